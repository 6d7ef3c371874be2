"""The pipeline against brute force on a small corpus, and on tables with every odd case."""

import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from test_dedup import brute
from test_mixing import water_fill
from test_toxicity import BAD, corpus
from tokenizers import Tokenizer

import corpus_pipeline
from tidemill.llm.mixing import mix
from tidemill.llm.toxicity import fit_logistic, score_toxicity, train


def write(spark, folder, docs, labels, bench):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_and_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontaminate", "mix", "token_output"]


def test_pipeline_matches_brute_force(spark, tmp_path):
    rng = random.Random(8)
    base, labels = corpus(700, seed=8)
    bench = [(i, " ".join("".join(rng.choice("bcdfg") for _ in range(5)) for _ in range(25))) for i in range(5)]
    docs = [(i, t, "xx", f"s{i % 5}", len(t)) for i, t, *_ in base]
    for k in range(60):  # near and exact copies, and documents with a benchmark item
        i, t, _, s, _ = docs[k * 3 + 1]
        words = t.split()
        if k % 2 and len(words) > 60:
            words[-1] = "changed"
        docs.append((1000 + k, " ".join(words), "xx", s, 0))
        docs.append((2000 + k, f"{t} {bench[k % 5][1]} {t[::-1]}", "xx", s, 0))
    folder = write(spark, tmp_path, docs, labels, bench)

    # The classifier's accuracy has its own tests; here its decisions are taken as they are.
    all_docs, known = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    predicted = {r["doc_id"]: r["predicted"] for r in score_toxicity(all_docs, train(spark, all_docs, known)).collect()}
    toxic = [d for d in docs if any(b in d[1].lower() for b in BAD)]
    assert sum(predicted[d[0]] for d in toxic) >= 0.8 * len(toxic)
    assert sum(predicted.values()) <= len(toxic)
    kept = [d for d in docs if not predicted[d[0]]]
    groups = brute([(d[0], d[1]) for d in kept], 5)
    kept = [d for d in kept if groups[d[0]][2]]
    kept = [d for d in kept if not any(item in d[1] for _, item in bench)]
    mixed = {r["doc_id"]: r["repeats"] for r in mix(spark, spark.createDataFrame(kept, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    sizes = Counter()
    for d in kept:
        sizes[d[3]] += len(d[1].split())
    target, taken = water_fill(sizes, (5, 2, 1), 1.5, 2.0), Counter()
    for d in kept:
        taken[d[3]] += mixed[d[0]] * len(d[1].split())
    assert all(abs(target[s] - taken[s]) <= 250 for s in sizes)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for doc_id, text, *_ in sorted(kept):
        for _ in range(mixed[doc_id]):
            ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
            want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    got = sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=lambda r: r[1])
    assert got == want
    assert 0 < len({r[0] for r in got}) < len(docs)


def test_every_stage_takes_odd_documents(spark, tmp_path, odd_docs, odd_rows):
    _, labels = corpus(60)
    folder = write(spark, tmp_path, [(*r, 0) for r in odd_rows], labels, [(1, "nothing of this is in any of the texts at all")])
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "token_output":
            assert out.columns == docs.columns
            docs = out
        out.collect()
        assert stage(spark, odd_docs.limit(0), folder).collect() == []
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_stages_leave_no_scratch_tables_behind(spark, tmp_path, monkeypatch):
    """A stage's own tables are gone when it returns, but for what its lazy result still reads."""
    shared = tmp_path / "shared"
    monkeypatch.setattr(type(spark.conf), "get", lambda conf, name, *rest, plain=type(spark.conf).get: str(shared) if name == "spark.checkpoint.dir" else plain(conf, name, *rest))
    docs, labels = corpus(300, seed=3)
    docs = [(i, t, "xx", f"s{i % 3}", len(t)) for i, t, *_ in docs] + [(5000 + i, t, "xx", "s1", 0) for i, t, *_ in docs[:40]]
    folder = write(spark, tmp_path / "tables", docs, labels, [(1, "nothing of this is in any of the texts at all")])
    rows, left = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = set(shared.glob("*"))
        out = stage(spark, rows, folder)
        left[name] = sorted(p.name.split("-")[1] for p in set(shared.glob("*")) - before)
        assert out.count()
    assert left == {
        "toxicity": [], "near_dedup": ["decided", "shared"], "decontaminate": [], "mix": ["cuts"], "token_output": ["index", "places", "tokens"],
    }


def test_fitting_holds_long_numbers_of_few_rows_at_once():
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 3, (30_000, 120)).astype(np.float16), rng.random(30_000)
    x[:, -1] = 1
    tracemalloc.start()
    weights = fit_logistic(x, y)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < x.nbytes * 2  # all rows as float64, twice, would be eight times
    p = 1 / (1 + np.exp(-(x.astype(np.float64) @ weights)))
    shrunk = np.append(np.full(119, 0.05), 1e-6) * weights
    assert np.abs(x.astype(np.float64).T @ (p - y) + shrunk).max() < 1e-5
