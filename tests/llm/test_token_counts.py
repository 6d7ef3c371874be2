import public_tokenizers
import sentencepiece
from hypothesis import given, settings, strategies as st

from tidemill.llm.token_counts import PrefixCounter, counts_of, fitting_prefix, fitting_prefixes, op1_token_counts, prefix_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


PIECES = sentencepiece.SentencePieceProcessor(model_file=MODEL)
COUNTER = PrefixCounter(MODEL)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab ceht  n\n\té漢\U0001f600▁.,#0<>\0 \rS", max_size=24))
def test_every_prefix_counts_as_the_library_counts_it(text):
    (steps,) = COUNTER.texts_steps([text])
    assert counts_of(steps).tolist() == [len(PIECES.encode(text[:p])) for p in range(len(text) + 1)]


def test_long_units_are_cut_only_where_no_piece_lies():
    text = "abcdefXYZ0123456789" * 40 + "漢字かな" * 60 + "".join(chr(97 + i * 7 % 26) for i in range(3000))
    (steps,) = COUNTER.texts_steps([text])
    for p in (0, 1, 50, 777, 1500, len(text)):
        assert counts_of(steps)[p] == len(PIECES.encode(text[:p]))


def test_prefix_within_a_budget():
    text = "The quick brown fox is unbelievably quick."
    (steps,) = COUNTER.texts_steps([text])
    for budget in range(len(PIECES.encode(text)) + 2):
        fits = [p for p in range(len(text) + 1) if len(PIECES.encode(text[:p])) <= budget]
        assert fitting_prefix(steps, budget) == max(fits)


def test_odd_documents(spark, odd_docs, odd_rows, no_docs):
    got = prefix_counts(odd_docs, MODEL, limit=4)
    texts = [r[1] or "" for r in odd_rows]
    want = sorted((str(r[0]), len(t.encode()), n := len(PIECES.encode(t)), n > 4) for r, t in zip(odd_rows, texts, strict=True))
    assert sorted((str(r[0]), *r[1:4]) for r in got.collect()) == want
    assert prefix_counts(no_docs, MODEL).collect() == []


def test_a_stored_table_answers_any_budget(spark, odd_docs, odd_rows, tmp_path):
    prefix_counts(odd_docs, MODEL).write.parquet(str(tmp_path / "prefixes"))
    kept = spark.read.parquet(str(tmp_path / "prefixes"))
    budgets = (0, 1, 5, 100)
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["fits"]) for r in fitting_prefixes(kept, budgets).collect())
    want = []
    for doc_id, text, *_ in odd_rows:
        text = text or ""
        short = text[:2000]  # any prefix within these budgets is shorter
        counts = [len(PIECES.encode(short[:p])) for p in range(len(short) + 1)]
        want.append((str(doc_id), len(text.encode()), [max(p for p, n in enumerate(counts) if n <= b) for b in budgets]))
    assert got == sorted(want)


def test_query_counts_like_the_library(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op1_token_counts(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        n = len(PIECES.encode(text))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 4096)
        for name, budget in (("fit_chars_512", 512), ("fit_chars_1024", 1024)):
            assert r[name] == len(text) if n <= budget else len(PIECES.encode(text[: r[name]])) <= budget
