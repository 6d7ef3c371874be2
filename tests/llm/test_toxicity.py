import math
import random
import re
import zlib

import numpy as np

from tidemill.llm.toxicity import ADDRESS, LABEL_TRUST, fitting_rows, label_model, op10_toxicity, score_toxicity, toxicity_score, train

BAD = ["vexgob", "drulk", "smarnit"]


def corpus(n=1500, seed=4):
    """Prose without the bad words, and toxic texts with one to four of them, some with endings not seen before."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(2 + i % 6)) for i in range(400)]
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.12
        own = [rng.choice(words) for _ in range(rng.randint(4, 120))]
        if toxic:
            for _ in range(rng.randint(1, 4)):
                own.insert(rng.randrange(len(own)), rng.choice(BAD) + rng.choice(["", "", "a", "en", f"x{i % 9}".replace("x", "y")]))
        docs.append((i, " ".join(own).capitalize() + ".", "xx", "s"))
        if i % 3:
            labels.append((i, 1, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    d, l = frames(spark, docs, labels)
    rows = {r["doc_id"]: r for r in score_toxicity(d, train(spark, d, l)).collect()}
    assert len(rows) == len(docs)
    truth = {i: any(b in t.lower() for b in BAD) for i, t, *_ in docs}
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    unseen = [i for i, r in rows.items() if r["held_out"]]
    assert sum(rows[i]["predicted"] == truth[i] for i in unseen) >= 0.98 * len(unseen)


def test_wrong_labels_are_outvoted(spark):
    docs, labels = corpus()
    rng = random.Random(2)
    noisy = [(i, q, 1 - t if rng.random() < 0.05 else t) for i, q, t in labels]
    d, l = frames(spark, docs, noisy)
    rows = score_toxicity(d, train(spark, d, l)).collect()
    right = [r["predicted"] == any(b in docs[r["doc_id"]][1].lower() for b in BAD) for r in rows]
    assert np.mean(right) >= 0.97


def test_held_out_labels_are_never_read(spark):
    docs, labels = corpus(600)
    d, l = frames(spark, docs, labels)
    other = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    one, two = train(spark, d, l), train(spark, d, frames(spark, docs, other)[1])
    assert one.entries == two.entries and np.allclose(one.weights, two.weights)


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(0)
    y = rng.random(8000) < 0.2
    fire = lambda hit, false: np.where(y, rng.random(8000) < hit, rng.random(8000) < false)
    good, weak = fire(0.6, 0.01), fire(0.4, 0.2)
    votes = np.stack([good, good, weak, fire(0.5, 0.02)], axis=1).astype(float)
    labels = np.where(rng.random(8000) < LABEL_TRUST, y, ~y).astype(float)
    posterior, model = label_model(votes, labels)
    assert model["accuracy"][0] > 0.85 > 0.5 > model["accuracy"][2]
    assert model["correlation"][0, 1] > 0.9 and abs(model["correlation"][0, 3]) < 0.2
    # Two voters that always agree weigh together about as much as one of the same quality.
    assert model["weights"][0] + model["weights"][1] < 1.6 * model["weights"][3]
    assert np.mean((posterior > 0.5) == y) >= np.mean((labels > 0.5) == y)


def test_odd_documents(spark, odd_docs, odd_rows, no_docs):
    docs, labels = corpus(400)
    d, l = frames(spark, docs, [*labels, (None, 1, 1), (3, 1, None), (5, None, 0), (5, None, 1)])
    model = train(spark, d, l)
    rows = score_toxicity(odd_docs, model).collect()
    assert len(rows) == len(odd_rows)
    assert all(not r["held_out"] for r in rows if r["doc_id"] is None)
    assert all(r["predicted"] == 0 for r in rows if r["doc_id"] in (2, 3, 4))
    column = odd_docs.select(toxicity_score(model).alias("s")).collect()
    assert sorted(round(r["s"], 12) for r in column) == sorted(round(r["score"], 12) for r in rows)
    assert score_toxicity(no_docs, model).collect() == []
    # Nothing to learn from.
    for few, score in ((l.limit(0), 0.5), (l.where("toxic = 0"), 0.0)):
        plain = train(spark, d, few)
        assert all(abs(r["score"] - score) < 1e-3 for r in score_toxicity(odd_docs, plain).collect())
    assert train(spark, no_docs.drop("toxic"), l).entries == []


def test_given_tables(spark):
    sf = "/root/testdata/sf0.1"
    truth = dict(map(tuple, spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic").collect()))
    rows = [r for r in op10_toxicity(spark, sf).collect() if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in rows]) >= 0.97


def test_the_label_is_a_voter_whose_accuracy_is_estimated():
    rng = np.random.default_rng(1)
    y = rng.random(9000) < 0.25
    votes = np.stack([np.where(y, rng.random(9000) < 0.7, rng.random(9000) < 0.02) for _ in range(5)], axis=1).astype(float)
    for right in (0.95, 0.8):
        labels = np.where(rng.random(9000) < right, y, ~y).astype(float)
        labels[rng.random(9000) < 0.4] = np.nan
        posterior, model = label_model(votes, labels)
        assert all(abs(p - right) < 0.04 for p in model["label"])
        unlabelled = np.isnan(labels)
        assert np.mean((posterior > 0.5)[unlabelled] == y[unlabelled]) >= 0.95
        assert np.mean((posterior > 0.5) == y) >= right


def test_rows_without_label_are_read_too(spark):
    docs, labels = corpus(900)
    d, l = frames(spark, docs, labels)
    fit = fitting_rows(spark, d, l, 24_000, 8_000).collect()
    known = {i for i, _, t in labels if t is not None}
    not_held = [i for i, *_ in docs if zlib.crc32(str(i).encode()) % 3 != 1]
    assert sum(r["toxic"] is None for r in fit) == len([i for i in not_held if i not in known])
    assert sum(r["toxic"] is not None for r in fit) == len([i for i in not_held if i in known])


def test_scores_by_hand(spark):
    docs, labels = corpus(600)
    d, l = frames(spark, docs, labels)
    model = train(spark, d, l)
    n = len(model.entries)
    for r in score_toxicity(d, model).collect():
        text = docs[r["doc_id"]][1]
        words = re.findall(r"[^\W\d_]+", text.lower())
        z = model.weights[-1]
        for i, entry in enumerate(model.entries):
            seen = sum(w == entry or (entry[-1] == "*" and len(w) >= len(entry) and w.startswith(entry[:-1])) for w in words)
            z += model.weights[i] * (1 + math.log(seen)) if seen else 0
        patterns = [
            float(text.isupper()),
            min(1, 20 * text.count("!") / len(text)),
            1 - min(len(text), sum(map(len, words)) + text.count(" ")) / len(text),
            max(words.count(w) for w in words) / len(words),
            min(1, 10 * sum(w in ADDRESS for w in words) / len(words)),
        ]
        z += sum(model.weights[n + j] * p for j, p in enumerate(patterns))
        assert abs(r["score"] - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-9
