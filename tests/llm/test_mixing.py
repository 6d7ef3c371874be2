from collections import defaultdict

import duckdb

from tidemill.llm.mixing import ORACLES, keyed, mix, mixed_documents, op8_mixing


def water_fill(sizes, weights, share, most):
    """Share out, cut at the limits, share the excess again, until nothing is above."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, rest = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while rest > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += rest * weight[s] / total
        rest = 0.0
        for s in list(open_):
            if target[s] >= most * sizes[s]:
                rest += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


def test_targets_and_whole_epochs(spark):
    docs = [(i, " ".join(["w"] * (1 + i * 7 % 50)), f"s{i % 7}") for i in range(900)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mix(spark, df).collect()
    sizes = defaultdict(int)
    for _, text, source in docs:
        sizes[source] += len(text.split())
    want = water_fill(sizes, (5, 2, 1), 1.5, 2.0)
    taken = defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert r["taken"] <= 2 * r["size"] and r["repeats"] in (int(r["target"] // r["source_size"]), int(r["target"] // r["source_size"]) + 1)
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 50 for s in sizes)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mix(spark, df.repartition(5)).collect()))


def test_better_documents_are_taken_more_often(spark):
    clean, noisy = "plain words here", "### $$$ !!! 123 %%%"
    docs = [(i, clean if i % 2 else noisy, "abc"[i % 3]) for i in range(3000)]
    rows = mix(spark, spark.createDataFrame(docs, "doc_id long, text string, source string"), share=0.5).collect()
    kept = [sum(r["repeats"] for r in rows if r["doc_id"] % 2 == odd) for odd in (0, 1)]
    assert kept[1] > 1.5 * kept[0]


def test_odd_documents(spark, odd_docs, odd_rows, no_docs):
    rows = mix(spark, odd_docs).collect()
    assert len(rows) == len(odd_rows)
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    out = mixed_documents(spark, odd_docs)
    assert out.columns == odd_docs.columns
    assert out.count() == sum(r["repeats"] for r in rows)
    assert mix(spark, no_docs).collect() == mixed_documents(spark, no_docs).collect() == []


def test_rows_without_id_or_of_one_id_meet_their_target(spark, tmp_path):
    docs = [(None, f"none {i} " * (i % 9 + 1), "a") for i in range(600)]
    docs += [(7, f"seven {i} " * (i % 7 + 1), "b") for i in range(600)] + [(i, f"own {i} " * 5, "c") for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    taken, target = defaultdict(int), {}
    for r in mix(spark, df, share=1.1).collect():
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 20 for s in target)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = op8_mixing(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(ORACLES["op8_mixing"]).fetchall()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_cells_are_even_at_any_weight(spark):
    rows = spark.range(200_000).selectExpr("id AS doc_id", "'a' AS source", "repeat('#', 40) AS text")
    most = keyed(rows, "mix").groupBy("cell").count().agg({"count": "max"}).first()[0]
    assert most <= 200_000 / 1000
