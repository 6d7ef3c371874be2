import random
import re

import pytest

from tidemill.llm.common import connected_components
from tidemill.llm.exact_dedup import exact_dedup
from tidemill.llm.near_dedup import differing_bits, most_differing_bits, near_dedup, shingle_sets, sketch, without_near_duplicates
from tidemill.llm.queries import llm_queries


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(width, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute(docs, width, percent=80):
    sets = {d: shingles(t, width) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_match_brute_force(spark, width):
    random.seed(width)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(40):
        base = [random.choice(words) for _ in range(random.randint(1, 90))]
        for _ in range(random.choice([1, 1, 3, 9])):
            own = list(base)
            for _ in range(random.choice([0, 0, 1, 2, 6])):
                own[random.randrange(len(own))] = random.choice(words)
            texts.append(" ".join(own))
    # A chain: each is near the next, the ends are not near each other.
    line = [f"c{i}" for i in range(80)]
    texts += [" ".join(line[k * 3 : k * 3 + 60]) for k in range(6)]
    docs = list(enumerate(texts))
    random.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r[0]: tuple(r[1:]) for r in near_dedup(spark, df, width=width).collect()}
    assert got == brute(docs, width)
    assert any(not kept for _, _, kept in got.values())


def test_large_bucket_with_several_components_is_compared_in_tiles(spark, monkeypatch):
    from tidemill.llm import near_dedup as module

    monkeypatch.setattr(module, "TILE", 8)
    random.seed(1)
    line = [f"x{i}" for i in range(100)]
    docs = []
    for i in range(60):
        own = list(line)
        for k in random.sample(range(100), 7):
            own[k] = f"y{i}_{k}"
        docs.append((i, " ".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r[0]: tuple(r[1:]) for r in near_dedup(spark, df, width=1).collect()}
    assert got == brute(docs, 1)


def test_odd_documents_near(spark, odd_docs, odd_rows, no_docs):
    rows = near_dedup(spark, odd_docs, width=2).collect()
    assert len(rows) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[7]["component_id"] == 1 and not by_id[7]["kept"]
    assert by_id[6]["component_id"] == 5
    assert by_id[3]["n_shingles"] == by_id[2]["n_shingles"] == by_id[4]["n_shingles"] == 0
    assert by_id[3]["kept"] and by_id[2]["kept"] and by_id[8]["n_shingles"] == 1
    assert [r["kept"] for r in rows if r["doc_id"] is None] == [True, True]
    assert near_dedup(spark, no_docs).collect() == []


def test_sketch_separates_far_from_close(spark):
    line = [f"w{i}" for i in range(500)]
    close = ["z"] * 10 + line[10:]
    far = [f"v{i}" for i in range(250)] + line[250:]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate((line, close, far))], "doc_id long, text string")
    odd = sketch(docs, 2).select("doc_id", "odd")
    pairs = odd.alias("x").crossJoin(odd.selectExpr("doc_id AS other", "odd AS odd_b"))
    bits = {(r[0], r[1]): r[2] for r in pairs.select("doc_id", "other", differing_bits("odd", "odd_b")).collect()}
    limit = most_differing_bits(0.8)
    assert bits[0, 0] == 0 and bits[0, 1] <= limit < bits[0, 2]


def test_shingle_sets_do_not_depend_on_neighbours():
    texts = ["a b c", "", "x", "a b  c\n", "B c A b c"]
    alone = [s.tolist() for t in texts for s in shingle_sets([t], 2)]
    assert [s.tolist() for s in shingle_sets(texts, 2)] == alone
    assert [len(s) for s in alone] == [2, 0, 1, 2, 3]
    assert alone[0] == alone[3]


def test_components_of_paths_stars_and_cycles(spark):
    random.seed(3)
    links = [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)] + [(300, 301), (301, 302), (302, 300)]
    links = [(a, b) if random.random() < 0.5 else (b, a) for a, b in links] + [(100, 101), (7, 7), (None, 3)]
    got = dict(connected_components(spark, spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: (i // 100) * 100 for i in [*range(100, 141), *range(200, 260), 300, 301, 302]}


def test_exact_duplicates(spark, odd_docs, odd_rows, no_docs):
    import hashlib

    for support in (0.001, 0.2):
        got = sorted(map(tuple, exact_dedup(spark, odd_docs, support).collect()), key=repr)
        groups = {}
        for doc_id, text, *_ in odd_rows:
            groups.setdefault(text or "", []).append(doc_id)
        want = []
        for doc_id, text, *_ in odd_rows:
            own = groups[text or ""]
            keep = max((d for d in own if d is not None), default=None)
            want.append((doc_id, keep, len(own), doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
        assert got == sorted(want, key=repr)
    assert exact_dedup(spark, no_docs).collect() == []


def test_exact_dedup_runs_no_python(spark):
    plan = llm_queries()["op7_exact_dedup"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_a_row_goes_by_its_id_and_text(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(3, a, "x"), (5, a, "x"), (5, b, "x"), (6, c, "x"), (6, c, "x"), (None, a, "x"), (None, a, "x"), (7, c + " more", "x"), (8, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, name string")
    kept = without_near_duplicates(spark, docs)
    assert kept.columns == docs.columns
    texts = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    some_a = [t for t in texts if t[1] == a and t[0] is not None]
    assert len(some_a) == 1 and (5, b) in texts and texts.count((6, c)) == 1 and (7, c + " more") not in texts
    assert texts.count((None, a)) == 2 and (8, None) in texts
    plain = spark.createDataFrame([(i, t, "x") for i, t in enumerate([a, a, b, c, c])], "doc_id long, text string, name string")
    assert sorted(r["doc_id"] for r in without_near_duplicates(spark, plain).collect()) == [0, 2, 3]
    assert without_near_duplicates(spark, docs.limit(0)).collect() == []
