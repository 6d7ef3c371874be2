import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidemill.llm.common import table
from tidemill.llm.periodic_runs import branching_squares, op12_periodic_runs, periodic_runs, runs_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=24, exponent=3):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q) and (i, j + q - i) not in found:
                found[i, j + q - i] = q  # the first is the smallest period
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_row(doc_id, words):
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = (None,) * 4
    for s, n, q in runs:
        if best[0] is None or n * best[2] > best[1] * q:
            best = (s, n, q, 1000 * n // q)
    return (
        doc_id,
        len(runs),
        *best,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def planted(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def texts(seed=7, count=400):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        alphabet = rng.choice([1, 2, 3, 5])
        words = []
        while len(words) < rng.randint(1, 150):
            unit = [rng.randrange(alphabet) for _ in range(rng.randint(1, 12))]
            words += unit * rng.choice([1, 1, 2, 3, 4, 10]) + unit[: rng.randint(0, len(unit))]
        out.append(words)
    return out


def test_runs_equal_brute_force():
    for words in texts():
        assert runs_of(np.array(words), 24, 3) == brute_runs(words), words


@pytest.mark.parametrize(("least", "exponent"), [(2, 2), (6, 2), (9, 3), (40, 4)])
def test_other_limits(least, exponent):
    for words in texts(11, 150):
        assert runs_of(np.array(words), least, exponent) == brute_runs(words, least, exponent), words


def test_squares_are_those_whose_next_word_differs():
    for words in texts(5, 60):
        words = words[:60]
        n, want = len(words), set()
        for d in range(1, n // 2 + 1):
            for i in range(n - 2 * d + 1):
                if words[i : i + d] == words[i + d : i + 2 * d] and (i + 2 * d == n or words[i + 2 * d] != words[i + d]):
                    want.add((i, d))
        begin, half = branching_squares(np.array(words)) if n > 1 else (np.zeros(0), np.zeros(0))
        assert set(zip(begin.tolist(), half.tolist(), strict=True)) == want


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    want = sorted(brute_row(i, planted(i, t)) for i, t in docs)
    got = op12_periodic_runs(spark, sf_dir)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect())) == want
    assert sum(row[1] for row in want) >= 10


def test_odd_rows(spark, odd_rows, odd_docs, no_docs):
    rows = lambda df: sorted(((r[0], [tuple(x) for x in r[1]], r[2]) for r in df.collect()), key=repr)
    want = []
    for doc_id, text, *_ in odd_rows:
        words = WORD.findall(text or "")
        runs = [(0, 63_000, 7)] if len(words) == 63_000 else brute_runs(words)
        kept = words[:7] if len(words) == 63_000 else words
        want.append((doc_id, runs, " ".join(kept)))
    assert rows(periodic_runs(odd_docs)) == sorted(want, key=repr)
    assert rows(periodic_runs(no_docs)) == []


def test_one_word_many_times_takes_no_quadratic_time(spark):
    words = np.zeros(200_000, np.int64)
    assert runs_of(words, 24, 3) == [(0, 200_000, 1)]


def test_large_ids_beside_missing_ones(spark):
    docs = spark.createDataFrame([(2**60 + 1, "a b " * 20), (None, "a b " * 20)], "doc_id long, text string")
    got = {r["doc_id"]: r["collapsed_text"] for r in periodic_runs(docs).collect()}
    assert got == {2**60 + 1: "a b", None: "a b"}


