"""Periodic runs of words inside documents, by the branching-tandem test on an enhanced suffix array.

For the words of one document: suffix array, its inverse (ISA) and the lengths of common prefixes (LCP). An LCP
interval of depth ``d`` is all suffixes that share ``d`` words; a square (two equal halves of
``d`` words, one at ``i`` and one at ``i + d``) whose next word differs is a pair of its suffixes in different
children. The suffixes of all but the largest child are tested: whether ``ISA[i + d]`` or ``ISA[i - d]`` lies in the
interval, outside the child. That is n log n tests, and no tree is built. Every run ends in one such
square for its period; turning the square to the left as long as the words agree gives the whole run. Squares that are
powers of a shorter one at the same end are left out, so the period is the smallest.

A document is one unit of work and costs about 60 bytes a word in its task; documents are dealt out as they lie, without a
shuffle. A document without two equal windows of ``min_words * (1 - 1 / min_exponent)`` words has no
run, which a pass over window hashes tells for most.

Defined results: a null or empty text has no words and no runs. Texts are read whole, of any length.
Repeated rows, rows that share a ``doc_id`` and rows without one get their own results. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.llm.common import WORD, table, text_of
from tidemill.llm.words import mixed, prefix_hashes, word_hashes

#: Words whose windows a task hashes at once, and suffixes that it tests at once.
CHUNK_WORDS, TESTS = 1 << 20, 1 << 20
RUNS = "array<struct<start: long, length: long, period: long>>"


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the place of each, by doubling the length that is sorted."""
    n = len(ids)
    rank, k = np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    while True:
        key = (rank + 1) * (n + 1)
        key[: n - k] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.diff(key[order], prepend=key[order[0]]) != 0)
        if rank[order[-1]] == n - 1:
            return order, rank
        k *= 2


def common_prefixes(ids: np.ndarray, sa: np.ndarray, isa: np.ndarray) -> np.ndarray:
    """Words that each suffix shares with the one before it in order; 0 for the first."""
    n, out = len(ids), np.zeros(len(ids), np.int32)
    text, order, place, lcp = memoryview(ids.astype(np.int32)), memoryview(sa.astype(np.int32)), memoryview(isa.astype(np.int32)), memoryview(out)
    shared = 0
    for i in range(n):
        at = place[i]
        if not at:
            shared = 0
            continue
        j = order[at - 1]
        most = n - max(i, j)
        while shared < most and text[i + shared] == text[j + shared]:
            shared += 1
        lcp[at] = shared
        if shared:
            shared -= 1
    return out


def _small_children(lcp: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """``depth, interval begin, end, child begin, end`` of every LCP interval and each of its children but the largest."""
    stack: list[tuple[int, int, list[int]]] = [(0, 0, [])]
    for i, depth in enumerate([*lcp[1:].tolist(), -1], 1):
        left = i - 1
        while stack and depth < stack[-1][0]:
            d, left, cuts = stack.pop()
            edges = [left, *cuts, i]
            sizes = [y - x for x, y in zip(edges, edges[1:])]  # noqa: B905
            largest = sizes.index(max(sizes))
            for c in range(len(sizes)):
                if c != largest:
                    yield d, left, i, edges[c], edges[c + 1]
        if depth < 0:
            return
        if stack[-1][0] == depth:
            stack[-1][2].append(i)
        else:
            stack.append((depth, left, [i]))


def branching_squares(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and half length of every square whose next word is not that of its first half's end."""
    n = len(ids)
    sa, isa = suffix_array(ids)
    children = _small_children(common_prefixes(ids, sa, isa))
    found = [np.zeros((0, 2), np.int64)]

    def test(some: list[tuple[int, int, int, int, int]]) -> None:
        depth, low, high, x, y = np.array(some, np.int64).T
        size = y - x
        which = np.repeat(np.arange(len(some)), size)
        suffix = sa[np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + x[which]]
        d = depth[which]
        for other, begin in ((suffix + d, suffix), (suffix - d, suffix - d)):
            inside = np.flatnonzero((other >= 0) & (other < n))
            at, w = isa[other[inside]], which[inside]
            good = (at >= low[w]) & (at < high[w]) & ((at < x[w]) | (at >= y[w]))
            found.append(np.column_stack([begin[inside[good]], d[inside[good]]]))

    some, held = [], 0
    for child in children:
        if child[0]:
            some.append(child)
            held += child[4] - child[3]
            if held > TESTS:
                test(some)
                some, held = [], 0
    if some:
        test(some)
    squares = np.unique(np.concatenate(found), axis=0)
    return squares[:, 0], squares[:, 1]


def runs_of(ids: np.ndarray, min_words: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all runs of ``max(min_words, min_exponent * period)`` words or more, by start, then period."""
    if len(ids) < max(min_words, 2):
        return []
    begin, half = branching_squares(ids)
    # Words that a run has left of its last square, at least; the first of them are compared for all squares at once.
    left = np.maximum(min_words - 2 * half, (min_exponent - 2) * half)
    keep = begin >= left
    begin, half, left = begin[keep], half[keep], left[keep]
    for step in range(1, 9):
        keep = (left < step) | (ids[begin - step] == ids[begin - step + half])
        begin, half, left = begin[keep], half[keep], left[keep]
    runs, by_end = [], {}
    for i, d in sorted(zip(begin.tolist(), half.tolist(), strict=True), key=lambda s: s[1]):
        same_end = by_end.setdefault(i + 2 * d, [])
        if any(d % period == 0 and start <= i for start, period in same_end):
            continue
        start = _turned(ids, i, d)
        same_end.append((start, d))
        length = i + 2 * d - start
        if length >= max(min_words, min_exponent * d):
            runs.append((start, length, d))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _turned(ids: np.ndarray, i: int, d: int) -> int:
    """How far a square can be turned to the left: the smallest begin from which the period holds."""
    step = 64
    while i > 0:
        low = max(0, i - step)
        differ = np.flatnonzero(ids[low:i] != ids[low + d : i + d])
        if len(differ):
            return low + int(differ[-1]) + 1
        i, step = low, 2 * step
    return 0


def _hopeful(texts: list[bytes], window: int) -> np.ndarray:
    """Whether a text has two equal windows of ``window`` words."""
    words, counts = word_hashes(texts)
    row = np.repeat(np.arange(len(counts)), counts)
    out = np.zeros(len(counts), bool)
    hashes = prefix_hashes(words, window)
    if hashes:
        own = np.flatnonzero(row[: len(words) - window + 1] == row[window - 1 :])
        h = mixed(hashes[window][own] + row[own].astype(np.uint64), 1)
        order = np.argsort(h)
        out[row[own[order[1:][h[order[1:]] == h[order[:-1]]]]]] = True
    return out


def _ids(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, min_words: int = 24, min_exponent: int = 3) -> DataFrame:
    """``doc_id, runs, collapsed_text`` of every row: all runs by start, then period, and the text without the words that
    a run repeats, one blank between words."""
    window = max(1, -(-min_words * (min_exponent - 1) // min_exponent))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            sizes = np.cumsum([len(t) // 6 + 1 for t in texts]) // CHUNK_WORDS
            for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(sizes)) + 1):
                out = []
                for text, hopeful in zip([texts[i] for i in part], _hopeful([texts[i] for i in part], window), strict=True):
                    words, runs = text.split(), []
                    if hopeful:
                        runs = runs_of(_ids(words), min_words, min_exponent)
                        words = _collapsed(words, runs) if runs else words
                    named = [dict(zip(("start", "length", "period"), r)) for r in runs]  # noqa: B905
                    out.append((named, b" ".join(words).decode("utf-8", "replace")))
                done = pd.DataFrame(out, columns=["runs", "collapsed_text"])
                yield done.assign(key=batch["key"].to_numpy()[part], absent=batch["absent"].to_numpy()[part])

    key = F.col("doc_id").cast("long")
    texts = docs.select(F.coalesce(key, F.lit(0)).alias("key"), key.isNull().alias("absent"), text_of().cast("binary").alias("text"))
    return texts.mapInPandas(find, f"key long, absent boolean, runs {RUNS}, collapsed_text string").select(
        F.when(~F.col("absent"), F.col("key")).alias("doc_id"), "runs", "collapsed_text"
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents of the stated query: one in ten repeats a stretch of its words up to its end."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string"))
    split = F.when(h % 10 == 0, F.regexp_extract_all(text_of(), F.lit(f"({WORD})"), F.lit(1)))
    words, g, n, a, p = (F.col(c) for c in ("words", "g", "n", "a", "p"))
    sized = docs.select("doc_id", "text", split.alias("words"), F.floor(h / 10).alias("g")).select(
        "*", F.coalesce(F.array_size("words"), F.lit(0)).alias("n")
    )
    begun = sized.select("*", F.when(n > 0, g % n).cast("int").alias("a"))
    placed = begun.select("*", (1 + F.floor((n - a) / (3 + g % 8))).cast("int").alias("p"))
    copies = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
    planted = F.concat(F.slice(words, F.lit(1), a), F.slice(F.flatten(copies), F.lit(1), n - a))
    return placed.select("doc_id", F.when(n > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def strongest(runs: str) -> Column:
    """The run of greatest length to period; of ties the first."""
    longer = "r.length * b.period > b.length * r.period"
    return F.expr(f"reduce({runs}, {runs}[0], (b, r) -> CASE WHEN {longer} THEN r ELSE b END)")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(table(spark, sf_dir, "documents"))
    found = periodic_runs(docs, min_words=24, min_exponent=3).withColumn(
        "best", F.when(F.size("runs") > 0, strongest("runs"))
    )
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
ORACLES: dict[str, str] = {}
