"""Passages that repeat across documents, by suffix trees over words, split by variable-length prefixes.

Suffixes begin at every word. Their tree is cut ``width`` words below the root, as what a word's
fate needs is only whether its window of ``width`` words is an internal node that a smaller document
also has; longer repeats are chains of such nodes along suffix links (the next word's node).

1. Survey: one pass counts, over all documents, how many suffixes begin with each prefix of 1, 2, 4, ... words
   (prefixes dealt to bins). A bin that exceeds the memory-sized ``group_size`` is split by its longer
   prefixes, down to ``width`` words, where equal suffixes cannot part and the rest is split by hash. Light
   bins are packed together. So a group's size is bounded by what was counted, whatever words are frequent.
2. Inside a chunk of documents, suffixes under one node are folded: of each node only the smallest document's
   suffix leaves the task, and the other documents' suffixes are repeats already. A passage that a third of all
   documents hold travels once per chunk.
3. Each group is a subtree: its suffixes in tree order, equal ones side by side, are its deep internal nodes.
   A suffix is a repeat where its node has a smaller document.
4. The repeats go back to their documents, gathered by buckets of documents and joined; what consecutive windows
   cover are the maximal repeats.

A node's string is held as 64 hash bits beside its group, a word's as 64. Suffixes travel packed, about 9 bytes each.

Defined results: a null text has no words. Texts are read whole, of any length; a document of
fewer words than ``width`` has no window. Copies inside one document count for nothing, nor do rows that share
a ``doc_id``: each such row keeps or loses words by smaller ids alone. A row without ``doc_id``
neither loses words nor makes others lose them. Windows are judged on the input. Repeated rows get equal results, one
each. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.llm.common import WORD, stored, table, text_of
from tidemill.llm.words import mixed, prefix_hashes, word_hashes
from tidemill.storage import shuffles_released

#: Suffixes that one task holds as a subtree, words that a task folds at once, bins per prefix length at most.
GROUP_SIZE, CHUNK_WORDS, MOST_BINS = 1 << 21, 1 << 20, 1 << 16
PACKED = "grp long, settled boolean, ids binary, names binary, counts binary, nodes binary"
BUCKETED = "bucket long, ids binary, names binary, counts binary, nodes binary"


def _documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, a name of the text, and its bytes."""
    text = text_of()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("name"), text.cast("binary").alias("text"))


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """Rows, word hashes and words per row, about ``CHUNK_WORDS`` words (one text at least) at a time."""
    for batch in batches:
        texts = batch["text"].tolist()
        sizes = np.cumsum([len(t) // 6 + 1 for t in texts]) // CHUNK_WORDS
        for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(sizes)) + 1):
            if len(part):
                words, counts = word_hashes([texts[i] for i in part])
                yield batch.iloc[part], words, counts


def _windows(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[dict[int, np.ndarray], np.ndarray, np.ndarray]:
    """Prefix hashes by length of all windows inside a row, their rows, and where they begin."""
    hashes = prefix_hashes(words, width)
    row = np.repeat(np.arange(len(counts)), counts)
    if not hashes:
        return {}, row[:0], row[:0]
    starts = np.flatnonzero(row[: len(words) - width + 1] == row[width - 1 :])
    return {size: h[starts] for size, h in hashes.items()}, row[starts], starts


class Groups:
    """Which group a suffix belongs to: the shortest of its prefixes whose bin is light decides."""

    def __init__(self, counts: dict[int, np.ndarray], group_size: int):
        self.lengths = sorted(counts)
        self.first, self.parts, self.count = {}, {}, 0
        for length in self.lengths:
            n = counts[length]
            heavy = n > group_size
            if length == self.lengths[-1]:
                parts = np.maximum(1, -(-n // group_size))
            else:
                parts = np.ones(len(n), np.int64)
                n = np.where(heavy, 0, n)
            room = np.where(parts > 1, parts, 0)
            light = np.where(parts > 1, 0, n)
            filled = np.cumsum(light) // group_size
            split = self.count + int(filled[-1]) + 1
            self.first[length] = np.where(parts > 1, split + np.cumsum(room) - room, self.count + filled)
            self.parts[length] = parts
            if length != self.lengths[-1]:
                self.first[length][heavy] = -1
            self.count = split + int(room.sum())
            if not heavy.any():
                self.lengths = self.lengths[: self.lengths.index(length) + 1]
                break

    def of(self, hashes: dict[int, np.ndarray], width: int) -> np.ndarray:
        out = np.full(len(hashes[width]), -1, np.int64)
        for length in self.lengths:
            left = np.flatnonzero(out < 0)
            where = _bins(hashes[length][left], len(self.first[length]))
            parts = self.parts[length][where].astype(np.uint64)
            out[left] = self.first[length][where]
            more = np.flatnonzero((out[left] >= 0) & (parts > 1))
            out[left[more]] += (mixed(hashes[width][left[more]], 9) % parts[more]).astype(np.int64)
        return out


def _bins(h: np.ndarray, bins: int) -> np.ndarray:
    return (mixed(h, 3) % np.uint64(bins)).astype(np.int64)


def prefix_groups(docs: DataFrame, width: int, group_size: int) -> Groups:
    """The survey: bins of prefixes counted over all documents, as many as the text asks for, ``MOST_BINS`` a length at most."""
    total = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 5  # words, by a generous guess
    bins = min(MOST_BINS, 1 << max(10, int(16 * total // group_size).bit_length()))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[int, np.ndarray] = {}
        for _, words, sizes in _chunks(batches):
            hashes, _, _ = _windows(words, sizes, width)
            for length, h in hashes.items():
                counts[length] = counts.get(length, 0) + np.bincount(_bins(h, bins), minlength=bins)
        for length, n in counts.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"length": length, "bin": at, "n": n[at]})

    rows = (
        docs.select("text").mapInPandas(count, "length int, bin int, n long").groupBy("length", "bin").agg(F.sum("n").alias("n"))
    ).collect()  # a few times MOST_BINS numbers at most
    counts = {size: np.zeros(bins, np.int64) for size in prefix_hashes(np.zeros(width, np.uint64), width)}
    for length, at, n in rows:
        counts[length][at] = n
    return Groups(counts, group_size)


def _packed(rows: pd.DataFrame, row: np.ndarray, nodes: np.ndarray) -> tuple:
    """Documents, and the nodes of each, from entries ordered by row."""
    at = np.flatnonzero(np.diff(row, prepend=-1))
    own = row[at]
    counts = np.diff(np.append(at, len(row))).astype("<u4")
    ids = rows["doc_id"].to_numpy()[own].astype("<i8")
    return ids.tobytes(), rows["name"].to_numpy()[own].astype("<i8").tobytes(), counts.tobytes(), nodes.astype("<u8").tobytes()


def _folded(rows: pd.DataFrame, words: np.ndarray, sizes: np.ndarray, width: int, groups: Groups) -> Iterator[tuple]:
    """What a chunk gives out: by group, each node's smallest document; and the repeats that this settles."""
    hashes, row, _ = _windows(words, sizes, width)
    if not len(row):
        return
    ids = rows["doc_id"].to_numpy()[row]
    order = np.lexsort((row, ids, hashes[width]))
    node, row, ids = hashes[width][order], row[order], ids[order]
    new = np.diff(node, prepend=~node[:1]) != 0
    least = ids[new][np.cumsum(new) - 1]
    once = new | (np.diff(row, prepend=-1) != 0)  # a node of a document counts once
    repeat = once & (ids > least)
    leaves = np.flatnonzero(once & (ids == least))
    grp = groups.of({size: h[order[leaves]] for size, h in hashes.items()}, width)
    leaves = leaves[np.lexsort((row[leaves], grp))]
    grp = np.sort(grp)
    for part in np.split(np.arange(len(leaves)), np.flatnonzero(np.diff(grp)) + 1):
        mine = leaves[part]
        yield int(grp[part[0]]), False, *_packed(rows, row[mine], node[mine])
    repeats = np.flatnonzero(repeat)
    if len(repeats):
        repeats = repeats[np.argsort(row[repeats], kind="stable")]
        yield int(node[0] % np.uint64(groups.count)), True, *_packed(rows, row[repeats], node[repeats])


def _unpacked(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """Document ids and names, the document of each node, and the nodes."""
    cat = lambda column, kind: np.frombuffer(b"".join(rows[column]), kind)
    ids, names, counts = cat("ids", "<i8"), cat("names", "<i8"), cat("counts", "<u4")
    return ids, names, np.repeat(np.arange(len(ids)), counts), cat("nodes", "<u8")


def _by_bucket(ids: np.ndarray, names: np.ndarray, entry: np.ndarray, nodes: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Repeats by bucket of documents, packed, from entries ordered by document."""
    mine = (mixed(names.view(np.uint64) ^ mixed(ids.view(np.uint64), 2)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(mine[entry], kind="stable")
    entry, nodes = entry[order], nodes[order]
    rows = pd.DataFrame({"doc_id": ids, "name": names})
    for part in np.split(np.arange(len(entry)), np.flatnonzero(np.diff(mine[entry])) + 1):
        if len(part):
            yield int(mine[entry[part[0]]]), *_packed(rows, entry[part], nodes[part])


def _subtree(rows: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """The repeats of one group: suffixes in tree order, nodes being the stretches of equal ones."""
    settled = rows["settled"].to_numpy()
    out = list(_by_bucket(*_unpacked(rows[settled]), buckets))
    ids, names, entry, nodes = _unpacked(rows[~settled])
    if len(nodes):
        order = np.argsort(nodes, kind="stable")
        begins = np.flatnonzero(np.diff(nodes[order], prepend=~nodes[order[:1]]))
        least = np.minimum.reduceat(ids[entry[order]], begins)
        least = np.repeat(least, np.diff(np.append(begins, len(order))))
        repeat = np.sort(order[ids[entry[order]] > least])
        out += _by_bucket(ids, names, entry[repeat], nodes[repeat], buckets)
    return pd.DataFrame(out, columns=[c.split()[0] for c in BUCKETED.split(", ")])


def _by_document(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per document of a bucket with its repeats."""
    ids, names, entry, nodes = _unpacked(rows)
    order = np.lexsort((nodes, names[entry], ids[entry]))
    ids, names, nodes = ids[entry[order]], names[entry[order]], nodes[order]
    new = (np.diff(ids, prepend=~ids[:1]) != 0) | (np.diff(names, prepend=~names[:1]) != 0)
    at, raw = np.append(np.flatnonzero(new), len(new)), nodes.tobytes()
    found = [raw[8 * x : 8 * y] for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return pd.DataFrame({"doc_id": ids[at[:-1]], "name": names[at[:-1]], "nodes": found})


def repeated_windows(spark: SparkSession, docs: DataFrame, width: int = 13, group_size: int = GROUP_SIZE) -> DataFrame:
    """``doc_id, name, nodes``: of each document the windows that a smaller document has too (sorted hashes, packed)."""
    named = _documents(docs).where("doc_id is not null")
    groups = prefix_groups(named, width, group_size)
    buckets = groups.count

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in PACKED.split(", ")]
        for rows, words, sizes in _chunks(batch.drop_duplicates(["doc_id", "name"]) for batch in batches):
            yield pd.DataFrame(_folded(rows, words, sizes, width, groups), columns=columns)

    found = (
        named.mapInPandas(fold, PACKED)
        .repartition(buckets, "grp")
        .groupBy("grp")
        .applyInPandas(lambda rows: _subtree(rows, buckets), BUCKETED)
    )
    with shuffles_released(spark):
        repeats = stored(spark, found, "repeats")
    return repeats.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_by_document, "doc_id long, name long, nodes binary")


def _covered(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that begins at one of ``starts``."""
    steps = np.bincount(starts, minlength=n + 1) - np.bincount(starts + width, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def substring_dedup(spark: SparkSession, docs: DataFrame, width: int = 13, group_size: int = GROUP_SIZE) -> DataFrame:
    """``doc_id, n_words, n_removed, spans, kept_text`` of every row: repeated passages (word numbers, end exclusive) and
    what is left, one blank between words."""
    by_row = repeated_windows(spark, docs, width, group_size)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, packed in zip(batch["text"], batch["nodes"], strict=True):
                words = text.split()
                spans, kept = [], words
                if packed is not None:
                    marks = np.frombuffer(packed, "<u8")
                    hashes, _ = word_hashes([text])
                    found = prefix_hashes(hashes, width)[width]
                    place = np.minimum(np.searchsorted(marks, found), len(marks) - 1)
                    gone = _covered(len(words), np.flatnonzero(marks[place] == found), width)
                    spans = np.flatnonzero(np.diff(gone, prepend=False, append=False)).reshape(-1, 2).tolist()
                    kept = [words[i] for i in np.flatnonzero(~gone).tolist()]
                out.append((len(words), len(words) - len(kept), spans, b" ".join(kept).decode("utf-8", "replace")))
            done = pd.DataFrame(out, columns=["n_words", "n_removed", "spans", "kept_text"])
            yield done.assign(key=batch["key"].to_numpy(), absent=batch["absent"].to_numpy())

    return (
        _documents(docs)
        .join(by_row, ["doc_id", "name"], "left")
        .select(F.coalesce("doc_id", F.lit(0)).alias("key"), F.col("doc_id").isNull().alias("absent"), "text", "nodes")
        .mapInPandas(cut, "key long, absent boolean, n_words long, n_removed long, spans array<array<long>>, kept_text string")
        .select(F.when(~F.col("absent"), F.col("key")).alias("doc_id"), "n_words", "n_removed", "spans", "kept_text")
    )


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup(spark, table(spark, sf_dir, "documents"), width=13)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES = {"op11_substring_dedup": op11_substring_dedup}

ORACLES = {
    "op11_substring_dedup": f"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents
), numbered AS (
    SELECT row_number() OVER () AS r, doc_id, words, CAST(len(words) AS BIGINT) AS n FROM split
), windows AS (
    SELECT r, doc_id, i, array_to_string(words[i : i + 12], ' ') AS w
    FROM (SELECT r, doc_id, words, unnest(range(1, n - 11)) AS i FROM numbered WHERE n >= 13)
), repeats AS (
    SELECT r, i FROM (SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY w) AS least FROM windows) WHERE doc_id > least
), removed AS (
    SELECT DISTINCT r, unnest(range(i, i + 13)) AS i FROM repeats
), kept AS (
    SELECT r, i, w FROM (SELECT r, unnest(range(1, n + 1)) AS i, unnest(words) AS w FROM numbered)
    ANTI JOIN removed USING (r, i)
), texts AS (
    SELECT r, string_agg(w, ' ' ORDER BY i) AS text, count(*) AS n FROM kept GROUP BY r
)
SELECT doc_id, numbered.n AS n_words, CAST(numbered.n - coalesce(texts.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM numbered LEFT JOIN texts USING (r)""",
}
