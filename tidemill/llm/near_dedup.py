"""Near-duplicate documents: MinHash bands propose, odd sketches thin out, full sets decide.

Sketches. A document's set is its distinct shingles of ``width`` words, hashed to 64 bits. From
``BANDS * ROWS`` MinHash samples come the band keys, and an odd sketch: every (sample number, value)
flips one bit of ``SKETCH_BITS``. Two sketches differ in about as many bits as the samples differ in
elements, which tells high similarities apart with 64 bytes a document.

Links without pairs of whole groups:

1. Documents with equal sets are one class, folded by a partial minimum; its smallest id stands for it.
2. Each document is paired with the most central member that it shares a bucket with (the one that shares most
   buckets with most): one pair per document, however large its groups. The sketch thins the pairs out, the
   full sets confirm them, and the confirmed links give components. The same once more with the
   most central member of each bucket that still lies in several components.
3. In the buckets left, members of different components are compared in tiles of ``TILE`` members, inside
   tasks: by sketch, closest first, then by full sets. Only links that join components leave a
   task, so no pair of a group is ever a row. No bucket is capped.

A pair at similarity 0.8 shares no bucket with probability (1 - 0.8**5)**30 < 1e-5, and its sketch
is refused with less than that.

Defined results: a null text counts as empty; an empty set has no link. Words are taken from whole texts
of any length. Equal texts are linked. Rows that share a ``doc_id`` are nodes of one name: what links one of their texts may
link the others (``without_near_duplicates`` tells them apart); a row without ``doc_id`` is linked with nothing, has no component and
is kept. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.llm.common import connected_components, stored, stored_alone, table, text_of

ROWS, BANDS = 5, 30
SKETCH_BITS = 512
TILE = 256
#: Bytes of text that are hashed at once.
CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
SKETCH = "key long, absent boolean, name long, n_shingles long, set_a long, set_b long, keys array<long>, odd array<long>"


def _mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    z = h + np.uint64(salt * BASE % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def shingle_sets(texts: list[str], width: int) -> Iterator[np.ndarray]:
    """For each text, the sorted 64-bit hashes of its distinct shingles; letters A-Z count as a-z."""
    at = 0
    while at < len(texts):
        some, size = [], 0
        while at < len(texts) and (not some or size + len(texts[at]) <= CHUNK):
            some.append(texts[at].encode("utf-8").lower())
            size += len(some[-1])
            at += 1
        yield from _sets(some, width)


def _sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    codes = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    edges = np.flatnonzero(np.diff(blank, prepend=True))  # where words begin and end, in turn
    begins, ends = edges[::2], edges[1::2]
    up, down = np.full(len(codes), BASE, np.uint64), np.full(len(codes), BASE_INVERSE, np.uint64)
    up[:1] = down[:1] = 1
    up, down = np.cumprod(up), np.cumprod(down)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * down)))
    words = _mixed((sums[ends] - sums[begins]) * up[begins] + (ends - begins).astype(np.uint64))
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    cuts = np.searchsorted(begins, text_ends)
    first = 0
    for last in cuts.tolist():
        own = words[first:last]
        first = last
        if len(own):
            n = min(width, len(own))
            h = own[: len(own) - n + 1].copy()
            for k in range(1, n):
                h = _mixed(h * np.uint64(BASE)) + own[k : len(own) - n + 1 + k]
            own = np.unique(_mixed(h, n))
        yield own


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    numbers = _mixed(np.arange(2 * ROWS * BANDS, dtype=np.uint64), 11)
    return numbers[: ROWS * BANDS] | np.uint64(1), numbers[ROWS * BANDS :]


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """A row per document: a name of its text, size of its set, 128 bits that name the set, band keys, odd sketch."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        times, plus = _coefficients()
        slot = np.arange(ROWS * BANDS, dtype=np.uint64)
        for batch in batches:
            out = []
            for own in shingle_sets(list(batch["text"]), width):
                if not len(own):
                    out.append((0, 0, 0, [], []))
                    continue
                least = np.full(ROWS * BANDS, ~np.uint64(0))
                for i in range(0, len(own), 2048):
                    h = np.multiply.outer(times, own[i : i + 2048])
                    h += plus[:, None]
                    np.minimum(least, h.min(axis=1), out=least)
                keys = np.zeros(BANDS, np.uint64)
                for row in least.reshape(BANDS, ROWS).T:
                    keys = _mixed(keys * np.uint64(BASE) + row)
                keys = _mixed(keys + np.arange(BANDS, dtype=np.uint64), 5)
                flips = (_mixed(least + slot * np.uint64(BASE), 7) % np.uint64(SKETCH_BITS)).astype(np.int64)
                odd = np.packbits(np.bincount(flips, minlength=SKETCH_BITS) & 1).view(np.int64)
                set_a, set_b = _mixed(own, 3).sum(), _mixed(own, 4).sum()
                out.append((len(own), set_a.astype(np.int64), set_b.astype(np.int64), keys.view(np.int64), odd))
            found = pd.DataFrame(out, columns=["n_shingles", "set_a", "set_b", "keys", "odd"])
            yield found.assign(**{c: batch[c].to_numpy() for c in ("key", "absent", "name")})

    doc_id = F.col("doc_id").cast("long")
    texts = docs.select(
        F.coalesce(doc_id, F.lit(0)).alias("key"), doc_id.isNull().alias("absent"), F.xxhash64(text_of()).alias("name"), text_of().alias("text")
    )
    found = texts.mapInPandas(rows, SKETCH)
    return found.select(F.when(~F.col("absent"), F.col("key")).alias("doc_id"), *found.columns[2:])


def differing_bits(a: str, b: str) -> Column:
    """Population count of the XOR of two odd sketches."""
    parts = [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(SKETCH_BITS // 64)]
    return sum(parts[1:], parts[0])


def most_differing_bits(similarity: float) -> int:
    """Bits in which the sketches of a pair at ``similarity`` differ at most, six deviations allowed."""
    n = ROWS * BANDS
    differ = n * (1 - similarity) + 6 * (n * similarity * (1 - similarity)) ** 0.5
    expected = SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** (2 * min(differ, n)))
    return int(expected + 3 * expected**0.5)


def near_dedup(spark: SparkSession, docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row; links need ``similarity`` of the sets or more."""
    return _decided(spark, docs, width, similarity).drop("name")


def _decided(spark: SparkSession, docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """The rows of ``near_dedup`` with the ``name`` of their text."""
    sketches = stored(spark, sketch(docs, width), "sketches")
    named = sketches.where("n_shingles > 0 and doc_id is not null")
    classes = stored(
        spark, named.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("rep")), "classes"
    )
    reps = stored(
        spark,
        named.join(classes.select(F.col("rep").alias("doc_id"), "set_a", "set_b"), ["doc_id", "set_a", "set_b"], "left_semi").select(
            "doc_id", "n_shingles", "keys", "odd"
        ),
        "reps",
    )
    in_buckets = reps.select(F.explode("keys").alias("key"), "doc_id")
    buckets = in_buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(spark, in_buckets.join(buckets, "key"), "buckets")
    # Who shares many buckets with many is in the middle of its group, and near to most of it.
    degrees = shared.groupBy("doc_id").agg(F.sum("n").alias("degree"))
    leads = shared.join(degrees, "doc_id").groupBy("key").agg(F.max(F.struct("degree", (-F.col("doc_id")).alias("id"))).alias("lead"))
    shared = stored(spark, shared.join(leads, "key"), "led")
    brief = reps.select("doc_id", "n_shingles", "odd")
    sets = stored(spark, _sets_of(docs.join(degrees.select("doc_id"), "doc_id", "left_semi"), width), "sets")
    lead_id = -F.col("lead.id")

    # One pair per document first: with the most central member that it shares a bucket with.
    best = shared.where(F.col("doc_id") != lead_id).groupBy("doc_id").agg(F.max("lead").alias("lead"))
    pairs = best.select(lead_id.alias("a"), F.col("doc_id").alias("b"))
    components = _joined(spark, None, pairs, brief, sets, similarity)

    # Then with the most central member of each bucket that still lies in several components.
    placed = _placed(spark, shared, components)
    pairs = placed.where("component <> lead_component").select("a", "b").distinct()
    components = _joined(spark, components, pairs, brief, sets, similarity)

    # Then, in the buckets left, the members of different components among each other.
    placed = _placed(spark, shared, components)
    members = placed.select("key", "n", F.col("b").alias("doc_id"), "component").join(brief, "doc_id").join(sets, "doc_id")
    more = stored(spark, _across(members, similarity).distinct(), "more")
    if not more.isEmpty():
        components = connected_components(spark, _edges(components).union(more))

    by_set = ["set_a", "set_b", "n_shingles"]
    whole = (
        sketches.select("doc_id", "name", *by_set)
        .join(classes, by_set, "left")
        .join(components.withColumnRenamed("node", "rep"), "rep", "left")
        .select("doc_id", "name", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))
    )
    return whole.select(
        "doc_id",
        "name",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).alias("kept"),
    )


def without_near_duplicates(spark: SparkSession, docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: one of each group, one of rows equal in id and text.

    A row is its id and text. Texts that share an id are documents of their own here: each goes by a hash of both instead of the id,
    so none goes because another one of that id does.
    """
    key, name = F.col("doc_id").cast("long"), F.xxhash64(text_of())
    rows = docs.select(F.struct(*docs.columns).alias("doc"), key.alias("doc_id"), name.alias("name"), text_of().alias("text"))
    names = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("name").alias("low"), F.max("name").alias("high"))
    shared = stored(spark, names.where("low <> high").select("doc_id"), "shared")
    if not shared.isEmpty():
        told = rows.join(shared.withColumn("told", F.lit(True)), "doc_id", "left")
        rows = told.withColumn("doc_id", F.when(F.col("told"), F.xxhash64("doc_id", "name")).otherwise(F.col("doc_id")))
    decided = stored_alone(spark, lambda: _decided(spark, rows.select("doc_id", "text"), width, similarity), "decided")
    dropped = decided.where("not kept").select("doc_id", "name").distinct()
    rows = rows.select("doc", "doc_id", "name").join(dropped, ["doc_id", "name"], "left_anti")
    repeated = decided.where("kept and doc_id is not null").groupBy("doc_id", "name").agg(F.count("*").alias("n")).where("n > 1")
    if not repeated.isEmpty():
        once = rows.where("doc_id is not null").dropDuplicates(["doc_id", "name"])
        rows = once.union(rows.where("doc_id is null"))
    return rows.select("doc.*")


def _sets_of(docs: DataFrame, width: int) -> DataFrame:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [s.tobytes() for s in shingle_sets(list(batch["text"]), width)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "shingles": own})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return texts.mapInPandas(rows, "doc_id long, shingles binary")


def _thinned(pairs: DataFrame, brief: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sketches leave the similarity possible."""
    of = lambda side: brief.select(F.col("doc_id").alias(side), F.col("odd").alias(f"odd_{side}"))
    return (
        pairs.join(of("a"), "a")
        .join(of("b"), "b")
        .where(differing_bits("odd_a", "odd_b") <= most_differing_bits(similarity))
        .select("a", "b")
    )


def _edges(components: DataFrame) -> DataFrame:
    return components.select(F.col("node").alias("a"), F.col("component").alias("b"))


def _joined(
    spark: SparkSession, components: DataFrame | None, pairs: DataFrame, brief: DataFrame, sets: DataFrame, similarity: float
) -> DataFrame:
    """The components after the links among ``pairs``."""
    links = stored(spark, _confirmed(_thinned(pairs, brief, similarity), sets, round(100 * similarity)), "links")
    if components is not None:
        if links.isEmpty():
            return components
        links = _edges(components).union(links)
    return connected_components(spark, links)


def _placed(spark: SparkSession, shared: DataFrame, components: DataFrame) -> DataFrame:
    """``key, n, a, b, component, lead_component`` of the members ``b`` of the buckets with several components and of
    their leads ``a``; of buckets with the same members one is enough."""
    own = components.select(F.col("node").alias("doc_id"), "component")
    placed = stored(
        spark,
        shared.join(own, "doc_id", "left").select(
            "key", "n", (-F.col("lead.id")).alias("a"), F.col("doc_id").alias("b"), F.coalesce("component", "doc_id").alias("component")
        ),
        "placed",
    )
    several = (
        placed.groupBy("key", "n")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.bit_xor(F.xxhash64("b")).alias("x"),
            F.sum(F.hash("b").cast("long")).alias("s"),
            F.max(F.when(F.col("a") == F.col("b"), F.col("component"))).alias("lead_component"),
        )
        .where("low <> high")
        .groupBy("n", "x", "s")
        .agg(F.min(F.struct("key", "lead_component")).alias("first"))
        .select("first.*")
    )
    return stored(spark, placed.join(several, "key"), "several")


def _across(members: DataFrame, similarity: float) -> DataFrame:
    """Links ``a, b`` that join different components of a bucket, found tile by tile.

    A task holds two tiles with their sketches and sets. It compares members of different components, the
    closest sketches first, and gives out only links that join what was apart: fewer than it has members.
    """
    limit, percent = most_differing_bits(similarity), round(100 * similarity)

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        odd = np.array(rows["odd"].tolist(), np.int64).view(np.uint64).reshape(len(rows), -1)
        ids, size, tile = rows["doc_id"].to_numpy(), rows["n_shingles"].to_numpy(), rows["tile"].to_numpy()
        own = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
        group = rows["component"].to_numpy().copy()
        one, two = rows["i"].iloc[0], rows["j"].iloc[0]
        found = []
        for x in np.flatnonzero(tile == one).tolist():
            others = np.arange(x + 1, len(rows)) if one == two else np.flatnonzero(tile == two)
            others = others[group[others] != group[x]]
            others = others[100 * np.minimum(size[others], size[x]) >= percent * np.maximum(size[others], size[x])]
            bits = np.bitwise_count(odd[others] ^ odd[x]).sum(axis=1)
            near = np.argsort(bits, kind="stable")[: np.count_nonzero(bits <= limit)]
            for y in others[near].tolist():
                if group[y] != group[x] and _alike(own[x], own[y], percent):
                    found.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
                    group[group == group[y]] = group[x]
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    tiles = F.ceil(F.col("n") / TILE).cast("int")
    tiled = members.withColumn("tile", F.pmod(F.xxhash64("doc_id"), tiles).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), tiles - 1))
    )
    kept = ["tile", "doc_id", "component", "n_shingles", "odd", "shingles"]
    return (
        tiled.select("key", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), *kept)
        .groupBy("key", "i", "j")
        .applyInPandas(links, "a long, b long")
    )


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have ``percent`` of their union in common, or more."""
    if len(x) > len(y):
        x, y = y, x
    both = np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x)
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have ``percent`` of their union in common, or more."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = [
                _alike(np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64), percent)
                for one, two in zip(batch["set_of_a"], batch["set_of_b"], strict=True)
            ]
            yield batch.loc[good, ["a", "b"]]

    of = lambda side: sets.select(F.col("doc_id").alias(side), F.col("shingles").alias(f"set_of_{side}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").mapInPandas(check, "a long, b long")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(spark, table(spark, sf_dir, "documents"), width=2)


QUERIES = {"op4_near_dedup": op4_near_dedup}
ORACLES: dict[str, str] = {}
