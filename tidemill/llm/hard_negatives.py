"""Hard negatives by angles: rows of another label that score close to, but below, an anchor's positives.

Scores are integer inner products. A few reference directions are fixed first; every row stores its angle to each of
them and belongs to the cell of the nearest. By the triangle inequality of angles, an anchor at angle ``s`` and a row at
angle ``t`` to one direction are between ``|s - t|`` and ``s + t`` apart; the cosines of these, times
both lengths, bound the score, with a slack beyond what rounding can do.

1. Cells: their rows' angles and lengths bound an anchor's scores; it goes only to cells whose bounds meet a
   score window that it asks for.
2. Blocks: cells are cut into blocks of bounded size, however many rows a cell holds, sorted by angle. An anchor's
   windows are a stretch of angles of a block; only that stretch is scored, exactly.
3. Each block gives out its first ``k`` rows of each window; the first ``k`` of those are the answer. Before all rows, one
   in ``SEEDS`` (by hash of the id) is searched the same way: what it finds raises the windows' lower
   ends, so blocks give out little and stretches are short. It only narrows: all rows are searched.

First each anchor's ``positives`` best rows of its own label are searched (a window without ends), then, for each of them,
the rows of other labels between the two shares of its score.

The directions are fitted on at most ``SAMPLE`` rows (least hashes of the id); their choice moves the work, never the
result. Anchors, one row in a hundred, travel to the blocks; rows travel once per search.

Defined results: rows without id or label, with a null vector, or with a null or non-finite component take
no part. Rows that share an id count once, the one with the smallest label, then the smallest vector. A short vector counts as
filled up with zeros; an empty one scores 0. Equal scores go by the smaller id. Components saturate at 64 bits, as do
scores. Anchors without positive, and positives without negative, give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemill.llm.common import stored, table

DIRECTIONS, SAMPLE, SEEDS = 16, 1024, 16
#: Bytes of vectors in a block, and scores that a task holds at once.
BLOCK_BYTES, SCORES_AT_ONCE = 32 << 20, 1 << 21
MARGIN = 1e-5
LEAST, MOST = -(1 << 63), (1 << 63) - 1
ANSWER = "anchor_id long, ask int, id long, score long"


@dataclass(frozen=True)
class Cells:
    """Per cell: rows, the range of their lengths, and of their angles to each direction."""

    rows: np.ndarray
    norms: np.ndarray
    angles: np.ndarray

    def bounds(self, norm: np.ndarray, angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each anchor in each cell."""
        own = angles[:, None, :]
        low, high = self.angles[None, :, :, 0] - MARGIN, self.angles[None, :, :, 1] + MARGIN
        near = np.maximum(0, np.maximum(own - high, low - own)).max(axis=2)
        far = np.minimum(own + high, 2 * np.pi - own - low).min(axis=2)
        far = np.clip(np.maximum(far, near), 0, np.pi)
        return _bounds(norm[:, None], self.norms[None, :, 0], self.norms[None, :, 1], near, far)


def _bounds(norm, least, most, near, far) -> tuple[np.ndarray, np.ndarray]:
    """Scores of vectors of length ``norm`` with others of lengths from ``least`` to ``most``, ``near`` to ``far`` apart."""
    top, bottom = np.cos(np.minimum(near, np.pi)), np.cos(far)
    slack = 1 + 2 * MARGIN * norm * most
    return (
        norm * np.where(bottom < 0, most, least) * bottom - slack,
        norm * np.where(top < 0, least, most) * top + slack,
    )


def stretch(norm: np.ndarray, angle: np.ndarray, low: np.ndarray, high: np.ndarray, least: float, most: float) -> tuple:
    """Angles between which rows of lengths ``least`` to ``most`` can score from ``low`` to ``high``."""
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        slack = 1 + 2 * MARGIN * norm * most
        ratio = lambda score, size: np.nan_to_num(score / (norm * size), nan=0.0, posinf=1.0, neginf=-1.0)
        widest = np.arccos(np.clip(np.where(low - slack > 0, ratio(low - slack, most), ratio(low - slack, least)), -1, 1))
        closest = np.arccos(np.clip(np.where(high + slack > 0, ratio(high + slack, least), ratio(high + slack, most)), -1, 1))
    begin = np.maximum(angle - widest, closest - angle) - MARGIN
    end = np.minimum(angle + widest, 2 * np.pi - closest - angle) + MARGIN
    return begin, end


def scores_of(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors, saturated at 64 bits."""
    most = lambda v: float(np.abs(v.astype(np.float64)).max(initial=0))
    if anchors.shape[1] * most(anchors) * most(rows) < 2**53:
        return np.rint(anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    whole = anchors.astype(object) @ rows.astype(object).T
    return np.clip(whole, LEAST, MOST).astype(np.int64)


def _distinct(rows: DataFrame) -> DataFrame:
    """``vec_id, label, v``: the rows that take part, with integer components, once per id."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    return (
        rows.where("vec_id is not null and label is not null and embedding is not null")
        .where(fine)
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.struct("label", whole.alias("v")).alias("row"))
        .groupBy("vec_id")
        .agg(F.min("row").alias("row"))
        .select("vec_id", F.col("row.label").cast("long").alias("label"), "row.v")
    )


def _matrix(vectors: list, size: int) -> np.ndarray:
    out = np.zeros((len(vectors), size), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def directions(sample: np.ndarray, count: int = DIRECTIONS) -> np.ndarray:
    """Unit vectors, each as far as can be from those before it; fewer where the sample has fewer directions."""
    sample = sample.astype(np.float64)
    norms = np.linalg.norm(sample, axis=1)
    unit = sample[norms > 0] / norms[norms > 0, None]
    if not len(unit):
        return np.eye(1, sample.shape[1])
    chosen, near = [0], unit @ unit[0]
    while len(chosen) < min(count, len(unit)):
        farthest = int(near.argmin())
        if near[farthest] > 1 - 1e-9:
            break
        chosen.append(farthest)
        near = np.maximum(near, unit @ unit[farthest])
    return unit[chosen]


def with_angles(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, Cells, int, str]:
    """The rows stored with packed vectors, lengths and angles; their cells; components per vector and how they are packed."""
    distinct = stored(spark, _distinct(rows), "vectors")
    extent = F.array_max(F.transform("v", lambda x: F.greatest(x, -x - 1)))
    size, extent = distinct.agg(F.max(F.size("v")), F.max(extent)).first()
    size, kind = max(size or 0, 1), "<i2" if (extent or 0) < 1 << 15 else "<i8"
    sample = distinct.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    fixed = directions(_matrix([r["v"] for r in sample], size))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = _matrix(batch["v"].tolist(), size)
            norm = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
            cosines = (vectors @ fixed.T) / np.where(norm > 0, norm, 1)[:, None]
            angles = np.arccos(np.clip(cosines, -1, 1))
            yield pd.DataFrame(
                {
                    "vec_id": batch["vec_id"],
                    "label": batch["label"],
                    "v": [v.tobytes() for v in vectors.astype(kind)],
                    "norm": norm,
                    "cell": angles.argmin(axis=1),
                    "angles": list(angles.astype(np.float32)),
                }
            )

    schema = "vec_id long, label long, v binary, norm double, cell int, angles array<float>"
    measured = stored(spark, distinct.mapInPandas(measure, schema), "angles")
    ends = [f(F.col("angles")[i]).alias(f"{name}{i}") for i in range(len(fixed)) for name, f in (("low", F.min), ("high", F.max))]
    found = measured.groupBy("cell").agg(F.count("*").alias("n"), F.min("norm").alias("least"), F.max("norm").alias("most"), *ends)
    cells = Cells(np.zeros(len(fixed), np.int64), np.zeros((len(fixed), 2)), np.zeros((len(fixed), len(fixed), 2)))
    for cell, n, least, most, *angles in found.collect():  # DIRECTIONS rows at most
        cells.rows[cell], cells.norms[cell], cells.angles[cell] = n, (least, most), np.array(angles).reshape(-1, 2)
    return measured, cells, size, kind


def search(
    measured: DataFrame, cells: Cells, anchors: DataFrame, asks: DataFrame, k: int, same_label: bool, size: int, kind: str, share: int = 1
) -> DataFrame:
    """``anchor_id, ask, id, score``: a superset of the first ``k`` rows in each window ``low`` to ``high``, ``k`` a block at most."""
    per_block = max(256, BLOCK_BYTES // (8 * size))
    parts = -(-cells.rows // (per_block * share))
    first = np.cumsum(parts) - parts
    blocks = max(1, int(parts.sum()))
    of_cell = lambda numbers: F.element_at(F.array(*[F.lit(int(x)) for x in numbers]), F.col("cell") + 1)
    rows = measured.select(
        (of_cell(first) + F.pmod(F.xxhash64("vec_id"), of_cell(np.maximum(parts, 1)))).cast("int").alias("block"),
        F.lit(0).alias("role"),
        F.col("vec_id").alias("id"),
        "label",
        "v",
        "norm",
        F.element_at("angles", F.col("cell") + 1).cast("double").alias("angle"),
        F.lit(None).cast("array<int>").alias("ask"),
        F.lit(None).cast("array<long>").alias("low"),
        F.lit(None).cast("array<long>").alias("high"),
    )

    def cells_asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            low = np.array([x.min() for x in batch["low"]], np.float64)
            high = np.array([x.max() for x in batch["high"]], np.float64)
            least, most = cells.bounds(batch["norm"].to_numpy(), np.array(batch["angles"].tolist(), np.float64))
            meet = (most >= low[:, None]) & (least <= high[:, None]) & (parts > 0)
            yield batch.assign(cells=[np.flatnonzero(row).astype(np.int32) for row in meet])

    by_anchor = asks.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("ask", "low", "high"))).alias("asks"))
    asking = anchors.join(by_anchor.withColumnRenamed("anchor_id", "vec_id"), "vec_id").select(
        "vec_id", "label", "v", "norm", "angles", F.col("asks.ask").alias("ask"), F.col("asks.low").alias("low"), F.col("asks.high").alias("high")
    )
    schema = "vec_id long, label long, v binary, norm double, angles array<float>, ask array<int>, low array<long>, high array<long>, cells array<int>"
    sent = (
        asking.mapInPandas(cells_asked, schema)
        .withColumn("cell", F.explode("cells"))
        .withColumn("block", F.explode(F.sequence(of_cell(first), of_cell(first + parts - 1))))
        .select(
            "block",
            F.lit(1).alias("role"),
            F.col("vec_id").alias("id"),
            "label",
            "v",
            "norm",
            F.element_at("angles", F.col("cell") + 1).cast("double").alias("angle"),
            "ask",
            "low",
            "high",
        )
    )

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, held, packed = None, [], None
        for batch in batches:
            keys = batch["block"].to_numpy() * 2 + batch["role"].to_numpy()
            for part in np.split(np.arange(len(keys)), np.flatnonzero(np.diff(keys)) + 1):
                if not len(part):
                    continue
                some = batch.iloc[part]
                if some["block"].iloc[0] != block:
                    block, held, packed = some["block"].iloc[0], [], None
                if some["role"].iloc[0] == 0:
                    held.append(_block(some, size, kind))
                elif held:
                    packed = packed or tuple(np.concatenate(x) for x in zip(*held, strict=True))
                    held = held[:1]
                    yield from _scored(some, packed, k, same_label, size, kind)

    return (
        rows.unionByName(sent).repartition(blocks, "block").sortWithinPartitions("block", "role", "angle").mapInPandas(score, ANSWER)
    )


def _block(rows: pd.DataFrame, size: int, kind: str) -> tuple[np.ndarray, ...]:
    vectors = np.frombuffer(b"".join(rows["v"]), kind).reshape(-1, size)
    return vectors, rows["id"].to_numpy(), rows["label"].to_numpy(), rows["norm"].to_numpy(), rows["angle"].to_numpy()


def _scored(anchors: pd.DataFrame, block: tuple, k: int, same_label: bool, size: int, kind: str) -> Iterator[pd.DataFrame]:
    vectors, ids, labels, norms, angles = block
    own, own_ids, own_labels, own_norms, own_angles = _block(anchors, size, kind)
    asks = max(len(x) for x in anchors["ask"])
    filled = lambda column, rest: np.array([[*x, *[rest] * (asks - len(x))] for x in anchors[column].tolist()])
    ask, low, high = filled("ask", -1), filled("low", MOST), filled("high", LEAST)
    begin, end = stretch(
        own_norms, own_angles, low.min(axis=1).astype(np.float64), high.max(axis=1).astype(np.float64), norms.min(), norms.max()
    )
    begin, end = np.searchsorted(angles, begin), np.searchsorted(angles, end, "right")
    step = max(1, SCORES_AT_ONCE // len(ids))
    for at in range(0, len(own), step):
        some = np.arange(at, min(at + step, len(own)))
        some = some[end[some] > begin[some]]
        if not len(some):
            continue
        x, y = begin[some].min(), end[some].max()
        scores = scores_of(own[some], vectors[x:y])
        fits = own_labels[some, None] == labels[None, x:y]
        fits = fits & (own_ids[some, None] != ids[None, x:y]) if same_label else ~fits
        for j in range(asks):
            inside = fits & (scores >= low[some, j, None]) & (scores <= high[some, j, None])
            anchor, row = _first(inside, scores, ids[x:y], k)
            if len(anchor):
                yield pd.DataFrame(
                    {"anchor_id": own_ids[some[anchor]], "ask": ask[some[anchor], j], "id": ids[x:y][row], "score": scores[anchor, row]}
                )


def _first(inside: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first ``k`` of each row by score, then id."""
    if inside.sum(axis=1).max() > k:
        cut = np.partition(np.where(inside, scores, LEAST), -k, axis=1)[:, -k]
        inside = inside & (scores >= cut[:, None])
    anchor, row = np.nonzero(inside)
    order = np.lexsort((ids[row], ~scores[anchor, row], anchor))
    anchor, row = anchor[order], row[order]
    begins = np.flatnonzero(np.diff(anchor, prepend=-1))
    rank = np.arange(len(anchor)) - np.repeat(begins, np.diff(np.append(begins, len(anchor))))
    return anchor[rank < k], row[rank < k]


def best(spark: SparkSession, vectors: tuple, anchors: DataFrame, asks: DataFrame, k: int, same_label: bool, label: str) -> DataFrame:
    """The first ``k`` rows in every window, with their ``rank`` from 1; seeds first, then all rows."""
    measured, cells, size, kind = vectors
    order = Window.partitionBy("anchor_id", "ask").orderBy(F.desc("score"), "id")

    def found(rows: DataFrame, asks: DataFrame, share: int) -> DataFrame:
        candidates = search(rows, cells, anchors, asks, k, same_label, size, kind, share)
        return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    seeds = found(measured.where(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(SEEDS)) == 0), asks, SEEDS)
    floors = seeds.where(F.col("rank") == k).select("anchor_id", "ask", F.col("score").alias("floor"))
    raised = asks.join(floors, ["anchor_id", "ask"], "left").select("anchor_id", "ask", F.greatest("low", "floor").alias("low"), "high")
    return stored(spark, found(measured, stored(spark, raised, f"{label}-windows"), 1), label)


def hard_negatives(
    spark: SparkSession, rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 3, high: int = 9
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; anchors are the rows whose id ``every``
    divides, negatives score from ``low`` to ``high`` tenths of the positive's score."""
    vectors = with_angles(spark, rows)
    anchors = vectors[0].where(F.col("vec_id") % every == 0)
    anything = anchors.select(F.col("vec_id").alias("anchor_id"), F.lit(0).alias("ask"), F.lit(LEAST).alias("low"), F.lit(MOST).alias("high"))
    own = best(spark, vectors, anchors, anything, positives, True, "positives")
    tens, rest = "(score - pmod(score, 10L)) div 10", "pmod(score, 10L)"
    windows = own.select(
        "anchor_id",
        F.col("rank").alias("ask"),
        F.expr(f"{low} * ({tens}) + ({low} * {rest} + 9) div 10").alias("low"),
        F.expr(f"{high} * ({tens}) + ({high} * {rest}) div 10").alias("high"),
    ).where("low <= high")
    others = best(spark, vectors, anchors, windows, negatives, False, "negatives")
    mine = own.select("anchor_id", F.col("rank").alias("ask"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return others.join(mine, ["anchor_id", "ask"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(spark, table(spark, sf_dir, "embeddings").withColumn("label", label))


QUERIES = {"op13_hard_negatives": op13_hard_negatives}

ORACLES = {
    "op13_hard_negatives": """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
           CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score
    FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10""",
}
