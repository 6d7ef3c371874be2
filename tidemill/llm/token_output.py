"""Token ids as raw binary shards, with a minimal perfect hash index from document key to place.

Shards. Documents are encoded where they lie; their ids are dealt out by ranges of ``doc_id`` that hold about
``SHARD_BYTES`` of text each (ranges of length and hash too, where rows have no id or share one), and sorted. Each range
becomes one shard file, or several of ``RECORDS_PER_FILE`` records, written by Spark's own committer, so a lost executor or a
repeated task leaves nothing half done and any file system that Spark writes to will do. A record is

    doc_id int64, flags uint8, ids uint32, then the ids themselves, then one line end (0x0A)

with all numbers little-endian and ids of two bytes for vocabularies up to 65,536, else four. Flag 1
marks a document without ``doc_id``, flag 2 one whose ``doc_id`` an earlier record has.

Index. Keys are dealt by hash to buckets of about ``PER_BUCKET``. Each bucket has a minimal
perfect hash (groups of keys are displaced, largest first, until all slots differ), and per slot a
32-bit fingerprint by another hash, the shard and the byte offset. A lookup reads one bucket
row, computes one slot and compares one fingerprint, however many documents there are; a
key that was never written is refused but for one chance in 2**32.

Defined results: a null text counts as empty; it holds the end id alone. Documents without
``doc_id`` come first, repeated ones follow each other (shortest text first); both are written and
read back, but the index has no entry for a missing key and leads to the first of
equal ones. Texts are encoded whole. An empty table makes no record and an empty index. Other
columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemill.llm.common import process_memory, stored, table, text_of
from tidemill.llm.words import span_hashes
from tidemill.storage import scratch_dir, scratch_released, shuffles_released

PER_BUCKET = 2048
SHARD_BYTES = 8 << 20
#: Bytes of ids that a task gives out at once, and records of a file: a shard of more goes on in another file.
AT_ONCE, RECORDS_PER_FILE = 4 << 20, 1 << 16
ORDER = ("absent", "key", "chars", "mark")
HEADER = "<qBI"
HEADER_SIZE = struct.calcsize(HEADER)
NO_KEY, REPEATED = 1, 2
PLACES = "doc_id long, flags int, shard long, offset long, n_tokens long, before long, ids_crc32 long"


class PieceEncoder:
    """Ids of whole texts as the tokenizer gives them, each word encoded once and then remembered.

    No token of these tokenizers reaches over a blank, nor from letters to digits or signs, so texts are cut there:
    pieces between blanks (space, tab, line ends), and pieces of ASCII alone once more where the kind of sign changes,
    in lower case. What is left whole, and texts with special strings, goes to the library as it is. Words are found by 64-bit hashes
    of their bytes, a chunk of text at once; the ids of ``HELD_BYTES`` worth of words are remembered, the first met. Beyond
    that a new word is encoded again in every chunk that has it. ``apart`` says whether a tokenizer file works that
    way; with others, texts are encoded as they are.
    """

    TAIL = ".,;:!?"
    #: Bytes of text that are split at once, words that are encoded as one string, and bytes of words remembered.
    CHUNK, WORDS, HELD_BYTES = 1 << 20, 500, 32 << 20
    #: Kinds of bytes: blank, letter, digit, sign, and what keeps a piece whole (apostrophes, controls, beyond ASCII).
    KINDS = np.array(
        [
            0 if b in b" \t\n\r" else 4 if b < 33 or b > 126 or b == 39 else 1 if chr(b).isalpha() else 2 if chr(b).isdigit() else 3
            for b in range(256)
        ],
        np.uint8,
    )
    LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        size = self.tokenizer.get_vocab_size()
        self.width = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.ends_word = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.apart = self._works_apart()
        self.hashes = np.zeros(0, np.uint64)
        self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids, self.held = np.zeros(1 << 16, self.width), 0

    def _works_apart(self) -> bool:
        probe = ["a", "it's", "1", ",", "2", "word", ".", "word", ".", "x", "-", "9", "9"]
        one = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        return one("  a\n it's\t\r1,2 Word. word\n. X-99") == [i for p in probe for i in one(p)]

    def _encode(self, pieces: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, self.width) for e in found]

    def _encode_words(self, words: list[str]) -> list[np.ndarray]:
        out = []
        for i in range(0, len(words), self.WORDS):
            some = words[i : i + self.WORDS]
            (whole,) = self._encode([" ".join(some)])
            cuts = (np.flatnonzero(self.ends_word[whole]) + 1).tolist()
            out += [whole[x:y] for x, y in zip([0, *cuts], cuts)] if len(cuts) == len(some) else self._encode(some)  # noqa: B905
        return out

    def _encode_pieces(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of pieces without blanks: words many at once, also those before common punctuation."""
        parted, odd = [], []
        for piece in pieces:
            core = piece.rstrip(self.TAIL)
            plain = core.isalpha() and (core.isascii() or (max(core) < "\u0250" and core.lower().isalpha()))
            parted.append((core.lower(), piece[len(core) :]) if plain else None)
            if not plain:
                odd.append(piece)
        words = list({p[0] for p in parted if p})
        tails = list({p[1] for p in parted if p and p[1]})
        ids = dict(zip(words, self._encode_words(words), strict=True))
        ends = dict(zip(tails, self._encode(tails), strict=True))
        rest = iter(self._encode(odd))
        return [next(rest) if not p else np.concatenate((ids[p[0]], ends[p[1]])) if p[1] else ids[p[0]] for p in parted]

    def encode(self, texts: list[str] | list[bytes]) -> Iterator[bytes]:
        some, size = [], 0
        for text in texts:
            raw = text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")
            if some and size + len(raw) > self.CHUNK:
                yield from self._encode_texts(some)
                some, size = [], 0
            some.append(raw)
            size += len(raw)
        if some:
            yield from self._encode_texts(some)

    def _encode_texts(self, texts: list[bytes]) -> list[bytes]:
        whole = [not self.apart or (b"<" in t and any(s in t.lower() for s in self.special)) for t in texts]
        if any(whole):
            cut = iter(self._encode_chunk([t for t, w in zip(texts, whole, strict=True) if not w]))
            ids = iter(self._encode([t.decode("utf-8", "replace") for t, w in zip(texts, whole, strict=True) if w]))
            return [next(ids).tobytes() if w else next(cut) for w in whole]
        return self._encode_chunk(texts)

    def _encode_chunk(self, texts: list[bytes]) -> list[bytes]:
        joined = b"\n".join(texts) + b"\n"
        codes, begins, ends = self._words_of(np.frombuffer(joined, np.uint8))
        names, first, which = np.unique(span_hashes(codes, begins, ends), return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.hashes, names), max(len(self.hashes) - 1, 0))
        known = self.hashes[place] == names if len(self.hashes) else np.zeros(len(names), bool)
        new = np.flatnonzero(~known)
        raw = codes.tobytes()
        spans = zip(begins[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
        fresh = self._encode_pieces([raw[x:y].decode("utf-8", "replace") for x, y in spans])
        start, size = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        start[known], size[known] = self.starts[place[known]], self.sizes[place[known]]
        size[new] = [len(ids) for ids in fresh]
        start[new] = self.held + np.cumsum(size[new]) - size[new]
        pool = self._pool(fresh)
        if len(new) and 16 * (len(self.hashes) + len(new)) + self.width.itemsize * (self.held + int(size[new].sum())) <= self.HELD_BYTES:
            at = np.searchsorted(self.hashes, names[new])
            self.hashes = np.insert(self.hashes, at, names[new])
            self.starts, self.sizes = np.insert(self.starts, at, start[new]), np.insert(self.sizes, at, size[new])
            self.held += int(size[new].sum())
        size, start = size[which], start[which]
        until = np.cumsum(size)
        total = int(until[-1]) if len(until) else 0
        ids = pool[np.repeat(start - until + size, size) + np.arange(total)].tobytes()
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        cuts = np.concatenate((np.zeros(1, np.int64), until))[np.searchsorted(begins, text_ends)] * self.width.itemsize
        return [ids[x:y] for x, y in zip([0, *cuts.tolist()], cuts.tolist())]  # noqa: B905

    def _pool(self, fresh: list[np.ndarray]) -> np.ndarray:
        """The remembered ids, and behind them the new ones."""
        if fresh:
            more = np.concatenate(fresh)
            if self.held + len(more) > len(self.ids):
                self.ids = np.concatenate((self.ids[: self.held], np.zeros(self.held + 2 * len(more), self.width)))
            self.ids[self.held : self.held + len(more)] = more
        return self.ids

    def _words_of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes, in lower case where they are cut by kind, and where words begin and end."""
        kind = self.KINDS[codes]
        before = np.concatenate((np.zeros(1, np.uint8), kind[:-1]))
        blank = kind == 0
        begin = ~blank & (before == 0)
        cut = ~blank & (before != 0) & ((kind != before) | (kind == 2))
        lower = self.LOWER[codes]
        odd = np.flatnonzero(kind == 4)
        if len(odd):
            starts = np.flatnonzero(begin)
            pieces = np.unique(np.searchsorted(starts, odd, "right") - 1)
            stops = np.flatnonzero(blank & (before != 0))
            steps = np.zeros(len(codes) + 1, np.int8)
            steps[starts[pieces]] += 1
            steps[stops[pieces]] -= 1
            kept = np.cumsum(steps[:-1], dtype=np.int8).view(bool)
            cut &= ~kept
            lower = np.where(kept, codes, lower)
        edges = np.flatnonzero(begin | cut | (blank & (before != 0)))
        first = np.flatnonzero(~blank[edges])
        return lower, edges[first], edges[first + 1]


def _encoder(tokenizer_file: str) -> PieceEncoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    held = process_memory("piece encoders")
    if tokenizer_file not in held:
        held[tokenizer_file] = PieceEncoder(tokenizer_file)
    return held[tokenizer_file]


@dataclass(frozen=True)
class Cuts:
    """Where shards begin, as sortable keys, and whether an earlier shard ends with the same ``doc_id``."""

    keys: np.ndarray
    continued: tuple[bool, ...]

    def shard_of(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, keys, "right").astype(np.int32)


def _sortable(absent: np.ndarray, key: np.ndarray, chars: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Bytes that sort as rows do: without id first, then by id, length and hash of the text."""
    out = np.zeros((len(key), 25), np.uint8)
    out[:, 0] = ~absent.astype(bool)
    for i, column in enumerate((key, chars, mark)):
        signed = column.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
        out[:, 1 + 8 * i : 9 + 8 * i] = signed.astype(">u8").view(np.uint8).reshape(-1, 8)
    return out.reshape(-1).view("S25")


def shard_cuts(spark: SparkSession, texts: DataFrame, shard_bytes: int) -> Cuts:
    """Cuts that give every shard about ``shard_bytes`` of text, also among rows without id or of one id.

    Only ids, lengths and hashes travel. The driver gets one row per shard.
    """
    total, rows = texts.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    if not total or total <= shard_bytes:
        return Cuts(np.zeros(0, "S25"), (False,))
    sizes = texts.select(*ORDER, F.octet_length("text").alias("size"))
    spread = sizes.repartitionByRange(1 + rows // 1_000_000, *ORDER).withColumn("part", F.spark_partition_id())
    placed = stored(spark, spread, "sizes")
    parts = placed.groupBy("part").agg(F.sum("size").alias("bytes"))
    begins = parts.select("part", F.coalesce(F.sum("bytes").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("begin"))
    running = F.sum("size").over(Window.partitionBy("part").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0))
    shard = F.floor((F.col("begin") + F.col("running") - F.col("size")) / shard_bytes)
    numbered = placed.withColumn("running", running).join(F.broadcast(begins), "part").withColumn("shard", shard)
    first = numbered.groupBy("shard").agg(F.min(F.struct(*ORDER)).alias("row")).select("row.*").orderBy(*ORDER)
    cuts = stored(spark, first.distinct(), "cuts")
    least = placed.join(F.broadcast(cuts.select("absent", "key").distinct()), ["absent", "key"], "left_semi")
    least = {(r["absent"], r["key"]): r["row"] for r in least.groupBy("absent", "key").agg(F.min(F.struct(*ORDER)).alias("row")).collect()}
    rows = sorted(cuts.collect(), key=lambda r: (not r["absent"], *r[1:]))[1:]
    found = [np.array([r[i] for r in rows], bool if i == 0 else np.int64) for i in range(4)]
    return Cuts(_sortable(*found), (False, *(tuple(least[r["absent"], r["key"]]) != tuple(r) for r in rows)))


def write_shards(
    docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 2, shard_bytes: int = SHARD_BYTES
) -> None:
    """Write all documents, in ascending ``doc_id``, as raw shards below ``path``. Texts are encoded where they lie; ids travel."""
    spark, doc_id = docs.sparkSession, F.col("doc_id").cast("long")
    texts = docs.select(
        doc_id.isNull().alias("absent"),
        F.coalesce(doc_id, F.lit(0)).alias("key"),
        F.length(text_of()).cast("long").alias("chars"),
        F.xxhash64(text_of()).alias("mark"),
        text_of().alias("text"),
    )
    with scratch_released(spark):
        cuts = shard_cuts(spark, texts, shard_bytes)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer_file)
        end = np.array([end_id], encoder.width).tobytes()
        for batch in batches:
            order = [batch[c].to_numpy() for c in ORDER]
            shards = cuts.shard_of(_sortable(*order))
            for at, ids in _bounded(encoder.encode(batch["text"].tolist())):
                part = slice(at, at + len(ids))
                yield pd.DataFrame(
                    {"shard": shards[part], **dict(zip(ORDER, (c[part] for c in order), strict=True)), "ids": [raw + end for raw in ids]}
                )

    def frame(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before, width = None, _encoder_width(tokenizer_file)
        for batch in batches:
            records = []
            for shard, absent, key, raw in zip(batch["shard"].tolist(), batch["absent"].tolist(), batch["key"].tolist(), batch["ids"], strict=True):
                repeated = key == before[1] if before and before[0] == shard else cuts.continued[shard]
                flags = NO_KEY if absent else REPEATED if repeated else 0
                before = (shard, None if absent else key)
                records.append(struct.pack(HEADER, key, flags, len(raw) // width) + raw)
            yield pd.DataFrame({"record": records})

    encoded = texts.select(*ORDER, F.col("text").cast("binary").alias("text")).mapInPandas(
        encode, "shard int, absent boolean, key long, chars long, mark long, ids binary"
    )
    ordered = encoded.repartitionById(len(cuts.continued), "shard").sortWithinPartitions("shard", F.desc("absent"), "key", "chars", "mark")
    records = ordered.select("shard", "absent", "key", "ids").mapInPandas(frame, "record binary")
    with shuffles_released(spark):
        records.select(F.col("record").cast("string").alias("value")).write.option("compression", "none").option(
            "maxRecordsPerFile", RECORDS_PER_FILE
        ).text(path)


def _bounded(ids: Iterator[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """The ids in lists of ``AT_ONCE`` bytes (one document at least), each with the number of its first."""
    at, some, size = 0, [], 0
    for raw in ids:
        some.append(raw)
        size += len(raw)
        if size > AT_ONCE:
            yield at, some
            at, some, size = at + len(some), [], 0
    if some:
        yield at, some


def _encoder_width(tokenizer_file: str) -> int:
    return _encoder(tokenizer_file).width.itemsize


def scan_shards(spark: SparkSession, path: str, width: str = "<u2") -> DataFrame:
    """Every record, read back: its key, flags, shard, byte offset, ids, ids before it in the shard, and their checksum."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, content in zip(batch["shard"], batch["content"], strict=True):
                yield _records(int(shard), content, np.dtype(width))

    return _shard_files(spark, path).mapInPandas(read, PLACES)


def _shard_files(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(path)
        .select(
            (F.regexp_extract("path", r"part-(\d+)", 1).cast("long") * 1_000_000 + F.regexp_extract("path", r"-c(\d+)\.", 1).cast("long")).alias("shard"),
            "content",
        )
    )


def _records(shard: int, content: bytes, width: np.dtype) -> pd.DataFrame:
    rows, at, before = [], 0, 0
    view = memoryview(content)
    while at < len(content):
        key, flags, n = struct.unpack_from(HEADER, content, at)
        ids = np.frombuffer(view[at + HEADER_SIZE : at + HEADER_SIZE + n * width.itemsize], width)
        rows.append((None if flags & NO_KEY else key, flags, shard, at, n, before, zlib.crc32(ids.astype("<u4").tobytes())))
        before += n
        at += HEADER_SIZE + n * width.itemsize + 1
    columns = [c.split()[0] for c in PLACES.split(", ")]
    return pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})


def _mix(h: np.ndarray, salt: int) -> np.ndarray:
    """64 well mixed bits of a hash and a salt."""
    with np.errstate(over="ignore"):
        z = h + np.uint64(salt) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def perfect_hash(hashes: np.ndarray) -> np.ndarray:
    """Displacements that send ``n`` different 64-bit hashes to the slots 0 to n - 1, each to its own."""
    n = len(hashes)
    group_of = (_mix(hashes, 1) % np.uint64(_groups(n))).astype(np.int64)
    order = np.argsort(group_of, kind="stable")
    sizes = np.bincount(group_of, minlength=_groups(n))
    ends = np.cumsum(sizes)
    free, out = np.ones(n, bool), np.zeros(_groups(n), np.uint32)
    for g in np.argsort(-sizes, kind="stable").tolist():
        if not sizes[g]:
            break
        members, base = hashes[order[ends[g] - sizes[g] : ends[g]]], 0
        while True:
            tries = np.arange(base, base + 256, dtype=np.uint64)
            slots = _slots(members[None, :], tries[:, None], n)
            good = free[slots].all(axis=1)
            if sizes[g] > 1:
                ranked = np.sort(slots, axis=1)
                good &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
            if good.any():
                at = int(good.argmax())
                free[slots[at]] = False
                out[g] = base + at
                break
            base += 256
    return out


def _groups(n: int) -> int:
    return n // 4 + 1


def _slots(hashes: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (_mix(hashes + displacement * np.uint64(0xD6E8FEB86659FD93), 2) % np.uint64(n)).astype(np.int64)


def slots_of(hashes: np.ndarray, displacements: np.ndarray, n: int) -> np.ndarray:
    """The slot of each hash: one displacement read, one computation."""
    group = (_mix(hashes, 1) % np.uint64(_groups(n))).astype(np.int64)
    return _slots(hashes, displacements[group].astype(np.uint64), n)


def build_index(places: DataFrame) -> DataFrame:
    """One row per bucket: ``bucket, buckets, n_keys, displacements, fingerprints, shards, offsets``."""

    def bucket_row(rows: pd.DataFrame) -> pd.DataFrame:
        hashes = rows["h"].to_numpy(np.int64).view(np.uint64)
        moved = perfect_hash(hashes)
        order = np.argsort(slots_of(hashes, moved, len(rows)))
        return pd.DataFrame(
            {
                "bucket": [rows["bucket"].iloc[0]],
                "buckets": [rows["buckets"].iloc[0]],
                "n_keys": [len(rows)],
                "displacements": [moved.astype("<u4").tobytes()],
                "fingerprints": [rows["mark"].to_numpy("<i4")[order].tobytes()],
                "shards": [rows["shard"].to_numpy("<i8")[order].tobytes()],
                "offsets": [rows["offset"].to_numpy("<i8")[order].tobytes()],
            }
        )

    keys = places.where("flags = 0")
    buckets = max(1, -(-keys.count() // PER_BUCKET))
    return (
        keys.select(*_hashed("doc_id", buckets), F.lit(buckets).cast("long").alias("buckets"), "shard", "offset")
        .groupBy("bucket")
        .applyInPandas(
            bucket_row,
            "bucket long, buckets long, n_keys long, displacements binary, fingerprints binary, shards binary, offsets binary",
        )
    )


def _hashed(key: str, buckets: int) -> list:
    h = F.xxhash64(F.col(key).cast("long"))
    return [F.pmod(h, F.lit(buckets)).cast("long").alias("bucket"), h.alias("h"), F.hash(F.col(key).cast("long")).alias("mark")]


def lookup(index: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """``doc_id, shard, offset`` of the keys that were written; others, null ones and repeats give no row."""

    def find(keys: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if keys.empty or rows.empty:
            return pd.DataFrame({"doc_id": [], "shard": [], "offset": []}).astype("int64")
        row = rows.iloc[0]
        slots = slots_of(
            keys["h"].to_numpy(np.int64).view(np.uint64), np.frombuffer(row["displacements"], "<u4"), int(row["n_keys"])
        )
        known = np.frombuffer(row["fingerprints"], "<i4")[slots] == keys["mark"].to_numpy(np.int32)
        return pd.DataFrame(
            {
                "doc_id": keys["doc_id"].to_numpy()[known],
                "shard": np.frombuffer(row["shards"], "<i8")[slots][known],
                "offset": np.frombuffer(row["offsets"], "<i8")[slots][known],
            }
        )

    first = index.select("buckets").first()
    buckets = first["buckets"] if first else 1
    asked = keys.select(F.col(key).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    return (
        asked.select("doc_id", *_hashed("doc_id", buckets))
        .groupBy("bucket")
        .cogroup(index.groupBy("bucket"))
        .applyInPandas(find, "doc_id long, shard long, offset long")
    )


def read_ids(spark: SparkSession, path: str, index: DataFrame, keys: DataFrame, width: str = "<u2") -> DataFrame:
    """``doc_id, ids`` (end id included) of the given keys, by index and offset; meant for a list of keys, not for scans.

    Each shard that holds an asked key is read once; its offsets travel as one row per shard,
    which is bounded by the shard's size.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content, asked in zip(batch["content"], batch["asked"], strict=True):
                rows = []
                for one in asked:
                    n = struct.unpack_from(HEADER, content, one["offset"])[2]
                    start = one["offset"] + HEADER_SIZE
                    rows.append((one["doc_id"], np.frombuffer(content, width, n, start).tolist()))
                yield pd.DataFrame(rows, columns=["doc_id", "ids"])

    asked = lookup(index, keys).groupBy("shard").agg(F.collect_list(F.struct("doc_id", "offset")).alias("asked"))
    return asked.join(_shard_files(spark, path), "shard").select("content", "asked").mapInPandas(
        cut, "doc_id long, ids array<int>"
    )


def token_output(spark: SparkSession, docs: DataFrame, tokenizer_file: str, end_id: int = 2) -> DataFrame:
    """Write shards and index, then find each document through the index and read it back.

    ``doc_id, start, n_tokens, ids_crc32``: ``start`` counts the ids of all documents before it,
    ``ids_crc32`` covers its ids as little-endian 32-bit integers. The shards' totals, one
    number per shard, are all that the global order needs.
    """
    path = scratch_dir(spark, "tokens") + "/shards"
    write_shards(docs, path, tokenizer_file, end_id)
    places = stored(spark, scan_shards(spark, path), "places")
    index = stored(spark, build_index(places), "index")
    by_shard = Window.orderBy("shard")
    totals = (
        places.groupBy("shard")
        .agg(F.sum("n_tokens").alias("ids"))
        .select("shard", (F.sum("ids").over(by_shard) - F.col("ids")).alias("ids_before"))
    )
    by_key = lookup(index, docs).select("shard", "offset", F.col("doc_id").alias("found_id"))
    found = places.where("flags = 0").join(by_key, ["shard", "offset"]).withColumn("doc_id", F.col("found_id")).drop("found_id")
    rows = found.unionByName(places.where("flags > 0").select(found.columns))
    return rows.join(totals, "shard").select(
        "doc_id", (F.col("ids_before") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_output(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {"op9_token_output": op9_token_output}
ORACLES: dict[str, str] = {}
