"""Exact token counts of every prefix of every text.

For merge-based pieces, the encoding of a prefix is the encoding of a shorter prefix plus
one last piece, and that piece is the one that may stand beside the piece before it. So
one pass over a text finds the last piece, and with it the exact count, of every prefix.
No piece of the vocabulary holds a blank behind another sign, so a text falls into units
(blanks, then what follows up to the next blank) that are counted alone; a worker
remembers the units it has met. The count of a text is the sum of its units, with no
second encoding.

The stored form is one signed byte per code point: how the count changes when the
text grows by that code point. Its running sum is the count of each prefix, so a table of it answers
any budget later (``fitting_prefixes``).

Defined results: a null text counts as empty and has no tokens; rows are kept one for one,
repeated ones and those without ``doc_id`` included; texts are taken whole; an empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import collections
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.llm.common import process_memory, stored, table, text_of

BLANK = "▁"
#: Units that a worker remembers, the first met; later ones are counted again in every chunk that has them, which only takes time.
REMEMBERED = 500_000
#: Characters of text that are split into units at once, and of the texts whose units are counted together.
CHUNK, GATHERED = 4 << 20, 32 << 20
#: Units counted in step with each other.
BLOCK = 100_000
#: Signs at which a unit may be cut, if no piece lies across.
ENDS = frozenset(".,;:!?\n\t")
UNSET, BYTES = -1, -2
NO_PAIRS = (np.array([-1], np.int64), np.array([0], np.int8))
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


class PrefixCounter:
    """Counts tokens of all prefixes under a piece model without normalisation, as the library would."""

    def __init__(self, model_file: str):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.score = {
            pieces.id_to_piece(i): pieces.get_score(i)
            for i in range(pieces.get_piece_size())
            if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i) or pieces.is_unused(i))
        }
        self.pieces = list(self.score)
        self.longest = max(map(len, self.pieces))
        self.inside = {piece[i : i + 2] for piece in self.pieces for i in range(len(piece) - 1)}
        if any(pair[1] == BLANK != pair[0] for pair in self.inside):
            raise ValueError("a piece holds a blank behind another sign; units can't be counted alone")
        self.alone = np.array([self.encode(piece) == [piece] for piece in self.pieces])
        self.units: dict[str, bytes] = {}
        # Pieces by hash, and a table of bits that most substrings without a piece fail.
        hashes = np.array([self._hash(piece) for piece in self.pieces], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.hash_ids = hashes[order], order
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[hashes >> np.uint64(44)] = True
        # Pairs of pieces whose answer is known, by sorted key; the newest apart, so that few are moved.
        self.pairs = self.recent = NO_PAIRS

    def encode(self, unit: str) -> list[str]:
        """Pieces of a short text by the merges themselves: the best score first, then the leftmost."""
        parts, score = list(unit), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _hash(self, text: str) -> np.uint64:
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        return _running(codes)[0][-1]

    def _fits(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether each pair of pieces may stand side by side; every new pair is encoded once."""
        keys = before.astype(np.int64) * len(self.pieces) + after
        fits = self._known(self.pairs, keys) | self._known(self.recent, keys)
        new = np.unique(keys[fits == 0])
        if len(new):
            pieces, n = self.pieces, len(self.pieces)
            answers = [1 + (self.encode(pieces[k // n] + pieces[k % n]) == [pieces[k // n], pieces[k % n]]) for k in new.tolist()]
            self.recent = _merged(self.recent, (new, np.array(answers, np.int8)))
            if len(self.recent[0]) > 8192:
                # Pairs are at most a few per piece and text; a vast table starts again.
                self.pairs = _merged(self.pairs, self.recent) if len(self.pairs[0]) < 4 * REMEMBERED else self.recent
                self.recent = NO_PAIRS
                return self._fits(before, after)
            fits |= self._known(self.recent, keys)
        return fits == 2

    @staticmethod
    def _known(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
        """Of each pair: 0 not in the table, 1 it does not fit, 2 it does."""
        at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
        return np.where(table[0][at] == keys, table[1][at], 0).astype(np.int8)

    def steps(self, units: list[str]) -> list[bytes]:
        """By how much the count grows with each code point, for all units in step with each other."""
        codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        starts = np.cumsum(lengths) - lengths
        place = np.arange(len(codes)) - np.repeat(starts, lengths)
        sums, powers = _running(codes)
        sums = np.concatenate((np.zeros(1, np.uint64), sums))
        by_place = np.argsort(place.astype(np.uint16) if lengths.max() < 1 << 16 else place, kind="stable")
        edges = np.searchsorted(place[by_place], np.arange(int(lengths.max()) + 1))
        found = []  # per length of piece: where pieces end, in order of their place, and which they are
        for size in range(1, self.longest + 1):
            ends = by_place[edges[size - 1] if size - 1 < len(edges) else len(codes) :]
            first = ends - (size - 1)
            h = (sums[ends + 1] - sums[first]) * powers[first]
            ends, h = ends[(m := self.maybe[h >> np.uint64(44)])], h[m]
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            real = self.hashes[at] == h
            ends = ends[real]
            found.append((ends, self.hash_ids[at[real]], np.searchsorted(place[ends], np.arange(len(edges) + 1))))
        last = np.full(len(codes), UNSET, np.int64)
        count = np.zeros(len(codes), np.int64)
        for p in range(len(edges) - 1):
            for size in range(min(self.longest, p + 1), 0, -1):
                ends, ids, cuts = found[size - 1]
                ends, ids = ends[cuts[p] : cuts[p + 1]], ids[cuts[p] : cuts[p + 1]]
                if not len(ends):
                    continue
                todo = last[ends] == UNSET
                ends, ids = ends[todo], ids[todo]
                fits = self.alone[ids]
                if size <= p:
                    before = last[ends - size]
                    pair = fits & (before >= 0)
                    fits[pair] = self._fits(before[pair], ids[pair])
                ends, ids = ends[fits], ids[fits]
                last[ends] = ids
                count[ends] = 1 + (count[ends - size] if size <= p else 0)
            here = by_place[edges[p] : edges[p + 1]]
            here = here[last[here] == UNSET]
            if len(here):  # signs without a piece: their bytes are the tokens
                c = codes[here]
                last[here] = BYTES
                count[here] = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF) + (count[here - 1] if p else 0)
        step = np.diff(count, prepend=0)
        step[starts] = count[starts]
        raw = step.astype(np.int8).tobytes()
        return [raw[a : a + n] for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)]

    def _parts(self, unit: str) -> list[str]:
        """The unit, cut where no piece can lie across."""
        out, begin, anywhere = [], 0, len(unit) > 64
        for i in range(1, len(unit)):
            if (anywhere or unit[i] in ENDS or unit[i - 1] in ENDS) and unit[i - 1 : i + 1] not in self.inside:
                out.append(unit[begin:i])
                begin = i
        return [*out, unit[begin:]]

    def texts_steps(self, texts: list[str]) -> Iterator[bytes]:
        """For each text, one signed byte per code point; the units of ``CHUNK`` characters are held at once."""
        at = 0
        while at < len(texts):
            some, size = [], 0
            while at < len(texts) and (not some or size + len(texts[at]) <= CHUNK):
                some.append(texts[at])
                size += len(texts[at])
                at += 1
            yield from self._texts_steps(some)

    def _texts_steps(self, texts: list[str]) -> list[bytes]:
        all_units = [_units(text) for text in texts]
        known = self.units
        new = set().union(*all_units).difference(known)
        if new:
            parted = {u: self._parts(u) for u in new}
            parts = sorted({p for ps in parted.values() for p in ps if p not in known}, key=len)
            fresh = {}
            for i in range(0, len(parts), BLOCK):
                fresh.update(zip(block := parts[i : i + BLOCK], self.steps(block), strict=True))
            for u, ps in parted.items():
                if len(ps) > 1:
                    fresh[u] = b"".join([fresh[p] if p in fresh else known[p] for p in ps])
            if len(known) + len(fresh) <= REMEMBERED:
                known.update(fresh)
            else:  # the first met are the frequent ones: they stay
                known = collections.ChainMap(fresh, known)
                known = {u: known[u] for units in all_units for u in units}
        out = []
        for units in all_units:
            joined = b"".join(map(known.__getitem__, units))
            # The blank put before the text is no code point of it: its step falls to the first that is.
            out.append(bytes(((joined[0] + joined[1]) & 255,)) + joined[2:] if units else b"")
        return out


def _merged(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, values = np.concatenate((one[0], two[0])), np.concatenate((one[1], two[1]))
    order = np.argsort(keys, kind="stable")
    return keys[order], values[order]


def _running(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the codes times falling powers of a base modulo 2**64, and the powers that undo a start."""
    up, down = np.full(len(codes), BASE, np.uint64), np.full(len(codes), BASE_INVERSE, np.uint64)
    if len(codes):
        up[0] = down[0] = 1
    return np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * np.cumprod(down)), np.cumprod(up)


def _units(text: str) -> list[str]:
    """Blanks and what follows them, with the one blank that the library puts before a text."""
    if not text:
        return []
    units, run = [], BLANK
    for part in text.replace(BLANK, " ").split(" "):
        if part:
            units.append(run + part)
            run = BLANK
        else:
            run += BLANK
    return units + [run[:-1]] if len(run) > 1 else units


def counts_of(steps: bytes) -> np.ndarray:
    """Token counts of all prefixes, from the empty one to the whole text."""
    return np.concatenate(([0], np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)))


def fitting_prefix(steps: bytes, budget: int) -> int:
    """Code points of the longest prefix with at most ``budget`` tokens."""
    fits = np.nonzero(counts_of(steps) <= budget)[0]
    return int(fits[-1]) if len(fits) else 0


def _counter(model_file: str) -> PrefixCounter:
    held = process_memory("prefix counters")
    if model_file not in held:
        held[model_file] = PrefixCounter(model_file)
    return held[model_file]


def _gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows in frames of about ``GATHERED`` bytes: what many texts share is counted once for all of them."""
    some, size = [], 0
    for batch in batches:
        own = int(batch["n_bytes"].sum())
        if some and size + own > GATHERED:
            yield pd.concat(some, ignore_index=True)
            some, size = [], 0
        some.append(batch)
        size += own
    if some:
        yield pd.concat(some, ignore_index=True)


def prefix_counts(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, fit_chars, prefix_steps`` of every row.

    ``fit_chars`` is the length of the longest prefix within ``limit``; ``prefix_steps``
    answers any other limit (``fitting_prefix``) and any prefix (``counts_of``).
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _counter(model_file)
        for batch in _gathered(batches):
            steps = list(counter.texts_steps(batch["text"].tolist()))
            tokens = [int(np.frombuffer(s, np.int8).sum(dtype=np.int64)) for s in steps]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "n_bytes": batch["n_bytes"],
                    "n_tokens": tokens,
                    "over_limit": [n > limit for n in tokens],
                    "fit_chars": [len(s) if n <= limit else fitting_prefix(s, limit) for s, n in zip(steps, tokens, strict=True)],
                    "prefix_steps": steps,
                }
            )

    texts = docs.select("doc_id", text_of().alias("text"), F.octet_length(text_of()).cast("long").alias("n_bytes"))
    kind = dict(texts.dtypes)["doc_id"]
    return texts.mapInPandas(
        count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long, prefix_steps binary"
    )


def fitting_prefixes(counted: DataFrame, budgets: Sequence[int]) -> DataFrame:
    """``counted`` with ``fits``: for each budget, the code points of the longest prefix within it. From ``prefix_steps``
    alone, so a stored table answers any budget without its texts or the tokenizer."""

    @F.pandas_udf("array<long>")
    def fits(steps: pd.Series, n_tokens: pd.Series) -> pd.Series:
        return pd.Series(
            [[len(s) if n <= b else fitting_prefix(s, b) for b in budgets] for s, n in zip(steps, n_tokens, strict=True)], dtype=object
        )

    return counted.withColumn("fits", fits("prefix_steps", "n_tokens"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = prefix_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    kept = stored(spark, counted, "prefixes", compression="zstd")
    return fitting_prefixes(kept, (512, 1024)).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars", F.col("fits")[0].alias("fit_chars_512"), F.col("fits")[1].alias("fit_chars_1024")
    )


QUERIES = {"op1_token_counts": op1_token_counts}
ORACLES: dict[str, str] = {}
