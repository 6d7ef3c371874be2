"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit verification.

The CGK embedding walks over a string; at step ``j`` it writes the current character and moves on or stays by a
random bit of ``(j, character)``. Two strings at a small edit distance are written in step again soon after each
edit, so their outputs have a small Hamming distance, and a few sampled positions of the output
agree with good chance. Each repetition has its own random bits and its own sample of positions.

Every word of an item begins a window over the rest of the item, and every word of a document one over the text
that follows. Where ``UNBROKEN`` characters have had no blank, as in Chinese or long addresses, every
further character of a document begins one, and every ``ITEM_STEP``-th of an item. Windows that agree in all samples of a repetition are candidates; the item's place in the document
follows from the two offsets, and the item-sized stretch there is compared by exact edit
distance, unless it has fewer of the item's four-letter pieces than the allowed edits must leave. Samples are taken in the order of the walk, and a document window is given up at the first
sample that no item window has, so most cost a few steps.

An item with up to ``max_edits`` of its length in edits has stretches without an edit, and many windows that
begin in them. Repetitions are added until ``TARGET_RECALL`` of some items' copies, edited as far as allowed, are proposed; the tests
measure the recall on edited and exact copies. A window that many items share, such as a common opening, would propose all of
them; items with enough other windows go without it. Items shorter than ``SPAN`` characters
are cut in one piece more than the edits allowed: a copy holds one of the pieces unchanged, so every copy within
``max_edits`` is found by the pieces and the same exact edit distance. Such a copy runs from word end to word end;
scripts without blanks have an end everywhere. Items too short for an edit (below 10 characters at 0.1) are
searched for as they are.

Items are the query set: they travel to the tasks in blocks of ``BLOCK_CHARS`` characters at most
(or of one item), each block against all documents.

Defined results: letters count without case, any white space as a blank. Null and empty texts and items
match nothing, nor do items of blanks. Texts are searched whole. Repeated documents and items give rows of their own.
Several places of an item in a document give one row, with the best. An empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.llm.common import process_memory, stored, table, text_of

#: Share of copies at the edit limit that the repetitions together must propose; tried out on ``TRIED`` items, up to ``MOST_REPEATS``.
TARGET_RECALL, TRIED, MOST_REPEATS = 0.99, 200, 16
SPAN = 48
#: Windows that more items share are left out of items that have ``LEAST_RARE`` others.
SHARED, LEAST_RARE = 8, 6
#: Sampled positions of a walk: some early ones, which part most windows, and some in the rest.
EARLY, LATE = 6, 10
EARLY_STEPS = 12
FILTER_BITS = 18
#: Characters without a blank after which windows begin inside, and the step of these in items.
UNBROKEN, ITEM_STEP = 12, 2
BLOCK_CHARS = 8 << 20
#: Letters by which the pieces of short items are looked up; shorter pieces are searched one by one.
PIECE = 5
#: Word starts that walk together, and characters of text held as an array.
WALKERS, CHUNK = 1 << 16, 1 << 20
SPACE = re.compile(r"\s")
#: A sign of a word in a script that puts blanks between words: not Thai to Khmer, nor Chinese and Japanese.
SPACED = "[^\\W\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]"
IN_WORD = re.compile(SPACED)
BASE = np.uint64(0x9E3779B97F4A7C15)
LEAKS = "item_id long, edits int, item_chars int, start long, end long"


def normal(text: str) -> str:
    """Lower case and plain blanks, character by character, so that places stay."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    return SPACE.sub(" ", low)


def distances(pattern: str, text: str, free_start: bool) -> list[int]:
    """Edit distance of ``pattern`` to the best string that ends at each place of ``text`` (from its begin if not free)."""
    m = len(pattern)
    mask, high = (1 << m) - 1, 1 << (m - 1)
    at: dict[str, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    pv, mv, score, out = mask, 0, m, [m]
    for c in text:
        eq = at.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & mask)
        mh = pv & xh
        score += bool(ph & high) - bool(mh & high)
        ph = ph << 1 | (not free_start)
        pv = (mh << 1 | ~(xv | ph)) & mask
        mv = ph & xv & mask
        out.append(score)
    return out


def nearest(item: str, text: str, limit: int) -> tuple[int, int, int] | None:
    """Edits, start and end of the stretch of ``text`` nearest to ``item``, if within ``limit``."""
    found = distances(item, text, True)
    best = min(found)
    if best > limit:
        return None
    end = found.index(best)
    back = distances(item[::-1], text[:end][::-1], False)
    return best, end - back.index(best), end


class Items:
    """Benchmark items with the sampled embeddings of their windows."""

    def __init__(self, items: list[tuple[int | None, str]], max_edits: float, target_recall: float = TARGET_RECALL, seed: int = 7):
        self.ids = [i for i, _ in items]
        self.texts = [normal(t).strip() for _, t in items]
        self.limits = [int(max_edits * len(t)) for t in self.texts]
        self.grams = [_grams(_codes(t)) for t in self.texts]
        rng = np.random.default_rng(seed)
        self.moves = rng.integers(0, 2, (MOST_REPEATS, SPAN, 256), np.uint8)
        self.samples = [
            sorted(
                rng.choice(EARLY_STEPS, EARLY, replace=False).tolist()
                + (EARLY_STEPS + rng.choice(SPAN - EARLY_STEPS, LATE, replace=False)).tolist()
            )
            for _ in range(MOST_REPEATS)
        ]
        long = [i for i, t in enumerate(self.texts) if len(t) >= SPAN]
        self.short = [i for i, t in enumerate(self.texts) if 0 < len(t) < SPAN]
        self._index_pieces()
        self.windows = []  # per repetition: sorted keys, item, offset, and a bit table per sample from the last early one on
        if not long:
            return
        windows = _laid_out([_codes(self.texts[i]) for i in long], ITEM_STEP)
        copies = self._edited_copies(rng, long)
        met = np.zeros(len(copies), bool)
        while len(self.windows) < MOST_REPEATS and (not self.windows or met.mean() < target_recall):
            self.windows.append(self._indexed(len(self.windows), np.array(long), *windows))
            met |= [len(self._found(self.windows[-1], len(self.windows) - 1, i, copy)) > 0 for i, copy in copies]

    def _indexed(self, r: int, long: np.ndarray, codes: np.ndarray, at: np.ndarray, own: np.ndarray, off: np.ndarray, room: np.ndarray) -> tuple:
        """The windows of one repetition. Those that many items share propose all of these wherever one
        of them is, so an item with enough others goes without."""
        keys, used = self._walk(r, codes, at)
        inside = used <= room  # the walk did not leave the item
        last, own, off = keys[-1][inside], own[inside], off[inside]
        _, group = np.unique(last, return_inverse=True)
        pairs = np.unique(np.stack((group, own), axis=1), axis=0)
        rare = np.bincount(pairs[:, 0], minlength=group.max(initial=-1) + 1)[group] <= SHARED
        keep = rare | (np.bincount(own[rare], minlength=len(long))[own] < LEAST_RARE)
        tables = [_bits(k[inside][keep]) for k in keys[EARLY - 1 :]]
        order = np.argsort(last[keep], kind="stable")
        return last[keep][order], long[own[keep][order]], off[keep][order], tables

    def _edited_copies(self, rng: np.random.Generator, long: list[int]) -> list[tuple[int, np.ndarray]]:
        """Some items, each with as many edits as are allowed, as codes."""
        out = []
        for i in rng.permutation(long)[:TRIED].tolist():
            copy = _codes(self.texts[i]).tolist()
            for _ in range(self.limits[i]):
                at, kind, letter = rng.integers(len(copy)), rng.integers(3), int(rng.integers(97, 123))
                copy[at : at + (kind != 1)] = [] if kind == 0 else [letter]
            out.append((i, np.array(copy, np.uint8)))
        return out

    def _found(self, windows: tuple, r: int, i: int, copy: np.ndarray) -> np.ndarray:
        """Windows of a copy that agree with one of the item's."""
        codes, at, *_ = _laid_out([copy], 1)
        keys, _ = self._walk(r, codes, at)
        return np.intersect1d(keys[-1], windows[0][windows[1] == i])

    def _index_pieces(self) -> None:
        """Pieces of the short items by their first letters, and patterns of those that are too short for an edit."""
        self.whole, found = [], []
        for i in self.short:
            item, parts = self.texts[i], self.limits[i] + 1
            cuts = [len(item) * p // parts for p in range(parts + 1)]
            if parts == 1:
                before = rf"(?<!{SPACED})" if IN_WORD.match(item[0]) else ""
                after = rf"(?!{SPACED})" if IN_WORD.match(item[-1]) else ""
                self.whole.append((i, re.compile(before + re.escape(item) + after)))
            else:
                found += [(i, a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        self.tiny = [f for f in found if len(f[2]) < PIECE]
        found = [f for f in found if len(f[2]) >= PIECE]
        keys = np.concatenate([_piece_keys(_codes(p))[:1] for _, _, p in found] + [np.empty(0, np.uint64)])
        order = np.argsort(keys, kind="stable")
        self.pieces, self.piece_keys, self.piece_bits = [found[o] for o in order], keys[order], _bits(keys)

    def _short_leaks(self, text: str, codes: np.ndarray) -> dict[int, tuple]:
        """Edits, start and end of the best copy of each short item."""
        best: dict[int, tuple] = {}
        for i, pattern in self.whole:
            if m := pattern.search(text):
                best[i] = (0, *m.span())
        tried = set()
        for i, begin in self._piece_hits(text, codes):
            if (i, begin) in tried or best.get(i, (1,))[0] == 0:
                continue
            tried.add((i, begin))
            got = self._bounded(i, text, begin)
            if got and (i not in best or got < best[i]):
                best[i] = got
        return best

    def _piece_hits(self, text: str, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """Short items and where they would begin, for every place of one of their pieces."""
        for i, a, piece in self.tiny:
            at = text.find(piece)
            while at >= 0:
                yield i, at - a
                at = text.find(piece, at + 1)
        if not self.pieces:
            return
        keys = _piece_keys(codes)
        places = np.flatnonzero(self.piece_bits[keys >> np.uint64(64 - FILTER_BITS)])
        first, last = (np.searchsorted(self.piece_keys, keys[places], side) for side in ("left", "right"))
        some = np.flatnonzero(last > first)
        for place, low, high in zip(places[some].tolist(), first[some].tolist(), last[some].tolist(), strict=True):
            for i, a, piece in self.pieces[low:high]:
                if text.startswith(piece, place):
                    yield i, place - a

    def _bounded(self, i: int, text: str, begin: int) -> tuple[int, int, int] | None:
        """The nearest stretch from word end to word end that begins within the allowed edits of ``begin``."""
        item, limit, best = self.texts[i], self.limits[i], None
        for a in range(max(0, begin - limit), min(len(text), begin + limit + 1)):
            if _inside_word(text, a):
                continue
            for n, edits in enumerate(distances(item, text[a : a + len(item) + limit], False)):
                if n and edits <= limit and (best is None or edits < best[0]) and not _inside_word(text, a + n):
                    best = (edits, a, a + n)
        return best

    def _walk(self, r: int, codes: np.ndarray, at: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Keys after each sample, and characters used, of walks from all places."""
        place, key, keys = at.copy(), np.zeros(len(at), np.uint64), []
        for j in range(self.samples[r][-1] + 1):
            c = codes[place]
            if j in self.samples[r]:
                key = (key + c + np.uint64(1)) * BASE
                keys.append(key)
            place += self.moves[r, j][c]
        return keys, place - at

    def candidates(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows of document place, item and offset in the item, for windows that agree in all samples."""
        out = []
        for r, (known, owner, offset, tables) in enumerate(self.windows):
            alive, place, key, seen = at, at.copy(), np.zeros(len(at), np.uint64), 0
            for j in range(self.samples[r][-1] + 1):
                c = codes[place]
                if j in self.samples[r]:
                    key = (key + c + np.uint64(1)) * BASE
                    seen += 1
                    if seen >= EARLY:
                        stay = np.flatnonzero(tables[seen - EARLY][key >> np.uint64(64 - FILTER_BITS)])
                        alive, place, key, c = alive[stay], place[stay], key[stay], c[stay]
                place += self.moves[r, j][c]
            first, last = np.searchsorted(known, key, "left"), np.searchsorted(known, key, "right")
            n = last - first
            which = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out.append(np.stack((np.repeat(alive, n), owner[which], offset[which]), axis=1))
        return np.concatenate(out) if out else np.empty((0, 3), np.int64)

    def leaks(self, texts: list[str]) -> Iterator[list[tuple]]:
        """For each text, ``item_id, edits, item_chars, start, end`` of the items found in it."""
        at = 0
        while at < len(texts):
            some, size = [], 0
            while at < len(texts) and (not some or size + len(texts[at]) <= CHUNK):
                some.append(normal(texts[at]))
                size += len(some[-1])
                at += 1
            yield from self._leaks(some)

    def _leaks(self, texts: list[str]) -> Iterator[list[tuple]]:
        codes = np.concatenate([a for t in texts for a in (_codes(t), np.zeros(1, np.uint8))] + [np.zeros(SPAN + 1, np.uint8)])
        begins = np.cumsum([0] + [len(t) + 1 for t in texts])
        starts = _window_starts(codes)
        found = [self.candidates(codes, starts[i : i + WALKERS]) for i in range(0, len(starts), WALKERS)]
        hits = np.concatenate(found) if found else np.empty((0, 3), np.int64)
        text_of_hit = np.searchsorted(begins, hits[:, 0], "right") - 1
        # Where the item would begin in its text; hits on one place are one candidate.
        begin = hits[:, 0] - begins[text_of_hit] - hits[:, 2]
        once = np.unique(np.stack((text_of_hit, hits[:, 1], begin), axis=1), axis=0)
        cuts = np.searchsorted(once[:, 0], np.arange(len(texts) + 1))
        for t, text in enumerate(texts):
            best: dict[int, tuple] = {}
            for i, low, high in self._stretches(once[cuts[t] : cuts[t + 1], 1:]):
                low = max(0, low)
                if not self._may_match(i, codes[begins[t] + low : begins[t] + min(high, len(text))]):
                    continue
                got = nearest(self.texts[i], text[low:high], self.limits[i])
                if got and (i not in best or got[0] < best[i][0]):
                    best[i] = (got[0], low + got[1], low + got[2])
            if self.short:
                best |= self._short_leaks(text, codes[begins[t] : begins[t] + len(text)])
            yield [(self.ids[i], e, len(self.texts[i]), a, b) for i, (e, a, b) in sorted(best.items())]


    def _may_match(self, i: int, stretch: np.ndarray) -> bool:
        """Whether the stretch has as many of the item's four-letter pieces as the edits must leave: each edit takes four."""
        grams = self.grams[i]
        left = len(grams) - 4 * self.limits[i]
        return left <= 0 or len(stretch) >= 4 and np.count_nonzero(np.isin(grams, _grams(stretch))) >= left

    def _stretches(self, places: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Item, begin and end of the stretches to compare: candidates of an item that overlap are compared as one."""
        last = None
        for i, p in places.tolist():
            low, high = p - self.limits[i], p + len(self.texts[i]) + self.limits[i] + 1
            if last and last[0] == i and low <= last[2]:
                last = (i, last[1], high)
            else:
                if last:
                    yield last
                last = (i, low, high)
        if last:
            yield last


def _laid_out(texts: list[np.ndarray], step: int) -> tuple[np.ndarray, ...]:
    """Texts one after the other with room behind each; where their windows begin, whose they are, where in it, and the room left."""
    begins = [_window_starts(t, step) for t in texts]
    sizes = np.array([len(t) + SPAN + 1 for t in texts])
    base = np.cumsum(sizes) - sizes
    own = np.repeat(np.arange(len(texts)), [len(b) for b in begins])
    off = np.concatenate(begins)
    codes = np.concatenate([c for t in texts for c in (t, np.zeros(SPAN + 1, np.uint8))])
    return codes, off + base[own], own, off, np.array([len(t) for t in texts])[own] - off


def _inside_word(text: str, at: int) -> bool:
    return 0 < at < len(text) and bool(IN_WORD.match(text[at - 1]) and IN_WORD.match(text[at]))


def _piece_keys(codes: np.ndarray) -> np.ndarray:
    """A key of the ``PIECE`` letters from each place on."""
    keys = np.zeros(max(0, len(codes) - PIECE + 1), np.uint64)
    for j in range(PIECE):
        keys = (keys + codes[j : j + len(keys)] + np.uint64(1)) * BASE
    return keys


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint8)


def _grams(codes: np.ndarray) -> np.ndarray:
    """The four-letter pieces, each as a number."""
    c = codes.astype(np.uint32)
    return c[:-3] << 24 | c[1:-2] << 16 | c[2:-1] << 8 | c[3:] if len(c) >= 4 else c[:0]


def _window_starts(codes: np.ndarray, step: int = 1) -> np.ndarray:
    """Starts of words, and every ``step``-th place ``UNBROKEN`` characters or more after the last one."""
    inside = (codes != 32) & (codes != 0)
    first = inside & ~np.concatenate(([False], inside[:-1]))
    places = np.arange(len(codes))
    depth = places - np.maximum.accumulate(np.where(first, places, 0))
    return np.flatnonzero(first | inside & (depth >= UNBROKEN) & (depth % step == 0))


def _bits(keys: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << FILTER_BITS, bool)
    table[keys >> np.uint64(64 - FILTER_BITS)] = True
    return table


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of bounded size; rows without text are left out."""
    items = benchmark.select("item_id", "text").where("text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        if rows := [(r["item_id"], r["text"]) for r in own.orderBy("item_id", "text").collect()]:
            yield rows


def _items(rows: list[tuple[int | None, str]], max_edits: float) -> Items:
    held, key = process_memory("benchmark items"), hash((tuple(rows), max_edits))
    if key not in held:
        held.clear()
        held[key] = Items(rows, max_edits)
    return held[key]


def find_leaks(docs: DataFrame, benchmark: DataFrame, max_edits: float = 0.1) -> DataFrame:
    """``doc_id, item_id, edits, item_chars, start, end``: the items that documents hold, within ``max_edits`` of their length."""
    texts = docs.select("doc_id", text_of().alias("text"))
    schema = f"doc_id {dict(texts.dtypes)['doc_id']}, {LEAKS}"

    def search(rows):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            items = _items(rows, max_edits)
            for batch in batches:
                out = [
                    (doc_id, *leak)
                    for doc_id, leaks in zip(batch["doc_id"].tolist(), items.leaks(list(batch["text"])), strict=True)
                    for leak in leaks
                ]
                names = ["doc_id", *(c.split()[0] for c in LEAKS.split(", "))]
                yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64", "item_id": "Int64"})

        return run

    found = None
    for rows in item_blocks(benchmark):
        part = texts.mapInPandas(search(rows), schema)
        found = part if found is None else found.union(part)
    return texts.mapInPandas(lambda batches: iter(()), schema) if found is None else found


def _leak_flag(rows: list[tuple[int | None, str]], max_edits: float):
    @F.pandas_udf("boolean")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(leaks) for leaks in _items(rows, max_edits).leaks(list(texts))])

    return run


def is_leaked(benchmark: DataFrame, max_edits: float = 0.1, text: str = "text") -> Column:
    """Whether the text holds an item; for filters by a benchmark of one block (``without_leaks`` takes any)."""
    out = F.lit(False)
    for rows in item_blocks(benchmark):
        out = out | _leak_flag(rows, max_edits)(text_of(text))
    return out


def without_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, max_edits: float = 0.1) -> DataFrame:
    """The documents without an item, all columns. Of several blocks of items each is a pass over what the one before left."""
    blocks = list(item_blocks(benchmark))
    for n, rows in enumerate(blocks):
        docs = docs.where(~_leak_flag(rows, max_edits)(text_of()))
        if n + 1 < len(blocks):
            docs = stored(spark, docs, "unleaked")
    return docs


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op2_decontaminate": op2_decontaminate}
ORACLES: dict[str, str] = {}
