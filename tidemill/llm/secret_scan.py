"""Secrets in texts: three stated patterns, and random strings by token efficiency.

A byte-pair vocabulary packs what people write into few tokens and random strings into many. A run of key
characters with few characters per token is therefore taken for a secret, unless it is a known
digest (hexadecimal of a hash's length), a UUID, a number, or an identifier built of words. Added spans never
overlap spans of the stated patterns, and those always stay; what they leave of a run is tested as a run.

A run that is no secret as a whole is tested again between its words, then piece by piece between ``/ _ -``, so a
key behind a wordy path or name is found. Letters alone are also held against the letter pairs of the
vocabulary's own tokens: words follow them, random letters do not.

Defined results: a null text counts as empty and has no spans; spans are code points of the whole text, end
exclusive, ordered by start and then by kind; every row gives one row, repeated ones and those
without ``doc_id`` included; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.llm.common import process_memory, table, text_of

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
#: A text without one of these has no assignment.
HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A run is matched from its start and to its end, so shorter runs can be left out at once.
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
#: Hexadecimal digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_LENGTHS = frozenset((32, 40, 56, 64, 96, 128))
WORDY = re.compile(r"(?:[A-Z]?[a-z]{2,}|[A-Z]{2,}|[0-9]{1,4}|[/_-]+)+\Z")
#: At most so many characters a token; letters alone need a lower ratio, as rare words come close.
RANDOM_RATIO, LETTERS_RATIO = 1.9, 1.5
#: Letters alone above that ratio: at most so many characters a token, and bits a letter pair gains over even chance.
PAIRS_RATIO, PAIRS_GAIN = 2.6, 0.0
LEAST = 20
SEPARATORS = re.compile(r"[/_-]+")
EMBEDDED_UUID = re.compile(rf"(?<![0-9A-Za-z]){UUID.pattern}(?![0-9A-Za-z])")


class Scanner:
    def __init__(self, ranks_file: str, pattern: str):
        import tiktoken

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.gains = _pair_gains(ranks)

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        found = []
        low = text.lower()
        if any(h in low for h in HINTS):
            found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        if "AKIA" in text:
            found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
        taken = Taken([(s, e) for _, s, e in found])
        for m in RUN.finditer(text):
            for start, end in taken.left_of(*m.span()):
                found += [("random", a, b) for a, b in self.random_parts(text, start, end)]
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))

    def random_parts(self, text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
        """The run if it looks random, or its stretches between words that do, or their pieces."""
        if self.looks_random(text[start:end]):
            yield start, end
            return
        for low, high in self._between_words(text, start, end):
            if (low, high) != (start, end) and self.looks_random(text[low:high]):
                yield low, high
                continue
            for a, b in _pieces(text, low, high):
                if b - a >= LEAST and (a, b) != (low, high) and self.looks_random(text[a:b]):
                    yield a, b

    def _between_words(self, text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
        uuids = Taken([m.span() for m in EMBEDDED_UUID.finditer(text, start, end)])
        for low, high in uuids.left_of(start, end):
            first = last = None
            for a, b in _pieces(text, low, high):
                if self._is_word(text[a:b]):
                    if first is not None and last - first >= LEAST:
                        yield first, last
                    first = None
                else:
                    first, last = a if first is None else first, b
            if first is not None and last - first >= LEAST:
                yield first, last

    def _is_word(self, piece: str) -> bool:
        """Four letters or more, cased as words are, with the letter pairs of words."""
        if len(piece) < 4 or not piece.isalpha() or not WORDY.match(piece):
            return False
        return self.pair_gain(piece) > PAIRS_GAIN

    def pair_gain(self, letters: str) -> float:
        low = letters.lower()
        return sum(self.gains.get(low[i : i + 2], 0.0) for i in range(len(low) - 1)) / max(1, len(low) - 1)

    def looks_random(self, run: str) -> bool:
        body = run.rstrip("=")
        if body.isdigit() or UUID.fullmatch(body) or (len(body) in DIGEST_LENGTHS and DIGEST.match(body)):
            return False
        letters = body.isalpha()
        if not letters and not any(c.isdigit() for c in body) and WORDY.match(body):
            return False
        ratio = len(run) / len(self.encoding.encode_ordinary(run))
        if letters:
            return ratio <= LETTERS_RATIO or (ratio <= PAIRS_RATIO and self.pair_gain(body) <= PAIRS_GAIN)
        return ratio <= RANDOM_RATIO and not (ratio > LETTERS_RATIO and WORDY.match(body))


class Taken:
    """Spans that are taken, merged, and found by bisection: a run meets only those that overlap it."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.begins: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.begins.append(start)
                self.ends.append(end)

    def left_of(self, start: int, end: int) -> Iterator[tuple[int, int]]:
        """What the spans leave of a run; all of it if none overlaps, else what is long enough."""
        i = bisect_right(self.ends, start)
        while i < len(self.begins) and self.begins[i] < end:
            if self.begins[i] - start >= LEAST:
                yield start, self.begins[i]
            start = max(start, self.ends[i])
            i += 1
        if end - start >= LEAST:
            yield start, end


def _pieces(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """The non-empty pieces between separators."""
    for m in SEPARATORS.finditer(text, start, end):
        if m.start() > start:
            yield start, m.start()
        start = m.end()
    if start < end:
        yield start, end


def _pair_gains(ranks: dict[bytes, int]) -> dict[str, float]:
    """Bits that each letter pair of the vocabulary's tokens has over even chance of the second letter."""
    pairs = Counter()
    for token in ranks:
        letters = token.strip().lower()
        if len(letters) > 2 and letters.isalpha():
            word = letters.decode("ascii")
            pairs.update(map("".join, zip(word, word[1:], strict=False)))
    letters = "abcdefghijklmnopqrstuvwxyz"
    return {
        a + b: math.log2(26 * (pairs[a + b] + 1) / (sum(pairs[a + c] for c in letters) + 26)) for a in letters for b in letters
    }


def _scanner(ranks_file: str, pattern: str) -> Scanner:
    held = process_memory("secret scanners")
    if ranks_file not in held:
        held[ranks_file] = Scanner(ranks_file, pattern)
    return held[ranks_file]


def find_secrets(docs: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """``doc_id, spans`` of every row; a span has ``kind, start, end``."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = _scanner(ranks_file, pattern)
        for batch in batches:
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in scanner.spans(t)] for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "spans": spans})

    texts = docs.select("doc_id", text_of().alias("text"))
    kind = dict(texts.dtypes)["doc_id"]
    return texts.mapInPandas(scan, f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long>>")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = find_secrets(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    of_kind = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return found.select(
        "doc_id",
        of_kind("assign").alias("n_assign"),
        of_kind("access").alias("n_access"),
        of_kind("hex").alias("n_hex"),
        F.sha2(listed(F.filter("spans", lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        of_kind("random").alias("n_random"),
    )


QUERIES = {"op5_secret_scan": op5_secret_scan}
ORACLES: dict[str, str] = {}
