"""Words of whole texts as numbers, many texts at once: hashes of words and of stretches of words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

#: Bytes of text that are hashed at once.
CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(BASE, -1, 1 << 64)
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """64 well mixed bits."""
    with np.errstate(over="ignore"):
        z = h + np.uint64(salt * BASE % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(a * np.uint64(BASE) + b)


def span_hashes(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of bytes: equal bytes, equal hash, wherever they lie."""
    up, down = np.full(len(codes), BASE, np.uint64), np.full(len(codes), _BASE_INVERSE, np.uint64)
    up[:1] = down[:1] = 1
    up, down = np.cumprod(up), np.cumprod(down)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * down)))
    return mixed((sums[ends] - sums[begins]) * up[begins] + (ends - begins).astype(np.uint64))


def _hashes(text: bytes) -> np.ndarray:
    """One hash per word of a text."""
    codes = np.frombuffer(text + b"\n", np.uint8)
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    edges = np.flatnonzero(np.diff(blank, prepend=True))  # where words begin and end, in turn
    return span_hashes(codes, edges[::2], edges[1::2])


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of about ``CHUNK`` bytes that end at blanks."""
    at = 0
    while len(text) - at > CHUNK:
        blank = _BLANK.search(text, at + CHUNK)
        if not blank:
            break
        yield text[at : blank.start()]
        at = blank.end()
    yield text[at:]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words' hashes, text after text, and how many words each text has."""
    found, counts, some, size = [], [], [], 0

    def flush() -> None:
        if some:
            found.append(_hashes(b"\n".join(some)))
            some.clear()

    for text in texts:
        counts.append(len(text.split()))
        if size + len(text) > CHUNK:
            flush()
            size = 0
        if len(text) > CHUNK:
            found.extend(_hashes(piece) for piece in _pieces(text))
        elif text:
            some.append(text)
            size += len(text)
    flush()
    return np.concatenate([np.zeros(0, np.uint64), *found]), np.array(counts, np.int64)


def prefix_hashes(words: np.ndarray, width: int) -> dict[int, np.ndarray]:
    """For every place with ``width`` words from it on: hashes of its first 1, 2, 4, ... and ``width`` words."""
    n = len(words) - width + 1
    if n <= 0:
        return {}
    levels, k = {1: words}, 1
    while 2 * k <= width:
        levels[2 * k] = _joined(levels[k][:-k], levels[k][k:])
        k *= 2
    whole, at = levels[k][:n], k
    while at < width:
        while at + k > width:
            k //= 2
        whole = _joined(whole, levels[k][at : at + n])
        at += k
    return {size: h[:n] for size, h in levels.items()} | {width: whole}
