"""Hashed words and structure figures of many texts at once, as NumPy arrays over their bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

GROUP_BYTES = 1 << 20   # texts are worked on together up to this size, longer ones in pieces
STATS = ("log_bytes", "log_words", "word_bytes", "capitals", "digits", "marks", "shouts", "bars",
         "spaces", "breaks", "beyond_ascii", "distinct_words", "repeated_lines", "line_bytes")

_B = np.arange(256)
_UPPER = (_B >= 65) & (_B <= 90)
_DIGIT = (_B >= 48) & (_B <= 57)
_WORD = _UPPER | _DIGIT | ((_B >= 97) & (_B <= 122)) | (_B >= 128)
_SPACE = (_B == 32) | ((_B >= 9) & (_B <= 13))
_NO_WORD = re.compile(b"[^0-9A-Za-z\x80-\xff]")
_LOWER = np.where(_UPPER, _B + 32, _B).astype(np.uint64) + 1
_PRIME = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of each word: a polynomial in its lower-case bytes, mixed."""
    word = _WORD[data]
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    at = np.flatnonzero(word)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(at)) - np.repeat(first, lengths)
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(lengths.max()) - 1, _PRIME)]).astype(np.uint64))
    h = np.add.reduceat(_LOWER[data[at]] * powers[place], first)
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return starts, h ^ (h >> np.uint64(32))


def _pieces(text: bytes, size: int) -> Iterator[bytes]:
    """A long text in pieces of about ``size``; a cut is made where no word is, however long."""
    start = 0
    while len(text) - start > size:
        cut = text.rfind(b" ", start + 1, start + size)
        if cut < 0:
            found = _NO_WORD.search(text, start + size)
            cut = found.start() if found else len(text)
        yield text[start:cut]
        start = cut
    yield text[start:]


def _groups(texts: list[bytes], most: int) -> Iterator[tuple[int, list[bytes]]]:
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        if held and size + len(t) > most:
            yield first, held
            first, held, size = i, [], 0
        held.append(t)
        size += len(t)
    if held:
        yield first, held


def word_counts(texts: list[str | None], bits: int,
                size: int = GROUP_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket, count) of the hashed words, sorted by number and bucket."""
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    keys, counts = [], []
    for first, held in _groups(raw, size):
        own_keys, own_counts = [], []
        for pieces in ([held] if len(held) > 1 else [[p] for p in _pieces(held[0], size)]):
            sizes = np.array([len(p) + 1 for p in pieces])
            starts, h = hash_words(np.frombuffer(b"\n".join(pieces) + b"\n", np.uint8))
            doc = np.searchsorted(np.cumsum(sizes), starts, side="right")
            key = ((doc + first).astype(np.uint64) << np.uint64(bits)) | (h >> np.uint64(64 - bits))
            k, c = np.unique(key, return_counts=True)
            own_keys.append(k)
            own_counts.append(c)
        if len(own_keys) > 1:  # one long text in pieces
            k, where = np.unique(np.concatenate(own_keys), return_inverse=True)
            own_keys, own_counts = [k], [np.bincount(where, np.concatenate(own_counts)).astype(np.int64)]
        keys += own_keys
        counts += own_counts
    key = np.concatenate(keys) if keys else np.empty(0, np.uint64)
    n = np.concatenate(counts) if counts else np.empty(0, np.int64)
    return (key >> np.uint64(bits)).astype(np.int64), (key & np.uint64((1 << bits) - 1)).astype(np.int64), n


def structure(texts: list[str | None]) -> np.ndarray:
    """A row of ``STATS`` for each text; an empty text has zeros."""
    out = np.zeros((len(texts), len(STATS)))
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "replace")
        if not raw:
            continue
        n = len(raw)
        have = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        lower = raw.lower()
        words = lower.split()
        lines = [line for line in raw.split(b"\n") if line.strip()]
        marks = have[33:127].sum() - have[(_WORD & (_B < 128))].sum()
        out[i] = (np.log1p(n), np.log1p(len(words)), n / (len(words) + 1), have[_UPPER].sum() / n,
                  have[_DIGIT].sum() / n, marks / n, have[33] / n, have[124] / n,
                  have[_SPACE].sum() / n, have[10] / n, have[128:].sum() / n,
                  len(set(words)) / (len(words) + 1), 1 - len(set(lines)) / max(1, len(lines)),
                  np.log1p(n / max(1, len(lines))))
    return out
