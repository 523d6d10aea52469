"""Vectorised five-word shingles of whole texts (used inside tasks)."""

from __future__ import annotations

import numpy as np

U = np.uint64
WIDTH = 5
CHUNK_BYTES = 1 << 18  # of text handled at a time, few enough for a core's cache
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTERS = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_LETTERS[_SPACE] = 0


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z lowered) of all texts, and the words per text."""
    buf = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
    space = _SPACE[buf]
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    starts = np.flatnonzero(~space & before)
    ends = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, ends), prepend=0) if len(texts) else np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros(0, U), counts
    lens = np.flatnonzero(space & ~before) - starts
    at = np.arange(len(buf), dtype=np.int64)
    at[starts[0]:] -= np.repeat(starts, np.diff(starts, append=len(buf)))
    powers = np.cumprod(np.full(int(lens.max()) + 1, 0x9E3779B97F4A7C15, U))
    vals = _LETTERS.take(buf)
    vals *= powers.take(at, mode="clip")
    return mix(np.add.reduceat(vals, starts) + lens.astype(U)), counts


def chunks(texts: list):
    """Index ranges of ``texts`` of about CHUNK_BYTES each."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK_BYTES:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, n): each text's distinct shingle hashes in ascending order, and how many each has.

    A text with fewer than WIDTH words has its whole word sequence as one
    shingle; a text without words has none.
    """
    words, counts = word_hashes(texts)
    doc = np.repeat(np.arange(len(texts)), counts)
    n = len(words) - WIDTH + 1
    parts_h, parts_d = [], []
    if n > 0:
        h = words[:n].copy()
        for j in range(1, WIDTH):
            h = mix(h * U(3) + words[j:n + j])
        whole = doc[:n] == doc[WIDTH - 1:]
        parts_h.append(h[whole])
        parts_d.append(doc[:n][whole])
    offsets = np.concatenate([[0], np.cumsum(counts)])
    for i in np.flatnonzero((counts > 0) & (counts < WIDTH)):
        h = U(counts[i])
        for w in words[offsets[i]:offsets[i + 1]]:
            h = mix(np.array([h], U) * U(5) + w)[0]
        parts_h.append(np.array([h], U))
        parts_d.append(np.array([i]))
    if not parts_h:
        return np.zeros(0, U), np.zeros(len(texts), np.int64)
    h, d = np.concatenate(parts_h), np.concatenate(parts_d)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[new], np.bincount(d[new], minlength=len(texts))
