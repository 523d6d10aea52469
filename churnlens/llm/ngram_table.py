"""N-grams of a batch of texts, interned in an open-addressed NumPy table.

Words are maximal runs of digits, ASCII letters (lower-cased) and bytes above
0x7F. An n-gram is n words of one text joined by one blank, held as a span of
one byte buffer. Its key is the XXH64 of the span; the table probes linearly,
at most half full, and a slot is shared only by spans with equal bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

#: Fixed values of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                            0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
#: Spans below this many bytes are hashed and compared as 64-bit lanes of whole arrays.
SHORT = 32

_BYTES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
IS_WORD = ((_BYTES >= 48) & (_BYTES <= 57)) | ((LOWER >= 97) & (LOWER <= 122)) | (_BYTES >= 128)


class Spans(NamedTuple):
    """Spans of ``data`` (zero bytes follow the last one), in the order of the texts."""

    data: np.ndarray
    start: np.ndarray
    length: np.ndarray
    doc: np.ndarray


class Table(NamedTuple):
    """``slot`` of every span; ``owner`` (a span, or -1) and ``count`` of every slot."""

    slot: np.ndarray
    owner: np.ndarray
    count: np.ndarray


def text_slices(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column without nulls into runs of about ``most`` bytes, whole texts each.

    Gives (first row, end row, bytes, offsets), so a batch of long texts is
    never expanded at once.
    """
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def words_of(data: np.ndarray, offsets: np.ndarray) -> Spans:
    """The words of texts that lie end to end, copied with one blank before each."""
    keep = IS_WORD[data]
    first = keep.copy()
    first[1:] &= ~keep[:-1]
    begins = offsets[offsets < len(data)]
    first[begins] = keep[begins]  # a word ends with its text
    at = np.flatnonzero(first)
    place = np.cumsum(keep) + np.cumsum(first) - 1  # a blank before each word
    out = np.full((int(place[-1]) + 1 if len(data) else 0) + SHORT + 8, 32, np.uint8)
    out[place[keep]] = LOWER[data[keep]]
    start = place[at]
    end = np.append(start[1:] - 1, len(out) - SHORT - 8)[:len(start)]
    out[len(out) - SHORT - 8:] = 0
    return Spans(out, start, end - start, np.searchsorted(offsets, at, "right") - 1)


def grams_of(words: Spans, n: int) -> Spans:
    """Runs of ``n`` words of one text."""
    if n == 1:
        return words
    ends = words.start + words.length
    start, end, doc = words.start[:1 - n], ends[n - 1:], words.doc[:1 - n]
    inside = doc == words.doc[n - 1:]
    return Spans(words.data, start[inside], (end - start)[inside], doc[inside])


def runs_of(words: Spans, most: int) -> Spans:
    """Runs of 1 to ``most`` words."""
    parts = [grams_of(words, n) for n in range(1, most + 1)]
    return parts[0] if most == 1 else Spans(words.data, *(np.concatenate([p[k] for p in parts]) for k in (1, 2, 3)))


def _lanes(data: np.ndarray) -> np.ndarray:
    """The little-endian 64-bit number at every byte."""
    return np.ndarray(len(data) - 7, "<u8", data, strides=(1,))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64(s: Spans) -> np.ndarray:
    """XXH64 (seed 0) of every span: short ones as arrays, a step at a time; others one by one."""
    lanes, out = _lanes(s.data), np.empty(len(s.start), np.uint64)
    few = np.flatnonzero(s.length < SHORT)
    at, left = s.start[few].copy(), s.length[few].copy()
    with np.errstate(over="ignore"):
        h = P5 + left.astype(np.uint64)
        for _ in range(SHORT // 8 - 1):
            m = np.flatnonzero(left >= 8)
            h[m] = _rotl(h[m] ^ (_rotl(lanes[at[m]] * P2, 31) * P1), 27) * P1 + P4
            at[m] += 8
            left[m] -= 8
        m = np.flatnonzero(left >= 4)
        h[m] = _rotl(h[m] ^ ((lanes[at[m]] & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
        at[m] += 4
        left[m] -= 4
        for _ in range(3):
            m = np.flatnonzero(left > 0)
            h[m] = _rotl(h[m] ^ (s.data[at[m]].astype(np.uint64) * P5), 11) * P1
            at[m] += 1
            left[m] -= 1
        for shift, prime in ((33, P2), (29, P3)):
            h = (h ^ (h >> np.uint64(shift))) * prime
        out[few] = h ^ (h >> np.uint64(32))
    view = memoryview(s.data)
    for i in np.flatnonzero(s.length >= SHORT).tolist():
        out[i] = xxhash.xxh64_intdigest(view[s.start[i]:s.start[i] + s.length[i]])
    return out


def _same_bytes(s: Spans, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether spans ``a`` and ``b``, of equal length, hold the same bytes."""
    lanes, length = _lanes(s.data), s.length[a]
    same = np.ones(len(a), bool)
    for k in range(0, SHORT, 8):
        m = np.flatnonzero((length > k) & (length < SHORT))
        spare = np.uint64(8) * np.maximum(0, 8 - (length[m] - k)).astype(np.uint64)
        same[m] &= ((lanes[s.start[a[m]] + k] ^ lanes[s.start[b[m]] + k]) << spare) == 0
    view = memoryview(s.data)
    for i in np.flatnonzero((length >= SHORT) & (a != b)).tolist():
        n, x, y = length[i], s.start[a[i]], s.start[b[i]]
        same[i] = view[x:x + n] == view[y:y + n]
    return same


def intern(s: Spans, key: np.ndarray | None = None) -> Table:
    """Give spans with equal bytes one slot of a table of twice as many slots as spans.

    Every round tries one slot for each span that has none: free slots go to
    one of those that want them; a span whose slot is owned by other bytes,
    with an equal key or not, goes on to the next slot.
    """
    n = len(s.start)
    key = xxh64(s) if key is None else key
    size = 1 << max(4, (2 * n - 1).bit_length())
    owner, slot = np.full(size, -1, np.int64), np.empty(n, np.int64)
    at, todo = (key & np.uint64(size - 1)).astype(np.int64), np.arange(n)
    while len(todo):
        want = at[todo]
        free = owner[want] < 0
        owner[want[free]] = todo[free]
        has = owner[want]
        same = (key[has] == key[todo]) & (s.length[has] == s.length[todo])
        alike = np.flatnonzero(same)
        same[alike] = _same_bytes(s, has[alike], todo[alike])
        slot[todo[same]] = want[same]
        todo = todo[~same]
        at[todo] = (at[todo] + 1) & (size - 1)
    return Table(slot, owner, np.bincount(slot, minlength=size))


def buckets_of(s: Spans, t: Table, buckets: int) -> np.ndarray:
    """The bucket of every slot: its bytes' crc32, once a slot; -1 in free ones."""
    out, view = np.full(len(t.owner), -1, np.int64), memoryview(s.data)
    used = np.flatnonzero(t.owner >= 0)
    start = s.start[t.owner[used]]
    ends = (start + s.length[t.owner[used]]).tolist()
    out[used] = [zlib.crc32(view[a:b]) % buckets for a, b in zip(start.tolist(), ends)]
    return out
