"""Vectorised word spans and hashes over a batch of texts, as UTF-8 bytes in one numpy array."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

MULT = 0x9E3779B97F4A7C15 | 1
INV = pow(MULT, -1, 1 << 64)
CHUNK = 1 << 19  # bytes hashed at once, unless one word is longer
LONG = 64  # bytes of a word from which on it is hashed by running sums
STEP = np.uint64(0xD6E8FEB86659FD93)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
NOT_SPACE = ~SPACES
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x41, 0x5B), *range(0x80, 0x100)]] = True


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and their len + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def looked_up(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """table[data] for bytes and a table of 256 bytes or truths."""
    return np.frombuffer(data.tobytes().translate(table.tobytes()), table.dtype)


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of `inside` bytes that stay within one text, and for each
    text the index of its first run (len + 1 values)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inner = looked_up(data, inside)
    begins = inner.copy()
    begins[1:] &= ~inner[:-1]
    edge = offsets[1:-1]
    edge = edge[edge < len(data)]
    begins[edge] = inner[edge]
    ends = inner.copy()
    ends[:-1] &= ~inner[1:]
    edge = edge[edge > 0] - 1
    ends[edge] = inner[edge]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: int = MULT) -> np.ndarray:
    out = np.full(n + 1, base & (2**64 - 1), np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) <= n:
        _POWERS["up"], _POWERS["down"] = powers(n + 1), powers(n + 1, INV)
    return _POWERS["up"], _POWERS["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes; spans are in order and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, low + CHUNK, "right")))
        high = ends[j - 1]
        up, down = _tables(max(CHUNK, int(high - low)))
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[:high - low], out=sums[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, eight at a time; other values than those of span_hashes."""
    length = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    mask = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
    out = mixed((eight[starts] & mask[np.minimum(length, 8)]) ^ length.astype(np.uint64) * STEP)
    at, left = 8, np.flatnonzero((length > 8) & (length <= LONG))
    while len(left):
        rest = length[left] - at
        more = eight[starts[left] + at] & mask[np.minimum(rest, 8)]
        out[left] = mixed(out[left] * STEP + more)
        at, left = at + 8, left[rest > 8]
    long = np.flatnonzero(length > LONG)
    out[long] = span_hashes(data, starts[long], ends[long])
    return out


def shingles(words: np.ndarray, firsts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles of each text and the index of each text's first one; a text
    of fewer words, but not none, has one shingle: all its words."""
    count = np.diff(firsts)
    each = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(each)])
    if not begin[-1]:
        return np.zeros(0, np.uint64), begin
    at = np.arange(begin[-1]) + np.repeat(firsts[:-1] - begin[:-1], each)
    weights, power = [], np.uint64(1)
    with np.errstate(over="ignore"):
        for _ in range(k):
            power = power * STEP
            weights.append(power)
    # At each word the sum of the k words from there on, though they may belong to several texts.
    last = max(0, len(words) - k)
    sums = np.full(last + 1, k, np.uint64)
    if len(words) >= k:
        for j, weight in enumerate(weights):
            sums += words[j:last + 1 + j] * weight
    total = sums[np.minimum(at, last)]
    short = np.flatnonzero((count > 0) & (count < k))
    start, held = firsts[:-1][short], count[short]
    few = held.astype(np.uint64)
    for j, weight in enumerate(weights[:-1]):
        few += np.where(j < held, words[np.minimum(start + j, len(words) - 1)] * weight, np.uint64(0))
    total[begin[:-1][short]] = few
    return mixed(total), begin
