"""Suffix arrays by induced sorting, and permuted common prefixes, of one shard's text.

The first level works on bytes: suffixes of a bucket are induced in one vectorised step after the
other. Its leftmost-smaller (LMS) substrings are named and sorted recursively; those levels have large
alphabets and a fraction of the length, and run over lists.
"""

from __future__ import annotations

import numpy as np

from lastword.llm import textops


def smaller_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last symbol is the least and unique."""
    step = np.sign(np.diff(text.astype(np.int64)))
    at = np.where(step != 0, np.arange(len(step)), len(step))
    after = np.minimum.accumulate(at[::-1])[::-1]
    out = np.ones(len(text), bool)
    out[:-1] = np.append(step, 1)[after] > 0
    return out


def _induce(text: np.ndarray, small: np.ndarray, array: np.ndarray, begin: np.ndarray,
            tails: np.ndarray, seeds: np.ndarray) -> None:
    """Fills in larger suffixes left to right, then smaller ones right to left, from sorted seeds.

    begin: first place of each symbol's bucket and the end; tails: how many seeds each bucket ends with.
    """
    symbols = len(begin) - 1
    heads = begin[:-1].copy()

    def put(found: np.ndarray, forward: bool) -> None:
        symbol = text[found]
        order = np.argsort(symbol, kind="stable")
        found, symbol = found[order], symbol[order]
        count = np.bincount(symbol, minlength=symbols)
        first = np.cumsum(count) - count
        rank = np.arange(len(found)) - first[symbol]
        if forward:
            array[heads[symbol] + rank] = found
            heads[:] += count
        else:
            array[ends[symbol] - 1 - rank] = found
            ends[:] -= count

    seeded = np.concatenate([[0], np.cumsum(tails)])
    for c in np.flatnonzero(np.diff(begin)):
        at = begin[c]
        while at < heads[c]:
            block = array[at:heads[c]]
            at = heads[c]
            block = block[block > 0] - 1
            put(block[~small[block]], True)
        block = seeds[seeded[c]:seeded[c + 1]]
        block = block[block > 0] - 1
        put(block[~small[block]], True)
    ends = begin[1:].copy()
    for c in np.flatnonzero(np.diff(begin))[::-1]:
        at = begin[c + 1]
        while at > ends[c]:
            block = array[ends[c]:at][::-1]
            at = ends[c]
            block = block[block > 0] - 1
            put(block[small[block]], False)
        block = array[begin[c]:heads[c]][::-1]  # the larger suffixes of the bucket
        block = block[block > 0] - 1
        put(block[small[block]], False)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Of an array of symbols below 2**16 that ends with 0, its only 0."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    text = text.astype(np.uint16)
    small = smaller_types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    size = np.bincount(text)
    begin = np.concatenate([[0], np.cumsum(size)])
    tails = np.bincount(text[lms], minlength=len(size))

    def sort(seeds: np.ndarray) -> np.ndarray:
        array = np.zeros(n, np.int64)
        _induce(text, small, array, begin, tails, seeds)
        array[0] = n - 1
        return array

    array = sort(lms[np.argsort(text[lms], kind="stable")])
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = array[is_lms[array]]
    # Names: equal ones have equal bytes up to and with the next LMS symbol.
    hashes = textops.span_hashes(text, lms, np.append(lms[1:], n))
    length = np.diff(np.append(lms, n))
    closing = text[np.append(lms[1:], n - 1)]
    place = np.searchsorted(lms, ordered)
    new = np.ones(len(ordered), bool)
    a, b = place[1:], place[:-1]
    new[1:] = (hashes[a] != hashes[b]) | (length[a] != length[b]) | (closing[a] != closing[b])
    names = np.empty(len(lms), np.int64)
    names[place] = np.cumsum(new) - 1
    if new.all():
        order = place
    else:
        order = np.array(by_lists(names.tolist(), int(new.sum())), np.int64)
    return sort(lms[order])


def by_lists(text: list[int], symbols: int) -> list[int]:
    """The same for the levels below: the last symbol is the least and unique."""
    n = len(text)
    if n < 2:
        return list(range(n))
    small = [True] * n
    for i in range(n - 2, -1, -1):
        small[i] = text[i] < text[i + 1] or (text[i] == text[i + 1] and small[i + 1])
    size = [0] * (symbols + 1)
    for c in text:
        size[c + 1] += 1
    for c in range(symbols):
        size[c + 1] += size[c]
    lms = [i for i in range(1, n) if small[i] and not small[i - 1]]

    def sort(seeds: list[int]) -> list[int]:
        array = [-1] * n
        ends = size[1:]
        for i in reversed(seeds):
            c = text[i]
            ends[c] -= 1
            array[ends[c]] = i
        heads = size[:-1]
        for j in array:  # filled to the right while it is read
            if j > 0 and not small[j - 1]:
                c = text[j - 1]
                array[heads[c]] = j - 1
                heads[c] += 1
        ends = size[1:]
        for k in range(n - 1, -1, -1):
            j = array[k]
            if j > 0 and small[j - 1]:
                c = text[j - 1]
                ends[c] -= 1
                array[ends[c]] = j - 1
        return array

    array = sort(lms)
    end = {a: b for a, b in zip(lms, lms[1:] + [n - 1])}
    ordered = [i for i in array if i in end]
    names, last, count = {}, None, -1
    for i in ordered:
        word = text[i:end[i] + 1]
        if word != last:
            count += 1
            last = word
        names[i] = count
    if count + 1 == len(lms):
        return sort(ordered)
    below = by_lists([names[i] for i in lms], count + 1)
    return sort([lms[i] for i in below])


def common_prefixes(text: np.ndarray, array: np.ndarray, room: np.ndarray) -> np.ndarray:
    """By text place: the common prefix of its suffix with the one before it in the array, never more
    than `room` symbols (what its segment has left). Only where the symbols before the two differ is it
    compared, by words of eight; elsewhere it is one less than at the place before."""
    n = len(text)
    before = np.empty(n, np.int64)
    before[array[1:]] = array[:-1]
    before[array[0]] = array[0]
    at = np.arange(n)
    left = np.where(at > 0, text[at - 1], 65535)
    left_other = np.where(before > 0, text[before - 1], 65534)
    own = (left != left_other) | (room != np.append(0, room[:-1]) - 1) | (
        room[before] != np.where(before > 0, room[before - 1], 0) - 1)
    own[array[0]] = True
    words = np.append(text, np.zeros(8, text.dtype)).astype(np.uint64)
    for shift in (1, 2, 4):
        words[:len(words) - shift] |= words[shift:] << np.uint64(8 * shift)
    found = np.zeros(n, np.int64)
    i = np.flatnonzero(own)
    most = np.minimum(room[i], room[before[i]])
    most[i == array[0]] = 0
    length = np.zeros(len(i), np.int64)
    active = np.arange(len(i))
    while len(active):
        a = i[active] + length[active]
        b = before[i[active]] + length[active]
        go = length[active] < most[active]
        active, a, b = active[go], a[go], b[go]
        differ = words[a] ^ words[b]
        low = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, np.floor(np.log2(low.astype(np.float64) + (differ == 0))).astype(np.int64) // 8)
        length[active] += same
        active = active[same == 8]
    found[i] = np.minimum(length, most)
    last = np.maximum.accumulate(np.where(own, at, 0))
    return found[last] - (at - last)
