"""Plain-Python versions of the operators, for small tables."""

import collections
import hashlib
import itertools
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingles(text):
    words = WORD.findall((text or "").encode().translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def similar(a, b):
    both = len(a & b)
    return both > 0 and 100 * both >= 75 * (len(a) + len(b) - both)


def components(rows):
    """(doc_id, text) -> sorted (doc_id, n_shingles, component_id); ids may repeat or be null."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if similar(sets[a], sets[b]):
            parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=str)


def kept_lines(rows):
    """(doc_id, text) with distinct ids -> {doc_id: (n_lines, n_removed, text left)}"""
    seen, out = [], {}
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        kept, n, gone = [], 0, 0
        for line in (text or "").split("\n"):
            one = shingles(line)
            n += bool(one)
            if one and any(similar(one, other) for other in seen):
                gone += 1
            else:
                kept.append(line)
            seen.append(one)
        out[i] = (n, gone, "\n".join(kept))
    return out


def without_repeats(rows, window=200):
    texts = [(t or "").encode() for _, t in rows]
    count = collections.Counter(b[s:s + window] for b in texts for s in range(len(b) - window + 1))
    out = []
    for (i, _), b in zip(rows, texts):
        spans = []
        for s in range(len(b) - window + 1):
            if count[b[s:s + window]] > 1:
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = s + window
                else:
                    spans.append([s, s + window])
        left, at = b"", 0
        for s, e in spans:
            left += b[at:s]
            at = e
        left += b[at:]
        out.append((i, len(b), len(b) - len(left), len(spans), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def hits(rows, items, size=13):
    def words(t):
        return ALNUM.findall((t or "").encode().translate(LOWER).decode())

    found = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for s in range(len(w) - n + 1) if w else ():
            found[tuple(w[s:s + n])].add(item or "")
    sizes = {len(x) for x in found}
    out = []
    for i, text in rows:
        w, hit, mine = words(text), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in found:
                    hit |= set(range(s, s + n))
                    mine |= found[tuple(w[s:s + n])]
        digest = hashlib.sha256(",".join(sorted(mine)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(mine), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def jump(key, shards):
    key, b, j = key % 2**64, -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b
