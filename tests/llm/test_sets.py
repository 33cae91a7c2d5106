"""The steps that cut texts into sets, against plain Python, and that only what is asked for is hashed."""

import random

import numpy as np
import pyarrow as pa
import pytest

from lastword.llm import lines, textops
from lastword.llm import setjoin as sj

TEXTS = [None, "", " \n\t ", "one", "a b c d e", "a b c d\n\nx y", "x\ny\nx\ny", "q" * 200 + " w" * 3,
         "a\0b a b\0 a\0\0", "Ünïcode Ça va? " * 3 + "\nlast line of seven words stands here\n", "abcdefgh abcdefghi " * 9]


def words_of(text):
    return [line.split() for line in (text or "").lower().split("\n") if line.split()]


def test_words_have_a_hash_of_their_bytes():
    rng = random.Random(5)
    words = [bytes(rng.choice(b"ab\0\xff") for _ in range(n)) for n in [*range(1, 20), 63, 64, 65, 66, 200] for _ in range(9)]
    words += words[::-1]
    data = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    hashes = textops.word_hashes(data, ends - [len(w) for w in words], ends).tolist()
    assert len(set(hashes)) == len(set(words)) == len(set(zip(hashes, words)))


def test_only_wanted_lines_are_hashed(monkeypatch):
    texts = pa.array(TEXTS)
    every, first, of = lines.lines(texts)
    assert np.diff(first).tolist() == [len(line) for t in TEXTS for line in words_of(t)]
    hashed = []
    one = textops.word_hashes
    monkeypatch.setattr(textops, "word_hashes", lambda d, s, e: hashed.append(len(s)) or one(d, s, e))
    places = np.arange(len(TEXTS)) * 100
    nth = np.arange(len(of)) - np.searchsorted(of, of)
    mine = (places[of] + nth) % 2 == 1
    got, begin, text = lines.lines(texts, places, lambda x: x % 2 == 1)
    assert hashed == [len(got)] and 0 < len(got) < len(every)
    assert got.tolist() == every[np.repeat(mine, np.diff(first))].tolist()
    assert text.tolist() == of[mine].tolist() and np.diff(begin).tolist() == np.diff(first)[mine].tolist()
    lines.bounds(texts)
    assert len(hashed) == 1  # the pass that takes lines out needs no hash


def test_sets_and_their_order_by_rarity():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 6, 4000).astype(np.uint64)
    first = np.sort(np.append(rng.integers(0, 4000, 300), [0, 4000, 4000]))
    token, begin = textops.shingles(words, first, sj.WORDS)
    plain = [sorted(set((token[a:b] >> np.uint64(6)).tolist())) for a, b in zip(begin, begin[1:])]
    found = sj.sets(words, first)
    assert [found.tokens[a:b].tolist() for a, b in zip(found.begin, found.begin[1:])] == plain
    rarity = rng.integers(0, 64, sj.COUNTERS).astype(np.uint8)
    fresh = (found.size > 0) & (rng.random(len(plain)) < 0.7)
    tokens, begin = sj.rarest_first(found, fresh, rarity)
    want = [sorted(int(rarity[t % sj.COUNTERS]) << 58 | t for t in one) for one, new in zip(plain, fresh) if new]
    assert [tokens[a:b].tolist() for a, b in zip(begin, begin[1:])] == want


@pytest.mark.parametrize("low_bits", [3, 1 << 40])
def test_entries_sort_by_token_then_class(low_bits):
    rng = np.random.default_rng(2)
    token = rng.integers(0, 50, 3000) * (1 << 26) + (1 << 31)
    which = rng.integers(0, 8, 3000) * low_bits + rng.integers(0, 3, 3000)
    order, plain = sj.sorted_entries(token, which), np.lexsort((which, token))
    assert (token[order] == token[plain]).all() and (which[order] == which[plain]).all()


def test_bitmap_holds_every_key_and_grows_with_their_number(spark):
    keys = spark.range(0, 1 << 20).selectExpr("xxhash64(id) AS a")
    flags = sj.bitmap(keys)
    assert 16 << 20 < 8 * len(flags) <= 1 << 27
    assert sj.marked(flags, np.array([r["a"] for r in keys.limit(5000).collect()])).all()
    others = np.array([r["a"] for r in spark.range(1 << 20, (1 << 20) + 5000).selectExpr("xxhash64(id) AS a").collect()])
    assert sj.marked(flags, others).mean() < 0.08


def test_able_counts_tokens_of_other_components(spark):
    rng = random.Random(8)
    sets = {a: sorted(rng.sample(range(1 << 40, (1 << 40) + 60), rng.randint(4, 12))) for a in range(1, 90)}
    component = {a: a % 7 for a in sets}
    listed = [a for a in sets if a % 3]
    held = {}
    for a in listed:
        for t in sets[a]:
            held.setdefault(t, set()).add(component[a])
    far = max(sets) + 1  # tokens of its own, and one that others hold
    sets[far], component[far] = [64005, 64006, 64007, sets[1][0]], 99
    listed.append(far)
    held[sets[1][0]].add(99)
    want = {a for a in listed if 100 * sum(len(held.get(t, ())) > 1 for t in sets[a]) >= 75 * len(sets[a])}
    members = spark.createDataFrame(
        [(a, a, a, len(x), bytearray(np.array(x, np.uint64).tobytes())) for a, x in sets.items()],
        "class long, one long, two long, size long, tokens binary")
    lists = spark.createDataFrame([(a, component[a], t % 5) for a in listed for t in sets[a]],
                                  "a long, component long, token long")
    got = sj.able(lists, members).collect()
    assert sorted(r["a"] for r in got) == sorted(want) and far not in want
    kept = {r["class"] for r in sj.only(members, lists).collect()}
    assert set(listed) <= kept and len(kept) < len(sets)  # others do not travel
