"""Joins of near copies, repeated lines and repeated strings against brute force."""

import hashlib
import re
from pathlib import Path

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import REPEATED, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from lastword.llm import frames, jaccard, lines, listblocks, repeats, setjoin, suffixes, textops


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("short", [2, 8])
def test_jaccard_components(docs, rows, short, monkeypatch):
    monkeypatch.setattr(setjoin, "SHORT", short)
    assert tuples(jaccard.join(docs).select("doc_id", "n_shingles", "component_id")) == brute.components(rows)


def test_jaccard_heavy_tokens(docs, rows, monkeypatch):
    monkeypatch.setattr(setjoin, "HEAVY", 3)
    monkeypatch.setattr(setjoin, "HEAVY_TIMES", 0)
    assert tuples(jaccard.join(docs).select("doc_id", "n_shingles", "component_id")) == brute.components(rows)


def test_jaccard_repeated_rows_and_null_ids(repeated, rows):
    got = tuples(jaccard.join(repeated).select("doc_id", "n_shingles", "component_id"))
    assert got == brute.components(rows[:12] + REPEATED * 2)


def test_jaccard_keeps_one(docs, rows):
    left = jaccard.keep_one(docs)
    assert left.columns == docs.columns
    want = {c for i, n, c in brute.components(rows)}
    assert sorted(r.doc_id for r in left.collect()) == sorted(want)


def test_jaccard_keeps_one_of_repeated_rows(repeated):
    left = [r.doc_id for r in jaccard.keep_one(repeated).collect()]
    assert left.count(60) == 1 and left.count(None) >= 2


def test_jaccard_keeps_one_text_of_a_repeated_or_missing_id(spark):
    words = [f"w{n}" for n in range(80)]
    near = lambda x: " ".join(words[:-1] + [x])
    far = lambda x: " ".join(f"{x}{n}" for n in range(60))
    given_rows = [(5, near("a")), (5, near("b")), (7, near("c")), (None, near("d")), (5, far("own")),
                  (None, far("z")), (None, far("z") + " end"), (9, far("y")), (None, far("y") + " end")]
    left = [(r.doc_id, r.text) for r in jaccard.keep_one(frame(spark, given_rows)).collect()]
    assert len(left) == 4
    assert sum(i == 5 and t in (near("a"), near("b")) for i, t in left) == 1
    assert (5, far("own")) in left and (9, far("y")) in left
    assert sum(i is None and t.startswith("z0") for i, t in left) == 1


def test_divide_skip_is_the_overlap_test():
    rng = np.random.default_rng(1)
    for _ in range(60):
        query = np.unique(rng.integers(0, 60, 40)).astype(np.uint64)
        others = [np.unique(np.concatenate([rng.choice(query, rng.integers(1, len(query))),
                                            rng.integers(0, 200, rng.integers(0, 12))])).astype(np.uint64)
                  for _ in range(9)]
        want = [k for k, x in enumerate(others) if brute.similar(frozenset(query.tolist()), frozenset(x.tolist()))]
        assert sorted(jaccard.divide_skip(query, others)) == want


def test_jaccard_blocks(docs, rows, monkeypatch):
    """All pairs are left to the blocks, several of a band."""
    monkeypatch.setattr(setjoin, "SHORT", 1)
    monkeypatch.setattr(jaccard, "VOLUME", 500)
    monkeypatch.setattr(jaccard, "pivot_pairs", lambda lists: lists.select("a", jaccard.F.col("a").alias("b")).limit(0))
    assert tuples(jaccard.join(docs).select("doc_id", "n_shingles", "component_id")) == brute.components(rows)


def reached(n, links):
    of = list(range(n))
    for i, j in links:
        of = [of[i] if x == of[j] else x for x in of]
    return [of.index(x) for x in of]


def test_forest_connects_what_links_connect():
    rng = np.random.default_rng(5)
    for _ in range(60):
        base = rng.choice(400, (3, 60))
        sets = sorted((np.unique(np.where(rng.random(60) < rng.choice([0.02, 0.1, 0.3]), rng.choice(400, 60),
                                          base[rng.integers(3)]))[:rng.integers(1, 61)] for _ in range(25)), key=len)
        size = np.array([len(x) for x in sets])
        component, partner = rng.integers(0, 20, 25), rng.random(25) < 0.8
        links = []
        for i in range(25):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if partner[j] and 100 * both >= 75 * (size[i] + size[j] - both):
                    links.append((i, j))
        same = [(i, j) for i in range(25) for j in range(i) if component[i] == component[j]]
        found = jaccard.forest(size, component, partner, np.concatenate(sets).astype(np.uint64))
        assert set(found) <= set(links)
        assert reached(25, same + found) == reached(25, same + links)


@pytest.mark.parametrize("short", [2, 8])
def test_lines(docs, rows, short, monkeypatch):
    monkeypatch.setattr(setjoin, "SHORT", short)
    got = {r.doc_id: (r["__n_lines"], r["__n_removed"], r.text or "")
           for r in lines.deduplicated(docs, counts=True).collect()}
    assert got == brute.kept_lines(rows)


@pytest.mark.parametrize("pivots", [True, False])
@pytest.mark.parametrize("volume", [300, 5000])
def test_lines_in_blocks(docs, rows, volume, pivots, monkeypatch):
    monkeypatch.setattr(setjoin, "SHORT", 1)
    monkeypatch.setattr(listblocks, "VOLUME", volume)
    if not pivots:
        monkeypatch.setattr(lines, "pivot_pairs", lambda named, gone: named.select("a", named["a"].alias("b")).limit(0))
    got = {r.doc_id: (r["__n_lines"], r["__n_removed"], r.text or "")
           for r in lines.deduplicated(docs, counts=True).collect()}
    assert got == brute.kept_lines(rows)


def test_earlier_finds_every_set_with_a_similar_one_before_it():
    rng = np.random.default_rng(5)
    for _ in range(60):
        base = [rng.choice(40, rng.integers(1, 25), replace=False) for _ in range(6)]
        sets = []
        for _ in range(40):
            one = set(base[rng.integers(6)].tolist()) ^ set(rng.choice(60, rng.integers(0, 4)).tolist())
            sets.append(np.sort(np.array(sorted(one or {99}), np.uint64)))
        query, partner = rng.random(40) < 0.7, rng.random(40) < 0.7
        found = listblocks.earlier(np.array([len(x) for x in sets]), np.concatenate(sets), query, partner)
        want = [bool(query[i]) and any(
            partner[j] and brute.similar(frozenset(sets[i].tolist()), frozenset(sets[j].tolist()))
            for j in range(i)) for i in range(40)]
        assert found.tolist() == want


def test_lines_stage_drops_only_emptied_documents(docs, rows):
    left = lines.without_repeats(docs)
    assert left.columns == docs.columns
    want = {i for i, (n, gone, _) in brute.kept_lines(rows).items() if not n or gone < n}
    found = left.collect()
    assert {r.doc_id for r in found} == want
    assert all(r.text is None or r.n_chars == len(r.text) for r in found)


def test_lines_of_repeated_rows_are_equal(repeated):
    same = [r for r in lines.deduplicated(repeated).collect() if r.doc_id == 60]
    assert len(same) == 2 and same[0].text == same[1].text == REPEATED[0][1]


@pytest.mark.parametrize("hot", [2, 3000])
def test_repeated_strings(docs, rows, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", hot)
    assert tuples(repeats.deduplicated(docs).drop("kept")) == brute.without_repeats(rows)


def test_repeated_strings_in_pieces_of_long_texts(docs, rows, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 700)
    found = repeats.deduplicated(docs)
    assert tuples(found.drop("kept")) == brute.without_repeats(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found.collect())


def test_repeated_strings_of_repeated_rows(spark):
    from conftest import frame
    rows = [(1, "z" * 150 + "q" * 80)] * 3 + [(None, "k" * 300)] + [(2, None), (2, None)]
    assert tuples(repeats.deduplicated(frame(spark, rows)).drop("kept")) == brute.without_repeats(rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(2, 5), min_size=1, max_size=30), min_size=1, max_size=4))
def test_suffix_array_and_common_prefixes(parts):
    text = [x for p in parts for x in (*p, 1)] + [0]
    room = np.array([x for p in parts for x in (*range(len(p), 0, -1), 0)] + [0])
    array = suffixes.suffix_array(np.array(text, np.uint16))
    assert array.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    prefix = suffixes.common_prefixes(np.array(text, np.uint16), array, room)
    for i, j in zip(array, array[1:]):
        n = 0
        while n < min(room[i], room[j]) and text[i + n] == text[j + n]:
            n += 1
        assert prefix[j] == n


def test_empty_tables(empty):
    assert jaccard.join(empty).count() == 0
    assert jaccard.keep_one(empty).count() == 0
    assert lines.deduplicated(empty).count() == 0
    assert repeats.deduplicated(empty).count() == 0


def test_lines_lie_between_breaks():
    texts = ["", "a\n\nbc\n", None, "\n", "d", "\n\ne f\r\n \n", "", "g\n"]
    data, offsets = textops.flat(pa.array(texts))
    low, high = lines.between_breaks(data, offsets)
    want = [textops.spans(data, offsets, np.arange(256) != 10)[k].tolist() for k in (0, 1)]
    assert [low.tolist(), high.tolist()] == want


def test_many_sets_of_one_block_are_searched_together(monkeypatch):
    """The search takes no numpy calls for each set that asks."""
    rng = np.random.default_rng(7)
    base = [rng.choice(3000, 30, replace=False) for _ in range(400)]
    sets = [np.unique(np.where(rng.random(30) < 0.12, rng.choice(3000, 30), base[rng.integers(400)])).astype(np.uint64)
            for _ in range(2000)]
    calls = []
    unique = np.unique
    monkeypatch.setattr(np, "unique", lambda *a, **b: calls.append(1) or unique(*a, **b))
    every = np.ones(2000, bool)
    found = listblocks.earlier(np.array([len(x) for x in sets]), np.concatenate(sets), every, every)
    assert len(calls) < 20
    held = np.zeros((2000, 3000), np.int32)
    for i, x in enumerate(sets):
        held[i, x.astype(int)] = 1
    both, size = held @ held.T, held.sum(1)
    similar = np.tril(100 * both >= 75 * (size[:, None] + size - both), -1)
    assert 0 < found.sum() < 2000 and found.tolist() == similar.any(1).tolist()


@pytest.mark.parametrize("spots, step", [(1, 1), (40, 3)])
def test_earlier_in_small_steps(spots, step, monkeypatch):
    monkeypatch.setattr(listblocks, "SPOTS", spots)
    monkeypatch.setattr(listblocks, "STEP", step)
    test_earlier_finds_every_set_with_a_similar_one_before_it()


def resident():
    return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) // 1024


@pytest.mark.parametrize("lean", [frames.lean, frames.lean_group])
def test_tasks_leave_no_unused_memory(lean):
    last = []

    def run(_):
        held = [bytes([n % 250]) * 90_000 for n in range(2000)]  # below what malloc maps by itself
        last.append(b"x" * 90_000)  # on top of them
        return [len(held)]

    before = resident()
    assert list(lean(run)([])) == [2000]
    assert resident() - before < 40
