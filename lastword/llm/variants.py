"""Spelling variants: exact pairs at edit distance one through PartEnum signatures of letter multisets.

A word is a binary vector with one dimension for each (letter, how often it occurred before in the word). One
inserted, deleted or replaced letter changes at most two places of the vector. The dimensions are dealt
to PARTS parts of like information, by letter counts over the vocabulary; two changed places touch at most
two parts, so near words agree in all the others: each word gets one signature for every choice of
PARTS - 2 parts (partition and enumerate), words of a signature meet, and what meets is verified by letters.

Words of a signature are compared only if they share one half: one edit leaves the first half or the
second half as it was. A signature with more than CROWD words is not held in one task: its words go to
a second exchange by signature and half, which spreads them; nothing is dropped.

The text's own rule for words (which runs count, which lose a letter) is `words_of`; everything behind it
works on any table of words and counts.

Edge cases: null texts have no words; a null id is written as an empty string in the key of the deletion rule;
letters are code points up to U+00FF, one byte each, and a run may have any length (words beyond LONG
letters are compared one by one); ties for a form go to the word that is first in code-point order; rows
that repeat count again; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lastword.llm import frames, textops

SHORTEST, TIMES, FACTOR = 7, 2, 10  # letters, occurrences of a word; how much more frequent a form is
DIVISOR = 31
RUN = r"[a-zÀ-ÿ]{%d,}" % SHORTEST
PARTS = 6
CHOICES = list(itertools.combinations(range(PARTS), PARTS - 2))
CROWD = 20_000  # words of one signature that a task holds
LONG = 64  # letters up to which words are compared as rows of a matrix
PAIRS = 1 << 18  # pairs compared at once
LATIN = "ISO-8859-1"


def words_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word (bytes, one a letter) and n of all words long and frequent enough. Written."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = F.translate(F.col(text).cast("string"), capitals, capitals.lower())
    runs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(low, F.lit(RUN), F.lit(0))).alias("run"))
    mark = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod("mark", F.char_length("run")).cast("int")
    # Without its letter at `at`: what stands before it and what follows.
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = runs.withColumn("mark", mark).select(
        F.when(F.col("mark") % DIVISOR == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n")).where(
        (F.col("n") >= TIMES) & (F.char_length("word") >= SHORTEST))
    return frames.written(counted.select(F.encode("word", LATIN).alias("word"), "n"), "words")


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letters of all words with their word's number, sorted within the word; how many like it stand
    before it in its word; and the words' lengths."""
    data, offsets = textops.flat(column)
    size = np.diff(offsets)
    owner = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((data, owner))
    letter = data[order].astype(np.int64)
    new = np.ones(len(letter), bool)
    new[1:] = (letter[1:] != letter[:-1]) | (owner[1:] != owner[:-1])
    here = np.arange(len(letter))
    return letter, owner, here - np.maximum.accumulate(np.where(new, here, 0)), size


def dealt_letters(words: DataFrame) -> np.ndarray:
    """The part of each dimension (256 letters by 8 occurrences, later ones as the last): the fullest
    dimension first, always to the part that has least information so far."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(2048, np.int64), 0
        for batch in batches:
            letter, _, before, size = letters(batch.column(0))
            total += np.bincount(letter * 8 + np.minimum(before, 7), minlength=2048)
            n += len(size)
        at = np.append(np.flatnonzero(total), -1)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(total[at[:-1]], n))], ["at", "n"])

    held = {r["at"]: r["n"] for r in words.select("word").mapInArrow(run, "at bigint, n bigint")
            .groupBy("at").agg(F.sum("n").alias("n")).collect()}  # 2,049 rows at most
    n = max(1, held.pop(-1, 1))
    share = np.zeros(2048)
    share[list(held)] = [min(1.0, x / n) for x in held.values()]
    both = np.stack([share, 1 - share]).clip(1e-12, 1)
    weight = -(both * np.log2(both)).sum(axis=0)
    part, load = np.zeros(2048, np.int64), np.zeros(PARTS)
    for d in np.lexsort((np.arange(2048), -weight)):
        part[d] = int(np.argmin(load))
        load[part[d]] += weight[d] + 1e-9
    return part


def signed(words: DataFrame, part: np.ndarray) -> DataFrame:
    """sig, word and n: every word under each of its signatures."""
    shared = words.sparkSession.sparkContext.broadcast(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letter, owner, before, size = letters(batch.column(0))
            spot = shared.value[letter * 8 + np.minimum(before, 7)]
            value = textops.mixed((letter + 256 * before + 1).astype(np.uint64))
            # Sums of a word's values by part; a sum tells a set of places but for 64-bit collisions.
            order = np.lexsort((spot, owner))
            key = (owner * PARTS + spot)[order]
            sums = np.zeros(len(size) * PARTS, np.uint64)
            start = np.flatnonzero(np.diff(key, prepend=-1))
            if len(start):
                sums[key[start]] = np.add.reduceat(value[order], start)
            sums = textops.mixed(sums.reshape(-1, PARTS) + np.arange(PARTS, dtype=np.uint64) * np.uint64(textops.MULT))
            every = np.stack([textops.mixed(sums[:, list(c)].sum(axis=1, dtype=np.uint64) + np.uint64(k))
                              for k, c in enumerate(CHOICES)], axis=1)
            pick = pa.array(np.repeat(np.arange(len(size)), len(CHOICES)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(every.ravel().view(np.int64)), batch.column(0).take(pick), batch.column(1).take(pick)],
                ["sig", "word", "n"])

    return words.mapInArrow(run, "sig bigint, word binary, n bigint")


def halves(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys under which near words meet: keys, their word and whether it takes part as the longer one.

    Of two words the shorter has L letters, cut at L // 2. Without an edit in the first half both start alike;
    without one in the second both end alike. A word is entered as the shorter (L its length) and as the
    longer one (L one less), with its start and its end each.
    """
    size = np.diff(offsets)
    start, end = offsets[:-1], offsets[1:]
    keys, words, longer = [], [], []
    for less in (0, 1):
        level = size - less
        cut = level // 2
        for which, (low, high) in enumerate(((start, start + cut), (start + cut + less, end))):
            held = textops.span_hashes(data, low, high)
            keys.append(textops.mixed(held * np.uint64(4) + (level.astype(np.uint64) << np.uint64(20))
                                      + np.uint64(which)))
            words.append(np.arange(len(size)))
            longer.append(np.full(len(size), less))
    return np.concatenate(keys), np.concatenate(words), np.concatenate(longer)


def one_edit(data: np.ndarray, offsets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs are one edit apart; the word at b has as many letters as that at a, or one more."""
    size = np.diff(offsets)
    out = np.zeros(len(a), bool)
    for i in np.flatnonzero(size[b] > LONG).tolist():
        x, y = (data[offsets[k]:offsets[k + 1]] for k in (a[i], b[i]))
        n = len(x)
        if len(y) == n:
            out[i] = (x != y).sum() == 1
        else:
            ahead, back = x != y[:n], x[::-1] != y[::-1][:n]
            out[i] = (ahead.argmax() if ahead.any() else n) + (back.argmax() if back.any() else n) >= n
    short = np.flatnonzero(size[b] <= LONG)
    if not len(short):
        return out
    a, b = a[short], b[short]
    n, wide = size[a], int(size[b].max())
    place = np.arange(wide)
    inside = place < n[:, None]
    last = len(data) - 1
    x = data[np.minimum(offsets[a][:, None] + place, last)]
    ahead = (x != data[np.minimum(offsets[b][:, None] + place, last)]) & inside
    # Where the second word is one longer, its letters behind the first difference are held one further on.
    shifted = (x != data[np.minimum(offsets[b][:, None] + place + 1, last)]) & inside
    before = np.where(ahead.any(axis=1), ahead.argmax(axis=1), n)
    behind = shifted & (place >= before[:, None])
    out[short] = np.where(size[b] == n, ahead.sum(axis=1) == 1, ~behind.any(axis=1))
    return out


def grouped_pairs(group: np.ndarray, words: np.ndarray, longer: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of entries of one group, the first one taking part as the shorter word, PAIRS at a time.

    Two entries as the longer word meet under their own length instead.
    """
    if not len(group):
        return
    order = np.lexsort((longer, group))
    group, words, longer = group[order], words[order], longer[order]
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    end = np.repeat(np.append(start[1:], len(group)), np.diff(np.append(start, len(group))))
    here = np.arange(len(group))
    mates = np.where(longer == 0, end - here - 1, 0)  # all that follow in the group
    total = np.concatenate([[0], np.cumsum(mates)])
    for low in range(0, int(total[-1]), PAIRS):
        k = np.arange(low, min(low + PAIRS, int(total[-1])))
        first = np.searchsorted(total, k, "right") - 1
        yield words[first], words[first + 1 + k - total[first]]


def near(data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of words of the same group that are one edit apart."""
    keys, words, longer = halves(data, offsets)
    keys = textops.mixed(keys + textops.mixed(group.view(np.uint64))[words])
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for a, b in grouped_pairs(keys, words, longer):
        hit = one_edit(data, offsets, a, b)
        found.append((a[hit], b[hit]))
    a, b = (np.concatenate(x) for x in zip(*found))
    pair = np.unique(a * np.int64(len(group)) + b)
    return pair // max(1, len(group)), pair % max(1, len(group))


def met(rows: DataFrame, by: list[str], crowd: int | None) -> DataFrame:
    """a, n_a, b, n_b of near words that share the key `by[0]`; words of a key with more than `crowd` words
    come back as they are (with a null b)."""
    schema = "key bigint, a binary, n_a bigint, b binary, n_b bigint"
    names = ["key", "a", "n_a", "b", "n_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows of the keys that have not ended
        crowded: int | None = None  # the key whose words are passed on

        def settled(whole: pa.Table) -> pa.RecordBatch:
            key = whole.column(0).to_numpy()
            again, same = np.zeros(len(key), bool), key[1:] == key[:-1]
            again[1:] |= same
            again[:-1] |= same
            whole = whole.filter(pa.array(again))  # a word alone under its key meets nobody
            column, n = whole.column(1).combine_chunks(), whole.column(2).combine_chunks()
            data, offsets = textops.flat(column)
            a, b = (pa.array(x) for x in near(data, offsets, whole.column(0).to_numpy()))
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(a), pa.int64()), column.take(a), n.take(a), column.take(b), n.take(b)], names)

        def passed(batch: pa.RecordBatch) -> pa.RecordBatch:
            n = batch.num_rows
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            if crowded is not None:
                same = int((batch.column(0).to_numpy() == crowded).sum())
                if same:
                    yield passed(batch.slice(0, same))
                    batch = batch.slice(same)
                if not batch.num_rows:
                    continue
                crowded = None
            held.append(batch)
            whole = pa.Table.from_batches(held)
            key = whole.column(0).to_numpy()
            open_ = int((key == key[-1]).sum())  # rows are sorted: these are the last ones
            if open_ < len(key):
                yield settled(whole.slice(0, len(key) - open_))
                held = whole.slice(len(key) - open_).to_batches()
            if crowd is not None and open_ > crowd:
                for part in held:
                    yield passed(part)
                held, crowded = [], int(key[-1])
        if held:
            yield settled(pa.Table.from_batches(held))

    return rows.repartition(*by).sortWithinPartitions(*by).select(by[0], "word", "n").mapInArrow(run, schema)


def by_half(rows: DataFrame) -> DataFrame:
    """key, word and n: crowded words under their signature and each of their halves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textops.flat(batch.column(1))
            keys, words, _ = halves(data, offsets)
            keys = textops.mixed(keys + textops.mixed(batch.column(0).to_numpy().view(np.uint64))[words])
            pick = pa.array(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), batch.column(1).take(pick), batch.column(2).take(pick)],
                ["key", "word", "n"])

    return rows.select("key", F.col("a").alias("word"), F.col("n_a").alias("n")).mapInArrow(
        run, "key bigint, word binary, n bigint")


def near_pairs(words: DataFrame) -> DataFrame:
    """Each pair of words (a, n_a, b, n_b) one edit apart, once. Written."""
    spark = words.sparkSession
    frames.ship(spark)
    columns = ["a", "n_a", "b", "n_b"]
    first = frames.written(met(signed(words, dealt_letters(words)), ["sig"], CROWD), "met")
    crowded = first.where("b IS NULL")
    pairs = first.where("b IS NOT NULL").select(*columns)
    if not crowded.isEmpty():
        pairs = pairs.unionByName(met(by_half(crowded), ["key"], None).select(*columns))
    ordered = pairs.select(
        F.least("a", "b").alias("a"), F.when(F.col("a") < F.col("b"), F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
        F.greatest("a", "b").alias("b"), F.when(F.col("a") < F.col("b"), F.col("n_b")).otherwise(F.col("n_a")).alias("n_b"))
    return frames.written(ordered.distinct(), "near")


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """word, n, n_near, and the word's form with its count where it has one."""
    both = pairs.select("a", "b", "n_b").unionByName(
        pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("n_a").alias("n_b")))
    best = (both.groupBy(F.col("a").alias("of")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), "b")).alias("best")))
    joined = words.join(best, F.col("word") == F.col("of"), "left")
    frequent = -F.col("best.less") >= F.col("n") * FACTOR
    return joined.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                         F.when(frequent, F.col("best.b")).alias("form"),
                         F.when(frequent, -F.col("best.less")).alias("form_n"))


def roots(parents: DataFrame) -> DataFrame:
    """word and root: where following forms from word ends. parents: word, form.

    Every turn doubles how far a root lies ahead, and counts grow FACTOR times a step, so turns are few.
    """
    now = frames.written(parents.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        then = frames.written(now.join(further, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = then.select("word", "root")
        if then.where("moved").isEmpty():
            return now


def variants(words: DataFrame) -> DataFrame:
    """Per word (bytes) of a table of words and counts: form, root, n, n_near, form_n."""
    told = frames.written(forms(words, near_pairs(words)), "forms")
    ends = roots(told.where("form IS NOT NULL").select("word", "form")).withColumnRenamed("word", "of")

    def shown(c: Column) -> Column:
        return F.decode(c, LATIN)

    return told.join(ends, F.col("word") == F.col("of"), "left").select(
        shown(F.col("word")).alias("word"), shown(F.col("form")).alias("form"),
        shown(F.coalesce("root", "word")).alias("root"), "n", "n_near", "form_n")


def op11_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants(words_of(frames.table(spark, folder, "documents")))
