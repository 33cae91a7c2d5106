"""Best-fit packing of tokenised documents by minimum bin slack.

Only how many pieces have each length decides which lengths share a sequence: at most `capacity`
numbers however many documents there are. For the longest piece left, a bitset subset-sum over the
lengths left finds the fullest combination; it is taken as often as the counts allow and removed.
Pieces get their places by rank within their length; ranks are running sums over hashed parts, so
a length that a third of all pieces share is not a hot group.

Edge cases: null and empty texts are one piece of one token, the end token; repeated rows are packed
as often as they occur; null ids stay null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastword.llm import frames, textops

CAPACITY = 4096
END = 1
VOCABULARY = "word_bpe_49k.json"
CACHED_WORDS = 1_500_000  # words a worker remembers; beyond, it starts anew

SPACE, LETTER, NUMBER, MARK, ODD = range(5)


def _classes() -> np.ndarray:
    """Kinds of the code points whose words we may cut ourselves; all others are ODD."""
    out = np.full(0x2028, ODD, np.uint8)
    for point in [*range(0x20, 0x7F), *range(0xA1, 0x250), *range(0x2010, 0x2028), 9, 10, 13]:
        kind = unicodedata.category(chr(point))[0]
        out[point] = LETTER if kind == "L" else NUMBER if kind == "N" else MARK
    out[[9, 10, 13, 32]] = SPACE
    out[0x130] = ODD  # its lower case has two code points
    return out


class Encoder:
    """Token ids by the tokenizers library, each distinct word of plain text encoded once.

    The vocabulary's pre-tokenizer cuts text at code point classes, so ids of a text are those of its
    words in a row. Texts with code points beyond the table, or with a special token's string, go
    to the library whole.
    """

    def __init__(self, name: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(public_tokenizers.path(name))
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.by_word = Tokenizer.from_file(public_tokenizers.path(name))
        self.by_word.normalizer = None
        self.by_word.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.classes = _classes()
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        found = [e.ids for e in self.by_word.encode_batch_fast(words, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(size.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        self.ids[self.used:self.used + len(flat)] = flat
        at = self.used + np.cumsum(size) - size
        self.used += len(flat)
        place = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, place, hashes)
        self.at, self.size = np.insert(self.at, place, at), np.insert(self.size, place, size)

    def _cut(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of words: letters, single numbers, runs of marks, and contractions."""
        kind = self.classes[points]
        before = np.concatenate([[SPACE], kind[:-1]])
        starts = (kind != SPACE) & ((kind != before) | (kind == NUMBER))
        padded = np.concatenate([points, np.full(3, 32, points.dtype)])
        quote = np.flatnonzero(starts & (points == ord("'")))
        one, two = padded[quote + 1], padded[quote + 2]
        short = np.isin(one, [ord(x) for x in "stmd"])
        pair = one.astype(np.int64) * 65536 + two
        long = ~short & np.isin(pair, [ord(a) * 65536 + ord(b) for a, b in ("re", "ve", "ll")])
        for where, n in ((quote[short], 2), (quote[long], 3)):
            starts[where + 1] = False
            rest = where + n
            rest = rest[rest < len(points)]
            starts[rest] |= kind[rest] == LETTER
        ends = kind != SPACE
        ends[:-1] &= (kind[1:] == SPACE) | starts[1:]
        return np.flatnonzero(starts), np.flatnonzero(ends) + 1

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """One array of ids for each text, without the end token."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = "\n".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        begin = np.concatenate([[0], np.cumsum(lengths + 1)])
        kind = self.classes[np.minimum(points, len(self.classes) - 1)]
        kind[points >= len(self.classes)] = ODD
        odd_at = np.flatnonzero(kind == ODD)
        odd = set((np.searchsorted(begin, odd_at, "right") - 1).tolist())
        if any(s in joined for s in self.special):
            odd |= {i for i, t in enumerate(texts) if any(s in t for s in self.special)}
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        if odd:
            rest = sorted(odd)
            for i, e in zip(rest, self.whole.encode_batch_fast([texts[i] for i in rest],
                                                              add_special_tokens=False)):
                out[i] = np.array(e.ids, np.uint32)
        plain = [i for i in range(len(texts)) if i not in odd]
        if not plain:
            return out
        lowered = "\n".join(texts[i] for i in plain).lower() + "\n"
        points = np.frombuffer(lowered.encode("utf-32-le"), np.uint32)
        starts, ends = self._cut(points)
        hashes = textops.span_hashes(points, starts, ends)
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        slot = self._slots(unique)
        if (slot < 0).any():
            if len(self.known) + len(unique) > CACHED_WORDS:
                self.forget()
                slot = self._slots(unique)
            new = slot < 0
            self._learn(unique[new], [lowered[starts[i]:ends[i]] for i in first[new]])
            slot = self._slots(unique)
        size, at = self.size[slot][back], self.at[slot][back]
        total = np.concatenate([[0], np.cumsum(size)])
        flat = self.ids[np.arange(total[-1]) + np.repeat(at - total[:-1], size)]
        edge = np.concatenate([[0], np.cumsum(lengths[plain] + 1)])
        cut = total[np.searchsorted(starts, edge)]
        for k, i in enumerate(plain):
            out[i] = flat[cut[k]:cut[k + 1]]
        return out

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        """Places of known words, -1 for others."""
        slot = np.searchsorted(self.known, hashes)
        known = slot < len(self.known)
        known[known] = self.known[slot[known]] == hashes[known]
        return np.where(known, slot, -1)


_ENCODERS: dict[str, Encoder] = {}


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY,
           keep_ids: bool = False) -> DataFrame:
    """One row for each piece of at most `capacity` tokens: doc_id, piece, start, length, ids_crc32,
    and the ids themselves if asked for."""
    frames.small_batches(docs.sparkSession, 512)
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (
        ", ids array<int>" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(vocabulary) or _ENCODERS.setdefault(vocabulary, Encoder(vocabulary))
        for batch in batches:
            owner, piece, start, length, crc, kept = [], [], [], [], [], []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), encoder(texts)):
                ids = np.append(ids, np.uint32(END)).astype("<u4")
                for k, low in enumerate(range(0, len(ids), capacity)):
                    part = ids[low:low + capacity]
                    owner.append(doc)
                    piece.append(k)
                    start.append(low)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if keep_ids:
                        kept.append(part.astype(np.int32))
            columns = [pa.array(owner, pa.int64()), pa.array(piece, pa.int32()),
                       *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(columns)]
            yield pa.RecordBatch.from_arrays(columns, names)

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return picked.mapInArrow(run, schema)


def fullest(target: int, counts: np.ndarray, lengths: list[int]) -> list[int]:
    """Lengths, each at most as often as counted, whose sum is the largest not above target.

    Bit s of `sums` says that sum s can be reached; long lengths come first, so short ones are left
    for later bins. Counts enter in powers of two.
    """
    sums, mask, steps = 1, (1 << (target + 1)) - 1, []
    for length in lengths:
        left, take = min(int(counts[length]), target // length), 1
        while left > 0 and not sums >> target & 1:
            n = min(take, left)
            more = sums | (sums << (n * length)) & mask
            if more != sums:
                steps.append((sums, length, n))
                sums = more
            left, take = left - n, take * 2
        if sums >> target & 1:
            break
    best, out = sums.bit_length() - 1, []
    for before, length, n in reversed(steps):
        if not before >> best & 1:
            out += [length] * n
            best -= n * length
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths of one sequence, how many sequences look so), until no piece is left."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    out = []
    while True:
        left = np.flatnonzero(counts)
        if not len(left):
            return out
        longest = int(left[-1])
        counts[longest] -= 1
        room = capacity - longest
        rest = fullest(room, counts, [int(x) for x in left[left <= room][::-1]]) if room else []
        counts[longest] += 1
        combination = [longest, *rest]
        kinds, each = np.unique(combination, return_counts=True)
        times = int((counts[kinds] // each).min())
        counts[kinds] -= each * times
        out.append((combination, times))


def places(patterns: list[tuple[list[int], int]]) -> tuple[np.ndarray, ...]:
    """For runs of ranks of a length: (length << 44 | first rank, first sequence, offset), sorted."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for combination, times in patterns:
        offset = 0
        for length in combination:
            rows.append(((length << 44) + used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + times
            offset += length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset. Texts are
    tokenised once, into a written table of piece lengths."""
    cut = frames.written(pieces(docs, capacity, vocabulary), "pieces")
    histogram = {int(r["length"]): int(r["n"]) for r in
                 cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    table = docs.sparkSession.sparkContext.broadcast(places(plan(histogram, capacity)))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ranked = frames.ranked_counts(cut.groupBy(*names).agg(F.count("*").alias("n")), ["length"],
                                  ["doc_id", "piece", "start", "ids_crc32"])
    blocks, ranks = frames.numbered(F.col("first"), F.col("n"))
    ranked = ranked.withColumn("_block", blocks).withColumn("rank", ranks).select(*names, "rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, first, offset = table.value
        for batch in batches:
            want = (batch.column(3).to_numpy() << 44) + batch.column(5).to_numpy()
            at = np.searchsorted(keys, want, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(first[at] + want - keys[at]), pa.array(offset[at])],
                [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, "
                                  "ids_crc32 bigint, sequence_id bigint, offset bigint")


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(frames.table(spark, folder, "documents"))
