"""Suffix-array dedup: removes every byte that a repeated string of 200 bytes covers, corpus-wide.

Every window of 200 bytes is dealt by its minimizer, the least hash of its grams of 64 bytes: equal
windows have equal minimizers, so they meet. Only minimizers that stand at two places or more are
followed. A run of windows of one minimizer is a segment; segments of a minimizer share a shard.
A shard keeps each distinct segment once, sorts the suffixes of its segments by induced sorting, and
flags windows whose common prefix with a neighbour reaches 200 bytes.

Copies of a whole text need no search: all their bytes go, and a task follows one of them. Minimizers
that stand at more than HOT places would make a shard as large as the corpus: their windows are dealt
by a 128-bit hash of the window itself, which is exact but for that hash.

Edge cases: null and empty texts, and texts of fewer bytes than a window, lose nothing; rows that repeat
id and text are copies; an empty table gives no rows; other columns are ignored. Documents are told
apart by a 64-bit hash of id and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastword.llm import frames, suffixes, textops

WINDOW, GRAM = 200, 64
SPAN = WINDOW - GRAM + 1  # grams of a window
SIDE = (WINDOW - GRAM) // 2  # every window holds so many bytes before its minimizer, or after
HOT = 3000
BUCKET_ENTRIES, SHARD_BYTES = 500_000, 4_000_000
FLUSH_BYTES, PIECE = 12_000_000, 1 << 20
ENTRY = np.dtype([("value", "<u8"), ("owner", "<u8")])
HASHED = np.dtype([("one", "<u8"), ("two", "<u8"), ("owner", "<u8"), ("start", "<u4")])
MARK = np.dtype([("owner", "<u8"), ("start", "<u4"), ("end", "<u4")])
NOWHERE = 0xFFFFFFFF
SECOND = 0xD1342543DE82EF95


def rolling(data: np.ndarray, size: int, base: int = textops.MULT) -> np.ndarray:
    """A hash of every run of `size` bytes."""
    n = len(data)
    up, down = textops.powers(n, base), textops.powers(n, pow(base, -1, 1 << 64))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    return textops.mixed((sums[size:] - sums[:-size]) * down[:n - size + 1])


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    size, out = 1, x
    while size * 2 <= width:
        out = pick(out[:-size], out[size:])
        size *= 2
    n = len(x) - width + 1
    return pick(out[:n], out[width - size:width - size + n])


class Windows:
    """The windows of texts in a row: their minimizers, and where those stand."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        grams = rolling(data, GRAM)
        least = sliding(grams, SPAN, np.minimum)
        start = np.arange(len(least))
        self.text = np.searchsorted(offsets, start, "right") - 1
        valid = offsets[self.text + 1] - start >= WINDOW
        least = np.where(valid, least, np.uint64(0))
        padded = np.concatenate([np.zeros(SPAN - 1, np.uint64), least, np.zeros(SPAN - 1, np.uint64)])
        self.places = np.flatnonzero((grams == sliding(padded, SPAN, np.maximum)) & (grams > 0))
        self.values = grams[self.places]
        self.least, self.valid = least, valid

    def runs(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last window, and minimizer, of each run whose minimizer is wanted (sorted)."""
        new = np.ones(len(self.least), bool)
        new[1:] = (self.least[1:] != self.least[:-1]) | (self.text[1:] != self.text[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(self.least)) - 1
        value = self.least[first]
        keep = self.valid[first] & (value > 0)
        slot = np.minimum(np.searchsorted(wanted, value), max(len(wanted) - 1, 0))
        keep &= (wanted[slot] == value) if len(wanted) else False
        # A run may end with windows that are cut off by the text's end.
        first, last, value = first[keep], last[keep], value[keep]
        return first, last, value

    def place_in(self, first: np.ndarray, last: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Where the minimizer stands in each run, from the run's start; NOWHERE if at several places."""
        order = np.lexsort((self.places, self.values))
        values, places = self.values[order], self.places[order]
        key = np.searchsorted(values, value)
        out = np.full(len(first), NOWHERE, np.int64)
        stop = np.searchsorted(values, value, "right")
        for i, (a, b) in enumerate(zip(key.tolist(), stop.tolist())):
            mine = places[a:b]
            low, high = np.searchsorted(mine, (first[i], last[i] + SPAN))
            if high - low == 1:
                out[i] = mine[low] - first[i]
        return out


def stretches(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Whole texts together, or pieces of a long text that overlap by one window less a byte:
    data, offsets, the first text and the piece's start in it."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = i + 1
        while j < n and offsets[j + 1] - offsets[i] <= PIECE:
            j += 1
        low, high = int(offsets[i]), int(offsets[j])
        if high - low <= PIECE or j > i + 1:
            yield data[low:high], offsets[i:j + 1] - low, i, 0
        else:
            for at in range(0, high - low, PIECE):
                end = min(high - low, at + PIECE + WINDOW - 1)
                yield data[low + at:low + end], np.array([0, end - at]), i, at
                if end == high - low:
                    break
        i = j


def places(docs: DataFrame, buckets: int) -> DataFrame:
    """Minimizers of the texts of a task, each text once: bucket and packed entries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        pending, waiting = [], 0
        for batch in batches:
            data, offsets = textops.flat(batch.column(2))
            owners = batch.column(0).to_numpy().view(np.uint64)
            fresh = np.zeros(batch.num_rows, bool)
            for i, h in enumerate(batch.column(1).to_pylist()):
                if h not in seen:
                    seen.add(h)
                    fresh[i] = True
            for part, edges, text, _ in stretches(data, offsets):
                if len(part) < WINDOW:
                    continue
                found = Windows(part, edges)
                whose = text + np.searchsorted(edges, found.places, "right") - 1
                keep = fresh[whose]
                entry = np.zeros(int(keep.sum()), ENTRY)
                entry["value"], entry["owner"] = found.values[keep], owners[whose[keep]]
                pending.append(entry)
                waiting += len(entry)
            if waiting > FLUSH_BYTES // 16:
                yield from dealt(pending)
                pending, waiting = [], 0
        if waiting:
            yield from dealt(pending)

    def dealt(pending: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        entry = np.concatenate(pending)
        bucket = (entry["value"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket.astype(np.uint16) if buckets < 65536 else bucket, kind="stable")
        entry, bucket = entry[order], bucket[order]
        start = np.flatnonzero(np.diff(bucket, prepend=-1))
        blobs = [entry[a:b].tobytes() for a, b in zip(start, [*start[1:], len(entry)])]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[start]), pa.array(blobs, pa.binary())], ["bucket", "entries"])

    return docs.select("owner", "hash", "text").mapInArrow(run, "bucket bigint, entries binary")


def repeated(packed: DataFrame) -> DataFrame:
    """Per owner its minimizers that stand at several places: packed values, and the hot ones."""
    def meet(table: pa.Table) -> pa.Table:
        entry = np.frombuffer(b"".join(table.column("entries").to_pylist()), ENTRY)
        entry = entry[np.argsort(entry["value"], kind="stable")]
        start = np.flatnonzero(np.diff(entry["value"], prepend=~entry["value"][:1]))
        count = np.diff(np.append(start, len(entry)))
        times = np.repeat(count, count)
        entry, times = entry[times > 1], times[times > 1]
        order = np.lexsort((entry["value"], entry["owner"]))
        entry, times = entry[order], times[order]
        new = np.ones(len(entry), bool)
        new[1:] = entry[1:] != entry[:-1]
        entry, hot = entry[new], times[new] > HOT
        start = np.flatnonzero(np.diff(entry["owner"], prepend=~entry["owner"][:1])) if len(entry) else []
        cuts = list(zip(start, [*start[1:], len(entry)]))
        return pa.table({
            "owner": pa.array([entry["owner"][a].astype(np.int64) for a, _ in cuts], pa.int64()),
            "n": pa.array([b - a for a, b in cuts], pa.int64()),
            "values": pa.array([entry["value"][a:b][~hot[a:b]].tobytes() for a, b in cuts], pa.binary()),
            "hot": pa.array([entry["value"][a:b][hot[a:b]].tobytes() for a, b in cuts], pa.binary())})

    return packed.groupBy("bucket").applyInArrow(meet, "owner bigint, n bigint, values binary, hot binary")


def segments(texts: DataFrame, shards: int) -> DataFrame:
    """Runs of windows of wanted minimizers, by shard; each distinct segment of a flush once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple] = []
        waiting = 0
        for batch in batches:
            owners = batch.column(0).to_numpy().view(np.uint64)
            data, offsets = textops.flat(batch.column(1))
            wanted, hot = (np.unique(np.frombuffer(b"".join(x for row in batch.column(c).to_pylist() for x in row),
                                                   np.uint64)) for c in (2, 3))
            for part, edges, text, at in stretches(data, offsets):
                if len(part) < WINDOW:
                    continue
                found = Windows(part, edges)
                first, last, value = found.runs(wanted)
                place = found.place_in(first, last, value)
                raw = part.tobytes()
                for a, b, v, p in zip(first.tolist(), last.tolist(), value.tolist(), place.tolist()):
                    t = int(found.text[a])
                    pending.append((v, raw[a:b + WINDOW], p, int(owners[text + t]), at + a - int(edges[t])))
                    waiting += b - a + WINDOW
                yield from by_window(found, part, edges, owners, text, at, hot)
            if waiting > FLUSH_BYTES:
                yield flush(pending)
                pending, waiting = [], 0
        if pending:
            yield flush(pending)

    def by_window(found, part, edges, owners, text, at, hot) -> Iterator[pa.RecordBatch]:
        first, last, value = found.runs(hot)
        if not len(first):
            return
        one, two = rolling(part, WINDOW), rolling(part, WINDOW, SECOND)
        raw = part.tobytes()
        same: dict[bytes, list[int]] = {}
        for i, (a, b) in enumerate(zip(first.tolist(), last.tolist())):
            same.setdefault(raw[a:b + WINDOW], []).append(i)
        spots, marks = [], []
        whose = owners[text + found.text[first]]
        begin = at + first - edges[found.text[first]]
        for rows in same.values():
            for i in rows[:2]:
                spots.append((np.arange(first[i], last[i] + 1), i))
            if len(rows) > 1:
                for i in rows:
                    marks.append((whose[i], begin[i], begin[i] + last[i] - first[i] + WINDOW))
        where = np.concatenate([x for x, _ in spots])
        which = np.repeat([i for _, i in spots], [len(x) for x, _ in spots])
        entry = np.zeros(len(where), HASHED)
        entry["one"], entry["two"], entry["owner"] = one[where], two[where], whose[which]
        entry["start"] = begin[which] + where - first[which]
        shard = -1 - (entry["one"] % np.uint64(256)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        entry, shard = entry[order], shard[order]
        cut = np.flatnonzero(np.diff(shard, prepend=1))
        names = [int(shard[a]) for a in cut]
        blobs = [entry[a:b].tobytes() for a, b in zip(cut, [*cut[1:], len(entry)])]
        if marks:
            names.append(-1000 - int(entry["one"][0] % np.uint64(256)))
            blobs.append(np.array(marks, MARK).tobytes())
        empty = pa.array([b""] * len(names), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), empty, empty, pa.array(blobs, pa.binary())],
            ["shard", "heads", "texts", "owners"])

    def flush(pending: list[tuple]) -> pa.RecordBatch:
        by_shard: dict[int, dict[tuple[int, bytes, int], list[tuple[int, int]]]] = {}
        for v, text, p, owner, start in pending:
            by_shard.setdefault(v % shards, {}).setdefault((v, text, p), []).append((owner, start))
        heads, texts, owners = [], [], []
        for found in by_shard.values():
            heads.append(np.array([(v, len(t), p) for v, t, p in found], np.uint64).tobytes())
            texts.append(b"".join(t for _, t, _ in found))
            owners.append(np.array([(i, o, s) for i, who in enumerate(found.values()) for o, s in who],
                                   np.uint64).tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(by_shard), pa.int64()), pa.array(heads, pa.binary()), pa.array(texts, pa.binary()),
             pa.array(owners, pa.binary())], ["shard", "heads", "texts", "owners"])

    return texts.select("owner", "text", "values", "hot").mapInArrow(
        run, "shard bigint, heads binary, texts binary, owners binary")


def shared_windows(value: np.ndarray, size: np.ndarray, place: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Of distinct segments in a row: a flag for each byte at which a repeated window starts."""
    begin = np.cumsum(size) - size
    once = place != NOWHERE
    at = np.where(once, place, 0)
    sides = []
    if len(data) >= SIDE:
        side = rolling(data, SIDE)
        for fits, start in ((at >= SIDE, at - SIDE), (at + GRAM + SIDE <= size, at + GRAM)):
            fits &= once
            key = textops.mixed(side[np.where(fits, begin + start, 0)] ^ value)
            _, back, count = np.unique(key[fits], return_inverse=True, return_counts=True)
            shared = ~once
            shared[np.flatnonzero(fits)] |= count[back] > 1
            sides.append(shared)
    left, right = sides
    low = np.where(left, 0, np.maximum(0, at - SIDE + 1))
    high = np.where(right, size, np.minimum(size, at + GRAM + SIDE - 1))
    high = np.where(left | right, high, 0)
    use = np.flatnonzero(high - low >= WINDOW)
    flags = np.zeros(len(data), bool)
    if not len(use):
        return flags
    length = (high - low)[use]
    total = np.cumsum(length + 1)
    text = np.ones(total[-1] + 1, np.uint16)
    room = np.zeros(len(text), np.int64)
    source = np.zeros(len(text), np.int64)
    inner = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    spot = inner + np.repeat(total - length - 1, length)
    source[spot] = inner + np.repeat((begin + low)[use], length)
    text[spot] = data[source[spot]].astype(np.uint16) + 2
    room[spot] = np.repeat(length, length) - inner
    text[-1] = 0
    array = suffixes.suffix_array(text)
    prefix = suffixes.common_prefixes(text, array, room)[array]
    hit = np.flatnonzero(prefix >= WINDOW)
    flags[source[array[hit]]] = True
    flags[source[array[hit - 1]]] = True
    return flags


def marked(packed: DataFrame) -> DataFrame:
    """Covered stretches of bytes: owner, start, end."""
    def rows(mark: np.ndarray) -> pa.Table:
        return pa.table({"owner": pa.array(mark["owner"].astype(np.int64)),
                         "start": pa.array(mark["start"].astype(np.int64)),
                         "end": pa.array(mark["end"].astype(np.int64))})

    def merged(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Table:
        order = np.lexsort((start, owner))
        owner, start, end = owner[order], start[order], end[order]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (start[1:] > end[:-1])  # windows: ends rise with starts
        first = np.flatnonzero(new)
        out = np.zeros(len(first), MARK)
        if len(first):
            out["owner"], out["start"] = owner[first], start[first]
            out["end"] = np.maximum.reduceat(end, first)
        return rows(out)

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        if shard <= -1000:
            return rows(np.frombuffer(b"".join(table.column("owners").to_pylist()), MARK))
        if shard < 0:
            entry = np.frombuffer(b"".join(table.column("owners").to_pylist()), HASHED)
            entry = entry[np.lexsort((entry["two"], entry["one"]))]
            same = (entry["one"][1:] == entry["one"][:-1]) & (entry["two"][1:] == entry["two"][:-1])
            hit = np.zeros(len(entry), bool)
            hit[1:] |= same
            hit[:-1] |= same
            entry = entry[hit]
            start = entry["start"].astype(np.int64)
            return merged(entry["owner"].astype(np.uint64), start, start + WINDOW)
        heads, owners, shift = [], [], 0
        for head, who in zip(table.column("heads").to_pylist(), table.column("owners").to_pylist()):
            head = np.frombuffer(head, np.uint64).reshape(-1, 3)
            who = np.frombuffer(who, np.uint64).reshape(-1, 3).copy()
            who[:, 0] += np.uint64(shift)
            shift += len(head)
            heads.append(head)
            owners.append(who)
        head, who = np.concatenate(heads), np.concatenate(owners)
        data = np.frombuffer(b"".join(table.column("texts").to_pylist()), np.uint8)
        value, size, place = head[:, 0], head[:, 1].astype(np.int64), head[:, 2].astype(np.int64)
        begin = np.cumsum(size) - size
        # Distinct segments: by minimizer, length and hash of the bytes.
        whole = textops.span_hashes(data, begin, begin + size)
        order = np.lexsort((size, value, whole))
        new = np.ones(len(order), bool)
        a, b = order[1:], order[:-1]
        new[1:] = (whole[a] != whole[b]) | (value[a] != value[b]) | (size[a] != size[b])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        kept = order[new]
        mine = number[who[:, 0].astype(np.int64)]
        times = np.bincount(mine, minlength=len(kept))
        several = times[mine] > 1
        start = who[:, 2].astype(np.int64)
        marks = [(who[several, 1], start[several], start[several] + size[kept][mine[several]])]
        pick = np.repeat(begin[kept] - (np.cumsum(size[kept]) - size[kept]), size[kept]) + np.arange(size[kept].sum())
        flags = shared_windows(value[kept], size[kept], place[kept], data[pick])
        where = np.flatnonzero(flags)
        edge = np.cumsum(size[kept])
        segment = np.searchsorted(edge, where, "right")
        alone = times[segment] == 1
        where, segment = where[alone], segment[alone]
        holder = np.zeros(len(kept), np.int64)
        holder[mine] = np.arange(len(mine))
        row = holder[segment]
        at = start[row] + where - (edge - size[kept])[segment]
        marks.append((who[row, 1], at, at + WINDOW))
        return merged(*(np.concatenate(x) for x in zip(*marks)))

    return packed.groupBy("shard").applyInArrow(meet, "owner bigint, start bigint, end bigint")


def removed(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text, and the sorted byte spans (start, end) that go; spans may touch.

    whole: the text is one of several equal ones and long enough to go as a whole.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.xxhash64("doc_id", "text").alias("owner"), F.xxhash64("text").alias("hash"))
    long = rows.where(F.octet_length("text") >= WINDOW)
    keys = frames.written(long.select("owner", F.md5(F.col("text").cast("binary")).alias("md5"),
                                      F.octet_length("text").cast("long").alias("size")), "keys")
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    copies = keys.groupBy("md5").agg(F.count("*").alias("n")).where("n > 1").select("md5")
    whole = keys.join(copies, "md5", "left_semi").select("owner", F.lit(True).alias("whole")).distinct()
    frames.small_batches(spark)
    buckets = max(16, total // (SPAN // 2) // BUCKET_ENTRIES)
    found = frames.written(repeated(places(long, buckets)), "repeated")
    entries = found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(16, entries * (WINDOW + SPAN // 2) // SHARD_BYTES)
    wanted = found.groupBy("owner").agg(F.collect_list("values").alias("values"), F.collect_list("hot").alias("hot"))
    packed = segments(long.select("owner", "text").join(wanted, "owner"), shards)
    marks = marked(packed).groupBy("owner").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    known = frames.written(marks.join(whole, "owner", "full_outer"), "marks")
    return rows.join(known, "owner", "left").select("doc_id", "text", "spans", F.coalesce("whole", F.lit(False)).alias("whole"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and `kept`, the remaining bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, runs, digest, kept = [], [], [], [], []
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for text, spans, whole in zip(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                parts, upto, n = [], 0, 0
                if whole:
                    spans = [{"start": 0, "end": len(text)}]
                for span in spans or ():
                    if span["start"] > upto or not n:
                        n += 1
                        parts.append(text[upto:span["start"]])
                    upto = max(upto, span["end"])
                parts.append(text[upto:])
                left = b"".join(parts)
                size.append(len(text))
                gone.append(len(text) - len(left))
                runs.append(n)
                digest.append(hashlib.sha256(left).hexdigest())
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (size, gone, runs)),
                 pa.array(digest, pa.string()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    found = removed(docs)
    frames.small_batches(docs.sparkSession)
    return found.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
                                 "kept_sha256 string, kept binary")


def op2_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicated(frames.table(spark, folder, "documents")).drop("kept")
