"""Composite arrival order, radix selection and the activity of candidates, against brute force."""

import json
import math
import random
import struct

import pytest
from lastword import settings
from lastword.functions import contract
from lastword.model import RECORDS_LOG
from lastword.operators import activity as act, newest, scan
from lastword.operators.quantiles import high_pick, index_pick, low_pick, order_statistics, ordered_bits
from lastword.plans import queries as Q
from lastword.sources import feed as src, partitioned
from lastword.streaming import jobs
from lastword.sources.tables import Store
from pyspark.sql import functions as F
from vectors import DID, POST, account, event, log


def interleaved(rng, n=400, keys=5):
    """(arrived_ms, partition, offset, key, revision) of four partitions with repeated times."""
    ends, rows = [0] * 4, []
    for _ in range(n):
        part = rng.randrange(4)
        rows.append((rng.randrange(0, 40) * 7, part, ends[part], f"k{rng.randrange(keys)}", f"{rng.randrange(90):03d}"))
        ends[part] += 1
    return rows


def accepted_of(rows):
    out, stored = [], {}
    for row in sorted(rows):
        if row[3] not in stored or row[4] > stored[row[3]]:
            stored[row[3]] = row[4]
            out.append(row)
    return sorted(out)


SHAPE = "arrived_ms bigint, partition int, offset bigint, row_key string, revision string"


@pytest.mark.parametrize("slot", [1, 50, 60_000])
def test_acceptance_over_four_interleaved_partitions(spark, slot):
    rows = interleaved(random.Random(slot))
    got = newest.accepted(spark.createDataFrame(rows, SHAPE).repartition(3), slot_ms=slot).collect()
    assert sorted(tuple(r) for r in got) == accepted_of(rows)


def test_one_hot_key_over_partitions(spark):
    rows = interleaved(random.Random(9), 600, 1)
    frame = spark.createDataFrame(rows, SHAPE)
    assert sorted(tuple(r) for r in newest.accepted(frame, slot_ms=10).collect()) == accepted_of(rows)
    best = newest.newest(frame).first()
    top = max(r[4] for r in rows)
    assert tuple(best) == min(r for r in rows if r[4] == top)


def test_an_order_that_is_not_total_fails(spark):
    rows = [(5, 1, 7, "k", "a"), (5, 1, 7, "k", "b"), (5, 1, 7, "other", "a")]
    with pytest.raises(Exception, match=scan.NOT_TOTAL):
        newest.accepted(spark.createDataFrame(rows, SHAPE)).collect()
    assert newest.accepted(spark.createDataFrame(rows[1:], SHAPE)).count() == 2  # other keys may share it


def lines(spark, *events):
    made = log(spark, *events).select("offset", contract.event_json().alias("line")).orderBy("offset")
    return [r["line"] for r in made.collect()]


def test_a_partitioned_topic_is_read_by_one_reader_per_partition(spark, tmp_path):
    folder = str(tmp_path / "topic")
    partitioned.append(folder, 0, [(3, "a"), (4, "b")])
    partitioned.append(folder, 2, [(1, "c")])
    partitioned.append(folder, 0, [(9, "d")])
    read = partitioned.topic(spark, folder)
    assert sorted(tuple(r) for r in read.collect()) == [(0, 0, 3, "a"), (0, 1, 4, "b"), (0, 2, 9, "d"), (2, 0, 1, "c")]
    assert read.rdd.getNumPartitions() == 2
    reader = partitioned.TopicStreamReader(folder)
    spans = reader.partitions({"0": 1}, reader.latestOffset())
    assert [(s.partition, s.first, s.end) for s in spans] == [(0, 1, 3), (2, 0, 1)]
    assert [r[3] for s in spans for r in reader.read(s)] == ["b", "d", "c"]


def test_the_job_over_a_partitioned_topic_equals_brute_force(spark, tmp_path):
    folder, store = str(tmp_path / "topic"), Store(spark, str(tmp_path / "store"))
    rng = random.Random(4)
    revisions = [f"3kabc2ddxyz{a}{b}" for a in "234567" for b in "abcdef"]
    places: dict[str, int] = {}
    arrived = []
    for turn in range(3):
        batches = {p: [] for p in range(4)}
        for k in range(30):
            ident = f"{DID}/r{rng.randrange(6)}"
            part = places.setdefault(ident, rng.randrange(4))  # a topic keeps a key in one partition
            one = event(ident=ident, revision=rng.choice(revisions))
            batches[part].append((1000 * turn + k // 3, one))
            arrived.append((1000 * turn + k // 3, part, len(arrived), ident, one["revision"]))
        for part, found in batches.items():
            if found:
                partitioned.append(folder, part, [(at, line) for (at, _), line in zip(found, lines(spark, *[e for _, e in found]))])
        stream = src.log_lines(partitioned.topic(spark, folder, streaming=True))
        assert jobs.start_current_state(store, stream, once=True).awaitTermination(180)
    emitted = store.read_runs("accepted", RECORDS_LOG)
    got = sorted((r["entity_id"], r["revision"]) for r in emitted.collect())
    assert got == sorted((r[3], r[4]) for r in accepted_of(arrived))


def test_kafka_rows_keep_their_partition():
    options = src.kafka_options("host:1", "records")
    assert options["startingOffsets"] == "earliest" and len(src.arrival()) == 3


def test_ordered_bits_are_the_bits_of_a_double(spark):
    rng = random.Random(1)
    values = [0.0, -0.0, 1.0, -1.0, 0.5, 2.0 ** 52 + 1, 5e-324, -5e-324, 2.0 ** -1022, 2.0 ** -1022 - 5e-324, math.pi, -1e-310,
              1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf, 0.1, 0.3, 1 - 2.0 ** -53]
    values += [rng.uniform(0, 1) for _ in range(300)] + [2.0 ** rng.randrange(-1074, 1024) for _ in range(200)]
    values += [struct.unpack("<d", struct.pack("<q", rng.getrandbits(63)))[0] for _ in range(300)]
    values = [v for v in values if v == v]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for row in frame.select("v", ordered_bits(F.col("v")).alias("k")).collect():
        size = struct.unpack("<q", struct.pack("<d", abs(row["v"])))[0]
        assert row["k"] == (-size if row["v"] < 0 else size), row["v"]
    nan = spark.createDataFrame([(math.nan,), (math.inf,)], "v double").select(ordered_bits(F.col("v")).alias("k")).collect()
    assert nan[0]["k"] > nan[1]["k"]


def statistics(spark, values, kind, grouped=False):
    picks = {"low": low_pick(0.5), "high": high_pick(0.5), "p95": index_pick(0.95), "least": lambda n: F.lit(0).cast("bigint"),
             "largest": lambda n: n - 1}
    rows = [(k % 3, v) for k, v in enumerate(values)]
    frame = spark.createDataFrame(rows, f"g int, v {kind}").repartition(3)
    return rows, order_statistics(frame, "v", picks, ["g"] if grouped else [])


@pytest.mark.parametrize("grouped", [False, True])
@pytest.mark.parametrize("kind, values", [
    ("double", [k / 977 for k in range(977)] + [0.25] * 300),
    ("double", [-3.5] * 40),
    ("double", [(-1) ** k * 10.0 ** (k % 600 - 300) for k in range(900)]),
    ("bigint", [7] * 50),
    ("bigint", [k * 315_576_000_000_000_000 // 5 for k in range(-8, 9)] + list(range(500))),
    ("bigint", [-(1 << 63), (1 << 63) - 1, 0, -1, 1]),
    ("int", list(range(70_000, 0, -700)))])
def test_radix_selection(spark, kind, values, grouped):
    rows, stats = statistics(spark, values, kind, grouped)
    for r in stats.collect():
        held = sorted(v for g, v in rows if not grouped or g == r["g"])
        n = len(held)
        assert (r["n"], r["least"], r["largest"]) == (n, held[0], held[-1])
        assert (r["low"], r["high"]) == (held[(n - 1) // 2], held[n // 2])
        assert r["p95"] == held[min(n - 1, int(0.95 * n))]


def test_radix_selection_of_nothing_and_of_nulls(spark):
    none = spark.createDataFrame([(None,), (None,)], "v double")
    assert [tuple(r) for r in order_statistics(none, "v", {"p": index_pick(0.5)}).collect()] == [(None, None)]
    some = spark.createDataFrame([(None,), (2.5,)], "v double")
    assert tuple(order_statistics(some, "v", {"p": index_pick(0.5)}).first()) == (1, 2.5)


def test_small_groups_are_shuffled_once_and_large_ones_are_not_gathered(spark):
    rows = [(k % 7 if k % 2 else 9, k * 31 % 1009 / 8) for k in range(1500)]  # half of the rows in group 9
    frame = spark.createDataFrame(rows, "g int, v double").repartition(3)
    picks = {"low": low_pick(0.99), "high": high_pick(0.99)}
    alone = order_statistics(frame, "v", picks, ["g"])
    assert alone._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0
    mixed = order_statistics(frame, "v", picks, ["g"], sorted_rows=400)
    for stats in (alone, mixed, order_statistics(frame, "v", picks, ["g"], sorted_rows=1)):
        found = {r["g"]: tuple(r)[1:] for r in stats.collect()}
        for g in {g for g, _ in rows}:
            held = sorted(v for other, v in rows if other == g)
            n = len(held)
            assert found.pop(g) == (n, held[math.floor(0.99 * (n - 1))], held[math.ceil(0.99 * (n - 1))])
        assert not found
    assert "LeftAnti" in mixed._jdf.queryExecution().optimizedPlan().toString()


def iso(ms):
    from datetime import datetime, timezone
    return datetime.fromtimestamp(ms / 1000, timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.") + f"{ms % 1000:03d}Z"


NOW = 1_741_106_074_300


def busy(spark, n=240):
    """Many events of few keys, a third of them of one, most of them not accepted."""
    rng = random.Random(n)
    made = []
    for k in range(n):
        ident = f"{DID}/hot" if rng.random() < 0.35 else f"{DID}/r{rng.randrange(12)}"
        made.append(event(ident=ident, revision=f"3kabc2dd{rng.randrange(32 ** 2):04d}2".replace("0", "a").replace("1", "b").replace("8", "c").replace("9", "d"),
                          received=iso(NOW - rng.randrange(0, 9_000_000))))
    return log(spark, *made, account(41, "active", received=iso(NOW - 10)))


@pytest.mark.parametrize("ahead, most", [(1, 3_200), (4, 3_200), (2, 10)])
@pytest.mark.parametrize("limit", [1, 7, 200])
def test_candidates_give_the_index_that_the_whole_log_gives(spark, ahead, most, limit, monkeypatch):
    monkeypatch.setattr(act, "AHEAD", max(2, ahead))
    monkeypatch.setattr(act, "MOST_CANDIDATES", most)
    rows = busy(spark)
    want = act.recent(Q.activity_index(rows), NOW, limit).orderBy("activity_key").collect()
    got = act.newest_entries(rows, NOW, limit).orderBy("activity_key").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_the_index_of_a_window_equals_that_of_the_log(spark):
    rows = busy(spark)
    want = Q.activity_index(rows).filter(act.in_window(F.col("received_ms"), NOW)).collect()
    assert sorted(map(tuple, act.window_index(rows, NOW).collect())) == sorted(map(tuple, want))


def test_the_activity_answer_judges_without_a_window_over_the_log(spark):
    answer = Q.activity_answer(busy(spark), NOW, 5)
    plan = answer._jdf.queryExecution().optimizedPlan().toString()
    assert json.loads(answer.select(F.to_json("records").alias("r")).first()["r"])
    assert plan.count("Window") <= 2  # over the accounts of at most 200 keys


def test_a_million_rows_of_one_key_leave_only_what_is_emitted():
    from lastword.streaming import newest as st
    rows = ({"offset": k, "revision": f"{(k * 7919) % 1_000_003:07d}"} for k in range(200_000))
    seen, top = [], ""

    class Value:
        def exists(self):
            return False

        def update(self, value):
            self.held = value

    processor = st.PreserveNewest()
    processor.latest = Value()
    got = [r["offset"] for r in processor.handleInputRows(None, rows, None)]
    for k in range(200_000):
        revision = f"{(k * 7919) % 1_000_003:07d}"
        if revision > top:
            seen.append(k)
            top = revision
    assert got == seen and processor.latest.held == (top,)


def test_settings_name_the_slot():
    assert settings.SLOT_MS > 0 and POST
