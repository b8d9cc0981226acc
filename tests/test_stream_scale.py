"""What streams cost as rows, keys and tasks grow: state calls, state partitions, pane files."""
import os
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import ts
from ubeat import stream_queries as sq
from ubeat.streaming import processors as P
from ubeat.streaming import ranking as sr


class Handle:
    """List states in memory; counts the calls and keeps the timers."""

    def __init__(self):
        self.calls, self.timers, self.lists = 0, set(), {}

    def getListState(self, name, schema):
        handle, rows = self, self.lists.setdefault(name, [])

        class State:
            def get(self):
                handle.calls += 1
                return iter(list(rows))

            def put(self, values):
                handle.calls += 1
                rows[:] = values

            def appendList(self, values):
                handle.calls += 1
                rows.extend(values)

            def clear(self):
                handle.calls += 1
                rows.clear()
        return State()

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.add(ms)


class Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_order_timeout_calls_the_store_per_bucket_not_per_order():
    handle, p = Handle(), P.OrderTimeout(T.LongType(), 10_000_000, "paid", "lonely", "timeout")
    p.init(handle)
    rows = [Row(order_id=k, us=k * 1000 + 5_000_000 * pay, pay=bool(pay), seq=2 * k + pay) for k in range(500) for pay in (0, 1) if pay < 1 + k % 2]
    list(p.handleInputRows((3,), iter(rows), Watermark(0)))
    first = list(p.handleExpiredTimer((3,), Watermark(4_000), None))
    assert first == []
    out = list(p.handleExpiredTimer((3,), Watermark(60_000), None))
    assert sorted((r.order_id, r.result) for r in out) == [(k, "paid" if k % 2 else "timeout") for k in range(500)]
    assert handle.calls < 30 and handle.lists["opened"] == [] == handle.lists["waiting"]


def test_login_pairs_of_a_bucket_equal_a_plain_model_over_many_batches():
    rng, handle, p = random.Random(4), Handle(), P.LoginFailPair(T.LongType(), 50, ["seq"], "x")
    p.init(handle)
    seq, last, want, got = 0, {}, [], []
    for _ in range(60):
        rows = []
        for _ in range(rng.randrange(1, 12)):
            seq += 1
            user, fail = rng.choice([None, *range(8)]), rng.random() < 0.6
            rows.append(Row(user_id=user, us=seq * 3, seq=seq, fail=fail))
            if fail and user in last and seq * 3 < last[user] + 50:
                want.append((user, last[user], seq * 3))
            if fail:
                last[user] = seq * 3
            else:
                last.pop(user, None)
        rng.shuffle(rows)
        got += [(r.user_id, r.first_us, r.last_us) for r in p.handleInputRows((0,), iter(rows), Watermark(0))]
        # Changes do not pile up: at most twice the keys and a batch.
        assert sum(len(c[0]) for c in handle.lists["last"]) <= 2 * 9 + 12
    assert got == want and want


def test_state_partitions_do_not_grow_with_the_rows_for_ever(spark, tmp_path, monkeypatch):
    class Seen(Exception):
        pass

    def seen(_, partitions):
        raise Seen(partitions)
    spark.range(200).select(F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id)").alias("ts")) \
        .write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(sq, "keyed_state", seen)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "500")
    try:
        for rows, want in ((1, 48), (50, 4), (1000, 1)):
            monkeypatch.setattr(sq, "STATE_ROWS", rows)
            with pytest.raises(Seen) as found:
                sq._replay(spark, str(tmp_path), "t", lambda ev: ev)
            assert found.value.args == (want,)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_an_epoch_of_panes_runs_its_batch_once_and_writes_few_files(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            runs.add(len(f))
            yield f
    hours, tasks = 30, 8
    data = [(ts(1_600_000_000 // 3600 * 3600 + h * 3600 + m * 60), f"/{m}", 1, ts(1_600_000_000 + h * 3600)) for h in range(hours) for m in range(tasks * 4)]
    batch = spark.createDataFrame(data, "pane timestamp_ntz, url string, cnt long, seen timestamp_ntz").repartition(tasks)
    batch = batch.mapInPandas(count, batch.schema)
    sr.revised_top_n(str(tmp_path / "r"), 3, "10 minutes", "5 minutes")(batch, 0)
    assert runs.value == len(data)
    files = [f for d, _, names in os.walk(tmp_path / "r" / "panes") for f in names if f.endswith(".parquet")]
    assert len(files) <= hours + tasks
    assert spark.read.parquet(str(tmp_path / "r" / "ranked")).where("row_num = 1").count() > hours
