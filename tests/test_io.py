import pytest
from pyspark.sql import functions as F

from conftest import rows, ts
from ubeat.operators.logins import login_fail_pair, login_fail_timer
from ubeat.sources import text
from ubeat.sources.kafka import kafka_sink_options, kafka_source_options
from ubeat.sources.sinks import side_output, write_tagged
from ubeat.streaming.stateful import stream_login_fail_pair, stream_login_fail_timer


def test_kafka_option_builders():
    assert kafka_source_options("h:9092", "a") == {"kafka.bootstrap.servers": "h:9092", "subscribe": "a",
                                                  "startingOffsets": "latest"}
    assert kafka_sink_options("h:9092", "a") == {"kafka.bootstrap.servers": "h:9092", "topic": "a"}


def test_write_tagged_batch_and_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, "matched"), (2, "unmatched_pay"), (3, "matched")], "id long, tag string")
    out = str(tmp_path / "out")
    write_tagged(df, out, mode="overwrite")
    back = spark.read.parquet(out)
    assert rows(back, "id", "tag") == [(1, "matched"), (2, "unmatched_pay"), (3, "matched")]
    assert rows(side_output(back, "unmatched_pay"), "id") == [(2,)]
    # Stream: the same rows through a file source, one pass, partitioned by tag.
    src = str(tmp_path / "src")
    df.write.parquet(src)
    s = spark.readStream.schema(df.schema).parquet(src)
    q = write_tagged(s, str(tmp_path / "sout"), checkpoint=str(tmp_path / "ck"), trigger={"availableNow": True})
    q.awaitTermination(120)
    assert rows(spark.read.parquet(str(tmp_path / "sout")), "id", "tag") == rows(back, "id", "tag")


def _login_files(tmp_path, first, second):
    (tmp_path / "logins").mkdir()
    (tmp_path / "logins" / "part-0.csv").write_text(first)
    (tmp_path / "logins" / "part-1.csv").write_text(second)
    return str(tmp_path / "logins")


def _lines(user, start, n, event="fail"):
    return "".join(f"{user},10.0.0.{i % 9},{event},{start + 10 * i}\n" for i in range(n))


@pytest.mark.parametrize("sizes", [(1, 40), (40, 1)])
def test_seq_is_arrival_order_over_files_of_unequal_size(spark, tmp_path, sizes):
    path = _login_files(tmp_path, _lines(7, 1000, sizes[0]), _lines(7, 5000, sizes[1]))
    got = text.read_logins(spark, path).orderBy("seq").select("seq", F.unix_micros(F.col("ts").cast("timestamp"))).collect()
    times = [1000 + 10 * i for i in range(sizes[0])] + [5000 + 10 * i for i in range(sizes[1])]
    assert [(r[0], r[1] // 10**6) for r in got] == list(enumerate(times))


def test_seq_when_a_file_is_read_in_splits(spark, tmp_path):
    path = _login_files(tmp_path, _lines(7, 1000, 500), _lines(8, 1000, 3))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        df = text.read_logins(spark, path)
        assert df.rdd.getNumPartitions() > 3
        got = df.orderBy("seq").select("seq", "user_id", "ts").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.seq for r in got] == list(range(503))
    assert [r.ts for r in got[:500]] == sorted(r.ts for r in got[:500]) and [r.user_id for r in got[500:]] == [8] * 3


def test_login_alarms_from_a_stream_of_text(spark, tmp_path):
    path = _login_files(tmp_path, _lines(7, 1000, 3) + _lines(7, 1031, 1, "success"), _lines(7, 1040, 2) + _lines(9, 9999, 1, "success"))
    cols = ("user_id", "first_fail", "last_fail", "msg")
    want = rows(login_fail_pair(text.read_logins(spark, path), "15 seconds"), *cols)
    logins = text.read_logins(spark, path, stream=True)

    def run(df, name):
        q = (df.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name))
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return rows(spark.table(name), *cols)
    got = run(stream_login_fail_pair(logins, "15 seconds", seq=["file", "seq"]), "text_pairs")
    assert got == want and len(got) == 3
    timer = run(stream_login_fail_timer(logins, 2, "25 seconds", seq=["file", "seq"], delay="0 seconds"), "text_timer")
    assert timer == rows(login_fail_timer(text.read_logins(spark, path), 2, "25 seconds"), *cols) and timer
