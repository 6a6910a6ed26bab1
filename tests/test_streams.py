import datetime

from pyspark.sql import functions as F

from terrace.plans.layers import BRONZE
from terrace.sources.places import new_dir
from terrace.sources.tables import read_table, snapshot_of, stream_table
from terrace.sources.topics import envelope, read_topic, to_records, write_topic
from terrace.streaming.streams import dedup_stream, set_aside, start_append, start_upsert


def send(spark, topic, data):
    start = datetime.datetime(2024, 1, 1)
    stamped = [(k, v, start + datetime.timedelta(minutes=m)) for k, v, m in data]
    df = spark.createDataFrame(stamped, "k int, v int, at timestamp")
    write_topic(to_records(df, at=F.col("at"), skip=("at",)), topic)


def parsed(bronze):
    data = F.from_json("kafka_value", "k int, v int")
    return bronze.select(data.alias("d"), "kafka_timestamp").select("d.*", "kafka_timestamp")


def test_a_stream_gives_what_a_batch_gives_and_runs_once(spark, rows):
    topic, bronze, silver = (new_dir(spark, n) for n in ("topic", "bronze", "silver"))
    checks = [new_dir(spark, "check") for _ in range(2)]

    def drain():
        raw = envelope(read_topic(spark, topic, per_trigger=1), "t")
        start_append(raw, bronze, checks[0], ["ingest_date"]).awaitTermination()
        once = dedup_stream(parsed(stream_table(spark, bronze, BRONZE, per_trigger=5)), ["k"], "kafka_timestamp")
        start_append(once, silver, checks[1]).awaitTermination()
        return rows(read_table(spark, silver), "k", "v")

    send(spark, topic, [(i % 50, i % 50, 0) for i in range(150)])
    want = [(i, i) for i in range(50)]
    assert drain() == want
    assert drain() == want
    send(spark, topic, [(0, 99, 5), (60, 60, 5)])
    assert drain() == [*want, (60, 60)]


def test_rows_behind_the_watermark_are_dropped(spark, rows):
    topic, silver, check = (new_dir(spark, n) for n in ("topic", "silver", "check"))
    for data in ([(1, 1, 600)], [(2, 2, 580)], [(3, 3, 60)]):
        send(spark, topic, data)
        once = dedup_stream(parsed(envelope(read_topic(spark, topic), "t")), ["k"], "kafka_timestamp")
        start_append(once, silver, check).awaitTermination()
    assert rows(read_table(spark, silver), "k") == [(1,), (2,)]


def test_upsert_keeps_the_newest_row_across_batches(spark, rows):
    topic, table, check = (new_dir(spark, n) for n in ("topic", "table", "check"))

    def drain():
        stream = parsed(envelope(read_topic(spark, topic), "t"))
        start_upsert(stream, table, check, ["k"], "kafka_timestamp").awaitTermination()
        return rows(read_table(spark, table), "k", "v")

    send(spark, topic, [(1, 10, 5), (1, 11, 9), (2, 20, 1)])
    assert drain() == [(1, 11), (2, 20)]
    send(spark, topic, [(1, 12, 7), (2, 21, 2), (3, 30, 0)])
    assert drain() == [(1, 11), (2, 21), (3, 30)]
    version = snapshot_of(spark, table).version
    assert drain() == [(1, 11), (2, 21), (3, 30)]
    assert snapshot_of(spark, table).version == version


def test_a_replayed_batch_changes_nothing(spark, rows):
    """The checkpoint is lost after the table was written: the same batch comes again."""
    topic, table = new_dir(spark, "topic"), new_dir(spark, "table")
    send(spark, topic, [(1, 10, 5)])
    for _ in range(2):
        stream = parsed(envelope(read_topic(spark, topic), "t"))
        start_upsert(stream, table, new_dir(spark, "check"), ["k"], "kafka_timestamp").awaitTermination()
    assert rows(read_table(spark, table), "k", "v") == [(1, 10)]


def test_records_left_out_are_set_aside(spark, rows):
    """Repeated and late records, also with null keys and times: with the kept ones they are all."""
    records = [(1, 5, "a"), (1, 5, "b"), (1, 9, "c"), (2, 1, "late"), (2, 1, "late"), (3, None, "x"), (3, None, "x"), (None, 4, "n"), (None, 4, "m")]
    df = spark.createDataFrame(records, "k int, at int, v string")
    kept = spark.createDataFrame([(1, 5, "a"), (3, None, "x"), (None, 4, "n")], "k int, at int, v string")
    aside = set_aside(df, kept, ["k"], "at")
    got = [(r.k, r.at, r.reason) for r in aside.collect()]
    assert sorted(got, key=str) == sorted(
        [(1, 5, "repeated"), (1, 9, "repeated"), (2, 1, "late"), (2, 1, "late"), (3, None, "repeated"), (None, 4, "repeated")], key=str
    )
    assert set_aside(df, kept.limit(0), ["k"], "at").filter("reason = 'late'").count() == len(records)
    assert set_aside(kept, kept, ["k"], "at").count() == 0
