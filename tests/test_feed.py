"""Change feeds of merged tables, and streams that are limited by records."""

import pytest
from compare import difference, duck

from terrace.operators.write import write_merge, write_overwrite, write_replace
from terrace.plans.layers import Layers, run_bronze, run_stage
from terrace.queries import ORACLE, QUERIES
from terrace.sources import tables
from terrace.sources.places import new_dir
from terrace.sources.tables import read_table, snapshot_of, stream_table
from terrace.sources.topics import to_records, write_topic
from terrace.specs import Source, TableSpec
from terrace.streaming.streams import start_append

SCHEMA = "k int, p string, v int"


@pytest.fixture
def place(spark):
    class Place:
        path, out, checkpoint = (new_dir(spark, n) for n in ("table", "out", "check"))

        def merge(self, *data, **more):
            write_merge(spark.createDataFrame(data, SCHEMA), self.path, ["k"], ["p"], **more)

        def drain(self):
            start_append(stream_table(spark, self.path, None), self.out, self.checkpoint).awaitTermination()
            return sorted(tuple(r) for r in read_table(spark, self.out).collect())

    return Place()


def test_feed_has_what_is_new_or_changed(spark, place):
    place.merge((1, "a", 1), (2, "a", 2), (3, None, 3), feed=True)
    start_append(stream_table(spark, place.path, None), place.out, place.checkpoint).awaitTermination()
    place.merge((1, "a", 1), (2, "a", 20), (4, "b", 4))  # one as it is
    place.merge((1, "a", 1))  # no change
    got = read_table(spark, place.out)
    start_append(stream_table(spark, place.path, None), place.out, place.checkpoint).awaitTermination()
    got = sorted((r.k, r.v) for r in read_table(spark, place.out).collect())
    assert got == [(1, 1), (2, 2), (2, 20), (3, 3), (4, 4)]
    write_replace(spark.createDataFrame([(9, "a", 9), (2, "a", 20)], SCHEMA), place.path, ["p"], ["p"])
    write_overwrite(spark.createDataFrame([(9, "a", 9), (5, "c", 5)], SCHEMA), place.path, ["p"])
    start_append(stream_table(spark, place.path, None), place.out, place.checkpoint).awaitTermination()
    more = sorted((r.k, r.v) for r in read_table(spark, place.out).collect())
    assert sorted([*got, (5, 5), (9, 9)]) == more
    with pytest.raises(ValueError, match="differ"):
        write_overwrite(spark.range(3), place.path)


def test_feed_of_a_table_that_had_none_begins_with_all_of_it(spark, place):
    place.merge((1, "a", 1), (2, "b", 2))
    with pytest.raises(ValueError, match="no change feed"):
        place.drain()
    place.merge((2, "b", 3), feed=True)
    assert place.drain() == [(1, "a", 1), (2, "b", 3)]


def test_failed_writes_leave_no_changes_and_late_names_are_made_up_for(spark, place, monkeypatch):
    place.merge((1, "a", 1), feed=True)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:  # before the version counts
        m.setattr(tables, "swap_text", fail)
        with pytest.raises(OSError):
            place.merge((2, "a", 2))
    assert place.drain() == [(1, "a", 1)]
    with monkeypatch.context() as m:  # the version counts, its changes have no name yet
        m.setattr(tables, "publish_changes", fail)
        with pytest.raises(OSError):
            place.merge((3, "a", 3))
    assert snapshot_of(spark, place.path).version == 2
    assert place.drain() == [(1, "a", 1), (3, "a", 3)]
    place.merge((4, "a", 4))
    assert place.drain() == place.drain() == [(1, "a", 1), (3, "a", 3), (4, "a", 4)]


@pytest.mark.parametrize("known", [True, False])
def test_two_rows_for_one_key_are_an_error(spark, place, known):
    if known:
        place.merge((1, "a", 1))
    with pytest.raises(ValueError, match="several rows for one key"):
        place.merge((1, "a", 2), (1, "a", 3))
    with pytest.raises(ValueError, match="several rows for one key"):
        place.merge((None, "a", 2), (None, "a", 2))
    place.merge((1, "a", 2), (1, "b", 3))  # the partition belongs to the key
    assert read_table(spark, place.path).count() == 2


def test_silver_streams_read_merged_silver(spark, rows):
    layers = Layers.under(new_dir(spark, "layers"))
    record = "k int, v int, at timestamp"
    first = TableSpec(
        name="state", layer="silver", sources=(Source("topic", "t", record),), keys=("k",), mode="stream", strategy="merge", feed=True
    )
    second = TableSpec(
        name="history", layer="silver", sources=(Source("silver", "state"),), keys=("k", "v"), mode="stream", strategy="append"
    )
    for data in ([(1, 1, 0), (2, 1, 0)], [(1, 2, 5), (2, 1, 5)], [(3, 1, 6)]):
        df = spark.createDataFrame(data, "k int, v int, m int").selectExpr("k", "v", "timestamp_seconds(1700000000 + 60 * m) AS at")
        write_topic(to_records(df, at=df["at"]), f"{layers.topics}/t")
        run_bronze(spark, layers, ["t"], records=1)
        run_stage(spark, layers, [first, second])
    assert rows(read_table(spark, layers.path("silver", "state")), "k", "v") == [(1, 2), (2, 1), (3, 1)]
    assert rows(read_table(spark, layers.path("silver", "history")), "k", "v") == [(1, 1), (1, 2), (2, 1), (3, 1)]


def test_feed_is_for_merged_tables(spark):
    with pytest.raises(ValueError, match="change feed"):
        TableSpec(name="x", layer="silver", sources=(Source("silver", "y"),), keys=("k",), feed=True)


def test_changes_to_equal_balances_count(spark, tmp_path):
    """Balances that a step sets to what they were: the SQL goes by the rows that a step sets."""
    con = duck("/root/testdata/sf0.001")
    balance = "CASE c_custkey % 4 WHEN 0 THEN -1.0 WHEN 1 THEN -11.0 WHEN 2 THEN 0.5 ELSE NULL END"
    con.execute(f"COPY (SELECT * REPLACE (CAST({balance} AS DOUBLE) AS c_acctbal) FROM customer) TO '{tmp_path}/customer.parquet'")
    found = QUERIES["stream_of_merged"](spark, str(tmp_path))
    assert difference(found, duck(str(tmp_path)), ORACLE["stream_of_merged"]) is None
