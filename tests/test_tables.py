import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from terrace.operators.serve import LoadError, load_all, refresh, refresh_jdbc
from terrace.operators.write import write_append, write_merge, write_overwrite, write_replace
from terrace.sources.places import new_dir
from terrace.sources.tables import partition_folder, read_table, snapshot_of, stream_table

SCHEMA = "id int, part string, v int"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_merge_updates_inserts_and_touches_only_its_partitions(spark, rows):
    path = new_dir(spark, "t")
    write_merge(frame(spark, [(1, "a", 1), (2, "b", 2), (3, "c", 3)]), path, ["id"], ["part"])
    update = frame(spark, [(1, "a", 10), (4, "b", 4)])
    for _ in range(2):
        write_merge(update, path, ["id"], ["part"])
        assert rows(read_table(spark, path)) == [(1, "a", 10), (2, "b", 2), (3, "c", 3), (4, "b", 4)]
    assert snapshot_of(spark, path).partitions == {"part=a": 3, "part=b": 3, "part=c": 1}


def test_merge_without_partitions_and_with_null_keys(spark, rows):
    path = new_dir(spark, "t")
    write_merge(frame(spark, [(1, None, 1), (2, "x", 2)]), path, ["id", "part"])
    write_merge(frame(spark, [(1, None, 5)]), path, ["id", "part"])
    assert rows(read_table(spark, path), "id", "v") == [(1, 5), (2, 2)]


def test_merge_keeps_newer_rows_and_knows_its_batches(spark, rows):
    path = new_dir(spark, "t")
    write_merge(frame(spark, [(1, "a", 5)]), path, ["id"], newer_by="v", batch=("s", "r", 0))
    write_merge(frame(spark, [(1, "a", 3), (2, "a", 1)]), path, ["id"], newer_by="v", batch=("s", "r", 1))
    assert rows(read_table(spark, path)) == [(1, "a", 5), (2, "a", 1)]
    write_merge(frame(spark, [(9, "z", 9)]), path, ["id"], newer_by="v", batch=("s", "r", 1))
    assert rows(read_table(spark, path), "id") == [(1,), (2,)]
    assert snapshot_of(spark, path).version == 2


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.integers(0, 5), st.integers(0, 99), min_size=1, max_size=4), min_size=1, max_size=3))
def test_merge_is_a_dictionary_update(spark, batches):
    path, model = new_dir(spark, "t"), {}
    for batch in batches:
        model |= batch
        write_merge(frame(spark, [(k, f"p{k % 2}", v) for k, v in batch.items()]), path, ["id"], ["part"])
    assert {r.id: r.v for r in read_table(spark, path).collect()} == model


def test_replace_takes_whole_slices_wherever_they_are(spark, rows):
    path = new_dir(spark, "t")
    write_overwrite(frame(spark, [(2024, "a", 1), (2024, "b", 2), (2025, "b", 3), (2026, "c", 4)]), path, ["part"])
    new = frame(spark, [(2024, "b", 20), (2025, "d", 30)])
    for _ in range(2):
        write_replace(new, path, ["id"], ["part"])
        assert rows(read_table(spark, path)) == [(2024, "b", 20), (2025, "d", 30), (2026, "c", 4)]
    assert set(snapshot_of(spark, path).partitions) == {"part=b", "part=c", "part=d"}


def test_replace_by_several_columns_means_their_combinations(spark, rows):
    path = new_dir(spark, "t")
    write_overwrite(frame(spark, [(1, "a", 1), (1, "b", 2), (2, "a", 3)]), path)
    write_replace(frame(spark, [(1, "b", 9), (2, "c", 8)]), path, ["id", "part"])
    assert rows(read_table(spark, path)) == [(1, "a", 1), (1, "b", 9), (2, "a", 3), (2, "c", 8)]


def test_an_empty_replacement_changes_nothing(spark, rows):
    path = new_dir(spark, "t")
    write_replace(frame(spark, []), path, ["id"])
    write_overwrite(frame(spark, [(1, "it's", 1)]), path)
    write_replace(frame(spark, []), path, ["id"])
    assert rows(read_table(spark, path)) == [(1, "it's", 1)]


def test_readers_keep_the_state_they_opened(spark, rows):
    path = new_dir(spark, "t")
    write_overwrite(frame(spark, [(1, "a", 1)]), path)
    before = read_table(spark, path)
    write_overwrite(frame(spark, [(2, "b", 2)]), path)
    assert rows(before) == [(1, "a", 1)]
    assert rows(read_table(spark, path)) == [(2, "b", 2)]


def test_a_failing_write_leaves_the_table_as_it_was(spark, rows):
    path = new_dir(spark, "t")
    write_overwrite(frame(spark, [(1, "a", 1)]), path)
    broken = frame(spark, [(2, "b", 0)]).selectExpr("id", "part", "CAST(raise_error('x') AS int) AS v")
    with pytest.raises(Exception, match="x"):
        write_overwrite(broken, path)
    assert rows(read_table(spark, path)) == [(1, "a", 1)]
    write_overwrite(frame(spark, [(3, "c", 3)]), path)
    assert rows(read_table(spark, path)) == [(3, "c", 3)]


ODD = ["a/b=c %x:'é", "{[^]}", "q?*\"#\\", "", None, " sp ace ", "2024"]


def test_partition_folders_are_named_as_spark_names_them(spark, rows):
    path = new_dir(spark, "t")
    write_overwrite(frame(spark, [(i, p, i) for i, p in enumerate(ODD)]), path, ["part"])
    names = {partition_folder(["part"], Row(part=p or None)) for p in ODD}
    assert set(snapshot_of(spark, path).partitions) == names
    write_merge(frame(spark, [(i, p or None, i + 100) for i, p in enumerate(ODD)]), path, ["id"], ["part"])
    assert rows(read_table(spark, path), "v") == [(100 + i,) for i in range(len(ODD))]
    assert partition_folder(["b", "d"], Row(b=True, d=datetime.date(2024, 1, 2))) == "b=true/d=2024-01-02"


def test_plain_append_and_overwrite(spark, rows):
    path = new_dir(spark, "t")
    write_append(frame(spark, [(1, "a", 1)]), path, partition_by=["part"])
    write_append(frame(spark, [(2, "b", 2)]), path, partition_by=["part"])
    assert rows(read_table(spark, path), "id") == [(1,), (2,)]
    write_append(frame(spark, [(3, "b", 2)]), path, "overwrite", ["part"])
    assert rows(read_table(spark, path), "id") == [(3,)]


def test_refresh_verifies_what_arrived(spark):
    df, sink = frame(spark, [(1, "a", 1), (2, "b", 2)]), []
    assert refresh(df, lambda d: sink.extend(d.collect()), lambda: len(sink)) == 2
    with pytest.raises(LoadError, match="expected 2 rows, the sink has 1"):
        refresh(df, lambda d: None, lambda: 1)
    assert refresh(df, lambda d: None, lambda: 1, verify=False) is None


def test_load_all_goes_on_and_reports(spark):
    loaded = []

    def load(name):
        if name == "bad":
            raise ValueError("no such table")
        loaded.append(name)

    with pytest.raises(LoadError, match="1 tables failed: bad: no such table"):
        load_all(["a", "bad", "b"], load)
    assert loaded == ["a", "b"]


def test_jdbc_refresh_asks_for_truncate_batches_and_few_connections(spark, monkeypatch):
    """No database is started here: only what goes to the writer is checked."""
    from pyspark.sql.readwriter import DataFrameWriter

    seen = {}
    monkeypatch.setattr(DataFrameWriter, "mode", lambda self, m: seen.update(mode=m) or self)
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, k, v: seen.update({k: v}) or self)
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, properties: seen.update(url=url, table=table))
    refresh_jdbc(frame(spark, [(1, "a", 1)]), "jdbc:x", "t", verify=False)
    assert seen == {
        "mode": "overwrite", "truncate": "true", "batchsize": 10_000, "numPartitions": 4,
        "url": "jdbc:x", "table": "t",
    }


def test_parts_must_have_the_columns_of_the_table(spark):
    path = new_dir(spark, "table")
    write_merge(frame(spark, [(1, "a", 1)]), path, ["id"])
    with pytest.raises(ValueError, match="extra"):
        write_merge(frame(spark, [(1, "a", 1)]).withColumn("extra", F.lit(1)), path, ["id"])


def test_a_new_run_of_a_stream_starts_over(spark, rows):
    path = new_dir(spark, "table")
    for run, v in (("a", 1), ("b", 2)):
        write_merge(frame(spark, [(v, "a", v)]), path, ["id"], batch=("s", run, 0))
    assert rows(read_table(spark, path), "id") == [(1,), (2,)]


def test_merged_table_is_no_stream_source(spark):
    path = new_dir(spark, "table")
    write_merge(frame(spark, [(1, "a", 1)]), path, ["id"])
    with pytest.raises(ValueError, match="replaced"):
        stream_table(spark, path, "id int")
