import pytest
from pyspark.sql import functions as F

from terrace.plans.layers import Layers, StageError, build, malformed, ordered, run_all, run_bronze, run_stage
from terrace.plans.racing import RECORDS, TOPICS, gold_specs, silver_specs
from terrace.sources.places import new_dir, shared_dir
from terrace.sources.tables import read_table
from terrace.sources.topics import to_records, write_topic
from terrace.specs import Source, TableSpec

TOPIC = Source("topic", "t", "Id int, Name string")


def spec(name, sources=(TOPIC,), **more):
    return TableSpec(**{"name": name, "layer": "silver", "sources": sources, "keys": ("id",), **more})


@pytest.mark.parametrize(
    "wrong",
    [
        {"mode": "stream", "strategy": "dynamic_overwrite", "replace_by": ("id",)},
        {"mode": "stream", "strategy": "overwrite"},
        {"strategy": "dynamic_overwrite"},
        {"keys": ()},
        {"sources": (TOPIC, TOPIC)},
        {"sources": (Source("topic", "t"),)},
    ],
)
def test_wrong_specs_are_refused(wrong):
    with pytest.raises(ValueError, match="X: "):
        spec("X", **wrong)


def test_tables_come_after_what_they_read():
    names = [(s.layer, s.name) for s in ordered([*gold_specs(), *silver_specs()])]
    at = {n: i for i, n in enumerate(names)}
    assert at["silver", "XWALK_CONSTRUCTOR"] < at["silver", "XWALK_DRIVER"] < at["gold", "FACT_RESULT"]
    assert at["silver", "FACT_LAP"] < at["gold", "FACT_LAP"] < at["gold", "FACT_TELEMETRY"]
    assert len(names) == 16 + 8 and set(RECORDS) == set(TOPICS)


def test_watermark_only_for_appended_streams(spark):
    stream = spark.readStream.format("rate").load().select(
        F.col("value").alias("Id"), F.col("timestamp").alias("kafka_timestamp")
    )
    plans = {
        strategy: build(spec("X", mode="stream", strategy=strategy), {"t": stream})
        ._jdf.queryExecution().analyzed().toString()
        for strategy in ("append", "merge")
    }
    assert "EventTimeWatermark" in plans["append"] and "Deduplicate" in plans["append"]
    assert "EventTimeWatermark" not in plans["merge"]


def test_batch_keeps_the_newest_keyed_row(spark, rows):
    df = spark.createDataFrame(
        [(1, "old", 1), (1, "new", 2), (None, "x", 9)], "Id int, Name string, kafka_timestamp int"
    )
    assert rows(build(spec("X"), {"t": df}), "id", "name") == [(1, "new")]


def test_a_stage_goes_on_past_a_failure_and_reports_it(spark, rows):
    layers = Layers.under(new_dir(spark, "layers"))
    df = spark.createDataFrame([(1, "a"), (2, "b")], "Id int, Name string")
    write_topic(to_records(df), f"{layers.topics}/t")
    run_bronze(spark, layers, ["t"])
    specs = [
        spec("C", (Source("silver", "B"),), layer="gold"),
        spec("B", (Source("silver", "A"),), transform=lambda s: s["A"].select("nothing")),
        spec("A", strategy="merge"),
    ]
    with pytest.raises(StageError, match="2 tables failed: B, C") as e:
        run_stage(spark, layers, specs)
    status = {r.table: r.status for r in e.value.results.collect()}
    assert status == {"A": "ok", "B": "failed", "C": "skipped"}
    assert rows(read_table(spark, layers.path("silver", "A")), "id", "name") == [(1, "a"), (2, "b")]
    only = run_stage(spark, layers, specs, only={"A"})
    assert [(r.table, r.status) for r in only.collect()] == [("A", "ok")]
    assert run_stage(spark, layers, specs, allow_partial=True).count() == 3


def test_bronze_goes_on_past_a_missing_topic_and_all_layers_share_a_report(spark, rows):
    layers = Layers.under(new_dir(spark, "layers"))
    write_topic(to_records(spark.createDataFrame([(1, "a")], "Id int, Name string")), f"{layers.topics}/t")
    with pytest.raises(StageError, match="1 tables failed: missing") as e:
        run_bronze(spark, layers, ["missing", "t"])
    assert {r.table: r.status for r in e.value.results.collect()} == {"missing": "failed", "t": "ok"}
    specs = [spec("B", (Source("silver", "A"),), layer="gold"), spec("A", strategy="merge")]
    with pytest.raises(StageError):
        run_all(spark, layers, ["missing", "t"], specs)
    results = run_all(spark, layers, ["missing", "t"], specs, allow_partial=True)
    assert rows(results, "layer", "table", "status") == [
        ("bronze", "missing", "failed"), ("bronze", "t", "ok"), ("gold", "B", "ok"), ("silver", "A", "ok"),
    ]
    assert rows(read_table(spark, layers.path("gold", "B")), "id", "name") == [(1, "a")]


def test_the_shared_folder_is_the_one_the_session_names(spark):
    place = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == place
    assert new_dir(spark, "x").startswith(place)


def test_gold_goes_to_the_serving_database_table_by_table(spark, rows, monkeypatch):
    """No database is started here: what is handed to the JDBC refresh is checked."""
    from terrace.plans import layers as module

    layers = Layers.under(new_dir(spark, "layers"))
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    specs = [spec(name, layer="gold") for name in ("DIM_A", "DIM_B")]
    for s in specs:
        module.write_overwrite(df, layers.path("gold", s.name))
    loaded = []
    monkeypatch.setattr(
        module, "refresh_jdbc", lambda d, url, table, *rest: loaded.append((url, table, rows(d)))
    )
    module.load_gold(spark, layers, specs, "jdbc:x")
    assert loaded == [("jdbc:x", "dim_a", [(1, "a")]), ("jdbc:x", "dim_b", [(1, "a")])]
    with pytest.raises(ValueError, match="DIM_C"):
        module.load_gold(spark, layers, specs, "jdbc:x", only={"DIM_C"})


@pytest.mark.parametrize("mode, strategy", [("batch", "merge"), ("batch", "append"), ("stream", "append"), ("stream", "merge")])
def test_all_layers_take_the_format(spark, rows, mode, strategy):
    layers = Layers.under(new_dir(spark, "layers"), fmt="orc")
    silver = spec("A", mode=mode, strategy=strategy, partition_by=("name",))
    gold = [
        spec("B", (Source("silver", "A"),), layer="gold", newest_first=()),
        spec("C", (Source("gold", "B"),), layer="gold", newest_first=(), strategy="dynamic_overwrite", replace_by=("id",)),
    ]
    for batch in ([(1, "a"), (2, "b")], [(3, "c")]):
        write_topic(to_records(spark.createDataFrame(batch, "Id int, Name string")), f"{layers.topics}/t")
        if strategy == "append" and mode == "batch" and batch[0][0] == 3:
            break  # a second batch run of an append would add everything again
        run_all(spark, layers, ["t"], [silver, *gold])
    want = [(1, "a"), (2, "b")] + ([] if (mode, strategy) == ("batch", "append") else [(3, "c")])
    for s in (silver, *gold):
        path = layers.path(s.layer, s.name)
        assert rows(read_table(spark, path, "orc"), "id", "name") == want
        files = read_table(spark, path, "orc").inputFiles()
        assert files and all(f.endswith(".orc") for f in files)


def test_malformed_records_are_set_aside_once(spark, rows):
    layers = Layers.under(new_dir(spark, "layers"))
    texts = ['{"Id": 1, "Name": "a"}', '{"Id": 2', "[]x", '{"Id": "no"}', "", None, "{}", '{"Id": 3, "more": 1}']
    sent = spark.createDataFrame([(None, t, None) for t in texts], "key string, value string, timestamp timestamp")
    write_topic(sent, f"{layers.topics}/t")
    for _ in range(2):
        results = run_all(spark, layers, ["t"], [spec("A", strategy="merge")], quarantine=True)
        assert ("silver", "quarantine/A-t", "ok") in rows(results, "layer", "table", "status")
    bad = read_table(spark, layers.path("silver", "quarantine/A-t"))
    assert rows(bad, "kafka_value") == sorted([('{"Id": 2',), ("[]x",), ('{"Id": "no"}',)])
    assert rows(malformed(spark, layers, TOPIC), "kafka_value") == rows(bad, "kafka_value")
    assert rows(read_table(spark, layers.path("silver", "A")), "id", "name") == [(1, "a"), (3, None)]
    with pytest.raises(StageError, match="quarantine/A-gone"):
        run_all(spark, layers, ["t"], [spec("A", (Source("topic", "gone", "Id int"),))], quarantine=True)
