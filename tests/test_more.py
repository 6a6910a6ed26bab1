"""Mixed windows, variant payloads, digests by content and unique keys."""

import random

import pytest
from pyspark.sql import functions as F

from terrace.functions.keys import assign_keys, surrogate_key
from terrace.operators import temporal
from terrace.operators.serve import LoadError, content_digest, refresh
from terrace.operators.temporal import binned_by_level, level_join, range_join
from terrace.sources.payloads import variant_leaves, variant_records


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("join", [level_join, range_join])
def test_windows_of_mixed_length(spark, rows, how, join):
    rng = random.Random(1)
    windows = [(rng.randrange(3), i, s, s + 10.0 ** rng.randrange(-3, 5)) for i in range(150) for s in [rng.uniform(-50, 50)]]
    windows += [(0, 900, 1.0, 1.0), (0, 901, 3.0, 2.0), (0, 902, None, 2.0), (1, 903, 0.0, 1e6), (None, 904, 0.0, 9.0)]
    left = [(rng.choice([0, 1, 2, 7, None]), rng.uniform(-60, 60)) for _ in range(200)] + [(0, None), (1, 5.0), (1, 5.0)]
    l, r = spark.createDataFrame(left, "g int, t double"), spark.createDataFrame(windows, "g int, w int, s double, e double")
    want = []
    for g, t in left:
        hits = [w for k, w, s, e in windows if g is not None and t is not None and s is not None and k == g and s <= t < e]
        want += [(g, t, w) for w in hits] or ([(g, t, None)] if how == "left" else [])
    key = lambda x: tuple((v is None, v or 0) for v in x)
    got = sorted((tuple(x) for x in join(l, r, ["g"], "t", "s", "e", how).select("g", "t", "w").collect()), key=key)
    assert got == sorted(want, key=key)
    assert level_join(l, r.limit(0), ["g"], "t", "s", "e", how).count() == (len(left) if how == "left" else 0)


def test_rows_per_window_are_bounded(spark):
    """Over nine orders of magnitude every window is on two cells at most (three by rounding)."""
    df = spark.range(2000).select((F.rand(3) * 1e6).alias("s"), F.pow(F.lit(10.0), F.col("id") % 10 - 4).alias("n"))
    df = df.select("s", (F.col("s") + F.col("n")).alias("e"))
    binned = binned_by_level(df, "s", "e", 1e-4)
    assert binned.count() <= 2 * 2000 and binned.select("_level").distinct().count() <= 17
    assert temporal.LEVEL == 4.0


def shuffled(plan):
    """Rows that the exchanges of an executed plan have written."""
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        return shuffled(plan.executedPlan())
    if "QueryStage" in plan.nodeName():
        return shuffled(plan.plan())
    own = plan.metrics().apply("shuffleRecordsWritten").value() if plan.nodeName() == "Exchange" else 0
    return own + sum(shuffled(plan.children().apply(i)) for i in range(plan.children().size()))


def test_rows_are_looked_up_on_levels_with_windows_only(spark):
    """Eight lengths of windows: a row is shuffled for what it finds, not for each of them."""
    rng = random.Random(4)
    windows = [(i % 20, s := rng.uniform(0, 1e6), s + 10.0 ** (i % 8 - 2)) for i in range(800)]
    rows = [(i % 20, rng.uniform(0, 1e6)) for i in range(4000)]
    l, r = spark.createDataFrame(rows, "g int, t double"), spark.createDataFrame(windows, "g int, s double, e double")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = level_join(l, r, ["g"], "t", "s", "e")
        found = len(joined.collect())
        assert shuffled(joined._jdf.queryExecution().executedPlan()) <= 2 * len(rows) + found + 6 * len(windows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_variant_records_and_leaves(spark, rows):
    bodies = [
        ('{"a": {"b c": [{"x": 1, "y": {"z": [true, null, "t"]}}, {"other": 1.5}, 7, null]}}', 1),
        ('{"a": {"b c": {}}}', 2), ("no json", 3), (None, 4), ('{"a": {"b c": []}}', 5),
    ]
    df = spark.createDataFrame(bodies, "body string, n int")
    records = variant_records(df, "body", ["a", "b c"], {"n": F.col("n")})
    assert records.columns == ["n", "place", "record"]
    assert rows(records, "n", "place") == [(1, 0), (1, 1), (1, 2), (1, 3)]
    leaves = variant_leaves(records.filter("place < 2"))
    assert sorted(tuple(r) for r in leaves.select("place", "path", F.coalesce("value", F.lit("-"))).collect()) == [
        (0, "x", "1"), (0, "y.z.0", "true"), (0, "y.z.1", "-"), (0, "y.z.2", "t"), (1, "other", "1.5")
    ]
    cut = variant_leaves(records.filter("place = 0"), levels=1)
    assert rows(cut, "path", "value") == [("x", "1"), ("y", '{"z":[true,null,"t"]}')]


def test_content_digest(spark):
    df = spark.createDataFrame([(1, "a", {"k": 1}), (2, None, None), (2, None, None)], "i int, s string, m map<string, int>")
    assert content_digest(df) == content_digest(df.repartition(3).select("m", "s", "i"))
    changed = [
        df.withColumn("s", F.when(F.col("i") == 2, "").otherwise(F.col("s"))),
        df.filter("i = 1").unionByName(df.filter("i = 1")).unionByName(df.filter("i = 2").limit(1)),
        df.withColumn("m", F.create_map(F.lit("k"), F.lit(2))),
    ]
    assert all(content_digest(c) != content_digest(df) for c in changed)
    two = spark.createDataFrame([(None, 1)], "a int, b int"), spark.createDataFrame([(1, None)], "a int, b int")
    assert content_digest(two[0]) != content_digest(two[1])
    assert content_digest(df.limit(0)) == (0, 0, 0)
    with pytest.raises(LoadError, match="not the same"):
        refresh(df, lambda _: None, changed[0].count, read=lambda: changed[0])
    assert refresh(df, lambda _: None, df.count, read=lambda: df) == 3


def test_keys_stay_unique_and_stable(spark):
    def keys(df):
        return {r.name: r.key for r in df.collect()}

    names = [(f"name {i}",) for i in range(220)]
    some = spark.createDataFrame(names[:60] * 2 + [(None,)], "name string")
    first = assign_keys(some, ["name"], bits=10)
    every = assign_keys(spark.createDataFrame(names, "name string"), ["name"], first, bits=10)
    a, b = keys(first), keys(every)
    assert len(a) == 60 and len(b) == 220 and len(set(b.values())) == 220 and a.items() <= b.items()
    assert keys(assign_keys(some, ["name"], bits=10)) == a
    plain = spark.createDataFrame(names, "name string")
    assert keys(assign_keys(plain, ["name"])) == keys(plain.withColumn("key", surrogate_key("name")))


def test_keys_in_dispute_are_settled_in_a_few_tries(spark, monkeypatch):
    """Also where there are more natural keys than keys of so many bits."""
    frame = type(spark.range(1))
    tries, checkpoint = [], frame.checkpoint

    def counted(df, *args, **options):
        tries.append(df)
        assert len(tries) <= 12
        return checkpoint(df, *args, **options)

    monkeypatch.setattr(frame, "checkpoint", counted)
    names = spark.range(100).select(F.format_string("name %d", "id").alias("name"))
    found = assign_keys(names, ["name"], bits=6).collect()
    assert len({r.name for r in found}) == len({r.key for r in found}) == len(found) == 100
