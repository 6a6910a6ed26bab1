import datetime
import json

import pytest
from pyspark.sql import functions as F

from terrace.plans.racing import extract
from terrace.sources.pages import cell, html_rows
from terrace.sources.payloads import payload_records
from terrace.sources.places import new_dir
from terrace.sources.schedule import nth_row, pick_rounds
from terrace.sources.topics import envelope, read_topic, to_records, write_topic


def page(spark, html, **more):
    names = list(more)
    return spark.createDataFrame([(html, *more.values())], ["html", *names])


def test_payload_path_and_tags(spark, rows):
    body = {"RaceTable": {"Races": [{"Results": [{"n": "1"}, {"n": "2"}]}, {"Results": [{"n": "9"}]}]}}
    df = spark.createDataFrame([(json.dumps(body),), ("{}",), ("junk",), (None,)], "p string")
    got = payload_records(df, "p", ["RaceTable", "Races", 0, "Results"], "n string", {"source": F.lit("api")})
    assert rows(got) == [("1", "api"), ("2", "api")]


def test_api_records_take_their_tags(spark, rows):
    driver = {"driverId": "x", "familyName": "V"}
    result = {"number": "1", "Driver": driver, "Constructor": {"constructorId": "c"}}
    body = {"MRData": {"RaceTable": {"Races": [{"raceName": "A", "Results": [result]}]},
                       "DriverTable": {"Drivers": [driver]}}}
    df = spark.createDataFrame([(json.dumps(body), 2024, 3)], "p string, season int, round int")
    got = extract.api_records(df, "api_result", "p", F.lit("api"))
    assert rows(got.select("number", "Driver.driverId", "race_id", "source", "season")) == [("1", "x", "2024_3", "api", 2024)]
    assert rows(extract.api_records(df, "api_race", "p", F.lit("api")).select("raceName", "race_id")) == [("A", "2024_3")]
    assert rows(extract.api_records(df, "api_driver", "p", F.lit("api")).select("familyName", "source")) == [("V", "api")]
    assert rows(extract.api_records(df, "api_constructor", "p", F.lit("api"))) == []


def test_table_rows_of_a_page(spark, rows):
    html = """<table class="other"><tbody><tr><td>no</td></tr></tbody></table>
    <table class="wide datatable"><thead><tr><td>head</td></tr></thead><tbody>
      <tr><td> A &amp; B <a>one</a><a>two</a></td><td k="v">x<table><tr><td>inner</td></tr></table></td></tr>
      <tr><td>open<td>cells</tr>
    </tbody></table><table class="datatable"><tbody><tr><td>late</td></tr></tbody></table>"""
    df = page(spark, html, id=7).unionByName(page(spark, "<p>none</p>", id=8)).unionByName(
        spark.createDataFrame([(None, 9)], "html string, id bigint")
    )
    got = html_rows(df, "html", "datatable", ["id"])
    assert rows(got.select("id", "row", cell(0), cell(0, "link"), cell(1, "attr:k"), F.size("cells"))) == [
        (7, 0, "A & B onetwo", "one", "v", 2),
        (7, 1, "open", None, None, 2),
    ]


def html_table(kind, *bodies):
    """A table with one body per argument; a row is a list of cell tags."""
    inner = "".join("<tbody>" + "".join(f"<tr>{''.join(r)}</tr>" for r in body) + "</tbody>" for body in bodies)
    return f'<table class="{kind}">{inner}</table>'


def tds(*texts):
    return [f"<td>{t}</td>" for t in texts]


def test_site_pages(spark, rows):
    drivers = html_table("datatable", [tds("Ada Blau", "Nordwind &amp; Co", "Kolben", "3"), tds("Bo Rust", "Falke")], [tds("Total", "2", "", "")])
    got = extract.site_drivers(page(spark, drivers, season=1999), "html", F.lit("S"))
    assert got.columns == ["Driver", "Constructor", "Engine_Manufacturer", "Best_Result", "Source", "Season"]
    assert rows(got) == [
        ("Ada Blau", "Nordwind & Co", "Kolben", "3", "S", 1999),
        ("Bo Rust", "Falke", None, None, "S", 1999),
    ]
    cars = html_table("datatable", [tds("<a>Falke</a> F&nbsp;7", "-", "Kolben"), tds("<a>Nordwind</a> N2", "-", "Ventil")], [tds("x", "y", "z")])
    assert rows(extract.site_cars(page(spark, cars, season=1999), "html", F.lit("S"))) == [
        ("Falke", "Falke F 7", "Kolben", "S", 1999),
        ("Nordwind", "Nordwind N2", "Ventil", "S", 1999),
    ]
    teams = html_table("sortable", [['<td>Falke</td>', '<td sorttable_customkey="AAA">Land</td>', "<td>1971</td>"]], [tds("sum", "", "")])
    assert rows(extract.site_constructors(page(spark, teams), "html", F.lit("S"))) == [("Falke", "AAA", "1971", "S")]
    assert extract.site_engine_suppliers(page(spark, teams), "html", F.lit("S")).columns[0] == "Engine_Manufacturer"
    race = html_table("datatable", [tds("2", "44", "Ada Blau", "N2", "Kolben", "61", "1:01:01"), tds("ab", "7", "Bo Rust", "F7", "", "9", "")])
    assert rows(extract.site_results(page(spark, race, season=1999, round=4), "html", F.lit("S")), "Position", "Driver", "Total_lap", "Race_id") == [
        ("2", "Ada Blau", "61", "1999_4"),
        ("ab", "Bo Rust", "9", "1999_4"),
    ]


def test_cancelled_rounds_do_not_count(spark, rows):
    item = "ms-schedule-table__item"
    bodies = [("GP du Lac", ""), ("GP de la Lune", ""), ("GP d'Or", " canceled"), ("GP du Î-Sund", "")]
    html = '<table class="ms-schedule-table">' + "".join(
        f'<tbody class="{item}{extra}"><tr><td>no</td><td><span>{name}</span></td></tr></tbody>' for name, extra in bodies
    ) + "</table>"
    df = page(spark, html, season=1999)
    assert [rows(extract.round_slug(df, "html", n)) for n in (1, 2, 3, 4)] == [
        [(1999, "lac")],
        [(1999, "lune")],
        [(1999, "i-sund")],
        [],
    ]


def test_rounds_of_a_schedule(spark, rows):
    day = datetime.date
    df = spark.createDataFrame([(1, day(2024, 3, 1)), (2, day(2024, 3, 9)), (3, day(2024, 4, 1))], "n int, d date")
    today = F.lit("2024-04-01").cast("date")
    assert rows(pick_rounds(df, "all", "d", "n", today), "n") == [(1,), (2,)]
    assert rows(pick_rounds(df, "LATEST", "d", "n", today), "n") == [(2,)]
    assert rows(pick_rounds(df, "3", "d", "n", today), "n") == [(3,)]
    with pytest.raises(ValueError, match="some"):
        pick_rounds(df, "some", "d", "n", today)
    assert rows(nth_row(df, 2, ["d"], F.col("n") == 1), "n") == [(3,)]
    assert rows(nth_row(df, 9, ["d"], F.lit(False)), "n") == []


def test_records_go_through_a_topic(spark, rows):
    topic = new_dir(spark, "topic")
    at = datetime.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(1, "a", at), (2, None, at)], "id int, name string, at timestamp")
    assert write_topic(to_records(df, F.col("id"), F.col("at"), skip=("at",)), topic) == 2
    assert write_topic(to_records(df.limit(0)), topic) == 0
    bronze = envelope(read_topic(spark, topic, stream=False), "t")
    assert bronze.columns == ["kafka_key", "kafka_value", "kafka_timestamp", "ingest_time", "ingest_date", "topic"]
    assert rows(bronze, "kafka_key", "kafka_value", "topic") == [
        ("1", '{"id":1,"name":"a"}', "t"),
        ("2", '{"id":2}', "t"),
    ]


def test_buckets_serve_windows_and_joins_without_a_shuffle(spark):
    from terrace.operators.temporal import fill_gaps
    from terrace.sources import buckets
    from terrace.sources.buckets import read_bucketed, write_bucketed
    from terrace.sources.places import new_dir

    laps = spark.range(300).selectExpr("id % 7 AS session", "id % 3 AS car", "id AS lap", "IF(id % 2 = 0, id * 1.0, null) AS s", "id + 1.0 AS e", "1.0 AS n")
    names = spark.range(7).selectExpr("id AS session", "concat('session ', id) AS name")
    path, other = new_dir(spark, "laps"), new_dir(spark, "names")
    a, b = write_bucketed(laps, path, ["session"], 4), write_bucketed(names, other, ["session"], 4)

    def apply(laps, names):
        return fill_gaps(laps, ["session", "car"], "lap", "s", "e", "n").join(names, "session")

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffles = [apply(*x)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for x in ((a, b), (laps, names))]
        assert shuffles[0] == 0 < shuffles[1]
        assert sorted(map(tuple, apply(a, b).collect())) == sorted(map(tuple, apply(laps, names).collect()))
        spark.sql(f"DROP TABLE {buckets._name(path)}")  # as in a session that does not know it
        again = read_bucketed(spark, path, a.schema, ["session"], 4)
        plan = apply(again, b)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 0 and again.count() == 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
