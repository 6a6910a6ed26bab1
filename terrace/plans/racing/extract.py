"""Records of the site's pages and of the API's payloads, ready for their topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import nfkd_strip, slug
from terrace.plans.racing.topics import PAYLOAD_PATHS, RECORDS
from terrace.sources.pages import cell, html_rows
from terrace.sources.payloads import payload_records
from terrace.sources.schedule import nth_row


def api_records(payloads: DataFrame, kind: str, payload: str, source: Column) -> DataFrame:
    """API records of a kind; ``payloads`` has ``season`` and ``round`` beside the JSON."""
    path, tags = PAYLOAD_PATHS[kind]
    values = {
        "race_id": F.concat_ws("_", "season", "round"),
        "source": source,
        "season": F.col("season").cast("int"),
    }
    fields = [
        f for f in _split_fields(RECORDS[kind]) if f.strip().split(" ")[0] not in tags
    ]
    return payload_records(payloads, payload, path, ", ".join(fields), {t: values[t] for t in tags})


def _split_fields(ddl: str) -> list[str]:
    """Top-level fields of a DDL string."""
    fields, depth, start = [], 0, 0
    for i, ch in enumerate(ddl):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            fields.append(ddl[start:i])
            start = i + 1
    return [*fields, ddl[start:]]


def _site(pages: DataFrame, html: str, table_class: str, keep: list[str], columns: dict) -> DataFrame:
    # The rows of the first body; a later one is a footer.
    rows = html_rows(pages, html, table_class, keep).filter("body = 0")
    return rows.select(*[c.alias(name) for name, c in columns.items()])


def site_drivers(pages: DataFrame, html: str, source: Column) -> DataFrame:
    """``pages`` has ``season`` beside the HTML."""
    return _site(pages, html, "datatable", ["season"], {
        "Driver": cell(0), "Constructor": cell(1), "Engine_Manufacturer": cell(2),
        "Best_Result": cell(3), "Source": source, "Season": F.col("season"),
    })


def site_cars(pages: DataFrame, html: str, source: Column) -> DataFrame:
    return _site(pages, html, "datatable", ["season"], {
        "Constructor": nfkd_strip(cell(0, "link")), "Chassis": nfkd_strip(cell(0)),
        "Engine": nfkd_strip(cell(2)), "Source": source, "season": F.col("season"),
    })


def _with_origin(name: str):
    def read(pages: DataFrame, html: str, source: Column) -> DataFrame:
        return _site(pages, html, "sortable", [], {
            name: cell(0), "Nation": cell(1, "attr:sorttable_customkey"),
            "Started_time": cell(2), "Source": source,
        })

    return read


site_engine_suppliers = _with_origin("Engine_Manufacturer")
site_constructors = _with_origin("Constructor")


def site_results(pages: DataFrame, html: str, source: Column) -> DataFrame:
    """``pages`` has ``season`` and ``round`` beside the HTML."""
    return _site(pages, html, "datatable", ["season", "round"], {
        "Race_id": F.concat_ws("_", "season", "round"), "Position": cell(0),
        "Driver_number": cell(1), "Driver": cell(2), "Chassis": cell(3),
        "Engine_manufacturer": cell(4), "Total_lap": cell(5),
        "Race_time": nfkd_strip(cell(6)), "Source": source,
    })


def round_slug(pages: DataFrame, html: str, number: int) -> DataFrame:
    """Slug of the n-th race of each season's schedule page, cancelled races left out."""
    rows = html_rows(pages, html, "ms-schedule-table", ["season"]).withColumn(
        "title", F.get(F.filter("cells", lambda c: c.span.isNotNull()), F.lit(0)).getField("span")
    )
    first_rows = rows.filter("title IS NOT NULL").groupBy("season", "body").agg(
        F.min_by("title", "row").alias("title"), F.min("body_class").alias("body_class")
    )
    cancelled = F.contains("body_class", F.lit("canceled"))
    return nth_row(first_rows, number, ["body"], cancelled, ["season"]).select(
        "season", slug(F.col("title")).alias("slug")
    )
