"""Readers for the given tables and the change-event view over ``events``.

``change_events`` maps each ``events`` row to one change event with pure
column expressions: no shuffle, and every column it does not need is pruned
from the Parquet scan by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.schema import CHANGE_EVENT_COLUMNS
from eventide.session import table_path

# Epoch seconds of a timestamp without zone, from zone-free date and time parts, so that
# neither the session zone nor daylight saving can shift it (fraction of a second dropped).
EPOCH_SECONDS_SQL = ("CAST(datediff(to_date(ts), DATE'1970-01-01') AS BIGINT) * 86400 "
                     "+ hour(ts) * 3600 + minute(ts) * 60 + CAST(floor(second(ts)) AS BIGINT)")

# Fixed values that shape the change-event view (chosen with the oracle SQL).
WIKIS = ["enwiki", "dewiki", "frwiki", "wikidata"]          # by user_id % 4
COMMENTS = ["", "/* edit */", "revert", "update"]           # by event_id % 4
SERVER_URL = "https://example.org"
SERVER_NAME = "Example Wiki"
SERVER_SCRIPT_URL = "https://example.org/w"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _pick(index, values):
    expr = F.when(index == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        expr = expr.when(index == i, F.lit(v))
    return expr


def change_events_from(events: DataFrame, with_duration: bool = False) -> DataFrame:
    """The ``ce`` view: ChangeEvent columns derived from an ``events`` frame."""
    epoch = F.expr(EPOCH_SECONDS_SQL)
    page = F.concat(F.lit("Page_"), (F.col("event_id") % 1000).cast("string"))
    cols = [
        F.col("event_id").alias("id"),
        F.col("event_type").alias("type"),
        (F.regexp_extract("props", "([0-9]+)", 1).cast("int") % 16).cast("int").alias("namespace"),
        page.alias("title"),
        page.alias("title_url"),
        _pick(F.col("event_id") % 4, COMMENTS).alias("comment"),
        epoch.alias("timestamp"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user"),
        (F.col("user_id") % 7 == 0).alias("bot"),
        F.lit(SERVER_URL).alias("server_url"),
        F.lit(SERVER_NAME).alias("server_name"),
        F.lit(SERVER_SCRIPT_URL).alias("server_script_url"),
        _pick(F.col("user_id") % 4, WIKIS).alias("wiki"),
        epoch.alias("parsed_timestamp"),
    ]
    if with_duration:
        cols.append((F.col("value") / F.lit(20.0)).alias("duration_s"))
    return events.select(*cols)


def change_events(spark: SparkSession, sf_dir: str, with_duration: bool = False) -> DataFrame:
    return change_events_from(read_table(spark, sf_dir, "events"), with_duration)


def ce_columns(df: DataFrame) -> DataFrame:
    """Keep exactly the 14 stored columns, in order."""
    return df.select(*CHANGE_EVENT_COLUMNS)
