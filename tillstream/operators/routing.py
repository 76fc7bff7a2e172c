"""Routing of logs and change records (CDC1-CDC7). All of it is row by row: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.schemas import EVENT_LOG, ODS_PREFIX, STARTUP_LOG
from tillstream.sources.records import json_field


ANY_INSERT = ("INSERT", "insert")  # spellings of both capture tools


def route_logs(logs: DataFrame) -> DataFrame:
    """Adds ``topic``: logs with a non-null ``start`` go to the start-up topic, all others to the event topic."""
    is_start = json_field(F.col("value"), "start").isNotNull()
    return logs.withColumn("topic", F.when(is_start, STARTUP_LOG).otherwise(EVENT_LOG))


def _records(data_text):
    """Elements of the ``data`` field as JSON texts; a lone object counts as an array of one."""
    listed = F.when(F.ltrim(data_text).startswith("{"), F.concat(F.lit("["), data_text, F.lit("]"))).otherwise(data_text)
    return F.from_json(listed, "array<string>")


def _envelope():
    return F.from_json("value", "type string, table string, data string")


def no_envelopes(changes: DataFrame, insert_types: tuple[str, ...] = ("INSERT",)) -> DataFrame:
    """Texts that are no change envelope: not JSON, without a type or a table, or inserts whose data holds no list of rows."""
    change = _envelope()
    data = change["data"]
    broken = change["type"].isin(*insert_types) & data.isNotNull() & _records(data).isNull()
    unusable = change["type"].isNull() | change["table"].isNull() | F.coalesce(broken, F.lit(False))
    return changes.where(F.coalesce(unusable, F.lit(True))).select("value")


def split_changes(changes: DataFrame, insert_types: tuple[str, ...] = ("INSERT",)) -> DataFrame:
    """Inserted rows of change envelopes ``{type, table, data}``, one output row per element of ``data``.

    ``topic`` is ``ods_<table>`` and ``value`` the JSON text of the row. Null and empty ``data`` give no row, nor does an envelope
    without a table, which is left to :func:`no_envelopes`. The envelope is parsed once; ``data`` stays text until the other types are gone.
    """
    inserts = changes.select(_envelope().alias("change")).where(F.col("change.type").isin(*insert_types) & F.col("change.table").isNotNull())
    rows = inserts.select(
        F.concat(F.lit(ODS_PREFIX), F.col("change.table")).alias("topic"),
        F.explode(_records(F.col("change.data"))).alias("value"),
    )
    return rows.where(F.col("value").isNotNull())


def split_changes_any(changes: DataFrame) -> DataFrame:
    """The same for the second capture tool, which writes ``insert`` and puts a single object in ``data``."""
    return split_changes(changes, ANY_INSERT)


def row_data_entries(entries: DataFrame, table: str | None = None) -> DataFrame:
    """Without a table: every entry but transaction begins and ends. With one: only that table's row data."""
    if table is None:
        return entries.where(~F.coalesce(F.col("entry_type"), F.lit("")).isin("TRANSACTIONBEGIN", "TRANSACTIONEND"))
    return entries.where((F.col("entry_type") == "ROWDATA") & (F.col("table") == table))


def flatten_row_changes(entries: DataFrame) -> DataFrame:
    """Inserted rows as one flat JSON object each, name to value, all values text.

    ``rows`` holds the columns after the change: ``array<array<struct<name, value>>>``.
    """
    row = F.explode("rows").alias("row")
    inserted = entries.where("event_type = 'INSERT'").select("table", row)
    pairs = F.transform("row", lambda c: F.struct(c["name"], c["value"]))
    return inserted.select("table", F.to_json(F.map_from_entries(pairs)).alias("value"))
