"""Change feed: decode, flatten, filter, route, type, and reduce to the latest state."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind import schemas

TRANSACTION_MARKS = ("TRANSACTIONBEGIN", "TRANSACTIONEND")
# Later changes win; the log position breaks ties of the same millisecond.
CHANGE_ORDER = ("executeTime", "logfileName", "logfileOffset")
MESSAGE = "RowData"


def decode(df: DataFrame, descriptor: str, value: str = "value", *, keep: list[str] | None = None) -> DataFrame:
    """Envelope bytes to envelope columns; bytes that are no envelope give null columns.

    This is Spark's own protobuf reader, which needs the optional protobuf package of Spark and a descriptor file.
    """
    kept = keep or []
    from pyspark.sql.protobuf.functions import from_protobuf

    parsed = df.select(*kept, from_protobuf(
        F.col(value), MESSAGE, descFilePath=descriptor, options={"mode": "PERMISSIVE"}).alias("_e"))
    return parsed.select(*kept, *[F.col(f"_e.{n}").cast(t).alias(n) for n, t in schemas.CHANGE])


def encode(df: DataFrame, descriptor: str) -> DataFrame:
    """Envelope columns to one `value` column of bytes."""
    from pyspark.sql.protobuf.functions import to_protobuf

    row = F.struct(*[F.col(n) for n, _ in schemas.CHANGE])
    return df.select(to_protobuf(row, MESSAGE, descFilePath=descriptor).alias("value"))


#: A record as it came: its raw bytes or text, the topic or file, and its place there.
ORIGIN = ("raw", "source", "position")


def from_json_text(df: DataFrame, value: str = "value", *, keep: list[str] | None = None) -> DataFrame:
    """Envelope columns of change records written as JSON text; text that is none gives null columns."""
    kept = keep or []
    parsed = df.select(*kept, F.from_json(F.col(value), schemas.ddl(schemas.CHANGE), {"mode": "PERMISSIVE"}).alias("_e"))
    return parsed.select(*kept, *[F.col(f"_e.{n}").alias(n) for n, _ in schemas.CHANGE])


def quarantine(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) records of a permissive decode: a good one names its table and its operation."""
    bad = F.col("tableName").isNull() | F.col("eventType").isNull()
    return decoded.filter(~bad), decoded.filter(bad)


def flatten_log(batches: DataFrame) -> DataFrame:
    """Polls of the change log to one change per changed row.

    Transaction marks are skipped. Inserts and updates carry the row after the change, deletes
    the row before it.
    """
    changed = F.filter("entries", lambda e: ~e["entryType"].isin(*TRANSACTION_MARKS))
    header = ["logfileName", "logfileOffset", "executeTime", "schemaName", "tableName"]
    # Header fields and rows part ways before the second explode, so that an entry's whole list
    # of rows is not copied along with each of them.
    entries = batches.select(F.explode(changed).alias("e")).select(
        *[f"e.{h}" for h in header], F.lower("e.eventType").alias("eventType"), "e.rowDatas")
    rows = entries.select(*header, "eventType", F.explode("rowDatas").alias("r"))
    event = F.col("eventType")
    image = F.when(event == "delete", F.col("r.beforeColumns")).when(
        event.isin("insert", "update"), F.col("r.afterColumns"))
    return rows.select(*header, event, F.coalesce(
        F.map_from_entries(image), F.create_map().cast("map<string,string>")).alias("columns"))


def of_table(changes: DataFrame, table: str) -> DataFrame:
    return changes.filter(F.col("tableName") == table)


def of_tables(changes: DataFrame, tables: Iterable[str] = tuple(schemas.DIMENSIONS)) -> DataFrame:
    return changes.filter(F.col("tableName").isin(*tables))


def inserts(changes: DataFrame) -> DataFrame:
    """New rows only, so that a later change of a row is not counted again."""
    return changes.filter(F.col("eventType") == "insert")


def with_payload(changes: DataFrame) -> DataFrame:
    return changes.filter(F.size("columns") > 0)


def action() -> Column:
    """What a change does to a table of latest rows."""
    event = F.col("eventType")
    return (F.when(event.isin("insert", "update"), "upsert")
            .when(event == "delete", "delete").otherwise("ignore"))


def typed(fields: list[tuple[str, str]], source: str = "columns") -> list[Column]:
    """Text columns of a change as typed columns; text that does not parse becomes null."""
    return [F.col(source)[n].try_cast(t).alias(n) for n, t in fields]


def orders(changes: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Change rows of the order table as order records."""
    return changes.select(*(keep or []), *typed(schemas.ORDER))


def latest(changes: DataFrame, key: list[str], order: list[str], values: list[str], *,
           event: str = "eventType", with_deleted: bool = False) -> DataFrame:
    """Latest row per key; keys whose last change is a delete are gone.

    An aggregate, not a ranking window: each task first reduces its own rows to one per key, so
    a key with a third of all changes costs one row per task in the shuffle. `order` must be
    total for the result to be repeatable. Unknown operations are ignored, and so are changes
    without a key: they name no row.
    """
    known = changes.filter(F.col(event).isin("insert", "update", "delete")).dropna("any", subset=key)
    state = known.groupBy(*key).agg(
        F.max_by(F.struct(event, *order, *values), F.struct(*order)).alias("_r"))
    out = state.select(*key, *[F.col(f"_r.{c}").alias(c) for c in
                               dict.fromkeys([event, *order, *values])])
    if with_deleted:
        return out
    return out.filter(F.col(event) != "delete").select(*key, *values)


def dimension_state(changes: DataFrame, dimension: str) -> DataFrame:
    """Current rows of one dimension table from its change feed."""
    key, fields = schemas.DIMENSIONS[dimension]
    rows = of_table(changes, dimension).select("eventType", *CHANGE_ORDER, *typed(fields))
    values = [n for n, _ in fields if n != key]
    return latest(rows, [key], list(CHANGE_ORDER), values)


def line_state(wide: DataFrame, order: list[str]) -> DataFrame:
    """Current widened order lines, one per line id."""
    values = [c for c in wide.columns if c not in ("ogId", "eventType", *order)]
    return latest(wide, ["ogId"], order, values)
