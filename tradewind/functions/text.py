"""Numbers, JSON and status codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind import schemas

# Lower bound of a drawn status value -> order status. Fixed values.
STATUS_BANDS = [
    (98, 11), (96, 10), (51, 9), (36, 8), (31, 7), (26, 6),
    (24, 5), (23, 4), (17, 3), (15, 2), (11, 1),
]


def zero_pad(number: Column, width: int = 10) -> Column:
    """Left-pad with zeros; a longer text is left alone (a bare lpad would cut it)."""
    text = number.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def whole_padded(amount: Column) -> Column:
    """A sum of money shown as whole units, zero when there is none, padded to ten digits."""
    return zero_pad(F.coalesce(amount.cast("bigint"), F.lit(0).cast("bigint")))


def line_amount(price: Column, count: Column) -> Column:
    return price * count


def money_sum(amount: Column) -> Column:
    """Exact sum of two-decimal money. Values no decimal(38,2) can hold, NaN among them, count as null.

    Adding doubles depends on the order in which partitions arrive and loses cents in large
    totals; the decimal sum is the same on every run.
    """
    return F.sum(amount.try_cast("decimal(38,2)")).try_cast("double")


def status_band(drawn: Column) -> Column:
    """Map a drawn value to an order status; values below the first band stay."""
    out = None
    for floor, status in STATUS_BANDS:
        out = F.when(drawn >= floor, status) if out is None else out.when(drawn >= floor, status)
    return out.otherwise(drawn)


def entity_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """One JSON object per row, null fields left out."""
    return F.to_json(F.struct(*(columns or df.columns)))


def parse_cart(value: Column) -> Column:
    return F.from_json(value, schemas.ddl(schemas.CART))


def parse_comment(value: Column) -> Column:
    return F.from_json(value, schemas.ddl(schemas.COMMENT))


def attachment(comment: str) -> Column:
    """The attachment text of a parsed comment, from whichever of its two fields carries it."""
    return F.coalesce(f"{comment}.assetsViedoJSON", f"{comment}.imageViedoJSON").alias("assetsViedoJSON")


def parse_dimension(value: Column, table: str) -> Column:
    return F.from_json(value, schemas.ddl(schemas.DIMENSIONS[table][1]))


def counter(value: Column, name: str) -> Column:
    """An integer counter inside a JSON text: 0 when absent, not an integer, or not JSON."""
    got = F.get_json_object(value, f"$.{name}")
    return F.coalesce(F.when(got.rlike("^-?[0-9]+$"), got.try_cast("int")), F.lit(0))
