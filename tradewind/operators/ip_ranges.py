"""Address to place: a range join without a nested loop.

Ranges do not overlap. Each is cut at /16 borders, which turns the search into an equality on
the upper half of the address plus a check of the bounds. All addresses have 65,536 upper
halves, so the cut table has at most that many rows more than there are ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import geo
from tradewind.operators import lookup

BLOCK_BITS = 16
_BLOCKS = 1 << BLOCK_BITS
# Bytes of one cut range in a broadcast table, place names included.
_ROW_BYTES = 512


def cut(ranges: DataFrame) -> DataFrame:
    """One row per range and /16 block it touches."""
    first = F.shiftright("begin", BLOCK_BITS)
    last = F.shiftright("end", BLOCK_BITS)
    return ranges.select("begin", "end", "country", "area",
                         F.explode(F.sequence(first, last)).alias("_block"))


def _fits(ranges: DataFrame) -> bool:
    size = lookup.estimated_bytes(ranges)
    if size is None:
        return False
    return size * lookup.EXPANSION + _BLOCKS * _ROW_BYTES <= lookup.BROADCAST_LIMIT


def locate(fact: DataFrame, ranges: DataFrame, ip: str = "ip") -> DataFrame:
    """Add `country` and `area` of the address; gaps between ranges are unknown places.

    The table of ranges is broadcast after a size check. A larger one is joined by block; one provider's
    block can hold a large share of all visits, which run-time skew splitting spreads.
    """
    numbered = fact.withColumn("_ip", geo.ip_number(F.col(ip)))
    keyed = numbered.withColumn("_b", F.shiftright("_ip", BLOCK_BITS))
    places = cut(ranges)
    hit = (F.col("_b") == F.col("_block")) & F.col("_ip").between(F.col("begin"), F.col("end"))
    joined = keyed.join(F.broadcast(places) if _fits(ranges) else places, hit, "left")
    return joined.select(
        *fact.columns,
        F.coalesce("country", F.lit(geo.UNKNOWN_COUNTRY)).alias("country"),
        F.coalesce(geo.clean_area(F.col("area")), F.lit(geo.UNKNOWN_AREA)).alias("area"))


def search(ranges: DataFrame, part: str) -> DataFrame:
    """Ranges whose place name contains a text, with dotted bounds."""
    area = geo.clean_area(F.col("area"))
    return ranges.filter(F.contains("country", F.lit(part)) | F.contains(area, F.lit(part))).select(
        geo.ip_text(F.col("begin")).alias("beginIp"), geo.ip_text(F.col("end")).alias("endIp"),
        "country", area.alias("area"))
