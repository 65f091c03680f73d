"""Access-log lines: guid, ip, identity, [time], "request", status, bytes, "referer", "agent"."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import times

# Possessive: the match of a field never backs up, so its length does not matter.
_QUOTED = r'"((?:[^"\\]++|\\.)*+)"'
LINE = (
    r'^(\S+) (\S+) (\S+) \[([^\]]*)\] ' + _QUOTED + r' (\d{3}|-) (\d+|-) '
    + _QUOTED + " " + _QUOTED + r'\s*$'
)
# The extended format carries the request cookie and the caller's address at the end.
LINE_EXTENDED = LINE[: -len(r"\s*$")] + " " + _QUOTED + " " + _QUOTED + r'\s*$'
# Servers escape control characters inside log fields, so this one cannot occur in a line.
_CUT = "\u0001"


def _present(text: Column) -> Column:
    return F.when(text != "-", text)


def parse(df: DataFrame, line: str = "value", *, extended: bool = False,
          keep: list[str] | None = None) -> DataFrame:
    """Parse log lines into typed fields; a line that does not fit gives nulls.

    The expression matches each line once (a `regexp_extract` per field would match it ten
    times) and cuts the rewritten line on a control character.
    """
    groups = 11 if extended else 9
    rewritten = F.regexp_replace(
        line, LINE_EXTENDED if extended else LINE,
        _CUT.join(f"${i}" for i in range(1, groups + 1)),
    )
    cut = df.withColumn("_f", F.split(rewritten, _CUT))
    field = lambda i: F.when(F.size("_f") == groups, F.col("_f")[i - 1])
    request = F.split(field(5), " ")
    is_request = F.size(request) == 3
    out = [
        _present(field(1)).alias("uid"),
        _present(field(2)).alias("ip"),
        field(4).alias("requestTime"),
        F.when(is_request, request[0]).alias("requestMethod"),
        F.when(is_request, request[1]).alias("requestUrl"),
        F.when(is_request, request[2]).alias("requestProtocol"),
        field(6).try_cast("int").alias("responseStatus"),
        F.when(field(7) == "-", "0").otherwise(field(7)).alias("responseBodyBytes"),
        _present(field(8)).alias("referer"),
        _present(field(9)).alias("userAgent"),
        F.try_parse_url(_present(field(8)), F.lit("HOST")).alias("referDomain"),
    ]
    if extended:
        out += [_present(field(10)).alias("cookie"), _present(field(11)).alias("address")]
    return (cut.select(*(keep or []), *out)
            .withColumn("requestDateTime", times.datetime_text(times.log_time(F.col("requestTime")))))
