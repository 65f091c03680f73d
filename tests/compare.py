"""Compare a registered query with its SQL twin: columns, row count, values, any order."""

from __future__ import annotations

import datetime as dt
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def database(root: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{root}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or v != v:
        return "~"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, text: str) -> str | None:
    """None when equal, else a short account of what differs."""
    cur = con.execute(text)
    want_names = [d[0] for d in cur.description]
    want = rows_of(want_names, cur.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(want_names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(want_names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            cells = [(n, a, b) for n, a, b in zip(sorted(want_names), g, w) if a != b]
            return f"first difference {cells}"
    if not want:
        return None
    return None


def main() -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tradewind import session

    root = sys.argv[1]
    only = sys.argv[2:]
    spark = session.build("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = database(root)
    bad = 0
    for name, fn in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            df = fn(spark, root)
            text = entry.oracle_sql().get(name)
            if text is None:
                note = f"no SQL, {df.count()} rows"
            else:
                diff = difference(df, con, text)
                note = "ok" if diff is None else "DIFF " + diff
                n = con.execute(f"SELECT count(*) FROM ({text})").fetchall()[0][0]
                note += f" [{n}]"
        except Exception as e:  # keep going: one report for all queries
            note = "ERROR " + str(e).strip()[:600]
        bad += note.startswith(("DIFF", "ERROR"))
        print(f"{name:28s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
