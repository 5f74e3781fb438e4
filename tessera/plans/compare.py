"""Order-insensitive comparison of a Spark result with a DuckDB oracle.

Columns are compared by name; values are normalised (decimals and floats to
rounded numbers, dates/timestamps to ISO text) and rows compared as sorted
multisets. Used by the test-suite; small inputs only (it collects).
"""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

from ..sources.tables import TABLES, table_path


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (int,)):
        return v
    if isinstance(v, (float, Decimal)):
        f = float(v)
        return round(f, 6) if abs(f) < 1e12 else float(f"{f:.9e}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def oracle_rows(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


# Spark simple type name -> DuckDB type name of the same values
_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
         "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}


def type_mismatches(spark_df, con, sql: str) -> list[str]:
    """Columns whose Spark type differs from the oracle's (decimals by
    precision and scale)."""
    duck = {d[0]: str(d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    bad = []
    for name, t in spark_df.dtypes:
        want = t.upper() if t.startswith("decimal") else _DUCK.get(t, t.upper())
        got = duck.get(name, "?").replace(" ", "")
        if want.replace(" ", "") != got:
            bad.append(f"{name}: spark={t} oracle={duck.get(name)}")
    return bad


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    o_cols, o_rows = oracle_rows(con, sql)
    if sorted(s_cols) != sorted(o_cols):
        return False, f"columns differ: spark={sorted(s_cols)} oracle={sorted(o_cols)}"
    if len(s_rows) != len(o_rows):
        return False, f"row count differs: spark={len(s_rows)} oracle={len(o_rows)}"
    a, b = _rows(s_cols, s_rows), _rows(o_cols, o_rows)
    for x, y in zip(a, b):
        if x != y:
            return False, f"first differing row: spark={x} oracle={y}"
    return True, f"{len(s_rows)} rows equal"
