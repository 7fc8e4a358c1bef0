"""Compare a registered Spark query with its DuckDB oracle on the same tables.

Mirrors the driver's check: same column names, same row count, and the same
multiset of rows (columns sorted by name, order-insensitive).
Run as a script to check every key: ``python tests/oracle_check.py [sf_dir] [key...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


# Spark type -> DuckDB type name, for the schema part of the comparison
TYPE_NAMES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
              "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.12g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def compare(spark, sf_dir: str, key: str, query, sql: str, con=None) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    s_cols = sorted(df.columns)
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in df.select(*s_cols).collect()]
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_cols = sorted(rel.columns)
    d_all = rel.fetchall()
    idx = [rel.columns.index(c) for c in d_cols]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in d_all]
    if s_cols != d_cols:
        return False, f"{key}: columns differ\n spark={s_cols}\n duck ={d_cols}"
    s_types = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    bad = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    if bad:
        return False, f"{key}: types differ {bad}"
    if len(s_rows) != len(d_rows):
        return False, f"{key}: rows spark={len(s_rows)} duck={len(d_rows)}"
    cs, cd = Counter(s_rows), Counter(d_rows)
    if cs != cd:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        return False, f"{key}: values differ\n cols={s_cols}\n spark-only={only_s}\n duck-only={only_d}"
    return True, f"{key}: ok ({len(s_rows)} rows)"


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from cardmarts.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:]
    spark = local_session(8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or list(qs):
        if k not in sqls:
            n = qs[k](spark, sf_dir).count()
            print(f"{k}: rows-only ({n} rows)")
            continue
        ok, msg = compare(spark, sf_dir, k, qs[k], sqls[k], con)
        bad += not ok
        print(msg, flush=True)
    print(f"{bad} mismatches")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
