"""Run registered queries against their DuckDB oracles (row count, columns, multiset of rows)."""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).decode("utf-8", "replace")
    return v


def compare(spark, name, fn, sql, sf_dir, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    cols = sorted(sdf.columns)
    s_rows = [tuple(_norm(r[c]) for c in cols) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = sorted(rel.columns)
    d_idx = [rel.columns.index(c) for c in d_cols]
    d_rows = [tuple(_norm(r[i]) for i in d_idx) for r in rel.fetchall()]
    res = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": cols == d_cols, "spark_sec": round(t1 - t0, 3)}
    res["values_match"] = (res["columns_match"]
                           and collections.Counter(s_rows) == collections.Counter(d_rows))
    if not res["values_match"]:
        res["spark_cols"], res["oracle_cols"] = cols, d_cols
        sc, dc = collections.Counter(s_rows), collections.Counter(d_rows)
        res["only_spark"] = list((sc - dc).elements())[:5]
        res["only_oracle"] = list((dc - sc).elements())[:5]
    return res


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tidal.session import get_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    ok = True
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            df = fn(spark, sf_dir)
            print({"name": name, "rows": df.count(), "oracle": None})
            continue
        r = compare(spark, name, fn, sqls[name], sf_dir, con)
        ok &= r["values_match"] and r["spark_rows"] == r["oracle_rows"]
        print(r)
    print("ALL OK" if ok else "MISMATCH")
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
