"""Run a registered Spark query and its DuckDB oracle side by side.

Used by `tests/test_oracle.py` and by hand:
    python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None) if v.tzinfo else v
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item"):
        return v.item()
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


# Spark type name -> DuckDB type name of the same values
CANON = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    t0 = time.time()
    df = queries()[name](spark, sf_dir)
    sp_types = {f.name: CANON.get(f.dataType.simpleString(), f.dataType.simpleString())
                for f in df.schema.fields}
    sp = df.toPandas()
    t1 = time.time()
    sql = oracle_sql().get(name)
    res = {"name": name, "spark_rows": len(sp), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["oracle"] = "none"
        return res
    rel = con.sql(sql)
    dk_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    dk = rel.df()
    res["oracle_rows"] = len(dk)
    res["types_ok"] = sp_types == dk_types
    if not res["types_ok"]:
        res["types"] = {c: (sp_types.get(c), dk_types.get(c)) for c in set(sp_types) | set(dk_types)
                        if sp_types.get(c) != dk_types.get(c)}
    res["cols_ok"] = sorted(sp.columns) == sorted(dk.columns)
    if not res["cols_ok"]:
        res["cols"] = (sorted(sp.columns), sorted(dk.columns))
        res["ok"] = False
        return res
    a, b = rows_of(sp), rows_of(dk)
    res["ok"] = a == b
    if not res["ok"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = list(sa - sb)[:5]
        res["only_oracle"] = list(sb - sa)[:5]
    return res


if __name__ == "__main__":
    from tidemark.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    from __spark_entry__ import queries
    con = duck(sf)
    bad = 0
    for n in names or list(queries()):
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and go on
            r = {"name": n, "error": repr(e)[:2000]}
        if not r.get("ok", r.get("oracle") == "none"):
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
