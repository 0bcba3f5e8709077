"""Run a registered Spark query and its DuckDB oracle on the same parquet tables and compare.

Comparison: same column names, same row count, and the same multiset of rows
after sorting columns by name and rounding floats to 9 significant digits.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("f", float(f"{v:.9g}"))
    if isinstance(v, bool):
        return ("i", int(v))
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    if hasattr(v, "asDict"):
        return ("l", tuple(_norm(x) for x in v))
    if isinstance(v, dict):
        return ("l", tuple(_norm(x) for x in v.values()))
    return ("s", str(v))


# Spark simple type name -> DuckDB type name of the same values.
TYPE_NAMES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN", "array<double>": "DOUBLE[]", "timestamp": "TIMESTAMP",
              "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


def type_mismatches(df, rel) -> dict:
    spark_types = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return {c: (spark_types.get(c), duck_types.get(c))
            for c in set(spark_types) | set(duck_types) if spark_types.get(c) != duck_types.get(c)}


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return cols, out


def compare(spark, name: str, query, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = duck(sf_dir)
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    bad_types = type_mismatches(df, rel)
    d_rows = rel.fetchall()
    s_cols, s_norm = normalise(df.columns, s_rows)
    d_cols2, d_norm = normalise(d_cols, d_rows)
    res["oracle_rows"] = len(d_rows)
    if s_cols != d_cols2:
        res["status"] = f"schema mismatch spark={s_cols} oracle={d_cols2}"
    elif bad_types:
        res["status"] = f"type mismatch {bad_types}"
    elif len(s_rows) != len(d_rows):
        res["status"] = "row count mismatch"
    elif s_norm != d_norm:
        diff = [(a, b) for a, b in zip(s_norm, d_norm) if a != b][:3]
        res["status"] = f"value mismatch, first diffs {diff}"
    else:
        res["status"] = "match"
    return res


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from sylvan.session import local_session

    sf_dir = "/root/testdata/sf0.01"
    names = argv[1:]
    spark = local_session()
    qs, sqls = entry.queries(), entry.oracle_sql()
    for name in names or sorted(qs):
        try:
            r = compare(spark, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # report and keep going
            r = {"name": name, "status": f"error {type(e).__name__}: {str(e)[:300]}"}
        print(r, flush=True)


if __name__ == "__main__":
    main(sys.argv)
