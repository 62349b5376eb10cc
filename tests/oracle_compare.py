"""Run registered Spark queries next to their DuckDB oracle and compare.

Comparison is exact and order-insensitive: columns sorted by name, every
value turned into canonical text, rows sorted. Types are compared after
mapping Spark names onto DuckDB's.

    python tests/oracle_compare.py [--json report.json] [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def canon(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(value)
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f") if value != 0 else "0"
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(canon(v) for v in value) + "]"
    return str(value)


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def spark_rows(df):
    names = sorted(df.columns)
    rows = df.select(*names).collect()
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return names, [tuple(canon(r[n]) for n in names) for r in rows], types


def duck_rows(con, sql):
    rel = con.sql(sql)
    cols = rel.columns
    types = dict(zip(cols, [str(t) for t in rel.types]))
    data = rel.fetchall()
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    return names, [tuple(canon(r[i]) for i in order) for r in data], types


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    s_names, s_rows, s_types = spark_rows(fn(spark, sf_dir))
    t1 = time.time()
    result = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        result["status"] = "no-oracle"
        return result
    d_names, d_rows, d_types = duck_rows(con, sql)
    result["duck_rows"] = len(d_rows)
    problems = []
    if s_names != d_names:
        problems.append(f"columns {s_names} vs {d_names}")
    else:
        for n in s_names:
            st = s_types[n]
            # decimal(p,s) maps to DECIMAL(p,s) by upper-casing.
            want = SPARK_TO_DUCK.get(st, st.upper())
            if want.replace(" ", "") != d_types[n].replace(" ", ""):
                problems.append(f"type {n}: {st} vs {d_types[n]}")
        if sorted(s_rows) != sorted(d_rows):
            s_set, d_set = sorted(s_rows), sorted(d_rows)
            only_s = [r for r in s_set if r not in set(d_set)][:3]
            only_d = [r for r in d_set if r not in set(s_set)][:3]
            problems.append(f"values differ; spark-only {only_s}; duck-only {only_d}")
    result["status"] = "ok" if not problems else "MISMATCH"
    if problems:
        result["problems"] = problems
    return result


def main(argv):
    import json

    from gridlake.plans.registry import all_queries
    from gridlake.session import build_session

    report_path = None
    if argv[:1] == ["--json"]:
        report_path, argv = argv[1], argv[2:]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = set(argv[1:])
    spark = build_session("oracle-check", master="local[8]", shuffle_partitions=8)
    con = duck_connection(sf_dir)
    bad = 0
    report = []
    for name, q in sorted(all_queries().items()):
        if wanted and name not in wanted:
            continue
        try:
            r = compare(spark, con, name, q.fn, q.sql, sf_dir)
        except Exception as exc:  # report and continue
            r = {"name": name, "status": "ERROR", "problems": [f"{type(exc).__name__}: {str(exc)[:600]}"]}
        bad += r["status"] not in ("ok", "no-oracle")
        report.append(r)
        print(r, flush=True)
    print(f"{bad} problems")
    if report_path:
        with open(report_path, "w", encoding="utf-8") as fh:
            json.dump({"sf_dir": sf_dir, "problems": bad, "queries": report}, fh, indent=1)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
