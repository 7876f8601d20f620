"""Row-for-row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime
import decimal
import math
import os

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return f"decimal {v}"
    if isinstance(v, datetime.datetime):
        return f"datetime {v}"
    return repr(v)


# Families of types that give equal Python values.
_FAMILY = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "BOOLEAN": "boolean", "DATE": "date",
}


def compare(df, con, sql: str) -> list[str]:
    """Differences between the two results; empty when they agree."""
    rel = con.sql(sql)
    problems = []
    spark_types = dict(df.dtypes)
    duck_types = {c: _FAMILY.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    if set(spark_types) != set(duck_types):
        return [f"columns: {sorted(spark_types)} != {sorted(duck_types)}"]
    for c in spark_types:
        if spark_types[c] != duck_types[c]:
            problems.append(f"type of {c}: {spark_types[c]} != {duck_types[c]}")
    names = sorted(spark_types)
    mine = sorted(tuple(_value(r[c]) for c in names) for r in df.collect())
    index = [rel.columns.index(c) for c in names]
    theirs = sorted(tuple(_value(r[i]) for i in index) for r in rel.fetchall())
    if len(mine) != len(theirs):
        problems.append(f"rows: {len(mine)} != {len(theirs)}")
    extra, missing = set(mine) - set(theirs), set(theirs) - set(mine)
    if extra or missing or mine != theirs:
        problems.append(f"{names}\n   spark only: {sorted(extra)[:3]}\n   sql only:   {sorted(missing)[:3]}")
    return problems


if __name__ == "__main__":
    import sys
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from vitals.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", 8, {"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, expected, failed = duck(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        if name not in expected:
            print("no SQL ", name)
            continue
        start = time.time()
        try:
            problems = compare(query(spark, sf_dir), con, expected[name])
        except Exception as error:  # report and go on with the next query
            problems = [str(error)[:1500]]
        failed += bool(problems)
        print("differs" if problems else "equal  ", name, f"{time.time() - start:.1f}s", *problems)
    print("failed:", failed)
