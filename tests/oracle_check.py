"""Compare named queries with their SQL: python tests/oracle_check.py [folder] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

GIVEN = "region nation customer supplier part orders lineitem events".split()


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def sorted_rows(rows):
    return sorted((tuple(map(normal, row)) for row in rows), key=repr)


def same(a, b) -> bool:
    return type(a) is type(b) and a == b


def connect(folder: str):
    import duckdb

    db = duckdb.connect()
    for name in GIVEN:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def difference(spark, db, folder: str, build, sql: str) -> str | None:
    """None where both sides agree, else a description."""
    df = build(spark, folder)
    names = sorted(df.columns)
    ours = sorted_rows(df.select(*[f"`{n}`" for n in names]).collect())
    cursor = db.execute(sql)
    found = [d[0] for d in cursor.description]
    if sorted(found) != names:
        return f"columns {names} against {sorted(found)}"
    at = [found.index(n) for n in names]
    theirs = sorted_rows([[row[i] for i in at] for row in cursor.fetchall()])
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if not all(map(same, a, b)):
            return f"{names}\n  {a}\n  {b}"
    return None if ours else "EMPTY"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tillstream.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    db, sqls, bad = connect(folder), oracle_sql(), 0
    for name, build in queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            problem = difference(spark, db, folder, build, sqls[name]) if name in sqls else "no SQL"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name}: {'ok' if problem is None else problem} ({time.time() - began:.1f}s)", flush=True)
    print(f"{bad} differ")
    extra = set(sqls) - set(queries())
    if extra:
        print("SQL without query:", extra)


if __name__ == "__main__":
    main()
