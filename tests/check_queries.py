"""Compare every named query with its SQL on one data directory.

    python tests/check_queries.py /root/testdata/sf0.001 [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricewatch.bindings.roles import TABLES  # noqa: E402


def canonical(columns, rows):
    """Rows as sorted tuples of text, columns by name, floats to nine digits."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if value is None:
            return "null"
        if isinstance(value, bool):
            return str(value)
        if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
            return f"{float(value):.9g}"
        return str(value)

    return sorted(columns), sorted(tuple(cell(row[i]) for i in order) for row in rows)


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def expected(con, sql: str):
    cursor = con.execute(sql)
    return canonical([d[0] for d in cursor.description], cursor.fetchall())


def actual(df):
    return canonical(df.columns, df.collect())


def difference(want, got) -> str | None:
    if want[0] != got[0]:
        return f"columns {got[0]} instead of {want[0]}"
    if want[1] == got[1]:
        return None
    missing = [row for row in want[1] if row not in set(got[1])][:3]
    extra = [row for row in got[1] if row not in set(want[1])][:3]
    return f"{len(got[1])} rows instead of {len(want[1])}; missing {missing}; extra {extra}"


def main() -> int:
    from pricewatch.session import build_session
    import __spark_entry__ as entry_module

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(**{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), entry_module.oracle_sql(), 0
    for name, run in entry_module.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            got = actual(run(spark, sf_dir))
            problem = difference(expected(con, sqls[name]), got) if name in sqls else "no SQL"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        size = len(got[1]) if problem is None else ""
        print(f"{'ok ' if problem is None else 'BAD'} {name} {size} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{bad} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
