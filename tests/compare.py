"""Run queries and their SQL oracles side by side.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical_rows(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows sorted; only numbers of equal value compare equal."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, bool) or value is None:
            return value
        if isinstance(value, float):
            return "nan" if math.isnan(value) else value
        return value

    out = [tuple(cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    cols, rows = canonical_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    ocols, orows = canonical_rows([d[0] for d in result.description], result.fetchall())
    if cols != ocols:
        return f"columns {cols} / {ocols}"
    if len(rows) != len(orows):
        return f"rows {len(rows)} / {len(orows)}"
    for a, b in zip(rows, orows):
        if a != b:
            bad = [(c, x, y) for c, x, y in zip(cols, a, b) if x != y]
            return f"values {str(bad)[:400]} in {str(a)[:200]}"
    types = [{type(r[i]) for r in rows if r[i] is not None} ^ {type(r[i]) for r in orows if r[i] is not None}
             for i in range(len(cols))]
    odd = {c: t for c, t in zip(cols, types) if t}
    return f"types {odd}" if odd else None


def main() -> int:
    import __spark_entry__ as entry
    from tracelode.session import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = local_session("8")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in args[1:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problem = difference(df, con, oracles[name]) if name in oracles else f"no oracle, {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} of {len(args[1:] or queries)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main() > 0)
