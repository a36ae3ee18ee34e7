"""Runs registered queries next to their SQL twins: python tests/compare.py [sf] [name ...]."""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, float):
        return (1, f"{v:.6f}".rstrip("0").rstrip("."))
    return (1, str(v))


def normalise(rows: list, names: list[str]) -> list:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both engines return the same rows, else a short description."""
    got = normalise([tuple(r) for r in spark_df.collect()], spark_df.columns)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = normalise(cur.fetchall(), names)
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    if got == want:
        return None if got else "no rows on either side"
    only_got, only_want = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
    return f"{len(got)} rows against {len(want)}; only spark {only_got}; only sql {only_want}"


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry_module
    from wardlake import session

    sf = argv[0] if argv else "sf0.001"
    sf_dir = f"/root/testdata/{sf}"
    spark = session.build("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    queries, sqls, con = entry_module.queries(), entry_module.oracle_sql(), duck(sf_dir)
    bad = 0
    for name in sorted(queries):
        if len(argv) > 1 and not any(name.startswith(a) for a in argv[1:]):
            continue
        start = time.time()
        try:
            out = difference(queries[name](spark, sf_dir), con, sqls[name])
        except Exception as err:  # report and go on with the next query
            out = f"{type(err).__name__}: {str(err)[:500]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += out is not None
        print(f"{'ok ' if out is None else 'BAD'} {time.time() - start:6.2f}s {name} {out or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
