import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def oracle():
    """Run a query's SQL in DuckDB over a folder of tables, or over given rows."""
    def run(sql, sf=None, **frames):
        con = duckdb.connect()
        if sf:
            for t in ("documents", "pages", "benchmark", "labels", "conversations"):
                con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
        for name, frame in frames.items():
            con.register(name, frame)
        cur = con.execute(sql)
        names = [d[0] for d in cur.description]
        return sorted(map(str, (tuple(v for _, v in sorted(zip(names, r))) for r in cur.fetchall())))
    return run
