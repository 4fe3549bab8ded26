"""Run registered queries next to their SQL twins; `python tests/compare.py sf_dir [name ...]`."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _text(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return repr(value)
    return str(value)


def rows_of(names: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_text(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql: str, sf_dir: str) -> tuple[int, str]:
    """Row count and an empty string, or what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return len(got), f"columns {sorted(set(df.columns) ^ set(names))}"
    if got != want:
        only_got = sorted(set(got) - set(want))[:2]
        only_want = sorted(set(want) - set(got))[:2]
        return len(got), f"{len(got)} rows vs {len(want)};\n  spark {only_got}\n  sql   {only_want}"
    return len(got), ""


def main() -> None:
    from tests.session import local_session

    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session(), duck(sf_dir)
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                n, problem = compare(spark, con, query, oracles[name], sf_dir)
            else:
                n, problem = len(query(spark, sf_dir).collect()), "" 
            state = "ok  " if not problem else "DIFF"
            if name not in oracles:
                state = "rows"
        except Exception as e:  # report and go on with the next query
            n, state, problem = -1, "FAIL", str(e)[:1500]
        print(f"{state} {name} {n} rows {time.time() - start:.1f}s {problem}", flush=True)


if __name__ == "__main__":
    main()
