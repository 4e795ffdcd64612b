"""Every oracle statement runs in DuckDB over the small tables and names its
columns exactly like the Spark query's output."""

import duckdb

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_oracles_run_and_match_column_names(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    qs = E.queries()
    own = {n[2:] for n in vars(E) if n.startswith("q_")}
    for name, sql in E.oracle_sql().items():
        if name not in own:
            continue
        cur = con.execute(sql)
        cols = sorted(d[0] for d in cur.description)
        cur.fetchall()
        if name.startswith("stream_"):
            continue  # Spark side covered by test_speed_query_matches_batch
        assert cols == sorted(qs[name](spark, SF_SMALL).columns), name
