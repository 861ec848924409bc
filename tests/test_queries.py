"""Every registered single-cell query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from cellgrid.plans import adapters, queries2, queries3  # noqa: F401  they register more
from cellgrid.plans.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(rows, columns):
    at = [columns.index(c) for c in sorted(columns)]

    def value(x):
        if hasattr(x, "as_tuple"):
            x = float(x)
        return float(f"{x:.9g}") if isinstance(x, float) else x

    return sorted(([value(r[i]) for i in at] for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.fixture(scope="module")
def db(data):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{data}/{t}.parquet"):
            con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, db, name):
    df = QUERIES[name](spark, data)
    rows = [tuple(r) for r in df.collect()]
    if name in ORACLE_SQL:
        want = db.sql(ORACLE_SQL[name])
        assert sorted(want.columns) == sorted(df.columns)
        assert plain(rows, df.columns) == plain(want.fetchall(), want.columns)


def test_droplets_that_share_a_name(spark, tmp_path):
    """Numbers of more than four digits: beads are counted by the name that is written."""
    spark.createDataFrame([(k, 1.0) for k in (30000, 30001, 30003, 30006)], "s_suppkey long, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    con = duckdb.connect()
    con.execute(f"create view supplier as select * from '{tmp_path}/supplier.parquet/*.parquet'")
    df = QUERIES["barcode_map_round_trip"](spark, str(tmp_path))
    want = con.sql(ORACLE_SQL["barcode_map_round_trip"])
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(want.fetchall(), want.columns)


def test_columns_that_differ_in_case_are_written(spark, data, tmp_path):
    QUERIES["read_qc"](spark, data).write.parquet(f"{tmp_path}/out")
    assert spark.conf.get("spark.sql.caseSensitive") == "false"


def test_gaps_at_intervals_that_start_before_the_contig(spark, tmp_path):
    """Unions over position 0, at it, before it and with a null end, and behind the contig's end."""
    con, n = duckdb.connect(), QUERIES["complement_intervals"]
    for i, keys in enumerate([[0, 4, 5, 9], [1, 2, 8], [-1, 0, 6], [-9, -7, 3, 40], [None, 4, 9], [0], [-7], [], [25, 30, 31]]):
        d = f"{tmp_path}/{i}"
        spark.createDataFrame([(k, 50, 1.0) for k in keys], "p_partkey long, p_size int, p_retailprice double").write.parquet(f"{d}/part.parquet")
        spark.createDataFrame([(k,) for k in (3, 20)], "l_partkey long").write.parquet(f"{d}/lineitem.parquet")
        for t in ("part", "lineitem"):
            con.execute(f"create or replace view {t} as select * from '{d}/{t}.parquet/*.parquet'")
        df = n(spark, d)
        want = con.sql(ORACLE_SQL["complement_intervals"])
        assert plain([tuple(r) for r in df.collect()], df.columns) == plain(want.fetchall(), want.columns), keys


@pytest.mark.parametrize("name", ["merge_by_jaccard", "merged_cell_names", "deconvolution_metrics"])
def test_fragments_of_a_merge_are_made_once(spark, data, name, monkeypatch):
    made, frag = spark.sparkContext.accumulator(0), adapters.frag

    @F.udf("long")
    def seen(start):
        made.add(1)
        return start

    monkeypatch.setattr(adapters, "frag", lambda *a: frag(*a).withColumn("start", seen("start")))
    QUERIES[name](spark, data).collect()
    assert made.value == frag(spark, data).count()
