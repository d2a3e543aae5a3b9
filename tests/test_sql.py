"""Queries against their SQL on the smallest tables, as the driver compares them."""

import os

import duckdb
import pytest

from contigo.plans import formats, queries

D = "/root/testdata/sf0.001"
NAMES = [k.removeprefix("q_") for k in vars(formats) if k.startswith("q_")] + ["not_in_list", "number_singletons", "unique_successors", "dbscan", "kendall", "agp"]


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(D):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{D}/{f}'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, db, name):
    f, sql = queries.QUERIES[name]
    got = f(spark, D)
    columns = sorted(got.columns)
    found = db.execute(sql)
    at = [[x[0] for x in found.description].index(c) for c in columns]
    plain = lambda v: round(v, 9) + 0.0 if isinstance(v, float) else v
    mine = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    assert mine == sorted((tuple(plain(r[k]) for k in at) for r in found.fetchall()), key=repr)


def lines_of(spark, tmp_path, name, rows):
    """The query's rows over such lines (order, part, supplier, number), and those of its SQL on one thread, which keeps the order of equal rows."""
    df = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int")
    df.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    f, sql = queries.QUERIES[name]
    got = f(spark, str(tmp_path))
    c = duckdb.connect(config={"threads": 1})
    c.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    return sorted(map(tuple, got.collect()), key=repr), sorted(c.execute(f"SELECT {', '.join(got.columns)} FROM ({sql})").fetchall(), key=repr)


def test_merged_regions_of_nulls(spark, tmp_path):
    """Regions without a start, without an end, and of a null supplier, beside equal ones."""
    one = [(0, 5, 1, 3), (0, 5, 1, 3), (0, 5, 1, None), (0, None, 1, 2), (0, None, 1, None), (0, 20, 1, 1), (0, 9, 1, None), (0, None, 2, 1), (0, 7, 2, 4), (0, 30, 3, None), (0, 31, 3, 1), (0, 3, None, 2), (0, None, None, 2)]
    mine, said = lines_of(spark, tmp_path, "merged_regions", one)
    assert mine == said and (2, 7, 11, 2) in mine


def test_tandem_features_of_nulls(spark, tmp_path):
    """Lines without a number after others and alone, of a null order and a null family, beside equal ones."""
    one = [(1, 0, 5, 2), (1, 0, 10, 2), (1, 0, 0, 3), (1, 0, 5, None), (2, 0, 5, None), (3, 0, 6, 4), (3, 0, 6, 7), (3, 0, 1, None), (None, 0, 2, 1), (None, 0, 7, 2), (4, 0, None, 3), (4, 0, None, None)]
    mine, said = lines_of(spark, tmp_path, "tandem_features", one)
    assert mine == said and (1, None, 2) in mine
