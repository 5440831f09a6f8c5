"""Registered queries against their SQL on small tables whose keys are as large as those of large tables."""

import datetime
import random

import pytest

from locusloom.plans import catalogue

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    r, day = random.Random(5), datetime.datetime(1995, 1, 1)
    items = [(8_000_000 + k, r.randrange(1, 120_000), r.randrange(1, 6000), n, float(r.randrange(1, 51)), 100.0 + n, r.choice("NAR"), r.choice("FO"), day + datetime.timedelta(r.randrange(40))) for k in range(400) for n in range(1, 8)]
    at = str(tmp_path_factory.mktemp("large"))
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{at}/lineitem.parquet")
    return at


@pytest.mark.parametrize("name", ["childless_any", "locus_annotations"])
def test_lines_beyond_what_doubles_hold(spark, tables, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tables}/lineitem.parquet/*.parquet'")
    got = catalogue.QUERIES[name](spark, tables)
    columns = ", ".join(f'"{c}"' for c in got.columns)
    want = con.execute(f"SELECT {columns} FROM ({catalogue.ORACLES[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want)) and want
