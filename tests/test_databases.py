"""Tables in databases and catalogs, the contracts of all tables, and what is left in the shared folder."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from inuring.plans.queries import QUERIES
from inuring.sources import contracts, sinks, tables
from inuring.sources.contracts import CONTRACTS, Contract
from inuring.sources.tables import FIXTURES, Tables


@pytest.fixture(scope="module")
def derby(spark, sf_dir):
    """Two tables of an embedded database, one with dense and one with sparse keys."""
    url = "jdbc:derby:memory:inuring;create=true"
    properties = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark.range(1, 1001).select(F.col("id").cast("int").alias("layer_id"), (F.col("id") * 2.0).alias("occ_limit")).write.jdbc(url, "dense", properties=properties)
    spark.range(500).select((F.col("id") * 1000003 % 2000000011 - 9).cast("int").alias("layer_id"), F.lit(1.0).alias("occ_limit")).write.jdbc(url, "sparse", properties=properties)
    nulls = spark.range(300).select(F.when(F.col("id") % 3 > 0, F.col("id") * 100).cast("int").alias("layer_id"), F.col("id").alias("n"))
    nulls.write.jdbc(url, "nulls", properties=properties)
    return url, properties


@pytest.mark.parametrize("name,rows,key", [("dense", 1000, "layer_id"), ("sparse", 500, "layer_id"), ("nulls", 300, "n")])
def test_a_database_is_read_in_even_parts(spark, derby, name, rows, key):
    df = tables.jdbc_tables(spark, *derby, parts=8, rows_a_part=50)(name)
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    parts = min(8, rows // 50)
    assert df.rdd.getNumPartitions() == parts and sum(sizes) == rows == df.select(key).distinct().count()
    if name != "nulls":  # a third of its keys is null, and goes to one part
        assert max(sizes) <= 1.6 * rows / parts


def test_filters_and_columns_reach_the_database(spark, derby):
    df = tables.jdbc_tables(spark, *derby, parts=4, rows_a_part=100)("dense").where("occ_limit > 1990").select("layer_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(occ_limit), *GreaterThan(occ_limit,1990.0)]" in plan.replace("OCC_LIMIT", "occ_limit") and "ReadSchema: struct<layer_id:int>" in plan.replace("LAYER_ID", "layer_id")
    assert df.count() == 5


def test_a_small_table_is_read_at_once(spark, derby):
    assert tables.jdbc_tables(spark, *derby)("dense").rdd.getNumPartitions() == 1


@pytest.fixture
def setting(spark):
    keys = []

    def put(key, value):
        keys.append(key)
        spark.conf.set(key, value)

    yield put
    for key in keys:
        spark.conf.unset(key)


def test_tables_by_configuration(spark, sf_dir, derby, setting, tmp_path):
    """The same query over the fixtures, a catalog and a database."""
    rows = lambda df: sorted(map(tuple, df.collect()))
    expected = rows(QUERIES["scan_portfolios"](spark, sf_dir))
    fixtures = Tables(spark, sf_dir)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS inuring_test LOCATION '{tmp_path}/warehouse'")
    fixtures.portfolio.write.saveAsTable("inuring_test.portfolio")
    url, properties = derby
    fixtures.portfolio.write.jdbc(url, "portfolio", properties=properties)
    try:
        setting("spark.inuring.tables", "catalog:inuring_test")
        assert rows(QUERIES["scan_portfolios"](spark, "/nowhere")) == expected
        setting("spark.inuring.tables", url)
        setting("spark.inuring.jdbc.driver", properties["driver"])
        assert rows(QUERIES["scan_portfolios"](spark, "/nowhere")) == expected
        setting("spark.inuring.tables", "ftp:nowhere")
        with pytest.raises(ValueError, match="must begin with"):
            QUERIES["scan_portfolios"](spark, "/nowhere")
    finally:
        spark.sql("DROP DATABASE inuring_test CASCADE")


# --- contracts ------------------------------------------------------------------------------------------------------
def test_every_table_has_a_contract(spark, sf_dir):
    assert set(CONTRACTS) == set(FIXTURES)
    t = Tables(spark, sf_dir)
    assert {n: contracts.wrong_types(getattr(t, n), c) for n, c in CONTRACTS.items()} == {n: [] for n in CONTRACTS}
    for c in CONTRACTS.values():
        assert all(to in CONTRACTS and len(k) == len(CONTRACTS[to].key) for k, to in c.refers.items())


def test_violations_by_hand(spark):
    own = {
        "a": Contract("id int, code string", ("id",), (("code",),)),
        "b": Contract("x int, y string, a_id int", ("x", "y"), refers={("a_id",): "a"}),
    }
    given = {
        "a": spark.createDataFrame([(1, "p"), (2, "p"), (2, None), (None, "q"), (3, None)], "id int, code string"),
        "b": spark.createDataFrame([(1, "u", 1), (1, "v", 9), (1, "v", None), (2, None, 9)], "x int, y string, a_id int"),
    }
    found = contracts.violations(type("T", (), given), own)
    assert sorted(map(tuple, found.collect())) == [
        ("a", "primary id", "2", 2), ("a", "primary id", "null", 1), ("a", "unique code", "p", 2),
        ("b", "primary x+y", "1|v", 2), ("b", "primary x+y", "2|null", 1), ("b", "refers a_id", "9", 2),
    ]
    with pytest.raises(TypeError, match="a: code: int, string"):
        contracts.violations(type("T", (), given | {"a": spark.createDataFrame([(1, 1)], "id int, code int")}), own)


def test_a_batch_that_repeats_a_key(spark, tmp_path):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, v string")
    for _ in range(2):
        sinks.append_once(df, str(tmp_path / "t"), ["k"])
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t")).collect())) == [(1, "a"), (2, "c")]


PROGRAM = """
from pyspark.sql import SparkSession
from inuring.operators import graph
from inuring.sources.shared import cut
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "{0}").getOrCreate()
assert graph.topological_depth(cut(spark.createDataFrame([(1, 2), (2, 3)], "a int, b int")), "a", "b").count() == 3
import os
assert os.listdir("{0}")
spark.stop()
"""


def test_nothing_is_left_in_the_shared_folder(tmp_path):
    """A program that stops its session itself: its tables go with the JVM."""
    shared = tmp_path / "shared"
    shared.mkdir()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", PROGRAM.format(shared)], check=True, timeout=180, env=os.environ | {"PYTHONPATH": root}, cwd=str(tmp_path))
    assert [p for p in shared.rglob("*") if p.is_file() or p.name.startswith("inuring")] == []  # Spark makes an empty folder of its own
