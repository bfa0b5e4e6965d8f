"""Every registered query against its SQL meaning, over whole tables."""

import os

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry
from tallyroll.operators import conform
from tallyroll.plans.star_oracles import ORACLES
from tallyroll.plans.star_lines import statement_file, statement_lines
from tallyroll.plans.star_queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem documents".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def normal(value):
    return f"{value:.6f}" if isinstance(value, float) else str(value)


def in_order(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(names)
    want = in_order(expected.fetchall(), names)
    got = in_order(result.collect(), result.columns)
    assert want, "an oracle without rows checks nothing"
    assert len(got) == len(want)
    different = [(g, w) for g, w in zip(got, want) if g != w]
    assert not different, different[:3]


def test_entry_runs(spark):
    assert entry(spark).count() > 0


def test_small_tables_are_joined_before_lines(spark):
    """Lines are shuffled once for each key of their own, whatever hangs on what."""
    lines = statement_lines(spark, SF_DIR, "deal_name", "file_name", "Track", "vendor_name", "Territory")
    plan = lines._jdf.queryExecution().optimizedPlan()
    joins = [line for line in plan.toString().splitlines() if "Join Inner" in line]
    assert len(joins) == 6
    assert sum("(l_" in line or "= l_" in line for line in joins) == 3
    first = plan.toString().index("o_custkey#")
    assert "c_custkey" in plan.toString()[first : first + 400]


def on_lines(plan):
    return sum("l_orderkey#" in line and "Relation" in line for line in plan.splitlines())


@pytest.mark.parametrize("name", ["accepted_totals", "payment_rows", "payment_rows_wide", "conform_aliases"])
def test_files_are_planned_once(spark, name):
    """The plan of the files takes all lines; it is kept between its count and its use."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().withCachedData().toString()
    assert on_lines(plan) == 1
    assert "InMemoryRelation" in plan


def test_what_is_shuffled_with_lines_is_narrow(spark):
    """Suppliers may be broadcast, lines are shuffled twice, and no file name or nation goes along."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(os.path.getsize(f"{SF_DIR}/supplier.parquet")))
    try:
        lines = statement_lines(spark, SF_DIR, "file_name", "vendor_name", "Play_Date", "Track", "Album", "ISRC", "Territory")
        plan = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning(l_") == 2
    shuffled = plan[plan.index("Exchange hashpartitioning(l_") :]
    shuffled = shuffled[: shuffled.index("FileScan")]
    assert "_file_name" not in shuffled and "n_name" not in shuffled and "r_name" not in shuffled


def test_file_names_of_all_years(spark):
    """Months as a formatter writes them, also of years that have not four digits."""
    when = "'0001-01-31', '0999-12-31', '1000-02-01', '1994-09-30', '9999-12-31', null"
    for kind in ("timestamp", "date"):
        rows = spark.sql(f"select explode(array({when})) as d").select(F.col("d").cast(kind))
        by_formatter = F.concat(F.lit("A_"), F.date_format("d", "MMM_yyyy"), F.lit(".csv"))
        found = rows.select(statement_file(F.lit("A"), F.col("d")), by_formatter).collect()
        assert len(found) == 6 and all(a == b for a, b in found)


@pytest.mark.parametrize("name", ["payment_rows", "payment_rows_wide"])
def test_equal_rows_are_shuffled_with_a_number_for_their_file(spark, monkeypatch, name):
    """The same rows come out with and without the number, which stands for what the engine sets."""
    numbered = QUERIES[name](spark, SF_DIR)
    plan = numbered._jdf.queryExecution().executedPlan().toString().splitlines()
    exchange = [line for line in plan if "Exchange hashpartitioning(kind" in line]
    assert len(exchange) == 1
    assert not any(f"{c}#" in exchange[0] for c in ("Deal", "Report_Date", "Sale_Category", "File_Name"))
    monkeypatch.setattr(conform, "BROADCAST_FILES", 0)
    plain = QUERIES[name](spark, SF_DIR)
    assert "hashpartitioning(kind" not in plain._jdf.queryExecution().executedPlan().toString()
    assert plain.columns == numbered.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, numbered.collect()))
