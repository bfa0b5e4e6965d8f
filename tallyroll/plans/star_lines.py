"""Statement lines derived from the star-schema tables.

Each line item becomes one line of a vendor's statement: the deal is the customer's market
segment, the vendor the supplier's nation, the file the month of the order. Only the
tables that the asked-for columns need are read and joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.session import compilable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a one-file table over all cores.

    A file with one row group is one task, whatever is computed from it. Tables of several
    files are left as they are, so nothing is shuffled that is large.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if len(rows.inputFiles()) > 1 or rows.rdd.getNumPartitions() >= cores:
        return rows
    return rows.repartition(cores)


def day(column: str) -> Column:
    return F.col(column).cast("date")


_MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()


def statement_file(deal: Column, when: Column) -> Column:
    """`<deal>_<Mon>_<year>.csv`; a formatter is left to years that have not four digits."""
    name = F.get(F.array(*map(F.lit, _MONTHS)), F.month(when) - 1)
    plain = F.concat(name, F.lit("_"), F.year(when).cast("string"))
    month = F.when(F.year(when).between(1000, 9999), plain).otherwise(F.date_format(when, "MMM_yyyy"))
    return F.concat(deal, F.lit("_"), month, F.lit(".csv"))


def _raw_play_date() -> Column:
    """The ship date in one of four forms: blank, ISO, month first, and run together.

    Taken from the ISO text where the year has four digits: a formatter costs several times as much.
    """
    kind, date = F.col("l_linenumber") % 4, day("l_shipdate")
    iso = date.cast("string")
    year, month, day_ = F.substring(iso, 1, 4), F.month(date).cast("string"), F.dayofmonth(date).cast("string")
    plain = F.year(date).between(1, 9999)
    return (
        F.when(kind == 0, "")
        .when(kind == 1, F.when(plain, iso).otherwise(F.date_format(date, "yyyy-MM-dd")))
        .when(
            kind == 2,
            F.when(plain, F.concat(month, F.lit("/"), day_, F.lit("/"), year)).otherwise(F.date_format(date, "M/d/yyyy")),
        )
        .otherwise(
            F.when(plain, F.concat(F.substring(iso, 9, 2), F.substring(iso, 6, 2), year))
            .otherwise(F.date_format(date, "ddMMyyyy"))
        )
    )


def _spoiled_play_date() -> Column:
    """The raw play date, with one kind of line that has none in some vendors' Februaries."""
    spoiled = (
        (F.col("n_nationkey") % 5 == 3) & (F.month("o_orderdate") == 2) & (F.col("l_linenumber") == 1)
    )
    return F.when(spoiled, F.lit("soon")).otherwise(_raw_play_date())


def money_text(column: str) -> Column:
    return F.concat(F.lit("$"), F.col(column).cast("decimal(18,2)").cast("string"))


# What each column is, and the tables beyond lineitem it needs.
_DEFINITIONS = {
    "order_key": (lambda: F.col("l_orderkey"), ()),
    "line_number": (lambda: F.col("l_linenumber"), ()),
    "vendor_key": (lambda: F.col("n_nationkey"), ("nation",)),
    "deal_name": (lambda: F.col("c_mktsegment"), ("customer",)),
    "vendor_name": (lambda: F.col("n_name"), ("nation",)),
    "file_name": (lambda: statement_file(F.col("c_mktsegment"), F.col("o_orderdate")), ("customer",)),
    "report_date": (lambda: F.last_day(day("o_orderdate")), ("orders",)),
    "Artist": (lambda: F.col("p_brand"), ("part",)),
    "Track": (lambda: F.col("p_name"), ("part",)),
    "Album": (lambda: F.concat("p_type", F.lit(" vol-"), F.col("l_suppkey").cast("string")), ("part",)),
    "ISRC": (
        lambda: F.when(F.col("p_size") % 5 == 0, "").otherwise(
            F.concat(F.lit("IS"), F.col("p_partkey").cast("string"))
        ),
        ("part",),
    ),
    "Play_Date": (_raw_play_date, ()),
    "Spoiled_Play_Date": (_spoiled_play_date, ("nation", "orders")),
    "Release_Date": (
        lambda: F.when(
            F.col("l_returnflag") == "R", F.date_format(F.date_sub(day("l_shipdate"), 30), "d-MMM-yyyy")
        ).otherwise(""),
        (),
    ),
    "Quantity": (lambda: F.col("l_quantity").cast("int").cast("string"), ()),
    "Net_Payment": (lambda: money_text("l_extendedprice"), ()),
    "Fee": (
        lambda: F.when(F.col("l_linenumber") % 3 == 0, "").otherwise(
            F.col("l_tax").cast("decimal(18,2)").cast("string")
        ),
        (),
    ),
    "Service_Provider": (lambda: F.lower("n_name"), ("nation",)),
    "Service_Type": (lambda: F.col("o_orderpriority"), ("orders",)),
    "Territory": (lambda: F.col("r_name"), ("region",)),
    "Type": (lambda: F.concat(F.lit("type "), F.col("l_linestatus")), ()),
}

# Tables reached through another one.
_THROUGH = {"customer": ("orders",), "nation": ("supplier",), "region": ("nation", "supplier")}

# What hangs on a line, each with its keys and what is joined to it first. Every row that is shuffled
# stays on disk until the query ends, so what is narrow comes first and wide text last. Suppliers are joined
# without their nations: the product that Spark takes a join's size for would hide that they may be broadcast.
_BRANCHES = [
    ("supplier", "l_suppkey", "s_suppkey", []),
    ("orders", "l_orderkey", "o_orderkey", [("customer", "o_custkey", "c_custkey")]),
    ("part", "l_partkey", "p_partkey", []),
    ("nation", "s_nationkey", "n_nationkey", []),
    ("region", "n_regionkey", "r_regionkey", []),
]

def statement_lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Statement lines with the given columns. What is worked out from them makes long methods; it is
    worked out after the joins, so that no text of it is shuffled with the lines."""
    compilable(spark)
    needed = {t for c in columns for t in _DEFINITIONS[c][1]}
    needed |= {t for n in needed for t in _THROUGH.get(n, ())}
    lines = spread(table(spark, sf_dir, "lineitem"))
    for name, left, right, further in _BRANCHES:
        if name not in needed:
            continue
        other = table(spark, sf_dir, name)
        for name_2, left_2, right_2 in further:
            if name_2 in needed:
                other = other.join(table(spark, sf_dir, name_2), F.col(left_2) == F.col(right_2))
        lines = lines.join(other, F.col(left) == F.col(right))
    return lines.select(*[_DEFINITIONS[c][0]().alias(c) for c in columns])
