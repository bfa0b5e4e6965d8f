import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyroll.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate one column function over a list of strings, keeping their order."""

    def run(function, inputs):
        rows = spark.createDataFrame(list(enumerate(inputs)), "i int, v string")
        out = rows.select("i", function(F.col("v")).alias("out")).collect()
        return [r.out for r in sorted(out, key=lambda r: r.i)]

    return run


MAPPING = {
    "Artist": ["Performer", "Artist Name"],
    "Track": ["Song Title", "Track Title"],
    "Album": ["Release"],
    "ISRC": ["ISRC Code"],
    "Play_Date": ["Sale Date"],
    "Quantity": ["Units"],
    "Net_Payment": ["Payable", "Net++Fee"],
}

CATEGORIES = [("V1", "Streaming"), ("V1", "Zeta"), ("V 2", "Download")]


@pytest.fixture
def mapping():
    return dict(MAPPING)


@pytest.fixture
def write(tmp_path):
    """Write one statement: write("Deal/V1/x_Apr_2016.csv", "header", "row", ...)."""

    def run(where, *lines, root="statements"):
        path = tmp_path / root / where
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines) + ("\n" if lines else ""), encoding="utf-8")
        return str(tmp_path / root)

    return run


@pytest.fixture
def tables(spark, tmp_path):
    from tallyroll.sources.tables import Tables

    made = Tables(spark, str(tmp_path / "tables")).create()
    made.append(
        "sales_category_lookup",
        "lookup",
        spark.createDataFrame(CATEGORIES, "vendor_name string, sales_category string"),
    )
    return made


@pytest.fixture
def song_table():
    """The stored song table, with its stored flags."""

    def run(tables):
        rows = tables.read("song").select("ISRC", "Artist", "Track", "Album", "Release_Date", "is_latest").collect()
        return sorted(tuple("" if v is None else str(v) for v in r) for r in rows)

    return run
