"""Column functions against Python's own string, date and decimal behaviour."""

import calendar
import datetime as dt
import random
import string
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyroll import functions as fn

ASCII = string.ascii_letters + string.digits + " '\"/-.,&_\t\n\x0b\x0c\r\x1c\x1f()"


def random_text(n, alphabet, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 24))) for _ in range(n)]


def test_blank_treats_null_and_whitespace_alike(values):
    inputs = [None, "", " ", "\t\n", "\x1c\x1f", "a", " a "]
    assert values(fn.blank, inputs) == [True] * 5 + [False] * 2


def test_ascii_clean_equals_python(values):
    inputs = random_text(2000, ASCII + "éß漢 ñ😀", 1)
    expected = ["".join(ch for ch in s if ord(ch) < 128).strip() for s in inputs]
    assert values(fn.ascii_clean, inputs) == expected


def test_title_ascii_equals_python(values):
    inputs = random_text(3000, ASCII, 2) + ["don't", "ac/dc", "3rd", "mIXED caSE", "ijssel"]
    expected = [s.title() if s.strip() else None for s in inputs]
    assert values(fn.title_ascii, inputs) == expected


def test_title_ascii_drops_non_ascii_and_blanks(values):
    assert values(fn.title_ascii, ["beyoncé x", None, " ", "§ a"]) == ["Beyonc X", None, None, " A"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("$1,234.50", Decimal("1234.5")),
        ("-3", Decimal("-3")),
        (" 7.25 ", Decimal("7.25")),
        ("0.0000153", Decimal("0.0000153")),
        ("1.2E-5", Decimal("0.000012")),
        ("abc", None),
        ("", None),
        (None, None),
    ],
)
def test_amount(values, text, expected):
    assert values(fn.amount, [text]) == [expected]


def test_combined_amount(spark):
    rows = spark.createDataFrame(
        [("$1,000.50", "2"), ("", "3"), (None, None), ("x", "1")], "a string, b string"
    )
    out = [r[0] for r in rows.select(fn.combined_amount([F.col("a"), F.col("b")])).collect()]
    assert out == [Decimal("1002.5"), Decimal("3"), Decimal("0"), None]


def test_amount_text(spark):
    rows = spark.sql(
        "select explode(array(1234.5, 100, 0, -0.25, 0.0000153)) v"
    ).select(F.col("v").cast("decimal(28,10)").alias("v"))
    out = [r[0] for r in rows.select(fn.amount_text(F.col("v"))).collect()]
    assert out == ["1234.5", "100.0", "0.0", "-0.25", "0.0000153"]


def test_any_date_examples(values):
    cases = {
        "2016-04-30": "2016-04-30",
        "2016/4/3": "2016-04-03",
        "4/30/2016": "2016-04-30",
        "25/04/2016": "2016-04-25",
        "3/4/2016": "2016-03-04",
        "2/30/2016": None,
        "30042016": "2016-04-30",
        "1112016": "2016-01-11",
        "20160430": None,
        "30-Apr-2016": "2016-04-30",
        "sept/9/2016": "2016-09-09",
        "4/30/16": "2016-04-30",
        "4/30/85": "1985-04-30",
        "2016-04-30 10:15:00": "2016-04-30",
        "2016-04-30T10:15:00.250Z": "2016-04-30",
        "4/30/2016 1:05 PM": "2016-04-30",
        "04-2016": None,
        "4/30-2016": None,
        "soon": None,
        "n/a": None,
        "": None,
        None: None,
    }
    expected = [dt.date.fromisoformat(v) if v else None for v in cases.values()]
    assert values(fn.any_date, list(cases)) == expected


def test_any_date_equals_python_parsers(values):
    parse = pytest.importorskip("dateutil.parser").parse
    rng = random.Random(5)

    def reference(text):
        try:
            if "/" in text or "-" in text:
                return parse(text).date()
            return dt.datetime.strptime(text, "%d%m%Y").date()
        except (ValueError, OverflowError):
            return None

    def sample():
        y, m, d = rng.randint(1971, 2068), rng.randint(1, 14), rng.randint(1, 33)
        name = rng.choice(list(calendar.month_abbr)[1:] + list(calendar.month_name)[1:])
        sep = rng.choice("/-")
        pad = rng.choice([str, lambda n: f"{n:02d}"])
        return rng.choice(
            [
                f"{y}{sep}{pad(m)}{sep}{pad(d)}",
                f"{pad(m)}{sep}{pad(d)}{sep}{y}",
                f"{pad(d)}{sep}{pad(m)}{sep}{y}",
                f"{pad(d)}{sep}{name}{sep}{y}",
                f"{name}{sep}{pad(d)}{sep}{y}",
                f"{d:02d}{m:02d}{y}",
                f"{d}{m}{y}",
                f"{y}{m:02d}{d:02d}",
                f"{y}-{pad(m)}-{pad(d)} 0{rng.randint(0, 9)}:{rng.randint(10, 59)}:00",
            ]
        )

    inputs = [sample() for _ in range(6000)]
    got = values(fn.any_date, inputs)
    wrong = [(s, g, reference(s)) for s, g in zip(inputs, got) if g != reference(s)]
    assert not wrong, (len(wrong), wrong[:20])


def test_report_date(values):
    cases = {
        "x_Apr_2016.csv": "2016-04-30",
        "x_feb_2016.csv": "2016-02-29",
        "x_FEBRUARY_2015.csv": "2015-02-28",
        "a_b_Sept_2017.csv": "2017-09-30",
        "x_QT1_2016.csv": "2016-03-31",
        "x_qt4_2016.csv": "2016-12-31",
        "x_7_2016.csv": "2016-07-31",
        "x_07_2016.csv": "2016-07-31",
        "x_Apr_2016.csv.csv": "2016-04-30",
        "x_QT5_2016.csv": None,
        "x_13_2016.csv": None,
        "x_Apr_16.csv": None,
        "statement.csv": None,
        "2016.csv": None,
    }
    expected = [dt.date.fromisoformat(v) if v else None for v in cases.values()]
    assert values(fn.report_date, list(cases)) == expected


def test_path_parts(spark):
    row = (
        spark.createDataFrame([("s3://b/root/Deal%20A+1/V%251/x_Apr_2016.csv",)], "p string")
        .select(fn.decode_path(F.col("p")).alias("p"))
        .select(fn.deal_name(F.col("p")), fn.vendor_name(F.col("p")), fn.file_name(F.col("p")))
        .first()
    )
    assert tuple(row) == ("Deal A+1", "V%1", "x_Apr_2016.csv")


def test_functions_need_no_python_worker_and_no_codegen_break(spark):
    rows = spark.range(1).select(F.col("id").cast("string").alias("v"))
    v = F.col("v")
    plan = rows.select(
        fn.any_date(v), fn.title_ascii(v), fn.ascii_clean(v), fn.amount(v), fn.report_date(v)
    )._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert plan.startswith("*(1) Project")


def test_cleaning_trims_only_where_an_end_is_blank(values):
    """Most texts are whole; only others are taken apart."""
    texts = ["ab", " ab", "ab\x1f", "a b", "", " ", None, "é", "aé", "a é", "\xa0a", "~"]
    assert values(fn.ascii_clean, texts) == ["ab", "ab", "ab", "a b", "", "", None, "", "a", "a", "a", "~"]
    assert values(fn.unreadable_amount, ["1.12345678901", "$1.12345678900", "12345678.5", "1,2,3", None, " "]) == [
        True, False, False, False, False, False]
