"""Operators on small frames: files, layouts, conforming, songs, sources, arrivals."""

import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from tallyroll.operators import manifest, payments, songs
from tallyroll.operators.conform import conform
from tallyroll.operators.layout import layout_columns, resolve
from tallyroll.sources import jdbc
from tallyroll.sources.mapping import check_mapping, load_mapping, mapping_table
from tallyroll.schemas import PAYMENT_COLUMNS, destination
from tallyroll.sources.statements import HeaderError, header_of, list_files

SONG = "ISRC string, Artist string, Track string, Album string, song_date date"


def day(text):
    return dt.date.fromisoformat(text)


# --- files and headers -----------------------------------------------------------------


def test_listing_takes_exact_suffix_and_depth(spark, write):
    write("D/V/a_Apr_2016.csv", "x", "1")
    write("D/V/b.CSV", "x")
    write("D/V/c.csv.gz", "x")
    write("D/V/deeper/d.csv", "x")
    root = write("D/W/e.csv", "x")
    names = {r.path.rsplit("/", 1)[1] for r in list_files(spark, root).collect()}
    assert names == {"a_Apr_2016.csv", "e.csv"}


@pytest.mark.parametrize(
    "content, expected",
    [
        (b"a,b\n1,2\n", ["a", "b"]),
        (b"\xef\xbb\xbfa,b", ["a", "b"]),
        (b"\n  \r\na, b \r\n1", ["a", " b "]),
        (b'"a,x","b ""q"""\n', ["a,x", 'b "q"']),
        ("é,b\n".encode(), ["é", "b"]),
        (b"", None),
        (b"\n\n", None),
        (b"h" * 200_000 + b",z\n1,2\n", ["h" * 200_000, "z"]),
    ],
)
def test_header_of(content, expected):
    assert header_of(io.BytesIO(content)) == expected


class Endless(io.RawIOBase):
    """A stream that repeats one byte and counts what is read of it."""

    def __init__(self, byte):
        self.byte, self.taken = byte, 0

    def read(self, size=-1):
        self.taken += size
        return self.byte * size


def test_a_header_line_is_read_up_to_its_limit():
    stream = Endless(b"x")
    with pytest.raises(HeaderError, match="longer than 300000 bytes"):
        header_of(stream, 300_000)
    assert stream.taken < 400_000
    assert header_of(io.BytesIO(b"a" * 1000 + b"\nrow"), 1000) == ["a" * 1000]
    with pytest.raises(HeaderError):
        header_of(io.BytesIO(b"a" * 1001 + b"\nrow"), 1000)
    assert header_of(io.BytesIO(b" " * 200_000 + b"\n\na,b\n" + b"x" * 200_000), 1000) == ["a", "b"]
    long = b",".join(b"name %d" % i for i in range(20_000))
    assert len(header_of(io.BytesIO(b"\n" + long + b"\r\n1,2"))) == 20_000


@pytest.mark.parametrize(
    "line, quoted",
    [(b'a,"b', True), (b'"a\nb",c', True), (b'a,"b""', True), (b'a,"b\\"', True), (b'a,"b"",c"', False),
     (b'a,b"c', False), (b'a\\"b,"c"', False), (b'"",""', False)],
)
def test_a_header_name_does_not_span_lines(line, quoted):
    if quoted:
        with pytest.raises(HeaderError, match="inside a quoted"):
            header_of(io.BytesIO(line))
    else:
        assert len(header_of(io.BytesIO(line))) >= 1


def test_destinations_that_loads_cannot_fill_are_refused():
    for columns in (PAYMENT_COLUMNS[1:3], [*PAYMENT_COLUMNS, "artist"], [*PAYMENT_COLUMNS, "Type"],
                    [*PAYMENT_COLUMNS, "reject"], [*PAYMENT_COLUMNS, "a.b"], [*PAYMENT_COLUMNS, ""],
                    [*[c for c in PAYMENT_COLUMNS if c != "Deal"], "deal"]):
        with pytest.raises(ValueError):
            destination(columns)
    with pytest.raises(ValueError, match="currency"):
        layout_columns({"Currency": ["Cur"]})
    assert "at_Currency" in layout_columns({"Currency": ["Cur"]}, destination([*PAYMENT_COLUMNS, "Currency"]))


def test_signature_keeps_order_and_names_blank_headers(spark):
    rows = spark.createDataFrame([(["B.x ", "", "\tA"],), (["A", "B x", ""],)], "header array<string>")
    got = [r[0] for r in rows.select(manifest.header_signature(F.col("header"))).collect()]
    assert got == ["b x,_c1,a", "a,b x,_c2"]


def test_header_versions_are_per_deal_and_vendor(spark):
    columns = "deal_name string, vendor_name string, file_headers string, report_date date"
    files = spark.createDataFrame(
        [("D", "V", "a,b", day("2016-05-31")), ("D", "V", "a,b", day("2016-04-30")),
         ("D", "W", "a,b", day("2016-05-31")), ("D", "V", "old", day("2016-05-31"))], columns)
    held = spark.createDataFrame([("D", "V", "old", day("2015-01-31"))], columns)
    got = {(r.vendor_name, r.file_headers, str(r.report_date)) for r in manifest.header_versions(files, held).collect()}
    assert got == {("V", "a,b", "2016-04-30"), ("W", "a,b", "2016-05-31")}


def test_mapping_refuses_order_dependence(spark, tmp_path):
    check_mapping({"Artist": ["Artist", "Performer"], "Total": ["Net_Payment++Fee"]})
    for bad in ({"Artist": ["N"], "Track": ["n "]}, {"Artist": ["Track"], "Track": []}, {"A": [], "a": []}, {"A": ["x++"]}):
        with pytest.raises(ValueError):
            check_mapping(bad)
    path = tmp_path / "m.json"
    path.write_text('{"Artist": ["Performer"], "Net_Payment": ["Net++Fee"]}')
    mapping = load_mapping(spark, str(path))
    rows = [tuple(r) for r in mapping_table(spark, mapping).collect()]
    assert rows == [("Artist", 0, "Performer", ["performer"]), ("Net_Payment", 0, "Net++Fee", ["net", "fee"])]


def conformed(spark, mapping, header, *rows):
    facts = "file_path string, deal_name string, vendor_name string, file_name string, report_date date, sale_category string"
    file = spark.createDataFrame([("f", "deal", "ven", "f.csv", day("2016-04-30"), "cat")], facts)
    file = file.withColumn("header", F.array(*map(F.lit, header))).withColumn("header_problem", F.lit(None).cast("string"))
    cells = spark.createDataFrame([(list(r), "f") for r in rows], "cells array<string>, file_path string")
    return conform(cells, resolve(file, mapping), mapping)


def test_first_alias_and_own_name_win(spark):
    mapping = {"Net_Payment": ["Late", "Net++Fee", "Payable"]}
    values = [
        (["Payable", "Net", "Fee"], ["9", "1", "2"], "3.0"),
        (["Payable", "Net"], ["9", "1"], "9"),
        (["Late", "Net", "Fee"], ["7", "1", "2"], "7"),
        (["NET_PAYMENT", "Net", "Fee"], ["5", "1", "2"], "5"),
    ]
    for header, row, expected in values:
        assert conformed(spark, mapping, header, row).first().Net_Payment == expected


def test_summed_columns_stay_as_plain_numbers(spark):
    mapping = {"Net_Payment": ["Quantity++Fee"]}
    row = conformed(spark, mapping, ["Quantity", "Fee"], ["$1,000", None]).first()
    assert (row.Net_Payment, row.Quantity, row.bad_amount) == ("1000.0", "1000", None)
    row = conformed(spark, mapping, ["Quantity", "Fee"], [" ", "x"]).first()
    assert (row.Net_Payment, row.Quantity, row.bad_amount) == (None, "0.0", "Net_Payment")
    row = conformed(spark, mapping, ["Quantity"], ["$1,000"]).first()
    assert (row.Net_Payment, row.Quantity) == (None, "$1,000")


def test_layout_columns_follow_the_mapping():
    assert "parts_Net_Payment" in layout_columns({"Net_Payment": ["a++b"]})
    assert not any(c.startswith("parts_") for c in layout_columns({"Net_Payment": ["a"]}))


def test_sale_category_takes_the_least(spark):
    lookup = spark.createDataFrame([("V", "b"), ("V", "a")], "vendor_name string, sales_category string")
    files = spark.createDataFrame([("V",), ("W",)], "vendor_name string")
    got = {r.vendor_name: r.sale_category for r in payments.with_sale_category(files, lookup).collect()}
    assert got == {"V": "a", "W": None}


# --- songs -----------------------------------------------------------------------------


def as_versions(spark, rows):
    found = songs.candidates(spark.createDataFrame(rows, SONG))
    return songs.song_delta(empty_current(spark), found)


def empty_current(spark):
    return spark.createDataFrame([], "id string, ISRC string, Artist string, Track string, Album string, Release_Date date")


def test_candidates_normalise_and_take_the_earliest(spark):
    rows = [
        ("IS1", "the band", "one", None, day("2016-05-01")),
        ("IS1", "THE BAND", "One", " ", day("2016-04-01")),
        (None, "x", "y", "z", day("2016-04-01")),
        ("", "x", "y", "z", day("2016-04-02")),
        ("IS2", "x", "", "z", day("2016-04-01")),
        ("IS2", None, "y", "z", day("2016-04-01")),
        ("IS2", "x", "y", "z", None),
    ]
    got = {tuple(map(str, r)) for r in songs.candidates(spark.createDataFrame(rows, SONG)).collect()}
    assert got == {("IS1", "The Band", "One", " ", "2016-04-01"), (" ", "X", "Y", "Z", "2016-04-01")}


def test_any_grouping_of_files_gives_the_same_current_songs(spark):
    rng = random.Random(7)
    files = [
        [(f"IS{rng.randint(0, 4)}", "a", f"t{rng.randint(0, 2)}", "b", day(f"2016-{rng.randint(1, 12):02d}-01"))
         for _ in range(6)]
        for _ in range(4)
    ]
    expected = {tuple(r) for r in songs.current(as_versions(spark, sum(files, []))).collect()}
    for order in ([[0], [1], [2], [3]], [[3, 1], [2, 0]], [[2], [0, 1, 3]]):
        versions = None
        for group in order:
            incoming = songs.candidates(spark.createDataFrame(sum((files[i] for i in group), []), SONG))
            held = songs.current(versions) if versions is not None else empty_current(spark)
            delta = songs.song_delta(held, incoming)
            versions = delta if versions is None else versions.unionByName(delta)
            versions = spark.createDataFrame(versions.collect(), versions.schema)
        assert {tuple(r) for r in songs.current(versions).collect()} == expected
        shown = songs.latest_flags(versions)
        assert {r.id for r in shown.where("is_latest = 'Y'").collect()} == {r[5] for r in expected}


def test_isrc_backfill_takes_least_isrc_and_earliest_date(spark):
    stored = songs.current(as_versions(spark, [(None, "a", "t", "b", day("2016-05-01")), ("IS9", "a", "u", "b", day("2016-05-01"))]))
    incoming = songs.candidates(spark.createDataFrame(
        [("IS2", "a", "t", "b", day("2016-06-01")), ("IS3", "a", "t", "b", day("2016-01-01")),
         (None, "a", "t", "b", day("2016-04-01")), ("IS8", "a", "u", "b", day("2016-01-01"))], SONG))
    got = [(r.ISRC, r.Track, str(r.Release_Date)) for r in songs.isrc_backfills(stored, incoming).collect()]
    assert got == [("IS2", "T", "2016-04-01")]


# --- other sources ---------------------------------------------------------------------


def test_jdbc_options_hold_only_what_the_caller_gives():
    connection = {"url": "jdbc:x", "driver": "d"}
    assert jdbc.read_options("Song", connection) == {**connection, "dbtable": "Song", "fetchsize": "10000"}
    split = jdbc.read_options("Song", connection, "id", 0, 100, 8)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "0", "100", "8")
    with pytest.raises(ValueError):
        jdbc.read_options("Song", connection, "id")
    assert jdbc.write_options("Song", connection, connections=4)["numPartitions"] == "4"


def test_arrivals_load_once_whatever_their_age(spark, tables, mapping, write, tmp_path):
    """Restarted over one checkpoint; nothing but the tables remembers files."""
    import os

    from tallyroll.streaming.arrivals import ingest_arrivals

    def run():
        query = ingest_arrivals(spark, tables, mapping, root, str(tmp_path / "stream"))
        query.awaitTermination()
        return sorted(r.file_name for r in tables.read("file_summary").collect())

    write("Deal A/V1/x_Apr_2016.csv", "Track,Net_Payment", "t,1")
    root = write("Deal A/V1/nodate.csv", "Track,Net_Payment", "t,1")
    assert run() == ["x_Apr_2016.csv"]
    write("Deal A/V1/y_May_2016.csv", "Track,Net_Payment", "t,1")
    os.utime(f"{root}/Deal A/V1/y_May_2016.csv", (1_000_000, 1_000_000))
    assert run() == ["x_Apr_2016.csv", "y_May_2016.csv"]
    assert tables.read("payment").count() == 2
    assert [r.file_path.rsplit("/", 1)[1] for r in tables.read("error_summary").collect()] == ["nodate.csv"]
    logs = [p.read_text() for p in (tmp_path / "stream").rglob("*") if p.is_file() and not p.name.endswith(".crc")]
    assert logs and not any("_2016" in log for log in logs)


def test_unreadable_arrivals_are_tried_again(spark):
    from tallyroll.streaming.arrivals import unsettled

    listed = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "file_path string, bytes long")
    rows = [("a", "no report date"), ("b", "unreadable file: FileNotFoundError"), ("z", "no report date")]
    errors = spark.createDataFrame(rows, "file_path string, reason string")
    assert sorted(r.file_path for r in unsettled(listed, errors).collect()) == ["b", "c"]
