"""Whole loads from CSV folders to tables."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Row

from tallyroll.plans.ingest import Batch, Limits, Slice, ingest, plan_batches
from tallyroll.schemas import PAYMENT_COLUMNS

PLAIN = "Artist,Track,Album,ISRC,Play_Date,Quantity,Net_Payment,Territory"


def payments(tables, *columns):
    rows = tables.read("payment").select(*(columns or PAYMENT_COLUMNS)).collect()
    return sorted((tuple(r) for r in rows), key=str)


def ledger(tables):
    return {
        (r.deal_name, r.vendor_name, r.file_name): r.total_net_payment
        for r in tables.read("file_summary").collect()
    }


def errors(tables):
    rows = tables.read("error_summary").collect()
    return sorted((r.file_path.rsplit("/", 1)[1], r.reason) for r in rows)


def test_plain_file(spark, tables, mapping, write, song_table):
    root = write(
        "Deal A/V1/x_Apr_2016.csv",
        PLAIN,
        "the band,don't stop,ac/dc,IS1,4/30/2016,3,\"$1,234.50\",us",
        " björk ,,,,,1,2.25,",
    )
    ingest(spark, tables, mapping, root)
    assert payments(tables) == sorted(
        [
            ("Deal A", "V1", "2016-04-30", "The Band", "Don'T Stop", "Ac/Dc", "IS1", "2016-04-30", None,
             "Streaming", "3", "$1,234.50", None, None, "Us", "x_Apr_2016.csv"),
            ("Deal A", "V1", "2016-04-30", "Bjrk", None, None, None, "2016-04-30", None,
             "Streaming", "1", "2.25", None, None, None, "x_Apr_2016.csv"),
        ],
        key=str,
    )
    assert ledger(tables) == {("Deal A", "V1", "x_Apr_2016.csv"): Decimal("1236.75")}
    assert song_table(tables) == [("IS1", "The Band", "Don'T Stop", "Ac/Dc", "2016-04-30", "Y")]
    registry = tables.read("metadata_management").collect()
    assert [(r.file_headers, r.report_date) for r in registry] == [
        (PLAIN.lower(), dt.date(2016, 4, 30))
    ]
    assert errors(tables) == []


def test_many_layouts_in_one_load(spark, tables, mapping, write):
    write(
        "D/V1/alias_QT1_2016.csv",
        "Performer,Song Title,Release,ISRC Code,Sale Date,Units,Payable",
        "ann,one,first,IS9,25/04/2016,7,10",
    )
    write("D/V1/sum_Apr_2016.csv", "Artist,Track,Net,Fee,Units", 'bob,two,"$1,000.25",,4', "cy,three,1,0.5,5")
    write("D/V1/only_May_2016.csv", "Net,Fee", "1,2")
    write("D/V 2/dot_Apr_2016.csv", "Artist.Name,Track.Title,Source", "dee,four,elsewhere", "eve,five,")
    write("D/V 2/type_Apr_2016.csv", "Type,Track", "Stream,", "Stream,named")
    write("D/V 2/typeonly_Apr_2016.csv", "Type", "Video")
    write("D/V 2/case_Apr_2016.csv", "artist,TRACK,net_payment", "fay,six,3")
    root = write("D/V 2/wide_Apr_2016.csv", ",".join(f"x{i}" for i in range(70)) + ",Track,Artist",
                 ",".join("" for _ in range(70)) + ",seven,gus")
    ingest(spark, tables, mapping, root)

    assert errors(tables) == []
    got = payments(tables, "File_Name", "Source", "Artist", "Track", "Play_Date", "Quantity", "Net_Payment")
    assert got == sorted(
        [
            ("alias_QT1_2016.csv", "V1", "Ann", "One", "2016-04-25", "7", "10"),
            ("sum_Apr_2016.csv", "V1", "Bob", "Two", "2016-04-30", "4", "1000.25"),
            ("sum_Apr_2016.csv", "V1", "Cy", "Three", "2016-04-30", "5", "1.5"),
            ("only_May_2016.csv", "V1", "D", None, "2016-05-31", None, "3.0"),
            ("dot_Apr_2016.csv", "elsewhere", "Dee", "Four", "2016-04-30", None, None),
            ("dot_Apr_2016.csv", None, "Eve", "Five", "2016-04-30", None, None),
            ("type_Apr_2016.csv", "V 2", "D", "Stream", "2016-04-30", None, None),
            ("type_Apr_2016.csv", "V 2", "D", "Named", "2016-04-30", None, None),
            ("typeonly_Apr_2016.csv", "V 2", "D", "Video", "2016-04-30", None, None),
            ("case_Apr_2016.csv", "V 2", "Fay", "Six", "2016-04-30", None, "3"),
            ("wide_Apr_2016.csv", "V 2", "Gus", "Seven", "2016-04-30", None, None),
        ],
        key=str,
    )
    signatures = {r.file_headers for r in tables.read("metadata_management").collect()}
    assert "artist name,track title,source" in signatures and len(signatures) == 8


def test_second_run_adds_nothing(spark, tables, mapping, write, song_table):
    root = write("D/V1/x_Apr_2016.csv", PLAIN, "a,t,al,IS1,,1,2,")
    ingest(spark, tables, mapping, root)
    before = (payments(tables), ledger(tables), song_table(tables), tables.read("metadata_management").count())
    run = ingest(spark, tables, mapping, root)
    assert run.loads == []
    assert before == (
        payments(tables), ledger(tables), song_table(tables), tables.read("metadata_management").count()
    )


def test_rejects_take_whole_files_and_leave_others(spark, tables, mapping, write, song_table):
    write("D/V1/good_Apr_2016.csv", PLAIN, "a,t,al,IS1,,1,2,")
    write("D/V1/date_Apr_2016.csv", PLAIN, "a,fine,al,IS2,,1,2,", "a,bad,al,IS3,20160430,1,2,", "a,bad,al,IS3,soon,1,2,")
    write("D/V1/sum_Apr_2016.csv", "Track,Net,Fee", "t,1,2", "t,abc,1")
    write("D/V1/rel_Apr_2016.csv", "Track,Release_Date", "t,never")
    write("D/V1/statement.csv", PLAIN, "a,t,al,IS1,,1,2,")
    write("D/V1/twice_Apr_2016.csv", "Track,track", "a,b")
    write("D/V1/blank_Apr_2016.csv", "")
    write("D/V1/skip_Apr_2016.CSV", PLAIN, "a,t,al,IS1,,1,2,")
    root = write("D/nobody/x_Apr_2016.csv", PLAIN, "a,t,al,IS1,,1,2,")
    ingest(spark, tables, mapping, root)

    assert errors(tables) == [
        ("blank_Apr_2016.csv", "no header line"),
        ("date_Apr_2016.csv", "not a date: Play_Date"),
        ("rel_Apr_2016.csv", "not a date: Release_Date"),
        ("statement.csv", "no report date in file name"),
        ("sum_Apr_2016.csv", "not a number: Net_Payment"),
        ("twice_Apr_2016.csv", "repeated header name"),
        ("x_Apr_2016.csv", "vendor has no sale category"),
    ]
    assert list(ledger(tables)) == [("D", "V1", "good_Apr_2016.csv")]
    assert {r[0] for r in payments(tables, "File_Name")} == {"good_Apr_2016.csv"}
    assert song_table(tables) == [("IS1", "A", "T", "Al", "2016-04-30", "Y")]

    # A rejected file is pending still: once mended it loads.
    write("D/V1/date_Apr_2016.csv", PLAIN, "a,fine,al,IS2,,1,2,")
    ingest(spark, tables, mapping, root)
    assert ("D", "V1", "date_Apr_2016.csv") in ledger(tables)


def test_header_only_file_is_entered_without_total(spark, tables, mapping, write):
    root = write("D/V1/none_Apr_2016.csv", PLAIN)
    ingest(spark, tables, mapping, root)
    assert ledger(tables) == {("D", "V1", "none_Apr_2016.csv"): None}


def test_earlier_date_makes_a_new_song_version(spark, tables, mapping, write, song_table):
    root = write("D/V1/x_Apr_2016.csv", PLAIN, "a,t,al,IS1,2016-04-10,1,2,", "a,u,,,2016-04-10,1,2,")
    ingest(spark, tables, mapping, root)
    write("D/V1/y_May_2016.csv", PLAIN, "a,t,al,IS1,2016-03-01,1,2,", "a,t,al,IS1,2016-05-01,1,2,", "a,u,,,2016-05-01,1,2,")
    ingest(spark, tables, mapping, root)
    assert song_table(tables) == [
        (" ", "A", "U", " ", "2016-04-10", "Y"),
        ("IS1", "A", "T", "Al", "2016-03-01", "Y"),
        ("IS1", "A", "T", "Al", "2016-04-10", "N"),
    ]
    write("D/V1/z_Jun_2016.csv", PLAIN, "a,t,al,IS1,2016-03-15,1,2,")
    ingest(spark, tables, mapping, root)
    assert len(song_table(tables)) == 3


def test_release_date_wins_per_row(spark, tables, mapping, write, song_table):
    root = write(
        "D/V1/x_Apr_2016.csv",
        "Artist,Track,Release_Date,Play_Date",
        "a,t,1/2/2010,2016-04-01",
        "a,u,,2016-04-02",
    )
    ingest(spark, tables, mapping, root)
    assert [r[4] for r in song_table(tables)] == ["2010-01-02", "2016-04-02"]
    assert payments(tables, "Release_Date") == sorted([("1/2/2010",), (None,)], key=str)


def test_small_batches_give_the_same_tables(spark, mapping, write, tmp_path, song_table):
    from tests.conftest import CATEGORIES
    from tallyroll.sources.tables import Tables

    for i in range(5):
        month = ["Jan", "Feb", "Feb", "Feb", "Mar"][i]
        root = write(f"D/V1/f{i}_{month}_2016.csv", PLAIN, f"a,t{i % 2},al,IS{i % 2},{5 - i}/1/2015,1,{i},")
    seen = []
    for name, limits in {"one": Limits(), "many": Limits(files=2)}.items():
        tables = Tables(spark, str(tmp_path / name)).create()
        tables.append("sales_category_lookup", "l", spark.createDataFrame(CATEGORIES, "vendor_name string, sales_category string"))
        run = ingest(spark, tables, mapping, root, limits=limits)
        current = [r for r in song_table(tables) if r[-1] == "Y"]
        versions = [
            (r.report_date, r.file_headers) for r in tables.read("metadata_management").collect()
        ]
        seen.append((payments(tables), ledger(tables), current, versions))
        assert (len(run.loads) == 1) == (name == "one")
    assert seen[0] == seen[1]
    assert len(seen[0][2]) == 2


def test_batches_are_neighbouring_slices_within_limits():
    sizes = [(0, 0, 0, 3, 10), (0, 1, 0, 4, 10), (1, 0, 0, 4, 10), (1, 0, 1, 10, 10), (2, 0, 0, 1, 500), (3, 0, 0, 1, 1)]
    slices = [Row(part=p, by_files=f, by_bytes=b, files=n, bytes=s) for p, f, b, n, s in sizes]
    at = [Slice(*s[:3]) for s in sizes]
    assert list(plan_batches(slices, Limits(files=10, bytes=100))) == [
        Batch(at[0], at[1]), Batch(at[2], at[2]), Batch(at[3], at[3]), Batch(at[4], at[4]), Batch(at[5], at[5])
    ]


@pytest.mark.parametrize("limits", [Limits(files=1), Limits(files=3), Limits(bytes=150), Limits()])
def test_slices_keep_the_order_of_files(spark, limits):
    from tallyroll.plans.ingest import in_slices

    days = [dt.date(2016, 1 + i % 3, 1) for i in range(20)]
    files = spark.createDataFrame([(d, f"file:///p{i:02d}", 50) for i, d in enumerate(days)], "report_date date, file_path string, bytes long")
    rows = in_slices(files, limits, 20).collect()
    key = lambda r: (r.part, r.by_files, r.by_bytes)
    order = sorted(rows, key=lambda r: (r.report_date, r.file_path))
    assert [key(r) for r in order] == sorted(map(key, rows)) and len(rows) == 20
    for own in {key(r) for r in rows}:
        some = [r for r in rows if key(r) == own]
        assert len(some) <= limits.files and sum(r.bytes for r in some) < limits.bytes + 50


def test_uncommitted_load_is_invisible_and_repeated(spark, tables, mapping, write, monkeypatch):
    root = write("D/V1/x_Apr_2016.csv", PLAIN, "a,t,al,IS1,,1,2,")

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "commit", fail)
        with pytest.raises(RuntimeError):
            ingest(spark, tables, mapping, root)
    assert payments(tables) == [] and ledger(tables) == {}
    ingest(spark, tables, mapping, root)
    assert len(payments(tables)) == 1 and len(ledger(tables)) == 1


def test_same_identity_in_two_roots_loads_once(spark, tables, mapping, write):
    one = write("D/V1/x_Apr_2016.csv", PLAIN, "a,t,al,IS1,,1,2,", root="r1")
    two = write("D/V1/x_Apr_2016.csv", PLAIN, "a,t,al,IS1,,1,9,", root="r2")
    ingest(spark, tables, mapping, two, one)
    assert ledger(tables) == {("D", "V1", "x_Apr_2016.csv"): Decimal("2")}


def test_one_vendor_folder(spark, tables, mapping, write):
    root = write("Deal A/V1/x_Apr_2016.csv", PLAIN, "a,t,al,IS1,,1,2,")
    write("Deal A/V1/deeper/y_Apr_2016.csv", PLAIN, "a,t,al,IS1,,1,2,")
    ingest(spark, tables, mapping, f"{root}/Deal A/V1/", folders="")
    assert list(ledger(tables)) == [("Deal A", "V1", "x_Apr_2016.csv")]


def test_odd_names_and_quoting(spark, tables, mapping, write):
    root = write("D [1]+50%/V1/{a}*_Apr_2016.csv", '"Track","Net_Payment"', '"a, b",1', "c,2,surplus", "d")
    ingest(spark, tables, mapping, root)
    assert payments(tables, "Deal", "Track", "Net_Payment") == sorted(
        [("D [1]+50%", "A, B", "1"), ("D [1]+50%", "C", "2"), ("D [1]+50%", "D", None)], key=str
    )


def test_line_without_surplus_header(spark, tables, mapping, write):
    """Blank lines before the header, BOM, and carriage returns."""
    root = write("D/V1/x_Apr_2016.csv", "﻿Track,Net_Payment\r", "t,1\r")
    write("D/V1/y_Apr_2016.csv", "", "Track,Net_Payment", "", "u,2")
    ingest(spark, tables, mapping, root)
    assert payments(tables, "Track", "Net_Payment") == [("T", "1"), ("U", "2")]


def test_batch_plan_has_no_shuffle_and_no_python(spark, tables, mapping, write, tmp_path):
    from tallyroll.plans.ingest import batch_payments, plan_files
    from tallyroll.sources.statements import list_files

    root = write("D/V1/x_Apr_2016.csv", PLAIN, "a,t,al,IS1,,1,2,")
    planned = plan_files(tables, mapping, list_files(spark, root))
    planned.write.parquet(str(tmp_path / "plan"))
    files = spark.read.parquet(str(tmp_path / "plan"))
    plan = batch_payments(spark, files, mapping)._jdf.queryExecution().executedPlan().toString()
    row_side = plan.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in row_side
    assert "Python" not in row_side and "ArrowEval" not in plan


def test_command_line(spark, tables, mapping, write, tmp_path, capsys, monkeypatch):
    import json

    from tallyroll import __main__ as cli

    root = write("D/V1/x_Apr_2016.csv", PLAIN, "a,t,al,IS1,,1,2,")
    (tmp_path / "mapping.json").write_text(json.dumps(mapping))
    cli.main([root, "--mapping", str(tmp_path / "mapping.json"), "--tables", tables.base])
    assert "1 load(s) committed" in capsys.readouterr().out
    assert ledger(tables) == {("D", "V1", "x_Apr_2016.csv"): Decimal("2")}
