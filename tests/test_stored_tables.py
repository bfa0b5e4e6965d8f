"""The payment table's columns as data, merged loads and clean-up."""

import glob
import time

import pytest

from tallyroll.plans.ingest import Limits, ingest
from tallyroll.schemas import PAYMENT_COLUMNS
from tallyroll.sources.tables import Tables


def rows(tables, *columns):
    return sorted((tuple(r) for r in tables.read("payment").select(*columns).collect()), key=str)


def loads(tables, name):
    return {r.load_id for r in tables.read(name).select("load_id").distinct().collect()}


def some_loads(spark, tables, mapping, write):
    """Four files in two loads; one of the second is rejected."""
    write("D/V1/a_Apr_2016.csv", "Artist,Track,Net_Payment", "ann,one,1", "ann,two,2")
    write("D/V1/b_May_2016.csv", "Artist,Track,Net_Payment", "bob,three,4")
    write("D/V1/bad_May_2016.csv", "Artist,Track,Net_Payment", "cy,four,no number")
    root = write("E/V 2/c_Apr_2016.csv", "Artist,Track,Net_Payment", "dee,five,8")
    ingest(spark, tables, mapping, root, limits=Limits(files=2))
    return root


def test_columns_of_the_payment_table_are_data(spark, tables, mapping, write):
    root = write("D/V1/a_Apr_2016.csv", "Artist,Track,Cur,Tax", "ann,one,EUR,1")
    ingest(spark, tables, mapping, root)
    tables.set_payment_columns([*[c for c in PAYMENT_COLUMNS if c != "Territory"], "Currency", "Tax"])
    write("D/V1/b_May_2016.csv", "Artist,Track,Cur,Tax,Territory", "bob,two, usd ,2,us")
    write("D/V1/c_May_2016.csv", "Artist,Track,Currency", "cy,three,\"a ,b\"")

    later = Tables(spark, tables.base).create()
    ingest(spark, later, {**mapping, "Currency": ["Cur"]}, root)
    assert later.read("payment").columns[:17] == list(later.destination().columns)
    assert later.destination().columns[-2:] == ("Currency", "Tax") and "Territory" not in later.read("payment").columns
    assert rows(later, "File_Name", "Artist", "Currency", "Tax") == [
        ("a_Apr_2016.csv", "Ann", None, None), ("b_May_2016.csv", "Bob", "usd", "2"), ("c_May_2016.csv", "Cy", "a ,b", None)
    ]
    with pytest.raises(ValueError, match="territory"):
        ingest(spark, later, {**mapping, "Territory": ["Land"]}, root)
    tables.refresh()
    assert tables.destination() == later.destination()


def test_merged_loads_hold_the_same_rows_in_fewer_files(spark, tables, mapping, write, song_table):
    root = some_loads(spark, tables, mapping, write)
    names = ("payment", "file_summary", "metadata_management")
    before = {n: sorted(map(str, tables.read(n).drop("load_id").collect())) for n in names}
    old = tables.read("payment")
    assert len(loads(tables, "payment")) == 2
    for name in names:
        done = tables.compact(name)
        assert loads(tables, name) == {done}
        folder = tables.path(name)
        assert len(glob.glob(f"{folder}/load_id={done}/**/*.parquet", recursive=True)) <= 2
        assert sorted(map(str, tables.read(name).drop("load_id").collect())) == before[name]
    # a reader that began before still sees its own state, and the rejected file stays out
    assert old.count() == 4 and "bad_May_2016.csv" not in str(before["payment"])
    songs = song_table(tables)
    ingest(spark, tables, mapping, root)
    assert sorted(map(str, tables.read("payment").drop("load_id").collect())) == before["payment"]
    write("D/V1/d_May_2016.csv", "Artist,Track,Net_Payment", "eve,six,16")
    ingest(spark, tables, mapping, root)
    tables.compact()
    assert len(loads(tables, "payment")) == 1 and tables.read("payment").count() == 5
    assert len(song_table(tables)) == len(songs) + 1
    with pytest.raises(ValueError, match="error_summary"):
        tables.compact("error_summary")


def test_a_commit_in_between_undoes_merging(spark, tables, mapping, write, monkeypatch):
    some_loads(spark, tables, mapping, write)
    stage = tables.stage

    def slow_stage(name, load_id, staged):
        stage(name, load_id, staged)
        if name == "merged_loads":
            other = Tables(spark, tables.base)
            other.commit("some-other-load")

    monkeypatch.setattr(tables, "stage", slow_stage)
    assert tables.compact() is None
    assert len(loads(tables, "payment")) == 2 and tables.read("payment").count() == 4


def test_vacuum_deletes_only_what_is_out_of_use(spark, tables, mapping, write, song_table):
    root = some_loads(spark, tables, mapping, write)
    write("D/V1/e_May_2016.csv", "Artist,Track,Play_Date,Net_Payment", "ann,one,2016-01-05,1")
    ingest(spark, tables, mapping, root)
    names = ("payment", "file_summary", "metadata_management", "error_summary", "sales_category_lookup")
    tables.compact()
    tables.stage("payment", "draft", tables.read("payment"))
    assert tables.vacuum(older_than=3600) == []
    before = {n: sorted(map(str, tables.read(n).collect())) for n in names}
    songs = song_table(tables)

    time.sleep(0.1)
    gone = tables.vacuum(older_than=0)
    assert f"{tables.path('payment')}/load_id=draft" in gone
    assert any("/runs/" in g for g in gone) and any("/song/load_id=" in g for g in gone)
    assert len(glob.glob(f"{tables.path('payment')}/load_id=*")) == 1
    assert {n: sorted(map(str, tables.read(n).collect())) for n in names} == before
    assert song_table(tables) == songs
    assert tables.vacuum(older_than=0) == []
    ingest(spark, tables, mapping, root)
    assert {n: sorted(map(str, tables.read(n).collect())) for n in names} != {} and song_table(tables) == songs


def test_a_header_that_rows_cannot_be_read_by_rejects_its_file(spark, tables, mapping, write):
    write("D/V1/open_Apr_2016.csv", 'Artist,"Track', 'name",Net_Payment', "ann,one,1")
    write("D/V1/long_Apr_2016.csv", "Artist," + "x" * (1 << 20), "ann")
    root = write("D/V1/fine_Apr_2016.csv", "Artist,Track", "ann,one")
    ingest(spark, tables, mapping, root)
    found = {r.file_path.rsplit("/", 1)[1]: r.reason for r in tables.read("error_summary").collect()}
    assert found == {
        "open_Apr_2016.csv": "line end inside a quoted header name",
        "long_Apr_2016.csv": "header line longer than 1048576 bytes",
    }
    assert rows(tables, "File_Name") == [("fine_Apr_2016.csv",)]
