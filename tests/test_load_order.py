"""Loads as a sequence of files: song history, retirement, listing, failures and runs at once."""

import os

import pytest

from tallyroll.operators import songs
from tallyroll.plans import ingest as plan
from tallyroll.plans.ingest import Limits, ingest
from tallyroll.sources import statements
from tallyroll.sources.statements import list_files
from tallyroll.sources.tables import Tables
from tests.conftest import CATEGORIES
from tests.test_ingest import PLAIN, errors, ledger, payments


def line(song, date, amount="2"):
    return f"a,t{song},al,IS{song},{date},1,{amount},"


def new_tables(spark, base, **options):
    made = Tables(spark, str(base), **options).create()
    made.append("sales_category_lookup", "l", spark.createDataFrame(CATEGORIES, "vendor_name string, sales_category string"))
    return made


def stored_songs(tables):
    rows = tables.read("song").select("Track", "Release_Date", "is_latest", "id", "replaces_id").collect()
    return sorted((r.Track, str(r.Release_Date), r.is_latest, r.id, r.replaces_id or "") for r in rows)


def test_history_is_one_version_a_file_whatever_the_batches(spark, mapping, write, tmp_path):
    """The reference order: files by report date and path, each sees the songs of those before."""
    files = {
        "D/V1/b_May_2016.csv": [line(1, "2016-04-01"), line(1, "2016-04-03"), line(2, "2016-05-05")],
        "D/V1/a_Apr_2016.csv": [line(1, "2016-04-05"), line(2, "2016-03-01")],
        "D/V1/c_May_2016.csv": [line(1, "2016-04-01"), line(2, "2016-02-01"), line(3, "2016-05-01")],
        "D/V1/d_May_2016.csv": [line(1, "2016-03-30"), line(3, "2016-04-01"), line(3, "2016-04-09")],
    }
    for where, lines in files.items():
        root = write(where, PLAIN, *lines)
    want = [("T1", "2016-03-30", "Y"), ("T1", "2016-04-01", "N"), ("T1", "2016-04-05", "N"), ("T2", "2016-02-01", "Y"),
            ("T2", "2016-03-01", "N"), ("T3", "2016-04-01", "Y"), ("T3", "2016-05-01", "N")]
    seen = []
    for name, limits in {"one": Limits(files=1), "three": Limits(files=3), "all": Limits()}.items():
        tables = new_tables(spark, tmp_path / name, song_buckets=4)
        run = ingest(spark, tables, mapping, root, limits=limits)
        seen.append(stored_songs(tables))
        assert len(run.loads) == {"one": 4, "three": 2, "all": 1}[name]
    assert seen[0] == seen[1] == seen[2]
    assert [r[:3] for r in seen[0]] == want
    by_id = {r[3]: r for r in seen[0]}
    for track, date, latest, _, replaced in seen[0]:
        later = [r for r in seen[0] if r[0] == track and r[1] > date]
        assert by_id[replaced][1] == min(r[1] for r in later) if later else replaced == ""
        assert (latest == "Y") == (date == min(r[1] for r in seen[0] if r[0] == track))


def titled(song, isrc, date):
    return f"a,t{song},al,{isrc},{date},1,2,"


def after_backfill(files):
    """Song table rows by a walk over files and songs: (track, isrc, date, flag)."""
    rows, live, known = [], {}, {}
    for lines in files:
        least = {}
        for song, isrc, date in lines:
            least[song, isrc] = min(date, least.get((song, isrc), date))
        for song in sorted({s for s, _ in least}):
            own = {i: d for (s, i), d in least.items() if s == song}
            heir = min(known.get(song, set()) or {i for i in own if i} or {""})
            known.setdefault(song, set()).update(i for i in own if i)
            if heir:
                dates = [d for d in (own.pop("", None), live.pop((song, ""), None)) if d]
                own.update({heir: min([*dates, own[heir]] if heir in own else dates)} if dates else {})
            for isrc, date in own.items():
                if date < live.get((song, isrc), "9"):
                    live[song, isrc] = date
                    rows.append((song, isrc, date))
    return sorted((f"T{s}", i or " ", d, "Y" if live.get((s, i)) == d else "N") for s, i, d in rows)


BACKFILL_FILES = {
    "D/V1/a_Apr_2016.csv": [(1, "", "2016-04-05"), (2, "", "2016-04-05"), (3, "Z3", "2016-04-05"), (4, "", "2016-04-09")],
    "D/V1/b_Apr_2016.csv": [(1, "", "2016-04-03"), (2, "B2", "2016-04-09"), (2, "A2", "2016-04-08"), (3, "", "2016-04-01")],
    "D/V1/c_May_2016.csv": [(1, "X1", "2016-04-30"), (1, "", "2016-05-01"), (2, "", "2016-04-02"), (3, "A3", "2016-03-01")],
    "D/V1/d_May_2016.csv": [(1, "", "2016-04-01"), (2, "B2", "2016-01-01"), (3, "", "2016-02-01"), (5, "", "2016-05-01")],
    "D/V1/e_Jun_2016.csv": [(1, "W1", "2016-01-01"), (4, "", "2016-04-01"), (5, "V5", "2016-06-01"), (5, "", "2016-04-01")],
}


def test_isrc_backfill_is_the_same_whatever_the_batches(spark, mapping, write, tmp_path):
    for where, lines in BACKFILL_FILES.items():
        root = write(where, PLAIN, *[titled(*line) for line in lines])
    seen = []
    for name, limits in {"one": Limits(files=1), "three": Limits(files=3), "all": Limits()}.items():
        tables = new_tables(spark, tmp_path / name, song_buckets=4)
        ingest(spark, tables, mapping, root, limits=limits, backfill_isrc=True)
        rows = tables.read("song").select("Track", "ISRC", "Release_Date", "is_latest", "id", "replaces_id").collect()
        seen.append(sorted((r.Track, r.ISRC, str(r.Release_Date), r.is_latest, r.id, r.replaces_id or "") for r in rows))
    assert seen[0] == seen[1] == seen[2]
    assert [r[:4] for r in seen[0]] == after_backfill(BACKFILL_FILES.values())
    # the song without ISRC of title 1 has gone over to X1, which keeps its date
    by_id = {r[4]: r for r in seen[0]}
    (went_over,) = [r for r in seen[0] if r[:3] == ("T1", "X1", "2016-04-03")]
    assert by_id[went_over[5]][:4] == ("T1", " ", "2016-04-03", "N")
    assert [r[:4] for r in seen[0] if r[0] == "T4" and r[3] == "Y"] == [("T4", " ", "2016-04-01", "Y")]
    again = ingest(spark, tables, mapping, root, backfill_isrc=True)
    assert again.loads == []


def test_isrc_backfill_over_songs_loaded_without_it(spark, mapping, write, tmp_path):
    """Songs stored with and without ISRC: the next file of the title merges them, and later loads
    without the option may have both again."""
    tables = new_tables(spark, tmp_path / "t", song_buckets=4)
    root = write("D/V1/a_Apr_2016.csv", PLAIN, titled(1, "", "2016-04-01"), titled(1, "M1", "2016-04-03"))
    ingest(spark, tables, mapping, root)

    def latest():
        rows = tables.read("song").where("is_latest = 'Y'").collect()
        return sorted((r.ISRC, str(r.Release_Date)) for r in rows)

    assert latest() == [(" ", "2016-04-01"), ("M1", "2016-04-03")]
    write("D/V1/b_May_2016.csv", PLAIN, titled(1, "", "2016-05-01"))
    ingest(spark, tables, mapping, root, backfill_isrc=True)
    assert latest() == [("M1", "2016-04-01")]
    write("D/V1/c_Jun_2016.csv", PLAIN, titled(1, "", "2016-06-01"))
    ingest(spark, tables, mapping, root)
    assert latest() == [(" ", "2016-06-01"), ("M1", "2016-04-01")]


def test_versions_take_one_shuffle(spark):
    key = "ISRC string, Artist string, Track string, Album string"
    stored = spark.createDataFrame([], f"id string, {key}, Release_Date date")
    lines = spark.createDataFrame([], f"{key}, song_date date, report_date string, file_path string")
    incoming = songs.candidates(lines, normalised=True, by=songs.FILE_ORDER)
    plan_text = songs.song_versions(stored, incoming)._jdf.queryExecution().executedPlan().toString()
    assert plan_text.count("Exchange hashpartitioning") <= 3  # the lines' aggregate, and both sides on the key
    assert "RoundRobin" not in plan_text and "SinglePartition" not in plan_text


def test_retired_versions_are_stored_and_only_touched_buckets_are_read(spark, mapping, write, tmp_path):
    tables = new_tables(spark, tmp_path / "t", song_buckets=8)
    root = write("D/V1/x_Apr_2016.csv", PLAIN, *[line(i, "2016-04-10") for i in range(40)])
    first = ingest(spark, tables, mapping, root).loads[0]
    write("D/V1/y_May_2016.csv", PLAIN, line(3, "2016-03-01"), line(5, "2016-05-01"))
    second = ingest(spark, tables, mapping, root).loads[0]
    latest = tables.read("song").where("is_latest = 'Y'")
    assert latest.count() == latest.select("Track").distinct().count() == 40 and tables.read("song").count() == 41
    # one bucket written anew, the others are still the first load's
    owners = {r.bucket: r.load_id for r in tables._last_buckets()}
    assert list(owners.values()).count(second) == 1 and set(owners.values()) == {first, second}
    (touched,) = [b for b, load in owners.items() if load == second]
    read = tables.songs([touched]).inputFiles()
    assert read and all(f"load_id={second}/bucket={touched}/" in f for f in read)
    assert Tables(spark, tables.base, song_buckets=3).read("song").count() == 41  # the table keeps its number
    write("D/V1/z_Jun_2016.csv", PLAIN, line(3, "2016-06-01"))
    third = ingest(spark, tables, mapping, root).loads[0]
    assert third not in {r.load_id for r in tables._last_buckets()}


def test_every_listed_file_is_in_ledger_or_errors(spark, tables, mapping, write):
    write("D/V1/x_Apr_2016.csv", PLAIN, line(1, "2016-04-01"))
    write("D/V1/_y_Apr_2016.csv", PLAIN, line(1, "2016-04-01"))
    write("D/V1/.w_Apr_2016.csv", PLAIN, line(1, "2016-04-01"))
    root = write("D/V1/é ü_Apr_2016.csv", PLAIN, line(2, "2016-04-01"))
    os.makedirs(f"{root}/D/V1/folder.csv")
    open(f"{root}/D/V1/z_Apr_2016.csv", "w").close()
    other = write("D/V1/x_Apr_2016.csv", PLAIN, line(1, "2016-04-01", "9"), root="second")
    listed = {r.path.rsplit("/", 1)[1] for r in list_files(spark, root).collect()}
    assert listed == {"x_Apr_2016.csv", "_y_Apr_2016.csv", ".w_Apr_2016.csv", "z_Apr_2016.csv", "é ü_Apr_2016.csv"}
    ingest(spark, tables, mapping, other, root)
    assert {k[2] for k in ledger(tables)} == {"x_Apr_2016.csv", "é ü_Apr_2016.csv"}
    found = dict(errors(tables))
    assert found.keys() == {"_y_Apr_2016.csv", ".w_Apr_2016.csv", "z_Apr_2016.csv", "x_Apr_2016.csv"}
    assert found["z_Apr_2016.csv"] == "no header line" and found["_y_Apr_2016.csv"] == "file name begins with _ or ."
    assert found["x_Apr_2016.csv"].startswith("same deal, vendor and name as file:")
    assert len(payments(tables)) == 2


def test_reported_path_is_what_rows_report(spark, tmp_path):
    names = ["a b", "é", "日本", "100%", "a+b", "x#y", "q?", "[z]{1}", "a;b,c=d&e@f!~'()*", "　x", "tab\tx", 'quo"te', "back\\slash", "^`|<>"]
    for name in names:
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_text("h\nv\n")
        path = f"file:{tmp_path}/{name}/f.csv"
        if "\\" in name:
            continue  # Hadoop takes a backslash for a folder's end
        rows = statements.scan_statements(spark, [path], [0]).collect()
        assert [r.file_path for r in rows] == [statements.reported_path(path)], name


def test_unreadable_folder_is_an_error_row(spark, tables, mapping, tmp_path):
    ingest(spark, tables, mapping, str(tmp_path / "nowhere"))
    assert errors(tables) == [("nowhere", "unreadable folder: FileNotFoundError")]


def test_a_file_gone_after_planning_leaves_the_others(spark, tables, mapping, write, monkeypatch):
    for name in "abcd":
        root = write(f"D/V1/{name}_Apr_2016.csv", PLAIN, line(ord(name), "2016-04-01"))
    planned = plan.in_slices

    def lose(files, limits, count):
        os.remove(f"{root}/D/V1/b_Apr_2016.csv")
        return planned(files, limits, count)

    monkeypatch.setattr(plan, "in_slices", lose)
    ingest(spark, tables, mapping, root)
    assert sorted(k[2][0] for k in ledger(tables)) == ["a", "c", "d"]
    assert errors(tables) == [("b_Apr_2016.csv", "unreadable file: FileNotFoundError")]
    assert len(payments(tables)) == 3


def test_a_file_that_fails_in_the_scan_alone_is_found_by_halving(spark, tables, mapping, write, monkeypatch):
    from pyspark.errors import AnalysisException

    for name in "abcde":
        root = write(f"D/V1/{name}_Apr_2016.csv", PLAIN, line(ord(name), "2016-04-01"))
    scan = plan.scan_batch

    def failing(session, chosen):
        if any("/d_Apr" in f.path for f in chosen):
            raise AnalysisException("[FAILED_READ_FILE.NO_HINT] while reading d")
        return scan(session, chosen)

    monkeypatch.setattr(plan, "scan_batch", failing)
    ingest(spark, tables, mapping, root)
    assert sorted(k[2][0] for k in ledger(tables)) == ["a", "b", "c", "e"]
    (found,) = errors(tables)
    assert found[0] == "d_Apr_2016.csv" and found[1].startswith("unreadable file: ")

    def broken(session, chosen):
        raise AnalysisException("something else")

    monkeypatch.setattr(plan, "scan_batch", broken)
    with pytest.raises(AnalysisException):  # not a matter of one file
        ingest(spark, tables, mapping, root)


def test_payments_are_written_once_though_a_file_is_rejected(spark, tables, mapping, write, monkeypatch):
    write("D/V1/good_Apr_2016.csv", PLAIN, line(1, "2016-04-01"))
    write("D/V1/amount_Apr_2016.csv", PLAIN, line(2, "2016-04-01", "2.x"))
    root = write("D/V1/bad_Apr_2016.csv", PLAIN, line(2, "soon"), line(3, "2016-04-01"))
    staged = []
    stage = tables.stage
    monkeypatch.setattr(tables, "stage", lambda name, load, rows: staged.append(name) or stage(name, load, rows))
    ingest(spark, tables, mapping, root)
    assert staged.count("payment") == 1
    assert {r[0] for r in payments(tables, "File_Name")} == {"good_Apr_2016.csv"}
    assert [k[2] for k in ledger(tables)] == ["good_Apr_2016.csv"]
    assert errors(tables) == [("amount_Apr_2016.csv", "not a number: Net_Payment"), ("bad_Apr_2016.csv", "not a date: Play_Date")]
    assert [r[0] for r in stored_songs(tables)] == ["T1"]


def test_two_runs_at_once_load_each_file_once(spark, tables, mapping, write, monkeypatch):
    write("D/V1/x_Apr_2016.csv", PLAIN, line(1, "2016-04-10"))
    root = write("D/V1/y_May_2016.csv", PLAIN, line(1, "2016-03-01"))
    commit, other = tables.commit, Tables(spark, tables.base)

    def late(load_id, after=None):
        if after is not None and not late.done:
            late.done = True
            ingest(spark, other, mapping, root, limits=Limits(files=1))  # another run, start to end
            write("D/V1/z_Jun_2016.csv", PLAIN, line(1, "2016-02-01"))
        return commit(load_id, after)

    late.done = False
    monkeypatch.setattr(tables, "commit", late)
    run = ingest(spark, tables, mapping, root)
    assert run.loads == []
    assert sorted(k[2][0] for k in ledger(tables)) == ["x", "y"] and tables.read("file_summary").count() == 2
    assert len(payments(tables)) == 2
    ingest(spark, tables, mapping, root)
    assert [r[1:3] for r in stored_songs(tables)] == [("2016-02-01", "Y"), ("2016-03-01", "N"), ("2016-04-10", "N")]


def test_commit_numbers_are_taken_once(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "t")).create()
    assert tables.last_commit() == 0 and tables.commits().count() == 0
    assert tables.commit("a", 0) and not tables.commit("b", 0) and tables.commit("c")
    assert {(r.load_id, r.number) for r in tables.commits().collect()} == {("a", 1), ("c", 2)}
    assert tables.last_commit() == 2
