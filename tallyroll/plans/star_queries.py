"""The engine's operators over whole star-schema tables.

Every query runs the library's own operators; `star_oracles` says the same in plain SQL.
Dates are given as text and exact sums as double, so that results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyroll.functions import (
    amount,
    amount_text,
    any_date,
    ascii_clean,
    blank,
    combined_amount,
    key_text,
    title_ascii,
    unreadable_amount,
)
from tallyroll.operators import manifest, payments, rejects, songs
from tallyroll.operators.conform import conform, is_few
from tallyroll.operators.layout import resolve
from tallyroll.plans.star_lines import day, spread, statement_file, statement_lines, table
from tallyroll.schemas import FILE_KEY, PAYMENT, PAYMENT_COLUMNS, SONG_KEY, Destination, destination

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _double(column: str) -> Column:
    return F.col(column).cast("double").alias(column)


def _texts(df: DataFrame, *dates: str) -> DataFrame:
    return df.withColumns({d: F.col(d).cast("string") for d in dates})


# --- files -----------------------------------------------------------------------------


def _path(deal: Column, vendor: Column, name: Column) -> Column:
    return F.concat(F.lit("s3://bucket/in/"), deal, F.lit("/"), vendor, F.lit("/"), name)


def _order_files(spark: SparkSession, sf_dir: str, name: Column) -> DataFrame:
    """One path per deal, vendor (the customer's nation here) and file, with its orders."""
    rows = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return rows.groupBy(_path(F.col("c_mktsegment"), F.col("n_name"), name).alias("path")).agg(
        F.count(F.lit(1)).alias("orders")
    )


def _monthly_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = statement_file(F.col("c_mktsegment"), F.col("o_orderdate"))
    return manifest.with_identity(_order_files(spark, sf_dir, name))


@query
def file_manifest(spark, sf_dir):
    files = _monthly_files(spark, sf_dir)
    return _texts(files.select(*FILE_KEY, "report_date", "orders"), "report_date")


@query
def quarter_report_date(spark, sf_dir):
    name = F.concat(
        F.lit("sales_qt"), F.quarter("o_orderdate"), F.lit("_"), F.year("o_orderdate"), F.lit(".csv")
    )
    files = manifest.with_identity(_order_files(spark, sf_dir, name))
    return _texts(files.select(*FILE_KEY, "report_date", "orders"), "report_date")


@query
def pending_files(spark, sf_dir):
    files = _monthly_files(spark, sf_dir)
    ledger = files.where(F.year("report_date") < 1998)
    return _texts(manifest.pending(files, ledger).select(*FILE_KEY, "report_date"), "report_date")


@query
def one_file_per_identity(spark, sf_dir):
    """The same identity under several roots: one root per order priority."""
    root = F.concat(F.lit("root-"), F.substring("o_orderpriority", 1, 1), F.lit("/"))
    rows = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.concat(
                root, "c_mktsegment", F.lit("/all/"), statement_file(F.col("c_mktsegment"), F.col("o_orderdate"))
            ).alias("path")
        )
        .dropDuplicates()
    )
    return manifest.one_per_identity(manifest.with_identity(rows)).select(*FILE_KEY, "path")


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose header carries the order's status and priority, in mixed spelling."""
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("c_mktsegment").alias("deal_name"),
            F.concat(F.lit("V"), F.col("c_nationkey").cast("string")).alias("vendor_name"),
            F.last_day(day("o_orderdate")).alias("report_date"),
            F.array(
                F.concat(F.lit("Artist."), "o_orderstatus"), F.lit("\tTrack "), F.lit(" "), "o_orderpriority"
            ).alias("header"),
        )
        .withColumn("file_headers", manifest.header_signature(F.col("header")))
    )


@query
def new_header_versions(spark, sf_dir):
    files = _headers(spark, sf_dir)
    registry = files.where(F.year("report_date") < 1996).select("deal_name", "vendor_name", "file_headers")
    new = manifest.header_versions(files.where(F.year("report_date") >= 1996), registry.distinct())
    return _texts(new.drop("create_date"), "report_date")


# --- cleaning --------------------------------------------------------------------------


@query
def ascii_cleaned(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", ascii_clean(F.col("text")).alias("clean"))


@query
def blank_lines(spark, sf_dir):
    """Lines of every document with how many of them are blank."""
    docs = spread(table(spark, sf_dir, "documents"))
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(blank(F.col("line"))).alias("n_blank"),
    )


@query
def title_case(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.concat("p_name", F.lit("/"), "p_type").alias("source"))
    customer = table(spark, sf_dir, "customer").select(
        F.concat("c_mktsegment", F.lit("'s "), "c_name").alias("source")
    )
    region = table(spark, sf_dir, "region").select(F.col("r_name").alias("source"))
    priority = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("source"))
    every = part.unionByName(customer).unionByName(region).unionByName(priority)
    return (
        every.groupBy("source")
        .agg(F.count(F.lit(1)).alias("uses"))
        .withColumn("titled", title_ascii(F.col("source")))
    )


@query
def key_blank_fill(spark, sf_dir):
    lines = statement_lines(spark, sf_dir, "ISRC")
    return lines.groupBy(key_text(F.col("ISRC")).alias("ISRC")).agg(F.count(F.lit(1)).alias("lines"))


@query
def play_date_normalised(spark, sf_dir):
    rows = statement_lines(spark, sf_dir, "Play_Date", "report_date", "Release_Date")
    rows = rows.withColumns({"deal_name": F.lit(""), "Artist": F.lit(""), "Track": F.lit(""), "Type": F.lit("")})
    filled = payments.fill_defaults(rows)
    return _texts(
        filled.groupBy("report_date", F.col("play_day").alias("play_date"), F.col("release_day").alias("release_date"))
        .agg(F.count(F.lit(1)).alias("lines")),
        "report_date",
        "play_date",
        "release_date",
    )


@query
def combined_amount_lines(spark, sf_dir):
    lines = statement_lines(spark, sf_dir, "order_key", "line_number", "Net_Payment", "Fee")
    total = combined_amount([F.col("Net_Payment"), F.col("Fee")])
    return lines.select(
        "order_key", "line_number", "Net_Payment", "Fee", amount_text(total).alias("total")
    )


# --- conforming ------------------------------------------------------------------------

# Aliases for the three header layouts that the vendors are spread over.
MAPPING = {
    "Artist": ["Performer", "Artist Name"],
    "Track": ["Song Title"],
    "Album": ["Release"],
    "ISRC": ["ISRC Code"],
    "Play_Date": ["Sale Date"],
    "Quantity": ["Units"],
    "Net_Payment": ["Payable", "Net++Fee"],
    "Territory": ["Region Name"],
}

# Header of each layout with the line column behind each field.
LAYOUTS = [
    {
        "Performer": "Artist",
        "Song Title": "Track",
        "Release": "Album",
        "ISRC Code": "ISRC",
        "Sale Date": "Spoiled_Play_Date",
        "Units": "Quantity",
        "Payable": "Net_Payment",
        "Region.Name": "Territory",
    },
    {
        "Net": "Net_Payment",
        "artist": "Artist",
        "Fee": "Fee",
        "TRACK": "Track",
        "Play_Date": "Spoiled_Play_Date",
        "Quantity": "Quantity",
    },
    {
        "Type": "Type",
        "Source": "Service_Provider",
        "Album": "Album",
        "ISRC": "ISRC",
        "Release_Date": "Release_Date",
        "Net_Payment": "Net_Payment",
        "Service_Type": "Service_Type",
    },
]
_LINE_COLUMNS = sorted({c for layout in LAYOUTS for c in layout.values()})


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two categories for each vendor, none for some vendors."""
    nation = table(spark, sf_dir, "nation").where("n_nationkey % 4 <> 0")
    category = F.explode(F.array(F.concat(F.lit("Cat "), "n_regionkey"), F.lit("Zed")))
    return nation.select(F.col("n_name").alias("vendor_name"), category.alias("sales_category"))


def _layout_number() -> Column:
    return F.col("vendor_key") % len(LAYOUTS)


def _cells() -> Column:
    """A line's fields in the order of its vendor's header."""
    cells = F.array(*LAYOUTS[-1].values())
    for number, layout in enumerate(LAYOUTS[:-1]):
        cells = F.when(_layout_number() == number, F.array(*layout.values())).otherwise(cells)
    return cells


def _header() -> Column:
    header = F.array(*map(F.lit, LAYOUTS[-1]))
    for number, layout in enumerate(LAYOUTS[:-1]):
        header = F.when(_layout_number() == number, F.array(*map(F.lit, layout))).otherwise(header)
    return header


# A payment table without territories, and with columns of its own: one that a file's column fills
# (and a sum uses), one that an alias fills, and one that no file has.
WIDE = destination([*[c for c in PAYMENT_COLUMNS if c != "Territory"], "Fee", "Market", "Currency"])
_WIDE_MAPPING = {"Market" if t == "Territory" else t: aliases for t, aliases in MAPPING.items()}


def _planned_files(
    spark: SparkSession, sf_dir: str, mapping: dict = MAPPING, to: Destination = PAYMENT
) -> DataFrame:
    """The statement files behind the lines, planned as a load plans them."""
    lines = statement_lines(spark, sf_dir, "deal_name", "vendor_name", "file_name", "vendor_key").distinct()
    path = _path(F.col("deal_name"), F.col("vendor_name"), F.col("file_name"))
    files = lines.select(path.alias("path"), "vendor_key").dropDuplicates()
    with_header = files.select(
        "path",
        F.col("path").alias("file_path"),
        _header().alias("header"),
        F.lit(None).cast("string").alias("header_problem"),
    )
    resolved = resolve(manifest.with_identity(with_header), mapping, to)
    return payments.with_sale_category(resolved, _lookup(spark, sf_dir))


def _plan_once(files: DataFrame) -> DataFrame:
    """The plan kept, one row a file: a load reads it from storage, where here it takes all lines, and
    `conform` looks at it twice."""
    return files.persist()


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines as a scan of the files would give them."""
    lines = statement_lines(
        spark, sf_dir, "deal_name", "vendor_name", "file_name", "vendor_key", *_LINE_COLUMNS
    )
    path = _path(F.col("deal_name"), F.col("vendor_name"), F.col("file_name"))
    return lines.select(_cells().alias("cells"), path.alias("file_path"))


def _loaded_rows(
    spark: SparkSession, sf_dir: str, mapping: dict = MAPPING, to: Destination = PAYMENT
) -> DataFrame:
    """Payment rows of all files that have a vendor category, bad rows among them."""
    files = _plan_once(rejects.loadable(_planned_files(spark, sf_dir, mapping, to)))
    return _payment_rows_of(spark, sf_dir, files, mapping, to)


def _payment_rows_of(spark: SparkSession, sf_dir: str, files: DataFrame, mapping: dict, to: Destination) -> DataFrame:
    conformed = conform(_rows(spark, sf_dir), files, mapping, to)
    return payments.payment_rows(payments.fill_defaults(conformed), to)


def _equal_rows(spark: SparkSession, sf_dir: str, mapping: dict, to: Destination) -> DataFrame:
    """Destination rows with how many are equal.

    What the engine sets is the same in all rows of a file, so rows are shuffled with a number for it, which
    goes by the values alone. The numbers see one row a file; too many to be broadcast, and rows keep the values.
    """
    files = _plan_once(rejects.loadable(_planned_files(spark, sf_dir, mapping, to)))
    rows = _payment_rows_of(spark, sf_dir, files, mapping, to)
    lines = F.count(F.lit(1)).alias("lines")
    if not is_few(files):
        return rows.groupBy(*to.columns).agg(lines)
    engine = {c: v for c, v in payments.engine_values().items() if c in to.columns}
    kinds = files.select("file_path", *[v.alias(c) for c, v in engine.items()])
    kinds = kinds.withColumn("kind", F.dense_rank().over(Window.orderBy(*engine)))
    numbered = rows.drop(*engine).join(F.broadcast(kinds.select("file_path", "kind").distinct()), "file_path")
    counted = numbered.groupBy("kind", *[c for c in to.columns if c not in engine]).agg(lines)
    named = counted.join(F.broadcast(kinds.drop("file_path").distinct()), "kind")
    return named.select(*to.columns, "lines")


@query
def header_layouts(spark, sf_dir):
    """How many files have each header version, and where their payment amount is."""
    files = _planned_files(spark, sf_dir)
    parts = F.array_join(F.col("parts_Net_Payment").cast("array<string>"), "+")
    place = F.coalesce(F.col("at_Net_Payment").cast("string"), parts)
    return files.groupBy("file_headers", place.alias("net_payment_at")).agg(F.count(F.lit(1)).alias("files"))


@query
def conform_aliases(spark, sf_dir):
    """Lines of all layouts as destination columns; equal lines are counted."""
    conformed = conform(_rows(spark, sf_dir), _plan_once(_planned_files(spark, sf_dir)), MAPPING)
    return conformed.groupBy(*FILE_KEY, *PAYMENT.file_columns).agg(F.count(F.lit(1)).alias("lines"))


@query
def track_from_type(spark, sf_dir):
    """Brand as track where a part has an even size, and its type where it has none."""
    rows = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(" ").alias("Track"),
        F.col("p_type").alias("Type"),
        F.lit("").alias("Artist"),
        F.col("p_brand").alias("deal_name"),
        F.lit("").alias("Play_Date"),
        F.lit("").alias("Release_Date"),
        F.lit(None).cast("date").alias("report_date"),
    )
    return payments.fill_defaults(rows).select("p_partkey", "Track")


@query
def artist_default(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_nationkey") % 3 == 0, F.lit(None)).when(F.col("c_nationkey") % 3 == 1, " ")
        .otherwise(F.col("c_name")).alias("Artist"),
        F.col("c_mktsegment").alias("deal_name"),
        *[F.lit("").alias(c) for c in ("Track", "Type", "Play_Date", "Release_Date")],
        F.lit(None).cast("date").alias("report_date"),
    )
    return payments.fill_defaults(rows).select("c_custkey", "Artist")


@query
def sale_category(spark, sf_dir):
    lines = statement_lines(spark, sf_dir, "vendor_name")
    vendors = lines.groupBy("vendor_name").agg(F.count(F.lit(1)).alias("lines"))
    return payments.with_sale_category(vendors, _lookup(spark, sf_dir))


# --- payments --------------------------------------------------------------------------


@query
def payment_rows(spark, sf_dir):
    """Destination rows in destination columns; equal rows are counted."""
    return _equal_rows(spark, sf_dir, MAPPING, PAYMENT)


@query
def payment_rows_wide(spark, sf_dir):
    """Destination rows of a payment table that has other columns; equal rows are counted."""
    return _equal_rows(spark, sf_dir, _WIDE_MAPPING, WIDE)


def _totals(rows: DataFrame) -> DataFrame:
    totals = payments.ledger_totals(payments.file_outcomes(rows))
    return totals.select(*FILE_KEY, _double("total_net_payment"))


@query
def ledger_totals(spark, sf_dir):
    """Exact payments per file straight from the lines."""
    lines = statement_lines(spark, sf_dir, "deal_name", "vendor_name", "file_name", "Net_Payment")
    amounts = lines.select(
        "deal_name",
        "vendor_name",
        F.col("file_name").alias("File_Name"),
        F.col("file_name").alias("file_path"),
        F.lit(None).cast("string").alias("reject"),
        amount(F.col("Net_Payment")).alias("net_amount"),
    )
    return _totals(amounts)


@query
def rejected_files(spark, sf_dir):
    """Files with bad rows, with how many and why."""
    return rejects.row_problems(payments.file_outcomes(_loaded_rows(spark, sf_dir)))


@query
def accepted_totals(spark, sf_dir):
    """Ledger totals of files without any bad row."""
    return _totals(_loaded_rows(spark, sf_dir))


@query
def accepted_lines(spark, sf_dir):
    """Payment lines left per file once files with any bad row are taken out whole."""
    files = _loaded_rows(spark, sf_dir).groupBy("file_path").agg(
        F.count(F.lit(1)).alias("lines"), F.count("reject").alias("bad_rows")
    )
    return files.where("bad_rows = 0").drop("bad_rows")


@query
def amount_rejects(spark, sf_dir):
    """How many lines have each kind of amount text, and whether it is an exact decimal."""
    kind = F.col("l_orderkey") % 6
    text = (
        F.when(kind == 0, "(12.50)").when(kind == 1, "1 234").when(kind == 2, "$1,234.50")
        .when(kind == 3, "1234567890123456789.5").when(kind == 4, "0.12345678901").otherwise("7.250")
    )
    lines = table(spark, sf_dir, "lineitem").select("l_linenumber", text.alias("amount_text"))
    return lines.groupBy("l_linenumber", "amount_text").agg(F.count(F.lit(1)).alias("lines")).withColumn(
        "rejected", unreadable_amount(F.col("amount_text"))
    )


@query
def files_without_category(spark, sf_dir):
    problems = rejects.file_problems(_planned_files(spark, sf_dir))
    return problems.groupBy("vendor_name", "reason").agg(F.count(F.lit(1)).alias("files"))


@query
def idempotent_append(spark, sf_dir):
    """Payment lines of a repeated load that are not held: those of files after 1997."""
    lines = statement_lines(spark, sf_dir, *FILE_KEY, "report_date", "Quantity")
    held = lines.where(F.year("report_date") < 1998).select(*FILE_KEY).distinct()
    new = manifest.append_new(held, lines, FILE_KEY)
    return new.groupBy(*FILE_KEY).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("Quantity").cast("long")).alias("quantity")
    )


# --- songs -----------------------------------------------------------------------------


def _song_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the columns candidates are taken from, dated by play date."""
    lines = statement_lines(spark, sf_dir, "order_key", *SONG_KEY, "Play_Date", "Release_Date", "report_date")
    raw = F.when(blank(F.col("Play_Date")), F.col("report_date").cast("string")).otherwise(F.col("Play_Date"))
    return lines.withColumn("play_text", raw).select(
        "order_key", *SONG_KEY, any_date(F.col("play_text")).alias("song_date"), "Release_Date"
    )


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Song versions that a load of the even orders has left."""
    found = songs.candidates(_song_rows(spark, sf_dir).where("order_key % 2 = 0"))
    return found.select(
        songs.song_id().alias("id"),
        *SONG_KEY,
        "Release_Date",
        F.lit("Y").alias("is_latest"),
        F.lit(None).cast("string").alias("replaces_id"),
    )


def _incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return songs.candidates(_song_rows(spark, sf_dir).where("order_key % 2 = 1"))


def _delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return songs.song_delta(songs.current(_stored(spark, sf_dir)), _incoming(spark, sf_dir))


def _dated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the columns candidates by file are taken from."""
    numbers = "order_key", "line_number"
    lines = statement_lines(spark, sf_dir, *numbers, *SONG_KEY, "Play_Date", "report_date", *FILE_KEY)
    raw = F.when(blank(F.col("Play_Date")), F.col("report_date").cast("string")).otherwise(F.col("Play_Date"))
    return lines.withColumn("play_text", raw).select(
        *numbers,
        *SONG_KEY,
        any_date(F.col("play_text")).alias("song_date"),
        "report_date",
        F.concat_ws("/", *FILE_KEY).alias("file_path"),
    )


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions that the odd orders' files make one after another, upon those of the even orders."""
    dated = _dated_lines(spark, sf_dir).where("order_key % 2 = 1")
    by_file = songs.candidates(dated, by=songs.FILE_ORDER)
    return songs.song_versions(songs.current(_stored(spark, sf_dir)), by_file)


@query
def song_history(spark, sf_dir):
    """A running minimum per song over the files, in order of report date and path."""
    return _texts(_history(spark, sf_dir), "Release_Date")


@query
def song_history_after(spark, sf_dir):
    """All stored versions after those files, with the superseded ones retired."""
    after = songs.snapshot(_stored(spark, sf_dir), _history(spark, sf_dir))
    return _texts(after.drop("replaces_id"), "Release_Date")


@query
def song_candidates_play(spark, sf_dir):
    return _texts(songs.candidates(_song_rows(spark, sf_dir)), "Release_Date")


@query
def song_candidates_release(spark, sf_dir):
    """Dated by the release date where a line has one, else by its play date."""
    rows = _song_rows(spark, sf_dir).withColumn(
        "song_date", F.coalesce(any_date(F.col("Release_Date")), F.col("song_date"))
    )
    return _texts(songs.candidates(rows), "Release_Date")


@query
def song_reconcile(spark, sf_dir):
    both = songs.reconcile(songs.current(_stored(spark, sf_dir)), _incoming(spark, sf_dir))
    return _texts(both, "held_date", "new_date")


@query
def song_inserts(spark, sf_dir):
    return _texts(songs.inserts(_delta(spark, sf_dir)).drop("replaces_id"), "Release_Date")


@query
def song_updates(spark, sf_dir):
    return _texts(songs.updates(_delta(spark, sf_dir)), "Release_Date")


@query
def song_retired(spark, sf_dir):
    return songs.retired_ids(_delta(spark, sf_dir))


@query
def song_delta(spark, sf_dir):
    return _texts(_delta(spark, sf_dir).drop("replaces_id"), "Release_Date")


@query
def song_table_after(spark, sf_dir):
    """All versions after the odd orders' load, with the superseded ones marked."""
    return _texts(songs.apply_delta(_stored(spark, sf_dir), _delta(spark, sf_dir)), "Release_Date")


@query
def song_current_after(spark, sf_dir):
    """Current versions after the load, found from the versions alone."""
    after = _stored(spark, sf_dir).unionByName(_delta(spark, sf_dir))
    return _texts(songs.current(after).drop("id"), "Release_Date")


@query
def isrc_backfills(spark, sf_dir):
    """ISRCs that incoming songs would give stored ones, if every ISRC of brand-name pairs
    with an odd part were stored blank."""
    def strip_isrc(rows: DataFrame) -> DataFrame:
        return rows.withColumn("Album", F.lit("")).withColumn(
            "ISRC", F.when(F.length("ISRC") % 2 == 1, "").otherwise(F.col("ISRC"))
        )

    rows = _song_rows(spark, sf_dir)
    stored = songs.candidates(strip_isrc(rows.where("order_key % 2 = 0"))).withColumn("id", songs.song_id())
    incoming = songs.candidates(rows.where("order_key % 2 = 1").withColumn("Album", F.lit("")))
    return _texts(songs.isrc_backfills(stored, incoming).drop("is_latest"), "Release_Date")


@query
def song_history_backfilled(spark, sf_dir):
    """All versions after the odd orders' files, one after another, where songs without ISRC go over
    to one that a file knows. A quarter of the lines keeps an ISRC, and a title has several; the
    songs stored before are those of every eighth order."""
    isrc = F.concat_ws("-", F.when(~blank(F.col("ISRC")), F.col("ISRC")), F.col("line_number"))
    lines = _dated_lines(spark, sf_dir).withColumns(
        {"Album": F.lit(""), "ISRC": F.when(F.col("line_number").isin(2, 6) & ~blank(F.col("ISRC")), isrc).otherwise("")}
    )
    stored = songs.candidates(lines.where("order_key % 8 = 0")).withColumns(
        {"id": songs.song_id(), "is_latest": F.lit("Y"), "replaces_id": F.lit(None).cast("string")}
    )
    held = songs.current(stored)
    incoming = songs.candidates(lines.where("order_key % 2 = 1"), by=songs.FILE_ORDER)
    heirs = songs.heirs(held, incoming)
    delta = songs.song_versions(held, songs.backfilled(incoming, heirs))
    return _texts(songs.snapshot(stored, delta, songs.filled_keys(heirs)), "Release_Date")
