"""The versioned song dimension.

A song is ISRC, artist, track and album. Its current version is the one with the earliest
date seen so far, so the current versions do not depend on the order or grouping in which
files arrive. Files take effect one after another, in `FILE_ORDER`: a file that knows an earlier
date makes a version, and retires the one before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroll.functions import blank, key_text, title_ascii
from tallyroll.schemas import SONG, SONG_COLUMNS, SONG_KEY

#: What a song without ISRC is known by.
TITLE = [c for c in SONG_KEY if c != "ISRC"]

#: Files in the order in which they take effect.
FILE_ORDER = ["report_date", "file_path"]


def song_id(date: str = "Release_Date") -> Column:
    """A version's id, from its key and date: the same in every run."""
    fields = [*SONG_KEY, F.col(date).cast("string")]
    return F.md5(F.concat_ws("\x01", *fields).cast("binary"))


def normalise_keys(rows: DataFrame) -> DataFrame:
    """Key columns in stored form: title case, blank as one space, never null.

    A nullable join key would make Spark test it for null below the aggregate, which works
    out the title case twice and keeps equal aggregates from being shared.
    """
    return _never_null(
        rows.withColumns(
            {
                "ISRC": key_text(F.col("ISRC")),
                "Artist": title_ascii(F.col("Artist")),
                "Track": title_ascii(F.col("Track")),
                "Album": key_text(title_ascii(F.col("Album"))),
            }
        )
    )


def _never_null(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.coalesce(c, F.lit(" ")) for c in SONG_KEY})


def candidates(payments: DataFrame, normalised: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Songs named by payment rows, each with its earliest date (in each file, given the file's
    columns `by`).

    Rows without artist, track or date name no song. The minimum is taken before the
    shuffle as well, so a song holding much of the data costs one row per task. Stored
    payments are in title case already (`normalised`).
    """
    named = payments.where(~blank(F.col("Artist")) & ~blank(F.col("Track"))).select(*SONG_KEY, "song_date", *by)
    if normalised:
        keyed = _never_null(named.withColumns({c: key_text(F.col(c)) for c in ("ISRC", "Album")}))
    else:
        keyed = normalise_keys(named)
    # Rows without a date are dropped by way of the minimum: a filter on the date itself
    # would be pushed below the parsing of it and parse twice.
    earliest = keyed.groupBy(*SONG_KEY, *by).agg(F.min("song_date").alias("Release_Date"))
    return earliest.where("Release_Date is not null")


def current(versions: DataFrame) -> DataFrame:
    """The current version of each song.

    A superseded version carries a later date than the one that replaced it, so the
    minimum finds the current one with a single shuffle on the key, which the join in
    `song_delta` then reuses.
    """
    return (
        versions.where("is_latest = 'Y'")
        .groupBy(*SONG_KEY)
        .agg(F.min("Release_Date").alias("Release_Date"))
        .withColumn("id", song_id())
    )


def song_delta(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """New version rows: songs not stored yet, and songs now known to be earlier.

    `stored` holds current versions (`current`), `incoming` candidates; both have one row
    per key. One left join gives both kinds: `replaces_id` is null for an insert and the
    id to retire for an update.
    """
    held = stored.select(
        *SONG_KEY, F.col("id").alias("held_id"), F.col("Release_Date").alias("held_date")
    )
    return (
        incoming.join(held, SONG_KEY, "left")
        .where(F.col("held_id").isNull() | (F.col("held_date") > F.col("Release_Date")))
        .select(
            song_id().alias("id"),
            *SONG_KEY,
            "Release_Date",
            F.lit("Y").alias("is_latest"),
            F.col("held_id").alias("replaces_id"),
        )
    )


def song_versions(stored: DataFrame, incoming: DataFrame, order: Sequence[str] = tuple(FILE_ORDER)) -> DataFrame:
    """New version rows of files that take effect one after another.

    `stored` holds current versions, `incoming` candidates by file. A file's row makes a version
    where its date is earlier than the stored one and all of the files before it. There is one
    row a song and file, so a window holds at most as many rows as a batch has files, however
    many lines name the song. The join and both windows share one shuffle, on the key.
    A song's first version may supersede another song's: the id in `fills_id`, if there is one.
    """
    fills = F.col("fills_id") if "fills_id" in incoming.columns else F.lit(None).cast("string")
    held = stored.select(*SONG_KEY, F.col("Release_Date").alias("held_date"))
    song = Window.partitionBy(*SONG_KEY)
    earlier = song.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    seen = incoming.join(held, SONG_KEY, "left").withColumns(
        {
            "before": F.least(F.min("Release_Date").over(earlier), F.col("held_date")),
            "earliest": F.min("Release_Date").over(song),
        }
    )
    return seen.where("before is null or Release_Date < before").select(
        song_id().alias("id"),
        *SONG_KEY,
        "Release_Date",
        F.when(F.col("Release_Date") == F.col("earliest"), "Y").otherwise("N").alias("is_latest"),
        F.when(F.col("before").isNotNull(), song_id("before")).otherwise(fills).alias("replaces_id"),
    )


def inserts(delta: DataFrame) -> DataFrame:
    return delta.where("replaces_id is null")


def updates(delta: DataFrame) -> DataFrame:
    return delta.where("replaces_id is not null")


def retired_ids(delta: DataFrame) -> DataFrame:
    """Ids of the versions that a delta supersedes."""
    return updates(delta).select(F.col("replaces_id").alias("id"))


def reconcile(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Every song of either side with what a load would do to it."""
    held = stored.select(*SONG_KEY, F.col("Release_Date").alias("held_date"))
    new = incoming.select(*SONG_KEY, F.col("Release_Date").alias("new_date"))
    action = (
        F.when(F.col("held_date").isNull(), "insert")
        .when(F.col("new_date").isNull(), "untouched")
        .when(F.col("new_date") < F.col("held_date"), "update")
        .otherwise("keep")
    )
    return held.join(new, SONG_KEY, "full").select(
        *SONG_KEY, "held_date", "new_date", action.alias("action")
    )


def isrc_backfills(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Version rows that would give stored songs without ISRC their ISRC.

    The difference of two whole song tables; a load, where files take effect one after another,
    does it by `heirs`. Matched by artist, track and album instead; where several new ISRCs
    come in for one such song the least is used. The row carries the earliest date known.
    """
    title = ["Artist", "Track", "Album"]
    held = stored.where(blank(F.col("ISRC"))).select(
        *title, F.col("id").alias("replaces_id"), F.col("Release_Date").alias("held_date")
    )
    new = incoming.where(~blank(F.col("ISRC"))).join(stored.select(*SONG_KEY), SONG_KEY, "left_anti")
    chosen = new.groupBy(*title).agg(F.min(F.struct("ISRC", "Release_Date")).alias("new"))
    still_blank = incoming.where(blank(F.col("ISRC"))).select(
        *title, F.col("Release_Date").alias("blank_date")
    )
    return (
        held.join(chosen, title)
        .join(still_blank, title, "left")
        .select(
            F.col("new.ISRC").alias("ISRC"),
            *title,
            F.least("held_date", "new.Release_Date", "blank_date").alias("Release_Date"),
            F.lit("Y").alias("is_latest"),
            "replaces_id",
        )
        .select(song_id().alias("id"), *SONG_KEY, "Release_Date", "is_latest", "replaces_id")
    )


def heirs(stored: DataFrame, incoming: DataFrame, order: Sequence[str] = tuple(FILE_ORDER)) -> DataFrame:
    """Which ISRC stands in for none, by title and file, in files that know one for the title.

    `stored` holds current versions, `incoming` candidates by file. The `heir` of a title is the
    least ISRC known before the file, or else the file's least. `blank_date` is the date of the file's
    own song without ISRC. `taken` is the date of the current version without ISRC, which the heir takes
    over: in the first file with an heir, and null where there is none.

    Each file's songs of a title are one row, so a window holds at most as many rows as a batch has
    files, whatever the number of ISRCs.
    """
    known, date = ~blank(F.col("ISRC")), F.col("Release_Date")
    isrc, without = F.min(F.when(known, F.col("ISRC"))), F.min(F.when(~known, date))
    held = stored.groupBy(*TITLE).agg(isrc.alias("held_isrc"), without.alias("held_date"))
    named = incoming.groupBy(*TITLE, *order).agg(isrc.alias("own_isrc"), without.alias("blank_date"))
    files = Window.partitionBy(*TITLE).orderBy(*order)
    earlier = files.rowsBetween(Window.unboundedPreceding, -1)
    seen = named.join(held, TITLE, "left").withColumns(
        {
            "heir": F.coalesce(F.least(F.min("own_isrc").over(earlier), F.col("held_isrc")), "own_isrc"),
            "left": F.least(F.min("blank_date").over(earlier), F.col("held_date")),
        }
    )
    # No ISRC is known up to the first file with an heir, so what came without one was a song until then.
    first = F.lag("heir").over(files).isNull()
    seen = seen.withColumn("taken", F.when(first, F.col("left")))
    return seen.where("heir is not null").select(*TITLE, *order, "heir", "blank_date", "taken")


def backfilled(incoming: DataFrame, heirs: DataFrame, order: Sequence[str] = tuple(FILE_ORDER)) -> DataFrame:
    """Candidates by file in which songs without ISRC have gone over to the `heirs`.

    `fills_id` names the version that a row takes over.
    """
    at = [*TITLE, *order]
    stay = incoming.where(~blank(F.col("ISRC"))).unionByName(
        incoming.where(blank(F.col("ISRC"))).join(heirs.select(*at), at, "left_anti")
    )
    moved = (
        heirs.withColumn("ISRC", F.lit(" "))
        .withColumn("fills_id", F.when(F.col("taken").isNotNull(), song_id("taken")))
        .select(F.col("heir").alias("ISRC"), *at, F.least("blank_date", "taken").alias("Release_Date"), "fills_id")
        .where("Release_Date is not null")
    )
    both = stay.withColumn("fills_id", F.lit(None).cast("string")).unionByName(moved)
    return both.groupBy(*SONG_KEY, *order).agg(
        F.min("Release_Date").alias("Release_Date"), F.min("fills_id").alias("fills_id")
    )


def filled_keys(heirs: DataFrame) -> DataFrame:
    """Keys of the songs without ISRC that heirs have taken over."""
    return heirs.where("taken is not null").select(F.lit(" ").alias("ISRC"), *TITLE)


def latest_flags(versions: DataFrame) -> DataFrame:
    """All versions as the song table shows them: superseded ones are not latest."""
    superseded = versions.where("replaces_id is not null").select(
        F.col("replaces_id").alias("id"), F.lit("N").alias("superseded")
    )
    return (
        versions.join(superseded.dropDuplicates(["id"]), "id", "left")
        .withColumn("is_latest", F.coalesce("superseded", "is_latest"))
        .select(*SONG_COLUMNS)
    )


def snapshot(versions: DataFrame, delta: DataFrame, filled: DataFrame | None = None) -> DataFrame:
    """All versions of some songs after a delta: those that it supersedes are retired, and all
    of the `filled` keys.

    New versions share their key with those they replace and are earlier, so the latest
    version is the earliest of the key's that are not retired; a song has few versions, so a window
    per key is small.
    """
    both = versions.select(*SONG.fieldNames()).unionByName(delta.select(*SONG.fieldNames()))
    live = F.col("is_latest") == "Y"
    earliest = F.min(F.when(live, F.col("Release_Date"))).over(Window.partitionBy(*SONG_KEY))
    kept = live & (F.col("Release_Date") == earliest)
    after = both.withColumn("is_latest", F.when(kept, "Y").otherwise("N"))
    if filled is None:
        return after
    gone = filled.withColumn("gone", F.lit("N"))
    flagged = after.join(gone, SONG_KEY, "left").withColumn("is_latest", F.coalesce("gone", "is_latest"))
    return flagged.select(*SONG.fieldNames())


def apply_delta(versions: DataFrame, delta: DataFrame) -> DataFrame:
    """The song table after a delta, in its public columns."""
    return snapshot(versions, delta).select(*SONG_COLUMNS)
