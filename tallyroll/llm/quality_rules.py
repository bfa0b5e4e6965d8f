"""Quality rules with a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Words and pairs of neighbouring words are hashed into `BUCKETS`. Their counts over all
documents give the raw multinomial, those over trusted documents the target; a document's
score is the mean of log(target / raw) over its n-grams. It is kept when it passes the base
rules and the score is at least the threshold. Bucket weights are whole millionths, so sums
don't depend on their order and the verdict is the same everywhere.

Trusted documents are all rows labelled good; the raw counts cover every document. Query op3's SQL
takes one trusted id for each of 16,384 hash buckets, so the two agree where no two ids share one.

Defined cases. Text null or without words: all counts 0, base rules failed. Repeated rows: each
counts and is judged. Without trusted documents every ratio is 0 and the base rules decide.
Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
#: A document whose n-grams are this much (in millionths) less likely among trusted ones goes.
THRESHOLD = -70_000
PRIOR = 16.0
_SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), _SPACE), lambda w: w != "")


def grams(w: Column) -> Column:
    """Words, then pairs of neighbours."""
    following = F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0)))
    pairs = F.zip_with(following, F.slice(w, F.lit(1), F.size(following)), lambda b, a: F.concat(a, F.lit(" "), b))
    return F.concat(w, pairs)


def bucket(gram: Column) -> Column:
    return (F.crc32(gram.cast("binary")) % BUCKETS).cast("int")


def repeated_words(w: Column) -> Column:
    """Words in three-word windows that occur twice or more; `w` must be a plain column."""
    n = F.size(w) - 2
    hashes = F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)))
    return F.when(n < 2, 0).otherwise(F.when(F.size(F.array_distinct(hashes)) == n, 0).otherwise(_covered(hashes)))


def _covered(hashes: Column) -> Column:
    """Length of the union of the three-word windows whose hash is there more than once."""
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def over(s: Column) -> Column:
        again = F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]))
        return F.array_sort(F.transform(again, lambda x: x["i"]))

    def union(at: Column) -> Column:
        return F.aggregate(
            at,
            F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
            lambda a: a["n"],
        )

    # a one-element transform names a value for use in a lambda
    at = F.get(F.transform(F.array(placed), over), F.lit(0))
    return union(at)


def base_rules(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row, w, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed);
    `row` is the whole row, apart from whose columns new names can't clash."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct("*").alias("row"))
    counted = own.withColumn("w", words(F.col("text"))).withColumn("lines", lines)
    return counted.select(
        "id",
        "row",
        "w",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).cast("long").alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def trusted_ids(labels: DataFrame, id_col: str) -> DataFrame:
    """Ids of all rows labelled good, each once."""
    good = labels.filter((F.col("quality") == 1) & F.col(id_col).isNotNull())
    return good.select(F.col(id_col).alias("id")).distinct().withColumn("trusted", F.lit(1))


def bucket_weights(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row, one array: log(target / raw) of each bucket in millionths. The target's count is
    held against the count that the raw share would give, both with `PRIOR` added: a bucket of
    which little is known weighs little."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    gram = F.explode(grams(F.col("w")))
    counts = (
        own.join(trusted, "id", "left")
        .withColumn("w", words(F.col("text")))
        .select(F.coalesce("trusted", F.lit(0)).alias("trusted"), gram.alias("gram"))
        .groupBy(bucket(F.col("gram")).alias("bucket"))
        .agg(F.count("*").alias("raw"), F.sum("trusted").alias("target"))
    )
    empty = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int"), F.lit(0), F.lit(0))
    every = counts.union(empty).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    whole = every.agg(
        F.array_sort(F.collect_list(F.struct("bucket", "raw", "target"))).alias("all"),
        F.sum("raw").alias("raws"),
        F.sum("target").alias("targets"),
    )

    def weight(c: Column) -> Column:
        expected = c["raw"].cast("double") * F.col("targets") / F.col("raws")
        ratio = (c["target"] + PRIOR) / (expected + PRIOR)
        return F.when(F.col("targets") > 0, F.round(F.ln(ratio) * 1e6).cast("long")).otherwise(0)

    return whole.select(F.transform("all", weight).alias("weights"))


def _judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            join: str | None = None, threshold: int = THRESHOLD) -> DataFrame:
    trusted = trusted_ids(labels, id_col)
    weights = bucket_weights(docs, trusted.hint(join) if join else trusted, id_col, text_col)
    scored = base_rules(docs, id_col, text_col).withColumn("weights", weights.scalar())
    total = F.aggregate(
        grams(F.col("w")), F.lit(0).cast("long"), lambda a, g: a + F.get(F.col("weights"), bucket(g))
    )
    n = 2 * F.col("n_words") - 1
    return (
        scored.withColumn("score", F.when(F.col("n_words") > 0, F.floor(total / n)))
        .withColumn("kept", ~F.col("base_failed") & (F.coalesce("score", F.lit(0)) >= threshold))
        .drop("w", "weights")
    )


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Every document with its counts, its score in millionths (null without words) and verdict."""
    return _judged(docs, labels, id_col, **options).drop("row").withColumnRenamed("id", id_col)


def passing(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are kept, with all their columns.

    A filter on the verdict alone would be moved below the steps that make it and repeat them
    for every word; the row number, which isn't deterministic to Spark, keeps it in place.
    """
    numbered = _judged(docs, labels, **options).withColumn("number", F.monotonically_increasing_id())
    return numbered.filter("kept AND number >= 0").select("row.*")


def quality_rules(spark, sf_dir: str) -> DataFrame:
    """Query op3: the rules' counts and verdict for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # one join at all sizes, as ids labelled good grow with the table
    return judged(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), join="merge")
