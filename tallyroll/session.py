"""Session settings the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates carry no zone; one fixed zone keeps timestamps stable between clusters.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Plans here are built from many small expressions; recording a Python stack trace for
    # each of them costs seconds per plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # A stage that cleans many columns compiles to one long method; the JVM would interpret
    # it for good instead of compiling it.
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    # Without that option, as in a session made elsewhere: operators whose method is too long for the
    # JVM to compile run one by one, each with methods that are split.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A partition column such as Report_Date stays the type its schema declares.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(app_name: str = "tallyroll", master: str | None = None, **conf) -> SparkSession:
    """A session with the engine's settings; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def compilable(spark: SparkSession) -> None:
    """Keep generated methods short enough for the JVM to compile, in a session made elsewhere."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", SETTINGS["spark.sql.codegen.hugeMethodLimit"])
