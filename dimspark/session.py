"""Session settings."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings any deployment should keep: period bounds are UTC, bad input to a
# strict cast fails, busy join keys are split at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# For windowed loads of a large warehouse: the ids of a window's headers, a Bloom filter of
# fixed size, drop the other lines before the shuffle. Spark's own limits are for headers
# of 10 MB by estimate and lines of 10 GB. More ids than a filter is made for let more lines pass.
LARGE_WINDOWS = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1t",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "50000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "402653184",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "50000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "402653184",
}

# Names under which a machine may have its zone set to UTC.
_UTC = {"utc", "etc/utc", "uct", "etc/uct", "universal", "etc/universal", "zulu", "etc/zulu", "gmt", "etc/gmt", "z", "+00:00"}


def require_settings(spark: SparkSession) -> None:
    """Fail if a setting that decides results is missing.

    Without ANSI mode a strict date turns bad text into NULL; with a zone other than
    UTC zoned and unzoned times shift against each other.
    """
    for key, accepted in (("spark.sql.session.timeZone", _UTC), ("spark.sql.ansi.enabled", {"true"})):
        # Without a default of ours: a session that sets neither has Spark's own.
        found = spark.conf.get(key)
        if found.lower() not in accepted:
            raise ValueError(f"{key} is {found!r}; it must be {SETTINGS[key]!r}")


def use_local_folder(spark: SparkSession) -> SparkSession:
    """Give a session on one machine a temporary shared folder if it has none.

    A cluster session is left alone: its folder must be named in
    ``spark.checkpoint.dir``.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and re.fullmatch(r"local(\[.*\])?", context.master):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="dimspark-"))
    return spark


def local_session(cores: str | int | None = None, **extra: str) -> SparkSession:
    """A session for tests and measurements on one machine."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    settings = SETTINGS | {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("dimspark")
    for key, value in (settings | extra).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return use_local_folder(spark)
