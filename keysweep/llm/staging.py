"""Intermediate tables of the operators in the shared folder, one folder for each run."""

from __future__ import annotations

from contextlib import contextmanager
from math import ceil
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keysweep.functions.columns import column
from keysweep.storage import work_folder

# Files of finished shuffles go at the end of each staged write, instead of when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Stage:
    """Writes tables below one new folder and reads them back, which cuts their lineage."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.folder = work_folder(spark, purpose)

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}-{uuid4().hex}"
        with cleaned_shuffles(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def small_groups(self, df: DataFrame, name: str, size: int) -> DataFrame:
        """The same in row groups of ``size`` bytes, for long rows: a reader holds up to a row group of them at once."""
        path = f"{self.folder}/{name}-{uuid4().hex}"
        with cleaned_shuffles(self.spark):
            df.write.option("parquet.block.size", str(size)).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


@contextmanager
def cleaned_shuffles(spark: SparkSession):
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def columns_of(df: DataFrame) -> list[Column]:
    return [column(c) for c in df.columns]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_digest(text: str) -> Column:
    """Digest of 64 bits that tells texts of one identifier apart; NULL counts as empty."""
    return F.xxhash64(F.coalesce(column(text), F.lit("")))


def bounded_sample(df: DataFrame, rows: int, *key: Column) -> DataFrame:
    """At most ``rows`` rows of ``df``, the first by a hash of ``key``.

    Rows whose hash is far too large are left out before the sort, so that no task sends more than its share of the sample.
    """
    spread = 1 << 31
    total = df.count()
    hashed = F.pmod(F.xxhash64(*key), F.lit(spread))
    if total > rows:
        df = df.filter(hashed < min(spread, ceil(1.3 * rows / total * spread) + 1))
    return df.orderBy(hashed, *key).limit(rows)
