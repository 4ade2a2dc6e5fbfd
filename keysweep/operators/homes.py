"""An index of the partitions that keys are stored in, kept as a bucketed table beside a catalog table.

A row keeps the partition that it is stored in, so the index only grows: an upsert adds the keys that it inserts. It is
bucketed by a hash of the key, so a join with it shuffles the incoming keys to its buckets, and never the index. Whether
it is still that of the table is checked by its number of rows against that of the table, which is in the footers of the files,
and by the rows that an upsert has found where the index says they are. An index that is not is built anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keysweep.functions.columns import column, quoted
from keysweep.operators.upsert import COPIES, HOME, stored_homes

BUCKETS = 256
# The key's hash, by which the index is bucketed and sorted, and the names of its other columns.
HASH = "key_hash"
KEY = "key_{}"
PLACE = "home"


def key_hash(keys: Sequence[str]) -> Column:
    """A hash of the key in which NULL is a value like others."""
    return F.xxhash64(*[F.struct(column(k)) for k in keys])


def index_rows(rows: DataFrame, keys: Sequence[str], partition_col: str) -> DataFrame:
    names = [column(k).alias(KEY.format(i)) for i, k in enumerate(keys)]
    return rows.select(key_hash(keys).alias(HASH), *names, column(partition_col).alias(PLACE))


def build_index(spark: SparkSession, stored: DataFrame, index: str, keys: Sequence[str], partition_col: str, buckets: int = BUCKETS) -> None:
    """Write the index of ``stored`` anew. A key that is stored twice is refused."""
    homes = stored_homes(stored, keys, partition_col)
    message = F.lit(f"the stored rows are not unique by {','.join(keys)}")
    once = F.when(F.col(COPIES) > 1, F.raise_error(message).cast("string")).otherwise(F.col(HOME))
    rows = index_rows(homes.select(*map(column, keys), once.alias(partition_col)), keys, partition_col)
    spark.sql(f"DROP TABLE IF EXISTS {index}")
    _saved(rows, index, buckets, "errorifexists")


def _saved(rows: DataFrame, index: str, buckets: int, mode: str) -> None:
    # One task, and so one file, for each bucket.
    rows = rows.repartition(buckets, HASH)
    rows.write.bucketBy(buckets, HASH).sortBy(HASH).mode(mode).format("parquet").saveAsTable(index)


def buckets_of(spark: SparkSession, index: str) -> int:
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {index}").collect()}
    return int(facts["Num Buckets"])


def add_to_index(spark: SparkSession, inserted: DataFrame, index: str, keys: Sequence[str], partition_col: str) -> None:
    """Add keys that were not stored before."""
    _saved(index_rows(inserted, keys, partition_col), index, buckets_of(spark, index), "append")


def is_current(spark: SparkSession, index: str, stored: DataFrame) -> bool:
    """Whether the index has as many keys as the table has rows; both are counted by the footers of their files."""
    return spark.catalog.tableExists(index) and spark.table(index).count() == stored.count()


def homes_of(spark: SparkSession, incoming: DataFrame, index: str, keys: Sequence[str], partition_col: str) -> DataFrame:
    """Per incoming key that is stored: the key, one copy, and its partition. The index is not shuffled."""
    wanted = incoming.select(*map(column, keys), key_hash(keys).alias(HASH))
    known = spark.table(index)
    one_hash = wanted[HASH] == known[HASH]
    # Keys that could be joined on would have to be part of the index's partitioning; a condition with "or" is only checked.
    same = [column(k).eqNullSafe(known[KEY.format(i)]) | ~one_hash for i, k in enumerate(keys)]
    met = wanted.join(known.hint("merge"), reduce(lambda a, b: a & b, [one_hash, *same]))
    return met.select(*map(column, keys), F.lit(1).cast("bigint").alias(COPIES), F.col(PLACE).alias(HOME))


def index_name(database: str, table: str) -> str:
    return f"{quoted(database)}.{quoted(f'{table}_homes')}"
