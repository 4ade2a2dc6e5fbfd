"""Writing the replica as partitioned Parquet, and making it known to the catalog."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keysweep.functions.columns import column, in_values, null_fill, quoted
from keysweep.operators.homes import add_to_index, build_index, homes_of, is_current
from keysweep.operators.joins import null_safe_join
from keysweep.operators.latest import latest_wins
from keysweep.operators.upsert import COPIES, at_home, merge, stored_homes
from keysweep.operators.validate import check_required, check_written
from keysweep.sinks.swap import read_registered, swap_partitions
from keysweep.sources.target import read_target
from keysweep.spec import PARTITION_COLUMN
from keysweep.storage import BROADCAST_LIMIT, sized, stage, work_folder

# Parquet codec of the replica.
CODEC = "gzip"


def write_partitioned(
    df: DataFrame, path: str, partition_col: str = PARTITION_COLUMN, codec: str = CODEC
) -> None:
    """A new table in Hive-style directories. Rows of a partition are brought together, in as many tasks as its size
    needs, so that not every task writes a file into every partition."""
    df.hint("rebalance", column(partition_col)).write.partitionBy(partition_col).option("compression", codec).parquet(path)


def overwrite_partitions(
    df: DataFrame,
    path: str,
    partition_col: str = PARTITION_COLUMN,
    codec: str = CODEC,
    gather: bool = False,
) -> None:
    """Replace the partitions that occur in ``df`` and no others.

    Spark writes all new files beside the table and swaps whole partitions in once every task has
    succeeded, so ``df`` may read the partitions it replaces, and lost executors only repeat tasks.
    ``gather`` is for rows that a shuffle has scattered: it brings those of one partition together, in
    as many tasks as its size needs, so that not every task writes a file into every partition.
    """
    if gather:
        df = df.hint("rebalance", column(partition_col))
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "compression", codec
    ).partitionBy(partition_col).parquet(path)


def upsert_to_path(
    spark: SparkSession,
    incoming: DataFrame,
    path: str,
    keys: Sequence[str],
    ordering: str,
    ordering_type: str | None = None,
    partition_col: str = PARTITION_COLUMN,
    folder: str | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
    codec: str = CODEC,
) -> int:
    """Upsert ``incoming`` into the table at ``path`` and return the number of its distinct keys.

    Only partitions that receive rows are read whole and rewritten; of the others just the keys are read,
    to find where each incoming row is stored.
    """
    stored = read_target(spark, path, partition_col=partition_col)
    replace = partial(overwrite_partitions, path=path, partition_col=partition_col, codec=codec)
    return _upsert(spark, incoming, stored, replace, keys, ordering, ordering_type, partition_col, folder, broadcast_limit)


def upsert_to_table(
    spark: SparkSession,
    incoming: DataFrame,
    name: str,
    keys: Sequence[str],
    ordering: str,
    ordering_type: str | None = None,
    partition_col: str = PARTITION_COLUMN,
    folder: str | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
    codec: str = CODEC,
    index: str | None = None,
) -> int:
    """``upsert_to_path`` for a catalog table, whose partitions are replaced by switching their locations, see ``swap``.

    ``index`` names a table of the partitions of all keys, see ``homes``. It is built by the first upsert that is given it and
    saves the others the scan of all stored keys.
    """
    stored = read_registered(spark, name)
    replace = partial(swap_partitions, name=name, partition_col=partition_col, codec=codec)
    return _upsert(spark, incoming, stored, replace, keys, ordering, ordering_type, partition_col, folder, broadcast_limit, index)


def _upsert(
    spark: SparkSession,
    incoming: DataFrame,
    stored: DataFrame,
    replace: Callable[..., None],
    keys: Sequence[str],
    ordering: str,
    ordering_type: str | None,
    partition_col: str,
    folder: str | None,
    broadcast_limit: int,
    index: str | None = None,
) -> int:
    check_required(stored, [*keys, ordering, partition_col])
    check_required(incoming, [*keys, ordering])
    folder = folder or work_folder(spark, "upsert")

    filled = null_fill(incoming, stored.schema)
    if dict(filled.dtypes)[partition_col] == "string":
        # An empty text is stored in the directory of NULL, so it must count as NULL here too.
        filled = filled.withColumn(partition_col, F.nullif(column(partition_col), F.lit("")))
    latest = stage(latest_wins(filled, keys, ordering, ordering_type), f"{folder}/latest")
    if index:
        placed = _placed_by_index(spark, latest, stored, index, keys, partition_col, folder, broadcast_limit)
    else:
        placed = stage(at_home(latest, _scanned_homes(latest, stored, keys, partition_col, folder, broadcast_limit), keys, partition_col), f"{folder}/placed")
    # Bounded by the number of directories of the table, which the driver lists anyway.
    touched = [row[0] for row in placed.select(column(partition_col)).distinct().collect()]
    if touched:
        batch = sized(placed, broadcast_limit)
        affected = stored.filter(in_values(partition_col, touched))
        rows = merge(affected, batch.rows, keys, ordering, ordering_type, batch.hint)
        check_written(rows, stored.schema)
        replace(rows, gather=not batch.small)
        inserted = placed.filter(F.col(COPIES).isNull()).select(*map(column, dict.fromkeys([*keys, partition_col])))
        if index and not inserted.isEmpty():
            add_to_index(spark, inserted, index, keys, partition_col)
    return latest.count()


def _scanned_homes(
    latest: DataFrame, stored: DataFrame, keys: Sequence[str], partition_col: str, folder: str, broadcast_limit: int
) -> DataFrame:
    """Where the incoming keys are stored, by a scan of all stored keys."""
    wanted = sized(latest.select(*map(column, keys)), broadcast_limit)
    narrow = stored.select(*map(column, dict.fromkeys([*keys, partition_col])))
    written_to = null_safe_join(narrow, wanted.hinted, keys, "left_semi")
    homes = stage(stored_homes(written_to, keys, partition_col), f"{folder}/homes")
    repeated = homes.filter(F.col(COPIES) > 1).limit(5).collect()
    if repeated:
        examples = [tuple(row[key] for key in keys) for row in repeated]
        raise ValueError(f"the stored rows are not unique by {','.join(keys)}: {examples}")
    return homes


def _placed_by_index(
    spark: SparkSession,
    latest: DataFrame,
    stored: DataFrame,
    index: str,
    keys: Sequence[str],
    partition_col: str,
    folder: str,
    broadcast_limit: int,
) -> DataFrame:
    """Incoming rows at home, by the index. If the rows are not where it says, it is built anew, and asked again."""
    if not is_current(spark, index, stored):
        build_index(spark, stored, index, keys, partition_col)
    names = list(dict.fromkeys([*keys, partition_col]))
    for again in (False, True):
        homes = stage(homes_of(spark, latest, index, keys, partition_col), f"{folder}/homes-{again}")
        placed = stage(at_home(latest, homes, keys, partition_col), f"{folder}/placed-{again}")
        known = sized(placed.filter(F.col(COPIES).isNotNull()).select(*map(column, names)), broadcast_limit)
        places = [row[0] for row in known.rows.select(column(partition_col)).distinct().collect()]
        there = stored.filter(in_values(partition_col, places)).select(*map(column, names))
        if not places or null_safe_join(there, known.hinted, names, "left_semi").count() == known.rows.count():
            return placed
        build_index(spark, stored, index, keys, partition_col)
    raise ValueError(f"the table changes while the index {index} is built")


def publish_table(
    spark: SparkSession,
    path: str,
    database: str,
    table: str,
    partition_col: str = PARTITION_COLUMN,
    database_path: str | None = None,
) -> str:
    """Register the table at ``path`` with all its partitions, and return its name."""
    name = f"{quoted(database)}.{quoted(table)}"
    place = f" LOCATION {_literal(database_path)}" if database_path else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}{place}")
    if not spark.catalog.tableExists(name):
        fields = read_target(spark, path, partition_col=partition_col).schema.fields
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet "
            f"PARTITIONED BY ({quoted(partition_col)}) LOCATION {_literal(path)}"
        )
    else:
        check_registration(spark, name, path, read_target(spark, path, partition_col=partition_col).columns)
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return name


def check_registration(spark: SparkSession, name: str, path: str, columns: Sequence[str]) -> None:
    """Refuse a table that is known with another place, or without a column of its files."""
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    plain = lambda place: "/" + place.split(":", 1)[-1].strip("/")
    if plain(facts["Location"]) != plain(path):
        raise ValueError(f"table {name} is registered at {facts['Location']}, not at {path}")
    unknown = sorted(set(columns) - set(spark.table(name).columns))
    if unknown:
        raise ValueError(f"table {name} is registered without the columns {unknown}")


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
