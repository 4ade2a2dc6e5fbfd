"""Replacing partitions of a catalog table by switching their locations.

New files of the touched partitions are written to a folder of their own, a generation, below the table. Then the catalog is told, partition by
partition, where its files are now. Each of these switches is one change of the catalog, so a partition is whole at any
time: its old files, or its new ones. Old folders go when all switches have been made.

If the driver dies, some partitions are switched and others are not, and no row is lost. A repeated run finds what is
left to do. Folders that no partition refers to any more stay behind; ``remove_unused`` finds them. Files of such a table
must be read through the catalog (``read_registered``), as a reader of the plain folder would find old partitions only.
"""

from __future__ import annotations

from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from keysweep.functions.columns import column, quoted
from keysweep.sinks.files import child_folders, delete_folder, plain_path
from keysweep.spec import PARTITION_COLUMN

GENERATIONS = "_generations"
# Fixed value: the folder name that stands for NULL.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def registered_name(database: str, table: str) -> str:
    return f"{quoted(database)}.{quoted(table)}"


def read_registered(spark: SparkSession, name: str) -> DataFrame:
    """All rows of a catalog table, wherever its partitions lie."""
    spark.catalog.refreshTable(name)
    rows = spark.table(name)
    return rows.select(*map(column, rows.columns))


def table_location(spark: SparkSession, name: str) -> str:
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return facts["Location"].rstrip("/")


def partition_locations(spark: SparkSession, name: str, partition_col: str = PARTITION_COLUMN) -> dict[str | None, str]:
    """Where the catalog has each partition, by its value. As many as the table has partitions."""
    catalog = spark._jsparkSession.sessionState().catalog()
    found = catalog.listPartitions(spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(name), spark._jvm.scala.Option.empty())
    locations = {}
    for i in range(found.size()):
        part = found.apply(i)
        value = part.spec().get(partition_col).get()
        # A location is a URI, in which the escapes of folder names are escaped again.
        place = spark._jvm.org.apache.hadoop.fs.Path(part.location()).toString()
        locations[None if value in (None, NULL_FOLDER) else value] = place
    return locations


def _spec(partition_col: str, value: str | None) -> str:
    text = "null" if value is None else _literal(value)
    return f"PARTITION ({quoted(partition_col)} = {text})"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_generation(rows: DataFrame, folder: str, partition_col: str, codec: str) -> dict[str | None, str]:
    """Write ``rows`` below a new ``folder``, and return where each of their partitions is."""
    rows.write.partitionBy(partition_col).option("compression", codec).parquet(folder)
    spark, prefix = rows.sparkSession, f"{partition_col}="
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    values = {}
    for place in child_folders(spark, folder):
        text = unescape(place.rsplit("/", 1)[-1]).removeprefix(prefix)
        values[None if text == NULL_FOLDER else text] = place
    return values


def switch(spark: SparkSession, name: str, partition_col: str, value: str | None, known: bool, place: str) -> None:
    """Tell the catalog that the files of a partition are at ``place``."""
    spec = _spec(partition_col, value)
    if known:
        spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION {_literal(place)}")
    else:
        spark.sql(f"ALTER TABLE {name} ADD {spec} LOCATION {_literal(place)}")


def swap_partitions(rows: DataFrame, name: str, partition_col: str = PARTITION_COLUMN, codec: str = "gzip", gather: bool = False) -> None:
    """Replace the partitions of the catalog table ``name`` that occur in ``rows``, and no others.

    ``rows`` may read what they replace, as that stays until its last partition is switched.
    """
    spark = rows.sparkSession
    before = partition_locations(spark, name, partition_col)
    if gather:
        rows = rows.hint("rebalance", column(partition_col))
    folder = f"{table_location(spark, name)}/{GENERATIONS}/{uuid4().hex}"
    after = write_generation(rows, folder, partition_col, codec)
    for value, place in after.items():
        switch(spark, name, partition_col, value, value in before, place)
    spark.catalog.refreshTable(name)
    _remove_old(spark, {value: place for value, place in before.items() if value in after})


def _remove_old(spark: SparkSession, locations: Mapping[str | None, str]) -> None:
    for place in locations.values():
        delete_folder(spark, place)


def remove_unused(spark: SparkSession, name: str, partition_col: str = PARTITION_COLUMN) -> int:
    """Delete the partition folders below the table that the catalog does not refer to, and return their number.

    They are what runs left behind that did not end. None may be under way.
    """
    used = {plain_path(place) for place in partition_locations(spark, name, partition_col).values()}
    base = table_location(spark, name)
    generations = child_folders(spark, f"{base}/{GENERATIONS}")
    removed = 0
    for parent in (base, *generations):
        for place in child_folders(spark, parent):
            if place.rsplit("/", 1)[-1].startswith(f"{partition_col}=") and plain_path(place) not in used:
                delete_folder(spark, place)
                removed += 1
    for generation in generations:
        if not child_folders(spark, generation):
            delete_folder(spark, generation)
    return removed
