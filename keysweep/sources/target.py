"""Readers of the replica: its stored table, its active rows, or a CSV snapshot of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keysweep.functions.columns import column, is_active
from keysweep.sources.csv_split import read_csv_records
from keysweep.sources.widening import stored_schema
from keysweep.spec import FLAG_COLUMN, PARTITION_COLUMN

# Read in place of an empty field without quotes; a quoted one is the empty text.
_NULL = "\0"


def table_exists(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.tableExists(f"`{database}`.`{table}`")


def require_table(spark: SparkSession, database: str, table: str) -> None:
    if not table_exists(spark, database, table):
        raise ValueError(f"table {database}.{table} does not exist")


def read_target(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    partition_col: str | None = PARTITION_COLUMN,
    kept_schema: str | None = None,
) -> DataFrame:
    """All rows of the partitioned Parquet table at ``path``, in its stored types.

    Spark would guess the type of the partition column from directory names, and turn ``007`` into 7.
    Without a ``schema`` it is read as the text it was written as, and the schemas of all files are merged: a column
    that only some files have is NULL in the rows of the others, and a column that is wider in some files is so in all rows.
    Files whose types no type holds without loss fail the read. ``kept_schema`` is a folder outside of the table
    that keeps the merged schema, so that the next read looks at new files only.
    """
    if schema is None:
        schema = stored_schema(spark, path, partition_col, kept_schema)
    return spark.read.schema(schema).parquet(path).select(*map(column, schema.fieldNames()))


def read_target_active(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    partition_col: str | None = PARTITION_COLUMN,
    flag_col: str = FLAG_COLUMN,
    null_is_active: bool = False,
) -> DataFrame:
    """The active rows; the filter reaches the Parquet scan."""
    rows = read_target(spark, path, schema, partition_col)
    return rows.filter(is_active(flag_col, null_is_active))


CSV_OPTIONS = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": _NULL,
    "mode": "FAILFAST",
}


def read_csv_snapshot(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True, split: bool = False
) -> DataFrame:
    """A CSV snapshot with a header, in declared types.

    Quoted fields may hold line breaks and doubled quotes; an empty field is NULL unless quoted. Spark's own reader gives a file with
    line breaks in fields to one task. With ``split`` such files are read by many tasks, twice, see ``csv_split``;
    ``multi_line`` may be False where no field holds a line break, and then they are split anyway.
    """
    if split and multi_line:
        return read_csv_records(spark, path, schema, {**CSV_OPTIONS, "multiLine": "true"})
    return spark.read.schema(schema).csv(path, header=True, multiLine=multi_line, enforceSchema=False, **csv_arguments())


def csv_arguments() -> dict[str, object]:
    """``CSV_OPTIONS`` as arguments of the reader."""
    return {name: {"true": True, "false": False}.get(value, value) for name, value in CSV_OPTIONS.items()}


def write_csv_snapshot(df: DataFrame, path: str) -> None:
    """A snapshot that ``read_csv_snapshot`` reads back unchanged."""
    df.write.csv(
        path,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
