"""The common schema of Parquet files that disagree on the types of columns.

A column may become wider over the years: a key grows from 32 to 64 bits, an amount gets more digits. Merging schemas fails then.
Here the files, ordered by their time, are halved until the files of each group agree; a table whose types changed a few
times needs a few merges for each halving, and one merge if they never did. The schema of all is the least one that holds
every value of every group; Parquet's reader widens the rows of narrower files as it scans, so the table stays one scan.
A mix that would lose values is refused, naming a file of either kind.

A schema may be kept in a folder together with the list of the files behind it. Then only files that are not in that list, by path,
time and length, have their footers read. A file that is gone leaves its columns and its width behind.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keysweep.sinks.files import child_folders, delete_folder

# Digits that an integer type needs.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_INTEGERS = tuple(_DIGITS)
_MOST_DIGITS = 38
# The kept list of files; the row without a file holds the schema.
_KEPT = "path string, modified timestamp, length long, schema string"


def wider(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """The least type that holds all values of both; None if there is none."""
    if left == right:
        return left
    kinds = (type(left), type(right))
    if all(k in _DIGITS for k in kinds):
        return max(left, right, key=lambda t: _INTEGERS.index(type(t)))
    if set(kinds) <= {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if T.DoubleType in kinds and any(k in _DIGITS and k is not T.LongType for k in kinds):
        return T.DoubleType()
    if T.DecimalType in kinds and all(k is T.DecimalType or k in _DIGITS for k in kinds):
        places = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (left, right)]
        whole, scale = max(p[0] for p in places), max(p[1] for p in places)
        return T.DecimalType(whole + scale, scale) if whole + scale <= _MOST_DIGITS else None
    if set(kinds) == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if kinds == (T.ArrayType, T.ArrayType):
        element = wider(left.elementType, right.elementType)
        return element and T.ArrayType(element, left.containsNull or right.containsNull)
    if kinds == (T.MapType, T.MapType):
        key, value = wider(left.keyType, right.keyType), wider(left.valueType, right.valueType)
        return T.MapType(key, value, left.valueContainsNull or right.valueContainsNull) if key and value else None
    if kinds == (T.StructType, T.StructType):
        try:
            return wider_fields(left, right)
        except Disagreement:
            return None
    return None


class Disagreement(ValueError):
    """Two types of a column that no type holds without loss."""


def wider_fields(left: T.StructType, right: T.StructType) -> T.StructType:
    """The columns of both, those of ``left`` first, each in the least type that holds both."""
    others = {f.name: f for f in right}
    fields = []
    for field in left:
        other = others.pop(field.name, None)
        kind = wider(field.dataType, other.dataType) if other else field.dataType
        if kind is None:
            raise Disagreement(f"column {field.name}: {field.dataType.simpleString()} and {other.dataType.simpleString()}")
        fields.append(T.StructField(field.name, kind))
    return T.StructType([*fields, *(T.StructField(f.name, f.dataType) for f in others.values())])


@dataclass(frozen=True)
class Group:
    """Files that agree, in the order of their time, and their merged schema."""

    schema: T.StructType
    file: str


def merged(spark: SparkSession, base: str, files: Sequence[str], partition_col: str | None) -> T.StructType:
    """The schema of ``files`` by Spark's own merge, which reads their footers in tasks and fails where they disagree."""
    found = spark.read.option("mergeSchema", "true").option("basePath", base).parquet(*files).schema
    return _with_partition(found, partition_col)


def cannot_merge(error: Exception) -> bool:
    """Whether a read failed because schemas disagree; Spark raises this one without its Python class."""
    return "[CANNOT_MERGE_" in str(error)


def agreeing_groups(spark: SparkSession, base: str, files: Sequence[str], partition_col: str | None) -> list[Group]:
    """Neighbouring ``files`` in groups that agree."""
    try:
        return [Group(merged(spark, base, files, partition_col), files[0])]
    except (PySparkException, Py4JJavaError) as error:
        if len(files) == 1 or not cannot_merge(error):
            raise
    half = len(files) // 2
    return agreeing_groups(spark, base, files[:half], partition_col) + agreeing_groups(spark, base, files[half:], partition_col)


def united(groups: Sequence[Group]) -> T.StructType:
    whole, names = groups[0].schema, [groups[0]]
    for group in groups[1:]:
        try:
            whole = wider_fields(whole, group.schema)
        except Disagreement as error:
            other = next(g for g in names if _disagree(g.schema, group.schema, whole))
            raise ValueError(f"{error}: no type holds both without loss, in {other.file} and {group.file}") from None
        names.append(group)
    return whole


def _disagree(left: T.StructType, right: T.StructType, whole: T.StructType) -> bool:
    """Whether ``left`` has a part in ``whole`` not taking ``right``: by itself, or by the width it led to."""
    kinds = {f.name: f.dataType for f in whole}
    own = {f.name for f in right if f.name in kinds and wider(kinds[f.name], f.dataType) is None}
    return any(f.name in own for f in left)


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, modified, length) of the Parquet files below ``path``."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return found.select("path", F.col("modificationTime").alias("modified"), "length")


def stored_schema(spark: SparkSession, path: str, partition_col: str | None, kept: str | None = None) -> T.StructType:
    """The common schema of the files of the table at ``path``; the partition column is text, and comes last.

    With ``kept``, a folder beside the table, the schema is kept there and only the footers of new files are read.
    """
    if kept is None:
        try:
            return _with_partition(spark.read.option("mergeSchema", "true").parquet(path).schema, partition_col)
        except (PySparkException, Py4JJavaError) as error:
            if not cannot_merge(error):
                raise
        files = _in_order(stored_files(spark, path))
        return _with_partition(united(agreeing_groups(spark, path, files, partition_col)), partition_col)
    now = stored_files(spark, path)
    before = child_folders(spark, kept)
    rows = spark.read.schema(_KEPT).parquet(before[-1]) if before else None
    head = rows.filter("schema is not null").first() if before else None
    # Without its head, a version was not written to its end.
    known = T.StructType.fromJson(json.loads(head.schema)) if head else None
    new = _in_order(now.join(rows.hint("merge"), ["path", "modified", "length"], "left_anti") if head else now)
    groups = agreeing_groups(spark, path, new, partition_col) if new else []
    if known is not None:
        groups = [Group(known, f"the files known to {before[-1]}"), *groups]
    if not groups:
        raise ValueError(f"no Parquet files below {path}")
    whole = _with_partition(united(groups), partition_col)
    if new:
        first = spark.createDataFrame([(None, None, None, whole.json())], _KEPT)
        target = f"{kept.rstrip('/')}/version-{_next_version(before):09d}"
        now.withColumn("schema", F.lit(None).cast("string")).unionAll(first).write.parquet(target)
        for old in before:
            delete_folder(spark, old)
    return whole


def _next_version(before: Sequence[str]) -> int:
    return int(before[-1].rsplit("-", 1)[1]) + 1 if before else 1


def _in_order(files: DataFrame) -> list[str]:
    return [r.path for r in files.orderBy("modified", "path").select("path").collect()]


def _with_partition(schema: T.StructType, partition_col: str | None) -> T.StructType:
    """``schema`` with the partition column as the text it was written as."""
    own = [f for f in schema if f.name != partition_col]
    found = [T.StructField(f.name, T.StringType()) for f in schema if f.name == partition_col]
    return T.StructType(own + found)
