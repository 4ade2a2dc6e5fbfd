"""CSV files with line breaks in quoted fields, read by many tasks for each file.

A split of a file begins anywhere, so whether its first line continues a quoted field depends on all quotes before it.
Quotes are counted for each split first; the parities of the splits before one say how it begins. A second pass joins
the lines of each split to records, in the order in which its task reads them and without a shuffle: a record ends where
the number of quotes since its start is even. What a split holds of records that begin or end in other splits
are pieces, at most two for each split, which are put together by their order in the file.

Doubled quotes count as two, so they do not matter. A quote that is part of a field without quotes would; such files are not
written by ``write_csv_snapshot``, and are refused if they end in a quoted field or their records do not fit the schema.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keysweep.functions.columns import column
from keysweep.storage import BROADCAST_LIMIT, sized, stage, work_folder

QUOTE = '"'

FILE, SPLIT, SIZE = "_metadata.file_path", "_metadata.file_block_start", "_metadata.file_block_length"


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, split, size (of the split) and text of every line, with a carriage return before its end if there is one."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col(FILE).alias("file"), F.col(SPLIT).alias("split"), F.col(SIZE).alias("size"), F.col("value").alias("text"))


def quotes_in(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(QUOTE), F.lit("")))


def split_starts(lines: DataFrame) -> DataFrame:
    """Whether each split begins inside of a quoted field: file, split, size, inside. One row for each split."""
    counted = lines.groupBy("file", "split", "size").agg((F.sum(quotes_in(F.col("text"))) % 2).alias("odd"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("file", "split", "size", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1).alias("inside"))


# Kinds of rows that a split gives: whole records, the end of one that began before, the start of one that ends later, and lines
# that lie between.
WHOLE, TAIL, HEAD, MIDDLE = range(4)


def line_joiner() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Joins lines to records. All of it is defined here, so that it is sent to workers that lack this package."""

    class Splits:
        """Joins the lines of one split after the other to records; lines come in the order of their files."""

        def __init__(self) -> None:
            self.at: tuple[str, int] | None = None
            self.first = False

        def begin(self, file: str, split: int, inside: bool) -> None:
            self.at, self.lines, self.inside = (file, split), [], inside
            # The split's first lines belong to a record of an earlier split until it ends.
            self.foreign = inside
            self.first = split == 0

        def end(self) -> Iterator[tuple]:
            if self.at is not None and self.lines:
                kind = MIDDLE if self.foreign else HEAD
                yield (*self.at, kind, self.first and not self.foreign, "\n".join(self.lines))
            self.at = None

        def take(self, texts: pa.Array) -> Iterator[tuple]:
            """Rows of the records that end in ``texts``; the rest is kept."""
            odd = pc.count_substring(texts, QUOTE).to_numpy(zero_copy_only=False) % 2
            inside = (int(self.inside) + np.cumsum(odd)) % 2
            ends = np.flatnonzero(inside == 0) + 1
            self.inside = bool(inside[-1])
            if not len(ends):
                self.lines += texts.to_pylist()
                return
            bounds = np.concatenate([[0], ends])
            records = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), texts.slice(0, int(ends[-1]))), "\n").to_pylist()
            if self.lines:
                records[0] = "\n".join([*self.lines, records[0]])
            for i, record in enumerate(records):
                kind = TAIL if self.foreign and i == 0 else WHOLE
                yield (*self.at, kind, self.first and kind == WHOLE, record)
                self.first = self.first and kind != WHOLE
            self.foreign = False
            self.lines = texts.slice(int(ends[-1])).to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits = Splits()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            names = ("file", "split", "kind", "first", "text")
            types = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            out = []
            file, split, inside = (batch.column(n) for n in ("file", "split", "inside"))
            at = 0
            while at < batch.num_rows:
                here = (file[at].as_py(), split[at].as_py())
                if splits.at != here:
                    out += splits.end()
                    splits.begin(*here, inside[at].as_py())
                same = pc.and_(pc.equal(split.slice(at), here[1]), pc.equal(file.slice(at), here[0])).to_numpy(zero_copy_only=False)
                other = np.flatnonzero(~same)
                to = at + int(other[0]) if len(other) else batch.num_rows
                out += splits.take(batch.column("text").slice(at, to - at))
                at = to
            if out:
                yield batch_of(out)
        if rest := list(splits.end()):
            yield batch_of(rest)

    return run


def records(spark: SparkSession, path: str, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """file, first (whether it is the file's first one) and text of every record of the files at ``path``."""
    folder = work_folder(spark, "csv")
    lines = raw_lines(spark, path)
    starts = sized(stage(split_starts(lines), f"{folder}/starts"), broadcast_limit)
    known = starts.rows.select(
        F.col("file").alias("known_file"), F.col("split").alias("known_split"), F.col("size").alias("known_size"), "inside"
    )
    if not starts.small:
        # Lines must stay in the order in which they are read.
        raise ValueError("there are more splits than a broadcast holds; raise spark.sql.files.maxPartitionBytes")
    met = lines.join(known.hint(starts.hint), (F.col("file") == F.col("known_file")) & (F.col("split") == F.col("known_split")), "left")
    # Both passes must split the files alike.
    message = F.concat(F.lit("the file was split in another way when it was read again: "), F.col("file"))
    same = F.col("known_size").isNotNull() & (F.col("known_size") == F.col("size"))
    met = met.select("file", "split", F.when(same, F.col("inside")).otherwise(F.raise_error(message).cast("boolean")).alias("inside"), "text")
    schema = "file string, split long, kind int, first boolean, text string"
    found = stage(met.mapInArrow(line_joiner(), schema), f"{folder}/records")
    pieces = found.filter(F.col("kind") != WHOLE)
    # Pieces of one record follow each other in the file; each record begins with a head.
    order = Window.partitionBy("file").orderBy("split", F.col("kind") == HEAD)
    numbered = pieces.withColumn("record", F.sum((F.col("kind") == HEAD).cast("int")).over(order))
    parts = F.sort_array(F.collect_list(F.struct("split", (F.col("kind") == HEAD).alias("head"), "text")))
    stitched = numbered.groupBy("file", "record").agg(
        F.max("first").alias("first"),
        F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"),
        F.max((F.col("kind") == TAIL).cast("int")).alias("ended"),
    )
    open_ = F.concat(F.lit("a quoted field does not end in "), F.col("file"))
    text = F.when(F.col("ended") == 1, F.col("text")).otherwise(F.raise_error(open_).cast("string"))
    return found.filter(F.col("kind") == WHOLE).select("file", "first", "text").unionByName(stitched.select("file", "first", text.alias("text")))


def parsed(rows: DataFrame, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """``records`` in the types of ``schema``, without the header of each file, whose names must be those of ``schema``."""
    text = F.regexp_replace(F.col("text"), "\r$", "")
    text = F.when(F.col("first"), F.regexp_replace(text, "^﻿", "")).otherwise(text)
    rows = rows.select("file", "first", text.alias("text")).filter(F.col("text") != "")
    names = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    read, head = F.from_csv("text", ddl(schema), options), F.from_csv("text", ddl(names), options)
    fits = F.array(*[F.lower(head[f.name]) for f in schema.fields]) == F.array(*[F.lit(f.name.lower()) for f in schema.fields])
    message = F.concat(F.lit("the header does not have the columns of the schema: "), F.col("file"))
    is_header = F.when(F.col("first"), F.when(fits, True).otherwise(F.raise_error(message).cast("boolean"))).otherwise(False)
    values = rows.filter(~is_header).select(read.alias("row"))
    return values.select(*[F.col("row")[f.name].alias(f.name) for f in schema.fields])


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def read_csv_records(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """Rows of the CSV files at ``path``, with a header each."""
    return parsed(records(spark, path), schema, options).select(*map(column, schema.fieldNames()))
