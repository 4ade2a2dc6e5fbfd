"""Keys numbered by consecutive ranges, so that a rank over all of them is taken range by range.

A window without partitions sorts all rows in one task. Ranges of a bounded number of rows are sorted each by itself, and the
rows of the ranges before one are counted, which ``jdbc.quantile_query`` does for a table with such a column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysweep.functions.columns import column, none_null
from keysweep.storage import stage

SLICE = "__slice"
# Rows of a range, on average.
SLICE_ROWS = 500_000


def key_slices(rows: DataFrame, keys: Sequence[str], folder: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The keys of ``rows`` without a NULL, and in ``SLICE`` the number of the range of keys that each is in, in the order of keys.

    Both tables are staged: the first is counted and sampled, and the second must not be numbered twice. Copies of a key are in one range.
    """
    columns = [column(k) for k in keys]
    present = stage(rows.select(*columns).filter(none_null(keys)), f"{folder}/keys")
    slices = max(1, -(-present.count() // slice_rows))
    ranged = present.repartitionByRange(slices, *columns)
    return stage(ranged.withColumn(SLICE, F.spark_partition_id()), f"{folder}/slices")
