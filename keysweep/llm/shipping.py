"""Prepares a session for the Python workers: sends them this package, as ``--py-files`` does, and bounds their batches."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Most bytes of rows that go to a worker at once; by default only their number is bounded, whatever their texts.
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's source files to the application once, and lower the session's batches to ``BATCH_BYTES``."""
    known = str(spark.conf.get(BATCH_SETTING, None) or "").rstrip("bB")
    if not known.isdigit() or not 0 < int(known) <= BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _sent.add(context.applicationId)
