"""The package itself for workers that cannot import it from their own path."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Texts in an Arrow batch, unless the session says otherwise: a worker holds one batch as
#: bytes, as Arrow and as Python objects at once.
BATCH_ROWS = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the workers of this application, once, and bound their batches.

    Spark serves the archive from the driver; a worker that already has the package on
    its path is not disturbed.
    """
    if spark.conf.get(_ROWS, None) is None:
        spark.conf.set(_ROWS, str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/siltstone", "zip", root, "siltstone")
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
