"""Prepares a session: gives executors this package where it isn't installed on them, and bounds Arrow batches."""

from __future__ import annotations

import os
import zipfile
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import SparkSession

import commerce_lens

# Texts are long rows: a batch of the usual 10,000 of them, held several times over, is a large part of a worker.
BATCH_ROWS = 1000
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package's source to the application, once; Spark hands it to every Python worker."""
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(size)) <= BATCH_ROWS:
        spark.conf.set(size, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(commerce_lens.__file__).parent
        folder = os.path.join(SparkFiles.getRootDirectory(), "source")
        os.makedirs(folder, exist_ok=True)
        target = os.path.join(folder, f"{root.name}.zip")
        with zipfile.ZipFile(target, "w") as z:
            for path in sorted(root.rglob("*.py")):
                z.write(path, path.relative_to(root.parent))
        spark.sparkContext.addPyFile(target)
        _SHIPPED.add(app)
    return spark
