"""Shipping the package to the executors' Python workers."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from qanat.session import shared_dir

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Adds this package to the session's files once, by way of the shared folder, so workers can import it wherever they were started."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    path = context._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{root.name}-{context.applicationId}.zip")
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(packed.getvalue()))
    out.close()
    context.addPyFile(path.toString())
    _shipped.add(context.applicationId)
