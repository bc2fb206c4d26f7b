"""The package itself on the executors, whether or not they have it installed."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from cairnlake.lineage import shared_dir

_sent: set[str] = set()


def _archive() -> bytes:
    package = Path(__file__).resolve().parent
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    return out.getvalue()


def ship(spark: SparkSession) -> SparkSession:
    """Give the package to the Python workers once per application, by way of the shared folder."""
    app = spark.sparkContext.applicationId
    if app not in _sent:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/cairnlake-{app}.zip")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        out = fs.create(path, True)
        out.write(bytearray(_archive()))
        out.close()
        spark.sparkContext.addPyFile(fs.makeQualified(path).toString())
        _sent.add(app)
    return spark
