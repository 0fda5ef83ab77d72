"""The package's code, sent to executors that don't have it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add this package to the Python path of the application's tasks, once."""
    application = spark.sparkContext.applicationId
    if application in _SENT:
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="kinmatch-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    packed = Path(folder) / "kinmatch_code.zip"
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(packed))
    _SENT.add(application)
