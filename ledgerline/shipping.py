"""Makes the package importable in Python workers, wherever they run."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_done: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for an application."""
    app = spark.sparkContext.applicationId
    if app not in _done:
        here = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="ledgerline-src-")  # executors fetch it as long as the application runs
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        root = Path(folder) / "src"
        shutil.copytree(here, root / here.name, ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{here.name}", "zip", root))
        _done.add(app)
