"""Handing Python functions of this package to the workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@lru_cache(maxsize=8)
def _package_archive(root: str) -> str:
    """The package's sources as a zip file, for the workers to import."""
    path = os.path.join(tempfile.mkdtemp(prefix="quartermaster-"), "quartermaster.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "quartermaster")):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    z.write(file, os.path.relpath(file, root))
    return path


def map_batches(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInArrow(function, schema)``. Unless the Python path that workers
    inherit names the package, Spark hands them its sources (``addPyFile``),
    so that ``function`` can be imported wherever the driver was started."""
    sc = df.sparkSession.sparkContext
    if _ROOT not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        archive = _package_archive(_ROOT)
        if not any(f.endswith(os.path.basename(archive)) for f in sc.listFiles):
            sc.addPyFile(archive)
    return df.mapInArrow(function, schema)
