"""Makes this package importable in Python workers that were not started with it on their path."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's source files to the workers, once for each application.

    Where the environment already names the package's folder in PYTHONPATH,
    workers find it there and nothing is sent.
    """
    known = {os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    app = spark.sparkContext.applicationId
    if _ROOT in known or app in _shipped:
        return
    package = os.path.basename(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix=f"{package}-"), f"{package}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(os.path.join(_ROOT, package)):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, _ROOT))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
