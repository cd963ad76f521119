"""The engine's Spark session: adaptive execution, UTC, sizes left to the cluster."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def session(app: str = "tidewell", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    base = {"spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC"}
    for key, value in (base | conf).items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the package to Python workers, which may not have it on their path; once an application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).parent
        folder = Path(tempfile.mkdtemp(prefix="tidewell-"))  # the driver's file server hands it on
        with zipfile.ZipFile(folder / "tidewell.zip", "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        context.addPyFile(str(folder / "tidewell.zip"))
        _shipped.add(context.applicationId)
    return spark
