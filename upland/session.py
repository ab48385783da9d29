"""Session defaults: adaptive plans, UTC, Arrow transfer, filter pushdown into Python sources."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
}


def session(app: str = "upland", **conf: str) -> SparkSession:
    return SparkSession.builder.appName(app).config(map=CONF | conf).getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application; they may not have it on their path."""
    sc = spark.sparkContext
    if getattr(sc, "_upland_shipped", None) != sc.applicationId:
        root = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(), "upland.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("upland", os.path.relpath(full, root)))
        sc.addPyFile(path)
        sc._upland_shipped = sc.applicationId
    return spark
