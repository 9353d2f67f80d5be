"""Session defaults for running outside a managed cluster, and the package for the workers."""

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def session(app: str = "gridsight", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; keyword ``a__b`` sets the option ``a.b``."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return ship(builder.getOrCreate())


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that runs within go when it ends; Spark keeps them until the
    driver happens to collect its garbage.  For writes of tables that are read back."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application.

    Functions that run in workers are pickled by module name, so the workers must find the
    package wherever they start.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="package-"), "gridsight.zip")
        with zipfile.ZipFile(target, "w") as out:
            for folder, _, files in os.walk(package):
                for name in sorted(files):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(target)  # the driver serves it to the executors
        _shipped.add(context.applicationId)
    return spark
