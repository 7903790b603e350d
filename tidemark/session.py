"""Making the package known to the Python workers of a session."""

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Only decoding and encoding of side-topic payloads run Python on executors. A cluster on
    which the package is installed, or passed with ``--py-files``, does not need this.
    """
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).resolve().parent
        archive = str(Path(tempfile.mkdtemp(prefix="tidemark-code-")) / package.name)
        spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", package.parent, package.name))
        _shipped.add(application)


def set_checkpoint_dir(spark: SparkSession) -> None:
    """Give a local session without a shared folder a new one; elsewhere it must be set."""
    context = spark.sparkContext
    if not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()) and context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-shared-"))
