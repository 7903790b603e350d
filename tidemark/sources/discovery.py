"""Finding the date partitions to check below a list of roots."""

import datetime
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import InputError

# Fixed value: the date column of the landed directories.
DEFAULT_DATE_COLUMN = "timestampcolumn"
LISTING_SCHEMA = "root string, path string, name string, is_dir boolean"
# The outcomes of a scan.
STATUSES = ["eligible", "skipped_run_date", "invalid_date", "non_matching"]


def check_roots(roots) -> list:
    """A list of roots, or comma-separated text, without blanks."""
    items = roots.split(",") if isinstance(roots, str) else list(roots or [])
    roots = [item.strip() for item in items if item and item.strip()]
    if not roots:
        raise InputError("at least one input root is required")
    return roots


def check_run_date(run_date) -> datetime.date:
    """The date to skip; the driver's current date when none is given.

    Text must be a full ISO date; of a date with a time the date counts.
    """
    if run_date is None:
        return datetime.date.today()
    if isinstance(run_date, datetime.datetime):
        return run_date.date()
    if isinstance(run_date, datetime.date):
        return run_date
    text = str(run_date)
    try:
        if not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", text):
            raise ValueError("not of the form yyyy-mm-dd")
        return datetime.date.fromisoformat(text)
    except ValueError as error:
        raise InputError(f"invalid run date: {run_date!r}") from error


def scan_roots(spark: SparkSession, roots) -> DataFrame:
    """The immediate children of each root: ``root, path, name, is_dir``.

    A directory listing is file-system metadata, so it is read through the session's Hadoop
    file system on the driver; only the names below the roots pass through it.
    """
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    children = []
    for root in check_roots(roots):
        try:
            path = jvm.org.apache.hadoop.fs.Path(root)
            fs = path.getFileSystem(conf)
            found = fs.exists(path)
            statuses = fs.listStatus(path) if found and fs.getFileStatus(path).isDirectory() else None
        except Exception as error:
            raise InputError(f"cannot list input root {root}: {error}") from error
        if not found:
            raise InputError(f"input root does not exist: {root}")
        if statuses is None:
            raise InputError(f"input root is not a directory: {root}")
        for status in statuses:
            child = status.getPath()
            children.append((root, child.toString(), child.getName(), bool(status.isDirectory())))
    # From an Arrow table a small listing becomes a local relation, which needs no Python task.
    columns = list(zip(*children)) or [()] * 4
    types = [pa.string(), pa.string(), pa.string(), pa.bool_()]
    arrays = [pa.array(column, kind) for column, kind in zip(columns, types)]
    return spark.createDataFrame(pa.table(arrays, names=["root", "path", "name", "is_dir"]))


def classify_partitions(listing: DataFrame, run_date, date_column: str = DEFAULT_DATE_COLUMN) -> DataFrame:
    """Add ``status`` and ``partition_date`` to a listing.

    A directory named ``<date_column>=<date>`` is eligible unless its date is not a real
    ISO date or equals the run date; dates after the run date are eligible. Everything
    else, plain files included, is non-matching.
    """
    prefix = date_column + "="
    text = F.substr("name", F.lit(len(prefix) + 1))
    # [0-9] and \z: nothing but ASCII digits, and no newline at the end.
    date = F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), text.try_cast("date"))
    named = F.col("is_dir") & F.startswith("name", F.lit(prefix))
    status = (
        F.when(~named, "non_matching")
        .when(date.isNull(), "invalid_date")
        .when(date == F.lit(check_run_date(run_date)), "skipped_run_date")
        .otherwise("eligible")
    )
    return listing.select("*", status.alias("status"), F.when(named, date).alias("partition_date"))


def eligible_paths(partitions: DataFrame) -> DataFrame:
    """The distinct paths to read, ordered."""
    return partitions.filter("status = 'eligible'").select("path").distinct().orderBy("path")


def ordered_eligible(partitions: DataFrame) -> DataFrame:
    """The eligible partitions with their dates, by date and then path."""
    eligible = partitions.filter("status = 'eligible'").select("partition_date", "path").distinct()
    return eligible.orderBy("partition_date", "path")


def scan_summary(partitions: DataFrame, roots=()) -> DataFrame:
    """Number of children per root and status, 0 included.

    A root without children is not in ``partitions``; name it in ``roots`` to have its rows.
    """
    names = F.array(*map(F.lit, STATUSES))
    every = partitions.select("root")
    if roots:
        every = every.union(partitions.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, check_roots(roots))))))
    wanted = every.distinct().select("root", F.explode(names).alias("status"))
    counts = partitions.groupBy("root", "status").agg(F.count(F.lit(1)).alias("n"))
    return wanted.join(counts, ["root", "status"], "left").select(
        "root", "status", F.coalesce("n", F.lit(0)).alias("path_count")
    )


def require_eligible(partitions: DataFrame) -> list:
    """The paths to read as a list, or an error that says what was skipped."""
    paths = [row.path for row in eligible_paths(partitions).collect()]
    if not paths:
        skipped = partitions.filter("status = 'skipped_run_date'").count()
        detail = f"; skipped_run_date_partition_count={skipped}" if skipped else ""
        raise InputError("no eligible date partition below the roots" + detail)
    return paths
