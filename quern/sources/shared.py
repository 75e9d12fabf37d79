"""The folder that driver and executors share, tables written there, and this package on the executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch: texts are long, and a worker holds a whole batch.
BATCH_ROWS = 512

_shipped: set[str] = set()
_made: list[list[str]] = []  # paths by open `tidied` block


def ship(spark: SparkSession | None = None) -> None:
    """Give executors this package, once per application: they need not have it installed.

    Arrow batches stay small: the session's maxRecordsPerBatch is lowered to BATCH_ROWS.
    """
    spark = spark or SparkSession.active()
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    folder = Path(tempfile.mkdtemp())
    archive = folder / f"{root.name}_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    _shipped.add(app)


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset, one is made, in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="quern-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{made}")
    return f"file://{made}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    path = f"{shared_root(spark)}/quern/{name}-{uuid.uuid4().hex}"
    for paths in _made[-1:]:
        paths.append(path)
    return path


@contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """Remove what the block makes by `scratch`: for blocks that write their result elsewhere before they end."""
    paths: list[str] = []
    _made.append(paths)
    try:
        yield
    finally:
        _made.pop()
        for path in paths:
            delete(spark, path)


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: lineage ends there."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held(df: DataFrame, name: str, column: Column) -> DataFrame:
    """df with a column that is made before what uses it: Spark does not take a Python function out of an expression with lambdas in its arguments."""
    return df.withColumn(name, F.explode(F.array(column)))


def filesystem(spark: SparkSession, path: str):
    """Spark's file system of a path, and the path in its terms."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = filesystem(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a path with all below it."""
    fs, target = filesystem(spark, path)
    fs.delete(target, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Files of a folder arrive in another at once; where there is no such folder, the other is empty."""
    fs, target = filesystem(spark, to)
    fs.mkdirs(target.getParent() if exists(spark, path) else target)
    if exists(spark, path) and not fs.rename(filesystem(spark, path)[1], target):
        raise OSError(f"{path} was not moved to {to}")
