"""Session helpers: the shared scratch folder, checkpoints and size limits."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# A side is shipped to every task only below this size; callers keep another way beyond it.
BROADCAST_BYTES = 64 * 1024 * 1024


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, or a temporary one in local tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="accrete-")
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def new_dir(spark: SparkSession, label: str) -> str:
    """A path of its own under the shared folder; the writer creates it."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write `df` to the reliable checkpoint folder and go on from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and go on from the files: lineage ends here, and
    a lost executor costs a re-read, not a recomputation."""
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()

# Rows of an Arrow batch: whole documents are wide, and both ends hold a batch in memory.
ARROW_ROWS = 1000


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers, wherever they run: a zip in the shared folder.

    Arrow batches are made smaller, unless the session has a size of its own.
    """
    from accrete.sources.files import Folder

    context, rows = spark.sparkContext, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":  # Spark's default
        spark.conf.set(rows, ARROW_ROWS)
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for at, _, names in os.walk(os.path.join(root, "accrete")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(at, name)
                    archive.write(path, os.path.relpath(path, root))
    folder = Folder(spark, new_dir(spark, "code"))
    folder.publish(packed.getvalue(), "accrete.zip")
    context.addPyFile(folder.path("accrete.zip"))
    _shipped.add(context.applicationId)
