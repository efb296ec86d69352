"""Session settings and the shared folder for state that must outlive an executor."""

import contextlib
import functools
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch while rows are landed. A batch is held by the JVM, outside its heap, and by the Python worker.
BATCH_BYTES = "4m"


def build_session(app: str = "clearspark", cores: str = "*", **conf: str) -> SparkSession:
    """Local session for tests and benches; on a cluster the submitter configures Spark."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="clearspark-")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`; a temporary folder only on one machine without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and not re.fullmatch(r"local(\[.*])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return named or _own_folder()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")


@contextlib.contextmanager
def settings(spark: SparkSession, named: dict[str, str]) -> Iterator[None]:
    """The settings inside; those from before after it."""
    before = {name: spark.conf.get(name, None) for name in named}
    for name, value in named.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def landed(rows: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    A stage whose result several later ones read is computed once, and a lost executor
    costs a read of the table and not the stage. Wide rows go to Python in batches of
    bounded bytes, whatever the number of rows that Spark's batches have.
    """
    path = fresh_folder(rows.sparkSession, label)
    with settings(rows.sparkSession, {"spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}):
        rows.write.partitionBy(*partition_by).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextlib.contextmanager
def keeping(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Gives a `persist` whose tables are dropped at the end.

    They are kept in as many pieces as they fill, not in one per shuffle partition: every
    later pass has a task for each piece, and its shuffles a file for each pair.
    """
    with (
        settings(spark, {"spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true"}),
        contextlib.ExitStack() as kept,
    ):

        def keep(rows: DataFrame) -> DataFrame:
            kept.callback(rows.unpersist)
            return rows.persist()

        yield keep
