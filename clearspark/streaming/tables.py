"""Tables written by micro-batches, whole or not at all, and the same when written again.

Each micro-batch owns a folder named by its id and overwrites it, so a micro-batch
that is replayed after a failure leaves exactly what its first run would have left.
"""

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STEP = "micro_batch"


def step_path(folder: str, step: int) -> str:
    return os.path.join(folder, f"{STEP}={step}")


def write_step(rows: DataFrame, folder: str, step: int, partition_by: tuple[str, ...] = ()) -> None:
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(step_path(folder, step))


_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _raise_unless_absent(error: AnalysisException) -> None:
    if error.getCondition() not in _ABSENT:
        raise error


def read_step(spark: SparkSession, folder: str, step: int) -> DataFrame | None:
    """What one micro-batch wrote, None when it wrote nothing."""
    try:
        return spark.read.parquet(step_path(folder, step))
    except AnalysisException as error:
        _raise_unless_absent(error)
        return None


class MissingStep(Exception):
    """What an earlier micro-batch handed over is gone; going on would lose its rows."""


class ForeignFolder(Exception):
    """The folder belongs to another streaming query."""


def handed_over(spark: SparkSession, folder: str, step: int) -> DataFrame | None:
    """What the micro-batch before `step` wrote for it; None before the first one only."""
    if step == 0:
        return None
    path = step_path(folder, step - 1)
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        _raise_unless_absent(error)
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingStep(path) from error
        return None


def claim(spark: SparkSession, folder: str) -> None:
    """Lets one streaming query only write to a folder.

    Spark keeps a query's id in its checkpoint, so a restart has the same one, and a new
    checkpoint, whose micro-batches would overwrite the old ones, another. Outside a
    streaming query nothing is claimed.
    """
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        return
    path = os.path.join(folder, "owner")
    try:
        owner = spark.read.schema("query string").parquet(path).first()
    except AnalysisException as error:
        _raise_unless_absent(error)
        owner = None
    if owner is None:
        spark.range(1).select(F.lit(query).alias("query")).write.mode("overwrite").parquet(path)
    elif owner["query"] != query:
        raise ForeignFolder(f"{folder} was written by query {owner['query']}")


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, in a form that costs a query no tasks."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]).filter(F.lit(False))


def read_table(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All micro-batches; an empty table before the first."""
    columns = T.StructType([*schema.fields, T.StructField(STEP, T.LongType())])
    try:
        return spark.read.schema(columns).parquet(folder)
    except AnalysisException as error:
        _raise_unless_absent(error)
        return _empty(spark, columns)


def _cell_path(cell: Sequence[tuple[str, object]]) -> str:
    return "/".join(f"{name}={value}" for name, value in cell)


def write_cells(rows: DataFrame, folder: str, step: int, cell: tuple[str, ...]) -> None:
    """Writes a micro-batch into a table cut by `cell` first and by micro-batch inside of it.

    Only the folders that get rows are replaced, so a micro-batch that is written again
    replaces what its first run wrote and nothing else.
    """
    (
        rows.withColumn(STEP, F.lit(step).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*cell, STEP)
        .parquet(folder)
    )


def read_cells(
    spark: SparkSession, folder: str, schema: T.StructType, cells: Sequence[Sequence[tuple[str, object]]]
) -> DataFrame:
    """The named cells of a table written by `write_cells`; those that are absent have no rows.

    The cells are alternatives of one path pattern, so that no other folder is listed.
    """
    columns = T.StructType([*schema.fields, T.StructField(STEP, T.LongType())])
    if not cells:
        return _empty(spark, columns)
    pattern = "{" + ",".join(sorted(map(_cell_path, cells))) + "}"
    try:
        # The pattern is matched when the reader is made.
        return spark.read.schema(columns).option("basePath", folder).parquet(f"{folder}/{pattern}")
    except AnalysisException as error:
        _raise_unless_absent(error)
        return _empty(spark, columns)


def before_step(table: DataFrame, step: int) -> DataFrame:
    """Rows of earlier micro-batches only: a replay must not see its own first run."""
    return table.filter(F.col(STEP) < step)
