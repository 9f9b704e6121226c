"""Helpers shared by the operators: Arrow maps over texts, tables that cut lineage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

#: Rows handed to a worker function at once.
SLICE = 256
#: Has Spark delete a query's shuffle files, on all executors, as soon as it is over.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders of the staged tables in use.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_texts(
    df: DataFrame,
    columns: list[str],
    work: Callable[..., dict[str, list]],
    fields: str,
    keep: tuple[str, ...] = (),
    rows: int = SLICE,
) -> DataFrame:
    """Map slices of so many rows to rows, without a shuffle.

    ``work`` gets one list per name of ``columns`` and returns one list per
    field of the DDL string ``fields``; the lists may be of any length.  With
    ``keep`` it must return one value per row, and these columns of ``df`` are
    put in front unchanged.
    """
    own = StructType.fromDDL(fields)
    schema = StructType([StructField(n, df.schema[n].dataType) for n in keep] + own.fields)
    arrow_schema, arrow_own = to_arrow_schema(schema), to_arrow_schema(own)
    n_keep, n_in = len(keep), len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                made = work(*(batch.column(n_keep + i).to_pylist() for i in range(n_in)))
                arrays = [batch.column(i).cast(arrow_schema.field(i).type) for i in range(n_keep)]
                arrays += [pa.array(made[f.name], type=f.type) for f in arrow_own]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

    # Positions, not names: a kept column may also be an input.
    picked = [df[n].alias(f"c{i}") for i, n in enumerate([*keep, *columns])]
    return df.select(*picked).mapInArrow(run, schema)


def smallest_hashes(df: DataFrame, column: str, n: int) -> DataFrame:
    """The rows of the ``n`` smallest hashes of a column; of equal values all rows."""
    key = F.xxhash64(column)
    bound = df.select(key.alias("k")).distinct().orderBy("k").limit(n).agg(F.max("k")).first()[0]
    return df.filter(key <= F.lit(bound))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: ``spark.checkpoint.dir``.

    Where it is unset, as in tests on one machine, a folder beside the
    warehouse is used; on a cluster it must be set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
    return folder or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "sheaf-checkpoints")


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are over: it does once the driver's JVM has noticed that they are garbage."""
    spark.sparkContext._jvm.System.gc()


def staged(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Cuts lineage so that lost executors never cost more than the tasks that
    read or write this table, whose shuffle files are deleted once it is written.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    free_shuffles(spark)
    table = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete the files of staged tables; nothing may read these, or what is made of them, any more."""
    for df in tables:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop(df))
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)
