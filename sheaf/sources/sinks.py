"""Writing records and the log of runs.

A run owns the folders ``records/run_id=R/batch_id=B`` and likewise below
``dois``, ``errors``, ``landed`` and ``runs`` of the results folder, and
replaces them when it is repeated, so a retried batch leaves no copies.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sheaf.operators.quality import primary_doi, run_dois
from sheaf.schema import DOIS_DDL, ERRORS_DDL, LANDED_DDL, RUN_DDL, schema


def write_json(records: DataFrame, path: str, partition_by: str = "spider") -> int:
    """Write JSON lines, one folder per source; returns the record count."""
    seen = Observation("written")
    counted = records.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.mode("overwrite").partitionBy(partition_by).json(path)
    return seen.get["n"]


def run_path(root: str, table: str, run_id: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/{table}/run_id={run_id}/batch_id={batch_id}"


def write_run(
    records: DataFrame,
    root: str,
    run_id: str,
    source: str,
    batch_id: int = 0,
    started_at: datetime.datetime | None = None,
    window: tuple[str | None, str | None] = (None, None),
    landed_as: str = "path",
) -> DataFrame:
    """Write the records of a run, its accounts and then its log entry.

    Good and bad documents go to separate partitions in one pass over the
    input; the counts are observed on the way.  The DOIs, the errors and the
    paths that the run took are tables beside the log, made from the written
    records; ``landed_as`` names the column of the paths.  The log entry comes
    last, so a run that fails on the way is never taken for a finished one.
    """
    spark = records.sparkSession
    started_at = started_at or _now()
    results = run_path(root, "records", run_id, batch_id)
    ok = F.col("error").isNull()
    seen = Observation("run")
    observed = records.observe(
        seen,
        F.count_if(ok).alias("n_records"),
        F.count_if(~ok).alias("n_errors"),
        F.count_if(ok & primary_doi().isNull()).alias("n_missing_doi"),
    )
    (
        observed.withColumn("status", F.when(ok, "ok").otherwise("error"))
        .write.mode("overwrite")
        .partitionBy("spider", "status")
        .parquet(results)
    )
    counts = seen.get
    written = spark.read.schema(_with_status(records.schema)).parquet(results)
    good, bad = written.where("status = 'ok'"), written.where("status = 'error'")
    accounts = {
        "dois": run_dois(good),
        "errors": bad.select("spider", "doc_id", _stage().alias("stage"), "error"),
        "landed": written.select(
            F.lit(source).alias("source"), F.col(landed_as).alias("path")
        ).where("path IS NOT NULL").distinct(),
    }
    for name, rows in accounts.items():
        rows.write.mode("overwrite").parquet(run_path(root, name, run_id, batch_id))
    entry = spark.createDataFrame(
        [
            (
                run_id, batch_id, source, results, window[0], window[1],
                counts["n_records"], counts["n_errors"], counts["n_missing_doi"],
                started_at, _now(), "success",
            )
        ],
        RUN_DDL,
    )
    log = run_path(root, "runs", run_id, batch_id)
    entry.drop("run_id", "batch_id").coalesce(1).write.mode("overwrite").parquet(log)
    return entry


def _with_status(records: StructType) -> StructType:
    """The schema of the records as written, with the columns that are folders."""
    rest = [f for f in records.fields if f.name not in ("spider", "status")]
    return StructType(rest + [StructField("spider", StringType()), StructField("status", StringType())])


def _stage() -> Column:
    """The step that a document failed in, told by its reason."""
    error = F.col("error")
    landed = F.rlike(error, F.lit("^(unreadable|unsafe member|member of|truncated)"))
    listed = F.rlike(error, F.lit("manifest|^issue lists|^item without"))
    return F.when(landed, "landing").when(listed, "manifest").otherwise("parse")


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc)


def read_records(spark: SparkSession, root: str) -> DataFrame:
    """Good records of all runs; bad ones are pruned as partitions."""
    return _records(spark, root).where("status = 'ok'").drop("status", "error", "payload")


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Documents of all runs that did not become records."""
    return (
        _records(spark, root)
        .where("status = 'error'")
        .select("run_id", "spider", "doc_id", _stage().alias("stage"), "error", "payload")
    )


def _records(spark: SparkSession, root: str) -> DataFrame:
    """Records of all runs, also of those whose stages added columns.

    Only the footers of the files are merged, and a run's name stays text.
    """
    path = f"{root.rstrip('/')}/records"
    found = spark.read.option("mergeSchema", "true").parquet(path).schema
    texts = ("run_id", "spider", "status")
    typed = [StructField(f.name, StringType()) if f.name in texts else f for f in found.fields]
    return spark.read.schema(StructType(typed)).parquet(path)


def _table(spark: SparkSession, root: str, name: str, ddl: str) -> DataFrame:
    """A table of the results folder by its own schema; an error if there is none."""
    path = f"{root.rstrip('/')}/{name}"
    return spark.read.schema(schema(ddl)).parquet(path)


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return _table(spark, root, "runs", RUN_DDL)


def read_dois(spark: SparkSession, root: str) -> DataFrame:
    """DOIs of all runs."""
    return _table(spark, root, "dois", DOIS_DDL)


def read_errors(spark: SparkSession, root: str) -> DataFrame:
    """Errors of all runs, without the documents."""
    return _table(spark, root, "errors", ERRORS_DDL)


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """Paths that finished runs took."""
    landed = _table(spark, root, "landed", LANDED_DDL)
    return landed.join(read_runs(spark, root).select("run_id", "batch_id"), ["run_id", "batch_id"], "left_semi")
