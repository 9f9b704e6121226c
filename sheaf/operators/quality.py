"""Validity of records and accounting of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheaf.functions import arrays


def primary_doi() -> Column:
    return arrays.blank_to_null(arrays.first(F.col("dois"))["value"])


def valid(records: DataFrame) -> DataFrame:
    return records.where(F.col("error").isNull())


def quarantined(records: DataFrame, run_id: str | None = None, stage: str = "parse") -> DataFrame:
    """Documents that did not become records, with the reason."""
    return records.where(F.col("error").isNotNull()).select(
        F.lit(run_id).cast("string").alias("run_id"),
        "spider",
        "doc_id",
        F.lit(stage).alias("stage"),
        "error",
        "payload",
    )


def run_summary(records: DataFrame) -> DataFrame:
    """Counts of records, errors and missing DOIs for each spider."""
    ok = F.col("error").isNull()
    return records.groupBy("spider").agg(
        F.count_if(ok).alias("n_records"),
        F.count_if(~ok).alias("n_errors"),
        F.count_if(ok & primary_doi().isNull()).alias("n_missing_doi"),
    )


def run_dois(records: DataFrame) -> DataFrame:
    """DOIs of a run, as rows: a list would grow with the run."""
    return valid(records).select("spider", primary_doi().alias("doi")).where("doi IS NOT NULL")


def warning_counts(records: DataFrame) -> DataFrame:
    flagged = records.select("spider", F.explode("warnings").alias("warning"))
    return flagged.groupBy("spider", "warning").agg(F.count("*").alias("n"))


def error_counts(records: DataFrame) -> DataFrame:
    failed = records.where(F.col("error").isNotNull())
    return failed.groupBy("spider", "error").agg(F.count("*").alias("n"))
