"""What all parsers share."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from sheaf.functions.arrays import empty_to_null
from sheaf.functions.xml import parse_xml, prepare_xml

LINEAGE = {
    "doc_id": "string",
    "package_path": "string",
    "path": "string",
    "pdf_path": "string",
    "pdfa_path": "string",
    "harvested_at": "timestamp",
    # Why a document could not be read at all, e.g. from a damaged archive.
    "landing_error": "string",
}


def with_lineage(documents: DataFrame) -> DataFrame:
    """Add the lineage columns a document table lacks, as NULL."""
    missing = {
        name: F.lit(None).cast(kind)
        for name, kind in LINEAGE.items()
        if name not in documents.columns
    }
    return documents.withColumns(missing) if missing else documents


def computed_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a costly column that is evaluated once per row.

    In a plain projection the optimizer copies the expression into every
    filter it pushes down, and a filter on an exploded list is inferred for
    each explode.  The explode of a one-element array is a step that filters
    and other projections do not cross.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))


def parse_documents(
    documents: DataFrame, fields_ddl: str, node: Column, mixed: tuple[str, ...] = ()
) -> DataFrame:
    """Add the parsed document as ``doc`` and the reason of a failure."""
    prepared = F.nullif(prepare_xml(node, mixed), F.lit(""))
    parsed = computed_once(with_lineage(documents), "doc", parse_xml(prepared, fields_ddl))
    return parsed.withColumn(
        "_malformed",
        F.when(F.col("doc").isNull(), "no document element").when(
            F.col("doc._corrupt_record").isNotNull(), "malformed XML"
        ),
    )


def select_record(
    parsed: DataFrame,
    spider: str,
    fields: Mapping[str, Column],
    warnings: Mapping[str, Column] | None = None,
    error: Column | None = None,
) -> DataFrame:
    """Project fields, warnings and the error of each parsed document."""
    problem = F.coalesce("landing_error", "_malformed", F.lit(None) if error is None else error)
    projected = parsed.select(
        F.lit(spider).alias("spider"),
        *[name for name in LINEAGE if name != "landing_error"],
        *[value.alias(name) for name, value in fields.items()],
        problem.alias("error"),
        F.col("payload"),
    )
    flags = [
        F.when(F.coalesce(condition, F.lit(True)), F.lit(name))
        for name, condition in (warnings or {}).items()
    ]
    noted = F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")
    return projected.withColumns(
        {
            "warnings": F.when(F.col("error").isNull(), noted),
            "payload": F.when(F.col("error").isNotNull(), F.col("payload")),
        }
    )


def is_empty(name: str) -> Column:
    return F.coalesce(F.size(F.col(name)), F.lit(0)) < 1


def local_files(*, pdf: bool = True, pdfa: bool = True) -> Column:
    """The document and its companions, as far as their paths are known."""
    kinds = [("xml", "path")]
    kinds += [("pdf", "pdf_path")] if pdf else []
    kinds += [("pdf/a", "pdfa_path")] if pdfa else []
    entries = [
        F.when(
            F.col(column).isNotNull(),
            F.struct(
                F.lit(kind).alias("filetype"),
                F.regexp_replace(F.col(column), "^file://", "").alias("path"),
            ),
        )
        for kind, column in kinds
    ]
    return empty_to_null(F.array_compact(F.array(*entries)))


def strings(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values])
