"""Canonical records to the nested form that consumers take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheaf.functions import arrays, dates

PUBLICATION_FIELDS = (
    "journal_title", "journal_volume", "journal_year", "journal_issue", "journal_fpage",
    "journal_lpage", "journal_doctype", "journal_artid", "pubinfo_freetext",
)
_FOLDED = (
    "related_article_doi", "source", "title", "subtitle", "abstract", "date_published",
    "copyright_holder", "copyright_year", "copyright_statement", "copyright_material",
    *PUBLICATION_FIELDS,
)


def has_publication_info() -> Column:
    """Whether any field about the publication has a value."""
    texts = [
        arrays.blank_to_null(F.col(name)).isNotNull()
        for name in PUBLICATION_FIELDS
        if name != "journal_year"
    ]
    found = F.coalesce(F.col("journal_year") != 0, F.lit(False))
    for text in texts:
        found = found | text
    return found


def filter_fields(records: DataFrame, keys) -> DataFrame:
    return records.drop(*keys)


def _or_blank(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def restructure(records: DataFrame, now: Column | str, submission_number: str = "") -> DataFrame:
    """Export records.  ``now`` is the time of the export, as ISO text."""
    now = now if isinstance(now, Column) else F.lit(now)
    source = F.coalesce(arrays.blank_to_null(F.col("source")), F.col("spider"))
    publication_date = F.coalesce(dates.pad_iso_date(F.col("date_published")), _or_blank("date_published"))
    none = F.array().cast("array<struct<value:string>>")
    nested = {
        "dois": arrays.empty_to_null(
            F.concat(F.coalesce("dois", none), F.coalesce("related_article_doi", none))
        ),
        "acquisition_source": F.struct(
            source.alias("source"),
            source.alias("method"),
            now.alias("date"),
            F.lit(submission_number).alias("submission_number"),
        ),
        "record_creation_date": F.coalesce(
            F.date_format("record_creation_date", "yyyy-MM-dd'T'HH:mm:ss"), now
        ),
        "titles": F.array(
            F.struct(
                _or_blank("title").alias("title"),
                _or_blank("subtitle").alias("subtitle"),
                source.alias("source"),
            )
        ),
        "abstracts": F.array(F.struct(_or_blank("abstract").alias("value"), source.alias("source"))),
        "imprints": F.array(
            F.struct(publication_date.alias("date"), source.alias("publisher"))
        ),
        "copyright": F.array(
            F.struct(
                *[
                    _or_blank(f"copyright_{part}").alias(part)
                    for part in ("holder", "year", "statement", "material")
                ]
            )
        ),
        "publication_info": F.when(
            has_publication_info(),
            F.array(
                F.struct(
                    _or_blank("journal_title").alias("journal_title"),
                    _or_blank("journal_volume").alias("journal_volume"),
                    F.nullif(F.col("journal_year"), F.lit(0)).alias("year"),
                    _or_blank("journal_issue").alias("journal_issue"),
                    _or_blank("journal_artid").alias("artid"),
                    _or_blank("journal_fpage").alias("page_start"),
                    _or_blank("journal_lpage").alias("page_end"),
                    _or_blank("journal_doctype").alias("material"),
                    _or_blank("pubinfo_freetext").alias("pubinfo_freetext"),
                )
            ),
        ),
    }
    return filter_fields(records.withColumns(nested), _FOLDED)
