"""Table schemas: raw documents, canonical records, quarantine, runs."""

from __future__ import annotations

from functools import cache

from pyspark.sql import types as T

RAW_DDL = """
  source STRING, doc_id STRING, package_path STRING, path STRING,
  payload STRING, harvested_at TIMESTAMP
"""

AFFILIATION_DDL = "STRUCT<value: STRING, organization: STRING, country: STRING>"

AUTHOR_DDL = f"""STRUCT<
  surname: STRING, given_names: STRING, full_name: STRING, raw_name: STRING,
  email: STRING, orcid: STRING, affiliations: ARRAY<{AFFILIATION_DDL}>>"""

# One record per article.  Every field is nullable; an absent field is NULL.
CANONICAL_DDL = f"""
  source STRING,
  authors ARRAY<{AUTHOR_DDL}>,
  abstract STRING,
  title STRING,
  subtitle STRING,
  collaborations ARRAY<STRUCT<value: STRING>>,
  collections ARRAY<STRUCT<primary: STRING>>,
  journal_title STRING,
  journal_year INT,
  journal_artid STRING,
  journal_fpage STRING,
  journal_lpage STRING,
  journal_volume STRING,
  journal_issue STRING,
  journal_doctype STRING,
  journal_issn ARRAY<STRING>,
  pubinfo_freetext STRING,
  preprint_date STRING,
  date_published STRING,
  language ARRAY<STRING>,
  dois ARRAY<STRUCT<value: STRING>>,
  related_article_doi ARRAY<STRUCT<value: STRING>>,
  copyright_holder STRING,
  copyright_year STRING,
  copyright_statement STRING,
  copyright_material STRING,
  free_keywords ARRAY<STRUCT<source: STRING, value: STRING>>,
  classification_numbers
    ARRAY<STRUCT<standard: STRING, classification_number: STRING>>,
  thesis_supervisor ARRAY<STRUCT<full_name: STRING, affiliation: STRING>>,
  thesis STRUCT<date: STRING, defense_date: STRING,
                institutions: ARRAY<STRING>, degree_type: STRING>,
  urls ARRAY<STRUCT<value: STRING>>,
  local_files ARRAY<STRUCT<value: STRUCT<filetype: STRING, path: STRING>>>,
  license ARRAY<STRUCT<license: STRING, url: STRING>>,
  license_url STRING,
  license_type STRING,
  arxiv_eprints ARRAY<STRUCT<value: STRING, categories: ARRAY<STRING>>>,
  field_categories
    ARRAY<STRUCT<term: STRING, scheme: STRING, source: STRING>>,
  page_nr ARRAY<INT>,
  record_creation_date TIMESTAMP,
  control_number STRING,
  references ARRAY<STRUCT<
    recid: STRING, texkey: STRING, doi: STRING, collaboration: ARRAY<STRING>,
    editors: ARRAY<STRING>, authors: ARRAY<STRING>, misc: ARRAY<STRING>,
    number: INT, isbn: STRING, publisher: ARRAY<STRING>, maintitle: STRING,
    report_number: ARRAY<STRING>, title: ARRAY<STRING>, url: ARRAY<STRING>,
    journal_pubnote: ARRAY<STRING>, raw_reference: ARRAY<STRING>, year: INT>>,
  files ARRAY<STRUCT<type: STRING, uri: STRING>>,
  file_urls ARRAY<STRING>,
  additional_files ARRAY<STRUCT<type: STRING, uri: STRING>>,
  extra_data MAP<STRING, STRING>,
  report_numbers ARRAY<STRING>,
  public_notes ARRAY<STRUCT<source: STRING, value: STRING>>,
  external_system_numbers ARRAY<STRUCT<institute: STRING, value: STRING>>
"""

# Kept beside the canonical fields: where the record came from and what the
# parser had to say about it.
LINEAGE_DDL = """
  spider STRING, doc_id STRING, package_path STRING, path STRING,
  harvested_at TIMESTAMP, warnings ARRAY<STRING>, error STRING, payload STRING
"""

# Accounts of runs, kept beside their log.
DOIS_DDL = "run_id STRING, batch_id BIGINT, spider STRING, doi STRING"
ERRORS_DDL = """
  run_id STRING, batch_id BIGINT, spider STRING, doc_id STRING, stage STRING, error STRING
"""
LANDED_DDL = "run_id STRING, batch_id BIGINT, source STRING, path STRING"

RUN_DDL = """
  run_id STRING, batch_id BIGINT, source STRING, results_uri STRING,
  window_from STRING, window_until STRING,
  n_records BIGINT, n_errors BIGINT, n_missing_doi BIGINT,
  started_at TIMESTAMP, finished_at TIMESTAMP, status STRING
"""


@cache
def schema(ddl: str) -> T.StructType:
    """A schema as a type; reading DDL needs a running session."""
    return T.StructType.fromDDL(" ".join(ddl.split()))


def canonical_schema() -> T.StructType:
    return schema(CANONICAL_DDL)


def lineage_schema() -> T.StructType:
    return schema(LINEAGE_DDL)
