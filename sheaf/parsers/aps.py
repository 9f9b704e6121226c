"""JSON pages of an article API: ``{"data": [article, ...]}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheaf import dims
from sheaf.functions import arrays, ids, licenses, names
from sheaf.parsers.common import computed_once, is_empty, select_record, strings, with_lineage

# Articles stay text at first, so that one bad value costs one article and not its page.
PAGE_SCHEMA = "data ARRAY<STRING>, _corrupt_record STRING"

ARTICLE_SCHEMA = """
  articleType STRING, date STRING, numPages STRING,
  identifiers STRUCT<doi: STRING, arxiv: STRING>,
  abstract STRUCT<value: STRING, format: STRING>,
  title STRUCT<value: STRING, format: STRING>,
  authors ARRAY<STRUCT<type: STRING, name: STRING, firstname: STRING,
                       surname: STRING, affiliationIds: ARRAY<STRING>>>,
  affiliations ARRAY<STRUCT<id: STRING, name: STRING>>,
  journal STRUCT<id: STRING, name: STRING, abbreviatedName: STRING>,
  issue STRUCT<number: STRING>, volume STRUCT<number: STRING>,
  classificationSchemes STRUCT<subjectAreas: ARRAY<STRUCT<id: STRING, label: STRING>>>,
  rights STRUCT<copyrightYear: STRING, copyrightHolders: ARRAY<STRUCT<name: STRING>>,
                rightsStatement: STRING, licenses: ARRAY<STRUCT<url: STRING>>>,
  _corrupt_record STRING
"""
_CORRUPT = {"columnNameOfCorruptRecord": "_corrupt_record"}


def pages_to_articles(documents: DataFrame) -> DataFrame:
    """One row per article of each page; a bad page stays one row, a bad article too."""
    page = F.from_json("payload", PAGE_SCHEMA, _CORRUPT)
    parsed = computed_once(with_lineage(documents), "_page", page)
    malformed = F.when(
        F.col("_page").isNull() | F.col("_page._corrupt_record").isNotNull(), "malformed JSON"
    ).when(F.col("_page.data").isNull(), "no data in page")
    # Only a malformed page is carried past the explode.
    listed = (
        parsed.withColumn("_malformed", malformed)
        .withColumn("payload", F.when(F.col("_malformed").isNotNull(), F.col("payload")))
        .select("*", F.posexplode_outer("_page.data").alias("_pos", "_article"))
        .where(F.col("_article").isNotNull() | F.col("_malformed").isNotNull())
        .drop("_page")
    )
    article = F.from_json("_article", " ".join(ARTICLE_SCHEMA.split()), _CORRUPT)
    read = computed_once(listed, "doc", article)
    bad = F.col("_article").isNotNull() & (
        F.col("doc").isNull() | F.col("doc._corrupt_record").isNotNull()
    )
    return read.withColumns(
        {
            "_malformed": F.coalesce("_malformed", F.when(bad, "malformed article")),
            "payload": F.coalesce("payload", "_article"),
        }
    ).drop("_article")


def _spaced(c: Column) -> Column:
    """Thin spaces become ordinary ones; a missing name part is empty."""
    return F.coalesce(F.translate(c, "\u2009", " "), F.lit(""))


def _authors() -> Column:
    known = F.coalesce(F.col("doc.affiliations"), F.array().cast("array<struct<id:string,name:string>>"))

    def affiliation(ref: Column) -> Column:
        # The last entry of an id counts; unknown ids are dropped.
        last = F.try_element_at(F.filter(known, lambda a: a["id"] == ref), F.lit(-1))
        return arrays.let(last, lambda hit: F.when(hit.isNotNull(), names.affiliation(hit["name"])))

    return F.transform(
        F.filter(F.col("doc.authors"), lambda a: a["type"] == "Person"),
        lambda a: names.author(
            surname=_spaced(a["surname"]),
            given_names=_spaced(a["firstname"]),
            raw_name=_spaced(a["name"]),
            affiliations=F.coalesce(
                arrays.map_values(F.array_distinct(a["affiliationIds"]), affiliation),
                F.array().cast("array<struct<value:string,organization:string,country:string>>"),
            ),
        ),
    )


def parse(documents: DataFrame) -> DataFrame:
    articles = pages_to_articles(documents)
    eprint = arrays.blank_to_null(ids.clean_arxiv(F.col("doc.identifiers.arxiv"), "prefix"))
    license_url = arrays.first(F.col("doc.rights.licenses"))["url"]
    record = {
        "dois": F.array_compact(F.array(arrays.blank_to_null(F.col("doc.identifiers.doi")))),
        "journal_doctype": dims.translate(F.col("doc.articleType"), dims.APS_DOCTYPES, "other"),
        "page_nr": arrays.empty_to_null(
            F.array_compact(F.array(F.col("doc.numPages").try_cast("int")))
        ),
        "arxiv_eprints": arrays.eprints(F.array_compact(F.array(eprint))),
        "abstract": F.col("doc.abstract.value"),
        "title": F.col("doc.title.value"),
        "authors": _authors(),
        "collaborations": F.transform(
            F.filter(F.col("doc.authors"), lambda a: a["type"] == "Collaboration"),
            lambda a: a["name"],
        ),
        "journal_title": F.col("doc.journal.name"),
        "journal_issue": F.col("doc.issue.number"),
        "journal_volume": F.col("doc.volume.number"),
        "journal_year": ids.to_int(F.substring("doc.date", 1, 4)),
        "date_published": F.col("doc.date"),
        "field_categories": F.transform(
            F.coalesce(
                F.col("doc.classificationSchemes.subjectAreas"),
                F.array().cast("array<struct<id:string,label:string>>"),
            ),
            lambda s: F.struct(
                s["label"].alias("term"), F.lit("APS").alias("scheme"), F.lit("").alias("source")
            ),
        ),
        "copyright_holder": arrays.first(F.col("doc.rights.copyrightHolders"))["name"],
        "copyright_year": F.col("doc.rights.copyrightYear"),
        "copyright_statement": F.col("doc.rights.rightsStatement"),
        "license": licenses.get_license(license_url),
        "collections": strings("HEP", "Citeable", "Published"),
    }
    warnings = {
        "no_doi": is_empty("dois"),
        "no_authors": is_empty("authors"),
        "no_arxiv": is_empty("arxiv_eprints"),
        "unmapped_doctype": F.col("journal_doctype") == "other",
        "no_license": is_empty("license"),
    }
    return select_record(articles, "APS", record, warnings)
