"""Article metadata in the NLM / PubMed format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheaf.functions import arrays, ids, names, xml
from sheaf.parsers.common import is_empty, local_files, parse_documents, select_record

_AUTHOR = """STRUCT<
  LastName: ARRAY<STRING>, FirstName: ARRAY<STRING>, MiddleName: ARRAY<STRING>,
  Affiliation: ARRAY<STRING>,
  AffiliationInfo: ARRAY<STRUCT<Affiliation: ARRAY<STRING>>>>"""

FIELDS = f"""
  Journal: STRUCT<
    JournalTitle: ARRAY<STRING>, Volume: ARRAY<STRING>, Issue: ARRAY<STRING>,
    PubDate: ARRAY<STRUCT<_PubStatus: STRING, Year: STRING, Month: STRING, Day: STRING>>>,
  ArticleTitle: ARRAY<STRING>,
  FirstPage: ARRAY<STRING>, LastPage: ARRAY<STRING>,
  ELocationID: ARRAY<STRUCT<_EIdType: STRING, _VALUE: STRING>>,
  ArticleIdList: STRUCT<ArticleId: ARRAY<STRUCT<_IdType: STRING, _VALUE: STRING>>>,
  AuthorList: STRUCT<Author: ARRAY<{_AUTHOR}>>,
  PublicationType: ARRAY<STRING>,
  PublicationTypeList: STRUCT<PublicationType: ARRAY<STRING>>,
  Abstract: ARRAY<STRING>
"""


def _given_names(author: Column) -> Column:
    first_name, middle = arrays.first(author["FirstName"]), arrays.first(author["MiddleName"])
    return F.when(first_name.isNotNull(), F.concat_ws(" ", first_name, middle)).otherwise("")


def _authors() -> Column:
    none = F.array().cast("array<string>")

    def one(a: Column) -> Column:
        nested = arrays.flat_map(a["AffiliationInfo"], lambda i: i["Affiliation"])
        places = F.concat(F.coalesce(a["Affiliation"], none), F.coalesce(nested, none))
        return names.author(
            surname=arrays.first(a["LastName"], ""),
            given_names=_given_names(a),
            affiliations=F.transform(places, names.affiliation),
        )

    return F.transform(F.col("doc.AuthorList.Author"), one)


def collections(doctype: Column) -> Column:
    """Fixed collections, and one more for reviews and conference papers."""
    return F.array_compact(
        F.array(
            F.lit("HEP"),
            F.lit("Citeable"),
            F.lit("Published"),
            F.when(doctype == "Review", "Review"),
            F.when(F.contains(F.lower(doctype), F.lit("conference")), "ConferencePaper"),
        )
    )


def date_published(pub_date: Column) -> Column:
    """``Y[-M[-D]]`` from the parts that are given."""
    parts = [arrays.blank_to_null(pub_date[p]) for p in ("Year", "Month", "Day")]
    return F.concat_ws("-", *parts)


def parse(documents: DataFrame) -> DataFrame:
    root = xml.root_element(F.col("payload"), ("Article",))
    parsed = parse_documents(documents, FIELDS, root, ("ArticleTitle", "Abstract"))

    def of_type(entries: str, kind: str) -> Column:
        chosen = F.filter(F.col(entries), lambda e: e[kind] == "doi")
        return arrays.empty_to_null(arrays.map_values(chosen, lambda e: e["_VALUE"]))

    doctype = F.coalesce(
        arrays.first(F.col("doc.PublicationType")),
        arrays.first(F.col("doc.PublicationTypeList.PublicationType")),
    )
    pub_date = arrays.first(F.col("doc.Journal.PubDate"))
    first_page, last_page = (arrays.first(F.col(f"doc.{p}")) for p in ("FirstPage", "LastPage"))
    pages = ids.page_count(first_page, last_page)
    record = {
        "dois": F.coalesce(
            of_type("doc.ArticleIdList.ArticleId", "_IdType"), of_type("doc.ELocationID", "_EIdType")
        ),
        "authors": _authors(),
        "title": arrays.flat_map(F.col("doc.ArticleTitle"), xml.direct_text),
        "abstract": arrays.first(F.col("doc.Abstract")),
        "collections": collections(doctype),
        "date_published": date_published(pub_date),
        "journal_title": arrays.first(F.col("doc.Journal.JournalTitle")),
        "journal_volume": arrays.first(F.col("doc.Journal.Volume")),
        "journal_issue": arrays.first(F.col("doc.Journal.Issue")),
        "journal_doctype": doctype,
        "journal_fpage": first_page,
        "journal_lpage": last_page,
        "page_nr": F.when(pages.isNotNull(), F.array(pages)),
        "local_files": local_files(pdf=False, pdfa=False),
        "extra_data": F.when(
            pub_date["_PubStatus"].isNotNull(),
            F.create_map(F.lit("pub_status"), pub_date["_PubStatus"]),
        ),
    }
    warnings = {
        "no_doi": is_empty("dois"),
        "no_authors": is_empty("authors"),
        "bad_page_count": (F.col("journal_fpage") != "")
        & (F.col("journal_lpage") != "")
        & F.col("page_nr").isNull(),
    }
    return select_record(parsed, "NLM", record, warnings)
