"""Springer A++ articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheaf import dims
from sheaf.functions import arrays, dates, ids, licenses, names, text, xml
from sheaf.parsers.common import is_empty, local_files, parse_documents, select_record

_ORG = """
  OrgDivision: ARRAY<STRING>, OrgName: ARRAY<STRING>,
  OrgAddress: STRUCT<Street: ARRAY<STRING>, City: ARRAY<STRING>, State: ARRAY<STRING>,
                     Postcode: ARRAY<STRING>, Country: ARRAY<STRUCT<_Code: STRING, _VALUE: STRING>>>
"""
_DATE = "Year: STRING, Month: STRING, Day: STRING"
_LICENSE = "License: ARRAY<STRUCT<_SubType: STRING, _Version: STRING>>"

_ARTICLE = f"""
  Article: STRUCT<
    _ID: STRING,
    ArticleInfo: STRUCT<
      _ArticleType: STRING,
      ArticleDOI: ARRAY<STRING>,
      ArticleExternalID: ARRAY<STRUCT<_Type: STRING, _VALUE: STRING>>,
      ArticleTitle: ARRAY<STRING>,
      ArticleFirstPage: ARRAY<STRING>, ArticleLastPage: ARRAY<STRING>,
      ArticleHistory: STRUCT<OnlineDate: ARRAY<STRUCT<{_DATE}>>>,
      ArticleCopyright: STRUCT<
        CopyrightHolderName: ARRAY<STRING>, CopyrightYear: ARRAY<STRING>,
        `copyright-statement`: ARRAY<STRING>, {_LICENSE}>,
      {_LICENSE}>,
    ArticleHeader: STRUCT<
      AuthorGroup: STRUCT<
        Author: ARRAY<STRUCT<
          _AffiliationIDS: STRING, _ORCID: STRING,
          AuthorName: STRUCT<GivenName: ARRAY<STRING>, FamilyName: ARRAY<STRING>>,
          Contact: STRUCT<Email: ARRAY<STRING>>>>,
        InstitutionalAuthor: ARRAY<STRUCT<InstitutionalAuthorName: ARRAY<STRING>>>,
        Affiliation: ARRAY<STRUCT<_ID: STRING, {_ORG}>>>,
      Abstract: ARRAY<STRUCT<Para: ARRAY<STRING>>>>>
"""

FIELDS = f"""
  Journal: STRUCT<
    JournalInfo: STRUCT<JournalTitle: ARRAY<STRING>>,
    Volume: STRUCT<
      VolumeInfo: STRUCT<VolumeIDStart: ARRAY<STRING>>,
      Issue: STRUCT<IssueInfo: STRUCT<IssueIDStart: ARRAY<STRING>>, {_ARTICLE}>>>
"""

MIXED = ("ArticleTitle", "Para")
_ISSUE = "doc.Journal.Volume.Issue"
_HEADER = f"{_ISSUE}.Article.ArticleHeader"


def _info(path: str) -> Column:
    return F.col(f"{_ISSUE}.Article.ArticleInfo.{path}")


def format_affiliation(aff: Column) -> Column:
    """One line from the parts that are there, with organisation and country."""
    address = aff["OrgAddress"]
    organization = arrays.first(aff["OrgName"])
    country = arrays.first(address["Country"])["_VALUE"]
    parts = [
        arrays.first(aff["OrgDivision"]),
        organization,
        arrays.first(address["Street"]),
        arrays.first(address["City"]),
        arrays.first(address["State"]),
        arrays.first(address["Postcode"]),
        country,
    ]
    line = F.concat_ws(", ", *[arrays.blank_to_null(p) for p in parts])
    return names.full_affiliation(line, organization, country)


def _authors() -> Column:
    group = f"{_HEADER}.AuthorGroup"
    known = F.col(f"{group}.Affiliation")
    none = F.array().cast("array<struct<value:string,organization:string,country:string>>")

    def one(a: Column) -> Column:
        refs = F.filter(F.split(a["_AffiliationIDS"], r"\s+"), lambda r: r != "")
        found = arrays.flat_map(
            refs,
            lambda r: F.transform(
                F.slice(F.filter(known, lambda k: k["_ID"] == r), 1, 1), format_affiliation
            ),
        )
        return names.author(
            surname=arrays.first(a["AuthorName"]["FamilyName"], ""),
            given_names=arrays.first(a["AuthorName"]["GivenName"], ""),
            email=arrays.first_nonempty(a["Contact"]["Email"]),
            affiliations=F.coalesce(F.array_distinct(found), none),
        )

    return F.transform(F.col(f"{group}.Author"), one)


def _license() -> Column:
    """Licence named by type and version; CC-BY-3.0 when there is none."""
    home = F.concat(
        *[
            F.coalesce(_info(path), F.array().cast("array<struct<_SubType:string,_Version:string>>"))
            for path in ("License", "ArticleCopyright.License")
        ]
    )
    typed = arrays.first(F.filter(home, lambda l: l["_SubType"].isNotNull()))
    version = arrays.first(F.filter(home, lambda l: l["_Version"].isNotNull()))["_Version"]
    kind = F.replace(
        F.regexp_replace(F.lower(typed["_SubType"]), "^cc[ -]", ""), F.lit(" "), F.lit("-")
    )
    # The double slash is part of the URL that consumers know.
    named = licenses.license_entry(
        F.concat(F.lit("CC-"), F.upper(kind), F.lit("-"), version),
        F.concat(F.lit("https://creativecommons.org/licenses//"), kind, F.lit("/"), version),
    )
    default = licenses.license_entry(
        F.lit("CC-BY-3.0"), F.lit("https://creativecommons.org/licenses/by/3.0")
    )
    return F.array(F.when(kind.isNotNull() & version.isNotNull(), named).otherwise(default))


def parse(documents: DataFrame) -> DataFrame:
    root = xml.root_element(F.col("payload"), ("Publisher",))
    parsed = parse_documents(documents, FIELDS, xml.drop_elements(root, ("Body", "BodyRef", "ArticleBackmatter")), MIXED)

    first_pages, last_pages = _info("ArticleFirstPage"), _info("ArticleLastPage")
    counts = F.transform(
        F.arrays_zip(first_pages.alias("f"), last_pages.alias("l")),
        lambda p: ids.page_count(p["f"], p["l"]),
    )
    counted = (F.size(first_pages) > 0) & (F.size(last_pages) > 0)
    online = arrays.first(_info("ArticleHistory.OnlineDate"))
    date = dates.calendar_date(
        ids.to_int(online["Year"]), ids.to_int(online["Month"]), ids.to_int(online["Day"])
    )
    journal = text.strip_leading_article(
        arrays.first(F.col("doc.Journal.JournalInfo.JournalTitle"))
    )
    eprints = F.filter(_info("ArticleExternalID"), lambda e: e["_Type"] == "arXiv")
    record = {
        "dois": _info("ArticleDOI"),
        "journal_doctype": F.when(
            _info("_ArticleType").isNotNull(),
            dims.translate(_info("_ArticleType"), dims.SPRINGER_DOCTYPES, "other"),
        ),
        "arxiv_eprints": arrays.eprints(
            arrays.map_values(eprints, lambda e: ids.clean_arxiv(e["_VALUE"], "none"))
        ),
        "page_nr": F.when(counted & F.forall(counts, lambda n: n.isNotNull()), counts),
        "abstract": arrays.flat_map(F.col(f"{_HEADER}.Abstract"), lambda a: a["Para"]),
        "title": F.transform(F.slice(_info("ArticleTitle"), 1, 1), text.drop_math),
        "authors": _authors(),
        "collaborations": arrays.flat_map(
            F.col(f"{_HEADER}.AuthorGroup.InstitutionalAuthor"),
            lambda a: a["InstitutionalAuthorName"],
        ),
        "journal_title": journal,
        "journal_issue": F.col(f"{_ISSUE}.IssueInfo.IssueIDStart"),
        "journal_volume": F.col("doc.Journal.Volume.VolumeInfo.VolumeIDStart"),
        "journal_artid": F.col(f"{_ISSUE}.Article._ID"),
        "journal_fpage": first_pages,
        "journal_lpage": last_pages,
        "journal_year": F.year(date),
        "date_published": F.date_format(date, "yyyy-MM-dd"),
        "copyright_holder": _info("ArticleCopyright.CopyrightHolderName"),
        "copyright_year": _info("ArticleCopyright.CopyrightYear"),
        "copyright_statement": _info("ArticleCopyright.`copyright-statement`"),
        "license": _license(),
        "collections": F.array_compact(F.array(journal)),
        "local_files": local_files(pdf=False),
        "_pages_given": counted,
    }
    warnings = {
        "no_doi": is_empty("dois"),
        "no_authors": is_empty("authors"),
        "no_arxiv": is_empty("arxiv_eprints"),
        "bad_page_count": F.coalesce(F.col("_pages_given"), F.lit(False)) & F.col("page_nr").isNull(),
        "no_date": F.col("date_published").isNull(),
    }
    return select_record(parsed, "Springer", record, warnings).drop("_pages_given")
