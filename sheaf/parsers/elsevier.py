"""Elsevier articles, completed from the manifest of their package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sheaf import dims
from sheaf.functions import arrays, ids, licenses, names, xml
from sheaf.parsers.common import is_empty, parse_documents, select_record

_HEAD = """STRUCT<
  title: ARRAY<STRING>, subtitle: ARRAY<STRING>,
  abstract: ARRAY<STRUCT<`abstract-sec`: ARRAY<STRING>>>,
  `author-group`: ARRAY<STRUCT<
    collaboration: ARRAY<STRUCT<text: ARRAY<STRING>>>,
    author: ARRAY<STRUCT<
      `_author-id`: STRING, _orcid: STRING,
      `given-name`: ARRAY<STRING>, surname: ARRAY<STRING>,
      `e-address`: ARRAY<STRUCT<_type: STRING, _VALUE: STRING>>,
      `cross-ref`: ARRAY<STRUCT<_refid: STRING>>>>,
    affiliation: ARRAY<STRUCT<_id: STRING, textfn: ARRAY<STRING>, affiliation: ARRAY<STRING>>>>>>"""

FIELDS = f"""
  _docsubtype: STRING,
  `item-info`: STRUCT<
    doi: ARRAY<STRING>, aid: ARRAY<STRING>,
    copyright: ARRAY<STRUCT<_type: STRING, _year: STRING, _VALUE: STRING>>>,
  `related-article`: ARRAY<STRUCT<`_ext-link-type`: STRING, _href: STRING>>,
  head: {_HEAD},
  `simple-head`: {_HEAD}
"""

# The structured affiliation is kept raw: the order of its parts matters.
MIXED = ("title", "subtitle", "abstract-sec", "textfn", "sa:affiliation")
ROOTS = ("article", "simple-article")
_AFF_PART = (
    r"(?s)<(?:\w+:)?(?:organization|city|country|address-line)(?:\s[^>]*)?>\s*([^<]*?)\s*<"
)


def parse_articles(documents: DataFrame, extract_related: bool = False) -> DataFrame:
    """Everything the article itself tells; a missing DOI is an error."""
    nodes = documents.withColumn(
        "payload", F.explode_outer(xml.nodes(F.col("payload"), ROOTS))
    )
    trimmed = xml.drop_elements(F.col("payload"), ("body", "tail"))
    parsed = parse_documents(nodes, FIELDS, trimmed, MIXED).withColumn(
        "_head", F.coalesce(F.col("doc.head"), F.col("doc.`simple-head`"))
    )
    doi = arrays.first_nonempty(F.col("doc.`item-info`.doi"))
    related = F.filter(F.col("doc.`related-article`"), lambda r: r["_ext-link-type"] == "doi")
    copyright = arrays.first(F.col("doc.`item-info`.copyright"))
    record = {
        "doi": doi,
        "dois": F.col("doc.`item-info`.doi"),
        "journal_doctype": F.when(
            F.col("doc._docsubtype").isNotNull(),
            dims.translate(F.col("doc._docsubtype"), dims.ELSEVIER_DOCTYPES, "other"),
        ),
        "related_article_doi": F.when(
            F.lit(extract_related) & F.col("doc._docsubtype").isin("correction", "addendum", "add"),
            F.transform(related, lambda r: r["_href"]),
        ),
        "abstract": arrays.first(F.col("_head.abstract"))["abstract-sec"],
        "title": arrays.flat_map(F.col("_head.title"), xml.direct_text),
        "subtitle": arrays.flat_map(F.col("_head.subtitle"), xml.direct_text),
        "authors": _authors(),
        "collaborations": arrays.flat_map(
            F.col("_head.`author-group`"),
            lambda g: arrays.flat_map(g["collaboration"], lambda c: c["text"]),
        ),
        "journal_artid": arrays.first(F.col("doc.`item-info`.aid")),
        "copyright_holder": copyright["_VALUE"],
        "copyright_year": copyright["_year"],
        "copyright_statement": copyright["_VALUE"],
        "license": licenses.license_by_url(
            F.lit("http://creativecommons.org/licenses/by/3.0/")
        ),
    }
    warnings = {"no_authors": is_empty("authors"), "unmapped_doctype": F.col("journal_doctype") == "other"}
    return select_record(
        parsed, "Elsevier", record, warnings, F.when(doi.isNull(), "article has no DOI")
    )


# --- authors -----------------------------------------------------------------


def _plain(aff: Column) -> Column:
    return F.transform(F.slice(aff["textfn"], 1, 1), xml.plain_text)


def _referred_text(aff: Column) -> Column:
    """Text of an affiliation an author points to."""
    parts = F.regexp_extract_all(arrays.first(aff["affiliation"]), F.lit(_AFF_PART), F.lit(1))
    structured = F.array_join(
        F.transform(F.filter(parts, lambda p: p != ""), xml.unescape_xml), ", "
    )
    plain = F.regexp_replace(arrays.first(_plain(aff)), r"^(\d+ ?)", "")
    return F.when(F.size(aff["affiliation"]) > 0, structured).otherwise(plain)


def _authors() -> Column:
    """Authors with, in turn: the affiliations they refer to and those of the
    group without an id; failing both, all affiliations of the group."""
    groups = F.col("_head.`author-group`")
    everywhere = arrays.flat_map(groups, lambda g: g["affiliation"])

    def of_group(group: Column) -> Column:
        unmarked = arrays.flat_map(
            F.filter(group["affiliation"], lambda a: a["_id"].isNull()), _plain
        )
        every = arrays.flat_map(group["affiliation"], _plain)
        return F.transform(group["author"], lambda a: one(a, unmarked, every))

    def one(a: Column, unmarked: Column, every: Column) -> Column:
        none = F.array().cast("array<string>")
        refs = F.filter(
            F.transform(a["cross-ref"], lambda r: r["_refid"]),
            # Notes on correspondence or decease are no affiliations.
            lambda r: F.contains(r, F.lit("aff")),
        )
        referred = arrays.flat_map(
            refs,
            lambda r: F.transform(F.filter(everywhere, lambda k: k["_id"] == r), _referred_text),
        )
        direct = F.concat(
            F.coalesce(F.array_compact(referred), none), F.coalesce(unmarked, none)
        )
        chosen = F.when(F.size(direct) > 0, direct).otherwise(F.coalesce(every, none))
        return names.author(
            surname=arrays.first(a["surname"]),
            given_names=arrays.first(a["given-name"]),
            email=arrays.first(a["e-address"])["_VALUE"],
            orcid=ids.clean_orcid(a["_orcid"], "label"),
            affiliations=F.transform(chosen, names.affiliation),
        )

    return arrays.flat_map(groups, of_group)


# --- manifest ----------------------------------------------------------------


def complete(articles: DataFrame, listed: DataFrame) -> DataFrame:
    """Add journal, volume, pages, date and files from the manifest.

    ``listed`` is what :func:`sheaf.sources.manifest.listed_articles` gives.
    Articles the manifest does not list become errors, and so does, as a row
    of its own, what it lists and the package lacks.  Articles and listed rows
    come together by package and DOI in one step, so each is computed once.
    """
    own = articles.columns
    # Articles without a DOI match nothing; a key of their own keeps them from
    # meeting in one task.
    key = F.coalesce("doi", F.concat(F.lit("no DOI: "), "doc_id")).alias("_key")
    told = [c for c in listed.columns if c not in ("package_path", "doi")]
    both = articles.select("package_path", key, F.struct(*own).alias("_article")).unionByName(
        listed.select("package_path", F.col("doi").alias("_key"), F.struct(*told).alias("_listed")),
        allowMissingColumns=True,
    )
    of_doi = Window.partitionBy("package_path", "_key")
    is_article = F.col("_article").isNotNull()
    met = both.withColumn("_known", F.max("_listed").over(of_doi)).where(
        is_article | F.col("_listed.problem").isNotNull()
    )
    is_item = F.coalesce(F.col("_known.is_item"), F.lit(False)) & is_article
    rows = met.select(
        *(F.col(f"_article.{c}").alias(c) for c in own if c not in ("spider", "doc_id", "package_path", "error", "doi")),
        F.coalesce("_article.spider", F.lit("Elsevier")).alias("spider"),
        F.when(is_article, F.col("_article.doc_id")).otherwise(F.concat_ws("#", "package_path", "_key")).alias("doc_id"),
        "package_path",
        F.col("_article.error").alias("error"),
        F.col("_listed.problem").alias("_problem"),
        is_item.alias("_is_item"),
        *(F.when(is_item, F.col(f"_known.{c}")).alias(c) for c in told if c not in ("is_item", "problem")),
    )
    pages = ids.page_count(F.col("first_page"), F.col("last_page"))
    both_given = F.col("first_page").isNotNull() & F.col("last_page").isNotNull()
    date = F.substring("publication_date", 1, 10)
    unlisted = F.when(F.col("error").isNull() & ~F.col("_is_item"), "DOI not in manifest")
    return rows.withColumns(
        {
            "journal_title": F.col("journal"),
            "journal_volume": F.col("volume"),
            "journal_fpage": F.col("first_page"),
            "journal_lpage": F.col("last_page"),
            "page_nr": F.when(pages.isNotNull(), F.array(pages)),
            "date_published": date,
            "journal_year": ids.to_int(F.substring(date, 1, 4)),
            "collections": F.when(F.col("journal").isNotNull(), F.array("journal")),
            "local_files": F.when(F.col("_is_item"), _manifest_files()),
            "warnings": F.array_compact(
                F.concat("warnings", F.array(F.when(both_given & pages.isNull(), "bad_page_count")))
            ),
            "error": F.coalesce("_problem", unlisted, "error"),
        }
    ).select(
        *[c for c in own if c != "doi"],
        "journal_title", "journal_volume", "journal_fpage", "journal_lpage", "page_nr",
        "date_published", "journal_year", "collections", "local_files",
    )


def _manifest_files() -> Column:
    entries = [
        F.when(
            F.col(column).isNotNull(),
            F.struct(F.lit(kind).alias("filetype"), F.col(column).alias("path")),
        )
        for kind, column in (("xml", "xml_file"), ("pdf", "pdf_file"), ("pdfa", "pdfa_file"))
    ]
    return F.array_compact(F.array(*entries))


def parse(documents: DataFrame, manifest: DataFrame, extract_related: bool = False) -> DataFrame:
    return complete(parse_articles(documents, extract_related), manifest)
