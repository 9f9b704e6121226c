"""Front matter in JATS, shared by the sources that deliver it."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from sheaf.functions import arrays, dates, ids, names, text, xml
from sheaf.parsers.common import is_empty, local_files, parse_documents, with_lineage
from sheaf.sources.landing import split_articles

_DATE = "day: ARRAY<STRING>, month: ARRAY<STRING>, year: ARRAY<STRING>"
_AFF = "ARRAY<STRUCT<_id: STRING, _VALUE: STRING>>"
_JOURNAL_TITLES = """
  `journal-title`: ARRAY<STRING>,
  `abbrev-journal-title`: ARRAY<STRUCT<`_abbrev-type`: STRING, _VALUE: STRING>>
"""

FIELDS = f"""
  `_article-type`: STRING,
  front: STRUCT<
    `journal-meta`: STRUCT<`journal-title-group`: STRUCT<{_JOURNAL_TITLES}>, {_JOURNAL_TITLES}>,
    `article-meta`: STRUCT<
      `article-id`: ARRAY<STRUCT<`_pub-id-type`: STRING, _VALUE: STRING>>,
      `title-group`: STRUCT<`article-title`: ARRAY<STRING>, subtitle: ARRAY<STRING>>,
      `contrib-group`: ARRAY<STRUCT<
        contrib: ARRAY<STRUCT<
          `_contrib-type`: STRING,
          name: ARRAY<STRUCT<surname: ARRAY<STRING>, `given-names`: ARRAY<STRING>>>,
          email: ARRAY<STRING>, collab: ARRAY<STRING>, aff: {_AFF},
          xref: ARRAY<STRUCT<`_ref-type`: STRING, _rid: STRING, _VALUE: STRING>>>>,
        aff: {_AFF}>>,
      aff: {_AFF},
      `pub-date`: ARRAY<STRUCT<`_pub-type`: STRING, `_date-type`: STRING, {_DATE}>>,
      history: STRUCT<date: ARRAY<STRUCT<`_date-type`: STRING, {_DATE}>>>,
      volume: ARRAY<STRING>, issue: ARRAY<STRING>, `elocation-id`: ARRAY<STRING>,
      counts: STRUCT<`page-count`: ARRAY<STRUCT<_count: STRING>>>,
      permissions: STRUCT<
        `copyright-statement`: ARRAY<STRING>, `copyright-year`: ARRAY<STRING>,
        `copyright-holder`: ARRAY<STRING>,
        license: ARRAY<STRUCT<
          _href: STRING,
          `license-p`: ARRAY<STRUCT<`ext-link`: ARRAY<STRUCT<_href: STRING, _VALUE: STRING>>>>>>>,
      abstract: ARRAY<STRING>,
      `kwd-group`: ARRAY<STRUCT<`_kwd-group-type`: STRING, kwd: ARRAY<STRING>>>,
      `related-article`: ARRAY<STRUCT<`_ext-link-type`: STRING, _href: STRING>>,
      `custom-meta-group`: ARRAY<STRUCT<
        `custom-meta`: ARRAY<STRUCT<`meta-name`: STRING, `meta-value`: ARRAY<STRING>>>>>>>
"""

MIXED = ("article-title", "subtitle", "abstract", "aff", "kwd", "collab", "copyright-statement")
ROOTS = ("article", "simple-article")


def parse_jats(documents: DataFrame) -> DataFrame:
    """Parse the front matter of every article; bodies and references are cut before parsing."""
    articles = split_articles(with_lineage(documents), ROOTS)
    node = _flat(xml.drop_elements(F.col("payload"), ("body", "back")))
    is_article = F.rlike(F.col("payload"), F.lit(rf"^<(?:{'|'.join(ROOTS)})[\s>]"))
    return parse_documents(articles, FIELDS, F.when(is_article, node), MIXED)


def _flat(node: Column) -> Column:
    """Contributors and affiliations at any depth brought to the depth that is parsed.

    The members of a collaboration, and of those in it, follow it as
    contributors of their own, and alternatives of an affiliation stand in the
    place of their wrapper.
    """
    members = arrays.let(
        node,
        lambda c: F.when(F.contains(c, F.lit("<collab")), xml.siblings(c, "contrib", "contrib-group")).otherwise(c),
    )
    return F.regexp_replace(members, r"</?aff-alternatives(?:\s[^>]*)?>", "")


def meta(path: str = "") -> Column:
    steps = "".join(f".`{step}`" for step in path.split("/") if step)
    return F.col(f"doc.front.`article-meta`{steps}")


def _or_empty(arr: Column, like: str) -> Column:
    return F.coalesce(arr, F.array().cast(like))


# --- authors -----------------------------------------------------------------

_AFF_TYPE = "array<struct<_id:string,_VALUE:string>>"


def contributors() -> Column:
    return arrays.flat_map(meta("contrib-group"), lambda g: g["contrib"])


def affiliations_with_id() -> Column:
    """All affiliations that may be referred to, wherever they stand."""
    in_groups = arrays.flat_map(meta("contrib-group"), lambda g: g["aff"])
    # Those in a contributor or in the text of a collaboration count as well.
    in_authors = arrays.flat_map(contributors(), lambda c: F.filter(c["aff"], lambda a: a["_id"].isNotNull()))
    in_names = arrays.flat_map(contributors(), lambda c: arrays.flat_map(c["collab"], _inner_affiliations))
    parts = (in_groups, meta("aff"), in_authors, in_names)
    return F.concat(*(_or_empty(part, _AFF_TYPE) for part in parts))


def _inner_affiliations(raw: Column) -> Column:
    def one(node: Column) -> Column:
        head = F.substring_index(node, ">", 1)
        value = F.substr(node, F.length(head) + 2)
        return F.struct(
            F.nullif(F.regexp_extract(head, r"""\sid\s*=\s*["']([^"']*)""", 1), F.lit("")).alias("_id"),
            F.left(value, F.length(value) - F.lit(len("</aff>"))).alias("_VALUE"),
        )

    found = F.transform(xml.nodes(raw, ["aff"]), one)
    return F.when(F.contains(raw, F.lit("<aff")), found).otherwise(F.array().cast(_AFF_TYPE))


def affiliation_text(c: Column) -> Column:
    """Text of an affiliation without its label."""
    return text.clean_whitespace(xml.plain_text(text.remove_tags_with_content(c, ["label"])))


def authors() -> Column:
    """Authors with inline affiliations first and then those they refer to."""

    def affiliations(contrib: Column, known: Column) -> Column:
        refs = F.filter(contrib["xref"], lambda x: x["_ref-type"] == "aff")
        referred = arrays.flat_map(
            refs, lambda x: F.filter(known, lambda a: a["_id"] == x["_rid"])
        )
        both = F.concat(
            _or_empty(contrib["aff"], _AFF_TYPE), _or_empty(referred, _AFF_TYPE)
        )
        texts = F.filter(
            F.transform(both, lambda a: affiliation_text(a["_VALUE"])), lambda v: v != ""
        )
        return F.transform(texts, names.affiliation)

    def one(contrib: Column, known: Column) -> Column:
        name = arrays.first(contrib["name"])
        return names.author(
            surname=F.coalesce(arrays.first(name["surname"]), F.lit("")),
            given_names=F.coalesce(arrays.first(name["given-names"]), F.lit("")),
            email=arrays.first_nonempty(contrib["email"]),
            affiliations=affiliations(contrib, known),
        )

    given = F.filter(contributors(), lambda c: c["_contrib-type"] == "author")
    # What may be referred to is listed once, not for each reference.
    return arrays.let(affiliations_with_id(), lambda known: F.transform(given, lambda c: one(c, known)))


def collaborations() -> Column:
    return arrays.flat_map(
        contributors(),
        lambda c: arrays.flat_map(c["collab"], xml.direct_text),
    )


# --- dates -------------------------------------------------------------------


def _date_of(nodes: Column) -> Column:
    """Date of the first given year, month and day; a missing part is 1.

    Missing altogether without any node.
    """

    def part(given: Column, name: str) -> Column:
        found = arrays.first(arrays.flat_map(given, lambda d: d[name]))
        return arrays.let(found, lambda f: F.when(f.isNull(), 1).otherwise(ids.to_int(f)))

    def date(given: Column) -> Column:
        parts = (part(given, name) for name in ("year", "month", "day"))
        return F.when(F.size(given) > 0, dates.calendar_date(*parts))

    return arrays.let(nodes, date)


def published_date(as_of: datetime.date | str | None = None) -> Column:
    """Date by priority: published, electronic, print, any, ``as_of``."""
    pub_dates = meta("pub-date")
    candidates = [
        F.filter(meta("history/date"), lambda d: d["_date-type"] == "published"),
        F.filter(pub_dates, lambda d: d["_pub-type"] == "epub"),
        F.filter(pub_dates, lambda d: d["_pub-type"] == "ppub"),
        pub_dates,
    ]
    fallback = F.lit(None if as_of is None else str(as_of)).cast("date")
    date = F.coalesce(*[_date_of(c) for c in candidates], fallback)
    return F.date_format(date, "yyyy-MM-dd")


# --- the rest ----------------------------------------------------------------


def keywords() -> tuple[Column, Column]:
    """Free keywords and PACS numbers."""

    def of(groups: Column) -> Column:
        return arrays.flat_map(groups, lambda g: g["kwd"])

    def is_pacs(group: Column) -> Column:
        return F.coalesce(group["_kwd-group-type"] == "pacs", F.lit(False))

    groups = meta("kwd-group")
    return of(F.filter(groups, lambda g: ~is_pacs(g))), of(F.filter(groups, is_pacs))


def article_ids(kind: str) -> Column:
    chosen = F.filter(meta("article-id"), lambda i: i["_pub-id-type"] == kind)
    return arrays.map_values(chosen, lambda i: i["_VALUE"], arrays.blank_to_null)


def journal_title() -> Column:
    title, short = "journal-title", "abbrev-journal-title"
    home = "doc.front.`journal-meta`"
    group = f"{home}.`journal-title-group`"
    return F.coalesce(
        arrays.first_nonempty(F.col(f"{group}.`{title}`")),
        arrays.first_nonempty(F.col(f"{home}.`{title}`")),
        arrays.first(F.col(f"{group}.`{short}`"))["_VALUE"],
        arrays.first(F.col(f"{home}.`{short}`"))["_VALUE"],
    )


def related_dois(enabled: bool) -> Column:
    """DOI of the article a correction or addendum is about."""
    related = F.filter(meta("related-article"), lambda r: r["_ext-link-type"] == "doi")
    found = arrays.map_values(related, lambda r: r["_href"])
    wanted = F.col("doc.`_article-type`").isin("correction", "addendum")
    return F.when(F.lit(enabled) & wanted, found)


def common_fields(extract_related: bool, with_keywords: bool) -> dict[str, Column]:
    free, pacs = keywords()
    pages = F.transform(meta("counts/page-count"), lambda p: p["_count"])
    words = {"free_keywords": free, "classification_numbers": pacs} if with_keywords else {}
    return {
        **words,
        "dois": article_ids("doi"),
        "related_article_doi": related_dois(extract_related),
        "page_nr": ids.all_ints(arrays.empty_to_null(pages)),
        "title": arrays.flat_map(meta("title-group/article-title"), xml.direct_text),
        "subtitle": arrays.flat_map(meta("title-group/subtitle"), xml.direct_text),
        "authors": authors(),
        "collaborations": collaborations(),
        "journal_title": journal_title(),
        "journal_issue": meta("issue"),
        "journal_volume": meta("volume"),
        "journal_artid": meta("elocation-id"),
        "copyright_holder": meta("permissions/copyright-holder"),
        "copyright_year": meta("permissions/copyright-year"),
        "copyright_statement": F.transform(
            meta("permissions/copyright-statement"), xml.plain_text
        ),
        "local_files": local_files(),
        "_pages_given": F.size(pages) > 0,
    }


def warnings() -> dict[str, Column]:
    return {
        "no_doi": is_empty("dois"),
        "no_authors": is_empty("authors"),
        "no_arxiv": is_empty("arxiv_eprints"),
        "unmapped_doctype": F.col("journal_doctype") == "other",
        "bad_page_count": F.col("_pages_given") & F.col("page_nr").isNull(),
    }
