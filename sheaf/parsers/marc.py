"""MARC21-XML records as two feeds write them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheaf import dims
from sheaf.functions import arrays, ids, licenses, names, text
from sheaf.functions.xml import direct_text
from sheaf.parsers.common import is_empty, parse_documents, select_record, strings

_FIELDS = """
  datafield: ARRAY<STRUCT<_tag: STRING, _ind1: STRING, _ind2: STRING,
    subfield: ARRAY<STRUCT<_code: STRING, _VALUE: STRING>>>>,
  controlfield: ARRAY<STRUCT<_tag: STRING, _VALUE: STRING>>
"""


def fields(tag: str) -> Column:
    """Data fields with the tag."""
    return F.expr(f"filter(doc.datafield, d -> d._tag = '{tag}')")


def subfields(field: Column, *codes: str) -> Column:
    """Values of a field's subfields, in order."""
    chosen = F.filter(field["subfield"], lambda s: s["_code"].isin(*codes) & (s["_VALUE"] != ""))
    return F.transform(chosen, lambda s: s["_VALUE"])


def subfield(field: Column, code: str) -> Column:
    return arrays.first(subfields(field, code))


def values(tag: str, code: str) -> Column:
    """Values of one subfield of all fields with the tag."""
    return F.expr(
        f"""flatten(transform(filter(doc.datafield, d -> d._tag = '{tag}'), d ->
              transform(filter(d.subfield, s -> s._code = '{code}' AND s._VALUE <> ''), s -> s._VALUE)))"""
    )


def value(tag: str, code: str) -> Column:
    return arrays.first(values(tag, code))


def _says(field: Column, code: str, word: str) -> Column:
    return F.exists(subfields(field, code), lambda v: F.contains(v, F.lit(word)))


def _authors(affiliations, orcid_mode: str) -> Column:
    """First author (100) and then all others (700)."""
    return F.transform(
        F.concat(fields("100"), fields("700")),
        lambda d: names.author(
            raw_name=subfield(d, "a"),
            orcid=ids.clean_orcid(subfield(d, "j"), orcid_mode),
            affiliations=F.transform(affiliations(d), names.affiliation),
        ),
    )


def _eprints(mode: str) -> Column:
    reports = F.filter(fields("037"), lambda d: _says(d, "9", "arXiv"))
    found = arrays.map_values(
        reports, lambda d: ids.clean_arxiv(subfield(d, "a"), mode), arrays.blank_to_null
    )
    return arrays.eprints(found)


def _common_fields() -> dict[str, Column]:
    pages = ids.page_range(value("773", "c"))
    statement = value("542", "f")
    return {
        "abstract": values("520", "a"),
        "title": arrays.flat_map(values("245", "a"), direct_text),
        "date_published": value("260", "c"),
        "page_nr": ids.all_ints(arrays.empty_to_null(values("300", "a"))),
        # The volume is read from 773 a although feeds keep it in v.
        "journal_volume": value("773", "a"),
        "journal_year": ids.to_int(value("773", "y")),
        "journal_issue": value("773", "n"),
        "journal_fpage": pages["fpage"],
        "journal_lpage": pages["lpage"],
        "copyright_statement": statement,
        "copyright_year": text.digits(statement),
        "license": licenses.get_license(value("540", "u"), value("540", "a")),
        "source": value("260", "b"),
        "control_number": arrays.first(
            F.transform(
                F.filter(F.col("doc.controlfield"), lambda c: c["_tag"] == "001"),
                lambda c: c["_VALUE"],
            )
        ),
        "_pages_given": F.size(values("300", "a")) > 0,
    }


def _warnings() -> dict[str, Column]:
    return {
        "no_doi": is_empty("dois"),
        "no_authors": is_empty("authors"),
        "no_arxiv": is_empty("arxiv_eprints"),
        "bad_page_count": F.col("_pages_given") & F.col("page_nr").isNull(),
    }


def _parse(documents: DataFrame) -> DataFrame:
    return parse_documents(documents, _FIELDS, F.col("payload"), mixed=("subfield",))


def parse_hindawi(documents: DataFrame) -> DataFrame:
    parsed = _parse(documents)
    dois = F.filter(fields("024"), lambda d: _says(d, "2", "DOI"))
    record = {
        **_common_fields(),
        "dois": arrays.flat_map(dois, lambda d: subfields(d, "a")),
        "authors": _authors(lambda d: subfields(d, "u"), "dashed"),
        "arxiv_eprints": _eprints("versioned"),
        "journal_title": value("773", "p"),
        "collections": strings("Advances in High Energy Physics"),
    }
    return select_record(parsed, "hindawi", record, _warnings()).drop("_pages_given")


def _repository_files(host: str) -> Column:
    """Full-text files, of which only those at the repository's host are kept."""
    kept = F.filter(fields("856"), lambda d: _says_in_first(d, "u", host))
    return arrays.empty_to_null(
        F.transform(
            kept,
            lambda d: F.struct(
                F.coalesce(subfield(d, "x"), ids.file_type(subfield(d, "u"))).alias("filetype"),
                subfield(d, "u").alias("path"),
            ),
        )
    )


def _says_in_first(field: Column, code: str, word: str) -> Column:
    return F.contains(subfield(field, code), F.lit(word))


def parse_repository(documents: DataFrame, *, repository_host: str) -> DataFrame:
    """Records of a repository whose own files are those at ``repository_host``."""
    parsed = _parse(documents)
    dois = F.filter(fields("024"), lambda d: (d["_ind1"] == "7") & _says(d, "2", "DOI"))
    abbreviation = value("773", "p")
    record = {
        **_common_fields(),
        "dois": arrays.flat_map(dois, lambda d: subfields(d, "a")),
        "authors": _authors(
            lambda d: F.array_union(subfields(d, "v"), subfields(d, "u")), "cut"
        ),
        "arxiv_eprints": _eprints("none"),
        "journal_title": dims.translate(abbreviation, dims.JOURNAL_FULL_NAMES, abbreviation),
        "local_files": _repository_files(repository_host),
    }
    return select_record(parsed, "repository", record, _warnings()).drop("_pages_given")
