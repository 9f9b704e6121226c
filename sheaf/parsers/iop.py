"""JATS as delivered by IOP."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sheaf import dims
from sheaf.functions import arrays, ids, licenses, text
from sheaf.parsers import jats
from sheaf.parsers.common import select_record, strings


def parse(
    documents: DataFrame, as_of=None, extract_related: bool = False, with_keywords: bool = False
) -> DataFrame:
    """A licence other than CC-BY sends the document to quarantine."""
    parsed = jats.parse_jats(documents)
    eprints = arrays.map_values(
        arrays.flat_map(
            jats.meta("custom-meta-group"),
            lambda g: arrays.flat_map(g["custom-meta"], lambda m: m["meta-value"]),
        ),
        lambda v: ids.clean_arxiv(v, "versioned"),
    )
    paragraphs = F.regexp_extract_all(
        F.concat_ws("", jats.meta("abstract")), F.lit(r"(?s)<p(?:\s[^>]*)?>(.*?)</p>"), F.lit(1)
    )
    urls = arrays.map_values(jats.meta("permissions/license"), lambda l: l["_href"])
    published = jats.published_date(as_of)
    record = {
        **jats.common_fields(extract_related, with_keywords),
        "journal_doctype": F.when(
            F.col("doc.`_article-type`").isNotNull(),
            dims.translate(F.col("doc.`_article-type`"), dims.JATS_DOCTYPES, "other"),
        ),
        "arxiv_eprints": arrays.eprints(eprints),
        "abstract": text.unwrap_cdata_instruction(F.array_join(paragraphs, "")),
        "date_published": published,
        "journal_year": ids.to_int(F.substring(published, 1, 4)),
        "license": arrays.map_values(urls, licenses.cc_by_license),
        "collections": strings("Chinese Physics C"),
    }
    unknown = F.filter(urls, lambda u: licenses.cc_by_license(u).isNull())
    error = F.when(
        F.size(unknown) > 0, F.concat(F.lit("unknown license: "), arrays.first(unknown))
    )
    return select_record(parsed, "IOP", record, jats.warnings(), error).drop("_pages_given")
