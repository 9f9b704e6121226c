"""JATS as delivered by OUP."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sheaf import dims
from sheaf.functions import arrays, ids, licenses
from sheaf.parsers import jats
from sheaf.parsers.common import select_record, strings


def parse(
    documents: DataFrame, as_of=None, extract_related: bool = False, with_keywords: bool = False
) -> DataFrame:
    parsed = jats.parse_jats(documents)
    eprints = arrays.map_values(
        jats.article_ids("arxiv"),
        lambda v: ids.clean_arxiv(v, "prefix"),
        arrays.blank_to_null,
    )
    links = arrays.flat_map(
        jats.meta("permissions/license"),
        lambda l: arrays.flat_map(l["license-p"], lambda p: p["ext-link"]),
    )
    record = {
        **jats.common_fields(extract_related, with_keywords),
        "journal_doctype": F.when(
            F.col("doc.`_article-type`").isNotNull(),
            dims.translate(F.col("doc.`_article-type`"), dims.JATS_DOCTYPES, "other"),
        ),
        "arxiv_eprints": arrays.eprints(eprints),
        "abstract": arrays.first(jats.meta("abstract")),
        "date_published": jats.published_date(as_of),
        # Volumes of this source are numbered by year.
        "journal_year": ids.to_int(arrays.first(jats.meta("volume"))),
        "license": licenses.get_license(arrays.first(links)["_VALUE"]),
        "collections": strings("Progress of Theoretical and Experimental Physics"),
    }
    warnings = {**jats.warnings(), "no_license": F.size("license") < 1}
    return select_record(parsed, "OUP", record, warnings).drop("_pages_given")
