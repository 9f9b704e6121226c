"""Per-field processing: raw fields of any parser to the canonical schema.

A rule says what happens to each value of a field and how its values are
reduced.  ``normalise`` applies all rules in one projection.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sheaf.functions import arrays, dates, names, text, urls
from sheaf.schema import canonical_schema, lineage_schema

Step = Callable[[Column], Column]


@dataclass(frozen=True)
class FieldRule:
    """``steps`` run on each value; ``reduce`` turns the list into the field."""

    steps: tuple[Step, ...] = ()
    reduce: Step | None = None
    scalar: Step | None = None

    def apply(self, column: Column, is_array: bool) -> Column:
        if not is_array and self.scalar is not None:
            for step in self.steps:
                column = step(column)
            return self.scalar(column)
        if not is_array:
            column = F.when(column.isNotNull(), F.array(column))
        values = arrays.map_values(column, *self.steps) if self.steps else column
        return self.reduce(values) if self.reduce else values


def take_first(*steps: Step) -> FieldRule:
    return FieldRule(steps, arrays.first_nonempty, arrays.blank_to_null)


def keep_all(*steps: Step, into: Step | None = None) -> FieldRule:
    """Keep every value; a field without values is absent."""

    def reduce(values: Column) -> Column:
        kept = arrays.empty_to_null(values)
        return into(kept) if into else kept

    return FieldRule(steps, reduce)


def _not_blank(c: Column) -> Column:
    return arrays.blank_to_null(c)


def _files(values: Column) -> Column:
    return F.transform(values, lambda f: F.struct(f.alias("value")))


DEFAULT_RULES: dict[str, FieldRule] = {
    "source": take_first(),
    "authors": keep_all(names.normalise_author),
    "abstract": take_first(text.clean_abstract),
    "title": FieldRule((text.clean_title,), lambda v: arrays.blank_to_null(arrays.join_all(v)),
                       arrays.blank_to_null),
    "subtitle": take_first(text.clean_title),
    "collaborations": keep_all(text.clean_collaboration, into=arrays.wrap),
    "collections": keep_all(into=lambda v: arrays.wrap(v, "primary")),
    "journal_title": take_first(),
    "journal_year": FieldRule((), arrays.first, lambda c: c),
    "journal_artid": take_first(),
    "journal_fpage": take_first(),
    "journal_lpage": take_first(),
    "journal_volume": take_first(),
    "journal_issue": take_first(),
    "journal_doctype": take_first(),
    "pubinfo_freetext": take_first(),
    "preprint_date": take_first(),
    "date_published": take_first(dates.format_date),
    "language": keep_all(text.language_name),
    "dois": keep_all(_not_blank, into=arrays.wrap),
    "related_article_doi": keep_all(_not_blank, into=arrays.wrap),
    "copyright_holder": take_first(),
    "copyright_year": take_first(),
    "copyright_statement": take_first(),
    "copyright_material": take_first(),
    "free_keywords": keep_all(text.clean_keyword, into=arrays.free_keywords),
    "classification_numbers": keep_all(into=arrays.classification_numbers),
    "thesis_supervisor": keep_all(names.thesis_supervisor),
    "thesis": FieldRule((), arrays.first, lambda c: c),
    "urls": keep_all(urls.canonical_url, into=arrays.wrap),
    "local_files": keep_all(into=_files),
    "license": keep_all(),
    "field_categories": keep_all(),
    "record_creation_date": FieldRule((), arrays.first, lambda c: c),
}


@lru_cache(maxsize=1024)
def _field(
    application: str, name: str, kind: T.DataType, rule: FieldRule | None, is_array: bool
) -> Column:
    """Column of a field.

    It refers to columns by name only, so that one serves all tables, and
    micro-batches do not build it anew.
    """
    value = F.col(name)
    if rule is not None:
        value = rule.apply(value, is_array)
    return value.cast(kind).alias(name)


def normalise(parsed: DataFrame, rules: Mapping[str, FieldRule] | None = None) -> DataFrame:
    """Canonical records with their lineage.

    ``rules`` adds or replaces rules by field name.  Fields a parser does not
    fill are NULL; columns outside the schema are dropped.
    """
    active = {**DEFAULT_RULES, **(rules or {})}
    given = {f.name: f.dataType for f in parsed.schema.fields}
    application = parsed.sparkSession.sparkContext.applicationId

    def column(field: T.StructField) -> Column:
        name = field.name
        if name not in given:
            return F.expr(f"CAST(NULL AS {field.dataType.simpleString()}) AS `{name}`")
        is_array = isinstance(given[name], T.ArrayType)
        return _field(application, name, field.dataType, active.get(name), is_array)

    return parsed.select(
        *[column(f) for f in lineage_schema().fields],
        *[column(f) for f in canonical_schema().fields],
    )
