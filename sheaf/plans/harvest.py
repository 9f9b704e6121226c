"""Running a source: landed files in, records and a log entry out."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheaf.operators.lookups import union_sources
from sheaf.parsers.common import with_lineage
from sheaf.plans.normalise import normalise
from sheaf.plans.registry import SourceSpec, source as find_source
from sheaf.sources import landing, manifest, packages
from sheaf.sources.sinks import read_landed, read_runs, run_path, write_run

Stage = Callable[[DataFrame], DataFrame]


def run_stages(df: DataFrame, stages: Sequence[tuple[int, Stage]]) -> DataFrame:
    """Apply transforms in the order of their priority."""
    for _, stage in sorted(stages, key=lambda s: s[0]):
        df = df.transform(stage)
    return df


def package_documents(spec: SourceSpec, archives: DataFrame) -> DataFrame:
    """Members of archives that a source takes, as documents.

    A few large archives become many documents, so these are spread before
    the costly parsing starts.
    """
    members = packages.unpack(archives, spec.member_suffixes)
    documents = packages.documents(members)
    routed = spec.route(documents) if spec.route else documents
    return landing.spread(routed)


def load_documents(
    spark: SparkSession,
    spec: SourceSpec,
    path: str,
    landed: DataFrame | None = None,
    force: bool = False,
    from_date: str | None = None,
    until_date: str | None = None,
) -> DataFrame:
    """Documents of the files below a path that are new and landed within the bounds."""
    if spec.kind == "package":
        archives = packages.read_packages(spark, path, landed, force, from_date, until_date)
        return package_documents(spec, archives)
    if spec.kind == "feed":
        documents = landing.read_feed(spark, path, spec.tags[0], bare=spec.bare_tag)
    else:
        documents = landing.read_documents(spark, path)
    documents = landing.in_landing_window(documents, from_date, until_date)
    if landed is not None and not force:
        documents = landing.not_yet_landed(documents, landed)
    if spec.kind == "page" and spec.tags:
        documents = landing.split_nodes(documents, spec.tags)
    return documents


def write_documents(
    documents: DataFrame,
    source: str,
    results: str,
    run_id: str,
    batch_id: int = 0,
    stages: Sequence[tuple[int, Stage]] = (),
    window: tuple[str | None, str | None] = (None, None),
    **options,
) -> DataFrame:
    """Harvest documents into the results folder; returns the log entry."""
    started_at = datetime.datetime.now(datetime.timezone.utc)
    if find_source(source).needs_manifest:
        documents = packages.stage(documents, run_path(results, "members", run_id, batch_id))
    records = harvest_documents(documents, source, stages, **options)
    landed_as = "package_path" if find_source(source).kind == "package" else "path"
    return write_run(records, results, run_id, source, batch_id, started_at, window, landed_as)


def parse_source(spec: SourceSpec, documents: DataFrame, **options) -> DataFrame:
    """Raw fields of a source's documents."""
    options = {**spec.defaults, **options}
    if not spec.needs_manifest:
        return spec.parse(documents, **options)
    listed = manifest.listed_articles(documents, options.pop("as_of", None))
    is_article = F.col("payload").rlike(r"<(?:simple-)?article[\s>]")
    articles = documents.where(is_article | F.col("landing_error").isNotNull())
    return spec.parse(articles, listed, **options)


def harvest_documents(
    documents: DataFrame, source: str, stages: Sequence[tuple[int, Stage]] = (), **options
) -> DataFrame:
    """Canonical records, good and bad, from a table of raw documents."""
    spec = find_source(source)
    records = normalise(parse_source(spec, with_lineage(documents), **options), spec.rules)
    return run_stages(records, stages)


# --- windows -----------------------------------------------------------------


def in_window(
    df: DataFrame,
    date: Column | str,
    from_date: str | None = None,
    until_date: str | None = None,
    journals: Sequence[str] | None = None,
    journal: Column | str | None = None,
    sets: Sequence[str] | None = None,
    set_name: Column | str | None = None,
) -> DataFrame:
    """Restrict to a date window, journals and sets; both bounds belong to it.

    The bounds are compared with the column as it is, so that they reach the
    scan as filters or prune partitions.
    """
    date = date if isinstance(date, Column) else F.col(date)
    if from_date:
        df = df.where(date >= F.lit(from_date).cast("timestamp"))
    if until_date:
        end = F.lit(until_date).cast("date") + F.expr("INTERVAL 1 DAY")
        df = df.where(date < end.cast("timestamp"))
    if journals:
        df = df.where((journal if isinstance(journal, Column) else F.col(journal)).isin(*journals))
    if sets:
        df = df.where((set_name if isinstance(set_name, Column) else F.col(set_name)).isin(*sets))
    return df


def high_water_marks(runs: DataFrame) -> DataFrame:
    """Where each source is to be harvested from next.

    ``from_date`` is the day, for windows of an interface that knows only
    days; ``from_time`` the moment the last run began, for landing times.
    """
    done = runs.where(F.col("status") == "success")
    return done.groupBy("source").agg(
        F.date_format(F.max("started_at"), "yyyy-MM-dd").alias("from_date"),
        F.date_format(F.max("started_at"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("from_time"),
    )


def next_from_date(
    runs: DataFrame | None, source: str, from_date: str | None = None, grain: str = "from_date"
) -> str | None:
    """An explicit date, else the high-water mark, else none for a full harvest."""
    if from_date or runs is None:
        return from_date
    mark = high_water_marks(runs.where(F.col("source") == source)).first()
    return mark[grain] if mark else None


# --- whole runs --------------------------------------------------------------


def harvest(
    spark: SparkSession,
    source: str,
    path: str,
    results: str,
    run_id: str | None = None,
    from_date: str | None = None,
    until_date: str | None = None,
    force: bool = False,
    incremental: bool = False,
    stages: Sequence[tuple[int, Stage]] = (),
    published: tuple[str | None, str | None] = (None, None),
    journals: Sequence[str] | None = None,
    sets: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Harvest landed files of a source and return the log entry of the run.

    ``from_date`` and ``until_date`` bound the time files landed.  Files that a
    other successful run into ``results`` took are left out, unless ``force`` is set.
    With ``incremental`` the window also starts at the last successful run, so
    that older files need not be looked up.  ``published``, ``journals`` and
    ``sets`` (subject areas) restrict the articles of a source of JSON pages;
    for other sources they cannot apply and are refused.
    """
    spec = find_source(source)
    articles_only = any(published) or bool(journals) or bool(sets)
    if articles_only and spec.kind != "page":
        raise ValueError(f"source {source!r} has no dates, journals or sets to select articles by")
    if incremental and not from_date and not force:
        from_date = next_from_date(_runs_or_none(spark, results), source, grain="from_time")
    run_id = run_id or uuid.uuid4().hex
    landed = None if force else _landed_or_none(spark, results, source, run_id)
    documents = load_documents(spark, spec, path, landed, force, from_date, until_date)
    if articles_only:
        stages = [(-1, lambda df: _selected(df, published, journals, sets)), *stages]
    return write_documents(
        documents,
        source,
        results,
        run_id,
        stages=stages,
        window=(from_date, until_date),
        **options,
    )


def _selected(
    records: DataFrame,
    published: tuple[str | None, str | None],
    journals: Sequence[str] | None,
    sets: Sequence[str] | None,
) -> DataFrame:
    """Articles within the selection; what is no record stays, to be accounted for."""
    good = in_window(
        records.where(F.col("error").isNull()),
        F.col("date_published").try_cast("timestamp"),
        *published,
        journals=journals,
        journal="journal_title",
    )
    if sets:
        good = good.where(F.arrays_overlap(F.transform("field_categories", lambda c: c["term"]), F.array(*map(F.lit, sets))))
    return good.unionByName(records.where(F.col("error").isNotNull()))


def _landed_or_none(
    spark: SparkSession, results: str, source: str, run_id: str
) -> DataFrame | None:
    """Paths that the other successful runs of a source took; a run that is repeated takes its own again."""
    from pyspark.errors import AnalysisException

    try:
        landed = read_landed(spark, results).where(F.col("run_id") != run_id)
        return landed.where(F.col("source") == source).select("path")
    except AnalysisException:
        return None


def _runs_or_none(spark: SparkSession, results: str) -> DataFrame | None:
    from pyspark.errors import AnalysisException

    try:
        return read_runs(spark, results)
    except AnalysisException:
        return None
