"""Export, accounting, sinks, increments and streams."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheaf.functions import arrays
from sheaf.operators.lookups import union_sources
from sheaf.operators.quality import error_counts, primary_doi, run_summary, valid, warning_counts
from sheaf.plans.export import restructure
from sheaf.plans.harvest import harvest_documents, high_water_marks, in_window
from sheaf.sources import landing, packages, sinks
from sheaf.streaming import stream_harvest
from sheaf.workloads import query
from sheaf.workloads.feeds import (
    Markup, datafield, documents, marc_record, render, spread_table, table, text,
)
from sheaf.workloads.publishers import customers_as_nlm, parts_as_iop, parts_as_marc


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors can reach: shared by setting, or beside the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    base = shared or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/sheaf-scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- export ------------------------------------------------------------------


def customers_as_marc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small records, of which every fourth has no identifier and no journal."""
    df = spread_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    key = F.col("c_custkey")
    id_ = key.cast("string")
    doi = datafield("024", ("a", Markup("10.5/", id_)), ("2", "DOI"), ind1="7")
    journal = datafield("773", ("p", "Exp. J."), ("y", "2010"), ("c", Markup(id_, "-9")))
    date = F.when(key % 3 == 0, "2010").when(key % 3 == 1, "2010-7").otherwise("2010-07-09")
    record = marc_record(
        id_,
        F.when(key % 4 != 0, render(doi, journal)).otherwise(""),
        datafield("100", ("a", Markup(text("c_name"), ", X. Y."))),
        datafield("245", ("a", Markup("Export ", text("c_mktsegment")))),
        datafield("260", ("c", date), ("b", F.when(key % 2 == 0, "Press").otherwise(""))),
        datafield("542", ("f", "(c) 2010")),
    )
    return documents(df, key, record)


@query("""
SELECT c_custkey AS custkey, src AS source, src AS method, 'run-7' AS submission_number, '2020-01-01T00:00:00' AS created,
       'Export ' || c_mktsegment AS title, '' AS subtitle, '' AS abstract,
       ['2010-01-01', '2010-07-01', '2010-07-09'][(c_custkey % 3 + 1)::INT] AS imprint_date, src AS publisher,
       '(c) 2010' AS statement, '' AS holder, '2010' AS copyright_year,
       CASE WHEN c_custkey % 4 <> 0 THEN 'Exp. J.' END AS journal_title, CASE WHEN c_custkey % 4 <> 0 THEN 2010 END AS year,
       CASE WHEN c_custkey % 4 <> 0 THEN c_custkey::VARCHAR END AS page_start, CASE WHEN c_custkey % 4 <> 0 THEN '' END AS artid,
       CASE WHEN c_custkey % 4 <> 0 THEN '10.5/' || c_custkey || ',10.5/related' END AS dois, upper(c_name) AS first_author
FROM (SELECT *, CASE WHEN c_custkey % 2 = 0 THEN 'Press' ELSE 'hindawi' END AS src FROM customer)
""")
def export_restructure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export after stages of the user's own, one of which adds related DOIs."""
    related = F.when(F.col("dois").isNotNull(), arrays.wrap(F.array(F.lit("10.5/related"))))
    shout = F.transform("authors", lambda a: a.withField("surname", F.upper(a["surname"])))
    stages = [
        (300, lambda df: restructure(df, "2020-01-01T00:00:00", "run-7")),
        (1, lambda df: df.withColumn("related_article_doi", related)),
        (2, lambda df: df.withColumn("authors", shout)),
    ]
    records = harvest_documents(customers_as_marc(spark, sf_dir), "hindawi", stages)
    info = arrays.first(F.col("publication_info"))
    rights = arrays.first(F.col("copyright"))
    return records.select(
        F.col("doc_id").cast("long").alias("custkey"),
        "acquisition_source.source",
        "acquisition_source.method",
        "acquisition_source.submission_number",
        F.col("record_creation_date").alias("created"),
        arrays.first(F.col("titles"))["title"].alias("title"),
        arrays.first(F.col("titles"))["subtitle"].alias("subtitle"),
        arrays.first(F.col("abstracts"))["value"].alias("abstract"),
        arrays.first(F.col("imprints"))["date"].alias("imprint_date"),
        arrays.first(F.col("imprints"))["publisher"].alias("publisher"),
        rights["statement"].alias("statement"),
        rights["holder"].alias("holder"),
        rights["year"].alias("copyright_year"),
        info["journal_title"].alias("journal_title"),
        info["year"].alias("year"),
        info["page_start"].alias("page_start"),
        info["artid"].alias("artid"),
        F.array_join(F.transform("dois", lambda d: d["value"]), ",").alias("dois"),
        arrays.first(F.col("authors"))["surname"].alias("first_author"),
    )


# --- quality -----------------------------------------------------------------


def documents_as_marc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as abstracts; every ninth document is cut off."""
    df = spread_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    key = F.col("doc_id")
    # Control characters have no place in XML.
    body = F.regexp_replace("text", r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", " ")
    record = marc_record(
        key.cast("string"),
        F.when(key % 2 == 0, render(datafield("024", ("a", Markup("10.6/", key.cast("string"))), ("2", "DOI")))).otherwise(""),
        F.when(key % 5 > 0, render(datafield("100", ("a", text("source"))))).otherwise(""),
        datafield("300", ("a", text("lang"))),
        datafield("520", ("a", text(body))),
    )
    whole = record.column()
    cut = F.when(key % 9 == 0, F.regexp_replace(whole, "</marc:record>$", "")).otherwise(whole)
    return documents(df, key, cut)


@query("""
SELECT doc_id::VARCHAR AS doc_id, w.warning FROM documents,
LATERAL (SELECT unnest(list_filter([CASE WHEN doc_id % 2 <> 0 THEN 'no_doi' END, CASE WHEN doc_id % 5 = 0 THEN 'no_authors' END,
                                    'no_arxiv', 'bad_page_count'], lambda x: x IS NOT NULL)) AS warning) w
WHERE doc_id % 9 <> 0
UNION ALL SELECT doc_id::VARCHAR, 'error: malformed XML' FROM documents WHERE doc_id % 9 = 0
""")
def quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = harvest_documents(documents_as_marc(spark, sf_dir), "hindawi")
    problem = F.concat(F.lit("error: "), F.col("error"))
    notes = F.when(F.col("error").isNotNull(), F.array(problem)).otherwise(F.col("warnings"))
    return records.select("doc_id", F.explode_outer(notes).alias("warning")).where("warning IS NOT NULL")


@query("""
WITH n AS (SELECT doc_id % 9 = 0 AS bad, doc_id % 2 <> 0 AS no_doi, doc_id % 5 = 0 AS no_authors FROM documents)
SELECT 'n_records' AS measure, count(*) FILTER (NOT bad) AS n FROM n
UNION ALL SELECT 'n_errors', count(*) FILTER (bad) FROM n
UNION ALL SELECT 'n_missing_doi', count(*) FILTER (NOT bad AND no_doi) FROM n
UNION ALL SELECT 'error malformed XML', count(*) FILTER (bad) FROM n
UNION ALL SELECT 'warning no_doi', count(*) FILTER (NOT bad AND no_doi) FROM n
UNION ALL SELECT 'warning no_authors', count(*) FILTER (NOT bad AND no_authors) FROM n
UNION ALL SELECT 'warning no_arxiv', count(*) FILTER (NOT bad) FROM n
UNION ALL SELECT 'warning bad_page_count', count(*) FILTER (NOT bad) FROM n
""")
def run_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = harvest_documents(documents_as_marc(spark, sf_dir), "hindawi")
    # The measures share one parse: they are read from a written run.
    folder = scratch(spark, "summary")
    records.select("spider", "error", "warnings", "dois").write.parquet(folder)
    written = spark.read.parquet(folder)
    totals = run_summary(written).unpivot(
        ["spider"], ["n_records", "n_errors", "n_missing_doi"], "measure", "n"
    ).select("measure", "n")
    warnings = warning_counts(written).select(F.concat(F.lit("warning "), "warning").alias("measure"), "n")
    errors = error_counts(written).select(F.concat(F.lit("error "), "error").alias("measure"), "n")
    return totals.unionByName(warnings).unionByName(errors)


# --- increments --------------------------------------------------------------


@query("""
SELECT '/in/' || event_type || '/' || event_id || CASE WHEN event_id % 3 = 0 THEN '.tar' ELSE '.zip' END AS path,
       CASE WHEN event_id % 4 = 0 THEN false ELSE true END AS missing
FROM events WHERE event_id % 5 <> 0 AND event_id % 7 <> 0
""")
def incremental_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as landed files: hidden and other files out, known ones flagged."""
    listing, landed = _landings(spark, sf_dir)
    return landing.all_and_missing(listing, landed).select("path", "missing")


def _landings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events")
    key = F.col("event_id")
    id_ = key.cast("string")
    name = (
        F.when(key % 5 == 0, F.concat(F.lit("."), id_, F.lit(".zip")))
        .when(key % 7 == 0, F.concat(id_, F.lit(".txt")))
        .when(key % 3 == 0, F.concat(id_, F.lit(".tar")))
        .otherwise(F.concat(id_, F.lit(".zip")))
    )
    files = events.select(
        F.concat(F.lit("/in/"), F.col("event_type"), F.lit("/"), name).alias("path"), key.alias("event_id")
    )
    listing = files.where(landing.is_package(F.col("path")))
    return listing, files.where(F.col("event_id") % 4 == 0)


@query("""
SELECT event_id, '/in/' || event_type || '/' || event_id || CASE WHEN event_id % 3 = 0 THEN '.tar' ELSE '.zip' END AS path
FROM events WHERE event_id % 5 <> 0 AND event_id % 7 <> 0 AND event_id % 4 <> 0
""")
def incremental_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing, landed = _landings(spark, sf_dir)
    return landing.not_yet_landed(listing, landed)


@query("""
SELECT event_id, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-11' AND event_type IN ('click', 'error')
""")
def harvest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    windowed = in_window(
        table(spark, sf_dir, "events"), "ts", "2024-01-03", "2024-01-10",
        journals=["click", "error"], journal="event_type",
    )
    return windowed.select("event_id", "event_type")


@query("""
SELECT event_type AS source, strftime(max(ts), '%Y-%m-%d') AS from_date, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS from_time FROM events WHERE event_id % 3 <> 0 GROUP BY 1
""")
def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"),
        F.col("ts").alias("started_at"),
        F.when(F.col("event_id") % 3 == 0, "failed").otherwise("success").alias("status"),
    )
    return high_water_marks(runs)


@query("""
SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'oup' WHEN 1 THEN 'iop' ELSE 'springer' END AS layout,
       CASE page_id % 3 WHEN 0 THEN '/w/p' || page_id || '/pdf/a' || page_id || '.pdf'
                        WHEN 1 THEN '/w/p' || page_id || '/a' || page_id || '.pdf' END AS pdf_path,
       CASE page_id % 3 WHEN 0 THEN '/w/p' || page_id || '/archival/a' || page_id || '.pdf'
                        WHEN 2 THEN '/w/p' || page_id || '/BodyRef/PDF/a' || page_id || '.pdf' END AS pdfa_path,
       ['xml', 'pdf', 'pdfa'][(page_id % 3 + 1)::INT] AS package_role, 'xml' AS member_role,
       CASE page_id % 3 WHEN 0 THEN 'pkg' || page_id ELSE 'pkg' || page_id END AS package_stem,
       '/w/p' || page_id || '/main_a-2b.pdf' AS vtex
FROM pages
""")
def sibling_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id")
    key = F.col("page_id")
    id_ = key.cast("string")
    layouts = ["oup", "iop", "springer"]

    def pick(options: list[Column]) -> Column:
        return F.when(key % 3 == 0, options[0]).when(key % 3 == 1, options[1]).otherwise(options[2])

    path = F.concat(F.lit("/w/p"), id_, F.lit("/a"), id_, F.lit(".xml.Meta.xml"))
    null = F.lit(None).cast("string")
    siblings = [landing.sibling_paths(path, layout) for layout in layouts]
    package = F.concat(F.lit("/in/pkg"), id_, pick([F.lit(".xml.zip"), F.lit(".pdf.zip"), F.lit(".archival.zip")]))
    archive = F.concat(F.lit("/in/pkg"), id_, pick([F.lit("A.tar"), F.lit(".tar"), F.lit(".zip")]))
    return pages.select(
        "page_id",
        pick([F.lit(layout) for layout in layouts]).alias("layout"),
        pick([s.get("pdf_path", null) for s in siblings]).alias("pdf_path"),
        pick([s.get("pdfa_path", null) for s in siblings]).alias("pdfa_path"),
        landing.package_role(package).alias("package_role"),
        pick([landing.member_role(path, layout) for layout in layouts]).alias("member_role"),
        landing.package_stem(archive).alias("package_stem"),
        landing.vtex_pdfa_path(F.concat(F.lit("/w/p"), id_, F.lit("/main.pdf"))).alias("vtex"),
    )


# --- whole runs --------------------------------------------------------------


@query("""
SELECT 'repository' AS spider, '10.7/' || p_partkey AS doi, p_brand AS surname FROM part
UNION ALL SELECT 'IOP', '10.1088/' || p_partkey, p_brand FROM part WHERE p_partkey % 7 <> 0
UNION ALL SELECT 'NLM', CASE WHEN c_custkey % 4 = 0 THEN '10.2/a' ELSE '10.2/e' END || c_custkey, c_name FROM customer
""")
def union_of_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = union_sources(
        harvest_documents(
            parts_as_marc(spark, sf_dir), "repository", repository_host="repo.example.org"
        ),
        harvest_documents(parts_as_iop(spark, sf_dir), "IOP"),
        harvest_documents(customers_as_nlm(spark, sf_dir), "NLM"),
    )
    return valid(records).select(
        "spider", primary_doi().alias("doi"), arrays.first(F.col("authors"))["surname"].alias("surname")
    )


@query("""
SELECT ['JHEP', 'EPJC'][(c_custkey % 2 + 1)::INT] AS journal, c_custkey::VARCHAR AS doc_id, 'Export ' || c_mktsegment AS title,
       (SELECT count(*) FROM customer) AS written
FROM customer
""")
def sink_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as JSON in the folders of two journals, read back."""
    from sheaf.dims import SPRINGER_FOLDERS

    folder = F.get(F.array(*map(F.lit, SPRINGER_FOLDERS)), (F.col("doc_id").cast("long") % 2).cast("int"))
    records = harvest_documents(customers_as_marc(spark, sf_dir), "hindawi").withColumn("journal", folder)
    path = scratch(spark, "json")
    written = sinks.write_json(records.drop("payload"), path, "journal")
    back = spark.read.schema("doc_id STRING, title STRING, journal STRING").json(path)
    return back.select("journal", "doc_id", "title", F.lit(written).alias("written"))


@query("""
SELECT 'part-run' AS run_id, 'IOP' AS source, count(*) FILTER (p_partkey % 7 <> 0) AS n_records,
       count(*) FILTER (p_partkey % 7 = 0) AS n_errors, 0::BIGINT AS n_missing_doi, 'success' AS status,
       count(*) FILTER (p_partkey % 7 <> 0) AS n_read, count(*) FILTER (p_partkey % 7 = 0) AS n_quarantined
FROM part
""")
def sink_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run written twice: the second time replaces the first."""
    root = scratch(spark, "run")
    records = harvest_documents(parts_as_iop(spark, sf_dir), "IOP")
    for _ in range(2):
        sinks.write_run(records, root, "part-run", "IOP")
    read = sinks.read_records(spark, root).groupBy("run_id").agg(F.count("*").alias("n_read"))
    bad = sinks.read_quarantine(spark, root).groupBy("run_id").agg(F.count("*").alias("n_quarantined"))
    return (
        sinks.read_runs(spark, root)
        .select("run_id", "source", "n_records", "n_errors", "n_missing_doi", "status")
        .join(read, "run_id")
        .join(bad, "run_id")
    )


@query("""
SELECT event_id::VARCHAR AS control_number, 'Event ' || event_type AS title, strftime(ts, '%Y-%m-%d') AS date_published,
       '10.9/' || event_id AS doi, 'events' AS run_id, NULL AS error FROM events WHERE event_id % 13 <> 0
UNION ALL SELECT event_id::VARCHAR, NULL, NULL, NULL, 'events', 'truncated record' FROM events WHERE event_id % 13 = 0
UNION ALL SELECT NULL, NULL, NULL, NULL, 'events', 'logged: truncated record' FROM events WHERE event_id % 13 = 0
""")
def stream_harvest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as feed files and harvested by two runs of one stream.

    Every 13th record is cut off: it stops nothing, and is found in the
    quarantine and in the account of errors.  The second run finds nothing new.
    """
    root, inbox, checkpoint = (scratch(spark, n) for n in ("stream", "inbox", "checkpoint"))
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    record = marc_record(
        F.col("event_id").cast("string"),
        datafield("024", ("a", Markup("10.9/", F.col("event_id").cast("string"))), ("2", "DOI"), ind1="7"),
        datafield("245", ("a", Markup("Event ", text("event_type")))),
        datafield("260", ("c", F.date_format("ts", "yyyy-MM-dd"))),
    )
    whole = record.column()
    cut = F.when(F.col("event_id") % 13 == 0, F.regexp_replace(whole, "</marc:record>$", "")).otherwise(whole)
    events.select(cut.alias("value")).write.text(inbox)
    for _ in range(2):
        stream_harvest(spark, "hindawi", inbox, root, checkpoint, "events").awaitTermination()
    none = F.lit(None).cast("string")
    good = sinks.read_records(spark, root).select(
        "control_number", "title", "date_published", primary_doi().alias("doi"), "run_id", none.alias("error")
    )
    number = F.regexp_extract("payload", "10\\.9/([0-9]+)", 1)
    bad = sinks.read_quarantine(spark, root).select(number, none, none, none, "run_id", "error")
    logged = sinks.read_errors(spark, root).select(none, none, none, none, "run_id", F.concat(F.lit("logged: "), "error"))
    return good.union(bad).union(logged)


def _pack(batches):
    """Two archives for each batch of pages: a zip of the even ones and a tar of the others."""
    import io
    import tarfile
    import zipfile

    for batch in batches:
        rows = batch.to_pylist()
        packed = {}
        for kind, own in (
            ("zip", [r for r in rows if r["page_id"] % 2 == 0]),
            ("tar", [r for r in rows if r["page_id"] % 2 == 1]),
        ):
            if not own:
                continue
            buffer = io.BytesIO()
            if kind == "zip":
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                    for row in own:
                        archive.writestr(f"p/{row['page_id']}.xml", row["html"])
                        archive.writestr(f"p/{row['page_id']}.pdf", b"%PDF")
            else:
                with tarfile.open(fileobj=buffer, mode="w") as archive:
                    for row in own:
                        data = row["html"].encode()
                        info = tarfile.TarInfo(f"p/{row['page_id']}.xml")
                        info.size = len(data)
                        archive.addfile(info, io.BytesIO(data))
            packed[f"/in/{own[0]['page_id']}.{kind}"] = buffer.getvalue()
        yield pa.RecordBatch.from_pydict(
            {"path": list(packed), "content": list(packed.values())},
            schema=pa.schema([("path", pa.string()), ("content", pa.binary())]),
        )


@query("""
SELECT page_id, length(html) AS n_chars, md5(html) AS digest, ['zip', 'tar'][(page_id % 2 + 1)::INT] AS kind FROM pages
""")
def package_unpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages packed into archives and taken out again, XML members only."""
    pages = spread_table(spark, sf_dir, "pages", "page_id", "html")
    archives = pages.mapInArrow(_pack, "path STRING, content BINARY")
    members = packages.documents(packages.unpack(archives, (".xml",)))
    return members.select(
        landing.stem(F.col("member_path")).cast("long").alias("page_id"),
        F.length("payload").cast("long").alias("n_chars"),
        F.md5(F.col("payload").cast("binary")).alias("digest"),
        F.substring_index("package_path", ".", -1).alias("kind"),
    )


def _damaged_sets(orders: DataFrame) -> DataFrame:
    """Two orders as articles of one file; the second of every seventh file is cut off, and the first of every ninth."""
    key = F.col("o_orderkey")
    front = render(
        "<article article-type='research-article'><front><article-meta><article-id pub-id-type='doi'>10.8/",
        key.cast("string"),
        "</article-id><title-group><article-title>Of ",
        text("o_orderpriority"),
        "</article-title></title-group></article-meta></front><body><p>x</p></body>",
    )
    number = F.floor(key / 2)
    second = key % 2 == 1
    cut = F.when(second, number % 7 == 0).otherwise(number % 9 == 0)
    article = F.when(cut, front).otherwise(F.concat(front, F.lit("</article>")))
    parts = orders.select(number.alias("number"), second.alias("second"), article.alias("article"))
    # At most two articles for each number.
    listed = F.array_sort(F.collect_list(F.struct("second", "article")))
    whole = F.array_join(F.transform(listed, lambda a: a["article"]), "\n")
    files = parts.groupBy("number").agg(F.concat(F.lit("<?xml version='1.0'?><set>"), whole, F.lit("</set>")).alias("payload"))
    return documents(files, F.col("number"), F.col("payload"))


def _damaged_pages(orders: DataFrame) -> DataFrame:
    """A hundred orders as one page; of every eleventh order the identifiers are of the wrong kind, every 50th page is cut off."""
    key = F.col("o_orderkey")
    number = F.floor(key / 100)
    article = F.when(
        key % 11 == 0, F.concat(F.lit('{"date": "2001-02-03", "identifiers": "10.9/'), key.cast("string"), F.lit('"}'))
    ).otherwise(
        F.concat(F.lit('{"date": "2001-02-03", "numPages": "x1", "identifiers": {"doi": "10.9/'), key.cast("string"), F.lit('"}}'))
    )
    parts = orders.select(number.alias("number"), key.alias("key"), article.alias("article"))
    # At most a hundred articles for each page.
    listed = F.transform(F.array_sort(F.collect_list(F.struct("key", "article"))), lambda a: a["article"])
    page = F.concat(F.lit('{"data": ['), F.array_join(listed, ","), F.when(F.col("number") % 50 == 0, "").otherwise("]}"))
    return documents(parts.groupBy("number").agg(page.alias("payload")), F.col("number"), F.col("payload"))


@query("""
SELECT 'OUP' AS spider, CASE WHEN bad THEN NULL ELSE '10.8/' || k END AS doi,
       CASE WHEN bad THEN 'truncated article' END AS error, count(*) AS n
FROM (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 1 THEN (o_orderkey // 2) % 7 = 0 ELSE (o_orderkey // 2) % 9 = 0 END AS bad FROM orders)
GROUP BY ALL
UNION ALL
SELECT 'APS', CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE '10.9/' || o_orderkey END,
       CASE WHEN o_orderkey % 11 = 0 THEN 'malformed article' END, count(*)
FROM orders WHERE (o_orderkey // 100) % 50 <> 0 GROUP BY ALL
UNION ALL
SELECT 'APS', NULL, 'malformed JSON', count(DISTINCT o_orderkey // 100)
FROM orders WHERE (o_orderkey // 100) % 50 = 0 GROUP BY ALL
""")
def damaged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and pages of several articles, some cut off: each article comes once, as record or as error."""
    orders = spread_table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")
    records = union_sources(
        harvest_documents(_damaged_sets(orders), "OUP"), harvest_documents(_damaged_pages(orders), "APS")
    )
    doi = F.when(F.col("error").isNull(), primary_doi())
    return records.groupBy("spider", doi.alias("doi"), "error").agg(F.count("*").alias("n"))


@query("""
SELECT 'first' AS run_id, count(*) AS n_records, 0::BIGINT AS n_errors FROM part
UNION ALL SELECT 'again', 0, 0
UNION ALL SELECT 'forced', count(*), 0 FROM part
UNION ALL SELECT 'later', 0, 0
""")
def harvest_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed files harvested once, not again, again by force, and none of a later window."""
    from sheaf.plans.harvest import harvest

    inbox, root = scratch(spark, "feeds"), scratch(spark, "harvest")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    record = marc_record(
        F.col("p_partkey").cast("string"),
        datafield("024", ("a", Markup("10.7/", F.col("p_partkey").cast("string"))), ("2", "DOI"), ind1="7"),
        datafield("245", ("a", Markup("Part ", text("p_brand")))),
    )
    parts.select(record.column().alias("value")).write.text(inbox)
    for run_id, options in (
        ("first", {}),
        ("again", {"incremental": True}),
        ("forced", {"force": True}),
        ("later", {"from_date": "2999-01-01"}),
    ):
        harvest(spark, "hindawi", inbox, root, run_id, **options)
    return sinks.read_runs(spark, root).select("run_id", "n_records", "n_errors")


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS source, count(*) AS n FROM events GROUP BY 1, 2
""")
def landings_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.streaming import landing_counts

    landed = table(spark, sf_dir, "events").select(
        F.col("ts").alias("harvested_at"), F.col("event_type").alias("source")
    )
    return landing_counts(landed)
