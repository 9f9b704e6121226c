"""Landed files: listing, splitting into documents, routing by name.

Nothing here deletes or moves an input.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheaf.functions import ids
from sheaf.functions.xml import nodes, pieces, whole_element
from sheaf.operators.children import explode_list


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dir_name(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def stem(path: Column) -> Column:
    """File name up to its first dot."""
    return F.substring_index(base_name(path), ".", 1)


def package_stem(path: Column) -> Column:
    """Name of a package without its extension, also the folder in it."""
    return F.regexp_replace(base_name(path), r"(A\.tar|\.tar|\.zip)$", "")


def join_path(*parts: Column | str) -> Column:
    """Join path parts, leaving out empty ones."""
    columns = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws("/", *[F.nullif(c, F.lit("")) for c in columns])


# --- reading -----------------------------------------------------------------


def read_feed(
    spark: SparkSession,
    path: str,
    tag: str,
    stream: bool = False,
    max_files: int = 1000,
    bare: bool = False,
) -> DataFrame:
    """Records of feed files, one row for each ``tag`` element.

    The opening tag is the line separator, so a feed of any size is read by
    many tasks in parallel and no file is held in memory as a whole.  What
    stands before the next opening tag without a closing one was cut off: it
    is a row of its own with ``landing_error``.  With ``bare`` the tag has no
    attributes; this is needed where other tags begin with its name.
    """
    start, end = (f"<{tag}>" if bare else f"<{tag}"), f"</{tag}>"
    reader = spark.readStream.option("maxFilesPerTrigger", max_files) if stream else spark.read
    lines = reader.option("lineSep", start).option("recursiveFileLookup", "true").text(path)
    # The head of a file follows no opening tag.
    head = r"^\s*(<[?!]|$)" if bare else r"^(?!\s*>|\s+[\w:.-]+\s*=)"
    value = F.regexp_replace("value", "^\uFEFF", "")
    whole = F.contains(value, F.lit(end))
    record = F.concat(F.lit(start), F.substring_index(value, end, 1), F.lit(end))
    return (
        lines.where(~value.rlike(head))
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_modification_time").alias("harvested_at"),
            F.when(whole, record).otherwise(F.concat(F.lit(start), value)).alias("payload"),
            F.when(~whole, "truncated record").alias("landing_error"),
        )
        .withColumn("doc_id", content_id(F.col("payload")))
    )


def content_id(payload: Column) -> Column:
    """Identifier that does not depend on where a document was found."""
    return F.md5(payload.cast("binary"))


def read_documents(
    spark: SparkSession, path: str, stream: bool = False, max_files: int = 1000
) -> DataFrame:
    """One row per text file."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files) if stream else spark.read
    return reader.option("recursiveFileLookup", "true").text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_path").alias("doc_id"),
        F.col("_metadata.file_modification_time").alias("harvested_at"),
        F.col("value").alias("payload"),
    )


def split_articles(documents: DataFrame, tags: Iterable[str]) -> DataFrame:
    """One row per article of a file; a file of one article keeps its ``doc_id``.

    Articles that were cut off are rows with ``landing_error``; a file without
    any stays as it is.
    """
    found = pieces(F.col("payload"), tags)
    # The list takes the place of the text, so that no article's row carries the whole file.
    listed = documents.withColumn("_pieces", found).withColumns(
        {
            "_none": F.coalesce(F.size("_pieces") == 0, F.lit(True)),
            "_pieces": F.when(F.size("_pieces") > 0, F.col("_pieces")).otherwise(F.array("payload")),
        }
    )
    split = (
        listed.drop("payload")
        .withColumn("_many", F.size("_pieces") > 1)
        .select("*", F.posexplode_outer("_pieces").alias("_pos", "_piece"))
        .drop("_pieces")
        .withColumn("_whole", whole_element(F.col("_piece"), tags))
    )
    whole = F.col("_whole")
    cut = F.when(~F.col("_none") & F.col("_piece").isNotNull() & whole.isNull(), "truncated article")
    payload = F.when(F.col("_none"), F.col("_piece")).otherwise(F.coalesce(whole, "_piece"))
    return split.select(
        *(
            {
                "doc_id": F.when(F.col("_many"), F.concat_ws("#", "doc_id", "_pos")).otherwise(F.col("doc_id")),
                "landing_error": F.coalesce("landing_error", cut),
                "payload": payload,
            }
            .get(name, F.col(name))
            .alias(name)
            for name in documents.columns
        )
    )


def split_nodes(documents: DataFrame, tags: Iterable[str]) -> DataFrame:
    """One row per element of the given tags, in document order."""
    listed = documents.withColumn("payload", nodes(F.col("payload"), tags))
    split = explode_list(listed, "payload", "node_pos", "payload")
    return split.withColumn("doc_id", F.concat_ws("#", "doc_id", "node_pos"))


# --- listing -----------------------------------------------------------------


def list_packages(spark: SparkSession, path: str) -> DataFrame:
    """Archives under a folder: files only, none hidden, no control files.

    Only names and sizes are read, not the content.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{zip,tar}")
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("harvested_at"))
    )
    return files.where(is_package(F.col("path")))


def in_landing_window(
    df: DataFrame, from_date: str | None, until_date: str | None, column: str = "harvested_at"
) -> DataFrame:
    """Rows that landed within the bounds; both belong to it, a date as a whole day.

    A lower bound with a time of day is the mark of the last run, and what
    landed at that very moment was taken by it.
    """
    landed = F.col(column)
    if from_date:
        start = F.lit(from_date).cast("timestamp")
        df = df.where(landed > start if len(from_date) > 10 else landed >= start)
    if until_date:
        end = F.lit(until_date).cast("date") + F.expr("INTERVAL 1 DAY")
        df = df.where(landed < end.cast("timestamp"))
    return df


def is_package(path: Column) -> Column:
    name = base_name(path)
    return (
        (F.endswith(name, F.lit(".zip")) | F.endswith(name, F.lit(".tar")))
        & ~F.startswith(name, F.lit("."))
        & (name != "go.xml")
    )


def not_yet_landed(
    listing: DataFrame, landed: DataFrame, on: str = "path", force: bool = False
) -> DataFrame:
    """Files of a listing that are not landed yet; all of them with ``force``."""
    if force:
        return listing
    return listing.join(landed.select(on).distinct(), on, "left_anti")


def all_and_missing(listing: DataFrame, landed: DataFrame, on: str = "path") -> DataFrame:
    """The listing with a flag for what is missing from the landed files."""
    known = landed.select(on).distinct().withColumn("_landed", F.lit(True))
    return (
        listing.join(known, on, "left")
        .withColumn("missing", F.col("_landed").isNull())
        .drop("_landed")
    )


# --- routing and companions --------------------------------------------------


def sibling_paths(path: Column, layout: str) -> dict[str, Column]:
    """Paths of the companions of an XML file, by delivery layout."""
    folder, name = dir_name(path), F.concat(stem(path), F.lit(".pdf"))
    if layout == "oup":
        return {
            "pdf_path": join_path(folder, "pdf", name),
            "pdfa_path": join_path(folder, "archival", name),
        }
    if layout == "iop":
        return {"pdf_path": join_path(folder, name)}
    if layout == "springer":
        return {"pdfa_path": join_path(folder, "BodyRef", "PDF", name)}
    raise ValueError(f"unknown layout {layout!r}")


def vtex_pdfa_path(pdf_path: Column) -> Column:
    """Where typesetters put the archival PDF of an article."""
    return join_path(dir_name(pdf_path), "main_a-2b.pdf")


def package_role(package_path: Column) -> Column:
    """What a package holds, told by its name."""
    name = base_name(package_path)
    return (
        F.when(F.contains(name, F.lit(".pdf")), "pdf")
        .when(F.contains(name, F.lit(".archival")), "pdfa")
        .when(F.contains(name, F.lit(".xml")), "xml")
    )


def member_role(member: Column, layout: str) -> Column:
    """``xml`` for members that are article metadata in the given layout."""
    if layout == "springer":
        wanted = F.contains(member, F.lit(".scoap")) | F.contains(member, F.lit(".Meta"))
    elif layout in ("iop", "oup"):
        wanted = F.endswith(member, F.lit(".xml")) & ~F.startswith(base_name(member), F.lit("."))
    else:
        raise ValueError(f"unknown layout {layout!r}")
    return F.when(wanted, "xml").when(ids.file_type(member) == "pdf", "pdf")


def _route(members: DataFrame, layout: str) -> DataFrame:
    wanted = member_role(F.col("member_path"), layout) == "xml"
    chosen = members.where(wanted | F.col("landing_error").isNotNull())
    return chosen.withColumns(sibling_paths(F.col("path"), layout))


def route_oup(members: DataFrame) -> DataFrame:
    xml_packages = members.where(
        (package_role(F.col("package_path")) == "xml") | F.col("landing_error").isNotNull()
    )
    return _route(xml_packages, "oup")


def route_iop(members: DataFrame) -> DataFrame:
    return _route(members, "iop")


def route_springer(members: DataFrame) -> DataFrame:
    return _route(members, "springer")


def spread(documents: DataFrame) -> DataFrame:
    """Deal documents out evenly by their bytes, whatever their files are like.

    Parsing is bound by the processor, and one large archive or file may hold
    most documents of an input.  How many parts there are is settled at run
    time, by what was written for the exchange.
    """
    return documents.hint("rebalance")
