"""Package manifests: which articles a package holds and where they belong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sheaf import dims
from sheaf.functions import arrays, xml
from sheaf.operators.children import explode_list
from sheaf.parsers.common import computed_once
from sheaf.sources.landing import base_name, join_path, package_stem, vtex_pdfa_path

_VOLUME = "`volume-issue-number`: STRUCT<`vol-first`: ARRAY<STRING>, suppl: ARRAY<STRING>>"
_FILES = """`files-info`: STRUCT<
  ml: ARRAY<STRUCT<pathname: ARRAY<STRING>>>,
  `web-pdf`: ARRAY<STRUCT<pathname: ARRAY<STRING>>>>"""

# Issues and items are parsed by one schema.
_ELEMENT = f"""
  `journal-issue-properties`: STRUCT<{_VOLUME}>, {_VOLUME},
  `journal-issue-unique-ids`: STRUCT<{_VOLUME}>,
  `journal-item-unique-ids`: STRUCT<
    doi: ARRAY<STRING>, `jid-aid`: STRUCT<jid: ARRAY<STRING>, aid: ARRAY<STRING>>>,
  `journal-item-properties`: STRUCT<`online-publication-date`: ARRAY<STRING>>,
  {_FILES}
"""
_ENTRY = """
  doi: ARRAY<STRING>,
  pages: ARRAY<STRUCT<`first-page`: ARRAY<STRING>, `last-page`: ARRAY<STRING>>>
"""


def is_dataset(member_path: Column) -> Column:
    return F.contains(member_path, F.lit("dataset.xml"))


def _pathname(kind: str) -> Column:
    return arrays.first(arrays.first(F.col(f"doc.`files-info`.`{kind}`"))["pathname"])


def _in_package(pathname: Column) -> Column:
    """Path of a member as the archive has it, below the package's folder."""
    return join_path(package_stem(F.col("package_path")), pathname)


#: What an item tells, and what an entry of an issue does.
ITEM = ("journal", "publication_date", "xml_file", "pdf_file", "pdfa_file")
ENTRY = ("volume", "first_page", "last_page")
_POSITION = "struct<member_path:string,pos:int,entry:int>"


def _typed(df: DataFrame, kind: Column | str, file: Column, **given: Column) -> DataFrame:
    """Rows of one shape, whatever they tell: the file they are about, and what is known of it."""
    empty = F.lit(None).cast("string")
    position = given.pop("position", F.lit(None).cast(_POSITION))
    return df.select(
        "package_path",
        (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"),
        file.alias("file"),
        position.cast(_POSITION).alias("position"),
        *(given.get(name, empty).alias(name) for name in ("doi", *ITEM, *ENTRY)),
    )


def _position(pos: Column, entry: Column | None = None) -> Column:
    return F.struct(F.col("member_path"), pos.alias("pos"), (F.lit(0) if entry is None else entry).alias("entry"))


def dataset_elements(datasets: DataFrame, as_of=None) -> DataFrame:
    """Issues and items of all manifests, each parsed once, as typed rows.

    An issue tells its volume and the file that lists its articles; an item
    its article's DOI, journal, date and files.  Items without an online date
    get ``as_of``, those without a DOI are left out.
    """

    def numbered(tag: str, kind: str) -> Column:
        found = xml.nodes(F.col("payload"), [tag])
        return F.transform(found, lambda n, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), n.alias("node")))

    both = F.concat(numbered("journal-issue", "issue"), numbered("journal-item", "item"))
    listed = datasets.select("package_path", "member_path", both.alias("_nodes"))
    found = explode_list(listed, "_nodes", "_no", "_e")
    node = xml.prepare_xml(F.col("_e.node"))
    parsed = computed_once(found, "doc", xml.parse_xml(node, _ELEMENT)).where(
        F.col("doc._corrupt_record").isNull()
    )
    is_item = F.col("_e.kind") == "item"
    volume = F.coalesce(
        F.col("doc.`journal-issue-properties`.`volume-issue-number`"),
        F.col("doc.`volume-issue-number`"),
        F.col("doc.`journal-issue-unique-ids`.`volume-issue-number`"),
    )
    code = arrays.first(F.col("doc.`journal-item-unique-ids`.`jid-aid`.jid"))
    given = arrays.first(F.col("doc.`journal-item-properties`.`online-publication-date`"))
    doi = arrays.first(F.col("doc.`journal-item-unique-ids`.doi"))
    file, pdf = _in_package(_pathname("ml")), _in_package(_pathname("web-pdf"))
    is_vtex = F.contains(base_name(F.col("package_path")), F.lit("vtex"))
    return _typed(
        parsed,
        F.col("_e.kind"),
        file,
        position=_position(F.col("_e.pos")),
        doi=F.when(is_item, doi),
        volume=F.when(
            ~is_item, F.concat_ws(" ", arrays.first(volume["vol-first"]), arrays.first(volume["suppl"]))
        ),
        journal=F.when(is_item, dims.translate(code, dims.ELSEVIER_JOURNALS, code)),
        publication_date=F.when(
            is_item, F.coalesce(F.substring(given, 1, 10), F.lit(None if as_of is None else str(as_of)))
        ),
        xml_file=F.when(is_item, file),
        pdf_file=F.when(is_item, pdf),
        pdfa_file=F.when(is_item & is_vtex, vtex_pdfa_path(pdf)),
    ).where((F.col("kind") == "issue") | F.col("doi").isNotNull())


def issue_entries(issues: DataFrame) -> DataFrame:
    """Articles that the issues' own files list, with their pages, as typed rows."""
    listed = issues.where(F.contains("payload", F.lit("include-item>"))).select(
        "package_path",
        "member_path",
        xml.nodes(F.col("payload"), ["include-item", "ce:include-item"]).alias("_nodes"),
    )
    found = explode_list(listed, "_nodes", "_pos", "_node")
    entries = computed_once(found, "doc", xml.parse_xml(xml.prepare_xml(F.col("_node")), _ENTRY))
    pages = arrays.first(F.col("doc.pages"))
    return _typed(
        entries,
        "entry",
        F.col("member_path"),
        position=_position(F.lit(0), F.col("_pos")),
        doi=arrays.first(F.col("doc.doi")),
        first_page=arrays.first(pages["first-page"]),
        last_page=arrays.first(pages["last-page"]),
    ).where(F.col("doi").isNotNull())


def join_manifest(items: DataFrame, entries: DataFrame) -> DataFrame:
    """Items completed by the issue that lists them, if any.

    ``items`` have ``item_pos``, ``entries`` have ``issue_pos`` besides
    ``package_path``, ``doi`` and what they tell.  A DOI listed by several
    issues of a package belongs to the first, one with several items has the
    last.  Both come together in one aggregation, partial in each task, so
    copies cannot multiply.
    """
    key = ["package_path", "doi"]
    told = [c for c in items.columns if c not in key]
    listed = [c for c in entries.columns if c not in (*key, "issue_pos")]
    both = items.select(*key, F.struct(F.col("item_pos").alias("at"), *told).alias("_item")).unionByName(
        entries.select(*key, F.struct("issue_pos", F.struct(*listed).alias("told")).alias("_entry")),
        allowMissingColumns=True,
    )
    one = both.groupBy(*key).agg(F.max("_item").alias("_item"), F.min("_entry").alias("_entry"))
    return one.where(F.col("_item").isNotNull()).select(
        *key, *(F.col(f"_item.{c}") for c in told), *(F.col(f"_entry.told.{c}") for c in listed)
    )


def _of_kind(documents: DataFrame, kind: str) -> DataFrame:
    """Staged documents know their kind; for others the content decides."""
    return documents.where(F.col("kind") == kind) if "kind" in documents.columns else documents


def listed_articles(documents: DataFrame, as_of=None) -> DataFrame:
    """What a package's manifest and issues say of each DOI, and what is wrong with it.

    A row per ``package_path`` and ``doi`` with the columns of ``ITEM`` and
    ``ENTRY``, ``is_item`` (the manifest has it) and ``problem``.  Every
    element is parsed once: issues, entries, items and the names of delivered
    files first come together by file, where entries get the issue that lists
    their file and items learn whether theirs came; and then by DOI.
    """
    datasets = _of_kind(documents, "dataset").where(is_dataset(F.col("member_path")))
    files = _typed(documents, "file", F.col("member_path"))
    typed = (
        dataset_elements(datasets, as_of)
        .unionByName(issue_entries(_of_kind(documents, "issue")))
        .unionByName(files)
    )
    of_file = Window.partitionBy("package_path", "file")
    is_a = lambda kind: F.col("kind") == kind
    issue = F.min(F.when(is_a("issue"), F.struct("position", "volume"))).over(of_file)
    met = typed.withColumns(
        {"_issue": issue, "_came": F.max(is_a("file")).over(of_file) & F.col("file").isNotNull()}
    ).where(is_a("item") | (is_a("entry") & F.col("_issue").isNotNull()))
    item = F.struct("position", F.coalesce("_came", F.lit(False)).alias("came"), *ITEM)
    entry = F.struct(
        F.col("_issue.position").alias("issue"),
        "position",
        F.col("_issue.volume").alias("volume"),
        "first_page",
        "last_page",
    )
    # The last item of a DOI, and the first entry.
    one = met.groupBy("package_path", "doi").agg(
        F.max(F.when(is_a("item"), item)).alias("_item"), F.min(F.when(is_a("entry"), entry)).alias("_entry")
    )
    problem = F.when(F.col("_item").isNull(), "issue lists a DOI without item").when(
        ~F.col("_item.came"), "item without article file"
    )
    return one.select(
        "package_path",
        "doi",
        *(F.col(f"_item.{c}") for c in ITEM),
        *(F.col(f"_entry.{c}") for c in ENTRY),
        F.col("_item").isNotNull().alias("is_item"),
        problem.alias("problem"),
    )


def build_manifest(documents: DataFrame, as_of=None) -> DataFrame:
    """Manifest of all packages from their members."""
    return listed_articles(documents, as_of).where("is_item").drop("is_item", "problem")


def manifest_problems(documents: DataFrame) -> DataFrame:
    """What manifests and issues promise but packages do not hold."""
    found = listed_articles(documents).where(F.col("problem").isNotNull())
    return found.select("package_path", "doi", F.col("problem").alias("error"))
