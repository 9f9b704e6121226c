"""Writing table rows as publisher documents, with Column expressions only."""

from __future__ import annotations

from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheaf.functions.xml import escape_xml


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table, spread over the cores if it is a small file."""
    # The rows become documents many times their size, so bytes say little here.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return table(spark, sf_dir, name).select(*columns).repartition(tasks)


def text(value: Column | str) -> Column:
    """Value as escaped element content."""
    return escape_xml((F.col(value) if isinstance(value, str) else value).cast("string"))


class Markup:
    """Pieces of a document: literal markup and columns, in order."""

    def __init__(self, *pieces: Markup | Column | str):
        self.pieces: list[Column | str] = []
        for piece in pieces:
            for part in piece.pieces if isinstance(piece, Markup) else [piece]:
                if isinstance(part, str) and self.pieces and isinstance(self.pieces[-1], str):
                    self.pieces[-1] += part
                else:
                    self.pieces.append(part)

    def column(self) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in self.pieces])


def render(*pieces: Markup | Column | str) -> Column:
    return Markup(*pieces).column()


def element(tag: str, /, *content: Markup | Column | str, **attributes: Column | str) -> Markup:
    """An element; strings are literal markup, attribute names use ``_`` for ``-``."""
    written: list[Column | str] = []
    for name, value in attributes.items():
        quoted = escape_xml(value) if isinstance(value, Column) else escape(value, {'"': "&quot;"})
        written += [f' {name.replace("_", "-")}="', quoted, '"']
    return Markup(f"<{tag}", *written, ">", *content, f"</{tag}>")


def optional(condition: Column, content: Markup | str) -> Column:
    return F.when(condition, render(content)).otherwise("")


def datafield(tag: str, *subfields: tuple[str, Column | Markup | str], ind1: str = " ") -> Markup:
    """A MARC data field with a prefixed name, as feeds have them."""
    inner = [element("marc:subfield", value, code=code) for code, value in subfields]
    return element("marc:datafield", *inner, tag=tag, ind1=ind1, ind2=" ")


def marc_record(identifier: Column, *fields: Markup) -> Markup:
    return Markup(
        '<marc:record xmlns:marc="http://www.loc.gov/MARC21/slim" type="Bibliographic">',
        element("marc:controlfield", identifier, tag="001"),
        *fields,
        "</marc:record>",
    )


def oai_page(*records: Markup) -> Markup:
    """Records in the envelope of a harvesting response."""
    wrapped = [
        Markup("<record><header/><metadata>\n", r, "\n</metadata></record>") for r in records
    ]
    return Markup(
        '<?xml version="1.0"?><OAI-PMH><ListRecords>', *wrapped, "</ListRecords></OAI-PMH>"
    )


def letter(number: Column) -> Column:
    """A letter A-Z for a number."""
    return F.char((number % 26 + 65).cast("int"))


def documents(df: DataFrame, doc_id: Column, payload: Markup | Column) -> DataFrame:
    return df.select(
        doc_id.cast("string").alias("doc_id"),
        F.concat(F.lit("/landed/"), doc_id.cast("string"), F.lit(".xml")).alias("path"),
        render(payload).alias("payload"),
    )
