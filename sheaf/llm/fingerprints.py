"""Document fingerprints: a Merkle tree over paragraphs and sections.

A text is cut into paragraphs at line ends and a paragraph into leaves at
punctuation, at most ``LEAF`` characters long (``SHORT_LEAF`` in paragraphs
of less than ``SHORT`` characters).  A paragraph's node is the hash
of its text; paragraphs whose node ends in one of four digits close a section,
so that sections keep their bounds when text before them changes; a section's
node is the hash of its paragraphs' nodes, the root that of the sections'.

The fingerprint is written as the root, then the paragraphs in order: the
first digits of the node and of each leaf's hash, ended by ``.``, or by ``/``
where a section ends.  Equal roots tell equal texts; where roots differ, the
sections, paragraphs and leaves that differ tell where.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters of a leaf, at most, and hexadecimal digits of its hash and of a paragraph's node.
LEAF, LEAF_DIGITS, NODE_DIGITS = 24, 6, 8
SHORT, SHORT_LEAF = 48, 4
_LEAF_PATTERN = r"[^.!?,;|]{1,%d}[.!?,;|]*+|[.!?,;|]++"
#: Rows that stand together when each is given the next one, about; groups, at most.
TOGETHER, GROUPS = 2000, 65_536


def paragraphs(text: Column) -> Column:
    return F.split(text, "\n", -1)


def leaves(text: Column) -> Column:
    """Hashes of the leaves of every paragraph."""

    def cut(paragraph: Column, most: int) -> Column:
        return F.regexp_extract_all(paragraph, F.lit(_LEAF_PATTERN % most), F.lit(0))

    def of(paragraph: Column) -> Column:
        return F.transform(
            F.when(F.length(paragraph) < SHORT, cut(paragraph, SHORT_LEAF)).otherwise(cut(paragraph, LEAF)),
            lambda leaf: F.xxhash64(leaf).bitwiseAND(F.lit((1 << 4 * LEAF_DIGITS) - 1)).cast("int"),
        )

    return F.transform(paragraphs(text), of)


def nodes(text: Column) -> Column:
    """Nodes of the paragraphs, each with the sign that ends it."""

    def ended(node: Column) -> Column:
        return F.concat(node, F.when(F.substring(node, 64, 1).isin("0", "4", "8", "c"), "/").otherwise("."))

    return F.transform(paragraphs(text), lambda p: ended(F.sha2(p.cast("binary"), 256)))


def root(nodes: Column) -> Column:
    sections = F.split(F.array_join(nodes, ""), "/", -1)
    return F.sha2(F.array_join(F.transform(sections, lambda s: F.sha2(s.cast("binary"), 256)), "").cast("binary"), 256)


def written(nodes: Column, leaves: Column) -> Column:
    """The fingerprint's text from nodes and leaves of one text."""

    def branch(node: Column, own: Column) -> Column:
        digits = F.transform(own, lambda h: F.lpad(F.lower(F.hex(h.cast("bigint"))), LEAF_DIGITS, "0"))
        return F.concat(F.substring(node, 1, NODE_DIGITS), F.array_join(digits, ""), F.substring(node, 65, 1))

    return F.concat(root(nodes), F.lit(":"), F.array_join(F.zip_with(nodes, leaves, branch), ""))


def likeness(one: Column, other: Column) -> Column:
    """Shared distinct leaves of two fingerprints, twice, by those of both; 1 for two without leaves."""
    a, b = F.array_distinct(F.flatten(one)), F.array_distinct(F.flatten(other))
    both = F.size(a) + F.size(b)
    return F.when(both == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def fingerprint(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint``; a null text counts as the empty one."""
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.withColumn("fingerprint", written(nodes(own), leaves(own)))


def differing(one: Column, other: Column) -> Column:
    """Numbers (from 0) of the paragraphs of ``one`` that ``other`` does not have; null for equal roots."""
    parts = lambda f: F.regexp_extract_all(F.substring_index(f, ":", -1), F.lit("[0-9a-f]+"), F.lit(0))
    theirs = parts(other)
    numbered = F.transform(parts(one), lambda p, i: F.when(~F.array_contains(theirs, p), i))
    return F.when(F.substring(one, 1, 64) != F.substring(other, 1, 64), F.filter(numbered, lambda i: i.isNotNull()))


def group_of(order: Column, cuts: list[int]) -> Column:
    """How many cuts are below a value, looked up in two steps."""
    width = max(1, int(len(cuts) ** 0.5))
    coarse = cuts[width - 1 :: width]
    below = lambda array: F.size(F.filter(array, lambda c: c < order))
    first = below(F.array(*map(F.lit, coarse))) if coarse else F.lit(0)
    fine = F.array(*(F.array(*map(F.lit, cuts[i * width : (i + 1) * width])) for i in range(len(coarse) + 1)))
    fine = fine.cast("array<array<bigint>>")
    return first * width + below(F.get(fine, first))


def with_next(docs: DataFrame, order: str, text: str) -> DataFrame:
    """Each row with ``next_text``: the text of the next row by descending ``order``, after the last the first.

    Rows are put in groups by cut points of ``order``, each with the first row
    of the group below, so a group is all that must stand in one task, and the
    texts are shuffled once.  Rows of equal order go by descending text.
    """
    n = docs.count()
    groups = max(1, min(GROUPS, -(-n // TOGETHER)))
    cuts: list[int] = []
    if groups > 1:
        shares = [i / groups for i in range(1, groups)]
        found = docs.agg(F.percentile_approx(order, shares, max(10_000, 10 * groups))).first()[0]
        cuts = sorted({int(c) for c in found or []})
    grouped = docs.withColumn("__group", group_of(F.col(order), cuts))
    heads = grouped.groupBy("__group").agg(F.max(order).alias("__head"))
    by_group = Window.orderBy("__group")
    above = F.coalesce(F.lead("__group").over(by_group), F.first("__group").over(by_group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    # At most one row for each group, of which there are GROUPS at most.
    heads = F.broadcast(heads.select("__head", above.alias("__to")))
    first = (
        docs.join(heads, docs[order] == heads["__head"])
        .groupBy("__to", order)
        .agg(F.max(text).alias(text))
        .select(F.col("__to").alias("__group"), order, text, F.lit(1).alias("__ghost"))
    )
    both = grouped.withColumn("__ghost", F.lit(0)).unionByName(first, allowMissingColumns=True)
    ahead = Window.partitionBy("__group").orderBy("__ghost", F.desc(order), F.desc(text))
    return (
        both.withColumn("next_text", F.lead(text).over(ahead)).filter("__ghost = 0").drop("__group", "__ghost")
    )


def edited_fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, with their likenesses.

    The edited text has its last third (rounded down, code points) replaced by
    as much of the beginning of the next document's text, by descending
    ``doc_id``; the last document's next is the first.  Null texts count as
    empty; null ids, and text ids that are no whole numbers, come last.  Rows that repeat an id stand by descending
    text, and all stay; a table of one row has itself as next.
    """
    base = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(doc_id).try_cast("bigint"), F.lit(-(1 << 63))).alias("order"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - third),
        F.substring(F.col("next_text"), F.lit(1), third),
    )
    texts = with_next(base, "order", "text").withColumn("n_chars", F.length("text").cast("bigint"))
    made = texts.withColumn("edited", edited).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        nodes(F.col("text")).alias("own_nodes"),
        leaves(F.col("text")).alias("own"),
        nodes(F.col("edited")).alias("edited_nodes"),
        leaves(F.col("edited")).alias("changed"),
        leaves(F.col("next_text")).alias("following"),
    )
    return made.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written(F.col("own_nodes"), F.col("own")).alias("fingerprint"),
        written(F.col("edited_nodes"), F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
