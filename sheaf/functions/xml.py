"""Getting XML text ready for ``from_xml``, and text back out of raw markup."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from sheaf.functions.arrays import let

# Stands between pieces of a text while it is split; no XML holds it.
_CUT = "\u0001"


def escape_xml(c: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def unescape_xml(c: Column) -> Column:
    x = c
    for char, entity in (
        ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;"), ("&", "&amp;"),
    ):
        x = F.replace(x, F.lit(entity), F.lit(char))
    return F.when(F.contains(c, F.lit("&")), x).otherwise(c)


def node_pattern(tags: Iterable[str]) -> str:
    return rf"(?s)<({'|'.join(tags)})[\s>].*?</\1>"


def _up_to_last(c: Column, closing: str) -> Column:
    """The text up to the last of a closing tag, an empty one without any."""
    tail = F.substring_index(c, closing, -1)
    return F.left(c, F.length(c) - F.length(tail))


def all_closed(c: Column, tags: Iterable[str]) -> Column:
    """Whether a closing tag follows the last opening of each tag.

    Then a search from an opening tag to the next closing one always ends, and
    all of them together read the text once, however many are open.
    """
    ok = F.lit(True)
    for tag in tags:
        tail = F.substring_index(c, f"</{tag}>", -1)
        ok &= ~(F.contains(tail, F.lit(f"<{tag}>")) | F.contains(tail, F.lit(f"<{tag} ")))
    return ok


def nodes(payload: Column, tags: Iterable[str]) -> Column:
    """Every outermost element with one of the tags, as text, in order; none where one is left open."""
    tags = list(tags)
    found = lambda c: F.regexp_extract_all(c, F.lit(node_pattern(tags)), F.lit(0))
    if len(tags) == 1:
        # What follows the last closing tag holds no element.
        return found(let(payload, lambda c: _up_to_last(c, f"</{tags[0]}>")))
    none = F.array().cast("array<string>")
    return let(payload, lambda c: F.when(all_closed(c, tags), found(c)).otherwise(none))


def pieces(payload: Column, tags: Iterable[str]) -> Column:
    """Text of each element with one of the tags, from its opening tag to the next one's.

    An element that was cut off is thus a piece of its own, without closing
    tag, and takes no neighbour along.  The elements do not hold each other.
    """
    opening = rf"<(?:{'|'.join(tags)})(?=[\s>])"

    def marked(c: Column) -> Column:
        parts = F.split(F.regexp_replace(c, opening, f"{_CUT}$0"), _CUT, -1)
        return F.slice(parts, F.lit(2), F.lit(1 << 30))

    def found(c: Column) -> Column:
        # A look-ahead at every character is many times as slow.
        parts = F.split(c, f"(?={opening})", -1)
        slow = F.filter(parts, lambda p: F.rlike(p, F.lit(f"^{opening}")))
        return F.when(F.contains(c, F.lit(_CUT)), slow).otherwise(marked(c))

    return let(payload, found)


def whole_element(piece: Column, tags: Iterable[str]) -> Column:
    """The element that a piece begins with; NULL if its closing tag is missing."""

    def whole(c: Column, tag: str) -> Column:
        opened = F.rlike(F.left(c, F.lit(len(tag) + 2)), F.lit(rf"^<{tag}[\s>]"))
        return F.when(opened, let(_up_to_last(c, f"</{tag}>"), lambda x: F.when(x != "", x)))

    return let(piece, lambda c: F.coalesce(*[whole(c, tag) for tag in tags]))


def _any_closing(c: Column, tags: Iterable[str]) -> Column:
    found = F.lit(False)
    for tag in tags:
        found |= F.contains(c, F.lit(f"</{tag}>"))
    return found


def root_element(payload: Column, tags: Iterable[str]) -> Column:
    """The document element, without prologue and document type."""
    tags = list(tags)
    pattern = rf"(?s)<({'|'.join(tags)})[\s>].*</\1>"
    return let(payload, lambda c: F.when(_any_closing(c, tags), F.regexp_extract(c, pattern, 0)).otherwise(""))


def drop_elements(c: Column, tags: Iterable[str]) -> Column:
    """Cut elements whose content is not needed, before parsing."""
    tags = list(tags)
    pattern = rf"(?s)<({'|'.join(tags)})(?:\s[^>]*)?>.*</\1>"
    return let(c, lambda x: F.when(_any_closing(x, tags), F.regexp_replace(x, pattern, "")).otherwise(x))


def _inline_cdata(c: Column) -> Column:
    """CDATA sections become escaped text."""
    return let(c, _inlined)


def _inlined(c: Column) -> Column:
    pieces = F.split(c, r"<!\[CDATA\[", -1)

    def piece(text: Column, position: Column) -> Column:
        inside = F.substring_index(text, "]]>", 1)
        after = F.substr(text, F.length(inside) + 4)
        return F.when(position == 0, text).otherwise(F.concat(escape_xml(inside), after))

    joined = F.array_join(F.transform(pieces, piece), "")
    return F.when(F.contains(c, F.lit("<![CDATA[")), joined).otherwise(c)


_REFERENCE = r"^(?:[xX]0*([0-9a-fA-F]{1,6})|0*([0-9]{1,7}))$"


def decode_char_refs(c: Column) -> Column:
    """Numeric character references become characters; ``< > &`` stay escaped."""
    return let(c, _decoded)


def _decoded(c: Column) -> Column:
    pieces = F.split(c, "&#", -1)

    def code(reference: Column) -> Column:
        from_hex = F.conv(F.regexp_extract(reference, _REFERENCE, 1), 16, 10)
        return F.coalesce(from_hex, F.regexp_extract(reference, _REFERENCE, 2)).try_cast("int")

    def piece(text: Column, position: Column) -> Column:
        # The reference ends at a semicolon, so only what stands before one is looked at.
        reference = F.substring_index(text, ";", 1)
        parts = F.struct(
            F.when(F.length(reference) < F.length(text), code(reference)).alias("code"),
            F.substr(text, F.length(reference) + 2).alias("after"),
        )
        return F.when(position == 0, text).otherwise(let(parts, lambda p: written(text, p["code"], p["after"])))

    def written(text: Column, code: Column, after: Column) -> Column:
        character = F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")
        allowed = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        return (
            F.when(code == 0x26, F.concat(F.lit("&amp;"), after))
            .when(code == 0x3C, F.concat(F.lit("&lt;"), after))
            .when(code == 0x3E, F.concat(F.lit("&gt;"), after))
            .when(allowed, F.concat(character, after))
            .otherwise(F.concat(F.lit("&#"), text))
        )

    joined = F.array_join(F.transform(pieces, piece), "")
    return F.when(F.contains(c, F.lit("&#")), joined).otherwise(c)


def protect_markup(c: Column, tags: Iterable[str]) -> Column:
    """Keep the inner markup of mixed-content elements as raw text.

    ``from_xml`` has no type for text interleaved with elements, so wherever
    one of the tags holds markup its content is put into a CDATA section.
    Where one is left open the text stays: it is malformed anyway.
    """
    tags = list(tags)
    pattern = rf"(?s)(<((?:\w++:)?(?:{'|'.join(tags)}))(?:\s[^>]*+)?(?<!/)>)([^<]*+<(?!/\2>).*?)(</\2>)"

    def protected(x: Column) -> Column:
        return F.when(all_closed(x, tags), F.regexp_replace(x, pattern, "$1<![CDATA[$3]]>$4")).otherwise(x)

    return let(c, protected)


def siblings(c: Column, tag: str, group: str) -> Column:
    """Elements of ``tag`` at any depth brought to the level of the outermost ones.

    Each is followed by those that it held, in the order of their opening.
    What else was in a ``group`` inside it follows it too, without the group's
    own tags.  The tags are numbered in one pass over them, with the open
    elements as a stack; texts in which they do not match stay as they are.
    """
    other, is_open, is_closed, group_open, group_closed = range(5)

    def opens(piece: Column, name: str) -> Column:
        opening = rf"^<{name}(?=[\s>])[^>]*+(?<!/)>"
        return F.startswith(piece, F.lit(f"<{name}")) & F.rlike(piece, F.lit(opening))

    def kind(piece: Column) -> Column:
        return (
            F.when(piece == f"</{tag}>", is_closed)
            .when(piece == f"</{group}>", group_closed)
            .when(opens(piece, tag), is_open)
            .when(opens(piece, group), group_open)
            .otherwise(other)
        )

    def step(state: Column, kind: Column) -> Column:
        """Elements open, numbers given, and the owner of each piece; the state is copied at each step, so it holds no text."""
        opened, n, marks = state["opened"], state["n"], state["marks"]

        def after(opened: Column, n: Column, owner: Column) -> Column:
            marked = F.concat(marks, owner.cast("string"), F.lit(","))
            return F.struct(opened.alias("opened"), n.alias("n"), marked.alias("marks"))

        inside = F.size(opened) > 0
        top, below = F.element_at(opened, -1), F.slice(opened, 1, F.size(opened) - 1)
        return (
            F.when(kind == is_open, after(F.concat(opened, F.array(n)), n + 1, n))
            .when(~inside, after(opened, n + 1, n))
            # Tags of inner groups are left out: their owners are negative.
            .when(kind == group_open, after(F.concat(opened, F.array(n)), n + 1, -n))
            .when(kind == group_closed, after(below, n, -top))
            .when(kind == is_closed, after(below, n, top))
            .otherwise(after(opened, n, top))
        )

    def owned(piece: Column, mark: Column) -> Column:
        owner = mark.cast("int")
        bare = F.regexp_replace(piece, rf"^</?{group}(?:\s[^>]*+)?>", "")
        return F.struct(F.abs(owner).alias("owner"), F.when(owner < 0, bare).otherwise(piece).alias("text"))

    def flat(pieces: Column, kinds: Column) -> Column:
        start = F.struct(F.array().cast("array<int>").alias("opened"), F.lit(1).alias("n"), F.lit("").alias("marks"))
        marks = F.aggregate(kinds, start, step, lambda s: s["marks"])
        parts = F.zip_with(pieces, F.split(F.rtrim(marks, F.lit(",")), ","), owned)
        # The sort is stable: the pieces of an element keep their order.
        in_order = F.array_sort(parts, lambda a, b: a["owner"] - b["owner"])
        return F.array_join(F.transform(in_order, lambda e: e["text"]), "")

    def nested(kinds: Column) -> Column:
        tags = F.filter(kinds, lambda k: k.isin(is_open, is_closed))
        shape = F.array_join(tags.cast("array<string>"), "")
        opens = F.size(F.filter(tags, lambda k: k == is_open))
        return F.contains(shape, F.lit(f"{is_open}{is_open}")) & (2 * opens == F.length(shape))

    def cut(text: Column) -> Column:
        """Closing tags are pieces of their own, opening ones take the text behind them along."""
        x = F.regexp_replace(text, rf"<(?:{tag}|{group})(?=[\s>])", f"{_CUT}$0")
        for closing in (f"</{tag}>", f"</{group}>"):
            x = F.replace(x, F.lit(closing), F.lit(f"{_CUT}{closing}{_CUT}"))
        return F.split(F.replace(x, F.lit(_CUT * 2), F.lit(_CUT)), _CUT, -1)

    def brought(text: Column) -> Column:
        tidy = F.regexp_replace(text, rf"</({tag}|{group})\s+>", "</$1>")

        def moved(pieces: Column) -> Column:
            return let(F.transform(pieces, kind), lambda kinds: F.when(nested(kinds), flat(pieces, kinds)).otherwise(text))

        # A text with the mark in it is no XML.
        return F.when(F.contains(text, F.lit(_CUT)), text).otherwise(let(cut(tidy), moved))

    return let(c, brought)


def prepare_xml(node: Column, mixed: Iterable[str] = ()) -> Column:
    """Text that ``from_xml`` reads without loss, without namespace prefixes."""
    node = decode_char_refs(_inline_cdata(node))
    node = protect_markup(node, mixed) if mixed else node
    return F.regexp_replace(node, r"<(/?)[A-Za-z]\w*+:", "<$1")


_INLINE = (
    r"(?s)<([A-Za-z][\w:.\-]*)(?:\s[^<>]*)?(?<!/)>.*?</\1>"
    r"|<[A-Za-z][^<>]*/>|<!--.*?-->|<\?.*?\?>"
)


def direct_text(c: Column) -> Column:
    """Text pieces directly under an element, leaving out inline elements.

    ``c`` comes out of a document that was parsed, so its tags match.
    """
    pieces = F.filter(F.split(c, _INLINE, -1), lambda x: F.trim(x) != "")
    return F.when(
        F.contains(c, F.lit("<")), F.transform(pieces, lambda x: unescape_xml(x))
    ).otherwise(F.array(c))


def plain_text(c: Column) -> Column:
    """All text under an element: tags dropped, entities decoded."""
    def bare(x: Column) -> Column:
        tagged = F.regexp_replace(_up_to_last(x, ">"), r"<[!?/A-Za-z][^>]*+>", "")
        untagged = F.concat(tagged, F.substring_index(x, ">", -1))
        return F.when(F.contains(x, F.lit("<")), untagged).otherwise(x)

    return let(let(c, bare), unescape_xml)


def parse_xml(node: Column, fields_ddl: str) -> Column:
    """Parse a document into the given fields plus ``_corrupt_record``."""
    return F.from_xml(
        node,
        f"STRUCT<{' '.join(fields_ddl.split())}, _corrupt_record: STRING>",
        {
            "ignoreNamespace": "true",
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": "_corrupt_record",
        },
    )
