"""Sources by name: how a feed is split, parsed and defaulted."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from sheaf.parsers import aps, elsevier, iop, marc, nlm, oup, springer
from sheaf.plans.normalise import FieldRule


@dataclass(frozen=True)
class SourceSpec:
    """A source of documents.

    ``parse`` maps a document table to raw fields.  ``tags`` name the elements
    one landed file is split into; none means one document per file.  Of a
    feed whose other tags begin with the name of its tag, ``bare_tag`` says
    that this one has no attributes.
    ``kind`` says how files land: ``feed`` (many records in one text file),
    ``page`` (one JSON page per file) or ``package`` (zip or tar archives, of
    which members that ``member_suffixes`` end are documents).
    """

    name: str
    parse: Callable[..., DataFrame]
    kind: str = "page"
    tags: tuple[str, ...] = ()
    bare_tag: bool = False
    member_suffixes: tuple[str, ...] = (".xml",)
    route: Callable[[DataFrame], DataFrame] | None = None
    needs_manifest: bool = False
    defaults: Mapping[str, object] = field(default_factory=dict)
    rules: Mapping[str, FieldRule] = field(default_factory=dict)


_SOURCES: dict[str, SourceSpec] = {}


def register_source(spec: SourceSpec) -> SourceSpec:
    _SOURCES[spec.name] = spec
    return spec


def source(name: str) -> SourceSpec:
    try:
        return _SOURCES[name]
    except KeyError:
        raise KeyError(f"unknown source {name!r}; known: {', '.join(sorted(_SOURCES))}") from None


def sources() -> list[str]:
    return sorted(_SOURCES)


def _register_publishers() -> None:
    from sheaf.sources import landing

    register_source(SourceSpec("APS", aps.parse, kind="page"))
    register_source(
        SourceSpec("hindawi", marc.parse_hindawi, kind="feed", tags=("marc:record",))
    )
    register_source(
        SourceSpec("repository", marc.parse_repository, kind="feed", tags=("marc:record",))
    )
    register_source(SourceSpec("NLM", nlm.parse, kind="feed", tags=("Article",), bare_tag=True))
    register_source(
        SourceSpec("OUP", oup.parse, kind="package", route=landing.route_oup)
    )
    register_source(
        SourceSpec("IOP", iop.parse, kind="package", route=landing.route_iop)
    )
    register_source(
        SourceSpec(
            "Springer",
            springer.parse,
            kind="package",
            member_suffixes=(),
            route=landing.route_springer,
        )
    )
    register_source(
        SourceSpec("Elsevier", elsevier.parse, kind="package", needs_manifest=True)
    )


_register_publishers()
