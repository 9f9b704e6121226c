"""Author names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sheaf.functions.arrays import let
from sheaf.functions.text import clean_affiliation, strip, title_case


def collapse_initials(c: Column) -> Column:
    """``T. A.`` becomes ``T.A.``"""
    return F.regexp_replace(c, r"([A-Z]\.)[\s\-]+(?=[A-Z]\.)", "$1")


def split_fullname(c: Column, switch_name_order: bool = False) -> Column:
    """Surname and given names of a full name.

    The surname comes first when the name has a comma, last otherwise;
    ``switch_name_order`` turns both round.
    """
    has_comma = F.contains(c, F.lit(","))
    surname_first = ~has_comma if switch_name_order else has_comma
    tokens = F.when(has_comma, F.transform(F.split(c, ",", -1), strip)).otherwise(
        F.split(strip(c), r"(?U)\s+", -1)
    )

    def split(t: Column) -> Column:
        rest = F.when(surname_first, F.slice(t, F.lit(2), F.size(t))).otherwise(
            F.slice(t, F.lit(1), F.size(t) - 1)
        )
        surname = F.try_element_at(t, F.when(surname_first, 1).otherwise(-1))
        return F.struct(surname.alias("surname"), F.array_join(rest, " ").alias("given_names"))

    empty = F.struct(F.lit("").alias("surname"), F.lit("").alias("given_names"))
    return F.when(F.coalesce(c, F.lit("")) == "", empty).otherwise(let(tokens, split))


def full_name(surname: Column, given_names: Column) -> Column:
    return _full_name(surname, collapse_initials(given_names))


def _full_name(surname: Column, initials: Column) -> Column:
    """Of given names whose initials are collapsed; these are never empty where the names are not."""
    has_given = F.coalesce(initials, F.lit("")) != ""
    return F.when(has_given, F.concat(surname, F.lit(", "), initials)).otherwise(surname)


def titled_full_name(name: Column, surname: Column, given_names: Column) -> Column:
    """An existing full name, or one made from its parts in title case."""
    made = F.concat(surname, F.lit(", "), collapse_initials(given_names))
    return F.coalesce(name, title_case(made))


def affiliation(value: Column) -> Column:
    null = F.lit(None).cast("string")
    return full_affiliation(value, null, null)


def full_affiliation(value: Column, organization: Column, country: Column) -> Column:
    return F.struct(
        value.alias("value"), organization.alias("organization"), country.alias("country")
    )


def author(
    affiliations: Column,
    surname: Column | None = None,
    given_names: Column | None = None,
    raw_name: Column | None = None,
    email: Column | None = None,
    orcid: Column | None = None,
) -> Column:
    """An author as parsers emit it; ``normalise_author`` fills the rest.

    A source that only knows whole names passes ``raw_name`` alone.
    """
    null = F.lit(None).cast("string")

    def text(c: Column | None) -> Column:
        return null if c is None else c.cast("string")

    return F.struct(
        text(surname).alias("surname"),
        text(given_names).alias("given_names"),
        text(raw_name).alias("raw_name"),
        text(email).alias("email"),
        text(orcid).alias("orcid"),
        affiliations.alias("affiliations"),
    )


def normalise_author(a: Column) -> Column:
    """Complete an author's name parts and clean the affiliations."""
    given_parts = F.struct(a["surname"].alias("surname"), a["given_names"].alias("given_names"))
    derived = a["surname"].isNull() & a["raw_name"].isNotNull()
    parts = F.when(derived, split_fullname(a["raw_name"])).otherwise(given_parts)

    def collapsed(p: Column) -> Column:
        return F.struct(p["surname"].alias("surname"), collapse_initials(p["given_names"]).alias("given_names"))

    def complete(p: Column) -> Column:
        return F.struct(
            p["surname"].alias("surname"),
            p["given_names"].alias("given_names"),
            _full_name(p["surname"], p["given_names"]).alias("full_name"),
            a["raw_name"].alias("raw_name"),
            a["email"].alias("email"),
            a["orcid"].alias("orcid"),
            F.transform(
                a["affiliations"],
                lambda x: full_affiliation(
                    clean_affiliation(x["value"]), x["organization"], x["country"]
                ),
            ).alias("affiliations"),
        )

    return let(let(parts, collapsed), complete)


def thesis_supervisor(a: Column) -> Column:
    """Supervisors keep the full name and the first affiliation only."""
    done = normalise_author(a)
    return F.struct(
        done["full_name"].alias("full_name"),
        F.try_element_at(done["affiliations"], F.lit(1))["value"].alias("affiliation"),
    )
