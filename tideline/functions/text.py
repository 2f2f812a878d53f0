"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lower_trim(col: Column) -> Column:
    return F.lower(F.trim(col))


def sanitize_text(col: Column) -> Column:
    """Lower case, runs of anything but ``a-z0-9`` become one ``_``; null is ``none``."""
    words = F.trim(F.regexp_replace(F.lower(col), "[^a-z0-9]+", " "))
    return F.coalesce(F.replace(words, F.lit(" "), F.lit("_")), F.lit("none"))


def sanitize_name(name: str) -> str:
    """Column-name form: every run outside ``A-Za-z0-9_`` becomes one ``_``."""
    import re

    return re.sub(r"[^A-Za-z0-9_]+", "_", name)


def human_duration(ms: Column) -> Column:
    """Milliseconds as the two largest non-zero units, e.g. ``1 days 2 hours``.

    Null and anything below one second is ``0 seconds``; a text column gives an
    empty string.  Days are floored, so a negative duration shows the
    remainder of its day without a day part.
    """
    seconds = F.floor(ms.try_cast("double") / 1000)
    days = F.floor(seconds / 86400)
    rest = seconds - days * 86400

    def part(amount: Column, unit: str) -> Column:
        return F.when(amount > 0, F.concat_ws(" ", amount.cast("string"), F.lit(unit)))

    units = F.array_compact(
        F.array(
            part(days, "days"),
            part(F.floor(rest / 3600), "hours"),
            part(F.floor(F.pmod(rest, F.lit(3600)) / 60), "minutes"),
            part(F.pmod(rest, F.lit(60)), "seconds"),
        )
    )
    shown = F.array_join(F.slice(units, 1, 2), " ")
    return (
        F.when(ms.isNull(), "0 seconds")
        .when(F.typeof(ms) == "string", "")
        .when(shown == "", "0 seconds")
        .otherwise(shown)
    )


def list_items(col: Column, separator: str = ";") -> Column:
    """A delimited list as an array; null becomes one empty item."""
    return F.split(F.coalesce(col, F.lit("")), separator, -1)


def before(col: Column, separator: str) -> Column:
    """The part in front of the first separator."""
    return F.get(F.split(col, separator, -1), F.lit(0))


def map_values(col: Column, mapping: dict, default: Column | None = None) -> Column:
    """Dictionary lookup on literal pairs; an unknown key gives ``default`` (null)."""
    pairs = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.try_element_at(pairs, col)
    return found if default is None else F.coalesce(found, default)


def replace_values(col: Column, mapping: dict, textual: bool = True) -> Column:
    """Replace listed values, keep the others.

    Text is lower-cased before the lookup and after it, so replaced values end
    up in lower case too.
    """
    if not textual:
        return map_values(col, mapping, col)
    low = F.lower(col)
    return F.lower(map_values(low, mapping, low))


def merge_value(col: Column, old: str, new: str) -> Column:
    return F.when(col == old, new).otherwise(col)


def location_key(region: Column, region_fallback: Column, country: Column) -> Column:
    """``region_country`` in lower case; null when the country is null."""
    place = F.coalesce(F.lower(region), F.lower(region_fallback), F.lit(""))
    return F.concat(place, F.lit("_"), F.lower(country))


def leading_digit(number: Column) -> Column:
    """First character of the number's text as an integer: ``12.0`` gives 1."""
    return F.substring(F.trim(number.cast("string"), F.lit(".")), 1, 1).try_cast("int")


def whole_number(number: Column) -> Column:
    """The variant of :func:`leading_digit` that keeps the full integer part."""
    return number.try_cast("int")
