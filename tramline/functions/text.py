"""Text normalisation and label columns, all native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tramline import schemas


# Whitespace in the Unicode sense: ASCII controls and separators, then the spaces
# and line marks beyond ASCII.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove any leading and trailing whitespace (plain ``trim`` removes spaces only)."""
    return F.trim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return strip(c) == ""


def clean_text(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def lookup(c: Column, table: dict, default: Column) -> Column:
    """A small fixed dictionary as a CASE chain, so no join is needed."""
    keys = list(table)
    out = F.when(c == F.lit(keys[0]), F.lit(table[keys[0]]))
    for key in keys[1:]:
        out = out.when(c == F.lit(key), F.lit(table[key]))
    return out.otherwise(default)


def transport_label(route_type: Column) -> Column:
    return lookup(route_type, schemas.TRANSPORT, F.lit(schemas.TRANSPORT_OTHER))


def route_type_name(route_type: Column) -> Column:
    code = route_type.cast("string")
    return lookup(code, schemas.ROUTE_TYPE_NAMES, F.concat(F.lit("Tipo "), code))


def metro_color(name: Column) -> Column:
    return lookup(name, schemas.METRO_COLORS, F.lit(schemas.METRO_OTHER))


def bus_color(name: Column) -> Column:
    return lookup(
        F.substring(strip(name), 1, 1),
        schemas.BUS_PREFIX_COLORS,
        F.lit(schemas.BUS_OTHER),
    )
