"""Parsing of reservation labels and affiliate names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns and values of the source systems.
LABEL_UNIT = r"hotel[-](.*)[_]xqdz"
LABEL_LOCALE = r"[-]core(.*)[-]hotel"
LABEL_MOBILE = r"(linkmob[-]core.*[-]hotel)"
NAME_MOBILE = r"(Mobile)"
NAME_CORE = r"([_][Cc]ore[.])"
NAME_PARTS = r"^(.*)[.](.*)[.].*"
DEFAULT_LOCALE = "US"
PLACEMENT_CODES = {"LU": "localuniversal", "MR": "mapresults"}
DEVICE_CODES = {"PC": "desktop", "Mobile": "mobile", "Tablet": "tablet"}
PLACEMENT_WORDS = ["mapresults", "localuniversal"]


def int_or_null(text: Column) -> Column:
    return F.nullif(text, F.lit("")).try_cast("int")


def unit_of(label: Column, fallback: Column) -> Column:
    """Unit id in the label (last click), or else the id on the reservation."""
    return F.coalesce(int_or_null(F.regexp_extract(label, LABEL_UNIT, 1)), fallback.cast("int"))


def locale_of(label: Column) -> Column:
    found = F.regexp_extract(label, LABEL_LOCALE, 1)
    return F.when(F.length(found) > 0, F.upper(found)).otherwise(F.lit(DEFAULT_LOCALE))


def device_of(label: Column, affiliate_name: Column) -> Column:
    mobile = F.lit("mobile")
    return (
        F.when(label.rlike(LABEL_MOBILE), mobile).when(affiliate_name.rlike(NAME_MOBILE), mobile).otherwise(F.lit("web"))
    )


def name_part(affiliate_name: Column, part: int) -> Column:
    """Distribution (1) or placement (2) of a name such as ``US.DMeta.x``; '' when it has no parts."""
    return F.regexp_extract(affiliate_name, NAME_PARTS, part)


def silo_pattern(placements) -> str:
    return f"(.*)({'|'.join(placements)})"


def _decode(code: Column, codes: dict[str, str]) -> Column:
    return F.coalesce(*[F.when(code == k, F.lit(v)) for k, v in codes.items()])


def affiliate_info(name: Column, kind: str) -> Column:
    """Country code ('cc'), 'placement' or 'device' of a name such as ``x_US.LU.PC``; NULL if absent."""
    parts = F.split(name, "[.]")
    if kind == "cc":
        return F.get(F.split(F.get(parts, F.lit(0)), "_"), F.lit(1))
    if kind == "placement":
        return _decode(F.get(parts, F.lit(1)), PLACEMENT_CODES)
    if kind == "device":
        return _decode(F.get(parts, F.lit(2)), DEVICE_CODES)
    return F.lit(None).cast("string")


def label_value(label: Column, key: str) -> Column:
    """Value of the last ``key-value`` token of a label, without building the whole map."""
    return F.substring_index(F.try_element_at(F.filter(F.split(label, "_"), lambda t: t.rlike(f"^{key}-[^-]*$")), F.lit(-1)), "-", -1)


def label_map(label: Column) -> Column:
    """All information in a label as a map; NULL for a NULL label.

    Tokens of the form ``key-value`` become entries. Other tokens give the placement when they
    mention one, and the unit id when they contain ``hotel-``. The last token wins.
    """
    def entry(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    def entries(token: Column) -> Column:
        lower = F.lower(token)
        pair = F.split(token, "-")
        placement = F.coalesce(*[F.when(F.contains(lower, F.lit(w)), F.lit(w)) for w in PLACEMENT_WORDS])
        unit = F.get(F.split(token, "hotel-"), F.lit(1))
        other = F.array(
            F.when(placement.isNotNull(), entry("placement", placement)),
            F.when(F.contains(lower, F.lit("hotel-")), entry("hotel_id", unit)),
        )
        as_pair = F.struct(F.get(pair, F.lit(0)).alias("key"), F.get(pair, F.lit(1)).alias("value"))
        return F.when(F.size(pair) == 2, F.array(as_pair)).otherwise(other)

    found = F.filter(F.flatten(F.transform(F.split(label, "_"), entries)), lambda e: e.isNotNull())
    # Scan from the last entry on and keep the first one seen of every key.
    empty = F.array().cast("array<struct<key:string,value:string>>")
    last = F.aggregate(
        F.reverse(found), empty,
        lambda kept, e: F.when(F.exists(kept, lambda k: k["key"] == e["key"]), kept).otherwise(
            F.concat(kept, F.array(e).cast("array<struct<key:string,value:string>>"))
        ),
    )
    return F.map_from_entries(last)
