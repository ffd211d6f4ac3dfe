"""Column expressions over text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions import numeric

# Chat-role tokens taken out of free text. The first form ends in a word
# boundary after the token, so "user: hi" keeps its token; the second form drops that rule.
# Word boundaries and case follow Unicode.
ROLE_TOKENS = r"(?iU)\b(system:|user:|assistant:|<\/?(system|user|assistant)>|\\n\\n)\b"
ROLE_TOKENS_LOOSE = r"(?iU)(\b(system|user|assistant):|<\/?(system|user|assistant)>|\\n\\n)"


def sanitise(text: Column, max_len: int = 256, pattern: str = ROLE_TOKENS) -> Column:
    """Blank out role tokens, then keep at most ``max_len`` characters; null becomes ''."""
    return F.coalesce(F.substring(F.regexp_replace(text, pattern, " "), 1, max_len), F.lit(""))


def apply_limits(df: DataFrame, limits: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """Apply a per-column limit spec such as ``{"price": {"min": 0}, "note": {"max_len": 64}}``.

    A column is text when the spec says so or its type is string, a number when the spec says
    so or its type is numeric; specs of absent columns are ignored.
    """
    changed: dict[str, Column] = {}
    for field in df.schema.fields:
        spec = limits.get(field.name)
        if spec is None:
            continue
        col = F.col(field.name)
        if spec.get("type") == "text" or isinstance(field.dataType, T.StringType):
            changed[field.name] = sanitise(col.cast("string"), int(spec.get("max_len", 256)))
        elif spec.get("type") == "number" or isinstance(field.dataType, T.NumericType):
            changed[field.name] = numeric.clip(col.cast("double"), spec.get("min"), spec.get("max"))
    return df.withColumns(changed) if changed else df


def store_number(label: Column, default: int = 1) -> Column:
    """'Store 12' or '12' to 12."""
    digits = F.regexp_extract(label, r"(\d+)", 1)
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("int"), F.lit(default))


# Family spellings mapped to one name.
FAMILY_ALIASES = {"HOME AND KITCHEN": "HOME AND GARDEN", "BREADORBAKERY": "BREAD/BAKERY"}


def normalise_family(
    name: Column,
    known: list[str] | None = None,
    default: str = "PRODUCE",
    aliases: Mapping[str, str] = FAMILY_ALIASES,
) -> Column:
    """Upper-case, trim, resolve aliases; a name outside ``known`` becomes ``default``."""
    clean = F.upper(F.trim(name))
    if aliases:
        table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
        clean = F.coalesce(F.try_element_at(table, clean), clean)
    if known is None:
        return F.coalesce(clean, F.lit(default))
    return F.when(clean.isin(known), clean).otherwise(F.lit(default))


# Share of a forecast credited to the product family, first keyword wins.
FAMILY_SHARE = {
    "PRODUCE": 0.18,
    "GROCERY": 0.15,
    "BEVERAGES": 0.13,
    "BREAD": 0.12,
    "BAKERY": 0.12,
    "DAIRY": 0.11,
    "CLEANING": 0.09,
    "BEAUTY": 0.07,
}
FAMILY_SHARE_DEFAULT = 0.10


def family_share(family: Column) -> Column:
    return numeric.first_match(family, FAMILY_SHARE, FAMILY_SHARE_DEFAULT)


def prediction_id(store: Column, family: Column, day: Column) -> Column:
    return F.concat_ws("-", store.cast("string"), family, F.date_format(day, "yyyy-MM-dd"))


def code_point_score(name: Column) -> Column:
    """Sum of the code points of a name, modulo 100."""
    points = F.transform(F.split(name, ""), F.ascii)
    return (F.aggregate(points, F.lit(0), lambda total, p: total + p) % 100).cast("int")
