"""String, number and array cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number in road tags; Spark alone would also read "50d" or "NaN".
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def list_text_items(text: Column) -> Column:
    """Items of a list kept as text, such as ``"['a', 'b']"`` or ``"[1,2]"``; plain text is one item."""
    bare = F.regexp_replace(text, r"[\[\]'\"]", "")
    items = F.filter(F.transform(F.split(bare, ","), lambda s: F.trim(s)), lambda s: s != "")
    single = F.array(text)
    missing = text.isNull() | text.isin("", "nan")
    return F.when(~missing, F.when(text.contains("["), items).otherwise(single))


def clean_speed_limit(text: Column) -> Column:
    """Speed limit as a number: the least of a list, NULL when any item is not a number."""
    items = F.transform(list_text_items(text), lambda s: F.trim(s))
    numeric = F.forall(items, lambda s: s.rlike(_NUMBER))
    return F.when(numeric, F.array_min(F.transform(items, lambda s: s.try_cast("double"))))


def segment_id(osmid: Column, chunk: Column) -> Column:
    return F.concat(osmid, F.lit("_"), chunk.cast("string"))


def snapshot_key(source_updated: Column) -> Column:
    """Folder-safe key of a snapshot time text; NULL gets the default key."""
    safe = F.translate(source_updated.cast("string"), " :", "_-")
    return F.coalesce(safe, F.lit("unknown_time"))


def lenient_boolean(value: Column) -> Column:
    """A flag out of a boolean or text column: true, t and 1 in any case, everything else false."""
    return F.coalesce(F.lower(value.cast("string")).isin("true", "t", "1"), F.lit(False))


def lenient_boolean_number(value: Column) -> Column:
    """A flag out of a numeric column: every number but 0."""
    return F.coalesce(value != 0, F.lit(False))


def hex_colour(text: Column) -> Column:
    """``#RRGGBB`` or ``#AARRGGBB`` as an ARGB number; full alpha when none is given, else NULL."""
    trimmed = F.trim(text)
    at = F.instr(trimmed, "#")
    digits = F.when(at > 0, F.overlay(trimmed, F.lit(""), at, F.lit(1))).otherwise(trimmed)
    full = F.when(F.length(digits) == 6, F.concat(F.lit("FF"), digits)).otherwise(digits)
    return F.when(full.rlike("^[0-9a-fA-F]{8}$"), F.conv(full, 16, 10).cast("bigint"))


def short_time(text: Column) -> Column:
    """``H:mm`` of an ISO time text, or the text itself when it is no time."""
    return F.coalesce(F.date_format(F.try_to_timestamp(text), "H:mm"), text)


def one_decimal(value: Column) -> Column:
    """One decimal place by the number's exact binary value, exact halves away from zero; NULL shows as 0.0."""
    x = F.coalesce(value.cast("double"), F.lit(0.0))
    # Only quarters can be exact halves; the formatter would round those to even.
    nudged = F.when(x * 4 == F.floor(x * 4), x + F.signum(x) * 0.01).otherwise(x)
    return F.call_function("format_number", nudged, F.lit("0.0"))
