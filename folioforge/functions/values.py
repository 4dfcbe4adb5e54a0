"""Choosing a value from an array of structs (value, lang, ...): several rules, kept apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def french_or_first(values: Column) -> Column:
    """The first value tagged fr, even an empty one; else the first value; else the empty string."""
    tagged = F.filter(values, lambda v: v["lang"] == "fr")
    return F.when(F.size(tagged) > 0, F.coalesce(F.get(tagged, F.lit(0))["value"], F.lit(""))).otherwise(F.coalesce(F.get(values, F.lit(0))["value"], F.lit("")))


def first_literal(values: Column) -> Column:
    """The first entry that has a value, trimmed, whatever its language; else null."""
    return F.trim(F.get(F.filter(values, lambda v: v["value"].isNotNull()), F.lit(0))["value"])


def summary_in(values: Column, lang: str) -> Column:
    """The first non-blank value of a language; an untagged one answers for fr only."""
    mine = F.filter(values, lambda v: (v["lang"] == lang) & (F.trim(v["value"]) != ""))
    found = F.get(mine, F.lit(0))["value"]
    if lang != "fr":
        return found
    return F.coalesce(found, F.get(F.filter(values, lambda v: v["lang"].isNull() & (F.trim(v["value"]) != "")), F.lit(0))["value"])


def joined_literals(values: Column) -> Column:
    """All non-blank values on lines of their own; null if there are none."""
    return F.nullif(F.array_join(F.transform(F.filter(values, lambda v: F.trim(v["value"]) != ""), lambda v: v["value"]), "\n"), F.lit(""))


def linked_ids(values: Column) -> Column:
    """Ids of the linked entries, in order, joined by |."""
    return F.array_join(F.transform(F.filter(values, lambda v: v["id"].isNotNull()), lambda v: v["id"].cast("string")), "|")


def shown_first(values: Column) -> Column:
    """What the first entry that has anything shows: its display title, else its value, else its address; blank ones are passed over, else null."""
    one = lambda v: F.coalesce(F.nullif(v["title"], F.lit("")), F.nullif(v["value"], F.lit("")), F.nullif(v["uri"], F.lit("")))
    return F.get(F.filter(F.transform(values, one), lambda x: x.isNotNull()), F.lit(0))


def label_of_language(values: Column) -> Column:
    """The trimmed display title or value of the first entry that has one; null means untagged, which is no language."""
    one = lambda v: F.nullif(F.trim(F.coalesce(F.nullif(v["title"], F.lit("")), v["value"])), F.lit(""))
    return F.get(F.filter(F.transform(values, one), lambda x: x.isNotNull()), F.lit(0))
