"""Vocabularies: terms made from templates per model, and the check before an installed vocabulary is replaced."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import filled


@dataclass(frozen=True)
class FieldTemplate:
    """What every model gets one term for; labels and comments by language, with {label} and {model_id}."""

    suffix: str
    labels: dict[str, str]
    comments: dict[str, str]
    kind: str = "owl:ObjectProperty"
    values: str | None = None  # the type of literals


def definitions(members: DataFrame, fields: Sequence[FieldTemplate]) -> DataFrame:
    """members (prefix, label, model_id): one row per member, field and language: term, place, lang, label, comment, kind, values.

    ``place`` is the field's.  A template's braces that are no known name stay
    as they are; a null label or model id counts as empty.
    """
    known = {"label": F.col("label"), "model_id": F.col("model_id")}
    rows = [
        F.struct(
            F.concat("prefix", F.lit(f.suffix)).alias("term"),
            F.lit(place).alias("place"),
            F.lit(lang).alias("lang"),
            filled(f.labels[lang], known).alias("label"),
            filled(f.comments[lang], known).alias("comment"),
            F.lit(f.kind).alias("kind"),
            F.lit(f.values).cast("string").alias("values"),
        )
        for place, f in enumerate(fields)
        for lang in sorted(f.labels)
    ]
    return members.select(F.explode(F.array(*rows)).alias("d")).select("d.*")


def replacement(installed: DataFrame, declared: DataFrame, values: DataFrame) -> DataFrame:
    """What replacing a vocabulary would do: name, change (would_delete or would_add), items that hold values under it.

    installed: name, property_id; declared: name; values: property_id, item_id.
    Repeated names count once, null names not at all.  Values are counted for
    the properties to be deleted only, and an item once per property.
    """
    have = installed.filter("name is not null").groupBy("name").agg(F.min("property_id").alias("property_id"))
    want = declared.filter("name is not null").select("name").distinct()
    gone = have.join(want, "name", "left_anti")
    held = values.join(gone.select("property_id"), "property_id", "left_semi").groupBy("property_id").agg(F.countDistinct("item_id").alias("items"))
    gone = gone.join(held, "property_id", "left").select("name", F.lit("would_delete").alias("change"), F.coalesce("items", F.lit(0).cast("long")).alias("items"))
    new = want.join(have, "name", "left_anti").select("name", F.lit("would_add").alias("change"), F.lit(0).cast("long").alias("items"))
    return gone.unionByName(new)


class PopulatedTerms(ValueError):
    """The replacement would destroy values."""


def refuse_populated(changes: DataFrame, shown: int = 20) -> None:
    """Raises where a term that would be deleted holds values; deleting empty ones is allowed, on that evidence alone."""
    lost = changes.filter("change = 'would_delete' and items > 0")
    if some := lost.orderBy(F.desc("items"), "name").limit(shown).collect():
        raise PopulatedTerms(f"{lost.count()} terms to be deleted hold values: " + ", ".join(f"{r['name']} ({r['items']} items)" for r in some))
