"""Catalogue records (item_id, raw JSON) as a long table of values, and selections of items."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTRY = "`@value` string, `@language` string, `@id` string, type string, property_id long, value_resource_id long, display_title string"


def _field(name: str) -> Column:
    return F.get_json_object("raw", f"$['{name}']")


def _ids(name: str) -> Column:
    """Ids of a list of references, by o:id or the end of @id; anything else is left out."""
    refs = F.from_json(_field(name), "array<string>")
    return F.filter(F.transform(refs, ref_id), lambda x: x.isNotNull())


def ref_id(ref: Column) -> Column:
    """Id of a reference: a number, a string of digits, or an object or address that ends in /items/N or /resources/N."""
    own = F.coalesce(F.get_json_object(ref, "$['o:id']"), F.get_json_object(ref, "$['@id']"), ref)
    return F.coalesce(own.try_cast("long"), F.nullif(F.regexp_extract(own, r"/(?:items|resources)/([0-9]+)$", 1), F.lit("")).try_cast("long"))


def long_values(items: DataFrame) -> DataFrame:
    """items (item_id, raw) as item_id, term, pos, type, property_id, value, lang, uri, link_id, display_title; entries that are no objects are left out."""
    fields = items.select("item_id", F.explode(F.from_json("raw", "map<string,string>")).alias("term", "_v")).filter("_v like '[%'")
    each = fields.select("item_id", "term", F.posexplode(F.from_json("_v", "array<string>")).alias("pos", "_e")).filter("_e like '{%'")
    e = F.from_json("_e", ENTRY)
    named = {"type": "type", "property_id": "property_id", "@value": "value", "@language": "lang", "@id": "uri", "value_resource_id": "link_id", "display_title": "display_title"}
    return each.select("item_id", "term", "pos", e.alias("e")).select("item_id", "term", "pos", *(F.col(f"e.`{k}`").alias(v) for k, v in named.items()))


def with_facets(items: DataFrame) -> DataFrame:
    """items with sets, media (arrays of ids), classes (array of names), template (id) read from raw."""
    return items.withColumns({"sets": _ids("o:item_set"), "media": _ids("o:media"), "classes": F.from_json(_field("@type"), "array<string>"), "template": ref_id(_field("o:resource_template"))})


def of_sets(items: DataFrame, sets: list[int]) -> DataFrame:
    """Items of each set in turn: an item of two sets comes twice, with set_id."""
    return items.select("*", F.explode("sets").alias("set_id")).filter(F.col("set_id").isin(*sets))


def of_class(items: DataFrame, name: str) -> DataFrame:
    return items.filter(F.coalesce(F.array_contains("classes", name), F.lit(False)))


def of_template(items: DataFrame, template: int) -> DataFrame:
    return items.filter(F.col("template") == template)


def parse_ids(text: str, lines: list[str] | None = None) -> list[int]:
    """Ids in a list by commas or spaces, each once, in order; ``lines`` stand in for a list in a file (@name). None, or a word that is no number, raises."""
    words = [w for part in ([text] if lines is None else lines) for w in re.split(r"[,\s]+", part) if w]
    bad = [w for w in words if not w.isdecimal()]
    if bad or not words:
        raise ValueError(f"no ids: {', '.join(bad)}" if bad else "no ids")
    return list(dict.fromkeys(map(int, words)))


def by_ids(items: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items found, ids without an item)."""
    return items.join(ids.select("item_id").distinct(), "item_id", "left_semi"), ids.join(items.select("item_id"), "item_id", "left_anti")


def having(items: DataFrame, values: DataFrame, property_id: int, value: str | None = None) -> DataFrame:
    """Items with some value of a property, or with one that equals ``value``."""
    hit = values.filter(F.col("property_id") == property_id)
    return items.join(hit if value is None else hit.filter(F.col("value") == value), "item_id", "left_semi")


def property_counts(values: DataFrame) -> DataFrame:
    """How many items and values each term has."""
    return values.groupBy("term").agg(F.count_distinct("item_id").alias("items"), F.count(F.lit(1)).alias("values"))


def resolve_terms(vocabulary: DataFrame, terms: list[str]) -> dict[str, int]:
    """Ids of terms (vocabulary: term, id); one that is not there raises, naming all that lack."""
    got = {r["term"]: r["id"] for r in vocabulary.filter(F.col("term").isin(*terms)).collect()}
    lacking = [t for t in terms if t not in got]
    if lacking:
        raise ValueError(f"unknown terms: {', '.join(lacking)}")
    return got


def with_resource(refs: DataFrame, resources: DataFrame, items: DataFrame, columns: list[str]) -> DataFrame:
    """refs (item_id) with columns of the resource of that id, or else of the item."""
    side = lambda df, x: df.select("item_id", F.lit(True).alias(f"_{x}"), *(F.col(c).alias(f"_{x}{c}") for c in columns))
    both = refs.join(side(resources, "r"), "item_id", "left").join(side(items, "i"), "item_id", "left")
    return both.select(*refs.columns, *(F.when(F.col("_r"), F.col(f"_r{c}")).otherwise(F.col(f"_i{c}")).alias(c) for c in columns))


def back_links(items: DataFrame, term: str) -> DataFrame:
    """item_id, pos, ref (JSON), ref_id of the entries of @reverse under a term."""
    refs = F.from_json(F.get_json_object("raw", f"$['@reverse']['{term}']"), "array<string>")
    return items.select("item_id", F.posexplode(refs).alias("pos", "ref")).withColumn("ref_id", ref_id(F.col("ref")))


def set_country(items: DataFrame, set_countries: DataFrame) -> DataFrame:
    """items with country: their own, else that of their first set (set_countries: set_id, country), else null."""
    own = items.withColumn("_s", F.get("sets", F.lit(0)))
    return own.join(set_countries.select(F.col("set_id").alias("_s"), F.col("country").alias("_c")), "_s", "left").withColumn("country", F.coalesce(F.nullif(F.col("country"), F.lit("")), "_c")).select(*items.columns)
