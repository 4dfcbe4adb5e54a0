"""Idempotent updates: literals, links, and their statuses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ["updated", "would_update", "unchanged", "empty", "not_found", "failed"]


def upsert_literal(values: Column, text: Column, lang: Column | None = None, adopt_untagged: bool = False) -> Column:
    """values (array<struct<value, lang>>) with text written to the literal it owns.

    Owned: the first literal of the same language, or, where allowed, the first
    untagged one; without a language the first of all.  No owned literal:
    appended.  A blank text changes nothing.
    """
    tag = F.lit(None).cast("string") if lang is None else lang
    values = F.coalesce(values, F.array().cast("array<struct<value:string,lang:string>>"))
    spot = F.transform(values, lambda v, i: F.when(F.lit(True) if lang is None else v["lang"] == tag, i))
    loose = F.transform(values, lambda v, i: F.when(v["lang"].isNull(), i))
    own = F.array_min(spot)
    if adopt_untagged:
        own = F.coalesce(own, F.array_min(loose))
    item = F.struct(text.alias("value"), tag.alias("lang"))
    written = F.transform(values, lambda v, i: F.when(i == own, item).otherwise(v))
    return F.when(F.trim(F.coalesce(text, F.lit(""))) == "", values).when(own.isNull(), F.concat(values, F.array(item))).otherwise(written)


def literal_status(before: Column, after: Column, text: Column, found: Column, dry_run: bool) -> Column:
    blank = F.trim(F.coalesce(text, F.lit(""))) == ""
    return F.when(~found, "not_found").when(blank, "empty").when(before == after, "unchanged").otherwise("would_update" if dry_run else "updated")


def append_links(existing: Column, new: Column) -> Column:
    """existing plus those of new it lacks, each once, in order."""
    have = F.coalesce(existing, F.array().cast("array<bigint>"))
    return F.concat(have, F.array_except(F.coalesce(new, F.array().cast("array<bigint>")), have))


def resource_ids(text: Column) -> Column:
    """Ids of a list by |; blank parts and those that are no whole number are left out."""
    sound = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\|", -1), lambda x: F.trim(x)), lambda x: x.rlike("^[+-]?[0-9]+$"))
    return F.filter(F.transform(sound, lambda x: x.try_cast("long")), lambda x: x.isNotNull())


def link_updates(updates: DataFrame, links: DataFrame, items: DataFrame, dry_run: bool, sent: DataFrame | None = None) -> DataFrame:
    """item_id (as given), term, after, added, status for updates (item_id string, term, ids: a list by |).

    links (item_id, term, links array<bigint>): what items (item_id) hold now.
    An item's status goes by all its terms: invalid_id, not_found, unchanged,
    would_update in a dry run, else failed where ``sent`` (item_id of records
    that were taken) lacks it, else updated.  (item_id, term) must be unique in
    updates and links.
    """
    number = F.when(F.trim("item_id").rlike("^[+-]?[0-9]+$"), F.trim("item_id").try_cast("long"))
    asked = updates.select(F.col("item_id").alias("_given"), number.alias("item_id"), "term", resource_ids(F.col("ids")).alias("_new"))
    known = items.select("item_id").distinct().withColumn("_there", F.lit(True))
    out = asked.join(known, "item_id", "left").join(links.select("item_id", "term", "links"), ["item_id", "term"], "left")
    have = F.coalesce("links", F.array().cast("array<bigint>"))
    out = out.withColumn("after", append_links(have, F.array_distinct("_new"))).withColumn("added", (F.size("after") - F.size(have)).cast("long"))
    of_item = out.groupBy(F.col("_given").alias("_g")).agg(F.sum("added").alias("_all"))
    out = out.join(of_item, F.col("_given").eqNullSafe(F.col("_g")))
    taken = F.lit(True)
    if sent is not None:
        out = out.join(sent.select("item_id").distinct().withColumn("_sent", F.lit(True)), "item_id", "left")
        taken = F.coalesce("_sent", F.lit(False))
    status = F.when(F.col("item_id").isNull(), "invalid_id").when(F.col("_there").isNull(), "not_found").when(F.col("_all") == 0, "unchanged")
    status = status.when(F.lit(dry_run), "would_update").when(~taken, "failed").otherwise("updated")
    return out.select(F.col("_given").alias("item_id"), "term", "after", "added", status.alias("status"))


def links_by_term(updates: DataFrame) -> DataFrame:
    """How many links rows of ``link_updates`` add per term; only items updated, or that would be, count."""
    counted = F.when(F.col("status").isin("updated", "would_update"), F.col("added")).otherwise(0)
    return updates.groupBy("term").agg(F.sum(counted).alias("added"))


def label_ids(ratings: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """ratings (item_id, term, label) to vocabulary ids; labels without an id, and blank ones, are left out."""
    return ratings.filter(F.trim("label") != "").join(vocabulary, ["term", "label"]).select("item_id", "term", "value_id")


def pair_status(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Full outer pairing of two keyed sets: both, first_only or second_only."""
    a, b = first.select(key, F.lit(True).alias("_a")), second.select(key, F.lit(True).alias("_b"))
    status = F.when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), "first_only").otherwise("second_only")
    return a.join(b, key, "full").select(key, status.alias("status"))


ANNOTATION = "map<string,array<map<string,string>>>"
LITERAL = f"array<struct<property_id:bigint,type:string,value:string,lang:string,annotation:{ANNOTATION}>>"


def annotation_matches(stored: Column, wanted: Column) -> Column:
    """True where stored has every list of wanted, as long, with every key and value of ours; keys that the server adds are no difference."""

    def listed(entry: Column) -> Column:
        have, want = stored[entry["key"]], entry["value"]
        each = F.zip_with(have, want, lambda h, w: F.forall(F.map_entries(w), lambda kv: F.coalesce(h[kv["key"]].eqNullSafe(kv["value"]), F.lit(False))))
        return F.coalesce((F.size(have) == F.size(want)) & F.forall(each, lambda x: x), F.lit(False))

    return wanted.isNull() | F.coalesce(F.forall(F.map_entries(wanted), listed), F.lit(False))


def write_literal(values: Column, property_id: Column, text: Column, lang: Column | None = None, adopt_untagged: bool = False, annotation: Column | None = None) -> Column:
    """values (``LITERAL``) with text in the literal that a target owns; a plain column, please.

    Owned is the first literal of the property, of the same language where one
    is given, or, where allowed, the first untagged one.  Other types and
    properties are left alone; without an owned one the text is appended.  A
    blank text, and one that is there already with its annotation, change
    nothing.
    """
    values = F.coalesce(values, F.array().cast(LITERAL))
    note = F.lit(None).cast(ANNOTATION) if annotation is None else annotation
    ours = lambda v: (v["property_id"] == property_id) & (v["type"] == "literal")
    first = lambda test: F.array_min(F.transform(values, lambda v, i: F.when(test(v), i)))
    own = first(ours) if lang is None else first(lambda v: ours(v) & (v["lang"] == lang))
    if lang is not None and adopt_untagged:
        own = F.coalesce(own, first(lambda v: ours(v) & v["lang"].isNull()))
    tag = (lambda v: v["lang"]) if lang is None else (lambda v: lang)

    def new(v: Column) -> Column:
        same = (v["value"] == text) & v["lang"].eqNullSafe(tag(v)) & annotation_matches(v["annotation"], note)
        return F.when(same, v).otherwise(F.struct(v["property_id"].alias("property_id"), v["type"].alias("type"), text.alias("value"), tag(v).alias("lang"), F.coalesce(note, v["annotation"]).alias("annotation")))

    added = F.struct(property_id.cast("long").alias("property_id"), F.lit("literal").alias("type"), text.alias("value"), (F.lit(None).cast("string") if lang is None else lang).alias("lang"), note.alias("annotation"))
    written = F.transform(values, lambda v, i: F.when(i == own, new(v)).otherwise(v))
    blank = F.trim(F.coalesce(text, F.lit(""))) == ""
    return F.when(blank, values).when(own.isNull(), F.concat(values, F.array(added))).otherwise(written)


def replace_property(values: Column, property_id: Column, new: Column) -> Column:
    """values with all entries of one property replaced by new, where they differ."""
    have = F.filter(values, lambda v: v["property_id"] == property_id)
    return F.when(F.to_json(have).eqNullSafe(F.to_json(new)), values).otherwise(F.concat(F.filter(values, lambda v: v["property_id"] != property_id), new))


def already_written(values: Column, property_id: int) -> Column:
    """One property stands for all that a run writes."""
    return F.coalesce(F.exists(values, lambda v: v["property_id"] == property_id), F.lit(False))


def review_action(action: Column) -> Column:
    """create or skip, trimmed and in lower case; anything else is neither: null."""
    said = F.lower(F.trim(action))
    return F.when(said.isin("create", "skip"), said)


def without_own_place(places: Column, own: Column) -> Column:
    """places but for those equal to the collection's own, case apart."""
    return F.filter(places, lambda p: own.isNull() | (F.lower(p) != F.lower(own)))


def with_new_terms(ids: Column, labels: DataFrame, rows: DataFrame, terms: DataFrame) -> DataFrame:
    """rows (row_id, ids) with the ids of their labels (row_id, pos, label) in a map (label, id, seq; the last wins) after their own, none twice."""
    last = terms.groupBy(F.lower(F.trim("label")).alias("_l")).agg(F.max_by("id", "seq").alias("id"))
    found = labels.withColumn("_l", F.lower(F.trim("label"))).join(last, "_l")
    more = found.groupBy("row_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]).alias("_more"))
    out = rows.join(more, "row_id", "left")
    return out.withColumn("ids", append_links(ids, F.col("_more"))).drop("_more")
