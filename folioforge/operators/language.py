"""Catalogued and detected languages: parsing, agreement, links to authority records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import language_code, strip, strip_accents

SHARES = ("dominant", "secondary", "occasional")  # fixed values, strongest first


def fold(text: Column) -> Column:
    """Lower case, without marks and outer white space."""
    return F.lower(strip(strip_accents(F.coalesce(text, F.lit("")))))


def parse_detected(payload: Column) -> Column:
    """array<struct<rank, pos, name, code, share>> of a JSON answer {languages: [...]}, strongest share first.

    Entries that are no objects, or that have neither name nor code, are left
    out; an unknown share counts as dominant.  Anything malformed is empty.
    """
    entries = F.from_json(F.get_json_object(payload, "$.languages"), "array<string>")
    read = lambda e, k: strip(F.coalesce(F.get_json_object(e, f"$.{k}"), F.lit("")))

    def one(e: Column, i: Column) -> Column:
        name, code, share = F.nullif(read(e, "name_en"), F.lit("")), F.nullif(read(e, "bcp47"), F.lit("")), F.lower(read(e, "share"))
        rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, SHARES)), share), F.lit(0)), F.lit(1)).cast("int")
        known = e.startswith("{") & (name.isNotNull() | code.isNotNull())
        return F.when(known, F.struct(rank.alias("rank"), i.alias("pos"), F.coalesce(name, code).alias("name"), F.coalesce(code, F.lit("und")).alias("code"), F.element_at(F.array(*map(F.lit, SHARES)), rank).alias("share")))

    found = F.filter(F.transform(entries, one), lambda x: x.isNotNull())
    return F.array_sort(F.coalesce(found, F.array().cast("array<struct<rank:int,pos:int,name:string,code:string,share:string>>")))


def primary(code: Column) -> Column:
    """fr of fr-FR."""
    return F.lower(strip(F.get(F.split(code, "-"), F.lit(0))))


def dominant(languages: Column) -> Column:
    """The dominant ones, or else the first."""
    strong = F.filter(languages, lambda x: x["share"] == SHARES[0])
    return F.when(F.size(strong) > 0, strong).otherwise(F.slice(languages, 1, 1))


def agrees(label: Column, languages: Column, labels: dict[str, str]) -> Column:
    """False only where a recorded label contradicts the dominant detected languages: by code if both have one, else by name."""
    own, heard = language_code(label, labels), dominant(languages)
    by_code = F.exists(heard, lambda x: primary(x["code"]) == own)
    coded = own.isNotNull() & F.exists(heard, lambda x: primary(x["code"]) != "")
    by_name = F.exists(heard, lambda x: fold(x["name"]).contains(fold(label)) | fold(label).contains(fold(x["name"])))
    silent = (strip(F.coalesce(label, F.lit(""))) == "") | (F.size(languages) < 1)
    return F.when(silent, True).when(coded, by_code).otherwise(by_name)


def linked(detected: DataFrame, labels: DataFrame, authority: DataFrame) -> DataFrame:
    """detected (item_id, name, code) with label and record_id: by code to a label, by label (case apart) to a record.

    Of several labels of a code the smallest counts, of several records of a
    label the smallest id.  Without a label the label is 'name (code)', and record_id is null; so it is
    for a label without a record.
    """
    one = labels.groupBy(F.col("code").alias("_c")).agg(F.min("label").alias("_l"))
    named = detected.withColumn("_c", primary(F.col("code"))).join(one, "_c", "left")
    records = authority.select(F.lower("title").alias("_t"), F.col("id").alias("record_id")).groupBy("_t").agg(F.min("record_id").alias("record_id"))
    out = named.withColumn("label", F.coalesce("_l", F.format_string("%s (%s)", "name", "code"))).withColumn("_t", F.lower("_l"))
    return out.join(records, "_t", "left").select(*detected.columns, "label", "record_id")


def allowed(languages: Column, wanted: list[str] | None) -> Column:
    """True where any of an array of labels is wanted, case apart; no list lets all through, no label none."""
    if wanted is None:
        return F.lit(True)
    return F.coalesce(F.arrays_overlap(F.transform(languages, F.lower), F.array(*(F.lit(w.lower()) for w in wanted))), F.lit(False))
