"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every text is content-addressed by its SHA-256.  The ledger says which rule
versions have seen which blob and what they found; only unseen pairs are
scanned, once per blob, and findings are joined back to every document that
holds the blob.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import filter_bits, fresh_path, member_filter, probe, read, salted, spread, stored


@dataclass(frozen=True)
class Rule:
    """kind:start:end spans of pattern's matches, leftmost and non-overlapping.

    ``needs`` is a cheaper regex that every text with a match satisfies.  A
    match whose group ``group`` is shorter than ``least`` is dropped after it
    has used up its characters.  Raise ``version`` with any change.
    """

    kind: str
    pattern: str
    needs: str
    version: int = 1
    group: int = 0
    least: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"(?i:passw(?:or)?d|secret|token|api_?key)", group=2, least=12),
    Rule("access", r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{14}", least=18),
    Rule("hex", r"[0-9a-f]{16,}", r"[0-9a-f]{16}"),  # runs shorter than 16 are maximal too, so this equals [0-9a-f]+ less the short matches
)
RULES = (
    *BASE,
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", r"-----BEGIN "),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", r"eyJ[A-Za-z0-9_-]{8}"),
    Rule("login", r"://[^\s/:@]{1,200}:[^\s/:@]{1,200}@", r"://[^\s/:@]{1,200}:"),
)
SPANS = "array<struct<start:bigint,place:int,kind:string,end:bigint,rule:string>>"
LEDGER = f"blob string, rules array<string>, spans {SPANS}"




def _scan(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """blob, rules, spans for blobs (blob, text, todo: rule keys to run)."""
    parts = [
        F.when(
            F.array_contains("todo", r.key) & F.col("text").rlike(r.needs),
            F.struct(F.lit(i).alias("place"), F.split("text", r.pattern, -1).alias("gaps"), F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0)).alias("hits")),
        )
        for i, r in enumerate(rules)
    ]
    by_rule = blobs.select("blob", F.explode(F.array(*parts)).alias("x")).filter("x is not null and size(x.hits) > 0")
    each = by_rule.select("blob", "x.place", "x.gaps", F.posexplode("x.hits").alias("n", "hit"))
    each = each.select("blob", "place", "n", "hit", F.length(F.get("gaps", F.col("n"))).alias("gap"), F.length("hit").alias("size"))
    upto = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("blob", "place").orderBy("n"))
    each = each.withColumn("end", upto)
    fits = F.lit(True)
    for i, r in enumerate(rules):
        if r.least:
            fits = fits & ((F.col("place") != i) | (F.length(F.regexp_extract("hit", r.pattern, r.group)) >= r.least))
    kinds, keys = F.array(*(F.lit(r.kind) for r in rules)), F.array(*(F.lit(r.key) for r in rules))
    found = each.filter(fits).select("blob", F.struct((F.col("end") - F.col("size")).cast("long").alias("start"), "place", F.get(kinds, F.col("place")).alias("kind"), F.col("end").cast("long").alias("end"), F.get(keys, F.col("place")).alias("rule")).alias("span"))
    return found.groupBy("blob").agg(F.array_sort(F.collect_list("span")).alias("spans"))


def scan_secrets(docs: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text", bits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(findings, additions to the ledger).

    findings has one row per row of docs: doc_id, blob, spans (struct array
    sorted by start, then by the rules' order).  The additions have one row per
    blob with pairs not in ``ledger`` (columns as in ``LEDGER``); the caller
    appends them.  Null text is the empty blob.  Rows with null or repeated ids
    are scanned like any other; other columns of docs are ignored.  Without a
    ledger everything is unseen.
    """
    keys = [r.key for r in rules]
    every = F.array(*map(F.lit, keys))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.sha2(text, 256).alias("blob"), text.alias("text"))
    suspect = F.col("text").rlike("|".join(f"(?:{r.needs})" for r in rules))
    spark = docs.sparkSession
    if ledger is None:
        fresh = rows.withColumns({"todo": every, "_live": suspect})
        known = None
    else:
        known = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"), F.flatten(F.collect_list("spans")).alias("old"))
        known = stored(known, "ledger")
        bits = bits or filter_bits(known)
        probed = probe(rows, "blob", member_filter(known, "blob", bits), "_known", bits)
        nothing = F.array().cast("array<string>")
        new, met = probed.filter("not _known").drop("_known").withColumn("todo", every), probed.filter("_known").drop("_known")
        strays = met.select("blob").join(known.select("blob"), "blob", "left_anti").distinct()  # let through by the filter alone
        open_ = known.select("blob", F.array_except(every, "seen").alias("todo")).filter("size(todo) > 0").unionByName(strays.withColumn("todo", every))
        open_ = stored(open_, "open-blobs")
        # texts travel only where something is left to do
        met = probe(met, "blob", member_filter(open_, "blob", bits), "_open", bits)
        done = met.filter("not _open").drop("_open").withColumn("todo", nothing)
        left = salted(met.filter("_open").drop("_open"), F.col("doc_id")).join(spread(open_), ["blob", "_salt"], "left").select("doc_id", "blob", "text", F.coalesce("todo", nothing).alias("todo"))
        fresh = new.unionByName(done).unionByName(left)
        fresh = fresh.withColumn("_live", (F.size("todo") > 0) & suspect)
    # a row without anything suspicious needs no text any more, and a suspicious blob is scanned once
    marks = stored(fresh.select("doc_id", "blob", "todo", "_live", F.when(F.col("_live"), F.col("text")).alias("text")), "blobs")
    live = marks.filter("_live").groupBy("blob").agg(F.first("text").alias("text"), F.first("todo").alias("todo"))
    scanned = stored(_scan(live, rules), "findings")
    spans = scanned
    if known is not None:
        # of what other versions of a rule found nothing stays, and places are those of the rules asked for
        valid = F.filter("old", lambda s: F.array_contains(every, s["rule"]))
        placed = F.transform(valid, lambda s: F.struct(s["start"].alias("start"), (F.array_position(every, s["rule"]) - 1).cast("int").alias("place"), s["kind"].alias("kind"), s["end"].alias("end"), s["rule"].alias("rule")))
        old = known.select("blob", placed.alias("spans")).filter("size(spans) > 0")
        spans = scanned.unionByName(old).groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))
        asks = F.lit(True)
    else:
        asks = F.col("_live")
    none = F.array().cast(SPANS)
    quiet = marks.filter(~asks).select("doc_id", "blob", none.alias("spans"))
    loud = salted(marks.filter(asks), F.col("doc_id")).join(spread(spans), ["blob", "_salt"], "left").select("doc_id", "blob", F.coalesce("spans", none).alias("spans"))
    findings = quiet.unionByName(loud)
    added = marks.filter("size(todo) > 0").groupBy("blob").agg(F.first("todo").alias("rules")).join(scanned, "blob", "left").select("blob", "rules", F.coalesce("spans", none).alias("spans"))
    return findings, added


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus is scanned into a ledger, and the findings are those of a second run that finds every blob in it."""
    docs, path = read(spark, sf_dir, "documents"), fresh_path(spark, "secret-ledger")
    scan_secrets(docs)[1].write.option("compression", "zstd").parquet(path)
    findings, _ = scan_secrets(docs, spark.read.schema(LEDGER).parquet(path))
    base = F.filter("spans", lambda s: s["place"] < len(BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return findings.select("doc_id", *(count(r.kind).alias(f"n_{r.kind}") for r in BASE), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))
