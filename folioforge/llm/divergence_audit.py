"""Source divergence audit on integer-encoded term counts.

Texts become counts per (lang, source, term), summed in the task, then by
Spark.  Chunks of a language's terms are encoded one by one: the kept terms are
a sorted array, ``searchsorted`` gives every count its integer id, and ids keep
the order of the terms' UTF-8 bytes.  A chunk's counts per group then fill
dense vectors (``bincount`` by group and id), from which come the distances of
all pairs of groups and the chunk's highest terms; ties of a value are broken
by id.  Sums over chunks and a last ranking are Spark's.

A term lies in one chunk, and a chunk has about ``CHUNK_ROWS`` counts, so no
language, source or term makes a task large.  Dense vectors are filled for
``DENSE`` numbers at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lean, read, stored
from .wordhash import LETTERS, lowered, portions, spans, utf8

LEAST_DOCS = 30  # documents of the language that a kept term is in
TOP_TERMS = 50
SCALE = 1_000_000_000
SMOOTH = 5
CHUNK_ROWS = 100_000  # counts in a chunk, about
DENSE = 2_000_000  # numbers of dense vectors held at once

COUNTS = "lang string, source string, term string, n long, docs long"
ENCODED = "lang string, chunk long, terms array<string>, sources array<string>, totals array<long>, at binary, id binary, n binary"
FOUND = "lang string, part string, source string, item string, value long"


def _strings(column) -> pa.Array:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.fill_null("").cast(pa.large_string())


def counted(lang: pa.Array, source: pa.Array, raw: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    """Counts of some texts: per (lang, source, term) occurrences and documents, and per (lang, source) one row without a term."""
    langs, sources = lang.dictionary_encode(), source.dictionary_encode()
    width = max(1, len(sources.dictionary))
    groups, group = np.unique(langs.indices.to_numpy().astype(np.int64) * width + sources.indices.to_numpy(), return_inverse=True)
    starts, ends = spans(raw, offsets, LETTERS)
    bounds = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(lowered(raw)[LETTERS[raw]].astype(np.uint8)))
    coded = words.dictionary_encode()
    size = max(1, len(coded.dictionary))
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
    pair, times = np.unique(doc * size + coded.indices.to_numpy(), return_counts=True)
    key, at = np.unique(group[pair // size] * size + pair % size, return_inverse=True)
    n, docs = np.bincount(at, times, len(key)).astype(np.int64), np.bincount(at, minlength=len(key))
    every = groups[np.r_[key // size, np.arange(len(groups))]]
    terms = pa.chunked_array([coded.dictionary.take(pa.array(key % size)), pa.nulls(len(groups), pa.large_string())]).combine_chunks()
    zero = np.zeros(len(groups), np.int64)
    columns = [langs.dictionary.take(pa.array(every // width)), sources.dictionary.take(pa.array(every % width)), terms]
    return pa.RecordBatch.from_arrays([*(c.cast(pa.string()) for c in columns), pa.array(np.r_[n, zero]), pa.array(np.r_[docs, zero])], ["lang", "source", "term", "n", "docs"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = utf8(batch.column(2))
        lang, source = _strings(batch.column(0)), _strings(batch.column(1))
        for s, e in portions(offsets, 1 << 23):
            yield counted(lang[s:e], source[s:e], raw[offsets[s] : offsets[e]], offsets[s : e + 1] - offsets[s])


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs); every group has also a row whose term is null."""
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col, text_col)))
    return texts.mapInArrow(lean(_counts), COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _encoded(least_docs: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        term = np.array(rows.column("term").to_pylist(), object)
        source, at = np.unique(np.array(rows.column("source").to_pylist(), object), return_inverse=True)
        n, docs = rows.column("n").to_numpy(), rows.column("docs").to_numpy()
        real = np.array([t is not None for t in term], bool)
        names = np.unique(term[real])
        seen = np.bincount(np.searchsorted(names, term[real]), docs[real], len(names)) if len(names) else np.zeros(0)
        kept = names[seen >= least_docs]
        ids = np.minimum(np.searchsorted(kept, term[real]), max(0, len(kept) - 1)) if len(kept) else np.zeros(real.sum(), np.int64)
        held = kept[ids] == term[real] if len(kept) else np.zeros(real.sum(), bool)
        at, ids, n = at[real][held].astype(np.int32), ids[held].astype(np.int32), n[real][held].astype(np.int64)
        total = np.zeros(len(source), np.int64)
        np.add.at(total, at, n)
        row = [[key[0].as_py()], [key[1].as_py()], [kept.tolist()], [source.tolist()], [total.tolist()], [at.tobytes()], [ids.tobytes()], [n.tobytes()]]
        kinds = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64()), *[pa.binary()] * 3]
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(row, kinds, strict=True)], ["lang", "chunk", "terms", "sources", "totals", "at", "id", "n"])

    return run


def shares(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE (count + SMOOTH) / whole) in 64-bit integers: three digits a step, exact while whole < 2**53."""
    rest, out = count + SMOOTH, np.zeros(np.broadcast(count, whole).shape, np.int64)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return out + 1


def _best(at: np.ndarray, ids: np.ndarray, value: np.ndarray, most: int) -> np.ndarray:
    """Of each group the entries with the largest values, of equal values those with the smallest ids."""
    order = np.lexsort((ids, -value, at))
    at = at[order]
    rank = np.arange(len(at)) - np.searchsorted(at, at)
    return order[rank < most]


def _compared(top_terms: int):
    def run(key: tuple, chunk: pa.Table, groups: pa.Table) -> pa.Table:
        lang = key[0].as_py()
        order = np.argsort(np.array(groups.column("source").to_pylist(), object), kind="stable")
        sources = np.array(groups.column("source").to_pylist(), object)[order]
        whole = (groups.column("total").to_numpy()[order] + SMOOTH * groups.column("kept").to_numpy()[order]).astype(np.int64)
        all_in = int(groups.column("in_lang")[0].as_py() + SMOOTH * groups.column("kept")[0].as_py())
        terms = np.array(chunk.column("terms")[0].as_py(), object)
        at, ids, n = (np.frombuffer(chunk.column(c)[0].as_py(), t).astype(np.int64) for c, t in (("at", np.int32), ("id", np.int32), ("n", np.int64)))
        at = np.searchsorted(sources, np.array(chunk.column("sources")[0].as_py(), object))[at].astype(np.int64)
        left, right, far = [], [], []
        block = max(1, DENSE // max(1, len(sources)))
        for a in range(0, len(sources), block):
            near = min(len(sources), a + block)
            total = np.zeros((near - a, len(sources)), np.int64)
            for t in range(0, len(terms), block):
                width, inside = min(block, len(terms) - t), (ids >= t) & (ids < t + block)
                dense = np.zeros(len(sources) * width, np.int64)
                dense[at[inside] * width + ids[inside] - t] = n[inside]  # a group has one count for a term
                p = shares(dense.reshape(len(sources), width), whole[:, None])
                for i in range(a, near):
                    total[i - a, i + 1 :] += np.abs(p[i + 1 :] - p[i]).sum(1)
            i, j = np.nonzero(np.arange(len(sources))[None, :] > np.arange(a, near)[:, None])
            left.append(i + a), right.append(j), far.append(total[i, j])
        left, right, far = np.concatenate(left), np.concatenate(right), np.concatenate(far)
        in_lang = np.zeros(len(terms), np.int64)
        np.add.at(in_lang, ids, n)
        p = shares(n, whole[at])
        q = shares(in_lang[ids], np.int64(all_in))
        over = np.flatnonzero((n > 0) & (p > q))
        top = over[_best(at[over], ids[over], (p - q)[over], top_terms)]
        part = ["pair"] * len(left) + ["term"] * len(top)
        items = np.r_[sources[right], terms[ids[top]]] if len(terms) else sources[right]
        columns = [[lang] * len(part), part, sources[np.r_[left, at[top]]].tolist(), items.tolist(), np.r_[far, (p - q)[top]]]
        return pa.Table.from_arrays([*(pa.array(c, pa.string()) for c in columns[:4]), pa.array(columns[4], pa.int64())], ["lang", "part", "source", "item", "value"])

    return run


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, chunk_rows: int = CHUNK_ROWS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: how far the groups (lang, source) lie from each other, and by which terms they stand out.

    Null text, lang and source are ''.  Repeated rows are documents of their
    own.  A text without letters adds nothing to its group's counts, but its
    group occurs.  A language without kept terms has pairs of value 0 and no
    term rows; one with a single source has no pairs; an empty table gives no
    rows.  Other columns of docs are ignored, whatever their names.
    chunk_rows changes no result.
    """
    counts = stored(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    chunks = max(1, -(-counts.count() // chunk_rows))
    chunk = F.pmod(F.xxhash64("term"), F.lit(chunks)).alias("chunk")
    encoded = stored(counts.select("*", chunk).groupBy("lang", "chunk").applyInArrow(_encoded(least_docs), ENCODED), "term-ids")
    totals = encoded.select("lang", F.explode(F.arrays_zip("sources", "totals")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.totals").alias("total"))
    kept = encoded.groupBy("lang").agg(F.sum(F.size("terms")).alias("kept"))
    totals = stored(totals, "term-totals")
    whole = totals.groupBy("lang").agg(F.sum("total").alias("in_lang"))
    groups = stored(totals.join(whole, "lang").join(kept, "lang"), "term-groups")
    every = encoded.select("lang", "chunk").join(groups, "lang").withColumnsRenamed({"lang": "_lang", "chunk": "_chunk"})
    found = encoded.groupBy("lang", "chunk").cogroup(every.groupBy("_lang", "_chunk")).applyInArrow(_compared(top_terms), FOUND)
    found = stored(found, "term-found")
    pairs = found.filter("part = 'pair'").groupBy("lang", "part", "source", "item").agg(F.sum("value").alias("value"))
    back = pairs.select("lang", "part", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")).cast("int")
    pairs, terms = pairs.unionByName(back).withColumn("rank", rank), found.filter("part = 'term'").withColumn("rank", rank).filter(F.col("rank") <= top_terms)
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(read(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT r, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
gn AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT gn.lang, gn.source, kept.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (gn.total + 5 * v.v) AS p
  FROM gn JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = kept.term),
ln AS (SELECT lang, sum(total)::HUGEINT AS total FROM gn GROUP BY lang),
q AS (
  SELECT p.lang, p.term, 1 + (1000000000::HUGEINT * (sum(p.n) + 5)) // (any_value(ln.total) + 5 * any_value(v.v)) AS q
  FROM p JOIN ln USING (lang) JOIN v USING (lang) GROUP BY p.lang, p.term),
far AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(far.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
terms AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, (p.p - q.q)::BIGINT AS value
  FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q)
SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 50
"""
