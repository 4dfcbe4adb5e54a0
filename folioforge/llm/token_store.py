"""Token-id output as a content-addressed store.

A rolling hash over each document's ids cuts the stream into chunks wherever
the hash says so; every distinct chunk is stored once under its SHA-256,
documents are recipes of chunk addresses in ascending doc_id order, and Merkle
roots per document and per recipe file verify what is read back.

Layout under the store's path (Parquet, zstd):

* ``chunks``   digest, n (ids), payload: ids as little-endian unsigned 16-bit
  numbers, or 32-bit ones for vocabularies beyond 65,536
* ``recipes``  kind 1: part, ord, doc_id, n, start (ids before it in its part),
  recipe (digest + 32-bit count per chunk), root; kind 2: per part, documents,
  ids and the Merkle root over its documents' roots
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh_path, lean, read

END_ID = 2
MEAN_CHUNK = 512
MOST_CHUNK = 4096
WINDOW = 4
PORTION = 1 << 24  # bytes of text encoded at a time; a longer text is a portion of its own
LEARNT = 1 << 25  # bytes of units and ids that a task keeps


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(values: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


SPACES = _table(bytes([*range(9, 14), *range(28, 33)]))  # white space, and ASCII that may count as such
LETTERS = _table(bytes([*range(65, 91), *range(97, 123)]))
ENDS_WORD = _table(b".,!?;:\n\r\t")


def _spaces_at(b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the characters whose last bytes are at ``at`` are white space."""
    z = b[at]
    out = SPACES[z]
    i = np.flatnonzero(z >= 128)
    if len(i):
        z, y, x = z[i], b[np.maximum(at[i] - 1, 0)], b[np.maximum(at[i] - 2, 0)]
        two = (y == 0xC2) & ((z == 0x85) | (z == 0xA0))
        e2 = (y == 0x80) & ((z <= 0x8A) | (z == 0xA8) | (z == 0xA9) | (z == 0xAF)) | (y == 0x81) & (z == 0x9F)
        out[i] = two | (x == 0xE1) & (y == 0x9A) & (z == 0x80) | (x == 0xE2) & e2 | (x == 0xE3) & (y == 0x80) & (z == 0x80)
    return out


def unit_cuts(b: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where units begin in the UTF-8 bytes of texts that begin at ``starts``, and the end.

    The library's pre-tokenizer always starts a new piece at a space after
    something other than white space, at ASCII punctuation or a line break
    after an ASCII letter, and after a single line break between two characters
    that are no white space; on either side of such a place it finds the same
    pieces as if the other side were not there.
    """
    cut = np.zeros(len(b) + 1, bool)
    cut[starts] = True
    at = np.flatnonzero(b[1:] == 32)
    cut[at[~_spaces_at(b, at)] + 1] = True
    at = np.flatnonzero(ENDS_WORD[b[1:]])
    cut[at[LETTERS[b[at]]] + 1] = True
    at = np.flatnonzero(b[1:-1] == 10) + 1
    for near in (-1, 1):
        at = at[~SPACES[b[at + near]] & (b[at + near] < 128)]
    cut[at + 1] = True
    return np.flatnonzero(cut)


class Learnt:
    """Units that a task has met and their ids; the empty unit, the first, has the ids that end a text."""

    def __init__(self, tail: bytes = b""):
        self.tail = tail
        self.clear()

    def clear(self) -> None:
        self.units, self.ids = pa.array([b""], pa.large_binary()), pa.array([self.tail], pa.large_binary())

    def add(self, units: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        ends = np.r_[0, np.cumsum(counts * ids.itemsize)]
        more = pa.Array.from_buffers(pa.large_binary(), len(units), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
        self.units, self.ids = pa.concat_arrays([self.units, units]), pa.concat_arrays([self.ids, more])


class Encoder:
    """Whole-text ids of a byte-level BPE of the tokenizers library.

    Texts are cut into units whose ids do not depend on their neighbours
    (``unit_cuts``), and the library encodes each distinct unit of a task once,
    as long as ``LEARNT`` holds them.  Nothing is kept from one task to the
    next.  A vocabulary with an added token that such a cut might split gets
    whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        special = self.tokenizer.get_added_tokens_decoder()
        self.lengths = np.zeros(size, np.int64)  # bytes of text that an id stands for
        for word, i in self.tokenizer.get_vocab().items():
            self.lengths[i] = len(word.encode()) if i in special else len(word)
        self.cuts = not any(t.lstrip or t.rstrip or t.single_word or any(c.isspace() or c in ".,!?;:" for c in t.content) for t in special.values())

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, self.dtype) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct units: ids one unit after another, how many each has, and the order in which units stand there."""
        ends = np.frombuffer(units.buffers()[1], np.int64)[: len(units) + 1]
        b = np.frombuffer(units.buffers()[2], np.uint8)
        joins = self.cuts & (b[ends[:-1]] == 32) & ~_spaces_at(b, ends[1:] - 1)  # such units, one after another, fall apart again
        many, few = np.flatnonzero(joins), np.flatnonzero(~joins)
        found = [self._joined(units.take(pa.array(many[at : at + 20_000]))) for at in range(0, len(many), 20_000)]
        found += [self._each(units.take(pa.array(few[at : at + 256]))) for at in range(0, len(few), 256)]
        ids, counts = zip(*found, strict=True)
        return np.concatenate(ids), np.concatenate(counts), np.concatenate([many, few])

    def _joined(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units and counts, by texts of 200 units; by single units should ids not end where units do."""
        offsets = np.frombuffer(units.buffers()[1], np.int64)[: len(units) + 1]
        data, cuts = units.buffers()[2].to_pybytes(), [*offsets[:-1:200].tolist(), int(offsets[-1])]
        ids = np.concatenate(self._ids([data[a:z].decode() for a, z in zip(cuts, cuts[1:], strict=False)]))
        ends = np.cumsum(self.lengths[ids])
        place = np.searchsorted(ends, offsets[1:])
        if len(ends) and place[-1] == len(ends) - 1 and (ends[place] == offsets[1:]).all():
            return ids, np.diff(place, prepend=-1)
        return self._each(units)

    def _each(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = self._ids([u.decode() for u in units.to_pylist()])
        return np.concatenate(ids), np.array([len(x) for x in ids])

    def stream(self, texts: pa.Array, learnt: Learnt) -> tuple[bytes, np.ndarray]:
        """The ids of texts, each with its end, as one run of bytes; where each text's ids end in it (counted in ids)."""
        texts = texts.fill_null("").cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        b = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        starts = offsets - offsets[0]
        at = unit_cuts(b, starts) if self.cuts else np.unique(starts)
        after = np.searchsorted(at, starts[1:])  # units up to each text's end
        units = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(b)]).dictionary_encode()
        place = pc.fill_null(pc.index_in(units.dictionary, value_set=learnt.units), -1).to_numpy().copy()
        fresh = np.flatnonzero(place < 0)
        if len(fresh):
            ids, counts, order = self._learn(units.dictionary.take(pa.array(fresh)))
            fresh = fresh[order]
            place[fresh] = np.arange(len(learnt.units), len(learnt.units) + len(fresh))
            learnt.add(units.dictionary.take(pa.array(fresh)), ids, counts)
        taken = learnt.ids.take(pa.array(np.insert(place[units.indices.to_numpy()], after, 0)))
        ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1]
        if learnt.units.nbytes + learnt.ids.nbytes > LEARNT:
            learnt.clear()
        return (taken.buffers()[2] or pa.py_buffer(b"")).to_pybytes()[: ends[-1]], ends[after + np.arange(1, len(after) + 1)] // self.dtype.itemsize

    def encode(self, texts: list[str]) -> list[bytes]:
        raw, ends = self.stream(pa.array(texts, pa.string()), Learnt())
        cuts = [0, *(ends * self.dtype.itemsize).tolist()]
        return [raw[a:z] for a, z in zip(cuts, cuts[1:], strict=False)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def chunk_ends(ids: np.ndarray, ends: np.ndarray, mean: int = MEAN_CHUNK, most: int = MOST_CHUNK) -> np.ndarray:
    """Where chunks end in ids, the concatenation of documents that end at ``ends``.

    A chunk ends after an id where the hash of the last WINDOW ids is 0 modulo
    ``mean``, at its document's end, and after ``most`` ids at the latest.
    """
    n = len(ids)
    x = (ids.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
    h = x.copy()
    for k in range(1, WINDOW):
        h[k:] += x[:-k] * np.uint32((2 * k + 1) * 0x85EBCA6B & 0xFFFFFFFF)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    cut = h % np.uint32(mean) == 0
    starts = np.r_[0, ends[:-1]]
    for k in range(WINDOW - 1):  # a window that would begin before its document
        at = starts + k
        cut[at[at < n]] = False
    cut[ends - 1] = True
    found = np.flatnonzero(cut) + 1
    size = np.diff(np.r_[0, found])
    if (size > most).any():
        extra = [np.arange(e - s + most, e, most) for e, s in zip(found[size > most].tolist(), size[size > most].tolist(), strict=True)]
        found = np.unique(np.concatenate([found, *extra]))
    return found


def merkle(leaves: list[bytes]) -> bytes:
    """Root over 32-byte leaves: pairs are hashed upwards, an odd last one moves up; none gives the hash of nothing."""
    level = [hashlib.sha256(b"\0" + x).digest() for x in leaves]
    while len(level) > 1:
        level = [hashlib.sha256(b"\1" + level[i] + level[i + 1]).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0] if level else hashlib.sha256(b"").digest()


PIECES = "key long, kind int, doc_id long, n long, digest binary, payload binary"
RECIPE = np.dtype([("digest", "V32"), ("n", "<u4")])


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in their order, of up to PORTION bytes of text at a time; every row whole."""
    held, size = [], 0
    for batch in batches:
        first = 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()):
            if size and size + n > PORTION:
                held.append(batch.slice(first, i - first))
                yield pa.Table.from_batches(held)
                held, size, first = [], 0, i
            size += n
        held.append(batch.slice(first))
    if held:
        yield pa.Table.from_batches(held)


def _cut_up(path: str, end_id: int):
    """Kind 0: a chunk this task has not sent yet; kind 1: a document's recipe."""

    def run(batches: Iterator[pa.RecordBatch]):
        enc, sent = encoder(path), set()
        step = enc.dtype.itemsize
        learnt = Learnt(np.array([end_id], enc.dtype).tobytes())
        for part in _portions(batches):
            if len(part):
                raw, doc_ends = enc.stream(part.column(1).combine_chunks(), learnt)
                sizes = np.diff(doc_ends, prepend=0).tolist()
                ends = chunk_ends(np.frombuffer(raw, enc.dtype), doc_ends)
                keys, kinds, ids, ns, digests, payloads = [], [], [], [], [], []
                recipe: list[bytes] = []
                a, d = 0, 0
                doc_ids = part.column(0).to_pylist()
                for z in ends.tolist():
                    data = raw[a * step : z * step]
                    digest = hashlib.sha256(data).digest()
                    recipe.append(digest + (z - a).to_bytes(4, "little"))
                    if digest not in sent:
                        if len(sent) >= 300_000:
                            sent.clear()
                        sent.add(digest)
                        keys.append(int.from_bytes(digest[:8], "little", signed=True)), kinds.append(0), ids.append(None)
                        ns.append(z - a), digests.append(digest), payloads.append(data)
                    if z == doc_ends[d]:
                        packed = b"".join(recipe)
                        keys.append(zlib.crc32(packed + str(doc_ids[d]).encode())), kinds.append(1), ids.append(doc_ids[d])
                        ns.append(sizes[d]), digests.append(merkle([r[:32] for r in recipe])), payloads.append(packed)
                        recipe, d = [], d + 1
                    a = z
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(kinds, pa.int32()), pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(digests, pa.binary()), pa.array(payloads, pa.binary())], ["key", "kind", "doc_id", "n", "digest", "payload"])

    return run


def _once(batches):
    """Of chunks sorted by digest the first; recipes as they are."""
    last = pa.scalar(None, pa.binary())
    for batch in batches:
        if len(batch):
            kinds, digests = batch.column(1), batch.column(4)
            before = pa.concat_arrays([pa.array([last.as_py()], pa.binary()), digests.slice(0, len(digests) - 1)])
            keep = pc.or_(pc.equal(kinds, 1), pc.fill_null(pc.not_equal(digests, before), True))
            last = digests[-1]
            yield batch.filter(keep)


ORDERED = "kind int, part int, ord long, doc_id long, n long, start long, recipe binary, root binary"


def _in_order(batches):
    """Recipes of a sorted part with their places, then the part's manifest."""
    part, ord_, start, roots = TaskContext.get().partitionId(), 0, 0, Roots()
    names = ["kind", "part", "ord", "doc_id", "n", "start", "recipe", "root"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    for batch in batches:
        n = batch.column(1).to_numpy()
        m = len(n)
        for r in batch.column(3).to_pylist():
            roots.add(r)
        starts = start + np.cumsum(n) - n
        cols = [np.ones(m, np.int32), np.full(m, part, np.int32), np.arange(ord_, ord_ + m), batch.column(0), n, starts, batch.column(2), batch.column(3)]
        ord_, start = ord_ + m, start + int(n.sum())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) if isinstance(c, np.ndarray) else c for c, k in zip(cols, kinds, strict=True)], names)
    if ord_:
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip([2, part, ord_, None, start, 0, None, roots.root()], kinds, strict=True)], names)


class Roots:
    """A Merkle root over a stream of leaves in little memory: a finished subtree per level."""

    def __init__(self):
        self.levels: list[bytes | None] = []

    def add(self, leaf: bytes) -> None:
        node, i = hashlib.sha256(b"\0" + leaf).digest(), 0
        while i < len(self.levels) and self.levels[i] is not None:
            node, self.levels[i] = hashlib.sha256(b"\1" + self.levels[i] + node).digest(), None
            i += 1
        if i == len(self.levels):
            self.levels.append(None)
        self.levels[i] = node

    def root(self) -> bytes:
        node = None
        for x in self.levels:
            if x is not None:
                node = x if node is None else hashlib.sha256(b"\1" + x + node).digest()
        return node or hashlib.sha256(b"").digest()


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every whole text, appends end_id and writes the store.

    Null text is empty: its stream is the end id alone.  Documents stand in
    ascending doc_id order, null ids first, rows repeating an id by their
    recipes.  Every text is encoded once; chunks and recipes leave the same
    pass, chunks are shuffled by address and recipes evenly, so neither a
    frequent chunk nor a frequent id fills one task.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(lean(_cut_up(vocabulary, end_id)), PIECES)
    unique = pieces.repartition(parts, "key").sortWithinPartitions("kind", "digest").mapInArrow(lean(_once), PIECES)
    unique.select("kind", "doc_id", "n", "digest", "payload").write.partitionBy("kind").option("compression", "zstd").parquet(f"{path}/pieces")
    recipes = _pieces(spark, path).filter("kind = 1").select("doc_id", "n", F.col("payload").alias("recipe"), F.col("digest").alias("root"))
    ordered = recipes.repartitionByRange(parts, "doc_id", "root").sortWithinPartitions("doc_id", "root")
    ordered.mapInArrow(_in_order, ORDERED).write.partitionBy("kind").option("compression", "zstd").parquet(f"{path}/recipes")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id long, n long, digest binary, payload binary, kind int").parquet(f"{path}/pieces")


def _recipes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("part int, ord long, doc_id long, n long, start long, recipe binary, root binary, kind int").parquet(f"{path}/recipes")


def chunks(spark: SparkSession, path: str) -> DataFrame:
    """digest, n, payload: one row per distinct chunk."""
    return _pieces(spark, path).filter("kind = 0").select("digest", "n", "payload")


def _ids_of(data: bytes, n: int) -> np.ndarray:
    """The n ids of a chunk; its length says how wide they are."""
    if n < 1 or len(data) not in (2 * n, 4 * n):
        raise ValueError(f"{n} ids do not fill {len(data)} bytes")
    return np.frombuffer(data, f"<u{len(data) // n}").astype("<u4")


def _check_chunks(batches):
    for batch in batches:
        crcs = []
        for digest, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if hashlib.sha256(data).digest() != digest:
                raise ValueError(f"chunk {digest.hex()} is damaged")
            crcs.append(zlib.crc32(_ids_of(data, n).tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(crcs, pa.int64())], ["digest", "n", "crc"])


def _check_manifests(batches):
    """Partitions sorted by (part, kind, ord): (part, ids) of every part whose recipes are those of its manifest, in its order."""
    part, count, ids, roots = None, 0, 0, Roots()
    for batch in batches:
        done = []
        for kind, p, ord_, n, root in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if part is None:
                part, count, ids, roots = p, 0, 0, Roots()
            if kind == 1 and p == part and ord_ == count:
                count, ids = count + 1, ids + n
                roots.add(root)
            elif kind == 2 and (p, ord_, n, root) == (part, count, ids, roots.root()):
                done.append((part, ids))
                part = None
            else:
                raise ValueError(f"recipes of part {part} are not those of its manifest")
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.int32()), pa.array([x[1] for x in done], pa.int64())], ["part", "n"])
    if part is not None:
        raise ValueError(f"part {part} has no manifest")


def _steps(batches):
    """Per chunk of a recipe: the document's row, the address and the ids that follow the chunk in the document."""
    for batch in batches:
        part, ord_ = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        rows, digests, after, pos = [], [], [], []
        for i, (packed, root) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
            recipe = np.frombuffer(packed, RECIPE)
            mine = [x.tobytes() for x in recipe["digest"]]
            if merkle(mine) != root:
                raise ValueError(f"recipe {part[i]}:{ord_[i]} is damaged")
            n = recipe["n"].astype(np.int64)
            rows += [i] * len(n)
            digests += mine
            after += (n.sum() - np.cumsum(n)).tolist()
            pos += range(len(n))
        yield pa.RecordBatch.from_arrays([pa.array(part[rows], pa.int32()), pa.array(ord_[rows], pa.int64()), pa.array(pos, pa.int64()), pa.array(digests, pa.binary()), pa.array(after, pa.int64())], ["part", "ord", "pos", "digest", "after"])


_shift_tables: list[np.ndarray] = []


def shift_crc(crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """CRC-32 moved over ``zeros`` more bytes: crc(a + b) = shift_crc(crc(a), len(b)) ^ crc(b)."""
    if not _shift_tables:
        byte = np.arange(256, dtype=np.uint32)
        step = byte.copy()
        for _ in range(8):
            step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
        lanes = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)]
        one = np.stack([step[x & 255] ^ (x >> np.uint32(8)) for x in lanes])
        _shift_tables.append(one)
    out, left, k = crc.astype(np.uint32), zeros.astype(np.int64), 0
    while left.any():
        if k == len(_shift_tables):
            t = _shift_tables[-1]
            _shift_tables.append(np.stack([_apply(t, t[lane]) for lane in range(4)]))
        odd = (left & 1).astype(bool)
        out[odd] = _apply(_shift_tables[k], out[odd])
        left, k = left >> 1, k + 1
    return out


def _apply(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    return table[0][x & 255] ^ table[1][x >> 8 & 255] ^ table[2][x >> 16 & 255] ^ table[3][x >> 24]


@F.arrow_udf(returnType=T.LongType())
def _moved(crc: pa.Array, after: pa.Array) -> pa.Array:
    return pa.array(shift_crc(crc.to_numpy(zero_copy_only=False), 4 * after.to_numpy(zero_copy_only=False)).astype(np.int64), pa.int64())


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32.

    Every chunk's bytes are checked against its address, every recipe against
    its root and the recipes of a part against its manifest.  Checksums of
    chunks are joined to recipes and combined; payloads are read where they lie
    and not shuffled, and adaptive execution splits a frequent chunk's join.
    """
    sums = chunks(spark, path).mapInArrow(lean(_check_chunks), "digest binary, n long, crc long")
    recipes = _recipes(spark, path)
    docs = recipes.filter("kind = 1")
    steps = docs.select("part", "ord", "recipe", "root").mapInArrow(lean(_steps), "part int, ord long, pos long, digest binary, after long")
    each = steps.join(sums, "digest", "left")
    each = each.withColumn("crc", F.coalesce("crc", F.raise_error(F.lit("a chunk is missing")).cast("long")))
    by_doc = each.select("part", "ord", "n", _moved("crc", "after").alias("crc")).groupBy("part", "ord").agg(F.sum("n").alias("n_tokens"), F.bit_xor("crc").alias("ids_crc32"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    listed = recipes.select("kind", "part", "ord", "n", "root").repartition("part").sortWithinPartitions("part", "kind", "ord")
    offsets = listed.mapInArrow(_check_manifests, "part int, n long").select("part", F.coalesce(before, F.lit(0)).alias("offset"))  # a row per recipe part
    out = docs.select("part", "ord", "doc_id", "start").join(by_doc, ["part", "ord"]).join(F.broadcast(offsets), "part")
    return out.select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def reconstruct(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids (array of ints) of some documents, rebuilt through joins of recipes and chunks."""
    docs = _recipes(spark, path).filter("kind = 1").filter(F.col("doc_id").isin(doc_ids))
    steps = docs.select("part", "ord", "recipe", "root").mapInArrow(_steps, "part int, ord long, pos long, digest binary, after long")
    whole = steps.join(chunks(spark, path), "digest").groupBy("part", "ord").agg(F.array_sort(F.collect_list(F.struct("pos", "n", "payload"))).alias("x"))

    @F.arrow_udf(returnType=T.ArrayType(T.IntegerType()))
    def ids(x: pa.Array) -> pa.Array:
        return pa.array([np.concatenate([_ids_of(s["payload"], s["n"]) for s in row]).astype(np.int32) for row in x.to_pylist()], pa.list_(pa.int32()))

    return docs.select("part", "ord", "doc_id").join(whole, ["part", "ord"]).select("doc_id", ids("x").alias("ids"))


def tokenise(docs: DataFrame) -> DataFrame:
    """docs written to a fresh store in the shared folder and read back."""
    path = fresh_path(docs.sparkSession, "tokens")
    write_tokens(docs, path)
    return read_tokens(docs.sparkSession, path)


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenise(read(spark, sf_dir, "documents"))
