"""N-gram Jaccard self-join as a blocked sparse matrix product.

The incidence matrix has a row per distinct n-gram set and a column per n-gram.
Columns are ordered by how common they are, rare ones first.  For a pair with
Jaccard similarity t the first |x| - ceil(t |x|) + 1 columns of each row x
already share one, so rows meet only in those.  In a column, rows of one size
class and the next form a group named by its smallest row; the many columns
that copies share give the same few groups, so a row is in few of them.

The product is then taken group by group: incidence blocks are multiplied and
overlap counts accumulate, first over the prefixes, where rows without a
partner that reaches the bound of their sizes are dropped, then over the whole
rows of the others.  Links leave a group as stars around its smallest rows.  A group of more rows than a tile holds first compares each row with a
few pivots; only rows that are then outside its largest component meet all
others, tile by tile.  No column, group, pair or partner is capped.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import filter_bits, lean, member_filter, probe, read, stored
from .components import components, least_labels
from .wordhash import SPACED, mix, ngrams, portions, utf8, word_hashes

NGRAM = 5
PERCENT = 80
SKETCH_BITS = 22  # counters of the frequency sketch: 16 MB in a task and on the driver, whatever the input
SKETCH_PARTS = 64
FAN_IN = 256  # sketches added up by one task
BLOCK_ENTRIES = 200_000
BLOCK_COLUMNS = 4096  # columns multiplied at once
PIVOTS = 16  # rows of a large group that all its rows are compared with
LOW56 = np.uint64((1 << 56) - 1)


def gram_sets(raw: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct n-gram hashes; a shorter text is one n-gram, one without words none."""
    words, first = word_hashes(raw, offsets, SPACED)
    grams = ngrams(words, n)
    for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if z - a >= n:
            got = np.sort(grams[a : z - n + 1])
            yield got[np.r_[True, got[1:] != got[:-1]]]
        else:
            yield ngrams(words[a:z], z - a) if z > a else grams[:0]


def _signature(grams: np.ndarray) -> int:
    """63 bits for a set of hashes, whatever their order."""
    a, b = int(mix(grams).sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mix(grams + np.uint64(0x51ED270B))))
    return int(mix(np.array([a ^ (b * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF)], np.uint64))[0] >> np.uint64(1))


def _rows_of(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[object, np.ndarray]]:
    """(id, n-gram set) of every row of batches (id, text)."""
    for batch in batches:
        raw, offsets = utf8(batch.column(1))
        ids = batch.column(0).to_pylist()
        for s, e in portions(offsets):
            yield from zip(ids[s:e], gram_sets(raw[offsets[s] : offsets[e]], offsets[s : e + 1] - offsets[s], n), strict=True)


class _Seen:
    """Which signatures this task met before; forgets all beyond its bound, which costs repeats only."""

    def __init__(self, bound: int = 500_000):
        self.bound, self.have = bound, set()

    def first(self, sig: int) -> bool:
        if sig in self.have:
            return False
        if len(self.have) >= self.bound:
            self.have.clear()
        self.have.add(sig)
        return True


SUMMARY = "kind int, doc_id long, n long, sig long, counts binary"


def _summaries(n: int):
    """Per row (0, id, set size, signature); per part of the task's frequency sketch (1, part, task, null, counts)."""

    def run(batches):
        sketch, seen = np.zeros(1 << SKETCH_BITS, np.int32), _Seen()
        ids, sizes, sigs = [], [], []

        def out(kind, a, b, c, data):
            return pa.RecordBatch.from_arrays([pa.array([kind] * len(a), pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64()), pa.array(data, pa.binary())], ["kind", "doc_id", "n", "sig", "counts"])

        for i, grams in _rows_of(batches, n):
            sig = _signature(grams) if len(grams) else None
            if sig is not None and seen.first(sig):
                np.add.at(sketch, (grams & LOW56) >> np.uint64(56 - SKETCH_BITS), 1)
            ids.append(i), sizes.append(len(grams)), sigs.append(sig)
            if len(ids) >= 10_000:
                yield out(0, ids, sizes, sigs, [None] * len(ids))
                ids, sizes, sigs = [], [], []
        yield out(0, ids, sizes, sigs, [None] * len(ids))
        if sketch.any():
            task = TaskContext.get().partitionId()
            yield out(1, list(range(SKETCH_PARTS)), [task] * SKETCH_PARTS, [None] * SKETCH_PARTS, [zlib.compress(x.astype("<i8").tobytes(), 1) for x in np.split(sketch, SKETCH_PARTS)])

    return run


def _added(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(zlib.decompress(x), "<i8") for x in group.column("counts").to_pylist())
    return pa.table({"doc_id": group.column("doc_id")[:1], "n": group.column("n")[:1], "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def frequency_classes(sketches: DataFrame) -> np.ndarray:
    """Per counter of the corpus-wide sketch a class that grows with its logarithm.

    Sketches of tasks are added up as a tree of ``FAN_IN``; the driver gets one.
    """
    top = sketches.agg(F.max("n")).first()[0]
    classes = np.zeros(1 << SKETCH_BITS, np.uint8)
    if top is None:
        return classes
    while True:
        sketches = sketches.withColumn("n", F.floor(F.col("n") / FAN_IN)).groupBy("doc_id", "n").applyInArrow(_added, "doc_id long, n long, counts binary")
        top //= FAN_IN
        if not top:
            break
    for r in sketches.collect():
        counts = np.frombuffer(zlib.decompress(r["counts"]), "<i8")
        at = r["doc_id"] * len(counts)
        classes[at : at + len(counts)] = np.minimum(np.round(5 * np.log2(1 + counts)), 255)
    return classes


def ordered(grams: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Column keys whose numeric order puts rare n-grams first: frequency class in 8 bits, hash in 56."""
    low = grams & LOW56
    return (classes[low >> np.uint64(56 - SKETCH_BITS)].astype(np.uint64) << np.uint64(56)) | low


def prefix_length(size, percent: int):
    """Columns of a row of which one is shared with every row linked to it."""
    return size - (percent * size + 99) // 100 + 1


def early_length(size, percent: int):
    """Columns of a row of which one is in the prefix of every linked row that is not smaller."""
    return size - least_shared(size, size, percent) + 1


def least_shared(m, n, percent: int):
    """n-grams that linked sets of m and n have in common at least."""
    return -(-percent * (m + n) // (100 + percent))


ENTRY = np.dtype([("key", "<u8"), ("sig", "<i8"), ("n", "<i4"), ("early", "u1")])
MEMBER = np.dtype([("h", "<i8"), ("x", "<i8"), ("n", "<i4")])


def pack(items: np.ndarray) -> bytes:
    """Records as compressed byte planes: what sorted or repeated values share costs little."""
    return zlib.compress(np.ascontiguousarray(items).view(np.uint8).reshape(len(items), -1).T.tobytes(), 1)


def unpack(data: bytes, dtype: np.dtype) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(dtype.itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def unpacked(column: pa.ChunkedArray, dtype: np.dtype) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *(unpack(x, dtype) for x in column.to_pylist())])


def packets(items: np.ndarray, dealt: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(numbers, packed records) of items dealt by number, each packet in the items' order."""
    order = np.argsort(dealt, kind="stable")
    items, dealt = items[order], dealt[order]
    cuts = np.flatnonzero(np.r_[True, dealt[1:] != dealt[:-1], True]) if len(dealt) else np.zeros(1, np.int64)
    return dealt[cuts[:-1]], [pack(items[a:z]) for a, z in zip(cuts[:-1], cuts[1:], strict=True)]


def distinct(items: np.ndarray, *fields: str) -> np.ndarray:
    """Records in the order of the fields, first field first, equal ones once."""
    items = items[np.lexsort([items[f] for f in reversed(fields)])]
    new = np.zeros(len(items), bool)
    new[:1] = True
    for f in fields:
        new[1:] |= items[f][1:] != items[f][:-1]
    return items[new]


def size_bounds(percent: int) -> np.ndarray:
    """Lower ends of size classes: linked rows lie in one class or in neighbouring ones."""
    ends = [1]
    while ends[-1] < 1 << 31:
        ends.append(100 * ends[-1] // percent + 1)
    return np.array(ends)


def _hot_class(rows: int) -> int:
    return int(np.round(5 * np.log2(1 + rows)))


def _salt_of(entries: np.ndarray, hot: int) -> np.ndarray:
    """0, but for hot columns a number that grows with their rows, by the row's signature."""
    over = np.maximum((entries["key"] >> np.uint64(56)).astype(np.int64) - hot, -1)
    salts = np.where(over < 0, 1, 2 ** np.minimum(over // 5 + 1, 20))
    return (mix(entries["sig"].astype(np.uint64)) % salts.astype(np.uint64)).astype(np.uint64)


def _prefixes(n: int, percent: int, classes, blocks: int, hot: int):
    """Per block of columns, packed entries of the rows' prefixes."""

    def run(batches):
        table, seen = np.frombuffer(zlib.decompress(classes.value), np.uint8), _Seen()
        held, size = [], 0

        def flush():
            entries = np.concatenate(held)
            entries = entries[np.argsort(entries["key"], kind="stable")]
            block = ((entries["key"] + _salt_of(entries, hot)) & np.uint64(blocks - 1)).astype(np.int64)
            numbers, data = packets(entries, block)
            return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(data, pa.binary())], ["block", "entries"])

        for _, grams in _rows_of(batches, n):
            if not len(grams):
                continue
            sig = _signature(grams)
            if not seen.first(sig):
                continue
            keys = ordered(grams, table)
            keys = np.sort(np.partition(keys, p - 1)[:p]) if (p := prefix_length(len(keys), percent)) < len(keys) else np.sort(keys)
            entries = np.empty(len(keys), ENTRY)
            entries["key"], entries["sig"], entries["n"] = keys, sig, len(grams)
            entries["early"] = np.arange(len(keys)) < early_length(len(grams), percent)
            held.append(entries)
            size += len(entries)
            if size >= 500_000:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return run


PACKETS = "kind int, part long, data binary"


def memberships(entries: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MEMBERs of the columns of entries (distinct rows per column).

    In a column, the rows of one size class form a group with those of the
    next class, named by the first row that has the column early; smaller rows
    are left out, for of two linked rows the smaller has a shared column early.
    So any two rows that may link are together in a group.
    """
    entries = entries[np.lexsort((entries["sig"], entries["n"], entries["key"]))]
    key, n = entries["key"], entries["n"]
    if not len(key):
        return np.zeros(0, MEMBER)
    size, place = np.searchsorted(bounds, n, side="right"), np.arange(len(key))
    start = np.ones(len(key), bool)
    start[1:] = (key[1:] != key[:-1]) | (size[1:] != size[:-1])
    at = np.flatnonzero(start)
    run = np.cumsum(start) - 1
    first = np.minimum.reduceat(np.where(entries["early"] > 0, place, len(key)), at)
    before = np.full(len(at), len(key))
    before[1:] = np.where((key[at[1:]] == key[at[:-1]]) & (size[at[1:]] == size[at[:-1]] + 1), first[:-1], len(key))
    own, guest = first[run], before[run]
    mine, others = place > own, guest < len(key)
    out = np.empty(int(mine.sum() + others.sum()), MEMBER)
    out["h"] = entries["sig"][np.r_[own[mine], guest[others]]]
    out["x"], out["n"] = np.r_[entries["sig"][mine], entries["sig"][others]], np.r_[n[mine], n[others]]
    return distinct(out, "x", "h")


def _column_block(percent: int, parts: int, hot: int):
    """One block of columns: (0, part of x, packed MEMBERs), and the rows of hot columns, which lie in several blocks: (1, part of row, packed ENTRYs)."""

    def run(block: pa.Table) -> pa.Table:
        entries = distinct(unpacked(block.column("entries"), ENTRY), "key", "sig")  # tasks may repeat a row
        wide = (entries["key"] >> np.uint64(56)).astype(np.int64) >= hot
        members = memberships(entries[~wide], size_bounds(percent))
        at0, data0 = packets(members, members["x"] % parts)
        at1, data1 = packets(entries[wide], entries["sig"][wide] % parts)
        kind = np.r_[np.zeros(len(at0), np.int32), np.ones(len(at1), np.int32)]
        return pa.table({"kind": kind, "part": np.r_[at0, at1].astype(np.int64), "data": pa.array(data0 + data1, pa.binary())})

    return run


def _members_of(part: pa.Table) -> pa.Table:
    """Distinct members of one part."""
    members = distinct(unpacked(part.column("data"), MEMBER), "x", "h")
    return pa.table({"h": members["h"], "x": members["x"], "n": members["n"].astype(np.int64)})


def _hot_entries(percent: int):
    def run(batches):
        bounds = size_bounds(percent)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                e = unpack(data, ENTRY)
                size = np.searchsorted(bounds, e["n"], side="right")
                yield pa.RecordBatch.from_arrays([pa.array(e["key"].view(np.int64)), pa.array(size), pa.array(e["sig"]), pa.array(e["n"].astype(np.int64)), pa.array(e["early"] > 0)], ["key", "size", "x", "n", "early"])

    return run


def hub_members(rows: DataFrame) -> DataFrame:
    """Members of the groups of rows (key, size, x, n, early): the smallest row of each size class comes from partial minima, and adaptive execution splits a hot key's join."""
    hubs = rows.filter("early").groupBy("key", "size").agg(F.min(F.struct("n", "x")).alias("hub"))
    own, guest = rows.join(hubs, ["key", "size"]).filter("n > hub.n or (n = hub.n and x > hub.x)"), rows.join(hubs.withColumn("size", F.col("size") + 1), ["key", "size"])
    return own.unionByName(guest).select(F.col("hub.x").alias("h"), "x", "n").distinct()


def _hot_members(packed: DataFrame, percent: int) -> DataFrame:
    """Members of hot columns."""
    return hub_members(stored(packed.mapInArrow(_hot_entries(percent), "key long, size long, x long, n long, early boolean"), "hot"))


def _rows_like(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id and text of the rows that stand for the signatures wanted (x, rep), and of some others that the filter lets through."""
    bits = filter_bits(wanted)
    return probe(docs.withColumn("_key", F.col("doc_id")), "_key", member_filter(wanted, "rep", bits), "_in", bits).filter("_in").select("doc_id", "text")


def _heads(n: int, percent: int, classes):
    """Per row its signature, set size, the mean frequency class of its n-grams, and its prefix in 32 bits a column."""

    def run(batches):
        table = np.frombuffer(zlib.decompress(classes.value), np.uint8)
        for batch in batches:
            x, size, mass, head = [], [], [], []
            for _, grams in _rows_of(iter([batch]), n):
                if len(grams):
                    keys = ordered(grams, table)
                    p = prefix_length(len(keys), percent)
                    first = np.partition(keys, p - 1)[:p] if p < len(keys) else keys
                    x.append(_signature(grams)), size.append(len(grams)), mass.append(float((keys >> np.uint64(56)).mean()))
                    head.append((mix(first) >> np.uint64(32)).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(size, pa.int64()), pa.array(mass, pa.float64()), pa.array(head, pa.binary())], ["x", "n", "mass", "head"])

    return run


def _sets(n: int):
    """Per row its signature and all n-grams."""

    def run(batches):
        for batch in batches:
            sets = [g for _, g in _rows_of(iter([batch]), n) if len(g)]
            yield pa.RecordBatch.from_arrays([pa.array([_signature(g) for g in sets], pa.int64()), pa.array([g.tobytes() for g in sets], pa.binary())], ["x", "grams"])

    return run


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many entries every row of left shares with every row of right.

    The incidence matrices of both sides are multiplied by blocks of columns
    and the counts added up; columns that one side lacks are left out.
    """
    if len(left) * len(right) <= 12:
        count = lambda a, b: int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
        return np.array([[count(a, b) if len(a) < len(b) else count(b, a) for b in right] for a in left])
    same = right is left
    sides = [left] if same else [left, right]
    rows = [np.repeat(np.arange(len(s)), [len(g) for g in s]) for s in sides]
    names, column = np.unique(np.concatenate([g for s in sides for g in s]), return_inverse=True)
    columns = np.split(column, [len(rows[0])])[: len(sides)]
    counts = [np.bincount(c, minlength=len(names)) for c in columns]
    shared = counts[0] > 1 if same else (counts[0] > 0) & (counts[1] > 0)
    place = np.cumsum(shared) - 1
    total, width = np.zeros((len(left), len(right)), np.float32), int(shared.sum())
    sides = []
    for r, c in zip(rows, columns, strict=True):
        keep = shared[c]
        r, c = r[keep], place[c[keep]]
        order = np.argsort(c, kind="stable")
        sides.append((r[order], c[order]))
    for lo in range(0, width, BLOCK_COLUMNS):
        blocks = []
        for (r, c), size in zip(sides, (len(left), len(right)), strict=False):
            a, z = np.searchsorted(c, [lo, lo + BLOCK_COLUMNS])
            block = np.zeros((size, min(BLOCK_COLUMNS, width - lo)), np.float32)
            block[r[a:z], c[a:z] - lo] = 1
            blocks.append(block)
        total += blocks[0] @ blocks[-1].T
    total = total.astype(np.int64)
    if same:
        np.fill_diagonal(total, [len(g) for g in left])
    return total


def forest(names: list, role: np.ndarray, label: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of role 1 (or 3) and role 2 (or 3) of different labels, reduced to stars: (row, the smallest row it reaches)."""
    l, r = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
    names = np.array(names, np.int64)
    left = [sets[i] for i in l]
    shared = overlaps(left, left if len(l) == len(r) and (l == r).all() else [sets[i] for i in r])
    n = np.array([len(g) for g in sets])
    linked = (100 * shared >= percent * (n[l][:, None] + n[r][None, :] - shared)) & (label[l][:, None] != label[r][None, :])
    i, j = np.nonzero(linked)
    return least_labels(names[l[i]], names[r[j]])


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal first columns; one run is held at a time."""
    at, held = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for key, row in zip(zip(*columns[:keys], strict=True), zip(*columns[keys:], strict=True), strict=True):
            if key != at:
                if held:
                    yield at, held
                at, held = key, []
            held.append(row)
    if held:
        yield at, held


def _tiles(percent: int):
    """Partitions sorted by tile (h, u, a): the links of each, as stars."""

    def run(batches):
        for _, held in _grouped(batches, 3):
            if len(held) > 1:
                role, x, label, grams = zip(*held, strict=True)
                v, c = forest(list(x), np.array(role), np.array(label), [np.frombuffer(g, "<u8") for g in grams], percent)
                if len(v):
                    yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(c)], ["a", "b"])

    return run


def _partnered(percent: int):
    """Partitions sorted by group: its members (h, x) that may link with another one.

    Of linked rows x and y, all but max(|x| - p(x), |y| - p(y)) shared columns
    lie in both prefixes, so the counts of the prefixes' product must reach
    what is left of the least overlap.
    """

    def run(batches):
        for (h,), held in _grouped(batches, 1):
            x, size, head = zip(*held, strict=True)
            n = np.array(size)
            heads = [np.unique(np.frombuffer(b, "<u4")) for b in head]
            shared = overlaps(heads, heads)
            rest = n - prefix_length(n, percent)
            lost = prefix_length(n, percent) - np.array([len(b) for b in heads])  # columns equal in 32 bits
            need = least_shared(n[:, None], n[None, :], percent) - np.maximum(rest[:, None], rest[None, :]) - np.maximum(lost[:, None], lost[None, :])
            met = shared >= np.maximum(need, 1)
            np.fill_diagonal(met, False)
            keep = np.array(x, np.int64)[met.any(1)]
            if len(keep):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keep), h, np.int64)), pa.array(keep)], ["h", "x"])

    return run


TILE = ["h", "u", "a", "role", "x", "c"]


def _links(tiles: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) found in tiles (h, u, a, role, x, c): their rows' n-grams meet in one task per tile."""
    full = tiles.select(*TILE).join(rows.select("x", "grams"), "x").select(*TILE, "grams").repartition("h", "u", "a").sortWithinPartitions("h", "u", "a")
    return stored(full.mapInArrow(lean(_tiles(percent)), "a long, b long"), "links")


def _dealt(by: str, into: str):
    return F.pmod(F.xxhash64(by), F.col(into)).cast("int")


def _numbers(upto: str):
    return F.explode(F.sequence(F.lit(0), F.col(upto) - 1))


def _first_tiles(members: DataFrame, mass: DataFrame) -> DataFrame:
    """Groups of one tile whole; in larger ones every row meets the pivots, of each of PIVOTS parts the row of the largest mass."""
    zero = F.lit(0).alias("u")
    small = members.filter("k = 1").select("h", zero, F.lit(0).alias("a"), F.lit(3).alias("role"), "x", F.col("x").alias("c"))
    large = members.filter("k > 1")
    spoke = large.select("h", zero, _dealt("x", "k").alias("a"), F.lit(2).alias("role"), "x", F.col("x").alias("c"))
    salt = F.pmod(F.xxhash64("x", F.lit(7)), F.lit(PIVOTS))
    pivots = large.join(mass, "x").groupBy("h", "k", salt.alias("salt")).agg(F.max_by("x", F.struct("mass", "x")).alias("x"))
    hub = pivots.select("h", zero, _numbers("k").alias("a"), F.lit(1).alias("role"), "x", F.lit(-1).cast("long").alias("c"))
    return small.unionByName(spoke).unionByName(hub)


def _open_tiles(members: DataFrame, inside: DataFrame, rows_a_tile: int) -> DataFrame:
    """Of large groups that still hold several components: all rows outside the largest against all rows."""
    label = F.coalesce("c", "x").alias("c")
    large = stored(members.filter("k > 1").join(inside.withColumnRenamed("v", "x"), "x", "left").select("h", "x", "k", label), "large")
    sizes = large.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("h").agg(F.max_by("c", F.struct("n", "c")).alias("main"), (F.sum("n") - F.max("n")).alias("outside"))
    main = main.filter("outside > 0").select("h", "main", F.ceil(F.col("outside") / rows_a_tile).cast("int").alias("ku"))
    named = large.join(main, "h")
    left = named.filter("c <> main").select("h", _dealt("x", "ku").alias("u"), _numbers("k").alias("a"), F.lit(1).alias("role"), "x", "c")
    right = named.select("h", _numbers("ku").alias("u"), _dealt("x", "k").alias("a"), F.lit(2).alias("role"), "x", "c")
    return left.unionByName(right)


def grouped(members: DataFrame, tile_rows: int, tile_grams: int) -> DataFrame:
    """Members (h, x, n) as (h, x, k): k tiles a side hold the group h, to which h itself belongs."""
    tiles = F.ceil(F.greatest((F.count(F.lit(1)) + 1) / tile_rows, F.sum("n") / tile_grams)).cast("int").alias("k")
    groups = members.groupBy("h").agg(tiles)
    return stored(members.select("h", "x").join(groups, "h").unionByName(groups.select("h", F.col("h").alias("x"), "k")), "groups")


def resolved(docs: DataFrame, own: DataFrame, classes: DataFrame, members: DataFrame, mass: DataFrame, n: int, percent: int, tile_rows: int) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of own (doc_id, n, sig), from the links within groups (h, x, k) of distinct sets.

    classes: sig and rep, the smallest doc_id with that set; mass: x and the
    number by which a large group's pivots are picked.
    """
    represented = classes.select(F.col("sig").alias("x"), "rep")
    wanted = stored(members.select("x").distinct().join(represented, "x"), "wanted")
    rows = stored(_rows_like(docs, wanted).mapInArrow(lean(_sets(n)), "x long, grams binary").join(wanted.select("x"), "x", "left_semi"), "rows")
    links = _links(_first_tiles(members, mass), rows, percent)
    inside = components(links)
    if members.filter("k > 1").limit(1).count():
        more = _links(_open_tiles(members, inside, tile_rows), rows, percent)
        inside = components(links.unionByName(more))
    named = stored(classes.join(inside, F.col("sig") == F.col("v"), "left").select("sig", "rep", F.coalesce("c", "sig").alias("c")), "named")
    least = stored(named.groupBy("c").agg(F.min("rep").alias("component_id")), "least")
    by_sig = stored(named.join(least, "c").select("sig", "component_id"), "by-sig")
    full = own.filter("sig is not null").join(by_sig, "sig")  # both sides come from tables: adaptive execution splits a hot set
    alone = own.filter("sig is null").withColumn("component_id", F.col("doc_id"))
    return full.select("doc_id", "n", "component_id").unionByName(alone.select("doc_id", "n", "component_id")).withColumnRenamed("n", "n_shingles")


def jaccard_classes(docs: DataFrame, n: int = NGRAM, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = 100_000, tile_rows: int = 512, tile_grams: int = 2_000_000) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Links are pairs whose sets of word n-grams have 100 |x & y| >= percent
    |x | y|; component_id is the smallest doc_id reachable by links.  A text
    without words, or null, has no n-grams and is linked with nothing.  Equal
    sets are one row of the product.  Rows repeating an id are linked like any
    others and share the id.  Null ids come last: a component of null ids only
    has a null id.  Other columns of docs are ignored.

    hot_rows: columns of more rows are dealt over several tasks; tile_rows,
    tile_grams: what one side of a tile holds, about.  They change no result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    summary = stored(docs.mapInArrow(lean(_summaries(n)), SUMMARY), "summaries")
    own = summary.filter("kind = 0").select("doc_id", "n", "sig")
    classes = stored(own.filter("sig is not null").groupBy("sig").agg(F.min("n").alias("n"), F.min("doc_id").alias("rep")), "classes")
    order = frequency_classes(summary.filter("kind = 1").select("doc_id", "n", "counts"))
    order = spark.sparkContext.broadcast(zlib.compress(order.tobytes(), 1))
    entries = classes.agg(F.sum(F.expr(f"n - cast(floor(({percent} * n + 99) / 100) as long) + 1"))).first()[0] or 0
    blocks = 1 << max(10, int(np.ceil(np.log2(max(1, entries / BLOCK_ENTRIES)))))
    hot, parts = _hot_class(hot_rows), max(1, blocks // 8)
    packed = docs.mapInArrow(lean(_prefixes(n, percent, order, blocks, hot)), "block long, entries binary")
    product = stored(packed.groupBy("block").applyInArrow(_column_block(percent, parts, hot), PACKETS), "product")
    members = product.filter("kind = 0").groupBy("part").applyInArrow(_members_of, "h long, x long, n long")
    if product.filter("kind = 1").limit(1).count():
        members = members.unionByName(_hot_members(product.filter("kind = 1").select("data"), percent)).distinct()
    members = stored(members, "members")
    members = grouped(members, tile_rows, tile_grams)
    # a row that comes twice only repeats its links; those outside groups meet nothing
    represented = classes.select(F.col("sig").alias("x"), "rep")
    wanted = stored(members.select("x").distinct().join(represented, "x"), "wanted")
    heads = stored(_rows_like(docs, wanted).mapInArrow(lean(_heads(n, percent, order)), "x long, n long, mass double, head binary"), "heads")
    small = members.filter("k = 1").select("h", "x").join(heads.select("x", "n", "head"), "x").select("h", "x", "n", "head")
    met = small.repartition("h").sortWithinPartitions("h").mapInArrow(lean(_partnered(percent)), "h long, x long")
    members = stored(met.withColumn("k", F.lit(1)).unionByName(members.filter("k > 1")), "partners")
    return resolved(docs, own, classes, members, heads.select("x", "mass"), n, percent, tile_rows)


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(read(spark, sf_dir, "documents"))
