"""Exact round trips of the token store."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("folioforge.llm")
pytest.importorskip("tokenizers")
from folioforge.llm import token_store as S  # noqa: E402


def direct(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(S.default_vocabulary())
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_units_equal_whole_texts():
    rng = random.Random(1)
    alphabet = ["a", "The", "é", " ", " ", "  ", "\n", "\t", ".", ",", "'s", "12", "😀", "<|endoftext|>", " ", "\r\n", "word", "!", "it's,", "a1.", "b?!.", "x,y"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 30))) for _ in range(4000)] + ["", " ", "  ", " a", "a ", "x" * 5000]
    got = S.encoder(S.default_vocabulary()).encode(texts)
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == direct(texts)


def test_crc_shift():
    rng = random.Random(1)
    for _ in range(50):
        a, b = rng.randbytes(rng.randrange(50)), rng.randbytes(rng.randrange(5000))
        got = int(S.shift_crc(np.array([zlib.crc32(a)]), np.array([len(b)]))[0]) ^ zlib.crc32(b)
        assert got == zlib.crc32(a + b)


def test_chunks_follow_content():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 50_000, 20_000).astype("<u2")
    moved = np.r_[a[:100], a]
    cut = lambda x: {x[s:e].tobytes() for s, e in zip(np.r_[0, S.chunk_ends(x, np.array([len(x)]))[:-1]], S.chunk_ends(x, np.array([len(x)])), strict=True)}
    assert len(cut(a) & cut(moved)) > 0.8 * len(cut(a)) and b"".join([]) == b""
    same = np.full(10_000, 7, "<u2")
    assert np.diff(np.r_[0, S.chunk_ends(same, np.array([10_000]))]).max() <= S.MOST_CHUNK


def test_merkle_stream():
    leaves = [bytes([i]) * 32 for i in range(8)]
    r = S.Roots()
    for x in leaves:
        r.add(x)
    assert r.root() == S.merkle(leaves) and S.merkle(leaves[:1]) != S.merkle(leaves[1:2])


def check(spark, docs, path):
    S.write_tokens(docs, path)
    rows = docs.select("doc_id", "text").collect()
    streams = [(r["doc_id"], np.array([*ids, 2], "<u4")) for r, ids in zip(rows, direct([r["text"] for r in rows]), strict=True)]
    got = S.read_tokens(spark, path).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((str(i), len(x), zlib.crc32(x.tobytes())) for i, x in streams)
    got = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in streams), key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    return dict(streams)


def test_corpus_round_trip(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    streams = check(spark, docs, f"{tmp_path}/t")
    some = sorted(streams)[:20]
    for r in S.reconstruct(spark, f"{tmp_path}/t", some).collect():
        assert list(r["ids"]) == streams[r["doc_id"]].tolist()
    stored = S.chunks(spark, f"{tmp_path}/t")
    assert stored.count() == stored.select("digest").distinct().count()


def test_odd_rows(spark, tmp_path):
    rows = [(5, "b  b", "x"), (None, "null id", "x"), (1, None, "x"), (2, "", "x"), (2, "two", "x"), (2, "two", "x"), (9, "long é " * 30_000, "x"), (-3, "<|endoftext|>", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string")
    check(spark, docs, f"{tmp_path}/a")
    S.write_tokens(docs.limit(0), f"{tmp_path}/b")
    assert S.read_tokens(spark, f"{tmp_path}/b").count() == 0


def test_damaged_recipes_do_not_pass(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i} of some words") for i in range(40)], "doc_id long, text string")
    S.write_tokens(docs, f"{tmp_path}/a")
    rows = spark.read.parquet(f"{tmp_path}/a/recipes")
    for name, kept in (("lost", rows.filter("kind = 2 or doc_id <> 7")), ("manifest", rows.filter("kind = 1"))):
        kept.coalesce(1).write.partitionBy("kind").parquet(f"{tmp_path}/{name}/recipes")
        spark.read.parquet(f"{tmp_path}/a/pieces").write.partitionBy("kind").parquet(f"{tmp_path}/{name}/pieces")
        with pytest.raises(Exception, match="manifest"):
            S.read_tokens(spark, f"{tmp_path}/{name}").collect()
    wide = [S._ids_of(np.array([1, 70_000], "<u4").tobytes(), 2).tolist(), S._ids_of(np.array([1, 7], "<u2").tobytes(), 2).tolist()]
    assert wide == [[1, 70_000], [1, 7]]


class Counted:
    """A tokenizer that notes how many characters it is given."""

    def __init__(self, inner):
        self.inner, self.given = inner, 0

    def encode_batch_fast(self, texts, **how):
        self.given += sum(map(len, texts))
        return self.inner.encode_batch_fast(texts, **how)


def test_a_run_owes_nothing_to_earlier_ones():
    enc = S.Encoder(S.default_vocabulary())
    enc.tokenizer = Counted(enc.tokenizer)
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["one", "two,", "three.\nFour", "five  six", "Größe\xa0 7"]) for _ in range(200)) for _ in range(100)]
    given = []
    for _ in range(2):
        enc.tokenizer.given = 0
        got = enc.encode(texts)
        given.append(enc.tokenizer.given)
    assert given[0] == given[1] < sum(map(len, texts)) / 100
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == direct(texts)


def test_units_at_all_kinds_of_white_space():
    rng = random.Random(3)
    spaces = [chr(c) for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]]
    alphabet = [*spaces, *[" ", "\n", "a"] * 8, "B", "\u00e9", "\u00c9", "\u0441\u043b\u043e\u0432\u043e", "\u5b57", "\u2026", "\u2030", "\u3001", "\u0160", "\u1805", ".", ";", "7", "'s", "\x00", "<|", "|>", "<|endoftext|>"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 24))) for _ in range(40_000)]
    assert [np.frombuffer(g, "<u2").tolist() for g in S.encoder(S.default_vocabulary()).encode(texts)] == direct(texts)


def test_added_tokens_that_a_cut_might_split(tmp_path):
    from tokenizers import AddedToken, Tokenizer

    for i, token in enumerate(["new york", AddedToken("<x>", lstrip=True), "e.g."]):
        t = Tokenizer.from_file(S.default_vocabulary())
        t.add_tokens([token])
        t.save(f"{tmp_path}/{i}.json")
        texts = ["in new york now", "in  <x> now", "see e.g. this", "see e.g. this", "", " new", " york", " <x>"]
        want = [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(g, "<u2").tolist() for g in S.Encoder(f"{tmp_path}/{i}.json").encode(texts)] == want


@pytest.mark.parametrize(("portion", "learnt"), [(1, 1), (60, 300), (1 << 24, 1 << 25)])
def test_portions_keep_every_row(monkeypatch, portion, learnt):
    monkeypatch.setattr(S, "PORTION", portion)
    monkeypatch.setattr(S, "LEARNT", learnt)
    texts = [None, "", "one two.\nThree", "", "one two three " * 20, "x", None, "two  one", None, ""]
    rows = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    for size in (1, 3, 100):
        for some in (rows, rows.slice(1), rows.slice(0, 2), rows.slice(0, 0)):
            out = [r for b in S._cut_up(S.default_vocabulary(), 2)(iter(some.to_batches(max_chunksize=size))) for r in b.to_pylist()]
            chunks = {r["digest"]: r["payload"] for r in out if r["kind"] == 0}
            got = {}
            for r in out:
                if r["kind"] == 1:
                    steps = np.frombuffer(r["payload"], S.RECIPE)["digest"]
                    got[r["doc_id"]] = np.frombuffer(b"".join(chunks[s.tobytes()] for s in steps), "<u2").tolist()
                    assert r["n"] == len(got[r["doc_id"]])
            assert list(got) == some["doc_id"].to_pylist()
            assert list(got.values()) == [[*ids, 2] for ids in direct(some["text"].to_pylist())]


def test_chunks_once_over_batches():
    rows = [(0, b"a"), (0, b"a"), (0, b"b"), (0, b"b"), (0, b"b"), (0, b"c"), (1, b"c"), (1, b"c")]
    for size in (1, 2, 3, 8):
        batches = [pa.RecordBatch.from_arrays([pa.array([None] * len(part)), pa.array([k for k, _ in part], pa.int32()), *[pa.array([None] * len(part))] * 2, pa.array([d for _, d in part], pa.binary())], ["key", "kind", "doc_id", "n", "digest"]) for part in (rows[i : i + size] for i in range(0, 8, size))]
        got = [(r["kind"], r["digest"]) for b in S._once(iter([batches[0].slice(0, 0), *batches])) for r in b.to_pylist()]
        assert got == [(0, b"a"), (0, b"b"), (0, b"c"), (1, b"c"), (1, b"c")]
