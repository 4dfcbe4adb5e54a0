"""Queries where positions or ids repeat, against their SQL on small tables, and what grows with tables."""

import duckdb
import pytest

from folioforge.plans import ORACLES, QUERIES


@pytest.fixture
def same(spark, tmp_path):
    """Runs a query over tables (name -> rows, columns) in Spark and its SQL in DuckDB; returns the rows, which must be equal."""

    def run(name, **tables):
        con = duckdb.connect()
        for table, (rows, columns) in tables.items():
            spark.createDataFrame(rows, columns).coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
        df = QUERIES[name](spark, str(tmp_path))
        result = con.execute(ORACLES[name])
        columns = [c[0] for c in result.description]
        got, want = [tuple(map(str, r)) for r in df.select(*columns).collect()], result.fetchall()
        assert sorted(got) == sorted(tuple(map(str, r)) for r in want)
        return want

    return run


def test_one_of_references_at_the_same_position_is_first(same):
    lines = [(1, 1, 5), (1, 1, 5), (1, 1, 5), (2, 1, 5), (1, 2, 7), (1, 2, 7), (3, 1, 6), (3, 1, 6), (19, 1, 5), (19, 1, 5), (23, 1, 5), (29, 1, 5), (4, 1, None)]
    want = same("reverse_ref_status", lineitem=(lines, "l_orderkey long, l_linenumber int, l_partkey long"), part=([(5, 1), (6, 5), (6, 1), (7, 1)], "p_partkey long, p_size int"))
    # part 6 is there twice, so that its rows count twice, as in a join
    assert dict(want) == {"article": 2, "duplicate": 6, "fetch_error": 1, "non_article": 2, "invalid": 4}


def test_long_listings_are_read_in_runs_of_pages(spark, tmp_path):
    from folioforge.sources import listing as L

    items = spark.range(900).selectExpr("id % 2 AS set_id", "id AS item_id", "concat('[', id, ']') AS raw")
    path = f"{tmp_path}/r"
    L.record_pages(items, path, 3)
    parts = L._Reader(path, 3).partitions()
    pages = [(q.set_id, q.page) for p in parts for q in (p, *p.then)]
    assert pages == [(s, n) for s in (0, 1) for n in range(1, 151)] and len(parts) <= L.TASKS
    got = L.read_listing(spark, path, 3).selectExpr("set_id", "page", "pos", "raw").collect()
    assert sorted(map(tuple, got)) == sorted((i % 2, i // 2 // 3 + 1, i // 2 % 3, f"[{i}]") for i in range(900))
    with pytest.raises(FileExistsError):
        L.record_pages(items, path, 3)
    assert [p.name for p in tmp_path.iterdir()] == ["r"]


ODD = ["l'ÉTÉ de  la MER", "ß ßa Straße", "’x a'b'c ' '", "DE\tΣΑΣ\vvan", " ", "\n", "ǆ ŉa İ ﬁn", "L’ D’un", " a b", "😀É 'ß", "el"]


def test_names_are_cleaned_alike_in_arrow_and_sql(spark):
    from folioforge.functions import text as X

    got = spark.createDataFrame([(x,) for x in ODD], "name string").select("name", X.clean_entity("name").alias("clean")).collect()
    clean = X.entity_cleaner()
    assert {r["name"]: r["clean"] for r in got} == {x: clean(x) for x in ODD} == {x: clean(x) for x in ODD}


def test_entities_of_repeated_ids(same):
    rows = [(2, "a b c d"), (3, "a b ville nord"), (3, "q z x Ville y"), (None, "x y z u"), (None, "v w s r"), (4, None), (5, "")]
    want = same("entity_clean_dedup", documents=(rows, "doc_id long, text string"))
    assert [r for r in want if r[0] == 3 and r[1] == "Ville"] == [(3, "Ville", 3)]


def test_entities_of_a_long_text(spark, tmp_path):
    """Work grows with the words, not with their square: minutes before."""
    import time

    long = " ".join(f"w{i % 25_000}" for i in range(100_000))
    spark.createDataFrame([(1, long)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    start = time.time()
    assert QUERIES["entity_clean_dedup"](spark, str(tmp_path)).filter("pos % 4 = 2").count() == 6_250
    assert time.time() - start < 60


def test_corrections_of_repeated_ids_and_none(spark, same, tmp_path):
    rows = [(1, "an the\nthan"), (3, "an than\nx"), (4, "an\nthe than"), (4, "an an\nx"), (None, "an the"), (5, None), (6, "")]
    want = same("ocr_token_apply", documents=(rows, "doc_id long, text string"))
    assert {r[2] for r in want if r[0] is None} == {"an the"} and {r[2] for r in want if r[0] == 1} == {"a1 the", "tha1"}
    # texts are shuffled for no id but the repeated ones
    plan = QUERIES["ocr_token_apply"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftAnti" in plan and plan.index("Join LeftAnti") < plan.index("Join Inner")


def test_keys_of_word_sets_carry_no_words(spark):
    from fractions import Fraction

    from folioforge.operators import setjoin as J

    places = spark.createDataFrame([("b", 1), ("a", 2)], "word string, place int")
    keys = J._keyed(J.ranked(spark.createDataFrame([(["a", "b"],), (["a"],)], "words array<string>"), places), Fraction("0.7"), "n1", "n2")
    assert {t for _, t in keys.dtypes} == {"array<int>", "int"}
    assert {(tuple(r["ordered"]), r["place"], r["n1"], r["n2"]) for r in keys.collect()} == {((1, 2), 1, 2, 2), ((2,), 2, 1, 1)}
