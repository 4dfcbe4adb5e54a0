"""Queries over whole texts, on small tables of their own and against brute force."""

import pytest

from folioforge.plans import QUERIES


@pytest.fixture
def folder(spark, tmp_path):
    """Writes documents (doc_id, text, lang, source) and returns their folder."""

    def put(rows):
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
        return str(tmp_path)

    return put


def tidy(text):
    """Line by line: blank ends go, of blank lines in a row one stays, and a line after two or more starts at its first sign."""
    out, gap = [], 0
    for line in text.replace("\xa0", " ").splitlines():
        line = line.rstrip(" \t")
        if line:
            out += [""] * (gap > 0) + [line.lstrip(" \t") if gap > 1 else line]
        gap = 0 if line else gap + 1
    return "\n".join(out).strip()


def test_whitespace_of_whole_texts(spark, folder):
    line = "un  deux, trois \t quatre"
    texts = {1: "\n".join([line] * 400), 2: "a" * 2999 + "\n  b,  c  \n", 3: "x" + "\n" * 4000 + "y", 4: "", 5: None, 6: " \n" * 5000}
    got = {r["doc_id"]: r["text"] for r in QUERIES["md_whitespace"](spark, folder([(k, t, "fr", "s") for k, t in texts.items()])).collect()}
    assert got.keys() == texts.keys()
    for k, text in texts.items():
        if text is not None:
            text = text.replace("\n", " \r\n\n  \n\n").replace(", ", ",\xa0 ") + "  \n"
            text = tidy(text)
        assert got[k] == text
    assert len(got[1]) > 3000 and got[2].endswith("c")


def test_corrections_of_all_lines(spark, folder):
    texts = {1: "\n".join(f"the man {i} and  then" for i in range(50)), 2: "an\n\nthe\nan", 3: "", 4: None, 6: "\nthan"}
    want = []
    for k, text in texts.items():
        for line, x in enumerate(text.split("\n") if text is not None else [], 1):
            fix = x.replace("an", "a1" if (k + 2) % 3 == 0 else "a2")
            want.append((k, line, fix, sum(a != b for a, b in zip(x.split(" "), fix.split(" "), strict=True))))
    got = QUERIES["ocr_token_apply"](spark, folder([(k, t, "fr", "s") for k, t in texts.items()])).select("doc_id", "line", "text", "changed").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert max(x[1] for x in want) == 50


def test_entities_of_all_tokens(spark, folder):
    text = " ".join(["wort"] * 8 + ["zürich", "", "de", "l'ÉTÉ", "straße"] + ["wort"] * 500 + ["letzter"])
    got = {(r["doc_id"], r["clean"]): r["pos"] for r in QUERIES["entity_clean_dedup"](spark, folder([(1, text, "de", "s"), (2, "", "de", "s"), (3, None, "de", "s")])).collect()}
    assert {k[0] for k in got} == {1, 2}
    # positions 9 to 13 and the last, 514
    assert [got[1, x] for x in ("de Zürich", "de", "Côte D'l'été", "de Straße Wort", "Letzter")] == [9, 11, 12, 13, 514]
    assert got[1, "Wort"] == 2 and got[2, "de"] == 1


def test_values_are_whole_texts(spark, folder):
    long = "x" * 40
    rows = [(2, long + "a", "en", "s"), (42, long + "b ", "fr", "s"), (7, None, "en", "s"), (47, long + " c ", "en", "s"), (8, "q", "en", "s"), (48, None, "fr", "s")]
    got = {r["source"]: tuple(r)[1:] for r in QUERIES["value_select_fr_first"](spark, folder(rows)).collect()}
    assert got == {"s-2": (long + "b ", long + "a", 2), "s-7": ("", long + " c", 2), "s-8": ("", "q", 2)}


def test_status_sees_whole_texts(spark, folder):
    long = "x" * 40
    rows = [(2, long + "a", "en", "s"), (2, long + "b", "en", "s"), (3, long, "en", "s"), (6, long * 9, "en", "s")]
    got = {r["status"]: r["n"] for r in QUERIES["literal_upsert_status"](spark, folder(rows)).collect()}
    # the two rows of id 2 meet themselves and each other, which differ after character 40 only
    assert got == {"unchanged": 3, "would_update": 3}
