"""The path-template tree at any depth and any number of pages."""

import pytest
from pyspark.sql import functions as F

pytest.importorskip("folioforge.llm")
from folioforge.llm import url_templates  # noqa: E402


def test_branches_below_eight_segments(spark):
    urls = [(i, f"http://h.test/a/b/c/d/e/f/g/h/i/{'bad' if i % 2 else 'good'}/p{i}") for i in range(200)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(200)], "page_id long, good int")
    got = {r["page_id"]: r["verdict"] for r in url_templates.filter_urls(pages, labels, rules=()).collect()}
    assert got == {i: "block" if i % 2 else "allow" for i in range(200)}


def test_wildcards_do_not_depend_on_the_number_of_pages(spark):
    def found(copies):
        rows = [("h", f"/{chr(97 + i % 10)}{chr(97 + i // 10)}") for i in range(60) for _ in range(copies)] + [("h", "/common")] * (20 * copies)
        return {r["template"] for r in url_templates.templates(spark.createDataFrame(rows, "host string, raw string").select(F.col("host"), F.col("raw"))).collect()}

    assert found(3) == found(40) == {"/{*}", "/common"}
