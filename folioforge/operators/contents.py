"""Pages of articles, the index of a document and its table of contents, from nested columns.

Articles are an array of structs titre, auteurs (array), pages, resume, in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sinks import write_parts
from ..sources.files import whole_files

ARTICLES = "array<struct<titre: string, auteurs: array<string>, pages: string, resume: string>>"
#: fixed values: wordings of pages, indexes and contents
COVER = "Page de couverture du magazine."
NO_ARTICLES = "Aucun article identifié sur cette page."
OTHER = "### Autres contenus"
INDEX_TITLE = "# Index des articles du magazine"
AUTHORS, TITLE, PAGES, SUMMARY = "- Auteur(s) : ", "- Titre : ", "- Pages : ", "- Résumé :"


def _lines(*lines: Column | str) -> Column:
    """Lines joined by line ends; null ones are left out."""
    return F.concat_ws("\n", *(F.lit(x) if isinstance(x, str) else x for x in lines))


def _some(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) != ""


def _names(authors: Column) -> Column:
    """Authors by commas, null without any."""
    return F.when(F.coalesce(F.size(authors), F.lit(0)) > 0, F.array_join(authors, ", "))


def _blocks(articles: Column, one) -> Column:
    return F.array_join(F.transform(F.coalesce(articles, F.from_json(F.lit("[]"), ARTICLES)), one), "\n")


def page_markdown(number: Column, cover: Column, articles: Column, other: Column) -> Column:
    """One page: its number, then that it is a cover, that it has no articles, or its articles; other contents last."""
    head = F.concat(F.lit("## Page : "), number.cast("string"), F.lit("\n"))
    one = lambda a, i: _lines(F.concat(F.lit("\n### Article "), (i + 1).cast("string")), F.concat(F.lit(TITLE), F.coalesce(a["titre"], F.lit(""))), F.concat(F.lit(AUTHORS), _names(a["auteurs"])), SUMMARY, F.concat(F.lit("  "), F.coalesce(a["resume"], F.lit(""))))
    none = F.coalesce(F.size(articles), F.lit(0)) < 1
    extra = F.when(_some(other), F.concat(F.lit(f"\n{OTHER}\n"), other))
    return F.when(cover, _lines(head, f"{COVER}\n")).when(none, _lines(head, f"{NO_ARTICLES}\n", F.concat(extra, F.lit("\n")))).otherwise(_lines(head, _blocks(articles, one), extra))


def index_markdown(articles: Column) -> Column:
    """The index of a document: a heading, then title, authors, pages and summary of each article."""
    one = lambda a: _lines(F.concat(F.lit("\n## "), F.coalesce(a["titre"], F.lit(""))), F.concat(F.lit(AUTHORS), _names(a["auteurs"])), F.concat(F.lit(PAGES), F.coalesce(a["pages"], F.lit(""))), SUMMARY, F.concat(F.lit("  "), F.coalesce(a["resume"], F.lit(""))))
    return F.concat(F.lit(f"{INDEX_TITLE}\n\n"), _blocks(articles, one))


def contents(articles: Column) -> Column:
    """The table of contents: 'p. pages : title (authors)' and the summary below, blank lines between; null without articles."""
    one = lambda a: F.concat(F.lit("p. "), F.coalesce(a["pages"], F.lit("")), F.lit(" : "), F.coalesce(a["titre"], F.lit("")), F.coalesce(F.concat(F.lit(" ("), _names(a["auteurs"]), F.lit(")")), F.lit("")), F.lit("\n"), F.coalesce(a["resume"], F.lit("")))
    return F.when(F.size(articles) > 0, F.array_join(F.transform(articles, one), "\n\n"))


def rolled_up(pages: DataFrame) -> DataFrame:
    """pages (doc_id, page, articles) as doc_id, articles: those of all pages, in the pages' order and within a page in their own; page numbers must be unique in a document."""
    each = F.array_sort(F.collect_list(F.struct("page", F.coalesce("articles", F.from_json(F.lit("[]"), ARTICLES)).alias("articles"))))
    return pages.groupBy("doc_id").agg(F.flatten(F.transform(each, lambda x: x["articles"])).alias("articles"))


def write_indexes(rows: DataFrame, path: str) -> None:
    """rows (doc_id, articles) as one JSON file and one Markdown file per document, in folders by kind and id."""
    kinds = {"json": F.to_json(F.struct("articles")), "md": index_markdown(F.col("articles"))}
    for kind, text in kinds.items():
        write_parts(rows.select("doc_id", text.alias("text")), f"{path}/{kind}", ["doc_id"])


def read_indexes(spark, path: str) -> DataFrame:
    """doc_id, articles, markdown of what ``write_indexes`` wrote."""
    number = F.regexp_extract("folder", "^doc_id=([0-9]+)$", 1).cast("long").alias("doc_id")
    data, shown = (whole_files(spark, f"{path}/{kind}", "part-*").select(number, "text") for kind in ("json", "md"))
    articles = F.from_json("text", f"articles {ARTICLES}")["articles"].alias("articles")
    return data.select("doc_id", articles).join(shown.select("doc_id", F.regexp_replace("text", "\n$", "").alias("markdown")), "doc_id")
