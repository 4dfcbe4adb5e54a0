"""Article blocks of a Markdown export, links to records, names of media files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import tidy_whitespace
from ..sinks import media_name

#: fixed values: the wording of a block
UNTITLED, UNKNOWN = "No title", "Inconnu"
JOURNAL, DATE, COUNTRY, ITEM, SUMMARY = "**Journal :** ", "**Date :** ", "**Pays :** ", "**Item :** ", "**Résumé (IA) :** "


def _some(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def api_url(base: Column, item_id: Column) -> Column:
    """A record's address in the interface that serves JSON."""
    return F.concat(F.rtrim(base, F.lit("/")), F.lit("/items/"), item_id.cast("string"))


def page_url(base: Column, item_id: Column, site: str) -> Column:
    """A record's public page: beside the interface, whose base ends in /api, under the site's name."""
    root = F.regexp_replace(F.rtrim(base, F.lit("/")), "/api$", "")
    return F.concat(root, F.lit(f"/s/{site}/item/"), item_id.cast("string"))


def article_block(title: Column, date: Column, publishers: Column, country: Column, item_id: Column, text: Column, summary: Column | None = None, url: Column | None = None) -> Column:
    """One article: heading, a line of facts, its machine-written summary if asked for, the tidied text, a rule.

    Null and empty title, date and publishers (an array) are named as unknown;
    country, item, summary and text are left out with their lines.  The item is
    a link where ``url`` is not null.
    """
    names = F.array_join(publishers, "; ")
    number = F.when(item_id != 0, item_id.cast("string"))
    shown = number if url is None else F.coalesce(F.concat(F.lit("["), number, F.lit("]("), url, F.lit(")")), number)
    facts = F.concat_ws(
        " | ",
        F.concat(F.lit(JOURNAL), F.coalesce(_some(names), F.lit(UNKNOWN))),
        F.concat(F.lit(DATE), F.coalesce(_some(date), F.lit(UNKNOWN))),
        F.concat(F.lit(COUNTRY), _some(country)),
        F.concat(F.lit(ITEM), shown),
    )
    told = F.lit(None).cast("string") if summary is None else F.concat(F.lit(SUMMARY), tidy_whitespace(_some(summary)), F.lit("\n"))
    body = F.concat(_some(tidy_whitespace(text)), F.lit("\n"))
    return F.concat_ws("\n", F.concat(F.lit("## "), F.coalesce(_some(title), F.lit(UNTITLED))), facts, F.lit(""), told, body, F.lit("---"), F.lit(""))


def media_file_name(source: Column, item_id: Column, media_id: Column, url: Column, media_type: Column) -> Column:
    """The name a medium came with, made safe; without one item-medium with the address's ending, or the type's."""
    last = F.regexp_extract(url, "([^/]*)$", 1)
    ending = F.lower(F.regexp_extract(last, r"^.*[^.].*?(\.[^.]+)$", 1))
    by_type = F.when(media_type.startswith("video/"), ".mp4").when(media_type.startswith("audio/"), ".mp3").otherwise("")
    made = F.concat(item_id.cast("string"), F.lit("-"), media_id.cast("string"), F.coalesce(_some(ending), by_type))
    return F.coalesce(media_name(_some(source)), made)
