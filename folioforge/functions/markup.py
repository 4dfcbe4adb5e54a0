"""Markdown to plain text: one scan over the lines, then one scan for each kind of inline mark.

Kinds are taken off in this order: images, links, bold, italic, code,
addresses in angle brackets, formulas.  A scan walks from mark to mark with
``str.find``; a mark without its partner stays as it is.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: fixed values: raised and lowered forms
RAISED = str.maketrans("0123456789e+-()n", "⁰¹²³⁴⁵⁶⁷⁸⁹ᵉ⁺⁻⁽⁾ⁿ")
LOWERED = str.maketrans("0123456789+-()", "₀₁₂₃₄₅₆₇₈₉₊₋₍₎")
FENCE = "```"


def _scanned(text: str, mark: str, read: Callable[[str, int], tuple[int, str] | None]) -> str:
    """text in which, from left to right, read(text, place of a mark) may give (the place after it, what stays)."""
    out, done, at = [], 0, text.find(mark)
    while at >= 0:
        got = read(text, at)
        if got:
            out += [text[done:at], got[1]]
            done = at = got[0]
        at = text.find(mark, at + (not got))
    return "".join(out) + text[done:]


def _target(text: str, at: int) -> tuple[int, str] | None:
    """[label](target) at a place: the label."""
    middle = text.find("]", at + 1)
    end = text.find(")", middle + 2) if middle > 0 and text.startswith("(", middle + 1) else -1
    return (end + 1, text[at + 1 : middle]) if end > 0 else None


def _image(text: str, at: int) -> tuple[int, str] | None:
    got = _target(text, at + 1)
    return (got[0], "") if got else None


def _doubled(text: str, at: int) -> tuple[int, str] | None:
    """**text** or __text__ within a line."""
    mark = text[at : at + 2]
    end = text.find(mark, at + 3) if mark in ("**", "__") else -1
    return (end + 2, text[at + 2 : end]) if end > 0 and "\n" not in text[at:end] else None


def _wordlike(text: str, at: int) -> bool:
    return 0 <= at < len(text) and (text[at].isalnum() or text[at] in "_*")


def _single(text: str, at: int) -> tuple[int, str] | None:
    """*text* within a line: words touch the stars from inside, never from outside."""
    if _wordlike(text, at - 1) or text[at + 1 : at + 2].isspace():
        return None
    line = text.find("\n", at)
    end = text.find("*", at + 2, line if line > 0 else len(text))
    while end > 0 and (text[end - 1].isspace() or _wordlike(text, end + 1)):
        end = text.find("*", end + 1, line if line > 0 else len(text))
    return (end + 1, text[at + 1 : end]) if end > 0 else None


def _code(text: str, at: int) -> tuple[int, str] | None:
    end = text.find("`", at + 1)
    return (end + 1, text[at + 1 : end]) if end > at + 1 else None


def _address(text: str, at: int) -> tuple[int, str] | None:
    end = text.find(">", at)
    inner = text[at + 1 : end]
    scheme, _, rest = inner.partition("://")
    return (end + 1, inner) if end > 0 and scheme in ("http", "https") and rest and not any(c.isspace() for c in inner) else None


def _braced(mark: str, forms: dict) -> Callable[[str, int], tuple[int, str] | None]:
    def read(text: str, at: int) -> tuple[int, str] | None:
        end = text.find("}", at + 2)
        return (end + 1, text[at + 2 : end].translate(forms)) if end > 0 else None

    return read


def _command(text: str, at: int) -> tuple[int, str] | None:
    r"""\name and the white space after it."""
    end = at + 1
    while text[end : end + 1].isascii() and text[end : end + 1].isalpha():
        end += 1
    if end == at + 1:
        return None
    while text[end : end + 1].isspace():
        end += 1
    return end, ""


def _formula(text: str, at: int) -> tuple[int, str] | None:
    r"""$...$ within a line, if it holds one of \ ^ _: raised and lowered digits spelt out, commands and braces dropped."""
    end = text.find("$", at + 1)
    inner = text[at + 1 : end]
    if end < 0 or "\n" in inner or not any(c in inner for c in "\\^_"):
        return None
    inner = _scanned(_scanned(inner, "^{", _braced("^{", RAISED)), "_{", _braced("_{", LOWERED))
    return end + 1, "".join(c for c in _scanned(inner, "\\", _command) if c not in "^_{}")


SCANS = (("![", _image), ("[", _target), ("*_", _doubled), ("*", _single), ("`", _code), ("<", _address), ("$", _formula))


def _bold(text: str) -> str:
    """Bold of both kinds, in one walk: whichever opens first is read first."""
    out, done, at = [], 0, 0
    while True:
        places = [p for p in (text.find("**", at), text.find("__", at)) if p >= 0]
        if not places:
            return "".join(out) + text[done:]
        at = min(places)
        got = _doubled(text, at)
        if got:
            out += [text[done:at], got[1]]
            done = at = got[0]
        else:
            at += 1


def _only_marks(line: str) -> bool:
    """A fence, a rule of three or more equal signs, or the row of dashes under a table's head."""
    bare = line.strip()
    if bare.startswith(FENCE):
        return True
    if len(bare) > 2 and bare[0] in "-*_" and bare == bare[0] * len(bare):
        return True
    cells = [c.strip() for c in bare.removeprefix("|").removesuffix("|").split("|")]
    return all(c.removeprefix(":").removesuffix(":").strip("-") == "" and "-" in c for c in cells)


def _unmarked(line: str) -> str:
    """A line without its heading or quote marks; the cells of a table row by tabs."""
    lead = len(line) - len(line.lstrip())
    rest = line[lead:]
    if lead <= 3:
        level = len(rest) - len(rest.lstrip("#"))
        if 0 < level < 7 and rest[level : level + 1].isspace():
            line = rest[level:].lstrip()
    lead = len(line) - len(line.lstrip())
    if lead <= 3 and line[lead : lead + 1] == ">":
        line = line[lead + 1 :]
        line = line[1:] if line[:1].isspace() else line
    row = line.strip()
    if len(row) > 1 and row[0] == row[-1] == "|":
        return "\t".join(c.strip() for c in row.strip("|").split("|"))
    return line


def plain(text: str | None) -> str:
    """Markdown as plain text: no line ends in blanks, and no two blank lines follow each other."""
    text = "\n".join(_unmarked(x) for x in (text or "").splitlines() if not _only_marks(x))
    for mark, read in SCANS:
        text = _bold(text) if read is _doubled else _scanned(text, mark, read)
    lines = [x.rstrip() for x in text.split("\n")]
    return "\n".join(x for i, x in enumerate(lines) if x or not i or lines[i - 1]).strip()


@F.arrow_udf(returnType=T.StringType())
def _plain(texts: pa.Array) -> pa.Array:
    return pa.array(map(plain, texts.to_pylist()), pa.string())


def strip_line_markup(text: Column) -> Column:
    """Markdown to plain text: marks dropped, links and emphasis unwrapped, images dropped, table rows by tabs, formulas spelt out; null is empty."""
    return _plain(text)
