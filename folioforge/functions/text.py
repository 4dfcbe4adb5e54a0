"""Scalar text expressions: folds, whitespace, redaction, entity cleaning, durations."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _mark_table() -> tuple[str, str]:
    """Characters that are a base letter with marks, then all marks alone; and the base letters. Those beyond them are dropped by translate."""
    bare = {c: "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn") for c in map(chr, range(0xC0, 0x3000))}
    letters = [c for c, b in bare.items() if len(b) == 1 and b != c]
    return "".join(letters) + "".join(c for c, b in bare.items() if not b), "".join(bare[c] for c in letters)


ACCENTED, PLAIN = _mark_table()
#: fixed values: apostrophes and dashes that count as ' and -
CURLY = "‘´’‐‑‒–—―"
STRAIGHT = "'''------"
#: fixed values: particles that stay lower case in names
PARTICLES = ("el", "van", "de", "von", "der", "den", "hadj", "ben", "ibn", "et", "du", "des", "le", "la", "les", "l", "d")
#: fixed values: wordings of a spent quota
SPENT = ("exceeded your current quota", "requests_per_model_per_day", "per_day", "billing", "insufficient credits")
#: fixed values: the same for the provider whose passing limits also speak of limits exceeded
SPENT_STRICTLY = ("exceeded your current quota", "quota exceeded", "per_day", "billing", "insufficient credits")
REDACTED = "<redacted>"
#: fixed values: parameters whose value is a credential
SECRET_PARAMS = ("key_identity", "key_credential", "api_key", "apikey", "access_token", "token")
WORD = r"[\p{L}\p{N}_]+"


def strip_accents(text: Column) -> Column:
    """Letters without their marks, composed or not."""
    return F.translate(text, ACCENTED, PLAIN)


def compact_key(name: Column) -> Column:
    """Comparison key of a name: lower case, no accents, no dashes, no spaces."""
    text = F.translate(F.lower(F.trim(name)), CURLY, STRAIGHT)
    return F.regexp_replace(strip_accents(text), r"[-\s]+", "")


def key_variants(name: Column) -> list[Column]:
    """Lookup keys in order of preference: lower case, compact, lower without accents."""
    lower = F.lower(name)
    return [lower, compact_key(name), strip_accents(lower)]


def tidy_whitespace(text: Column) -> Column:
    """LF line ends, plain spaces, no trailing blanks, at most one blank line, trimmed; the line after a longer gap loses its indent too."""
    lines = F.transform(F.split(text, "\r\n|\r|\n", -1), lambda x: F.rtrim(F.translate(x, "\u00a0\t", " \t"), F.lit(" \t")))
    # beside each line the two before it, so that no line looks the others up
    before = [F.concat(F.array_repeat(F.lit("text"), k), lines) for k in (1, 2)]
    rows = F.filter(F.arrays_zip(lines.alias("a"), before[0].alias("b"), before[1].alias("c")), lambda x: x["a"].isNotNull() & ((x["a"] != "") | (x["b"] != "")))
    kept = F.transform(rows, lambda x: F.when((x["b"] == "") & (x["c"] == ""), F.ltrim(x["a"], F.lit(" \t"))).otherwise(x["a"]))
    return strip(F.array_join(kept, "\n"))


_END = "\u241e"


def whole_json(text: Column) -> Column:
    """The variant of a text that is one JSON document, all of it, else null; parsed once.

    The parser ignores what follows a document, so the text is read as the
    first of two elements of a list and the second must be there, and last.
    """
    pair = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))
    ends = (F.try_variant_get(pair, "$[1]", "string") == _END) & F.try_variant_get(pair, "$[2]", "variant").isNull()
    odd = text.contains(_END)  # only then could the end be the text's own
    return F.when(ends & (~odd | is_json(text)), F.try_variant_get(pair, "$[0]", "variant"))


def is_json(text: Column) -> Column:
    """True where all of the text is one JSON document: the parser ignores what follows a document, so it is tried inside a list and inside an object."""
    inside = lambda a, z: F.try_parse_json(F.concat(F.lit(a), text, F.lit(z))).isNotNull()
    return inside("[", "]") & inside('{"x":', "}")


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def rewritten(text: Column, pattern: str, group: int, new: Callable[[Column], Column]) -> Column:
    """text with every match of pattern replaced by new(group of the match); text should be a plain column."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), new)
    pieces = F.zip_with(F.split(text, pattern, -1), found, lambda gap, x: F.concat(gap, F.coalesce(x, F.lit(""))))
    return F.array_join(pieces, "")


#: fixed values: headers that carry a credential
SECRET_HEADERS = ("authorization", "x-api-key", "api-key")
#: fixed values: besides white space, what ends a parameter's value: the next parameter, or the end of what the address stands in
VALUE_ENDS = "&'\"<>]}"
#: fixed values: bare provider keys
BARE_KEYS = ("sk-[A-Za-z0-9_-]{16,}", "AIza[A-Za-z0-9_-]{20,}")


def redaction_rules() -> list[tuple[str, str]]:
    """(pattern, replacement) in the order in which they apply: a parameter's value up to what ends it, a header's value, a bare key."""
    ends = "".join("\\" + c if c == "]" else c for c in VALUE_ENDS)
    named, headed = "|".join(SECRET_PARAMS), "|".join(SECRET_HEADERS)
    parameter = f"(?i)\\b({named})=[^\\s{ends}]+"
    header = f"(?i)\\b(({headed})\\s*[:=]\\s*)\\S+"
    return [(parameter, f"$1={REDACTED}"), (header, f"$1{REDACTED}"), (f"\\b(?:{'|'.join(BARE_KEYS)})", REDACTED)]


def redact(text: Column) -> Column:
    """Credentials in parameters, authorisation headers and bare provider keys replaced."""
    return reduce(lambda x, rule: F.regexp_replace(x, *rule), redaction_rules(), text)


def _capital(word: Column) -> Column:
    first = F.substring(word, 1, 1)
    return F.concat(F.when(first == "ß", "Ss").otherwise(F.upper(first)), F.lower(F.substring(word, 2, 1 << 30)))


def clean_entity(name: Column) -> Column:
    """Every word capitalised, particles in lower case, both halves around a single apostrophe capitalised."""

    def one(word: Column) -> Column:
        halves = F.split(word, "['’]", -1)
        both = F.concat(_capital(F.get(halves, F.lit(0))), F.lit("'"), _capital(F.get(halves, F.lit(1))))
        return F.when(F.lower(word).isin(*PARTICLES), F.lower(word)).when(F.size(halves) == 2, both).otherwise(_capital(word))

    words = F.filter(F.split(F.coalesce(name, F.lit("")), r"\s+"), lambda w: w != "")
    return F.array_join(F.transform(words, one), " ")


def entity_cleaner() -> Callable[[str], str]:
    """clean_entity as a Python function for Arrow batches; words are cleaned once, up to a bound."""
    known: dict[str, str] = {}
    blank, mark = re.compile(r"\s+", re.ASCII), re.compile("['’]")

    def capital(word: str) -> str:
        first = word[:1]
        return ("Ss" if first == "ß" else first.upper()) + word[1:].lower()

    def one(word: str) -> str:
        if (low := word.lower()) in PARTICLES:
            return low
        halves = mark.split(word)
        return f"{capital(halves[0])}'{capital(halves[1])}" if len(halves) == 2 else capital(word)

    def clean(name: str) -> str:
        if name in known:  # a name of one word
            return known[name]
        if len(known) > 200_000:
            known.clear()
        words = [w for w in blank.split(name) if w]
        for w in words:
            if w not in known:
                known[w] = one(w)
        return " ".join([known[w] for w in words])

    return clean


#: designators of a duration before and after its T, and their seconds
DATE_UNITS, TIME_UNITS = (("D", 86_400),), (("H", 3_600), ("M", 60), ("S", 1))


def iso_seconds(duration: Column) -> Column:
    """Whole seconds, rounded up, of P[nD]T[nH][nM][nS]; null for anything else and for zero.

    Each designator in turn takes its number from the front; nothing may be
    left, and a T needs something after it.
    """
    duration = strip(duration)
    halves = F.split(F.substring(duration, 2, 1 << 30), "T", -1)
    total, sound = F.lit(0.0), duration.startswith("P") & (F.size(halves) < 3)
    for rest, units in ((F.get(halves, F.lit(0)), DATE_UNITS), (F.get(halves, F.lit(1)), TIME_UNITS)):
        sound = sound & ((rest != "") | rest.isNull() | F.lit(units is DATE_UNITS))
        for unit, seconds in units:
            number = F.regexp_extract(rest, f"^([0-9]+{'([.][0-9]+)?' if unit == 'S' else ''}){unit}", 1)
            total = total + F.coalesce(F.nullif(number, F.lit("")).cast("double"), F.lit(0.0)) * seconds
            rest = F.when(number != "", F.substring(rest, F.length(number) + 2, F.lit(1 << 30))).otherwise(rest)
        sound = sound & F.coalesce(rest == "", F.lit(True))
    return F.when(sound & (total > 0), F.ceil(total).cast("long"))


def clock(seconds: Column) -> Column:
    """HH:MM:SS of seconds rounded half to even, or question marks for null."""
    s = F.bround(seconds.cast("double")).cast("long")
    return F.when(s.isNull(), "??:??:??").otherwise(F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60))


def clock_of_minutes(minutes: Column) -> Column:
    return clock(minutes.cast("double") * 60)


def quota_kind(code: Column, message: Column, strict: bool = False) -> Column:
    """terminal or transient: 402 always ends a run, 429 only where the message speaks of a spent quota.

    ``strict``: the rule of the provider without a 402, by wordings of its own.
    """
    spent = F.lower(message).rlike("|".join(SPENT_STRICTLY if strict else SPENT))
    paid = F.lit(strict) | ~F.coalesce(code == 402, F.lit(False))
    return F.when(~paid, "terminal").when((code == 429) & spent, "terminal").otherwise("transient")


def language_code(label: Column, labels: dict[str, str]) -> Column:
    """Code of a language label, accents and case apart; null where unknown."""
    keys = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.element_at(keys, strip_accents(F.lower(F.trim(label))))


#: fixed values: hosts of watch pages
VIDEO_HOSTS = ("youtube.com", "m.youtube.com", "music.youtube.com")


def video_id(url: Column) -> Column:
    """The 11-character id of a watch page or a short link; null for everything else, embedded players and shorts too."""
    url = strip(url)
    site = F.regexp_replace(F.lower(F.regexp_extract(url, r"^(?i:https?)://(?:[^/?#@]*@)?([^/?#:]*)", 1)), r"^www\.", "")
    path = F.regexp_extract(url, r"^[^:]+://[^/?#]*([^?#]*)", 1)
    asked = F.regexp_extract(url, r"^[^#?]*\?(?:[^#]*?&)?v=([^&#]+)", 1)
    found = F.when(site == "youtu.be", F.regexp_extract(path, r"^/+([^/]*)", 1)).when(site.isin(*VIDEO_HOSTS) & path.rlike("^/watch/*$"), asked)
    return F.when(found.rlike(r"^[A-Za-z0-9_-]{11}$"), found)
