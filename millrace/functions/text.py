"""Column functions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Frequent words of the languages that are told apart.
STOP_WORDS = {
    "de": ["der", "die", "und", "das", "von", "mit", "für", "ist", "nicht", "ein", "zu", "den"],
    "en": ["the", "and", "of", "to", "was", "with", "that", "for", "are", "is", "this", "by"],
    "es": ["el", "los", "las", "y", "que", "para", "con", "por", "una", "es", "del", "de"],
    "fr": ["le", "les", "des", "et", "est", "dans", "pour", "qui", "une", "du", "sur", "pas"],
}
FIELDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "money": r"[$€£][0-9][0-9,]*(?:\.[0-9]+)?",
    "percentage": r"[0-9]+(?:\.[0-9]+)?%",
    "date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}",
    "kpi": r"\b(?:CPA|CPL|CPI|FTD|ROI|CR|Spend|Revenue): ?[$€£]?[0-9][0-9.,]*%?",
    "ip": r"\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b",
}
RULES_VERSION = "1"


def stripped(c: Column) -> Column:
    """Without zero-width characters and controls other than tab and line end."""
    return F.regexp_replace(c, r"[\x{200B}-\x{200D}\x{FEFF}\x{0000}-\x{0008}\x{000B}\x{000C}\x{000E}-\x{001F}]", "")


def collapsed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[\s\x{00A0}]+", " "))


def normalized(c: Column) -> Column:
    return F.lower(collapsed(stripped(c)))


def tokens(c: Column) -> Column:
    return F.filter(F.split(normalized(c), " "), lambda t: t != "")


def html_escaped(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def label(c: Column) -> Column:
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def unwrapped(url: Column, params: tuple[str, ...] = ("url", "u", "target")) -> Column:
    """The target of a redirecting url, else the url."""
    found = [F.try_url_decode(F.try_parse_url(url, F.lit("QUERY"), F.lit(p))) for p in params]
    return F.coalesce(*[F.when(f.rlike("^https?://"), f) for f in found], url)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def chunks(c: Column, size: int) -> Column:
    """Parts of at most size characters, in order; joined they are the text."""
    n = F.greatest(F.lit(1), F.ceil(F.char_length(c) / F.lit(size)))
    return F.transform(F.sequence(F.lit(0), n.cast("int") - 1), lambda i: F.substring(c, i * size + 1, F.lit(size)))


def language(c: Column) -> Column:
    """The language with most of its frequent words in the text; ties to the first by code; null for none."""
    words = tokens(c)
    score = lambda k: F.size(F.array_intersect(words, F.array(*map(F.lit, STOP_WORDS[k]))))
    best = F.greatest(*[score(k) for k in STOP_WORDS])
    out = F.when(best == 0, F.lit(None).cast("string"))
    for k in STOP_WORDS:
        out = out.when(score(k) == best, k)
    return out


def decluttered(c: Column) -> Column:
    """Runs of one pictograph become one, and emphasis marks that have no partner on their line go."""
    c = F.regexp_replace(c, r"([\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}])\1+", "$1")
    return F.regexp_replace(c, r"(?m)^((?:(?!\*\*).)*)\*\*((?:(?!\*\*).)*)$", "$1$2")
