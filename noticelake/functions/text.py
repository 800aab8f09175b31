"""Text and HTML functions as Spark columns."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelake.functions.scan import ASCII_SPACES, marked_lines, replaced

#: The only named references that are decoded; the ampersand comes last so that nothing is decoded twice.
NAMED = [("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&amp;", "&")]


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def squash(c: Column) -> Column:
    """White space runs become one space."""
    return strip(F.regexp_replace(c, r"\s+", " "))


def _numeric(c: Column, pattern: str, base: int) -> Column:
    """Decode numeric references without leaving the JVM: what stands between them is zipped with their characters."""
    number = lambda x: F.conv(x, base, 10).cast("long")
    char = lambda x: F.when(number(x) <= 0x10FFFF, F.decode(F.unhex(F.lpad(F.hex(number(x)), 8, "0")), "UTF-32")).otherwise("")
    chars = F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), char)
    return F.array_join(F.zip_with(F.split(c, pattern), chars, lambda p, k: F.concat(p, F.coalesce(k, F.lit("")))), "")


def decode_entities(c: Column) -> Column:
    for name, char in NAMED:
        c = F.replace(c, F.lit(name), F.lit(char))
    return F.when(c.contains("&#"), _numeric(_numeric(c, r"&#(\d+);", 10), r"(?i)&#x([0-9a-f]+);", 16)).otherwise(c)


def clean_html(c: Column) -> Column:
    """Decode first, then drop scripts, styles, comments and tags; ends of blocks become line feeds."""
    c = decode_entities(c)
    for pattern, by in (
        (r"(?i)<script\b[\s\S]*?</script>", " "),
        (r"(?i)<style\b[\s\S]*?</style>", " "),
        (r"<!--[\s\S]*?-->", " "),
        (r"(?i)<(?:br|/p|/div|/li|/tr|/h[1-6])\b[^>]*>", "\n"),
        (r"<[^>]+>", " "),
        (r"[\t\r ]+", " "),
        (r"\n\s*\n+", "\n"),
    ):
        c = F.regexp_replace(c, pattern, by)
    return strip(c)


def clean(c: Column) -> Column:
    """Drop tags first and then decode four references: the older order, in which encoded tags stay as text."""
    for pattern in (r"(?i)<script[\s\S]*?</script>", r"(?i)<style[\s\S]*?</style>", r"<[^>]+>"):
        c = F.regexp_replace(c, pattern, " ")
    for name, char in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        c = F.replace(c, F.lit(name), F.lit(char))
    return squash(c)


def visible_text(c: Column) -> Column:
    for pattern in (r"(?i)<script\b[^>]*>[\s\S]*?</script>", r"(?i)<style\b[^>]*>[\s\S]*?</style>", r"<[^>]+>"):
        c = F.regexp_replace(c, pattern, " ")
    c = F.regexp_replace(F.regexp_replace(c, r"(?i)&nbsp;|&#160;", " "), r"(?i)&amp;", "&")
    return squash(c)


def page_title(c: Column) -> Column:
    return squash(F.regexp_replace(F.regexp_extract(c, r"(?i)<title\b[^>]*>([\s\S]*?)</title>", 1), r"<[^>]+>", " "))


def board_key(c: Column) -> Column:
    return F.lower(squash(F.regexp_replace(clean_html(c), r"[^0-9a-zA-Z가-힣]+", " ")))


def title_key(c: Column) -> Column:
    """A title without marks of revision, numbers of rounds, dates and punctuation."""
    marks = (r"\[(?:수정|변경|재공고|재재공고)\]", r"\((?:수정|변경|재공고|재재공고)\)", r"(?:수정|변경|재재?공고)", r"제?\d+차", r"\d{4}[-.년\s]*\d{0,2}[-.월\s]*\d{0,2}일?", r"[^0-9a-zA-Z가-힣]+")
    return F.lower(F.trim(replaced(c, *[(p, " ") for p in marks])))


def title_tokens(c: Column) -> Column:
    marks = (r"\[[^\]]+\]|\([^)]*\)", r"(?:채용|모집|공고|직원|신입|경력|정규직|공무직|무기계약직)", r"[^0-9a-zA-Z가-힣]+")
    words = F.split(F.trim(replaced(c, *[(p, " ") for p in marks])), " ")
    return F.slice(F.filter(words, lambda x: F.length(x) >= 2), 1, 8)


CELL_END, LINE_END = r"\n|\r|\t| {2,}", r"\r?\n|。"


def cell_lines(c: Column) -> Column:
    """The trimmed, non-empty parts between line ends, tabs and runs of spaces."""
    return F.filter(F.transform(F.split(c, CELL_END), strip), lambda x: x != "")


def context_lines(c: Column) -> Column:
    blank = lambda x: F.trim(F.regexp_replace(F.replace(x, F.lit(" "), F.lit(" ")), r"[ \t]+", " "))
    return F.filter(F.transform(F.split(c, LINE_END), blank), lambda x: x != "")


def marked_cells(c: Column, **patterns: str) -> Column:
    """cell_lines, each with whether the patterns are in it (see scan.marked_lines)."""
    return marked_lines(c, CELL_END, [], ASCII_SPACES, patterns)


def marked_context(c: Column, **patterns: str) -> Column:
    """context_lines, each with whether the patterns are in it (see scan.marked_lines)."""
    return marked_lines(c, LINE_END, [("\u00a0", " "), (r"[ \t]+", " ")], " ", patterns)


def marked_evidence(lines: Column, mark: str, limit: int, chars: int) -> Column:
    """evidence, of marked lines."""
    return F.array_distinct(F.transform(F.slice(F.filter(lines, lambda x: x[mark]), 1, limit), lambda x: F.left(x["line"], F.lit(chars))))


def evidence(lines: Column, pattern: str, limit: int, chars: int) -> Column:
    """The first lines that the pattern is in, cut to a length; equal ones among these count once."""
    return F.array_distinct(F.transform(F.slice(F.filter(lines, lambda x: x.rlike(pattern)), 1, limit), lambda x: F.left(x, F.lit(chars))))


def compact(c: Column, most: int = 18_000) -> Column:
    return F.left(F.replace(c, F.lit("\u0000"), F.lit("")), F.lit(most))


@F.pandas_udf(T.StringType())
def composed(c: pd.Series) -> pd.Series:
    """Unicode's canonical composition, which Spark has no function for."""
    return c.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


@F.pandas_udf(T.StringType())
def compatible(c: pd.Series) -> pd.Series:
    """Unicode's compatibility composition."""
    return c.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def canonical_org(c: Column) -> Column:
    return F.trim(F.regexp_replace(composed(F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown"))), r"[\s_-]+", " "))


def slug(c: Column) -> Column:
    """A name of letters, digits and Hangul, at most 80 long."""
    bare = F.regexp_replace(F.regexp_replace(canonical_org(c), r"[^a-zA-Z0-9가-힣]+", "_"), r"^_+|_+$", "")
    return F.coalesce(F.nullif(F.left(bare, F.lit(80)), F.lit("")), F.lit("unknown"))


def safe_name(c: Column) -> Column:
    """A name that file systems take, at most 100 long."""
    bare = F.regexp_replace(F.regexp_replace(c, r"[\\/:*?\"<>|]", "_"), r"\s+", "_")
    return F.coalesce(F.nullif(F.left(bare, F.lit(100)), F.lit("")), F.lit("unknown"))


def diagnostic_name(c: Column) -> Column:
    """Letters and digits of any script, the rest as _, at most 120 long."""
    return F.left(F.regexp_replace(compatible(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+", "_"), F.lit(120))
