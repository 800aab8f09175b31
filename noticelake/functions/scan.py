"""Patterns over whole columns: Arrow looks for them a batch at a time, in time that grows with the text whatever the number of alternatives."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES, ASCII_SPACES = "\t-\r ", "\t\n\x0b\f\r "
_LINE_END = "\r\n|[\n\r\u0085\u2028\u2029]"
_TOKEN = re.compile(r"\\.|\[\^?\]?(?:\\.|[^\]\\])*\]|[.$]", re.DOTALL)


def portable(pattern: str) -> str:
    """A Java pattern as Arrow takes it: white space, the dot and the end of a text mean there what they mean in Spark's own functions.

    The end must close its alternative. Patterns that look around or back are an error, and so are letters that fold beyond ASCII.
    """

    def one(m: re.Match) -> str:
        token = m[0]
        if token == r"\s":
            return f"[{SPACES}]"
        if token == r"\S":
            return f"[^{SPACES}]"
        if token == ".":
            return "[^\n\r\u0085\u2028\u2029]"
        if token == "$":
            return rf"(?:(?:{_LINE_END})?\z)"
        if token.startswith("["):
            return token.replace(r"\s", SPACES)
        if token in (r"\b", r"\B"):
            raise ValueError(f"borders of words differ: {pattern}")
        return token

    out = _TOKEN.sub(one, pattern)
    if "(?i" in pattern and re.search(r"[ks]", re.sub(r"\\.", "", pattern), re.IGNORECASE):
        raise ValueError(f"k and s have other cases beyond ASCII: {pattern}")
    pc.match_substring_regex(pa.array([""]), out)  # what Arrow cannot take fails here, on the driver
    return out


def found(text: Column, pattern: str) -> Column:
    """Whether the pattern is in the text."""
    p = portable(pattern)

    @F.arrow_udf("boolean")
    def found(v: pa.Array) -> pa.Array:
        return pc.match_substring_regex(v, p)

    return found(text)


def substituted(v: pa.Array, pairs: list[tuple[str, str]]) -> pa.Array:
    for p, by in pairs:
        v = pc.replace_substring_regex(v, p, by)
    return v


def replaced(text: Column, *pairs: tuple[str, str]) -> Column:
    """The text with all matches of each pattern, one pattern after the other, replaced by a plain string."""
    ported = [(portable(p), by) for p, by in pairs]

    @F.arrow_udf("string")
    def replaced(v: pa.Array) -> pa.Array:
        return substituted(v, ported)

    return replaced(text)


def lists_like(lists: pa.Array, keep: pa.Array, values: pa.Array) -> pa.Array:
    """Lists as long as ``lists`` of the flat values that keep is true for; a null list stays null."""
    kept = np.bincount(pc.list_parent_indices(lists).filter(keep).to_numpy(), minlength=len(lists))
    offsets = pa.array(np.concatenate([[0], kept.cumsum()]), pa.int32())
    return pa.ListArray.from_arrays(offsets, values.filter(keep), mask=lists.is_null() if lists.null_count else None)


def split_lines(v: pa.Array, split: str, blank: list[tuple[str, str]], spaces: str) -> tuple[pa.Array, pa.Array, pa.Array]:
    """The parts of texts between matches of ``split``: lists, flat parts with blank replaced and spaces trimmed, and which of these are not empty."""
    lists = pc.split_pattern_regex(v, split)
    flat = pc.utf8_trim(substituted(lists.flatten(), blank), spaces)
    return lists, flat, pc.not_equal(flat, "")


def marked_lines(text: Column, split: str, blank: list[tuple[str, str]], spaces: str, patterns: dict[str, str], least: int = 1, most: int | None = None) -> Column:
    """The lines of a text, trimmed and of ``least`` to ``most`` characters, each with whether the patterns are in it: an array of structs of line and a boolean by each name."""
    at, tidy = portable(split), [(portable(p), by) for p, by in blank]
    ported = {n: portable(p) for n, p in patterns.items()}
    schema = "array<struct<line: string, " + ", ".join(f"`{n}`: boolean" for n in ported) + ">>"

    @F.arrow_udf(schema)
    def marked(v: pa.Array) -> pa.Array:
        lists, flat, keep = split_lines(v, at, tidy, spaces)
        if least > 1 or most is not None:
            keep = pc.and_(pc.greater_equal(pc.utf8_length(flat), least), pc.less_equal(pc.utf8_length(flat), most or 2**31 - 1))
        rows = pa.StructArray.from_arrays([flat, *[pc.match_substring_regex(flat, p) for p in ported.values()]], ["line", *ported])
        return lists_like(lists, keep, rows)

    return marked(text)
