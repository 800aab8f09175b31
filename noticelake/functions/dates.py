"""Deadlines: found in texts as dates, compared at the end of the day in Korean time."""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelake.functions.scan import portable

# How postings write their periods.
RANGE = r"(?:20)?(\d{2})[.\-/]\s*(\d{1,2})[.\-/]\s*(\d{1,2})\s*~\s*(?:20)?(\d{2})[.\-/]\s*(\d{1,2})[.\-/]\s*(\d{1,2})"
UNTIL = r"(?:접수|지원|제출|원서접수)[^\n]{0,120}?(?:(20\d{2}|\d{2})[.\-/년]\s*)?(\d{1,2})[.\-/월]\s*(\d{1,2})\s*일?[^\n]{0,30}?(?:까지|마감|종료)"
LABELLED = r"(?:접수(?:기간|마감)?|마감(?:일)?|공고기간)\s*[:：]?[^\n]{0,100}?(?:(20\d{2}|\d{2})[.\-/년]\s*)?(\d{1,2})[.\-/월]\s*(\d{1,2})\s*일?"


def _date(year: Column, month: Column, day: Column, reference_year: int) -> Column:
    """``yyyy-MM-dd``, or null if there is no such day; no year is the reference year, two digits are of this century."""
    full = F.when(year == "", F.lit(str(reference_year))).when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)
    text = F.concat_ws("-", full, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.date_format(F.try_to_date(text, "yyyy-MM-dd"), "yyyy-MM-dd")


def extract_deadline(text: Column, reference_year: int) -> Column:
    """The end of a range (no other rule if it is no date), else the until-phrase's date, else the last labelled one, else empty."""
    d = told_dates(text)
    date = lambda rule: F.when(d[rule].isNotNull(), _date(*[d[rule][k] for k in "ymd"], reference_year))
    return F.when(d["range"].isNotNull(), F.coalesce(date("range"), F.lit(""))).otherwise(F.coalesce(date("until"), date("labelled"), F.lit("")))


def told_dates(text: Column) -> Column:
    """range, until and labelled: year, month and day as the text of single spaces writes them by each rule, null where it does not."""
    blank, ends, until, labelled = portable(r"\s+"), *(portable(p) for p in (RANGE, UNTIL, LABELLED))
    named = lambda pattern, names: re.sub(r"\((?!\?)", lambda _, it=iter(names): f"(?P<{next(it)}>", pattern)
    ends, until = named(ends, ("y0", "m0", "d0", "y", "m", "d")), named(until, "ymd")
    mark, part = "\x01", "\x02"

    @F.arrow_udf("struct<" + ", ".join(f"`{rule}`: struct<y: string, m: string, d: string>" for rule in ("range", "until", "labelled")) + ">")
    def told(v: pa.Array) -> pa.Array:
        v = pc.utf8_trim(pc.replace_substring_regex(v, blank, " "), " ")
        found = [pc.extract_regex(v, p) for p in (ends, until)]
        # each labelled date between two marks: what stands before the last mark is the last date
        clear = pc.replace_substring_regex(v, f"[{mark}{part}]", "\x03")
        parts = pc.split_pattern(pc.replace_substring_regex(clear, labelled, rf"{mark}\1{part}\2{part}\3{mark}"), mark)
        many = pc.greater(pc.list_value_length(parts), 1)
        at = pc.if_else(many, pc.subtract(parts.offsets[1:], 2), pa.scalar(None, pa.int32()))
        found.append(pc.extract_regex(parts.values.take(at), rf"(?P<y>[^{part}]*){part}(?P<m>[^{part}]*){part}(?P<d>[^{part}]*)"))
        ymd = [pa.StructArray.from_arrays([pc.struct_field(x, k) for k in "ymd"], list("ymd"), mask=x.is_null()) for x in found]
        return pa.StructArray.from_arrays(ymd, ["range", "until", "labelled"])

    return told(text)


def is_expired(deadline: Column, as_of: Column) -> Column:
    """Whether the deadline's last second in +09:00 is before as_of (a timestamp); an empty deadline never is."""
    end = F.try_to_timestamp(F.concat(deadline, F.lit("T23:59:59+09:00")))
    return F.coalesce((deadline != "") & (end < as_of), F.lit(False))


def days_left(deadline: Column, today: Column) -> Column:
    """Days from today (a date) to the deadline, null if there is none."""
    return F.date_diff(F.try_to_date(F.nullif(deadline, F.lit("")), "yyyy-MM-dd"), today)
