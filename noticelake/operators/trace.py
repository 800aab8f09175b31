"""Why a listing's candidates are not its visible rows: each row and candidate is told matched, missing or extra, and each page its cause."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticelake.functions.rules import settled
from noticelake.functions.text import board_key, clean_html, squash
from noticelake.operators.candidates import CELL, ROW
from noticelake.operators.listing import candidate_kind, counter_reason, row_reason

# What is a row's date, number, action and title, and cells that are no titles.
ROW_DATE = r"(?:19|20)\d{2}[.\-/년]\s*\d{1,2}(?:[.\-/월]\s*\d{1,2})?"
ROW_NUMBER = r"(?i)^(?:공지|notice|\d{1,6})$"
ROW_ACTION = r"(?i)\b(?:href|onclick|data-url|data-href)\s*=\s*(?:\"[^\"]+\"|'[^']+')"
TITLE_LINK = r"(?i)<a\b[^>]*(?:class\s*=\s*[\"'][^\"']*(?:title|subject|sj|tit|ellipsis)[^\"']*[\"']|title\s*=\s*[\"'][^\"']+[\"'])[^>]*>([\s\S]*?)</a>"
NO_TITLE_LINK = r"(?i)^(?:download|첨부|파일|보기)$"
NO_TITLE_CELL = r"(?i)^(?:공지|notice|\d{1,6}|(?:19|20)\d{2}[.\-/].*)$"


def _texts(block: Column, pattern: str) -> Column:
    return F.transform(F.regexp_extract_all(block, F.lit(pattern), F.lit(1)), lambda x: squash(clean_html(x)))


def _longest(texts: Column) -> Column:
    return F.coalesce(F.get(F.array_sort(F.transform(texts, lambda x, i: F.struct((-F.length(x)).alias("l"), i.alias("i"), x.alias("x")))), F.lit(0))["x"], F.lit(""))


def traced_rows(pages: DataFrame) -> DataFrame:
    """The table rows with cells of each page (page_id, html): page_id, pos, title, has_action, has_date and has_sequence."""
    df = pages.select("page_id", F.posexplode(F.filter(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(ROW), F.lit(0)), lambda x: x.rlike(r"(?i)<td\b[^>]*>[\s\S]*?</td>"))).alias("pos", "block"))
    block = F.col("block")
    links = F.filter(_texts(block, r"(?i)<a\b[^>]*>([\s\S]*?)</a>"), lambda x: (x != "") & ~x.rlike(NO_TITLE_LINK))
    cells = F.filter(_texts(block, CELL), lambda x: (x != "") & ~x.rlike(NO_TITLE_CELL))
    named = F.when(block.rlike(TITLE_LINK), squash(clean_html(F.regexp_extract(block, TITLE_LINK, 1))))
    title = F.coalesce(named, F.nullif(_longest(links), F.lit("")), _longest(cells))
    signs = {"has_action": block.rlike(ROW_ACTION), "has_date": squash(clean_html(block)).rlike(ROW_DATE), "has_sequence": F.coalesce(F.get(_texts(block, CELL), F.lit(0)), F.lit("")).rlike(ROW_NUMBER)}
    return settled(df.withColumns({"title": title} | signs), "title", *signs).drop("block")


def _numbered(df: DataFrame) -> DataFrame:
    """Which of the same titles of its page a row is; a page shows a bounded number of them."""
    keyed = df.withColumn("key", board_key(F.coalesce("title", F.lit(""))))
    return keyed.withColumn("nth", F.row_number().over(Window.partitionBy("page_id", "key").orderBy("pos")))


def row_trace(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """Each row (see traced_rows) and candidate (page_id, pos, title, link) once: page_id, key, nth, row_pos, row_title, candidate_pos, candidate_title, link, state, reason and kind.

    Rows and candidates of one title are matched in their orders, so what is there twice and once is missing or extra once. A row without
    a candidate says why; a candidate says what it is.
    """
    left = _numbered(rows).select("page_id", "key", "nth", F.col("pos").alias("row_pos"), F.col("title").alias("row_title"), "has_action", "has_date", "has_sequence")
    right = _numbered(candidates).select("page_id", "key", "nth", F.col("pos").alias("candidate_pos"), F.col("title").alias("candidate_title"), "link")
    both = left.join(right, ["page_id", "key", "nth"], "full")
    shown, taken = F.col("row_pos").isNotNull(), F.col("candidate_pos").isNotNull()
    state = F.when(shown & taken, "matched").when(shown, "missing").otherwise("extra")
    reason = F.when(shown & ~taken, row_reason(F.col("row_title"), F.col("has_action"), F.col("has_date"), F.col("has_sequence"))).otherwise("")
    kind = F.when(taken, candidate_kind(F.coalesce("candidate_title", F.lit("")), F.coalesce("link", F.lit("")))).otherwise("")
    return both.select("page_id", "key", "nth", "row_pos", "row_title", "candidate_pos", "candidate_title", "link", state.alias("state"), reason.alias("reason"), kind.alias("kind"))


def page_causes(pages: DataFrame, trace: DataFrame) -> DataFrame:
    """For each page (page_id, visible: the counted posts or null) its rows, unique_titles, candidates, missing and extra titles, reasons and kinds with their numbers, exact_titles, cause and counter_reason.

    A title is missing or extra as a whole, if the other side does not have it at all. A trace is added up by title and then by page; both are aggregates that Spark combines before it shuffles.
    """
    shown, taken = F.col("row_pos").isNotNull(), F.col("candidate_pos").isNotNull()
    by_title = trace.groupBy("page_id", "key").agg(
        F.count_if(shown).alias("r"),
        F.count_if(taken).alias("c"),
        F.count_if(shown & (F.col("row_title") != "")).alias("named"),
        F.count_if(F.col("reason") == "DETAIL_SIGNAL_MISSING").alias("silent"),
    )
    only = (F.col("c") == 0) & (F.col("r") > 0)
    sums = by_title.groupBy("page_id").agg(
        F.sum("r").alias("rows"),
        F.sum("c").alias("candidates"),
        F.count_if((F.col("named") > 0) & (F.col("key") != "")).alias("unique_titles"),
        F.sum(F.when(only, F.col("named")).otherwise(0)).alias("missing"),
        F.sum(F.when(F.col("r") == 0, F.col("c")).otherwise(0)).alias("extra"),
        F.sum(F.when(only & (F.col("named") > 0), F.col("named") - F.col("silent")).otherwise(0)).alias("_told"),
    )
    counted = lambda c: trace.where(F.col(c) != "").groupBy("page_id", F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n")).groupBy("page_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("v", "n")))).alias(f"{c}s"))
    df = pages.select("page_id", "visible").join(sums, "page_id", "left").fillna(0, ["rows", "candidates", "unique_titles", "missing", "extra", "_told"])
    df = df.join(counted("reason"), "page_id", "left").join(counted("kind"), "page_id", "left")
    rows, found, visible = F.col("rows"), F.col("candidates"), F.col("visible")
    exact = (rows > 0) & (F.col("missing") == 0) & (F.col("extra") == 0) & (F.col("unique_titles") == found) & (found == visible)
    cause = (
        F.when((rows == 0) & (found > 0), "VISIBLE_ROW_COUNTER_INCOMPATIBLE_WITH_PAGE_STRUCTURE")
        .when((rows > 0) & (found == 0) & (F.col("_told") == 0), "DETAIL_SIGNAL_NOT_EXPOSED_IN_ROWS")
        .when((rows > 0) & (found == 0), "ROW_TITLE_OR_SHAPE_SELECTOR_MISMATCH")
        .when(F.col("missing") > 0, "PARTIAL_ROW_REJECTION")
        .when(F.col("extra") > 0, "NON_ROW_CANDIDATES_OR_COUNTER_MISMATCH")
        .when(visible.isNull(), "VISIBLE_ROW_COUNTER_UNAVAILABLE")
        .otherwise("NO_LIST_ROOT_CAUSE_DETECTED")
    )
    told = counter_reason(visible, rows, F.col("unique_titles"), found)
    return df.select("page_id", "visible", "rows", "unique_titles", "candidates", "missing", "extra", "reasons", "kinds", F.coalesce(exact, F.lit(False)).alias("exact_titles"), cause.alias("cause"), told.alias("counter_reason"))
