"""Diagnosis of a source's stages: each stage is an ordered ladder of (condition, status, code) over one report row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.operators.reports import primary_cause

Rung = tuple[Column, str, str]


def _ladder(rungs: list[Rung], status: str, code: str) -> Column:
    tell = lambda s, c: F.struct(F.lit(s).alias("status"), F.lit(c).alias("code"))
    out = tell(status, code)
    for condition, s, c in reversed(rungs):
        out = F.when(F.coalesce(condition, F.lit(False)), tell(s, c)).otherwise(out)
    return out


def _n(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _is(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def list_stage() -> Column:
    """From http_ok, verify_ok, list_status, pages (diagnosed), candidates, visible and the extractor's counters."""
    status, rejected = F.col("list_status"), (_n("candidates") == 0) & (_n("visible") > 0)
    signals = (_n("anchors") > 0) | (_n("blocks") > 0)
    return _ladder(
        [
            (~_is("http_ok"), "blocked", "LIST_BLOCKED_BY_HTTP"),
            (~_is("verify_ok"), "blocked", "LIST_BLOCKED_BY_RECRUIT_VERIFY"),
            (status == "fetch-failed", "failed", "LIST_PAGE_FETCH_FAILED"),
            (_n("pages") == 0, "failed", "LIST_NO_DIAGNOSTIC_PAGE"),
            (status == "verified-exact", "success", "LIST_VERIFIED_EXACT"),
            (status == "verified-empty", "success", "LIST_VERIFIED_EMPTY"),
            (status == "count-exact-unverified", "partial", "LIST_COUNT_EXACT_UNVERIFIED"),
            ((status == "count-unavailable-or-empty") & signals, "failed", "LIST_COUNTER_FAILED"),
            (status == "count-unavailable-or-empty", "unknown", "LIST_EMPTY_OR_WRONG_PAGE"),
            (rejected & (_n("title_matches") == 0), "failed", "LIST_TITLE_NOT_FOUND"),
            (rejected & (_n("no_url") > 0), "failed", "LIST_DETAIL_SIGNAL_MISSING"),
            (rejected & (_n("unsafe_url") > 0), "failed", "LIST_URL_REJECTED"),
            (rejected, "failed", "LIST_EXTRACTOR_REJECTED_ALL"),
            (_n("candidates") < _n("visible"), "partial", "LIST_MISSING_POSTS"),
            (_n("candidates") > _n("visible"), "partial", "LIST_EXTRA_POSTS"),
        ],
        "failed",
        "LIST_UNKNOWN_MISMATCH",
    )


def detail_stage() -> Column:
    """From list_ok, detail_ok, detail_urls, attempted, targets, missing_urls, validated, error and empty_bodies.

    Causes that name an answer come before the mere count of pages that were not validated, so they can be reached.
    """
    empty_board = (F.col("list_status") == "verified-empty") & (_n("candidates") == 0)
    return _ladder(
        [
            (~_is("list_ok"), "blocked", "DETAIL_BLOCKED_BY_LIST"),
            (empty_board, "success", "DETAIL_NOT_APPLICABLE_EMPTY_BOARD"),
            (_n("detail_urls") == 0, "failed", "DETAIL_URL_NOT_READY"),
            (_n("attempted") == 0, "failed", "DETAIL_NOT_ATTEMPTED"),
            (_is("detail_ok"), "success", "DETAIL_FIRST_PAGE_VERIFIED_EXACT"),
            (_n("missing_urls") > 0, "failed", "DETAIL_URL_PARTIAL"),
            (_n("attempted") < _n("targets"), "failed", "DETAIL_COVERAGE_INCOMPLETE"),
            (F.col("error").rlike("404"), "failed", "DETAIL_404"),
            (F.col("error").rlike("(?i)403|forbidden"), "failed", "DETAIL_FORBIDDEN"),
            (_n("empty_bodies") > 0, "failed", "DETAIL_EMPTY_BODY"),
            (_n("validated") < _n("targets"), "failed", "DETAIL_BODY_PARTIAL"),
        ],
        "failed",
        "DETAIL_VALIDATION_FAILED",
    )


def attachment_stage() -> Column:
    empty_board = (F.col("list_status") == "verified-empty") & (_n("candidates") == 0)
    return _ladder(
        [
            (empty_board, "success", "ATTACHMENT_NOT_APPLICABLE_EMPTY_BOARD"),
            (~_is("detail_ok"), "blocked", "ATTACHMENT_BLOCKED_BY_DETAIL"),
            (_n("files") > 0, "success", "ATTACHMENT_FOUND"),
            (_is("explicitly_none"), "success", "ATTACHMENT_EXPLICITLY_NONE"),
        ],
        "unknown",
        "ATTACHMENT_ZERO_UNRESOLVED",
    )


def diagnose(report: DataFrame, remediation: DataFrame | None = None) -> DataFrame:
    """Adds each stage's status and code, the primary cause and, from a table (code, action), what to do; one row in, one row out."""
    http = _ladder([(_is("http_ok"), "success", "HTTP_OK")], "failed", "HTTP_FAILED")
    verify = _ladder([(~_is("http_ok"), "blocked", "RECRUIT_VERIFY_BLOCKED_BY_HTTP"), (_is("verify_ok"), "success", "RECRUIT_VERIFY_OK")], "failed", "RECRUIT_VERIFY_FAILED")
    stages = {"http": http, "recruitVerify": verify, "list": list_stage(), "detail": detail_stage(), "attachment": attachment_stage()}
    df = report.withColumns({f"{k}_stage": v for k, v in stages.items()})
    named = F.array(*[F.struct(F.lit(k).alias("stage"), F.col(f"{k}_stage.status").alias("status"), F.col(f"{k}_stage.code").alias("code")) for k in stages])
    df = df.withColumn("cause", primary_cause(named))
    if remediation is None:
        return df
    return df.withColumn("code", F.col("cause.code")).join(remediation, "code", "left").withColumn("action", F.coalesce("action", F.lit("read the evidence"))).drop("code")


def coverage(done: Column, of: Column, empty: float = 0.0) -> Column:
    return F.when(F.coalesce(of, F.lit(0)) == 0, F.lit(empty)).otherwise(F.round(done / of, 4))


def detail_template(url: Column, method: Column, from_script: Column) -> Column:
    """How a detail page is addressed."""
    return (
        F.when(F.upper(F.coalesce(method, F.lit(""))) == "POST", "FORM_POST")
        .when(url.rlike(r"(?i)job\.alio\.go\.kr|incruit\.com|recruit"), "COMMON_PLATFORM")
        .when(url.rlike(r"(?i)/api/"), "API_DETAIL")
        .when(url.rlike(r"(?i)(?<![\w])(?:idx|seq|no|nttId|bbsSeq|articleNo|postNo|dataSid|dataId|bcIdx|boardSeq|recruitNo)="), "QUERY_ID")
        .when(url.rlike(r"(?i)/view/|/detail/|/read/|/article/|boardView|recruitView|noticeView"), "PATH_VIEW")
        .when(F.coalesce(from_script, F.lit(False)), "JAVASCRIPT_RECOVERED")
        .otherwise("CUSTOM")
    )
