"""A source's report by stages, from tables of its access, listings, details and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.operators.stages import coverage

# Where a source is stuck, and what is reported where there is nothing to do.
UNVERIFIED, UNCOUNTED, NO_LIST = "목록 개수 일치·제목 정확성 미검증", "목록 글 수 판정 불가 또는 실제 0건", "목록 추출 실패"
NO_ACCESS, NO_BOARD, EMPTY = "HTTP 접속", "채용게시판 검증", "현재 실제 공고 0건 · 상세·첨부 대상 없음"
NO_URLS, NO_DETAIL, NO_FILES, NO_DOWNLOAD, NO_ANALYSIS, PASSED = "상세 URL 복구", "상세페이지 추출", "첨부 발견/추출", "첨부 다운로드", "문서 분석", "전체 파이프라인 통과"
ALL, SOME, NONE = "all", "some", "none"


def every(flag: Column) -> Column:
    """An aggregate of three values and null: of how many rows the flag holds; null without rows, where "all" would be true of nothing."""
    holds = F.count_if(F.coalesce(flag, F.lit(False)))
    n = F.count(F.lit(1))
    return F.when(n == 0, F.lit(None).cast("string")).when(holds == n, ALL).when(holds > 0, SOME).otherwise(NONE)


def best_listings(listings: DataFrame) -> DataFrame:
    """The listing of each source that is its board: an exact one, with most visible posts, then most candidates, then the first; a struct's minimum, combined before the shuffle."""
    rank = F.struct((F.col("status") != "exact").alias("a"), (-F.coalesce("visible", F.lit(-1))).alias("b"), (-F.col("candidates")).alias("c"), F.col("page_id").alias("d"))
    kept = F.struct("page_id", "status", "visible", "candidates", "verified")
    return listings.groupBy("org").agg(F.min_by(kept, rank).alias("l"), F.count(F.lit(1)).alias("pages"))


def _list_status() -> Column:
    status = F.col("l.status")
    return (
        F.when(F.col("l").isNull(), "fetch-failed")
        .when(status == "verified-empty", "verified-empty")
        .when(status.isin("empty-or-wrong-page", "count-unavailable"), "count-unavailable-or-empty")
        .when((status == "exact") & F.coalesce("l.verified", F.lit(False)), "verified-exact")
        .when(status == "exact", "count-exact-unverified")
        .otherwise(status)
    )


def _sampled(done: Column, of: Column) -> Column:
    return F.when(of == 0, "not-attempted").when(done == of, "sample-success").when(done > 0, "sample-partial").otherwise("sample-failed")


def source_report(access: DataFrame, listings: DataFrame, candidates: DataFrame, files: DataFrame) -> DataFrame:
    """One row a source of access: its list, detail, attachment, download and analysis stages, and where it is stuck.

    access: org, http_ok and verify_ok. listings: org, page_id, status (see listing.listing_status), visible, candidates and verified. candidates: org, page_id, list_only, ok (null: not
    attempted), attachments, explicitly_none and error, of which those of the source's best listing count. files: org, page_id, downloaded and parsed, of what was verified.
    """
    best = best_listings(listings)
    mine = candidates.join(best.select("org", F.col("l.page_id").alias("page_id")), ["org", "page_id"])
    tried = F.col("ok").isNotNull()
    details = mine.groupBy("org").agg(
        F.count(F.lit(1)).alias("targets"),
        F.count_if("list_only").alias("missing_urls"),
        F.count_if(tried).alias("attempted"),
        F.count_if("ok").alias("validated"),
        F.coalesce(F.sum("attachments"), F.lit(0)).alias("files"),
        F.min(F.when(F.col("error") != "", F.col("error"))).alias("error"),
    )
    told = mine.where(tried).groupBy("org").agg(every(F.col("explicitly_none")).alias("no_files"))
    verified = files.join(best.select("org", F.col("l.page_id").alias("page_id")), ["org", "page_id"]).groupBy("org").agg(F.count(F.lit(1)).alias("downloads"), F.count_if("downloaded").alias("downloaded"), F.count_if("parsed").alias("parsed"))
    df = access.select("org", F.coalesce("http_ok", F.lit(False)).alias("http_ok"), F.coalesce("verify_ok", F.lit(False)).alias("verify_ok"))
    for side in (best, details, told, verified):
        df = df.join(side, "org", "left")
    df = df.fillna(0, ["pages", "targets", "missing_urls", "attempted", "validated", "files", "downloads", "downloaded", "parsed"])
    reached = F.col("http_ok") & F.col("verify_ok")
    status = F.when(reached, _list_status()).otherwise("unknown")
    df = df.withColumns({"list_status": status, "visible": F.col("l.visible"), "candidates": F.coalesce("l.candidates", F.lit(0)), "page_id": F.col("l.page_id")}).drop("l")
    empty = (F.col("list_status") == "verified-empty") & (F.col("candidates") == 0)
    df = df.withColumns({"list_ok": F.col("list_status").isin("verified-exact", "verified-empty"), "_empty": empty})
    n = F.col("targets")
    complete = (n == F.col("candidates")) & (F.col("missing_urls") == 0) & (F.col("attempted") == n) & (F.col("validated") == n)
    of_tried = F.when(F.col("attempted") > 0, coverage(F.col("validated"), F.col("attempted"))).otherwise(F.when(n == 0, 1.0).otherwise(0.0))
    df = df.withColumns({"coverage": coverage(F.col("attempted"), n, 1.0), "validation": of_tried, "detail_ok": F.col("list_ok") & ((F.col("_empty") & (n == 0)) | complete)})
    without = F.coalesce(F.col("no_files") == ALL, F.lit(False))
    none_needed = F.col("_empty") | without
    discovery = F.when(F.col("_empty"), "not-required-no-posts").when(without, "not-required-no-attachments").when(F.col("files") > 0, "success").otherwise("failed")
    sent = F.col("downloads") > 0
    download = F.when(none_needed, "not-required").when(sent, _sampled(F.col("downloaded"), F.col("downloads"))).otherwise("blocked-by-discovery")
    analysis = F.when(none_needed, "not-required").when(sent, _sampled(F.col("parsed"), F.col("downloads"))).otherwise("blocked-by-download")
    df = df.withColumns({"discovery_status": discovery, "download_status": download, "analysis_status": analysis})
    good = lambda c: F.col(c).isin("not-required", "sample-success")
    partly = F.concat(F.lit("목록 부분 추출 ("), F.col("candidates").cast("string"), F.lit("/"), F.coalesce(F.col("visible").cast("string"), F.lit("null")), F.lit(")"))
    listed = F.col("list_status")
    stuck = (
        F.when(~F.col("http_ok"), NO_ACCESS)
        .when(~F.col("verify_ok"), NO_BOARD)
        .when(~F.col("list_ok"), F.when(listed == "count-exact-unverified", UNVERIFIED).when(listed == "partial", partly).when(listed == "count-unavailable-or-empty", UNCOUNTED).otherwise(NO_LIST))
        .when(listed == "verified-empty", EMPTY)
        .when(n - F.col("missing_urls") == 0, NO_URLS)
        .when(~F.col("detail_ok"), NO_DETAIL)
        .when(F.col("discovery_status") == "failed", NO_FILES)
        .when(~good("download_status"), NO_DOWNLOAD)
        .when(~good("analysis_status"), NO_ANALYSIS)
        .otherwise(PASSED)
    )
    return df.withColumns({"bottleneck": stuck, "detail_urls": n - F.col("missing_urls"), "explicitly_none": without}).drop("_empty", "no_files")
