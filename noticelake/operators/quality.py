"""Quality score, validation and collection checks of analysed postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions import rules as R
from noticelake.functions.scan import found
from noticelake.functions.text import squash, title_tokens
from noticelake.functions.urls import has_detail_signal, is_url
from noticelake.operators.classify import EXCLUDED, HIGH_SCHOOL, ULSAN, has_excluded_employment

THRESHOLD = 90


def detail_confidence(text: Column, title: Column) -> Column:
    signals = sum((found(text, p).cast("int") for p in R.STRUCTURE_SIGNALS), F.lit(0))
    tokens = title_tokens(title)
    matched = F.size(F.filter(tokens, lambda t: text.contains(t)))
    ratio = F.when(F.size(tokens) > 0, matched / F.size(tokens)).otherwise(1.0)
    return F.struct(signals.alias("signals"), matched.alias("matched"), F.size(tokens).alias("tokens"), ratio.alias("title_ratio"))


def score_quality(analysed: DataFrame) -> DataFrame:
    """Adds quality_score, quality_passed, quality_reasons and penalties to analysed rows with deadline, link and documents_read."""
    df = analysed.withColumn("confidence", detail_confidence(F.col("detail_text"), F.col("title")))
    ok, signals, ratio = F.coalesce(F.col("detail_ok"), F.lit(False)), F.col("confidence.signals"), F.col("confidence.title_ratio")
    documents = F.coalesce(F.col("documents_read"), F.lit(0))
    high, ulsan, allowed = F.col("education") == HIGH_SCHOOL, F.col("location") == ULSAN, F.col("employment").isin(R.ALLOWED_EMPLOYMENT)
    has_deadline = F.coalesce(F.col("deadline"), F.lit("")) != ""
    valid = F.coalesce(is_url(F.col("link")), F.lit(False))
    identified = valid & has_detail_signal(F.col("link"))
    points = [
        F.when(ok, 22),
        F.when(signals >= 5, 14).when(signals >= 3, 10),
        F.when(ratio >= 0.67, 12).when(ratio >= 0.4, 7),
        F.when(documents > 0, 8),
        F.when(F.col("cross.conflict"), -35),
        F.when(high, 14),
        F.when(ulsan, 14),
        F.when(allowed, 12),
        F.when(has_deadline, 5),
        F.when(identified, 4),
    ]
    total = sum((F.coalesce(p, F.lit(0)) for p in points), F.lit(0))
    score = F.when(F.col("excluded"), 0).otherwise(F.least(F.greatest(total, F.lit(0)), F.lit(100)))
    reasons = R.reasons(
        (ok, "상세 원문 검증 완료"),
        (signals >= 5, "채용 구조 5개 이상 확인"),
        ((signals >= 3) & (signals < 5), "채용 구조 확인"),
        (ratio >= 0.67, "제목-원문 일치도 높음"),
        ((ratio >= 0.4) & (ratio < 0.67), "제목-원문 일치"),
        (documents > 0, F.concat(F.lit("첨부문서 "), documents.cast("string"), F.lit("개 분석"))),
        (high, "고졸 지원 가능 확인"),
        (ulsan, "울산 단일 근무 확인"),
        (allowed, F.concat("employment", F.lit(" 확인"))),
        (has_deadline, "마감일 확인"),
        (identified, "상세주소 식별자 확인"),
    )
    early = R.reasons((~ok, "상세 원문 확인 실패"), (signals < 3, "채용 구조 부족"), ((ratio < 0.4) & (F.col("confidence.tokens") >= 3), "제목-원문 일치도 낮음"))
    late = R.reasons(
        (~high, "학력 조건 미확인"),
        (~ulsan, "울산 단일 근무 미확인"),
        (~allowed, "허용 고용형태 미확인"),
        (~has_deadline, "마감일 미확인"),
        (valid & ~identified, "상세주소 식별자 부족"),
        (~valid, "원문 주소 형식 오류"),
    )
    penalties = F.array_distinct(F.concat(early, F.col("cross.reasons"), late))
    df = df.withColumns({"quality_score": score, "quality_reasons": reasons, "penalties": penalties})
    return df.withColumn("quality_passed", F.col("recommended") & ~F.col("cross.conflict") & (F.col("quality_score") >= THRESHOLD))


def validate(jobs: DataFrame) -> DataFrame:
    """Adds errors, warnings and valid to scored rows; raw is the row's detail text. vacancy_count, vacancy_name and splitter_version are optional."""
    raw = F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("detail_text", F.lit("")))
    link = F.coalesce(F.col("link"), F.lit(""))
    path = F.regexp_extract(link, r"^[a-zA-Z][\w+.-]*://[^/?#]*([^?#]*)", 1)
    count = F.coalesce(F.col("vacancy_count"), F.lit(1)) if "vacancy_count" in jobs.columns else F.lit(1)
    name = F.coalesce(F.col("vacancy_name"), F.lit("")) if "vacancy_name" in jobs.columns else F.lit("")
    version = F.coalesce(F.col("splitter_version"), F.lit("")) if "splitter_version" in jobs.columns else F.lit("")
    errors = R.reasons(
        ((F.coalesce("org", F.lit("")) == "") | (F.coalesce("title", F.lit("")) == ""), "기관 또는 제목 누락"),
        (link == "", "원문 링크 누락"),
        ((link != "") & ~is_url(link), "원문 링크 형식 오류"),
        (is_url(link) & ~link.rlike(r"^(?i:https?)://"), "HTTP 원문 링크 아님"),
        (is_url(link) & path.rlike(R.LIST_OR_HOME) & ~link.contains("?"), "목록 또는 메인 링크"),
        (found(raw, R.ERROR_TEXT), "오류 페이지 문구 포함"),
        (found(raw, R.CLOSED_TEXT), "마감 문구 포함"),
        ((F.col("employment") == EXCLUDED) | has_excluded_employment(raw), "제외 고용형태 포함"),
        (F.col("education") != HIGH_SCHOOL, "고졸 지원 확인 안 됨"),
        (F.col("location") != ULSAN, "울산 단일 근무 확인 안 됨"),
        (~F.col("employment").isin(R.ALLOWED_EMPLOYMENT), "허용 고용형태 아님"),
        (F.col("quality_score") < THRESHOLD, "품질점수 미달"),
        (~F.coalesce(F.col("detail_ok"), F.lit(False)), "상세 원문 미검증"),
        ((count > 1) & (name == ""), "다중 직군 이름 누락"),
        ((count > 1) & (version == ""), "직군 분리 버전 누락"),
    )
    warnings = R.reasons((F.coalesce("deadline", F.lit("")) == "", "마감일 미확인"))
    return jobs.withColumns({"errors": errors, "warnings": warnings}).withColumn("valid", F.size("errors") == 0)


def job_key(*parts: str) -> Column:
    return F.lower(squash(F.concat_ws("|", *[F.coalesce(F.col(p), F.lit("")) for p in parts])))


def vacancy_key(jobs: DataFrame) -> Column:
    """What makes a job a duplicate: organisation, original title (the title, where there is none) and name of the vacancy."""
    title = F.coalesce(F.nullif(F.col("original_title"), F.lit("")), F.col("title")) if "original_title" in jobs.columns else F.col("title")
    name = F.col("vacancy_name") if "vacancy_name" in jobs.columns else F.lit("")
    return F.lower(squash(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in (F.col("org"), title, name)])))


def collection_issues(jobs: DataFrame, order: str) -> DataFrame:
    """One row per issue: the errors of an invalid job, and a duplicate (see vacancy_key) of a job with a smaller ``order``.

    The first job of each key comes from an aggregate that Spark combines before it shuffles, so a key that
    many rows share gathers in no task.
    """
    keyed = validate(jobs).withColumn("job_key", vacancy_key(jobs))
    firsts = keyed.groupBy("job_key").agg(F.min(order).alias("first_order"))
    marked = keyed.join(firsts, "job_key")
    duplicate = F.when(F.col(order) != F.col("first_order"), F.array(F.lit("중복 공고"))).otherwise(F.array().cast("array<string>"))
    return marked.select("org", "title", order, F.explode(F.concat("errors", duplicate)).alias("error"))


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("error").agg(F.count(F.lit(1)).alias("n"))
