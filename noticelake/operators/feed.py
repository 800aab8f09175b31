"""The feed query: search, filters, ranking and the reader's own state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.dates import days_left
from noticelake.operators.classify import DEGREE, HIGH_SCHOOL
from noticelake.operators.quality import job_key


def flags(jobs: DataFrame, today: Column) -> DataFrame:
    """Adds job_key, fit, ulsan, regular, days_left and rank to jobs of org, title, raw, education, employment and deadline."""
    text = F.lower(F.concat_ws(" ", "title", F.coalesce("raw", F.lit("")), "fit_text"))
    df = jobs.withColumn("fit_text", F.array_join("fit_reasons", " ") if "fit_reasons" in jobs.columns else F.lit(""))
    df = df.withColumns({"job_key": job_key("org", "title"), "fit": F.col("education") == HIGH_SCHOOL, "ulsan": text.rlike("울산|울주|새울"), "regular": F.col("employment").isin("정규직", "무기계약직", "공무직"), "days_left": days_left(F.col("deadline"), today)})
    soon = F.when(F.col("days_left").between(0, 7), 10 - F.col("days_left")).otherwise(0)
    rank = F.when(F.col("fit"), 40).otherwise(0) + F.when(F.col("ulsan"), 30).otherwise(0) + F.when(F.col("regular"), 20).otherwise(0) + soon
    return df.withColumn("rank", rank).drop("fit_text")


def feed_query(flagged: DataFrame, state: DataFrame | None = None, q: str = "", only: str = "all", mode: str = "recommended", tie: str = "job_key") -> DataFrame:
    """Flagged jobs that contain q and pass one filter (all, fit, ulsan, regular, new, closing, watched, applied), in the order of a mode.

    state has one row per user action: kind (seen, applied, watched, favorite) and value (a job key or an organisation).
    """
    df = flagged
    if q:
        df = df.where(F.lower(F.concat_ws(" ", "org", "title", F.coalesce("raw", F.lit("")))).contains(q.lower()))
    if only in ("fit", "ulsan", "regular"):
        df = df.where(only)
    elif only == "closing":
        df = df.where(F.col("days_left").between(0, 3))
    elif only in ("new", "watched", "applied"):
        kind, column, how = {"new": ("seen", "job_key", "left_anti"), "watched": ("watched", "org", "left_semi"), "applied": ("applied", "job_key", "left_semi")}[only]
        df = df.join(state.where(F.col("kind") == kind).select(F.col("value").alias(column)), column, how)
    order = {"deadline": [F.coalesce("days_left", F.lit(9999))], "newest": [F.desc("collected_at")], "org": [F.collate("org", "ko")], "recommended": [F.desc("rank")]}[mode]
    return df.orderBy(*order, tie)


def favorites(flagged: DataFrame, state: DataFrame) -> DataFrame:
    return flagged.join(state.where(F.col("kind") == "favorite").select(F.col("value").alias("job_key")), "job_key", "left_semi")


def recent_jobs(flagged: DataFrame, recent: DataFrame, tie: str) -> DataFrame:
    """The first job of each recent key (pos, job_key), in the order of pos; keys without a job are left out."""
    asked = flagged.join(recent.select("job_key"), "job_key", "left_semi")
    firsts = asked.groupBy("job_key").agg(*[F.min_by(c, tie).alias(c) for c in flagged.columns if c != "job_key"])  # one by one, so that what nobody reads is not computed
    return recent.join(firsts, "job_key").select("pos", "job_key", *[c for c in flagged.columns if c != "job_key"]).orderBy("pos")


def most_recent(recent: Column, key: Column, keep: int = 10) -> Column:
    """A key moved to the front of a list of at most ``keep`` distinct ones."""
    return F.slice(F.array_distinct(F.concat(F.array(key), recent)), 1, keep)


def expected_institutions(institutions: DataFrame, month: int) -> DataFrame:
    return institutions.agg(F.count_if(F.array_contains("months", month)).alias("expected"))


def find_institutions(institutions: DataFrame, q: str) -> DataFrame:
    return institutions.where(F.lower("name").contains(q.lower()))


def summary_lines(flagged: DataFrame) -> DataFrame:
    """Adds summary, at most four lines on a flagged job: two reasons of its quality, then school, place, employment and deadline."""
    reasons = F.slice(F.coalesce("quality_reasons", F.array().cast("array<string>")), 1, 2) if "quality_reasons" in flagged.columns else F.array().cast("array<string>")
    deadline = F.coalesce(F.col("deadline"), F.lit(""))
    school = F.when(F.col("fit"), "고졸 또는 학력무관 문구가 확인됐습니다.").when(F.col("education") == DEGREE, "대졸 이상 조건이 확인됐습니다.").otherwise("학력 조건은 원문 확인이 필요합니다.")
    until = F.when(deadline != "", F.concat(F.lit("마감일은 "), deadline, F.lit("입니다."))).otherwise("마감일은 원문에서 확인해야 합니다.")
    lines = F.array(school, F.when(F.col("ulsan"), "울산 근무 관련 키워드가 포함돼 있습니다."), F.when(F.col("regular"), F.concat("employment", F.lit(" 공고입니다."))), until)
    return flagged.withColumn("summary", F.slice(F.concat(reasons, F.array_compact(lines)), 1, 4))


def deadline_label(days: Column, deadline: Column) -> Column:
    return F.when(days.isNull(), "마감 확인").when(days == 0, "오늘 마감").when(days == 1, "D-1").when((days > 1) & (days <= 3), F.concat(F.lit("D-"), days.cast("string"))).otherwise(deadline)


def top_recommended(flagged: DataFrame, order: list, most: int = 5) -> DataFrame:
    return flagged.where(F.col("fit") & F.col("ulsan") & F.col("regular")).orderBy(*order).limit(most)
