"""Publishing: preferred jobs, retention of failed sources' jobs, circuit breakers, order and limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.dates import is_expired
from noticelake.functions.lineage import cut
from noticelake.functions.text import title_key
from noticelake.operators.classify import HIGH_SCHOOL, REVIEW
from noticelake.operators.quality import validate, vacancy_key


def revision_rank(title: Column) -> Column:
    return F.when(title.contains("재재공고"), 4).when(title.contains("재공고"), 3).when(title.rlike("수정|변경"), 2).otherwise(1)


def preferred_jobs(jobs: DataFrame, order: str) -> DataFrame:
    """Of each organisation, title key and vacancy the job of the highest revision, deadline, checked detail and fit; ties keep the first by ``order``.

    A struct minimum, combined before the shuffle, decides; the deadline is compared as days so that the latest comes first.
    """
    late = -F.coalesce(F.unix_date(F.try_to_date(F.nullif(F.col("deadline"), F.lit("")), "yyyy-MM-dd")), F.lit(-1_000_000))
    rank = F.struct((-revision_rank(F.col("title"))).alias("a"), late.alias("b"), (~F.coalesce("detail_ok", F.lit(False))).alias("c"), (-F.col("fit_score")).alias("d"), F.col(order).alias("e"))
    name = F.coalesce(F.col("vacancy_name"), F.lit("")) if "vacancy_name" in jobs.columns else F.lit("")
    best = jobs.groupBy(F.col("org").alias("_org"), title_key(F.col("title")).alias("_title"), name.alias("_vacancy")).agg(F.min_by(F.struct(*jobs.columns), rank).alias("r"))
    return best.select("r.*")


def retain(new: DataFrame, previous: DataFrame, failed: DataFrame, as_of: Column) -> DataFrame:
    """New jobs of sources that worked, and the previous unexpired ones of those that failed; retained tells which."""
    orgs = failed.select("org").distinct()
    fresh = new.join(orgs, "org", "left_anti").withColumn("retained", F.lit(False))
    kept = previous.join(orgs, "org", "left_semi").where(~is_expired(F.col("deadline"), as_of)).withColumn("retained", F.lit(True))
    return fresh.unionByName(kept)


def breaker_metrics(results: DataFrame, new_jobs: DataFrame, previous_jobs: DataFrame) -> DataFrame:
    """One row: sources, successes, jobs before and now, and whether either breaker trips."""
    sources = results.agg(F.count(F.lit(1)).alias("sources"), F.count_if("ok").alias("success"))
    count = lambda df, n: df.agg(F.count(F.lit(1)).alias(n))
    row = sources.crossJoin(count(new_jobs, "jobs")).crossJoin(count(previous_jobs, "previous"))  # each side is one row
    collapse = (F.col("previous") >= 5) & (F.col("jobs") < F.greatest(F.lit(2), F.floor(F.col("previous") * 0.2))) & (F.col("success") / F.col("sources") < 0.7)
    return row.withColumns({"no_success": F.col("success") == 0, "collapsed": collapse})


def guard(feed: DataFrame, metrics: DataFrame) -> DataFrame:
    """The feed, whose evaluation fails if a breaker tripped."""
    row = metrics.first()
    if row["no_success"]:
        raise RuntimeError("no source succeeded")
    if row["collapsed"]:
        raise RuntimeError(f"jobs collapsed from {row['previous']} to {row['jobs']}")
    return feed


#: Counters of sources that a run's statistics sum up.
COUNTERS = ("rejected", "detail_failures", "detail_attempted", "detail_validated", "attachments_discovered", "downloads_attempted", "attachments_downloaded", "documents_attempted", "documents_parsed", "vacancies_detected", "vacancies_accepted", "vacancies_rejected")


def statistics(jobs: DataFrame, sources: DataFrame, issues: DataFrame, passing: int = 85) -> DataFrame:
    """One row of a run's published numbers: of jobs, of its sources (ok, degraded, failed and the counters) and of the QA issues.

    A job passes at its own quality_threshold, or at ``passing`` where it has none. Each side is an aggregate that Spark combines before it shuffles.
    """
    score = F.coalesce(F.col("quality_score"), F.lit(0))
    threshold = F.coalesce(F.col("quality_threshold"), F.lit(passing)) if "quality_threshold" in jobs.columns else F.lit(passing)
    retained = F.count_if("retained") if "retained" in jobs.columns else F.lit(0).cast("long")
    of_jobs = jobs.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("recommended").alias("recommended"),
        F.count_if(F.col("education") == HIGH_SCHOOL).alias("high_school_suitable"),
        F.count_if("detail_ok").alias("detail_checked"),
        F.count_if(F.col("status") == REVIEW).alias("review_needed"),
        F.count_if(score >= threshold).alias("quality_passed"),
        F.coalesce(F.floor(F.avg(score) + 0.5), F.lit(0)).cast("long").alias("average_quality_score"),
        retained.alias("retained_jobs"),
    )
    of_sources = sources.agg(
        F.count(F.lit(1)).alias("source_count"),
        F.count_if("ok").alias("success"),
        F.count_if("degraded").alias("degraded_sources"),
        F.count_if("failed").alias("failed_sources"),
        *[F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0)).alias(c) for c in COUNTERS],
    )
    of_issues = issues.agg(F.count(F.lit(1)).alias("qa_issue_count")).withColumn("qa_passed", F.col("qa_issue_count") == 0)
    return of_sources.crossJoin(of_jobs).crossJoin(of_issues)  # each side is one row


def statistics_by_source(jobs: DataFrame, sources: DataFrame, counters: dict[str, Column], passing: int = 85) -> DataFrame:
    """statistics of scored jobs, in one pass over them: sources has org, ok, degraded and failed, counters are the numbers that a job adds to those of its source.

    ``jobs`` are told apart by rows: of those with one vacancy_key all but one are duplicates. Sums by key and organisation are combined before they are shuffled, and those by
    organisation, a row each, are kept for the totals. Jobs of no source count as jobs, but in no source's counters.
    """
    score = F.coalesce(F.col("quality_score"), F.lit(0))
    threshold = F.coalesce(F.col("quality_threshold"), F.lit(passing)) if "quality_threshold" in jobs.columns else F.lit(passing)
    is_ = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    of_job = {
        "total": F.lit(1),
        "recommended": is_(F.col("recommended")),
        "high_school_suitable": is_(F.col("education") == HIGH_SCHOOL),
        "detail_checked": is_(F.col("detail_ok")),
        "review_needed": is_(F.col("status") == REVIEW),
        "quality_passed": is_(score >= threshold),
        "_score": score,
        "retained_jobs": is_(F.col("retained")) if "retained" in jobs.columns else F.lit(0),
    }
    of_source = {f"_{n}": counters.get(n, F.lit(0)) for n in COUNTERS}
    rows = validate(jobs)
    rows = rows.select("org", vacancy_key(jobs).alias("_key"), F.size("errors").alias("_issues"), *[c.alias(n) for n, c in (of_job | of_source).items()])
    sums = ["_issues", *of_job, *of_source]
    add = [F.sum(F.col(c).cast("long")).alias(c) for c in sums]
    keys = rows.groupBy("_key", "org").agg(*add)
    # a key is nearly always of one organisation; its first one pays for the job that is no duplicate
    told = keys.groupBy("_key").agg(F.collect_list(F.struct("org", *sums)).alias("o")).select(F.posexplode("o").alias("at", "o")).select("at", "o.*")
    told = told.withColumn("_issues", F.col("_issues") + F.col("total") - F.when(F.col("at") == 0, 1).otherwise(0))
    by_org = cut(told.groupBy("org").agg(*add))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    average = F.coalesce(F.floor(F.sum("_score") / F.sum("total") + 0.5), F.lit(0)).cast("long").alias("average_quality_score")
    of_jobs = by_org.agg(*[average if c == "_score" else total(c).alias(c) for c in of_job])
    known = sources.select("org", "ok", "degraded", "failed").join(by_org.select("org", *of_source), "org", "left")
    of_sources = known.agg(
        F.count(F.lit(1)).alias("source_count"),
        F.count_if("ok").alias("success"),
        F.count_if("degraded").alias("degraded_sources"),
        F.count_if("failed").alias("failed_sources"),
        *[total(f"_{c}").alias(c) for c in COUNTERS],
    )
    of_issues = by_org.agg(total("_issues").alias("qa_issue_count")).withColumn("qa_passed", F.col("qa_issue_count") == 0)
    return of_sources.crossJoin(of_jobs).crossJoin(of_issues)  # each side is one row


def feed_order(jobs: DataFrame) -> list[Column]:
    """The order of the feed, of the columns that jobs has; an unknown deadline comes last."""
    orders = {"recommended": F.desc("recommended"), "quality_score": F.desc("quality_score"), "fit_score": F.desc("fit_score"), "deadline": F.coalesce(F.nullif(F.col("deadline"), F.lit("")), F.lit("9999-12-31"))}
    return [o for c, o in orders.items() if c in jobs.columns]


def ranked_feed(jobs: DataFrame, order: str, limit: int = 200) -> DataFrame:
    return jobs.orderBy(*feed_order(jobs), order).limit(limit)
