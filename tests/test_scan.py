"""Patterns looked for by Arrow: they mean what they mean to Spark, and the analysis leaves them to Arrow."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from noticelake.functions import dates
from noticelake.functions import rules as R
from noticelake.functions.scan import found, marked_lines, portable, replaced
from noticelake.functions.text import squash
from noticelake.operators import classify, feed, publish, quality, requirements, vacancies

TEXTS = [None, "", " ", "고졸\x0b이상", "학력 무관", "학력 \n무관", "/ 마감", "/ 마감\n", "/마감 ", "/마감\r\n", "/ 마감.", "404", "NOT\tFOUND", "학사\r\n이상", "기존 기간제 근무", "기간제 근로자", "채용형태: 계약직", "a\u0085b", "정규직 전환 없음", "계약기간: 2026.1 까지", "전국사업장 울산", "3 년 이상 경력 무관", "채용 인원 3명"]


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("extended")
    return out.getvalue().split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]


def test_patterns_mean_the_same_to_arrow(spark):
    patterns = [R.fused(p) for p in (R.NON_JOB, R.EXCLUDED_EMPLOYMENT, R.TEMPORARY_STRONG, R.DEGREE_REQUIRED, R.HIGH_SCHOOL_OK, R.REQUIRED_LICENSE)]
    patterns += [R.CLOSED_LISTING, R.ERROR_TEXT, R.ULSAN, R.NATIONWIDE, R.EXPERIENCE_LINE, R.VACANCY_HEADER, R.VACANCY_CONDITION, "a.b", dates.RANGE, dates.UNTIL, dates.LABELLED]
    t = F.col("t")
    df = spark.createDataFrame([(x,) for x in TEXTS], "t string")
    for row in df.select(t, *[F.struct(found(t, p).alias("a"), t.rlike(p).alias("b")).alias(f"p{i}") for i, p in enumerate(patterns)]).collect():
        assert all(row[f"p{i}"]["a"] == row[f"p{i}"]["b"] for i in range(len(patterns))), row
    for row in df.select(t, replaced(t, (r"\s+", " "), (r"기간제|\d", "")).alias("a"), F.regexp_replace(F.regexp_replace(t, r"\s+", " "), r"기간제|\d", "").alias("b")).collect():
        assert row["a"] == row["b"], row


@pytest.mark.parametrize("pattern", [r"(?<!비)정규직", r"(?i)<tr\b", r"(?i)detail|link", r"(a)\1"])
def test_patterns_that_would_differ_are_errors(pattern):
    with pytest.raises(ValueError):
        portable(pattern)


def test_lines_are_trimmed_marked_and_bounded(one):
    lines = lambda c: marked_lines(c, r"\n", [(r"\s+", " ")], " ", {"x": "가"}, 2, 4)
    assert [tuple(r) for r in one(lines, " 가 \n가\t나\n\n다라\n가나다라마\n")] == [("가 나", True), ("다라", False)]
    assert one(lines, "") == [] and one(lines, None) is None


def _by_spark(text):
    """extract_deadline by Spark's own functions, a pattern for each part."""
    c = squash(text)
    g = lambda pattern, i: F.regexp_extract(c, pattern, i)
    last = lambda i: F.element_at(F.regexp_extract_all(c, F.lit(dates.LABELLED), F.lit(i)), -1)
    date = lambda y, m, d: dates._date(y, m, d, 2026)
    labelled = F.when(F.size(F.regexp_extract_all(c, F.lit(dates.LABELLED), F.lit(0))) > 0, date(last(1), last(2), last(3)))
    until = F.when(c.rlike(dates.UNTIL), date(*[g(dates.UNTIL, i) for i in (1, 2, 3)]))
    return F.when(c.rlike(dates.RANGE), F.coalesce(date(*[g(dates.RANGE, i) for i in (4, 5, 6)]), F.lit(""))).otherwise(F.coalesce(until, labelled, F.lit("")))


def test_dates_of_odd_texts(spark):
    texts = [None, "", "접수기간 7.1 마감일: 2026.8.3", "접수 마감 26년 9월 1일, 마감일 10/2", "공고기간 2026.1.2 공고기간 3.4", "공고기간: 26-7-1 공고기간: 미정", "마감일: 2026.13.40", "공고기간 \x01 2026.8.3\x01 \x02", "26.7.1 ~ 26.7.40 마감일 2026.8.3", "26.7.1\n~\t2026.7.20", "원서접수 8월 2일 까지", "원서접수\u20288월 2일\x0b까지"]
    c = F.col("t")
    got = spark.createDataFrame([(x,) for x in texts], "t string").select("t", dates.extract_deadline(c, 2026).alias("a"), _by_spark(c).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got), got
    assert len({r["a"] for r in got}) > 6


def _texts(spark):
    return spark.createDataFrame([("직원 채용 공고", "", "고졸", "", True)], "title string, list_text string, detail_text string, document_text string, detail_ok boolean")


def test_the_verdict_is_left_to_arrow(spark):
    """no pattern of the verdict is looked for alternative by alternative in the JVM."""
    df = _texts(spark).withColumn("deadline", dates.extract_deadline(F.col("detail_text"), 2026))
    got = classify.analyze(df).select("deadline", "category", "status", "fit_score", "exclude_reasons", "evidence")
    assert "RLIKE" not in plan(got) and "regexp_extract" not in plan(got)
    assert got.first()["status"] == classify.REVIEW


def test_recent_jobs_compute_what_is_read(spark):
    """a column that nobody reads of the recent jobs is not computed."""
    jobs = spark.range(3).select(F.lit("o").alias("org"), F.col("id").alias("posting_id"), F.concat(F.lit("t"), F.col("id") % 2).alias("job_key"), F.repeat(F.col("id").cast("string"), 7).alias("unread"))
    recent = spark.createDataFrame([(0, "t1"), (1, "t0"), (2, "t9")], "pos int, job_key string")
    got = feed.recent_jobs(jobs, recent, "posting_id")
    assert [tuple(r) for r in got.select("pos", "job_key", "posting_id", "unread").collect()] == [(0, "t1", 1, "1" * 7), (1, "t0", 0, "0" * 7)]
    assert "repeat" not in plan(got.select("pos", "job_key", "posting_id"))


def _required(spark):
    return requirements.with_requirements(_texts(spark).withColumns({"org": F.lit("o"), "posting_id": F.lit(1), "link": F.lit("")}))


def test_the_report_of_requirements_is_left_to_arrow(spark):
    """the lines of a text are split, and looked through for all categories, a batch at a time."""
    got = requirements.category_report(requirements.samples(_required(spark), "posting_id"))
    assert plan(got).count("RLIKE") <= 1  # the name of a file
    assert [(r["category"], r["required"]) for r in got.collect()] == [("education", 1)]


def test_eligibility_is_left_to_arrow(spark):
    """F6."""
    profile = spark.createDataFrame([("고졸", None, False, False)], "education string, licenses array<string>, experience_known boolean, major_known boolean")
    got = requirements.eligibility(_required(spark), profile).select("support_status", "unresolved")
    assert "RLIKE" not in plan(got) and got.first()["support_status"] == "eligible-or-no-hard-conflict"


def test_stats_of_categories_are_left_to_arrow(spark):
    """F7."""
    got = requirements.category_stats(_required(spark).withColumn("requirements", requirements.requirements(F.lit("운전면허 필수\n경력 3년 이상 우대"))))
    assert "RLIKE" not in plan(got)
    assert sorted(tuple(r) for r in got.collect()) == [("experience", 1, 0, 0, 1), ("licenses", 1, 0, 0, 1)]


def test_lines_of_vacancies_are_left_to_arrow(spark):
    """a line's signs are looked for once, not again for each list of blocks."""
    got = vacancies.with_vacancies(_texts(spark)).select("shared_context", "vacancies")
    assert plan(got).count("RLIKE") <= 2  # parts of a row that is one
    assert got.first()["vacancies"][0]["source"] == "single"


def test_statistics_take_one_pass(spark):
    """the totals of jobs, sources and issues come from sums by organisation that are kept, not from the jobs again for each."""
    rows = [(i, o, t, bool(i % 3), bool(i % 4), i * 7 % 100, i % 5) for i, (o, t) in enumerate([("A", "x"), ("a", "X"), ("A", " x"), ("B", "y"), (None, "z"), (None, "z"), ("C", None), ("B", "y")])]
    jobs = spark.range(len(rows)).join(spark.createDataFrame(rows, "id long, org string, title string, recommended boolean, detail_ok boolean, quality_score int, documents_read int"), "id")
    texts = {"detail_text": F.lit("t"), "link": F.lit(""), "employment": F.lit("정규직"), "education": F.when(F.col("recommended"), classify.HIGH_SCHOOL).otherwise(""), "location": F.lit(classify.ULSAN), "deadline": F.lit(""), "status": F.lit(classify.REVIEW)}
    jobs = jobs.withColumns(texts)
    sources = spark.createDataFrame([("A", True, False, False), ("a", True, True, False), ("B", False, False, True), ("D", False, False, True)], "org string, ok boolean, degraded boolean, failed boolean")
    found = jobs.groupBy("org").agg(*[F.sum("documents_read").alias(c) for c in publish.COUNTERS])
    want = publish.statistics(jobs, sources.join(found, "org", "left"), quality.collection_issues(jobs, "id"))
    got = publish.statistics_by_source(jobs, sources, {c: F.col("documents_read") for c in publish.COUNTERS})
    assert got.first().asDict() == want.first().asDict()
    assert "Range" in plan(want) and "Range" not in plan(got)
    none = publish.statistics_by_source(jobs.where("id < 0"), sources, {c: F.col("documents_read") for c in publish.COUNTERS}).first()
    assert none["total"] == none["average_quality_score"] == none["rejected"] == 0 and none["source_count"] == 4 and none["qa_passed"]
