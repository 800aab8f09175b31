"""The posting view that the registered queries run on, built from orders, customers and nations, and the same view as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TITLES = [
    "2026년 {org} 일반직 직원 채용 공고",
    "{org} 신입직원 채용 최종합격자 명단 안내",
    "체험형 인턴 채용 공고",
    "[재공고] {org} 공무직 근로자 채용 공고",
    "{org} 간호사 직원 채용 공고",
    "{org} 정규직 공개 채용 계획 (수정)",
    "채용안내",
    "무기계약직 채용 모집 제2차",
]
EMPLOYMENTS = ["채용형태: 정규직", "채용형태: 공무직", "채용형태: 기간제 근로자", "무기계약직 (기간제 경력 인정)", "일반직 채용"]
EDUCATIONS = ["학력무관", "고졸 이상", "학사 이상", ""]
LOCATIONS = ["근무지: 울산광역시 남구", "근무지: 서울", "근무지: 울산, 부산", "전국 순환근무", "울산 울주군"]
PERIODS = ["접수기간: {date} ~ {date}", "원서접수 {date} 18시까지", "마감일: {date}", "", "접수기간: 26.02.30 ~ 26.02.31"]
NEEDS = ["응시자격: 산업기사 자격증 필수", "전기기사 자격증 우대", "경력 3년 이상\n관련 학과 전공자"]
FIELDS = ["모집분야 안내", "채용분야: 전산"]
DOCUMENTS = ["", "고용형태 기간제 근로자, 학사 이상, 근무지: 서울, 첨부문서 본문이 충분히 길게 이어집니다.", "고용형태 정규직, 학력무관, 근무지: 울산, 첨부문서 본문이 충분히 길게 이어지는 내용입니다.", "짧은 문서"]
SECOND = "채용분야: 시설관리\n채용형태: 정규직\n고졸 이상\n근무지: 울산광역시 남구\n채용인원: 2명"


def _nth(values: list[str], i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (i + 1).cast("int"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df over all cores, if it is read in fewer parts: small files would leave a long analysis to a few tasks. Large tables stay as they are read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """posting_id, cust, org, title, list_text, detail_text, document_text, link, detail_ok, documents_read and collected_at."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    orders = spread(read("orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey")
    who = spread(read("customer").select("c_custkey", "c_nationkey"), "c_custkey").join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    df = orders.join(who, F.col("o_custkey") == F.col("c_custkey"))
    k, c, org = F.col("o_orderkey"), F.col("o_custkey"), F.col("n_name")
    when = F.col("o_orderdate")
    date = F.concat_ws(".", (F.year(when) + 30).cast("string"), F.date_format(when, "MM"), F.date_format(when, "dd"))
    fill = lambda text: F.replace(F.replace(text, F.lit("{org}"), org), F.lit("{date}"), date)
    period = F.when(k % 50 == 0, PERIODS[4]).otherwise(fill(_nth(PERIODS[:4], F.floor(k / 8) % 4)))
    first = F.when(k % 3 == 0, "채용분야: 행정사무").otherwise(_nth(FIELDS, k % 2))
    lines = [F.when(k % 6 == 1, "").otherwise(first), _nth(EMPLOYMENTS, k % 5), _nth(EDUCATIONS, c % 4), _nth(LOCATIONS, F.col("n_regionkey")), period, F.lit("채용인원: 3명"), _nth(NEEDS, k % 3)]
    lines += [F.when(k % 3 == 0, SECOND).otherwise("")]
    title = fill(_nth(TITLES, k % 8))
    key = k.cast("string")
    link = F.when(k % 11 == 0, "").when(k % 7 == 0, "https://jobs.example/list").otherwise(F.concat(F.lit("https://jobs.example/board/view.do?page=1&nttId="), key, F.lit("&menuNo=3#top")))
    return df.select(
        k.alias("posting_id"),
        c.alias("cust"),
        org.alias("org"),
        title.alias("title"),
        F.concat(title, F.lit(" "), date, F.when(k % 13 == 0, " 접수 마감").otherwise("")).alias("list_text"),
        F.array_join(F.filter(F.array(*lines), lambda x: x != ""), "\n").alias("detail_text"),
        _nth(DOCUMENTS, F.floor(k / 2) % 4).alias("document_text"),
        link.alias("link"),
        (k % 9 != 0).alias("detail_ok"),
        F.when(F.floor(k / 2) % 4 == 0, 0).otherwise(1).alias("documents_read"),
        F.replace(date, F.lit("."), F.lit("-")).alias("collected_at"),
    )


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_DATE = "(CAST(year(o_orderdate) + 30 AS VARCHAR) || strftime(o_orderdate, '.%m.%d'))"


def _fill(expr: str) -> str:
    return f"replace(replace({expr}, '{{org}}', n_name), '{{date}}', {_DATE})"


_TITLE = _fill(f"{_sql_list(TITLES)}[o_orderkey % 8 + 1]")
SQL = rf"""
postings AS (
  SELECT o_orderkey AS posting_id, o_custkey AS cust, n_name AS org, {_TITLE} AS title,
    {_TITLE} || ' ' || {_DATE} || CASE WHEN o_orderkey % 13 = 0 THEN ' 접수 마감' ELSE '' END AS list_text,
    array_to_string(list_filter([
      CASE WHEN o_orderkey % 6 = 1 THEN '' WHEN o_orderkey % 3 = 0 THEN '채용분야: 행정사무' ELSE {_sql_list(FIELDS)}[o_orderkey % 2 + 1] END,
      {_sql_list(EMPLOYMENTS)}[o_orderkey % 5 + 1], {_sql_list(EDUCATIONS)}[o_custkey % 4 + 1], {_sql_list(LOCATIONS)}[n_regionkey + 1],
      CASE WHEN o_orderkey % 50 = 0 THEN '{PERIODS[4]}' ELSE {_fill(f"{_sql_list(PERIODS[:4])}[o_orderkey // 8 % 4 + 1]")} END,
      '채용인원: 3명', {_sql_list(NEEDS)}[o_orderkey % 3 + 1], CASE WHEN o_orderkey % 3 = 0 THEN '{SECOND}' ELSE '' END], lambda x: x <> ''), chr(10)) AS detail_text,
    {_sql_list(DOCUMENTS)}[o_orderkey // 2 % 4 + 1] AS document_text,
    CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 7 = 0 THEN 'https://jobs.example/list'
      ELSE 'https://jobs.example/board/view.do?page=1&nttId=' || o_orderkey || '&menuNo=3#top' END AS link,
    o_orderkey % 9 <> 0 AS detail_ok, CASE WHEN o_orderkey // 2 % 4 = 0 THEN 0 ELSE 1 END AS documents_read, replace({_DATE}, '.', '-') AS collected_at
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
