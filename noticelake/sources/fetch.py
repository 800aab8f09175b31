"""Access to pages and feeds: plans of addresses, fetching by a given function, files and JSON feeds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelake.operators.documents import decode_bytes
from noticelake.operators.publish import feed_order

SOURCE = T.StructType(
    [
        T.StructField("org", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("access_template", T.StringType()),
        T.StructField("access_urls", T.ArrayType(T.StringType())),
        T.StructField("transport_chain", T.ArrayType(T.StringType())),
    ]
)
TEMPLATE = T.StructType([T.StructField("access_template", T.StringType()), T.StructField("label", T.StringType()), T.StructField("template_chain", T.ArrayType(T.StringType()))])
JOB = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("org", "title", "link", "deadline", "employment", "education", "location", "raw", "collected_at")]
    + [T.StructField(n, T.IntegerType()) for n in ("quality_score", "fit_score")]
    + [T.StructField(n, T.BooleanType()) for n in ("detail_ok", "recommended")]
)


def violations(sources: DataFrame, templates: DataFrame) -> DataFrame:
    """Sources that lack an organisation, an address, a known template or a transport, with the reason."""
    df = sources.join(templates, "access_template", "left")
    reason = F.when(F.coalesce("org", F.lit("")) == "", "no organisation").when(F.coalesce("url", F.lit("")) == "", "no address").when(F.col("label").isNull(), "unknown template")
    reason = reason.when(F.size(F.coalesce("transport_chain", "template_chain")) < 1, "no transport")
    return df.withColumn("reason", reason).where(F.col("reason").isNotNull()).select("org", "url", "reason")


def access_plan(sources: DataFrame, templates: DataFrame) -> DataFrame:
    """(org, priority, url, transports): the distinct addresses of each source in order; a source's own transports come before its template's."""
    df = sources.join(templates, "access_template", "left")
    urls = F.array_distinct(F.array_compact(F.concat(F.coalesce("access_urls", F.array().cast("array<string>")), F.array("url"))))
    chain = F.coalesce("transport_chain", "template_chain", F.array(F.lit("fetch"), F.lit("curl"), F.lit("resolved")))
    return df.select("org", F.posexplode(urls).alias("priority", "url"), chain.alias("transports"))


def fetch_pages(plan: DataFrame, fetch: Callable[[str, str], tuple[int, str, str]], tries: int = 2) -> DataFrame:
    """Attempts: org, priority, url, transport, attempt, ok, status, content_type, html, error, for each planned address until one answers.

    fetch(url, transport) gives status, content type and text, or raises; it runs in the tasks. Transports take turns in
    their order and each is tried ``tries`` times. Errors are rows, not failures.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for org, priority, url, transports in batch.itertuples(index=False, name=None):
                for attempt, transport in enumerate(t for t in transports for _ in range(tries)):
                    try:
                        status, kind, text = fetch(url, transport)
                        ok, error = status < 400, None if status < 400 else f"HTTP {status}"
                    except Exception as e:  # whatever a transport raises is that attempt's result
                        status, kind, text, ok, error = 0, "", "", False, str(e)
                    rows.append((org, priority, url, transport, attempt, ok, status, kind, text, error))
                    if ok:
                        break
            yield pd.DataFrame(rows, columns=["org", "priority", "url", "transport", "attempt", "ok", "status", "content_type", "html", "error"])

    schema = "org string, priority int, url string, transport string, attempt int, ok boolean, status int, content_type string, html string, error string"
    return plan.select("org", "priority", "url", "transports").mapInPandas(run, schema)


def usable_html(pages: DataFrame) -> DataFrame:
    kind = F.coalesce("content_type", F.lit(""))
    return pages.where(((kind == "") | kind.rlike("(?i)html|xhtml")) & (F.length(F.trim("html")) >= 80))


def pages_from_files(spark: SparkSession, path: str, base: str) -> DataFrame:
    """Saved pages of a folder: url (below base), html, decoded by the charset that each declares."""
    files = spark.read.format("binaryFile").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(F.concat(F.lit(base.rstrip("/") + "/"), name).alias("url"), decode_bytes("content", F.lit("text/html")).alias("html"))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """The jobs of a published feed, by a fixed schema; no feed yet is an empty table."""
    try:
        df = spark.read.schema(T.StructType([T.StructField("jobs", T.ArrayType(JOB))])).option("multiLine", True).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], JOB)
    return df.select(F.explode("jobs").alias("j")).select("j.*")


def write_feed(jobs: DataFrame, path: str, limit: int = 200) -> None:
    """One JSON document of the first ``limit`` jobs in the feed's order: the published feed is bounded by contract."""
    columns = [c for c in JOB.fieldNames() if c in jobs.columns]
    ties = [c for c in ("org", "title", "link") if c in jobs.columns]
    place = F.row_number().over(Window.orderBy("_place"))  # over at most ``limit`` rows
    best = jobs.orderBy(*feed_order(jobs), *ties).limit(limit).withColumn("_place", F.monotonically_increasing_id()).withColumn("_place", place)
    best.agg(F.transform(F.array_sort(F.collect_list(F.struct("_place", F.struct(*columns).alias("job")))), lambda x: x["job"]).alias("jobs")).coalesce(1).write.mode("overwrite").json(path)


def without_retired(df: DataFrame, retired: DataFrame, org: str = "org") -> DataFrame:
    return df.join(retired.select(F.col("org").alias(org)).distinct(), org, "left_anti")


SEARCH = "https://job.alio.go.kr/mobile2021/recruit/recruit.do"


def search_url(org: Column) -> Column:
    """The shared platform's search for the postings of one organisation."""
    return F.concat(F.lit(SEARCH + "?order=REG_DATE&org_name="), F.url_encode(org), F.lit("&search_yn=Y"))


def template_summary(sources: DataFrame, templates: DataFrame) -> DataFrame:
    """For each source one struct of what its report says about access."""
    df = sources.join(templates, "access_template", "left")
    chain = F.coalesce("transport_chain", "template_chain")
    urls = F.size(F.array_distinct(F.array_compact(F.concat(F.coalesce("access_urls", F.array().cast("array<string>")), F.array("url")))))
    return df.select("org", F.struct(F.col("access_template").alias("id"), "label", chain.alias("transports"), urls.alias("addresses"), F.col("transport_chain").isNotNull().alias("own")).alias("access"))


REPORT = T.StructType([T.StructField("sources", T.ArrayType(T.StructType([T.StructField("org", T.StringType()), T.StructField("health", T.StringType())] + [T.StructField(s, T.StructType([T.StructField("ok", T.BooleanType()), T.StructField("status", T.StringType())])) for s in ("access", "list", "detail", "attachmentDiscovery", "attachmentDownload", "documentAnalysis")])))])


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The stage rows of a probe's report, one for each organisation; no report yet is an empty table."""
    try:
        df = spark.read.schema(REPORT).option("multiLine", True).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], REPORT)
    return df.select(F.explode("sources").alias("s")).select("s.*")
