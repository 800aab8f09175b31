"""Evidence of pages and of sources that are not healthy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions import rules as R
from noticelake.functions.text import compact, slug

SNIPPETS, SCRIPTS = 24, 12


def snippets(html: Column) -> Column:
    """The first 24 distinct rows, blocks and addresses that speak of recruitment, by kind and place."""
    found = F.concat(*[F.regexp_extract_all(html, F.lit(p), F.lit(0)) for p in R.RECRUIT_SNIPPETS])
    return F.slice(F.array_distinct(F.transform(found, lambda x: compact(x, 9000))), 1, SNIPPETS)


def scripts(html: Column) -> Column:
    """The first 12 scripts of a page that lead to other pages."""
    bodies = F.regexp_extract_all(html, F.lit(r"(?i)<script\b[^>]*>([\s\S]*?)</script>"), F.lit(1))
    return F.slice(F.transform(F.filter(bodies, lambda x: x.rlike(R.NAVIGATION_SCRIPT)), lambda x: compact(x, 12_000)), 1, SCRIPTS)


def page_artifacts(pages: DataFrame, stage: str = "access") -> DataFrame:
    """org, stage, url, status, content_type, html_length, html_head, snippets and scripts of fetched pages."""
    html = F.coalesce("html", F.lit(""))
    return pages.select(
        "org",
        F.lit(stage).alias("stage"),
        "url",
        F.coalesce("status", F.lit(0)).alias("status"),
        F.coalesce("content_type", F.lit("")).alias("content_type"),
        F.length(html).alias("html_length"),
        compact(html).alias("html_head"),
        snippets(html).alias("snippets"),
        scripts(html).alias("scripts"),
    )


def unhealthy_evidence(report: DataFrame, artifacts: DataFrame) -> DataFrame:
    """The artifacts of each source whose health is not healthy, with the folder they belong to; sources without artifacts have one row."""
    return report.where(F.col("health") != "healthy").withColumn("folder", slug(F.col("org"))).join(artifacts, "org", "left")
