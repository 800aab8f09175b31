"""Stage reports: health, causes, priorities, differences between runs, history and funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STAGES = ["access", "list", "detail", "discovery", "download", "analysis"]
# Points by stage.
PRIORITY = [("http", 110), ("recruitVerify", 100), ("access", 100), ("list", 80), ("detail", 60), ("attachmentDiscovery", 45), ("attachment", 45), ("attachmentDownload", 35), ("documentAnalysis", 25)]
HARD = r"HTTP_FORBIDDEN|TIMEOUT|API|DYNAMIC|JAVASCRIPT|POST|SPA|IFRAME"
MEDIUM = r"DETAIL_|LIST_DETAIL_SIGNAL|LIST_URL|LIST_COUNTER|LIST_MISSING|LIST_EXTRA"
URGENT = r"TIMEOUT|404|FORBIDDEN|MISSING|EXTRA|EMPTY"


def health() -> Column:
    """Of the stage flags; a missing download or analysis counts as good."""
    ok = lambda c, missing=False: F.coalesce(F.col(c), F.lit(missing))
    full = ok("access") & ok("list") & ok("detail") & ok("discovery") & ok("download", True) & ok("analysis", True)
    return F.when(full, "healthy").when(ok("access"), "degraded").otherwise("failed")


def difficulty(code: Column) -> Column:
    return F.when(code.rlike(HARD), 3).when(code.rlike(MEDIUM), 2).otherwise(1)


def priority(stage: Column, code: Column) -> Column:
    base = F.lit(10)
    for name, points in reversed(PRIORITY):
        base = F.when(stage == name, points).otherwise(base)
    label = F.when(base >= 100, "최우선").when(base >= 80, "높음").when(base >= 60, "보통").otherwise("낮음")
    return F.struct((base + F.when(code.rlike(URGENT), 10).otherwise(0)).alias("score"), label.alias("label"))


def primary_cause(statuses: Column) -> Column:
    """The first stage, in the array's order, that failed, is partial or unknown; blocked ones are passed over."""
    bad = F.filter(statuses, lambda s: s["status"].isin("failed", "partial", "unknown"))
    done = F.struct(F.lit("complete").alias("stage"), F.lit("success").alias("status"), F.lit("PIPELINE_SAMPLE_OK").alias("code"))
    return F.coalesce(F.get(bad, F.lit(0)), done)


def snapshot_diff(now: DataFrame, before: DataFrame, key: str = "org", removed: bool = False) -> DataFrame:
    """One row per key of now and stage: was, is and change (new, same, improved, regressed); gone keys only if asked for."""
    tall = lambda df: df.select(key, F.explode(F.array(*[F.struct(F.lit(s).alias("stage"), F.coalesce(F.col(s), F.lit(False)).alias("ok")) for s in STAGES])).alias("x")).select(key, "x.*")
    rows = tall(now).withColumnRenamed("ok", "now").join(tall(before).withColumnRenamed("ok", "before"), [key, "stage"], "full" if removed else "left")
    change = F.when(F.col("now").isNull(), "removed").when(F.col("before").isNull(), "new").when(F.col("before") == F.col("now"), "same").when(F.col("now"), "improved").otherwise("regressed")
    return rows.withColumn("change", change)


def regressions(diff: DataFrame, key: str = "org") -> DataFrame:
    return diff.where(F.col("change") == "regressed").groupBy(key).agg(F.array_join(F.array_sort(F.collect_list("stage")), ",").alias("stages"))


def bounded_history(runs: DataFrame, key: str, at: str, tie: str, keep: int = 20) -> DataFrame:
    """The last ``keep`` rows of each key. Spark limits each task's groups before the shuffle, so a hot key sends few rows."""
    latest = Window.partitionBy(key).orderBy(F.desc(at), F.desc(tie))
    return runs.withColumn("age", F.row_number().over(latest)).where(F.col("age") <= keep)


def funnel(stages: DataFrame) -> DataFrame:
    """How many reach each stage, and the share of those at the stage before."""
    counts = stages.agg(F.count(F.lit(1)).alias("sources"), *[F.count_if(s).alias(s) for s in STAGES])
    pairs = [F.struct(F.lit(i).alias("pos"), F.lit(s).alias("stage"), F.col(s).alias("n"), F.col(STAGES[i - 1] if i else "sources").alias("of")) for i, s in enumerate(STAGES)]
    rows = counts.select(F.explode(F.array(*pairs)).alias("x")).select("x.*")
    return rows.withColumn("ratio", F.when(F.col("of") == 0, 0.0).otherwise(F.round(F.col("n") / F.col("of"), 6)))


def merge_stages(probe: DataFrame, collector: DataFrame) -> DataFrame:
    """The probe's stage rows with download and analysis from what the collector counted for the same organisation.

    probe: org, access, list, detail, discovery, download, analysis and nothing_to_read (no posts, or none with attachments); collector:
    org, downloads_attempted, attachments_downloaded, documents_attempted, documents_parsed. Where nothing is to be read both stages are
    not required; where the collector tried, its counts decide; else the probe's own result stays.
    """
    df = probe.join(collector, "org", "left")

    def stage(own: str, tried: str, done: str) -> Column:
        n, good = F.coalesce(tried, F.lit(0)), F.coalesce(done, F.lit(0))
        made = lambda ok, status, mode: F.struct(ok.alias("ok"), status.alias("status"), n.alias("attempted"), good.alias("succeeded"), F.lit(mode).alias("mode"))
        counted = F.when(good == n, "success").when(good > 0, "partial").otherwise("failed")
        probed = F.when(F.col(own).isNull(), "not-attempted").when(F.col(own), "success").otherwise("failed")
        idle = F.struct(F.lit(True).alias("ok"), F.lit("not-required").alias("status"), F.lit(0).cast("long").alias("attempted"), F.lit(0).cast("long").alias("succeeded"), F.lit("not-required").alias("mode"))
        return F.when(F.coalesce("nothing_to_read", F.lit(False)), idle).when(n > 0, made(good == n, counted, "collector")).otherwise(made(F.coalesce(own, F.lit(False)), probed, "probe"))

    df = df.withColumns({"download": stage("download", "downloads_attempted", "attachments_downloaded"), "analysis": stage("analysis", "documents_attempted", "documents_parsed")})
    found, read, parsed = F.coalesce("discovery", F.lit(False)), F.col("download.ok"), F.col("analysis.ok")
    done = F.coalesce("access", F.lit(False)) & F.coalesce("list", F.lit(False)) & F.coalesce("detail", F.lit(False)) & found & read & parsed
    bottleneck = F.when(done, F.when(F.coalesce("nothing_to_read", F.lit(False)), "전체 파이프라인 통과 · 첨부/문서분석 대상 없음").otherwise("전체 파이프라인 통과"))
    bottleneck = bottleneck.when(F.coalesce("detail", F.lit(False)) & ~found, "첨부 발견/추출").when(found & ~read, "첨부 다운로드").when(read & ~parsed, "문서 분석").otherwise("")
    return df.select("org", "access", "list", "detail", "discovery", "download", "analysis", bottleneck.alias("bottleneck"))


def access_summary(attempts: DataFrame) -> DataFrame:
    """For each organisation of an attempt table (org, ok, error): code of its access."""
    e = F.coalesce(F.col("error"), F.lit(""))
    got = attempts.groupBy("org").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if("ok").alias("http_ok"),
        F.every(e.rlike("(?i)timeout")).alias("t"),
        F.some(e.rlike("404")).alias("n"),
        F.some(e.rlike("403")).alias("f"),
        F.some(e.rlike(r"HTTP 5\d\d")).alias("s"),
    )
    code = F.when(F.col("http_ok") > 0, "HTTP_OK").when(F.col("t"), "HTTP_TIMEOUT_ALL").when(F.col("n"), "HTTP_404").when(F.col("f"), "HTTP_FORBIDDEN").when(F.col("s"), "HTTP_SERVER_ERROR").otherwise("HTTP_FAILED")
    return got.select("org", "attempts", "http_ok", code.alias("code"))
