"""Requirements of a posting, line by line, and whether a profile meets them."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions import rules as R
from noticelake.functions.scan import found
from noticelake.functions.text import marked_context, marked_evidence

REQUIRED, PREFERRED, UNKNOWN = "required", "preferred", "unknown"


# What is looked for in each line of a text.
PLACE, KIND = r"근무지|근무지역|근무장소|근무예정지|배치예정지", r"(채용|고용|근로)\s*(형태|유형|구분)|정규직|무기계약직|공무직|기간제|계약직|인턴"
LINES = {
    "licenses": R.LICENSE_LINE,
    "experience": R.EXPERIENCE_LINE,
    "major": R.MAJOR_LINE,
    "identity": R.IDENTITY_LINE,
    "other": R.OTHER_LINE,
    "preferred": R.PREFERRED_LEVEL,
    "required": R.REQUIRED_LEVEL,
    "any_experience": r"신입\s*가능|경력\s*무관",
    "years": r"\d+\s*년\s*이상",
    "place": R.fused([PLACE, *R.LOCATION_VALUES]),
    "kind": R.fused(R.EMPLOYMENT_VALUES),
    **{f"school{i}": p for i, (_, p) in enumerate(R.EDUCATION_VALUES)},
}
SCHOOLS = [(v, f"school{i}") for i, (v, _) in enumerate(R.EDUCATION_VALUES)]


def level(line: Column) -> Column:
    """Words of preference beat words of requirement."""
    return F.when(line["preferred"], PREFERRED).when(line["required"], REQUIRED).otherwise(UNKNOWN)


def _items(lines: Column, mark: str, limit: int, of=level) -> Column:
    return F.transform(F.slice(F.filter(lines, lambda x: x[mark]), 1, limit), lambda x: F.struct(F.left(x["line"], F.lit(260)).alias("value"), of(x).alias("level")))


def _experience_level(line: Column) -> Column:
    return F.when(line["any_experience"], UNKNOWN).when(line["years"], REQUIRED).otherwise(level(line))


def requirements(text: Column) -> Column:
    """education, licenses, experience, major, identity, location, employment and other, as one struct."""
    lines = marked_context(text, **LINES)
    values = F.array_distinct(F.flatten(F.transform(lines, lambda x: F.array_compact(F.array(*[F.when(x[mark], v) for v, mark in SCHOOLS])))))
    said = F.transform(F.filter(lines, lambda x: reduce(or_, [x[mark] for _, mark in SCHOOLS])), lambda x: x["line"])
    named = lambda labels: F.filter(F.array(*[F.lit(v) for v in labels]), lambda v: text.contains(v))
    block = lambda v, needed, e: F.struct(v.alias("values"), F.when(needed, REQUIRED).otherwise(UNKNOWN).alias("level"), e.alias("evidence"))
    return F.struct(
        block(values, F.size(values) > 0, F.slice(F.array_distinct(said), 1, 5)).alias("education"),
        _items(lines, "licenses", 12).alias("licenses"),
        _items(lines, "experience", 8, _experience_level).alias("experience"),
        _items(lines, "major", 8).alias("major"),
        _items(lines, "identity", 8).alias("identity"),
        block(named(R.LOCATION_VALUES), found(text, PLACE), marked_evidence(lines, "place", 5, 260)).alias("location"),
        block(named(R.EMPLOYMENT_VALUES), found(text, KIND), marked_evidence(lines, "kind", 5, 260)).alias("employment"),
        _items(lines, "other", 8).alias("other"),
    )


def with_requirements(postings: DataFrame) -> DataFrame:
    parts = [F.nullif(F.col(c), F.lit("")) for c in ("title", "list_text", "detail_text", "document_text")]
    return postings.withColumn("requirements", requirements(F.concat_ws("\n", *parts)))


def eligibility(df: DataFrame, profile: DataFrame) -> DataFrame:
    """Adds support_status and unresolved against a profile of one row: education, licenses (null: not known), experience_known, major_known.

    The profile is one row by contract, so it goes along as a constant; more rows are an error.
    """
    rows = profile.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("a profile is one row")
    p = rows[0]
    values, need = F.col("requirements.education.values"), lambda c: F.filter(F.col(f"requirements.{c}"), lambda x: x["level"] == REQUIRED)
    none = F.lit(False)
    degree = F.exists(values, lambda v: v.isin("대졸 이상", "전문대 이상")) & F.lit(p["education"] == "고졸")
    licenses = need("licenses")
    lacks = F.exists(licenses, lambda x: ~F.exists(F.array(*[F.lit(v) for v in p["licenses"]]).cast("array<string>"), lambda v: x["value"].contains(v))) if p["licenses"] is not None else none
    open_reasons = R.reasons(
        ((F.size(values) > 0) & F.lit(p["education"] is None), "학력 보유정보 확인 필요"),
        ((F.size(licenses) > 0) & F.lit(p["licenses"] is None), "필수 자격 보유여부 확인 필요"),
        ((F.size(need("experience")) > 0) & F.lit(not p["experience_known"]), "필수 경력 보유여부 확인 필요"),
        ((F.size(need("major")) > 0) & F.lit(not p["major_known"]), "필수 전공/관련분야 요건 확인 필요"),
    )
    df = df.withColumn("unresolved", open_reasons)
    return df.withColumn("support_status", F.when(degree | lacks, "ineligible").when(F.size("unresolved") > 0, "needs-review").otherwise("eligible-or-no-hard-conflict"))


def samples(postings: DataFrame, order: str) -> DataFrame:
    """One row for each real posting or vacancy of an organisation: sample_key, org, requirements and what backs them, the first by ``order``.

    postings has requirements and the texts they come from. The key is the link, else the vacancy's id, its name or the title; a row without any
    text is no sample, and neither is one that only a file's name names. The first of a key comes from a struct's minimum, combined before the shuffle.
    """
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    name = F.coalesce(F.nullif(F.col("vacancy_name"), F.lit("")), F.col("title")) if "vacancy_name" in postings.columns else F.col("title")
    df = postings.withColumns({"from_document": filled("document_text"), "from_detail": filled("detail_text"), "from_list": filled("list_text"), "_name": F.coalesce(name, F.lit(""))})
    file_only = F.trim("_name").rlike(r"(?i)\.(?:pdf|hwp|hwpx|docx?|xlsx?|zip)$") & ~filled("link")
    df = df.where((F.col("from_document") | F.col("from_detail") | F.col("from_list")) & ~file_only)
    vacancy = F.nullif(F.col("vacancy_id").cast("string"), F.lit("")) if "vacancy_id" in postings.columns else F.lit(None).cast("string")
    df = df.withColumn("sample_key", F.concat_ws("::", "org", F.coalesce(F.nullif(F.col("link"), F.lit("")), vacancy, F.col("_name"))))
    kept = ["org", "title", "requirements", "from_document", "from_detail", "from_list"]
    return df.groupBy("sample_key").agg(F.min_by(F.struct(*kept), order).alias("s")).select("sample_key", "s.*")


def category_report(sampled: DataFrame) -> DataFrame:
    """For each of the eight categories: postings that have it, its items by level, and the institutions in order and number."""
    item = lambda k: lambda x: F.struct(F.lit(k).alias("category"), x["level"].alias("level"))
    block = lambda k: F.transform(F.col(f"requirements.{k}.values"), lambda v: F.struct(F.lit(k).alias("category"), F.col(f"requirements.{k}.level").alias("level")))
    items = F.flatten(F.array(*[F.transform(F.col(f"requirements.{k}"), item(k)) for k in ("licenses", "experience", "major", "identity", "other")], *[block(k) for k in ("education", "location", "employment")]))
    rows = sampled.select("sample_key", "org", F.explode(items).alias("i")).groupBy("i.category", "sample_key", "org").agg(*[F.count_if(F.col("i.level") == v).alias(v) for v in (REQUIRED, PREFERRED, UNKNOWN)])
    sums = [F.sum(v).alias(v) for v in (REQUIRED, PREFERRED, UNKNOWN)]
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("postings"), *sums, F.array_sort(F.collect_set("org")).alias("institutions")).withColumn("institution_count", F.size("institutions").cast("long"))


def category_stats(df: DataFrame) -> DataFrame:
    """For each category: how many items are required, preferred and unknown, and how many institutions name it."""
    kinds = ("licenses", "experience", "major", "identity", "other")
    named = lambda k: F.transform(F.col(f"requirements.{k}"), lambda x: F.struct(F.lit(k).alias("category"), x["level"].alias("level")))
    items = F.flatten(F.array(*[named(k) for k in kinds]))
    rows = df.select("org", F.explode(items).alias("i")).select("org", "i.*")
    return rows.groupBy("category").agg(*[F.count_if(F.col("level") == v).alias(v) for v in (REQUIRED, PREFERRED, UNKNOWN)], F.count_distinct("org").alias("institutions"))
