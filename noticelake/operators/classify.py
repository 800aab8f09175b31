"""Employment, education, location and category of a posting, and the verdict they give."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions import rules as R
from noticelake.functions.scan import ASCII_SPACES, found, lists_like, portable, split_lines, substituted
from noticelake.functions.text import CELL_END, marked_cells, marked_evidence

EXCLUDED, UNKNOWN_EMPLOYMENT = "제외 고용형태", "고용형태 확인 필요"
HIGH_SCHOOL, DEGREE, UNKNOWN_EDUCATION = "고졸 가능", "고졸 지원 어려움", "학력 확인 필요"
ULSAN, ELSEWHERE, UNKNOWN_LOCATION = "울산", "울산 외 또는 복수지역", "근무지 확인 필요"
RECOMMENDED, EXCLUDED_STATUS, REVIEW = "지원 추천", "제외", "확인 필요"
REGULAR = r"정규직"
NOT_REGULAR = r"비정규직|정규직\s*전환\s*(?:없음|불가)"


def has_excluded_employment(text: Column) -> Column:
    """Harmless mentions of temporary work go first, all of them, and then any excluded kind counts."""
    harmless = [(portable(p), " ") for p in R.TEMPORARY_BENIGN]
    counts = portable(R.fused([*R.EXCLUDED_EMPLOYMENT, *R.TEMPORARY_STRONG]))

    @F.arrow_udf("boolean")
    def excluded(v: pa.Array) -> pa.Array:
        return pc.match_substring_regex(substituted(v, harmless), counts)

    return excluded(text)


def employment(text: Column, excluded: Column | None = None) -> Column:
    """excluded: has_excluded_employment of the text, where it is at hand."""
    regular = text.contains(REGULAR) & ~found(text, NOT_REGULAR)
    kinds = F.when(has_excluded_employment(text) if excluded is None else excluded, EXCLUDED).when(found(text, r"무기계약직|기간의\s*정함이\s*없는\s*근로계약"), "무기계약직")
    for kind in ("공무직", "상용직", "일반직"):
        kinds = kinds.when(text.contains(kind), kind)
    return kinds.when(regular, REGULAR).otherwise(UNKNOWN_EMPLOYMENT)


def education(text: Column) -> Column:
    return F.when(found(text, R.fused(R.DEGREE_REQUIRED)), DEGREE).when(found(text, R.fused(R.HIGH_SCHOOL_OK)), HIGH_SCHOOL).otherwise(UNKNOWN_EDUCATION)


def places(text: Column) -> Column:
    """labelled (whether lines are labelled as a place of work), and here, nationwide and elsewhere: what these lines name, or else the head of the text.

    Other regions count in labelled lines only.
    """
    ends, label, here, nationwide, elsewhere = (portable(p) for p in (CELL_END, "(?i)" + R.LOCATION_LABEL, R.ULSAN, R.NATIONWIDE, R.OTHER_REGION))

    @F.arrow_udf("struct<labelled: boolean, here: boolean, nationwide: boolean, elsewhere: boolean>")
    def places(v: pa.Array) -> pa.Array:
        lists, flat, keep = split_lines(v, ends, [], ASCII_SPACES)
        named = lists_like(lists, pc.and_(keep, pc.match_substring_regex(flat, label)), flat)
        lines = pc.utf8_slice_codeunits(pc.binary_join(named, " "), 0, 1200)
        labelled = pc.not_equal(lines, "")
        target = pc.if_else(labelled, lines, pc.utf8_slice_codeunits(v, 0, 2400))
        other = pc.replace_substring(lines, "울산", "")
        signs = [labelled, pc.match_substring_regex(target, here), pc.match_substring_regex(target, nationwide), pc.match_substring_regex(other, elsewhere)]
        return pa.StructArray.from_arrays(signs, ["labelled", "here", "nationwide", "elsewhere"])

    return places(text)


def location(text: Column, signs: Column | None = None) -> Column:
    """signs: places of the text, where they are at hand."""
    signs = places(text) if signs is None else signs
    here, elsewhere = signs["here"], signs["elsewhere"] | signs["nationwide"]
    return F.when(here & ~elsewhere, ULSAN).when(signs["labelled"] & (~here | elsewhere), ELSEWHERE).otherwise(UNKNOWN_LOCATION)


def category(text: Column) -> Column:
    """The first category, in order, whose pattern the text holds."""
    rules = [(name, portable(p)) for name, p in R.CATEGORIES]

    @F.arrow_udf("string")
    def category(v: pa.Array) -> pa.Array:
        conditions = pa.StructArray.from_arrays([pc.fill_null(pc.match_substring_regex(v, p), False) for _, p in rules], [name for name, _ in rules])
        return pc.case_when(conditions, *[name for name, _ in rules], "기타")

    return category(text)


def cross_validate(detail: Column, document: Column) -> Column:
    """checked, conflict and reasons: where the page and its documents contradict each other."""
    checked = F.length(document) >= 40
    none = F.array().cast("array<string>")
    conflicts = R.reasons(
        (checked & employment(detail).isin(R.ALLOWED_EMPLOYMENT) & (employment(document) == EXCLUDED), "본문과 첨부문서의 고용형태 충돌"),
        (checked & (education(detail) == HIGH_SCHOOL) & (education(document) == DEGREE), "본문과 첨부문서의 학력 조건 충돌"),
        (checked & (location(detail) == ULSAN) & (location(document) == ELSEWHERE), "본문과 첨부문서의 근무지 충돌"),
    )
    told = F.when(checked, conflicts).otherwise(none)
    return R.bind(told, lambda x: F.struct(checked.alias("checked"), (F.size(x) > 0).alias("conflict"), x.alias("reasons")))


def decision_evidence(text: Column) -> Column:
    patterns = {
        "education": R.fused([*R.HIGH_SCHOOL_OK, *R.DEGREE_REQUIRED]),
        "employment": R.fused(["정규직|무기계약직|공무직|일반직|상용직", *R.EXCLUDED_EMPLOYMENT, *R.TEMPORARY_STRONG]),
        "location": R.fused(["(?i)(?:근무지|근무지역|근무장소|근무예정지|배치예정지|소재지)", "울산|울주군|새울"]),
    }
    lines = marked_cells(text, **patterns)
    return F.struct(*[marked_evidence(lines, name, 4, 240).alias(name) for name in patterns])


def analyze(postings: DataFrame, structured: Column | None = None) -> DataFrame:
    """Adds the verdict to rows of title, list_text, detail_text, document_text and detail_ok.

    Added: full_text, education, employment, location, category, cross, exclude_reasons, fit_reasons, sufficient,
    recommended, excluded, review_needed, status, fit_score, evidence. Null texts are empty.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    df = postings.withColumns({c: text(c) for c in ("title", "list_text", "detail_text", "document_text")})
    df = df.withColumn("full_text", F.regexp_replace(F.concat_ws("\n", F.trim("title"), "list_text", "detail_text", "document_text"), r"[ \t]+", " "))
    full = F.col("full_text")
    df = df.withColumns({"_excluded": has_excluded_employment(full), "_places": places(full)})  # each is used twice and more
    df = df.withColumns({"education": education(full), "employment": employment(full, F.col("_excluded")), "location": location(full, F.col("_places")), "category": category(full), "cross": cross_validate(F.col("detail_text"), F.col("document_text"))})
    allowed, high, ulsan = F.col("employment").isin(R.ALLOWED_EMPLOYMENT), F.col("education") == HIGH_SCHOOL, F.col("location") == ULSAN
    ok, detail = F.coalesce(F.col("detail_ok"), F.lit(False)), F.col("detail_text")
    signals = high.cast("int") + ulsan.cast("int") + allowed.cast("int") + found(detail, r"채용인원|모집인원|\d+명").cast("int")
    least = F.when(structured, 3).otherwise(4) if structured is not None else F.lit(4)
    sufficient = (F.length(detail) >= 120) | ((signals >= least) & (F.length(detail) >= 55))
    excludes = R.reasons(
        (found(F.trim("title"), R.fused(R.NON_JOB)), "채용공고가 아닌 안내·결과 공지"),
        (F.col("_excluded"), "인턴·기간제·계약직 등 제외 고용형태"),
        (found(F.trim("title"), R.fused(R.LICENSE_JOB)) | found(full, R.fused(R.REQUIRED_LICENSE)), "전문면허·전문자격 필수 직무"),
        (F.col("education") == DEGREE, "전문학사·학사 이상 조건"),
        (F.col("location") == ELSEWHERE, "울산 단일 근무가 아님"),
    )
    excludes = F.array_distinct(F.concat(excludes, F.col("cross.reasons")))
    fits = R.reasons(
        (high, "고졸 또는 학력무관 문구 확인"),
        (F.col("education") == UNKNOWN_EDUCATION, "학력 조건 원문 확인 필요"),
        (allowed, F.concat("employment", F.lit(" 문구 확인"))),
        (F.col("employment") == UNKNOWN_EMPLOYMENT, "고용형태 원문 확인 필요"),
        (ulsan, "울산 단일 근무지 확인"),
        (F.col("location") == UNKNOWN_LOCATION, "근무지 원문 확인 필요"),
        (F.col("cross.checked") & ~F.col("cross.conflict"), "본문-첨부문서 교차검증 통과"),
        (~ok, "상세페이지 판독 실패 또는 미지원"),
        (ok & ~F.col("sufficient"), "상세 본문이 너무 짧음"),
    )
    df = df.withColumns({"sufficient": sufficient, "exclude_reasons": excludes}).withColumn("fit_reasons", fits)
    df = df.withColumn("excluded", F.size("exclude_reasons") > 0)
    df = df.withColumn("recommended", ~F.col("excluded") & ok & F.col("sufficient") & high & ulsan & allowed)
    review = ~F.col("excluded") & ~F.col("recommended")
    score = F.least(F.lit(25) + 20 * (high.cast("int") + ulsan.cast("int") + allowed.cast("int")) + 10 * ok.cast("int"), F.lit(90))
    return df.withColumns(
        {
            "review_needed": review,
            "fit_score": F.when(F.col("recommended"), 100).when(F.col("excluded"), 0).otherwise(score),
            "status": F.when(F.col("recommended"), RECOMMENDED).when(F.col("excluded"), EXCLUDED_STATUS).otherwise(REVIEW),
            "evidence": decision_evidence(full),
        }
    ).drop("_excluded", "_places")


def legacy_analyze(postings: DataFrame, deadline: Column, as_of: str) -> DataFrame:
    """The older rule set: both education signs leave it open, an empty deadline is not open, and the score starts from 30."""
    text = F.concat_ws("\n", "title", "detail_text")
    high, degree = found(text, R.fused(R.HIGH_SCHOOL_OK)), found(text, R.fused(R.DEGREE_REQUIRED))
    eligibility = F.when(high & ~degree, HIGH_SCHOOL).when(degree & ~high, DEGREE).otherwise(UNKNOWN_EDUCATION)
    score = F.when(eligibility == HIGH_SCHOOL, 100).when(eligibility == DEGREE, 0).otherwise(30)
    score = score + F.when(text.rlike("울산"), 15).otherwise(0) + F.when(found(text, R.fused(R.ALLOWED_EMPLOYMENT)), 10).otherwise(0)
    return postings.withColumns({"legacy_eligibility": eligibility, "legacy_score": F.least(F.greatest(score, F.lit(0)), F.lit(100)), "legacy_open": (deadline != "") & (deadline >= as_of)})


def target_job(postings: DataFrame, deadline: Column, as_of: str) -> DataFrame:
    """Adds target and target_reasons, the rules of the oldest gate that a posting breaks: nine, over title and detail together."""
    both = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("detail_text", F.lit("")))
    broken = [(found(F.col("_both"), R.fused(patterns)), name) for name, patterns in R.TARGET_EXCLUDED.items()]
    broken += [(~found(F.col("_both"), pattern), f"no {name}") for name, pattern in R.TARGET_REQUIRED.items()]
    broken += [(~((F.coalesce(deadline, F.lit("")) != "") & (deadline >= as_of)), "not open")]
    df = postings.withColumn("_both", both).withColumn("target_reasons", R.reasons(*broken)).drop("_both")
    return df.withColumn("target", F.size("target_reasons") == 0)
