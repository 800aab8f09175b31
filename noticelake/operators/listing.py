"""Listing operators: candidate selection, first-wins dedup, exactness, differences and record matching."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions import rules as R
from noticelake.functions.text import board_key, squash, title_key
from noticelake.functions.urls import canonical_url


def valid_title(title: Column) -> Column:
    gate = F.length(title).between(6, 220) & title.rlike(R.RECRUITMENT) & ~title.rlike(R.STAGE_NOISE + r"|채용절차|전형일정")
    return F.coalesce(gate & ~R.any_of(title, [*R.NON_JOB, *R.EXCLUDED_EMPLOYMENT, *R.LICENSE_JOB]), F.lit(False))


def recruitment_title(title: Column) -> Column:
    """The older title gate: 7 to 180 characters, a sign of recruitment and none of other notices."""
    return F.coalesce(F.length(title).between(7, 180) & ~R.any_of(title, R.LEGACY_EXCLUDE) & R.any_of(title, R.LEGACY_RECRUITMENT), F.lit(False))


def recruit_detail_url(url: Column) -> Column:
    return url.rlike("(?i)recruit") & ~url.rlike("(?i)" + R.fused(R.FILE_URL))


def detail_failures(reason_counts: DataFrame) -> DataFrame:
    """For each source the rejections (org, reason, n) whose reason is a failed detail page."""
    return reason_counts.groupBy("org").agg(F.sum(F.when(F.col("reason").rlike(R.DETAIL_FAILURE), F.col("n")).otherwise(0)).alias("detail_failures"))


def select_candidates(candidates: DataFrame) -> DataFrame:
    """Adds reasons, signals and accepted (no reasons); rejected rows stay, so accepted and rejected make up the input."""
    title, text = squash(F.coalesce("title", F.lit(""))), squash(F.coalesce("list_text", F.lit("")))
    df = candidates.withColumns({"_title": title, "_all": F.trim(F.concat_ws(" ", title, text))})
    t, both = F.col("_title"), F.col("_all")
    found = R.reasons(
        (F.length(t) < 6, "제목이 없거나 너무 짧음"),
        (F.length(t) > 220, "제목이 비정상적으로 김"),
        ((t != "") & ~t.rlike(R.RECRUITMENT), "채용공고 제목 신호 없음"),
        (t.rlike(R.STAGE_NOISE), "채용 전형·결과 안내"),
        (R.any_of(t, R.NON_JOB), "채용공고가 아닌 공지·안내"),
        (R.any_of(t, R.EXCLUDED_EMPLOYMENT), "인턴·계약직 등 제외 고용형태가 제목에 명시됨"),
        (R.any_of(t, R.LICENSE_JOB), "전문면허 직무가 제목에 명시됨"),
        (both.rlike(R.CLOSED_LISTING), "목록에 마감 문구가 명시됨"),
    )
    signals = R.reasons(
        (R.any_of(both, R.ALLOWED_EMPLOYMENT), "대상 고용형태 신호"),
        (both.rlike(r"고졸|고등학교\s*졸업|학력\s*무관|학력\s*(?:제한|제한사항)\s*(?:없음|없)|학력제한\s*없"), "고졸 가능 신호"),
        (both.rlike(r"울산(?:광역시)?|울주군|새울"), "울산 근무 신호"),
        (t.rlike(r"채용|모집"), "채용 제목 신호"),
    )
    return df.withColumns({"reasons": found, "signals": signals, "accepted": F.size(found) == 0}).drop("_title", "_all")


def reason_counts(selected: DataFrame) -> DataFrame:
    return selected.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def first_of_each(candidates: DataFrame, order: str) -> DataFrame:
    """The first candidate, by ``order``, of each organisation, title key and canonical link.

    The row comes from a struct's minimum, which combines before the shuffle: a key that a third of all rows
    share still sends one row from each task.
    """
    keyed = candidates.withColumns({"title_key": title_key(F.coalesce("title", F.lit(""))), "link_key": canonical_url(F.coalesce("link", F.lit("")))})
    rest = [c for c in candidates.columns if c != order]
    best = keyed.groupBy(F.col("org").alias("_org"), "title_key", "link_key").agg(F.min(F.struct(order, *rest)).alias("r"))
    return best.select("r.*", "title_key", "link_key")


def listing_status(visible: Column, candidates: Column) -> Column:
    """exact, failed or partial against a visible count; without one, count-unavailable or an empty page."""
    return F.when(visible.isNotNull(), F.when(visible == candidates, "exact").when(candidates == 0, "failed").otherwise("partial")).otherwise(F.when(candidates == 0, "empty-or-wrong-page").otherwise("count-unavailable"))


def verified_status(status: Column, verified: Column) -> Column:
    """exact is told apart by whether the records prove it."""
    return F.when(status == "exact", F.when(verified, "verified-exact").otherwise("count-exact-unverified")).otherwise(status)


def counter_reason(visible: Column, rows: Column, unique: Column, candidates: Column) -> Column:
    return (
        F.when(visible.isNull() & (rows == 0) & (candidates > 0), "DOM_COUNT_ZERO")
        .when(visible.isNull() & (rows > 0), "COUNTER_SELECTOR_MISMATCH")
        .when(visible.isNull() & (candidates > 0), "COUNTER_ONLY")
        .when((unique == candidates) & (visible != candidates), "RAW_ROW_DUPLICATE_COUNT")
        .when((candidates == 0) & (rows > 0), "EXTRACTOR_REJECTED_ROWS")
        .when(visible.isNotNull() & (candidates < unique), "MISSING_UNIQUE_POSTS")
        .when(visible.isNotNull() & (candidates > unique), "EXTRA_NON_ROW_CANDIDATES")
        .otherwise("UNKNOWN")
    )


def row_reason(title: Column, has_action: Column, has_date: Column, has_sequence: Column) -> Column:
    return (
        F.when(title == "", "TITLE_EMPTY")
        .when(F.length(title) < 4, "TITLE_TOO_SHORT")
        .when(F.length(title) > 260, "TITLE_TOO_LONG")
        .when(title.rlike(r"^(?:홈|메인|목록|이전|다음|처음|마지막|더보기|바로가기)$"), "NAVIGATION_TITLE")
        .when(~has_action, "DETAIL_SIGNAL_MISSING")
        .when(~has_date & ~has_sequence, "ROW_SHAPE_NOT_RECOGNIZED")
        .otherwise("UNMATCHED_BY_EXTRACTOR")
    )


def candidate_kind(title: Column, link: Column) -> Column:
    return (
        F.when(title.rlike(r"FAQ|자주 묻는|질문"), "FAQ")
        .when(title.rlike(r"IR|투자정보|경영공시|회사소개|조직도|오시는길"), "MENU_OR_IR")
        .when(title.rlike(r"공지|합격자|면접|서류|필기|채용|모집|인턴|직원|근로자"), "RECRUIT_POST")
        .when(link.rlike(r"(?i)download|file|첨부"), "ATTACHMENT")
        .otherwise("UNCLASSIFIED")
    )


def unmatched(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond what the others match, as bags: a key twice here and once there is over once."""
    return rows.select(*keys).exceptAll(others.select(*keys))


def verify_listings(candidates: DataFrame, records: DataFrame, templates: DataFrame) -> DataFrame:
    """page_id, template, record_count, candidate_count, matched_count, verified and level of each page of templates (page_id, template).

    A list is proved if it has candidates, as many as visible records, and each is of a record of its own (see match_records).
    """
    matched = match_records(candidates, records).groupBy("page_id").agg(F.count(F.lit(1)).alias("candidate_count"), F.count("rec").alias("matched_count"))
    shown = records.groupBy("page_id").agg(F.count(F.lit(1)).alias("record_count"))
    df = templates.join(matched, "page_id", "left").join(shown, "page_id", "left").fillna(0, ["candidate_count", "matched_count", "record_count"])
    verified = (F.col("candidate_count") > 0) & (F.col("candidate_count") == F.col("record_count")) & (F.col("matched_count") == F.col("record_count"))
    level = F.when(verified, F.concat(F.lit("TEMPLATE_"), "template", F.lit("_EXACT"))).otherwise("TEMPLATE_RECORD_MISMATCH")
    return df.select("page_id", "template", "record_count", "candidate_count", "matched_count", verified.alias("verified"), level.alias("level"))


def verification_template(url: Column, html: Column, org: Column, adapters: dict[str, str] | None = None) -> Column:
    """Which visible records prove a list: the cards of the shared platform, what an adapter says of the organisation, data, else table rows."""
    out = F.when(url.rlike(r"(?i)job\.alio\.go\.kr"), "ALIO_CARD")
    for name, template in (adapters or {}).items():
        out = out.when((org == name) & (html.rlike(r"^\s*\{") if template == "API_CONTENT" else F.lit(True)), template)
    return out.otherwise("TABLE_RECORD")


def missing_counts(rows: DataFrame, found: Column, keys: list[str]) -> DataFrame:
    """How many rows of each key are beyond those that are found, where rows says itself which are: one aggregate, no second reading."""
    counts = rows.groupBy(*keys).agg((F.count(F.lit(1)) - F.count_if(found)).alias("missing"))
    return counts.where("missing > 0")


def match_records(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """Greedy one-to-one match of each page's candidate titles to its visible records, in candidate order.

    candidates: page_id, pos, title; records: page_id, rec, record. A title takes the first free record that
    contains it or is contained in it. The result depends on the order, so a page is matched by itself; a page
    shows a bounded number of records. Returns page_id, pos, title and rec (null: no match).
    """

    def match(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        free = list(right.sort_values("rec")[["rec", "key"]].itertuples(index=False, name=None))
        out = []
        for page, pos, title, key in left.sort_values("pos")[["page_id", "pos", "title", "key"]].itertuples(index=False, name=None):
            hit = next((r for r in free if key and (r[1] in key or key in r[1])), None)
            if hit:
                free.remove(hit)
            out.append((page, pos, title, hit[0] if hit else None))
        got = pd.DataFrame(out, columns=["page_id", "pos", "title", "rec"])
        return got.astype({"rec": "Int64"})

    left, right = candidates.withColumn("key", board_key(F.col("title"))), records.withColumn("key", board_key(F.col("record")))
    return left.groupBy("page_id").cogroup(right.groupBy("page_id")).applyInPandas(match, "page_id long, pos int, title string, rec int")
