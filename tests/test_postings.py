"""Classification, quality, vacancies, requirements: the behaviour that the rule sets promise."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from noticelake.operators import classify, listing, quality, requirements, vacancies

GOOD = "채용분야: 행정사무\n채용형태: 정규직\n학력무관\n근무지: 울산광역시 남구\n접수기간: 2026.08.01 ~ 2026.08.20\n채용인원: 3명\n응시자격: 누구나\n전형절차: 서류"


def analysed(spark, *rows):
    df = spark.createDataFrame([(t, "", d, o, True) for t, d, o in rows], "title string, list_text string, detail_text string, document_text string, detail_ok boolean")
    return classify.analyze(df)


def test_a_clear_posting_is_recommended_scored_and_valid(spark):
    df = analysed(spark, ("행정사무 직원 채용 공고", GOOD, "")).withColumns({"org": F.lit("o"), "deadline": F.lit("2026-08-20"), "link": F.lit("https://example.com/board/view.do?nttId=1"), "documents_read": F.lit(0)})
    row = quality.validate(quality.score_quality(df)).first()
    assert row["recommended"] and row["fit_score"] == 100 and row["status"] == "지원 추천"
    assert row["quality_passed"] and row["quality_score"] >= 90 and row["valid"], row["errors"]


def test_documents_that_contradict_the_page_exclude(spark):
    document = "고용형태 기간제 근로자, 학사 이상, 근무지 서울. 이 문서는 첨부된 공고문 본문이며 충분히 깁니다."
    row = analysed(spark, ("직원 채용 공고", GOOD, document)).first()
    assert row["excluded"] and row["cross"]["conflict"] and len(row["cross"]["reasons"]) == 3


@pytest.mark.parametrize("text,excluded", [("정규직 기존 기간제 근무경력 인정", False), ("채용형태: 기간제 근로자", True), ("무기계약직", True), ("체험형 인턴", True)])
def test_mentions_of_temporary_work(one, text, excluded):
    assert one(classify.has_excluded_employment, text) == excluded


@pytest.mark.parametrize(
    "text,kind",
    [("기간의 정함이 없는 근로계약 공무직", "무기계약직"), ("무기계약직", "제외 고용형태"), ("공무직 정규직", "공무직"), ("일반직 정규직", "일반직"), ("정규직", "정규직"), ("비정규직", "제외 고용형태"), ("없음", "고용형태 확인 필요")],
)
def test_employment_ladder(one, text, kind):
    assert one(classify.employment, text) == kind


@pytest.mark.parametrize(
    "text,place",
    [("근무지: 울산 남구", "울산"), ("근무지: 울산, 부산", "울산 외 또는 복수지역"), ("서울 본사\n울산 울주군", "울산"), ("서울", "근무지 확인 필요"), ("전국 근무 울산", "근무지 확인 필요")],
)
def test_location(one, text, place):
    assert one(classify.location, text) == place


def test_degree_beats_high_school(one):
    assert one(classify.education, "고졸 또는 학사 이상") == classify.DEGREE


def test_postings_split_by_headings(spark):
    block = "채용분야: {0}\n채용형태: {1}\n학력무관\n근무지: {2}\n채용인원: 2명 모집합니다 여러분의 지원을 기다립니다"
    detail = "\n".join([block.format("행정사무", "정규직", "울산"), block.format("시설관리", "기간제 근로자", "울산"), block.format("전산", "정규직", "서울")])
    df = spark.createDataFrame([("직원 채용 공고", "", detail, "", True), ("직원 채용 공고", "", GOOD, "", True)], "title string, list_text string, detail_text string, document_text string, detail_ok boolean")
    rows = vacancies.analyze_vacancies(df).collect()
    split = [r for r in rows if r["vacancy_count"] == 3]
    assert [r["vacancy"]["name"] for r in split] == ["행정사무", "시설관리", "전산"]
    assert [r["recommended"] for r in split] == [True, False, False]
    assert len(rows) == 4 and [r["vacancy"]["source"] for r in rows if r["vacancy_count"] == 1] == ["single"]


def test_requirement_levels_and_eligibility(spark):
    text = "응시자격: 전기기사 자격증 필수\n컴퓨터활용능력 우대\n경력 2년 이상\n학력 무관\n근무지: 울산\n정규직"
    df = requirements.with_requirements(spark.createDataFrame([("t", "", "", text)], "title string, list_text string, detail_text string, document_text string"))
    r = df.first()["requirements"]
    assert [x["level"] for x in r["licenses"]] == ["required", "preferred"]
    assert r["experience"][0]["level"] == "required" and r["education"]["values"] == ["학력무관"]
    assert r["location"]["values"] == ["울산"] and r["employment"]["values"] == ["정규직"]
    schema = "education string, licenses array<string>, experience_known boolean, major_known boolean"
    status = lambda licenses: requirements.eligibility(df, spark.createDataFrame([("고졸", licenses, True, True)], schema)).first()["support_status"]
    assert status(None) == "needs-review" and status([]) == "ineligible" and status(["전기기사"]) == "eligible-or-no-hard-conflict"


def test_selection_keeps_every_row(spark):
    titles = ["정규직 직원 채용 공고", "짧음", None, "최종합격자 명단 안내 공고", "간호사 직원 채용 공고"]
    got = listing.select_candidates(spark.createDataFrame([(t, "") for t in titles], "title string, list_text string")).collect()
    assert [r["accepted"] for r in got] == [True, False, False, False, False]
    assert "전문면허 직무가 제목에 명시됨" in got[4]["reasons"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("정규직고졸학사울산서울: \n1가", max_size=60), min_size=1, max_size=8))
def test_scores_stay_in_bounds(spark, texts):
    rows = analysed(spark, *[("채용 공고", t, "") for t in texts]).select("fit_score", "excluded", "recommended").collect()
    assert all(0 <= r["fit_score"] <= 100 and not (r["excluded"] and r["recommended"]) for r in rows)
