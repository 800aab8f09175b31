"""QA rules, statistics, samples, list verification, feeds, merges and the entry point."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from noticelake.functions import text
from noticelake.operators import attachments, candidates, classify, documents, elements, evidence, feed, listing, pages, publish, quality, reports, requirements
from noticelake.sources import fetch
from noticelake.streaming.history import merge_batches

ROOT = Path(__file__).resolve().parents[1]
JOB = "org string, title string, link string, deadline string, detail_text string, employment string, education string, location string, quality_score int, detail_ok boolean, vacancy_count int, vacancy_name string, original_title string, splitter_version string"
GOOD = ("기관", "행정 직원 채용", "https://a.kr/view.do?idx=1", "2026-07-01", "본문", "정규직", "고졸 가능", "울산", 95, True, 1, "", None, None)


def _job(**changes):
    names = [c.split()[0] for c in JOB.split(", ")]
    return tuple({**dict(zip(names, GOOD, strict=True)), **changes}.values())


@pytest.mark.parametrize(
    "changes,errors,warnings",
    [
        ({}, [], []),
        ({"deadline": ""}, [], ["마감일 미확인"]),
        ({"deadline": None}, [], ["마감일 미확인"]),
        ({"vacancy_count": 2}, ["다중 직군 이름 누락", "직군 분리 버전 누락"], []),
        ({"vacancy_count": 2, "vacancy_name": "행정", "splitter_version": "1"}, [], []),
        ({"link": ""}, ["원문 링크 누락"], []),
        ({"link": "ftp://a.kr/x"}, ["HTTP 원문 링크 아님"], []),
        ({"link": "https://a.kr/board/list"}, ["목록 또는 메인 링크"], []),
        ({"quality_score": 89, "detail_ok": None}, ["품질점수 미달", "상세 원문 미검증"], []),
    ],
)
def test_rules_of_validation(spark, changes, errors, warnings):
    row = quality.validate(spark.createDataFrame([_job(**changes)], JOB)).first()
    assert (row["errors"], row["warnings"], row["valid"]) == (errors, warnings, not errors)


def test_duplicates_are_of_original_title_and_vacancy(spark):
    rows = [_job(title="공고 행정", original_title="공고", vacancy_name="행정"), _job(title="공고 시설", original_title="공고", vacancy_name="시설"), _job(title="다른 제목", original_title="공고", vacancy_name="행정")]
    jobs = spark.createDataFrame(rows, JOB).withColumn("n", F.monotonically_increasing_id())
    assert [(r["title"], r["error"]) for r in quality.collection_issues(jobs, "n").collect()] == [("다른 제목", "중복 공고")]


def test_statistics_of_nothing_and_something(spark):
    jobs = spark.createDataFrame([(True, classify.HIGH_SCHOOL, True, classify.RECOMMENDED, 96), (False, "", None, classify.REVIEW, None)], "recommended boolean, education string, detail_ok boolean, status string, quality_score int")
    sources = spark.createDataFrame([(True, False, False), (False, True, True)], "ok boolean, degraded boolean, failed boolean")
    sources = sources.withColumns({c: F.lit(i) for i, c in enumerate(publish.COUNTERS)})
    issues = spark.createDataFrame([], "error string")
    row = publish.statistics(jobs, sources, issues).first()
    assert (row["total"], row["recommended"], row["quality_passed"], row["average_quality_score"], row["review_needed"]) == (2, 1, 1, 48, 1)
    assert (row["source_count"], row["success"], row["failed_sources"], row["vacancies_rejected"], row["qa_passed"]) == (2, 1, 1, 22, True)
    row = publish.statistics(jobs.limit(0), sources.limit(0), issues).first()
    assert (row["total"], row["average_quality_score"], row["source_count"], row["rejected"]) == (0, 0, 0, 0)


def test_samples_are_real_postings(spark):
    rows = [(1, "기관", "공고", "https://a.kr/1", "", "면허 필수", "우대 자격증"), (2, "기관", "공고 둘", "https://a.kr/1", "", "본문", ""), (3, "기관", "붙임.hwp", "", "", "본문", ""), (4, "기관", "빈 공고", "https://a.kr/4", "", "", None)]
    df = spark.createDataFrame(rows, "n int, org string, title string, link string, list_text string, detail_text string, document_text string")
    got = requirements.samples(requirements.with_requirements(df), "n")
    assert [(r["title"], r["from_document"], r["from_list"]) for r in got.collect()] == [("공고", True, False)]
    report = {r["category"]: r for r in requirements.category_report(got).collect()}
    assert (report["licenses"]["postings"], report["licenses"]["required"], report["licenses"]["preferred"], report["licenses"]["institutions"]) == (1, 1, 1, ["기관"])


def test_lists_are_verified(spark):
    records = spark.createDataFrame([(1, 0, "3 행정 채용 2026.01.02"), (1, 1, "2 시설 채용"), (2, 0, "행정 채용")], "page_id long, rec int, record string")
    shown = spark.createDataFrame([(1, 0, "시설 채용"), (1, 1, "행정 채용"), (2, 0, "다른 제목")], "page_id long, pos int, title string")
    templates = spark.createDataFrame([(1, "TABLE_RECORD"), (2, "ALIO_CARD"), (3, "TABLE_RECORD")], "page_id long, template string")
    got = {r["page_id"]: (r["verified"], r["level"], r["status"]) for r in listing.verify_listings(shown, records, templates).withColumn("status", listing.verified_status(listing.listing_status(F.col("record_count"), F.col("candidate_count")), F.col("verified"))).collect()}
    assert got == {1: (True, "TEMPLATE_TABLE_RECORD_EXACT", "verified-exact"), 2: (False, "TEMPLATE_RECORD_MISMATCH", "count-exact-unverified"), 3: (False, "TEMPLATE_RECORD_MISMATCH", "count-exact-unverified")}
    url, html = F.lit("https://job.alio.go.kr/x"), F.lit("{")
    assert spark.range(1).select(listing.verification_template(url, html, F.lit("o"))).first()[0] == "ALIO_CARD"
    assert spark.range(1).select(listing.verification_template(F.lit("u"), html, F.lit("o"), {"o": "API_CONTENT"})).first()[0] == "API_CONTENT"


def test_feed_is_written_in_order(spark, tmp_path):
    rows = [(f"기관{i}", f"제목{i}", f"https://a.kr/{i}", i % 3 == 0, i) for i in range(40)]
    jobs = spark.createDataFrame(rows, "org string, title string, link string, recommended boolean, quality_score int").repartition(5)
    fetch.write_feed(jobs, str(tmp_path / "feed"), 10)
    got = [r["quality_score"] for r in fetch.read_feed(spark, str(tmp_path / "feed")).collect()]
    assert got == [39, 36, 33, 30, 27, 24, 21, 18, 15, 12]
    assert fetch.read_feed(spark, str(tmp_path / "none")).count() == 0


def test_a_repeated_batch_writes_the_same(spark):
    schema = "org string, title string, deadline string, detail_ok boolean, fit_score int, link string"
    now = spark.createDataFrame([("o", "공고", "2026-07-01", True, 90, "old")], schema)
    batch = spark.createDataFrame([("o", "둘", "", True, 1, x) for x in "bca"] + [("o", "공고", "2026-07-01", True, 90, "new")], schema)
    written = []
    merge = merge_batches(lambda: now, lambda df, n: written.append(sorted(r["link"] for r in df.collect())))
    for parts in (1, 3):
        merge(batch.repartition(parts), 1)
    assert written[0] == written[1] and "old" in written[0] and len(written[0]) == 2


def test_small_operators(spark):
    docs = spark.createDataFrame([("pdf", "application/pdf", None), ("pdf", "x", "no text")], "detected_type string, content_type string, error string")
    assert {(r["by"], r["value"]): r["n"] for r in documents.result_counts(docs).collect()} == {("type", "pdf"): 2, ("content_type", "application/pdf"): 1, ("content_type", "x"): 1, ("error", "no text"): 1}
    told = lambda **k: spark.range(1).select(listing.row_reason(*[F.lit(k.get(n, d)) for n, d in (("title", "행정 채용"), ("action", True), ("date", True), ("number", True))])).first()[0]
    assert [told(title=""), told(title="abc"), told(action=False), told(date=False, number=False), told()] == ["TITLE_EMPTY", "TITLE_TOO_SHORT", "DETAIL_SIGNAL_MISSING", "ROW_SHAPE_NOT_RECOGNIZED", "UNMATCHED_BY_EXTRACTOR"]
    assert spark.range(1).select(listing.candidate_kind(F.lit("자주 묻는 질문"), F.lit(""))).first()[0] == "FAQ"
    recent = spark.range(1).select(feed.most_recent(F.array(F.lit("a"), F.lit("b")), F.lit("b"), 2)).first()[0]
    assert recent == ["b", "a"]
    institutions = spark.createDataFrame([("울산공단", [1, 3]), ("Port", [3])], "name string, months array<int>")
    assert feed.expected_institutions(institutions, 3).first()["expected"] == 2 and feed.find_institutions(institutions, "por").count() == 1
    linked = spark.createDataFrame([(1, "https://a.kr/", "<a href='/r'>Recruit</a><a href='https://b.kr/r'>careers</a><a href='/x'>about</a>")], "page_id long, url string, html string")
    assert [r["url"] for r in pages.listing_anchors(linked).collect()] == ["https://a.kr/r"]
    fetched = spark.createDataFrame([("text/html", "x" * 90), ("image/png", "x" * 90), (None, "short")], "content_type string, html string")
    assert fetch.usable_html(fetched).count() == 1
    assert fetch.without_retired(spark.createDataFrame([("a",), ("b",)], "org string"), spark.createDataFrame([("b",)], "org string")).count() == 1


@pytest.mark.parametrize(
    "make,value,want",
    [
        (text.slug, "울산 - 공단(주)", "울산_공단_주"),
        (text.slug, "", "unknown"),
        (text.slug, "\u110b\u116e\u11af", "울"),
        (text.safe_name, 'a/b:c d', "a_b_c_d"),
        (text.diagnostic_name, "Ａ１ (x)", "A1_x_"),
        (text.compact, "a\u0000b", "ab"),
        (fetch.search_url, "울산 공단", "https://job.alio.go.kr/mobile2021/recruit/recruit.do?order=REG_DATE&org_name=%EC%9A%B8%EC%82%B0+%EA%B3%B5%EB%8B%A8&search_yn=Y"),
        (attachments.alternate_address, "https://www.ubimc.or.kr/cop/cmm/fms/FileDown.do?a=1", "https://www.ubimc.or.kr/cmm/fms/FileDown.do?a=1"),
        (attachments.alternate_address, "https://o.kr/cop/cmm/fms/FileDown.do?a=1", None),
        (candidates.platform_url, "recruitView('303191')", "https://job.alio.go.kr/mobile2021/recruit/recruitView.do?idx=303191"),
        (candidates.platform_url, "location='/x/view.do?idx=12'", "/x/view.do?idx=12"),
        (candidates.platform_url, "idx: 45678", "https://job.alio.go.kr/mobile2021/recruit/recruitView.do?idx=45678"),
        (candidates.platform_url, "go()", ""),
        (listing.recruitment_title, "2026년 직원 채용 공고", True),
        (listing.recruitment_title, "직원 채용 합격자 안내", False),
        (listing.recruitment_title, None, False),
        (listing.recruit_detail_url, "https://a.kr/recruitView.do", True),
        (listing.recruit_detail_url, "https://a.kr/recruit/a.pdf", False),
    ],
)
def test_names_addresses_and_titles(one, make, value, want):
    assert one(make, value) == want


@pytest.mark.parametrize("block,link,want", [("<li>x</li>", "https://a.kr/view.do?idx=1", True), ("<tr><td>x</td></tr>", "", True), ("<li onclick='a()'>x</li>", "", True), ("<li>2026.01.02</li>", "", True), ("<li>조회수 3</li>", "", True), ("<li>menu</li>", "https://a.kr/", False)])
def test_records_of_boards(one, block, link, want):
    assert one(candidates.looks_like_record, block, link) == want


def test_platform_rows_without_links(spark):
    row = "<tr><td>1</td><td class='tit'>2026년 {0} 직원 채용 공고</td><td>2026.07.01</td><td onclick=\"recruitView('{1}')\">보기</td></tr>" + "x" * 950
    html = "<table>" + row.format("행정", 10001) + row.format("시설", 10002) + row.format("시설", 10002) + "<td onclick='goView(77777)'>번호</td></table>"
    df = spark.createDataFrame([(1, "o", html), (2, "o", None)], "page_id long, org string, html string")
    got = candidates.platform_candidates(df).orderBy("pos").collect()
    assert [(r["title"], r["link"][-5:]) for r in got] == [("2026년 행정 직원 채용 공고", "10001"), ("2026년 시설 직원 채용 공고", "10002")]


def test_links_by_profile(spark):
    links = spark.createDataFrame([("a", "https://www.a.kr/portal/post/view.do"), ("a", "https://b.kr/portal/post/view.do"), ("a", "https://a.kr/x?bcIdx=3"), ("b", "https://b.kr/read.do?idx=1"), ("b", "https://b.kr/")], "org string, link string")
    profiles = spark.createDataFrame([("a", ["a.kr"], r"/post/view\.do$", r"(?i)^(?:idx|bcIdx)$")], "org string, hosts array<string>, detail_path string, detail_param string")
    assert [r["is_detail"] for r in candidates.profiled_links(links, profiles).orderBy("org", F.desc("link")).collect()] == [True, False, True, True, False]


def test_enclosing_blocks(spark):
    long = "<div>" + "x" * 13_000 + "<tr>go(3)</tr></div>"
    pages = ["<ul><li class=a>one</li><li><a onclick='go(1)'>two</a></li></ul>", "no go(2) tags", long, "<div><li>go(4)</div>", None]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    got = [r["block"] for r in elements.occurrences(df, ["page_id"], r"go\(\d\)").orderBy("page_id").collect()]
    assert got == ["<li><a onclick='go(1)'>two</a></li>", "no go(2) tags", "<tr>go(3)</tr>", "<div><li>go(4)</div>"]
    assert elements.Page("<div>" + "x" * 13_000 + "go(1)</div>").block(13_005) == "x" * 1200 + "go(1)</div>"


def test_elements_take_time_in_proportion(spark):
    """10,000 links, as many that never end, and blocks: each page is one pass."""
    import time

    link = "<li><a href='/view.do?idx={0}' onclick=\"go({0})\">공고 {0}</a> <img src='/f/{0}.png'> " + "글" * 90 + "</li>"
    whole = "<script>function go(n){location.href='/down.do?file='+n;}</script>" + "".join(link.replace("{0}", str(i)) for i in range(10_000))
    assert len(whole) > 1_500_000
    start = time.time()
    page = elements.Page(whole)
    found = list(page.elements())
    assert [x[:2] for x in found[:2]] == [(0, 0), (1, 0)] and len(found) == 20_000
    assert page.block(found[-2][2]).startswith("<li><a href='/view.do?idx=9999'")
    assert not list(elements.Page("<a href='x'>" * 20_000 + "<a " * 20_000).elements())
    assert time.time() - start < 4


def test_gateways_give_their_best_file(spark):
    page = '<html><a href="/f/1.hwp">응시원서.hwp</a><a href="/f/2.pdf">채용공고.pdf</a><a href="/fileList?x=1">첨부 download</a></html>'.encode()
    rows = [(1, "https://o.kr/fileList?x=1", bytearray(page), "text/html"), (2, "https://o.kr/board/list.do", bytearray(page), "text/html"), (3, "https://o.kr/attach/3", bytearray(b"%PDF-1"), "application/pdf"), (4, "https://o.kr/attach/4", bytearray(b"<html></html>"), None)]
    got = attachments.through_gateways(spark.createDataFrame(rows, "file_id long, url string, content binary, content_type string")).collect()
    assert [(r["file_id"], r["url"], r["type"]) for r in got] == [(1, "https://o.kr/f/2.pdf", "pdf")]


def test_evidence_is_of_sources_that_are_not_healthy(spark):
    report = spark.createDataFrame([("a", "healthy"), ("울산 공단", "failed"), ("c", "degraded")], "org string, health string")
    fetched = spark.createDataFrame([("a", "u", "x"), ("울산 공단", "u", "<li>채용</li><script>location.href='/view'</script>" + "<li>채용 2</li>" * 30)], "org string, url string, html string").withColumns({"status": F.lit(200), "content_type": F.lit(None).cast("string")})
    got = {r["org"]: r for r in evidence.unhealthy_evidence(report, evidence.page_artifacts(fetched)).collect()}
    assert set(got) == {"울산 공단", "c"} and got["울산 공단"]["folder"] == "울산_공단" and got["c"]["snippets"] is None
    assert len(got["울산 공단"]["snippets"]) == 3 and got["울산 공단"]["scripts"] == ["location.href='/view'"]


def test_merged_stages(spark):
    probe = spark.createDataFrame([("a", True, True, True, True, False, False, False), ("b", True, True, True, True, None, None, True), ("c", True, True, True, True, True, True, False)], "org string, access boolean, list boolean, detail boolean, discovery boolean, download boolean, analysis boolean, nothing_to_read boolean")
    counts = spark.createDataFrame([("a", 3, 2, 2, 2)], "org string, downloads_attempted long, attachments_downloaded long, documents_attempted long, documents_parsed long")
    got = {r["org"]: (r["download"]["status"], r["download"]["mode"], r["analysis"]["ok"], r["bottleneck"]) for r in reports.merge_stages(probe, counts).collect()}
    assert got == {"a": ("partial", "collector", True, "첨부 다운로드"), "b": ("not-required", "not-required", True, "전체 파이프라인 통과 · 첨부/문서분석 대상 없음"), "c": ("success", "probe", True, "전체 파이프라인 통과")}


def test_reports_are_read(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"sources": [{"org": "a", "health": "failed", "list": {"ok": true, "status": "verified-empty"}}]}')
    row = fetch.read_report(spark, str(tmp_path / "r.json")).first()
    assert (row["org"], row["list"]["ok"], row["access"]) == ("a", True, None) and fetch.read_report(spark, str(tmp_path / "no.json")).count() == 0


def test_entry_without_the_subpackage_and_with_a_broken_one(tmp_path):
    code = "import sys; sys.path.insert(0, {0!r}); import __spark_entry__ as e; print(sum(q.startswith('op') for q in e.queries()), len(e.queries()) > 50)"
    bare = tmp_path / "bare"
    (bare / "noticelake").mkdir(parents=True)
    (bare / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    for f in (ROOT / "noticelake").iterdir():
        if f.name not in ("llm", "__pycache__"):
            (bare / "noticelake" / f.name).symlink_to(f)
    run = lambda d: subprocess.run([sys.executable, "-c", code.format(str(d))], capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONDONTWRITEBYTECODE": "1"}, cwd=tmp_path)
    assert run(bare).stdout.split() == ["0", "True"]
    (bare / "noticelake" / "llm").mkdir()
    (bare / "noticelake" / "llm" / "__init__.py").write_text("")
    (bare / "noticelake" / "llm" / "queries.py").write_text("import no_such_module")
    (bare / "corpus_pipeline.py").write_text("run = ORACLE_SQL = None")
    assert "no_such_module" in run(bare).stderr
