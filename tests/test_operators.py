"""Listings, pages, files, publishing, reports, feed, sources and streams."""

import datetime
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from noticelake.operators import attachments, documents, elements, feed, listing, pages, publish, reports
from noticelake.sources import fetch
from noticelake.streaming import history


def test_first_of_each_is_idempotent(spark):
    rows = spark.createDataFrame([(1, "a", "직원 채용 공고", "https://a.kr/v?nttId=1&page=1"), (2, "a", "직원  채용 공고!", "https://a.kr/v?nttId=1&page=2"), (3, "b", "직원 채용 공고", None)], "pos int, org string, title string, link string")
    once = listing.first_of_each(rows, "pos").select("pos", "org", "title", "link")
    assert sorted(r["pos"] for r in once.collect()) == [1, 3]
    assert sorted(r["pos"] for r in listing.first_of_each(once, "pos").collect()) == [1, 3]


def test_records_match_greedily_and_once(spark):
    titles = spark.createDataFrame([(1, 0, "채용 공고"), (1, 1, "채용 공고"), (1, 2, "다른 글")], "page_id long, pos int, title string")
    records = spark.createDataFrame([(1, 0, "채용 공고 2026"), (1, 1, "[마감] 채용 공고")], "page_id long, rec int, record string")
    got = {r["pos"]: r["rec"] for r in listing.match_records(titles, records).collect()}
    assert got == {0: 0, 1: 1, 2: None}


def test_bag_difference(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert [r["k"] for r in listing.unmatched(rows, rows.limit(0).union(spark.createDataFrame([("a",)], "k string")), ["k"]).orderBy("k").collect()] == ["a", "b"]


def test_board_types_and_verification(spark):
    html = {"iframe": "<iframe src=x>", "table": "<table><tr><td>", "list": "<ul><li>", "json": ' {"a": 1}', "none": "text"}
    df = spark.createDataFrame([(k, v) for k, v in html.items()], "k string, html string")
    got = {r["k"]: r["b"]["type"] for r in df.select("k", pages.board_type(F.col("html"), F.lit(""), F.lit("")).alias("b")).collect()}
    assert got == {"iframe": "IFRAME", "table": "HTML_TABLE", "list": "UL_LIST", "json": "API", "none": "UNKNOWN"}
    page = "<html><title>채용 공고</title><table><tbody><tr><td>번호 제목 " + "내용 " * 80 + "</table></html>"
    df = spark.createDataFrame([(1, "https://a.kr/board", page, 200), (2, "https://a.kr/x", page, 500), (3, "https://a.kr/y", None, 200)], "page_id long, url string, html string, status int")
    rows = pages.verify_pages(df.withColumns({"content_type": F.lit("text/html"), "org": F.lit("기관")})).collect()
    assert [r["code"] for r in rows] == ["RECRUIT_VERIFY_OK", "RECRUIT_VERIFY_ERROR_PAGE", "RECRUIT_VERIFY_ERROR_PAGE"]


def test_detail_body_prefers_the_title(spark):
    a, b = "<article>" + "가나다 " * 40 + "</article>", "<article>" + "시설관리 모집 " * 20 + "</article>"
    df = spark.createDataFrame([(a + b,), ("<p>short</p>",)], "html string")
    got = [r["t"] for r in df.select(pages.detail_body(F.col("html"), F.lit("시설관리 직원 채용")).alias("t")).collect()]
    assert got[0].startswith("시설관리") and got[1] == "short"


@pytest.mark.parametrize(
    "html,urls",
    [
        ('<a href="/a.pdf">공고문.pdf</a><a href="#x">첨부</a>', ["https://o.kr/a.pdf"]),
        ('<a data-url="/d/1.hwp">원서</a>', ["https://o.kr/d/1.hwp"]),
        ("<a href='#' onclick=\"window.open('/file/download.do?fileId=3')\">첨부파일</a>", ["https://o.kr/file/download.do?fileId=3"]),
        ("<a onclick=\"fn_egov_downFile('FILE_0001','2')\">첨부</a>", ["https://o.kr/cmm/fms/FileDown.do?atchFileId=FILE_0001&fileSn=2"]),
        ("<script>function down(a){location.href='/fileDown.do?fileId='+a;}</script><a onclick=\"down('77')\">다운로드</a>", ["https://o.kr/fileDown.do?fileId=77"]),
        ('<form action="/file/download.do" method="post"><input name="fileId" value="9"></form>', ["https://o.kr/file/download.do"]),
        ('<form action="/board/list.do"><input name="fileSeq" value="9"></form><img src="/images/logo/x.png" alt="로고">', []),
    ],
)
def test_attachments(spark, html, urls):
    df = spark.createDataFrame([(1, "https://o.kr/bbs/view.do", html)], "page_id long, url string, html string")
    assert [r["url"] for r in attachments.extract_attachments(df).orderBy("pos").collect()] == urls


def test_attachments_as_rows(spark):
    df = spark.createDataFrame([(1, "https://o.kr/", '<a href="/a.pdf">공고.pdf</a><a href="/a.pdf#p">공고.pdf</a>'), (2, None, None)], "page_id long, url string, html string")
    rows = attachments.extract_attachments(df).collect()
    assert [(r["page_id"], r["type"]) for r in rows] == [(1, "pdf")]
    many = "".join(f'<img src="/f/{i}.png" alt="첨부 {i}">' for i in range(30)) + '<a href="/z.hwp">원서</a>' + "x" * 500
    rows = attachments.extract_attachments(spark.createDataFrame([(1, "https://o.kr/", many)], "page_id long, url string, html string")).orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(24)) and rows[0]["url"] == "https://o.kr/z.hwp" and rows[1]["name"] == "첨부 0"


def test_element_surroundings(spark):
    page = "a" * 600 + "<a href='/x'>l</a>" + "b" * 600
    row = elements.elements(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string"), "page_id").first()
    assert row["around"] == "a" * 450 + "<a href='/x'>l</a>" + "b" * 450
    row = elements.elements(spark.createDataFrame([(1, "u", "<a href='/x'>l</a>" + "b" * 600)], "page_id long, url string, html string"), "page_id").first()
    assert row["around"] == "<a href='/x'>l</a>" + "b" * 450


def _zip(**entries):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in entries.items():
            z.writestr(name.replace("__", "/").replace("_xml", ".xml"), body)
    return out.getvalue()


def test_documents(spark):
    docx = _zip(word__document_xml="<w:p>채용 공고문</w:p>")
    rows = [(1, docx, "", "a.bin"), (2, b"%PDF-1.4", "", ""), (3, b"PK\x03\x04bad", "", "x.xlsx"), (4, b"<html>", "text/html", ""), (5, None, "", "")]
    df = spark.createDataFrame(rows, "id int, content binary, content_type string, url string").withColumns({"disposition": F.lit(""), "hinted_type": F.lit("")})
    got = {r["id"]: (r["detected_type"], r["text"], r["error"]) for r in documents.read_documents(df).collect()}
    assert got[1] == ("docx", "채용 공고문", None)
    assert got[2] == ("pdf", "", "unavailable: pdf") and got[3] == ("xlsx", "", "no text")
    assert got[4][0] == "html" and got[5][0] == "unsupported" and got[5][2] == "empty or too large"


def test_file_choice(spark):
    rows = [(1, 0, "사진.png", "png", "u1"), (1, 1, "채용공고.pdf", "pdf", "u2"), (1, 2, "지원서.hwp", "hwp", "u3"), (2, 0, "사진.png", "png", "u4")]
    df = spark.createDataFrame(rows, "id int, pos int, name string, type string, url string")
    got = [(r["id"], r["name"]) for r in documents.choose_files(df, "id").orderBy("id", "rank").collect()]
    assert got == [(1, "채용공고.pdf"), (1, "지원서.hwp"), (2, "사진.png")]


def test_decode_bytes(spark):
    df = spark.createDataFrame([("한글".encode("cp949"), "text/html; charset=euc-kr"), ("한글".encode(), None)], "b binary, t string")
    assert [r["x"] for r in df.select(documents.decode_bytes("b", "t").alias("x")).collect()] == ["한글", "한글"]


def test_preferred_job_and_retention(spark):
    schema = "pos int, org string, title string, deadline string, detail_ok boolean, fit_score int"
    jobs = spark.createDataFrame([(1, "a", "채용 공고", "2026-08-01", True, 90), (2, "a", "[재공고] 채용 공고", "2026-07-01", False, 10), (3, "b", "채용", "", True, 1), (4, "b", "채용", "", True, 1)], schema)
    assert sorted(r["pos"] for r in publish.preferred_jobs(jobs, "pos").collect()) == [2, 3]
    as_of = F.to_timestamp(F.lit("2026-07-15T00:00:00Z"))
    kept = publish.retain(jobs.where("pos = 1"), jobs, spark.createDataFrame([("b",)], "org string"), as_of)
    assert sorted((r["pos"], r["retained"]) for r in kept.collect()) == [(1, False), (3, True), (4, True)]


def test_breakers(spark):
    jobs, none = spark.range(10).withColumnRenamed("id", "x"), spark.range(0)
    results = spark.createDataFrame([(True,), (False,)], "ok boolean")
    assert publish.breaker_metrics(results, none, jobs).first()["collapsed"]
    with pytest.raises(RuntimeError):
        publish.guard(jobs, publish.breaker_metrics(results, none, jobs))
    assert publish.guard(jobs, publish.breaker_metrics(results, jobs, jobs)).count() == 10


STAGE_ROW = "org string, access boolean, list boolean, detail boolean, discovery boolean, download boolean, analysis boolean"


def test_health_and_diff(spark):
    df = spark.createDataFrame([("a", True, True, True, True, True, True), ("b", True, False, True, True, True, True), ("c", True, True, True, True, None, None), ("d", False, True, True, True, True, True)], STAGE_ROW)
    assert [r["h"] for r in df.select(reports.health().alias("h")).collect()] == ["healthy", "degraded", "healthy", "failed"]
    assert {r["change"] for r in reports.snapshot_diff(df, df).collect()} == {"same"}
    changes = {r["change"] for r in reports.snapshot_diff(df.where("org = 'a'"), df.where("org = 'b'"), removed=True).collect()}
    assert changes == {"new", "removed"}


def test_history_keeps_twenty(spark):
    runs = spark.range(60).select((F.col("id") % 2).alias("org"), F.col("id").alias("at"))
    got = reports.bounded_history(runs, "org", "at", "at").groupBy("org").agg(F.count("*").alias("n"), F.min("at").alias("first")).collect()
    assert sorted((r["org"], r["n"], r["first"]) for r in got) == [(0, 20, 20), (1, 20, 21)]


def test_feed(spark):
    rows = [("a", "울산 정규직", "", "고졸 가능", "정규직", "2026-07-02", "2026-06-01"), ("b", "서울", "", "학력 확인 필요", "공무직", "", "2026-06-02")]
    jobs = feed.flags(spark.createDataFrame(rows, "org string, title string, raw string, education string, employment string, deadline string, collected_at string"), F.lit(datetime.date(2026, 6, 30)))
    assert [r["rank"] for r in feed.feed_query(jobs).collect()] == [98, 20]
    state = spark.createDataFrame([("seen", "a|울산 정규직"), ("favorite", "b|서울"), ("watched", "b")], "kind string, value string")
    only = lambda **k: [r["org"] for r in feed.feed_query(jobs, state, **k).collect()]
    assert only(only="new") == ["b"] and only(only="watched") == ["b"] and only(only="closing") == ["a"] and only(q="서울") == ["b"] and only(mode="newest") == ["b", "a"]
    assert [r["org"] for r in feed.favorites(jobs, state).collect()] == ["b"]


def test_fetching_is_a_table_of_attempts(spark):
    templates = spark.createDataFrame([("html", "HTML", ["fetch", "curl"])], fetch.TEMPLATE)
    sources = spark.createDataFrame([("a", "https://a.kr/", "html", ["https://a.kr/1", "https://a.kr/1"], None), ("b", "", "none", None, None)], fetch.SOURCE)
    assert sorted(r["reason"] for r in fetch.violations(sources, templates).collect()) == ["no address"]
    plan = fetch.access_plan(sources.where("org = 'a'"), templates)
    assert [r["url"] for r in plan.orderBy("priority").collect()] == ["https://a.kr/1", "https://a.kr/"]

    def get(url, transport):
        if transport == "fetch":
            raise TimeoutError("timeout")
        return 200, "text/html", "<html>" + "x" * 100

    got = fetch.fetch_pages(plan, get).where("priority = 0").orderBy("attempt").collect()
    assert [(r["transport"], r["ok"]) for r in got] == [("fetch", False), ("fetch", False), ("curl", True)]


def test_feed_round_trip(spark, tmp_path):
    jobs = spark.createDataFrame([("a", "t")], "org string, title string")
    fetch.write_feed(jobs, str(tmp_path / "feed"))
    assert fetch.read_feed(spark, str(tmp_path / "feed")).first()["org"] == "a"
    assert fetch.read_feed(spark, str(tmp_path / "none")).count() == 0


def test_history_stream(spark, tmp_path):
    start = datetime.datetime(2026, 1, 1)
    rows = [("a", start + datetime.timedelta(days=i), "healthy" if i % 2 else "failed") for i in range(25)] * 2
    spark.createDataFrame(rows, "org string, at timestamp, health string").write.parquet(str(tmp_path / "runs"))
    stream = spark.readStream.schema("org string, at timestamp, health string").parquet(str(tmp_path / "runs"))
    q = history.history_stream(stream).writeStream.format("memory").queryName("history").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    row = spark.sql("SELECT * FROM history ORDER BY latest DESC").first()
    assert row["runs"] == 20 and row["healthy"] == 10


def test_candidates_by_tier(spark):
    from noticelake.operators import candidates

    table = "<table><tr><td>{0}</td><td><a href='#' onclick=\"postView({0})\">직원 채용 공고 {0}</a></td><td>2026.01.02</td></tr></table><a href='/view.do?nttId=9'>다른 글 목록</a>"
    rows = [
        (1, "a", "https://a.kr/list.do", table.format(14905) + table.format(14905)),
        (2, "b", "https://b.kr/list.do", "<a href='/board/view.do?nttId=5&amp;x=1'>직원 모집</a><a href='/board/view.do?nttId=5&x=1'>직원 모집</a><a href='/f.pdf'>공고문 파일</a>"),
        (3, "b", "https://b.kr/", "<li data-url='/read.do?no=7' class='x'>경력 채용</li>"),
        (4, "a", "https://a.kr/", None),
    ]
    pages_ = spark.createDataFrame(rows, "page_id long, org string, url string, html string")
    adapters = spark.createDataFrame([("a", "/view.do?nttId={id}")], "org string, template string")
    got = {(r["page_id"], r["tier"], r["title"], r["link"]) for r in candidates.candidates(pages_, adapters).collect()}
    assert got == {
        (1, "row", "직원 채용 공고 14905", "https://a.kr/view.do?nttId=14905"),
        (2, "anchor", "직원 모집", "https://b.kr/board/view.do?nttId=5&x=1"),
        (3, "block", "경력 채용", "https://b.kr/read.do?no=7"),
    }
    assert {r["page_id"]: r["visible"] for r in candidates.visible_counts(pages_).collect()} == {1: 1}


def test_state_records_and_forms(spark, one):
    from noticelake.operators import candidates

    page = "<ul><li class='state_on'><strong>채용 공고</strong><a onclick=\"view('12')\">보기</a></li><li class='state_off'><strong>모집</strong></li></ul>"
    got = candidates.state_records(spark.createDataFrame([(1, page)], "page_id long, html string")).collect()
    assert [(r["title"], r["identity"]) for r in got] == [("채용 공고", "12"), ("모집", "")]
    form = "<input name='a' value='1'><input name='a' value='2'><input type='submit' name='s' value='x'>"
    assert one(candidates.form_fields, form) == {"a": "2", "pageIndex": "1"}


def test_stage_diagnosis(spark):
    from noticelake.operators import stages

    base = {"org": "", "http_ok": True, "verify_ok": True, "list_status": "verified-exact", "pages": 1, "candidates": 3, "visible": 3, "anchors": 3, "blocks": 0, "title_matches": 3, "no_url": 0, "unsafe_url": 0, "list_ok": True, "detail_ok": True, "detail_urls": 3, "attempted": 3, "targets": 3, "missing_urls": 0, "validated": 3, "error": "", "empty_bodies": 0, "files": 1, "explicitly_none": False}
    cases = [
        ({}, "PIPELINE_SAMPLE_OK"),
        ({"http_ok": False}, "HTTP_FAILED"),
        ({"verify_ok": False}, "RECRUIT_VERIFY_FAILED"),
        ({"list_status": "partial", "candidates": 0, "no_url": 2}, "LIST_DETAIL_SIGNAL_MISSING"),
        ({"list_status": "partial", "candidates": 2}, "LIST_MISSING_POSTS"),
        ({"detail_ok": False, "validated": 1, "error": "HTTP 404"}, "DETAIL_404"),
        ({"detail_ok": False, "validated": 1}, "DETAIL_BODY_PARTIAL"),
        ({"files": 0}, "ATTACHMENT_ZERO_UNRESOLVED"),
        ({"files": None, "explicitly_none": True}, "PIPELINE_SAMPLE_OK"),
    ]
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) else 'boolean' if isinstance(v, bool) else 'int'}" for k, v in base.items())
    rows = [tuple((base | {"org": str(i)} | c)[k] for k in base) for i, (c, _) in enumerate(cases)]
    actions = spark.createDataFrame([("HTTP_FAILED", "check the address")], "code string, action string")
    got = {int(r["org"]): (r["cause"]["code"], r["action"]) for r in stages.diagnose(spark.createDataFrame(rows, schema), actions).collect()}
    assert [got[i][0] for i in range(len(cases))] == [c for _, c in cases]
    assert got[1][1] == "check the address" and got[0][1] == "read the evidence"
    t = [r["t"] for r in spark.createDataFrame([("https://a.kr/x?idx=1", "GET"), ("https://a.kr/view/1", None), ("https://a.kr/", "post"), ("https://a.kr/", None)], "u string, m string").select(stages.detail_template(F.col("u"), F.col("m"), F.lit(False)).alias("t")).collect()]
    assert t == ["QUERY_ID", "PATH_VIEW", "FORM_POST", "CUSTOM"]
