"""Row traces, causes of pages, reports of sources, and candidates by rules and profiles."""

from pyspark.sql import functions as F

from noticelake.operators import adapters, candidates, probe, trace

ROW = "<tr><td>{0}</td><td>{1}</td><td>{2}</td></tr>"


def _link(title):
    return f"<a href='/v?no=1'>{title}</a>"


def test_rows_and_candidates_are_matched_one_to_one(spark):
    same = "2026년 직원 채용 공고"
    rows = [ROW.format(1, _link(same), "2026.01.02")] * 3 + [ROW.format("공지", _link("행정 채용 공고"), ""), ROW.format("x", _link("시설 채용 공고"), ""), ROW.format(2, "조리 채용 공고", "2026.01.02"), ROW.format(3, _link("홈"), ""), ROW.format("", "", "")]
    pages = spark.createDataFrame([(1, "<table><tr><th>번호</th></tr>" + "".join(rows) + "</table>", 8), (2, None, None), (3, "<p>none</p>", None)], "page_id long, html string, visible long")
    taken = [(1, 0, same, "/a"), (1, 1, same, "/b"), (1, 2, "자주 묻는 질문", "/faq"), (3, 0, "첨부", "/download?f=1"), (9, 0, "다른 채용", "/x")]
    found = spark.createDataFrame(taken, "page_id long, pos long, title string, link string")
    got = trace.row_trace(trace.traced_rows(pages), found)
    told = sorted((r["page_id"], r["row_pos"] if r["row_pos"] is not None else 99, r["state"], r["reason"], r["kind"]) for r in got.collect())
    assert told == [
        (1, 0, "matched", "", "RECRUIT_POST"),
        (1, 1, "matched", "", "RECRUIT_POST"),
        (1, 2, "missing", "UNMATCHED_BY_EXTRACTOR", ""),
        (1, 3, "missing", "UNMATCHED_BY_EXTRACTOR", ""),
        (1, 4, "missing", "ROW_SHAPE_NOT_RECOGNIZED", ""),
        (1, 5, "missing", "DETAIL_SIGNAL_MISSING", ""),
        (1, 6, "missing", "TITLE_TOO_SHORT", ""),
        (1, 7, "missing", "TITLE_EMPTY", ""),
        (1, 99, "extra", "", "FAQ"),
        (3, 99, "extra", "", "ATTACHMENT"),
        (9, 99, "extra", "", "RECRUIT_POST"),
    ]
    causes = {r["page_id"]: r for r in trace.page_causes(pages, got).collect()}
    one = causes[1]
    assert (one["rows"], one["unique_titles"], one["candidates"], one["missing"], one["extra"], one["cause"], one["exact_titles"]) == (8, 5, 3, 4, 1, "PARTIAL_ROW_REJECTION", False)
    assert one["reasons"]["UNMATCHED_BY_EXTRACTOR"] == 2 and one["kinds"] == {"FAQ": 1, "RECRUIT_POST": 2} and one["counter_reason"] == "MISSING_UNIQUE_POSTS"
    assert causes[2]["cause"] == "VISIBLE_ROW_COUNTER_UNAVAILABLE" and causes[2]["reasons"] is None
    assert causes[3]["cause"] == "VISIBLE_ROW_COUNTER_INCOMPATIBLE_WITH_PAGE_STRUCTURE" and causes[3]["counter_reason"] == "DOM_COUNT_ZERO"


def test_every_is_not_true_of_nothing(spark):
    df = spark.createDataFrame([("a", True), ("a", True), ("b", True), ("b", None), ("c", False)], "k string, f boolean")
    assert {r["k"]: r["e"] for r in df.groupBy("k").agg(probe.every(F.col("f")).alias("e")).collect()} == {"a": "all", "b": "some", "c": "none"}
    assert df.where("k = 'd'").agg(probe.every(F.col("f"))).first()[0] is None


def test_source_reports(spark):
    access = spark.createDataFrame([("ok", True, True), ("down", None, None), ("other", True, False), ("empty", True, True), ("none", True, True), ("count", True, True), ("quiet", True, True), ("files", True, True)], "org string, http_ok boolean, verify_ok boolean")
    listings = [("ok", 1, "partial", 9, 5, False), ("ok", 2, "exact", 1, 1, True), ("empty", 3, "verified-empty", 0, 0, True), ("count", 4, "exact", 2, 2, False), ("quiet", 5, "exact", 1, 1, True), ("files", 6, "exact", 1, 1, True), ("down", 7, "exact", 1, 1, True)]
    listings = spark.createDataFrame(listings, "org string, page_id long, status string, visible long, candidates long, verified boolean")
    details = [("ok", 2, False, True, 1, False, ""), ("ok", 1, True, None, 0, False, ""), ("quiet", 5, False, True, 0, True, ""), ("files", 6, False, True, 2, False, "")]
    details = spark.createDataFrame(details, "org string, page_id long, list_only boolean, ok boolean, attachments long, explicitly_none boolean, error string")
    files = spark.createDataFrame([("ok", 2, True, True), ("files", 6, True, True), ("files", 6, True, False)], "org string, page_id long, downloaded boolean, parsed boolean")
    got = {r["org"]: r for r in probe.source_report(access, listings, details, files).collect()}
    want = {"ok": probe.PASSED, "down": probe.NO_ACCESS, "other": probe.NO_BOARD, "empty": probe.EMPTY, "none": probe.NO_LIST, "count": probe.UNVERIFIED, "quiet": probe.PASSED, "files": probe.NO_ANALYSIS}
    assert {k: r["bottleneck"] for k, r in got.items()} == want
    assert got["ok"]["page_id"] == 2 and got["quiet"]["discovery_status"] == "not-required-no-attachments" and got["none"]["list_status"] == "fetch-failed"
    assert got["empty"]["coverage"] == 1.0 and got["empty"]["validation"] == 1.0 and got["files"]["analysis_status"] == "sample-partial"


def test_candidates_by_rules_and_profiles(spark):
    rows = "<table>" + "".join(ROW.format(i, x, "2026.01.02") for i, x in enumerate(["<a onclick=\"go('5','7')\">2026년 행정 직원 채용</a>", "<a href='https://b.kr/read.do?idx=1'>2026년 시설 직원 채용</a>", "<a href='https://evil.kr/read.do?idx=1'>2026년 조리 직원 채용</a>"])) + "</table>"
    link = "<li><a href='{0}'>2026년 직원 채용 공고 {1}</a> 2026.01.02</li>"
    links = "".join(link.format(u, i) for i, u in enumerate(["/board/list.do", "/x/y/z", "/main.do", "/p?opaque=1", "/list", "/a.hwp"]))
    pages = spark.createDataFrame([(1, "a", "https://a.kr/list", rows), (2, "c", "https://c.kr/list", links), (3, None, None, None)], "page_id long, org string, url string, html string")
    rules = adapters.table_of(spark, adapters.RULES, [("a", r"go\('(\d+)','(\d+)'\)", ["id", "n"], False, None, None, "POST", "/view.do", [("idx", "{id}")], [("n", "{n}")], None, None, None, None)])
    profiles = spark.createDataFrame([("a", ["a.kr", "b.kr"], None, None)], "org string, hosts array<string>, detail_path string, detail_param string")
    got = candidates.candidates(pages, rules=rules, profiles=profiles).orderBy("page_id", "pos").collect()
    assert [(r["page_id"], r["tier"], r["link"], r["list_only"], r["method"], r["body"]) for r in got] == [
        (1, "row", "https://a.kr/view.do?idx=5", False, "POST", "n=7"),
        (1, "row", "https://b.kr/read.do?idx=1", False, "GET", ""),
        (1, "row", "https://a.kr/list#list-row-2", True, "GET", ""),
        (2, "anchor", "https://c.kr/x/y/z", False, "GET", ""),
        (2, "anchor", "https://c.kr/p?opaque=1", False, "GET", ""),
    ]
    assert candidates.candidates(pages.limit(0)).count() == 0
