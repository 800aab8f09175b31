"""Text, date, URL and rule functions."""

import datetime

from pyspark.sql import functions as F

from noticelake.functions import dates, text, urls


def test_clean_html_decodes_before_it_strips(one):
    html = "<p>가&amp;나</p><script>x()</script><style>p{}</style><!-- no --><div>다&nbsp;라&#44;&#x4e;</div>&lt;b&gt;마"
    assert one(text.clean_html, html) == "가&나\n 다 라,N\n 마"
    assert one(text.clean, "<b>a</b> &lt;i&gt; b") == "a <i> b"
    assert one(text.clean_html, "&amp;lt; &copy; &#99999999;") == "&lt; &copy;"


def test_title_tokens_and_keys(one):
    assert one(text.title_tokens, "[공고] 2026 행정직 직원 채용 (수정) a") == ["2026", "행정직"]
    assert one(text.title_key, "2026년 3월 1일 [재공고] 공무직 채용 제2차") == "공무직 채용"


def test_evidence_cuts_before_it_deduplicates(one):
    lines = lambda c: text.evidence(text.cell_lines(c), "가", 2, 240)
    assert one(lines, "가1\n나\n가1\n가2") == ["가1"]


def test_deadlines(one):
    d = lambda s: one(lambda c: dates.extract_deadline(c, 2026), s)
    assert d("접수기간 2026.08.01 ~ 2026.08.20") == "2026-08-20"
    assert d("접수기간 26.02.01 ~ 26.02.31") == ""  # a range without such a day has no fallback
    assert d("원서접수 2026.08.01부터 2026.08.20까지") == "2026-08-01"
    assert d("마감일: 8.5") == "2026-08-05"
    assert d("no date") == ""


def test_expiry_is_the_end_of_the_korean_day(one):
    at = lambda t: lambda c: dates.is_expired(c, F.to_timestamp(F.lit(t)))
    assert not one(at("2026-06-30T14:59:59Z"), "2026-06-30")
    assert one(at("2026-06-30T15:00:00Z"), "2026-06-30")
    assert not one(at("2026-06-30T15:00:00Z"), "")
    assert one(lambda c: dates.days_left(c, F.lit(datetime.date(2026, 6, 28))), "2026-06-30") == 2
    assert one(lambda c: dates.days_left(c, F.lit(datetime.date(2026, 6, 28))), "") is None


def test_canonical_url(one):
    c = lambda u: one(urls.canonical_url, u)
    assert c("https://a.kr/view.do?page=2&nttId=7&menuNo=3#top") == "https://a.kr/view.do?menuNo=3&nttId=7"
    assert c("https://a.kr/list/?pageIndex=2&menuNo=3") == "https://a.kr/list"
    for u in ("https://a.kr/x?b=2&a=1&page=3", "https://a.kr/", "not a url"):
        assert c(c(u)) == c(u)


def test_absolute_url(one):
    assert one(urls.absolute_url, "../b.do?x=가", "https://a.kr/c/d/e") == "https://a.kr/c/b.do?x=%EA%B0%80"
    assert one(urls.absolute_url, "b", "") == ""


def test_detail_signal(one):
    assert one(urls.has_detail_signal, "https://a.kr/board/view.do")
    assert one(urls.has_detail_signal, "https://a.kr/x?nttId=1")
    assert not one(urls.has_detail_signal, "https://a.kr/x?q=1")
