"""Publication of all documents or none, and the scrub of retired sources."""

import json

import pytest
from pyspark.sql import functions as F

from noticelake.operators import pages, requirements
from noticelake.sources import fetch, publication


def _documents(spark, n, third='{"qa": 0}'):
    jobs = spark.createDataFrame([(i, f"공고 {i}") for i in range(n)], "fit_score int, title string")
    feed = publication.document(jobs, "jobs", ["title"], 3)
    rest = spark.createDataFrame([("requirement-report", "[]"), ("qa-report", third), ("debug-report", "{}")], "name string, document string")
    return feed.union(rest)


def test_all_documents_or_none(spark, tmp_path):
    path = str(tmp_path / "site")
    assert publication.published(spark, path) == {}
    publication.publish(_documents(spark, 5), path)
    first = publication.published(spark, path)
    assert set(first) == set(publication.OUTPUTS) and [j["title"] for j in first["jobs"]] == ["공고 0", "공고 1", "공고 2"]
    for broken in (_documents(spark, 9, "{broken"), _documents(spark, 9, None), _documents(spark, 9).where("name <> 'qa-report'"), _documents(spark, 9).union(_documents(spark, 9))):
        with pytest.raises(Exception):  # noqa: B017
            publication.publish(broken, path)
        assert publication.published(spark, path) == first
    dies = F.udf(lambda n: 1 // 0 if n == "debug-report" else n, "string")
    with pytest.raises(Exception):  # noqa: B017
        publication.publish(_documents(spark, 9).withColumn("name", dies("name")), path)
    assert publication.published(spark, path) == first
    publication.publish(_documents(spark, 1, '{"qa": 7}'), path)
    assert publication.published(spark, path)["qa-report"] == {"qa": 7} and len(publication.published(spark, path)["jobs"]) == 1


def test_scrub_at_any_depth(spark):
    gone = {"org": "옛 기관", "x": 1}
    kept = {"org": "새 기관", "jobs": [{"title": "옛 기관 안내"}]}
    whole = {"list": [gone, kept, [gone, 3]], "옛 기관": {"n": 1}, "deep": {"a": {"b": gone, "c": [{"d": gone, "e": None}]}}, "org": "새 기관"}
    want = {"list": [kept, [3]], "deep": {"a": {"c": [{"e": None}]}}, "org": "새 기관"}
    texts = [json.dumps(whole, ensure_ascii=False), json.dumps(whole), '{"a" :  1}', "옛 기관 {no json", json.dumps(gone), None, '{"옛 기관 둘": 1,  "t": "옛 기관"}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["s"] for r in df.select("i", publication.scrubbed(F.col("t"), ["옛 기관"]).alias("s")).orderBy("i").collect()]
    assert json.loads(got[0]) == json.loads(got[1]) == want
    assert got[2:] == texts[2:]


def test_small_operators_of_sources(spark):
    html = "<a href='/r'>채용공고</a><a href='/r#x'>채용공고</a><a href='/r2'>채용공고 2</a><a href='/r3'>채용공고</a><a href='/r4'>채용공고</a><a href='/r5'>채용공고</a>"
    df = spark.createDataFrame([(1, "https://a.kr/", html)], "page_id long, url string, html string")
    assert [r["url"] for r in pages.listing_anchors(df).orderBy("pos").collect()] == ["https://a.kr/r", "https://a.kr/r2", "https://a.kr/r3", "https://a.kr/r4"]
    sources = spark.createDataFrame([("a", "t", None, ["https://a.kr", "https://a.kr", None], "https://b.kr"), ("b", "none", ["x"], None, "https://b.kr")], "org string, access_template string, transport_chain array<string>, access_urls array<string>, url string")
    templates = spark.createDataFrame([("t", "plain", ["node", "curl"])], "access_template string, label string, template_chain array<string>")
    got = {r["org"]: tuple(r["access"]) for r in fetch.template_summary(sources, templates).collect()}
    assert got == {"a": ("t", "plain", ["node", "curl"], 2, False), "b": ("none", None, ["x"], 1, True)}
    rows = [("o", "t", "", f"vacancy-{i}", "same", "", "text", "") for i in (1, 1, 2)] + [("o", "t", "https://l", "vacancy-9", "x", "", "text", "")] * 2
    postings = spark.createDataFrame(rows, "org string, title string, link string, vacancy_id string, vacancy_name string, list_text string, detail_text string, document_text string")
    keyed = requirements.samples(requirements.with_requirements(postings).withColumn("place", F.monotonically_increasing_id()), "place")
    assert sorted(r["sample_key"] for r in keyed.collect()) == ["o::https://l", "o::vacancy-1", "o::vacancy-2"]
