"""Judging by a join doesn't depend on page ids."""

from spanloom.llm import url_filter
from spanloom.llm.queries import URL_RULES


def test_null_and_repeated_page_ids(spark):
    urls = ["http://a.net/x", "http://example.net/en/1", "http://example.com/de/", "http://b.org/fr/2", "http://other.io/", None]
    pages = spark.createDataFrame([(i, u) for u in urls for i in (None, 1)], "page_id bigint, url string")
    want = url_filter.judge_urls(pages, URL_RULES).collect()
    got = url_filter.judge_by_join(pages, spark.createDataFrame(URL_RULES, "action string, rule string")).collect()
    assert len(want) == 12 and sorted(map(str, got)) == sorted(map(str, want))
