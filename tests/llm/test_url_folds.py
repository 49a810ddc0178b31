"""Suffix rates leave a row's own fold out; null ids and clashing columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import url_filter


def test_rates_leave_the_own_fold_out():
    rng = np.random.default_rng(2)
    suffixes = rng.choice(list("abcdef"), 200).tolist()
    y = rng.integers(0, 2, 200).astype(float)
    got = url_filter.left_out_rates(suffixes, y)
    for i in range(200):
        rest = [j for j in range(200) if j % 4 != i % 4]
        base = (y[rest].sum() + 1) / (len(rest) + 2)
        own = [j for j in rest if suffixes[j] == suffixes[i]]
        assert got[i] == pytest.approx((y[own].sum() + 5 * base) / (len(own) + 5))
    # A suffix that only one row has tells that row nothing of its label.
    alone = url_filter.left_out_rates([f"s{i}" for i in range(200)], y)
    assert all(len(set(alone[k::4])) == 1 for k in range(4))
    assert url_filter.left_out_rates([], np.zeros(0)).tolist() == []


def test_null_ids_and_clashing_columns(spark):
    rows = [(None, None), (None, "http://a.org/x"), (1, "no scheme"), (1, "http://b.com/de/x"), (1, "http://b.com/de/x"), (2, ""), (3, "http://"), (4, "x://" + "a" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("clash") for c in ("host", "path", "fit", "rule", "tld", "domain", "length", "verdict", "block_score", "blocked")})
    got = url_filter.judge_urls(pages).collect()
    assert sorted(((r["page_id"] or -1), r["rule"] or "", r["verdict"] in ("allow", "block")) for r in got) == sorted([(-1, "", True), (-1, "org/", True), (1, "", True), (1, "com/de/", True), (1, "com/de/", True), (2, "", True), (3, "", True), (4, "", True)])
    assert url_filter.judge_urls(pages.limit(0)).count() == 0
