import hashlib
from collections import defaultdict

import pytest

from quern.llm import exact_dedup, url_filter
from quern.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_sql(name, spark, duck, check_same):
    check_same(QUERIES[name](spark, SMALL).toPandas(), duck(ORACLE[name]))


@pytest.mark.parametrize("keep,pick", [("smallest", min), ("largest", max)])
def test_exact_edges(spark, edge_docs, no_docs, keep, pick):
    rows = exact_dedup.exact_classes(edge_docs, keep=keep).collect()
    source = [(r.doc_id, r.text or "") for r in edge_docs.collect()]
    groups = defaultdict(list)
    for i, t in source:
        groups[t].append(i)
    want = sorted(
        (str(i), str(k := pick(known) if (known := [x for x in groups[t] if x is not None]) else None), len(groups[t]), i == k, hashlib.sha256(t.encode()).hexdigest()) for i, t in source
    )
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in rows) == want
    assert exact_dedup.exact_classes(no_docs).count() == 0


def test_exact_dedup_keeps_columns(edge_docs, no_docs):
    kept = exact_dedup.exact_dedup(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 4, 6, 7, 8, 9]  # repeated rows of one id are one document
    assert exact_dedup.exact_dedup(no_docs).count() == 0


def test_runs_and_fan_in_do_not_matter(spark, check_same):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = exact_dedup.exact_classes(docs).toPandas()
    for runs, fan_in in ((1, 2), (16, 2), (9, 3)):
        check_same(exact_dedup.exact_classes(docs, runs=runs, fan_in=fan_in).toPandas(), want)


def test_hot_text(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'same', CAST(id AS STRING)) AS text")
    assert exact_dedup.exact_dedup(docs).count() == 2001


URLS = [
    (1, None, "", "", None, "allow"),
    (2, "no scheme", "", "", None, "allow"),
    (3, "http://X.ORG", "x.org", "", None, "allow"),
    (4, "http://x.org/a", "x.org", "/a", "org/", "allow"),
    (5, "http://EXAMPLE.org/es/1?x#y", "example.org", "/es/1", "example.org/es/", "block"),
    (6, "http://a.example.org/en/12", "a.example.org", "/en/12", "example.org/en/1", "block"),
    (7, "http://notexample.org/en/12", "notexample.org", "/en/12", "org/", "allow"),
    (8, "http://b.com/de/", "b.com", "/de/", "com/de/", "block"),
    (9, "http://www.free-bets.example.com/en/1", "www.free-bets.example.com", "/en/1", None, "block"),
    (10, "http://free-bets.example.com/fr/1", "free-bets.example.com", "/fr/1", "com/fr/", "allow"),
    (11, "http://ok.example.com#x", "ok.example.com", "", None, "allow"),
    (12, "a://b://c/d", "b:", "//c/d", None, "allow"),
    (None, "http://ads-track.example.net?q", "ads-track.example.net", "", None, "block"),
    (9, "http://www.free-bets.example.com/en/1", "www.free-bets.example.com", "/en/1", None, "block"),
]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "h", "p", "c", True) for i, u, *_ in URLS], "page_id long, url string, host string, path string, canonical string, listed boolean")
    got = url_filter.judge_urls(pages, url_filter.default_list(spark), 18).collect()
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in got) == sorted((str(i), h, p, str(r), v) for i, _, h, p, r, v in URLS)
    assert url_filter.judge_urls(pages.limit(0), url_filter.default_list(spark), 18).count() == 0
    empty = url_filter.judge_urls(pages, url_filter.default_list(spark).limit(0), 1).collect()
    assert {r.verdict for r in empty if r.rule is None} == {"allow"}


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    listed = spark.range(20_000).selectExpr("concat('h', id, '.example/') AS canonical")
    other = spark.range(20_000).selectExpr("concat('x', id, '.example/') AS canonical")
    assert url_filter.listed_hits(listed.union(other), listed, 20_000).count() == 20_000
    blocks = 20_000 * url_filter.BITS_PER_URL // 256
    block, bits = url_filter._block_and_bits(other["canonical"], blocks)
    passed = other.withColumn("block", block).join(url_filter.build_filter(listed, blocks), "block")
    for i, b in enumerate(bits):
        passed = passed.filter(passed[f"w{i}"].bitwiseAND(b) != 0)
    assert passed.count() < 400


def test_runs_meet_their_partners_only(spark):
    """Each round deals by the run's own number, merges sorted input, and needs no other exchange."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    merged = exact_dedup.merge_runs(exact_dedup._digests(docs, "doc_id", docs["text"]), runs=27, fan_in=3)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("shufflepartitionidpassthrough") == 3 and plan.count("Exchange") == 4 and plan.count("HashAggregate") == 0


def test_listed_pages(spark):
    """A list may name pages as well as hosts; a page's siblings are not on it."""
    listed = spark.createDataFrame([("shop.example/bad/1",), ("evil.example/",)], "canonical string")
    pages = spark.createDataFrame([(1, "http://shop.example/bad/1"), (2, "http://shop.example/bad/2"), (3, "http://www.evil.example/x"), (4, "http://ok.example/" + "p" * 100_000)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(pages, listed, 2).collect()}
    assert got == {1: "block", 2: "allow", 3: "block", 4: "allow"}
