"""Every catalog query against its SQL on the smallest tables; those without SQL against plain Python."""

import numpy as np
import pytest

from quern.plans import catalog

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_sql(name, spark, duck, check_same):
    check_same(catalog.QUERIES[name](spark, SMALL).toPandas(), duck(catalog.ORACLE[name]))


def test_semantic_dedup_is_greedy(spark):
    got = {r.vec_id for r in catalog.dedup_semantic(spark, SMALL).collect()}
    rows = sorted(spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect())
    x = np.array([r.embedding for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    kept = []
    for i in range(len(x)):
        if not kept or (x[kept] @ x[i]).max() < 0.30:
            kept.append(i)
    assert got == {rows[i].vec_id for i in kept}


def test_bleu_of_equal_texts_is_100(spark):
    from quern.operators import evalmetrics

    t = spark.createDataFrame([(1, "g", "the cat sat on the mat today .", "the cat sat on the mat today .")], "k int, g string, p string, r string")
    assert evalmetrics.bleu_scores(evalmetrics.bleu_counts(t, "g", "p", "r", "k"), "g").first()["bleu"] == pytest.approx(100)


def test_rouge_bounds(spark):
    rows = catalog.rouge_l(spark, SMALL).collect()
    assert all(0 <= r.rouge_l <= 1 for r in rows)
    assert all(r.rouge_l == 1 for r in rows if r.item_id % 3 == 0)


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", ["mix_ratio", "dedup_priority", "log_forward_fill", "dedup_semantic"])
def test_partitions_do_not_change_results(name, spark, check_same):
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = catalog.QUERIES[name](spark, SMALL).toPandas()
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        check_same(catalog.QUERIES[name](spark, SMALL).toPandas(), one)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
