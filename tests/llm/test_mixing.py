import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitals.llm import mixing


def corpus(spark, sizes):
    rows = [(f"{s}{i}", "word " * 3, s) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "doc_id string, text string, source string")


def test_shares_meet_the_weights(spark):
    docs = corpus(spark, {"a": 6000, "b": 2000, "c": 500})
    weights = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "source string, weight int")
    n = {r.source: r["count"] for r in mixing.replicate(docs, weights).groupBy("source").count().collect()}
    total = 8500
    for source, share in {"a": 0.25, "b": 0.25, "c": 0.5}.items():
        assert abs(n[source] - share * total) < 6 * math.sqrt(share * total) * 2.5


@pytest.mark.parametrize("mean", [0.3, 2.0, 7.5, 40.0])
def test_copies_follow_the_poisson_distribution(spark, mean):
    parts = max(1, math.ceil(mean / mixing.PART))
    cumulative = mixing.cumulative(F.lit(mean / parts))
    df = spark.range(20_000).select(mixing.copies(cumulative, F.lit(parts), F.col("id"), "seed").alias("n"))
    n = np.array([r.n for r in df.collect()])
    assert abs(n.mean() - mean) < 5 * math.sqrt(mean / len(n))
    assert abs(n.var() - mean) < 0.08 * mean
    assert abs((n == 0).mean() - math.exp(-mean)) < 0.02


def test_rows_are_repeated_whole_and_shuffled(spark):
    docs = corpus(spark, {"a": 300, "b": 30}).withColumn("copy", F.lit("clash"))
    out = mixing.replicate(docs, factor=3.0)
    rows = out.collect()
    assert out.columns == ["doc_id", "text", "source", "copy", "shuffle_key"]
    assert len({(r.doc_id, r.copy) for r in rows}) == len(rows) > 500
    by_partition = [r.shuffle_key for r in rows]
    assert by_partition != sorted(by_partition) or out.rdd.getNumPartitions() == 1
    assert [tuple(r) for r in mixing.replicate(docs, factor=3.0).collect()] == [tuple(r) for r in rows]


def test_null_sources_missing_weights_repeats_and_the_empty_table(spark):
    rows = [(None, None, None), (1, "", None), (2, "a", "s"), (2, "a", "s"), (3, "b", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = spark.createDataFrame([(None, 1), ("s", 1)], "source string, weight int")
    out = mixing.replicate(docs, weights, factor=50.0)
    assert "t" not in {r.source for r in out.collect()}
    n = [r["count"] for r in out.filter("doc_id = 2").groupBy("copy").count().collect()]
    assert set(n) == {2}  # equal rows have equal numbers of copies
    assert mixing.replicate(docs.limit(0)).collect() == []


def test_join_without_broadcast_gives_the_same(spark, monkeypatch):
    docs = corpus(spark, {"a": 200, "b": 20})
    expected = sorted(map(tuple, mixing.replicate(docs).collect()))
    monkeypatch.setattr(mixing, "MOST_BROADCAST_BYTES", 0)
    assert sorted(map(tuple, mixing.replicate(docs).collect())) == expected


def test_columns_may_have_any_names(spark):
    docs = spark.createDataFrame([(i, "s", i, i, i, i, i) for i in range(50)], "doc_id long, source string, _n int, n int, _source int, parts int, cumulative int").withColumn("text", F.lit("a"))
    out = mixing.replicate(docs)
    assert out.columns == [*docs.columns, "copy", "shuffle_key"]
    assert all(r._n == r.n == r.parts == r.doc_id for r in out.collect())
