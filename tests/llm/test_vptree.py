import numpy as np
import pytest
from pyspark.sql import functions as F

from vitals.llm import vptree

SCHEMA = "vec_id long, embedding array<double>, extra int"


def clustered(n, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(20, dim))
    return centers[rng.integers(0, 20, n)] + 0.3 * rng.normal(size=(n, dim))


def frame(spark, vectors, ids=None):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in zip(ids or range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def brute(vectors, queries, k):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for q in queries:
        score = np.round(unit @ unit[q], 12)
        score[q] = -9
        out[q] = np.lexsort((np.arange(len(unit)), -score))[:k].tolist()
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


def test_factor_one_is_exact_over_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(vptree, "BLOCK", 7)
    vectors = clustered(1500)
    df = frame(spark, vectors)
    index, shards = vptree.build_index(vptree.keyed(df), 5, shard=200)
    assert shards == 8 and sum(len(r.ids) for r in index.collect()) == 1500
    assert found(vptree.nearest(df, df.filter("vec_id % 50 = 0"))) == brute(vectors, range(0, 1500, 50), 5)


def test_a_larger_factor_visits_less_and_still_finds_most():
    vectors = vptree.normalized(clustered(4000, 8))
    nodes, order = vptree.build(vectors)
    queries = vectors[::40]
    exact = vptree.Search(vectors, nodes, order, queries, 6, 1.0)
    loose = vptree.Search(vectors, nodes, order, queries, 6, 1.5)
    truth = np.argsort(-(queries @ vectors.T), axis=1)[:, :6]
    assert all(set(a) == set(b) for a, b in zip(exact.found.tolist(), truth.tolist()))
    recall = np.mean([len(set(a) & set(b)) / 6 for a, b in zip(loose.found.tolist(), truth.tolist())])
    assert loose.visited < exact.visited < len(queries) * len(vectors) and recall >= 0.9


def test_a_vector_held_by_a_third_of_the_rows(spark):
    vectors = clustered(300)
    vectors[::3] = vectors[0]
    df = frame(spark, vectors)
    assert found(vptree.nearest(df, df.filter("vec_id % 50 = 0"))) == brute(vectors, range(0, 300, 50), 5)


def test_unusable_vectors_ties_and_repeats(spark):
    vectors = [[1, 0], [1, 0], [0, 0], None, [None, 1], [float("nan"), 1], [float("inf"), 0], [0, 1], [-0.0, 1], [1, 1, 1], []]
    df = frame(spark, vectors)
    df = df.union(df.filter("vec_id = 1"))
    out = vptree.nearest(df, df)
    assert found(out) == {0: [1, 7, 8], 1: [0, 7, 8], 7: [8, 0, 1], 8: [7, 0, 1]}
    assert {r.score for r in out.filter("query_id = 0 and vec_id = 1").collect()} == {1.0}


def test_scores_are_cosines_of_extreme_vectors(spark):
    vectors = [[1e-200, 2e-200], [3e200, 1e200], [1.0, 1.0]]
    scores = {(r.query_id, r.vec_id): r.score for r in vptree.nearest(frame(spark, vectors), frame(spark, vectors)).collect()}
    assert scores[0, 2] == pytest.approx(3 / np.sqrt(10)) and scores[0, 1] == pytest.approx(5 / np.sqrt(50))


def test_empty_tables(spark):
    df = frame(spark, clustered(10))
    assert vptree.nearest(df.limit(0), df).collect() == [] == vptree.nearest(df, df.filter(F.lit(False))).collect()


def test_more_ties_than_a_search_keeps_are_ranked_by_id(spark):
    rng = np.random.default_rng(3)
    query = np.eye(8)[0]
    across = np.zeros((300, 8))
    across[:, 1:] = rng.normal(size=(300, 7))  # cosine 0 to the query
    scaled = np.outer(2.0 ** rng.permutation(np.arange(-60, 60)), [0, 0, 0, 1, 2, 2, 4, 0])
    df = frame(spark, [query, *across, *scaled])
    out = found(vptree.nearest(df, df.filter("vec_id in (0, 400)")))
    assert out == {0: [1, 2, 3, 4, 5], 400: [301, 302, 303, 304, 305]}


def test_an_id_of_many_vectors_takes_one_place(spark):
    """25 vectors of one id are nearest to each other, nine other ids come after them."""
    near = [[1.0, k / 1000, 0.0] for k in range(25)]
    rows = [(100, v) for v in near] + [(k, [1.0, 0.0, 0.1 * k]) for k in range(1, 10)] + [(7, [1.0, 0.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = vptree.nearest(df, df.filter("vec_id in (100, 3)"))
    unit = {i: [np.array(v) / np.linalg.norm(v) for j, v in rows if j == i] for i, _ in rows}
    for query in (3, 100):
        score = {i: max(a @ b for a in unit[query] for b in own) for i, own in unit.items() if i != query}
        assert found(out)[query] == sorted(score, key=lambda i: (-score[i], i))[:5]
    ranks = [(r.query_id, r.rank) for r in out.collect()]
    assert sorted(ranks) == [(q, k) for q in (3, 100) for k in range(1, 6)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_vectors_or_hits_are_broadcast(spark):
    """Spark's estimates hold neither the copies of queries for all shards nor the hits, so small tables looked fit for it."""
    df = frame(spark, clustered(300))
    out = vptree.nearest(df, df.filter("vec_id % 50 = 0"))
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) >= 10 << 20
    assert "Broadcast" not in plan_of(out)


def test_hits_grow_with_columns_of_shards_not_with_shards(spark):
    keyed = vptree.keyed(frame(spark, clustered(1500)))
    index, shards = vptree.build_index(keyed, 5, shard=10)
    queries = keyed.filter("vec_id % 50 = 0").select("key", "vector")
    assert shards == 150
    assert vptree.search(index, shards, queries, 5, 1.0).count() <= 6 * 30 * 4 * spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("factor", [1.0, 1.5])
def test_many_bands_and_columns_of_several_dimensions(spark, monkeypatch, kind, factor):
    monkeypatch.setattr(vptree, "BAND", 1)
    monkeypatch.setattr(vptree, "COLUMN", 1)
    parts = [clustered(400, dim, dim).astype("f4" if kind == "float" else "f8") for dim in (4, 16)]
    rows = [(1000 * n + i, [float(x) for x in v]) for n, part in enumerate(parts) for i, v in enumerate(part)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    keyed = vptree.keyed(df)
    assert dict(keyed.dtypes)["vector"] == f"array<{kind}>"
    index, shards = vptree.build_index(keyed, 5, shard=100)
    asked = keyed.filter("vec_id % 10 = 0")
    hits = vptree.search(index, shards, asked.select("key", "vector"), 5, factor, block=8)
    best = {}
    for r in hits.join(asked.select("key", F.col("vec_id").alias("query")), "key").collect():
        best.setdefault(r.query, []).append((-r.score, r.vec_id))
    truth = {1000 * n + q: [1000 * n + v for v in near] for n, part in enumerate(parts) for q, near in brute(part.astype("f8"), range(0, 400, 10), 5).items()}
    # The nearest of all is the query itself.
    got = {q: [v for _, v in sorted(found)[1:6]] for q, found in best.items()}
    if factor == 1.0:
        assert got == truth
    else:
        assert got.keys() == truth.keys() and np.mean([len({*got[q]} & {*truth[q]}) / 5 for q in truth]) >= 0.9


def test_single_precision_and_carried_bounds_lose_no_neighbour():
    """Near copies, closer than single precision can tell apart, dealt over trees that share their bounds."""
    rng = np.random.default_rng(5)
    vectors = np.concatenate([clustered(1200, 64), clustered(1, 64) + 1e-9 * rng.normal(size=(300, 64))])[rng.permutation(1500)]
    queries = vectors[::7]
    best = vptree.Best(len(queries), 6)
    for start in range(0, 1500, 300):
        part = vectors[start : start + 300]
        nodes, order = vptree.build(vptree.normalized(part))
        ids = np.arange(start, start + 300), np.arange(301)
        vptree.Search(vptree.normalized(part), nodes, order, queries, 6, 1.0, ids, part, best)
    score = np.stack([vptree.cosine(np.broadcast_to(q, vectors.shape), vectors) for q in queries])
    assert best.ids.tolist() == np.lexsort((np.broadcast_to(np.arange(1500), score.shape), -score))[:, :6].tolist()
