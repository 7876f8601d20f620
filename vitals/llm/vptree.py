"""Nearest neighbours by cosine: a vantage-point tree for each shard of the vectors.

Unit vectors' Euclidean distance orders them as their cosine does and obeys the triangle
inequality. A node of a tree has a vantage point, one of its vectors; the nearer half of the others goes
to one child, the rest to the other, and the node keeps the range of distances of each. If ``d`` is a
query's distance to the vantage point, nothing in a child of range ``[lo, hi]`` is nearer than
``max(lo - d, d - hi)``. A child is skipped if ``factor`` times that exceeds the query's
distance to its ``k``-th best so far: factor one is exact, larger ones skip more.

Equal vectors are indexed as one, with their ``k + 1`` smallest ids: no query can need more
of them. Queries with equal vectors are searched once. Every query meets every shard: shards are dealt
into columns and queries into bands, and each task has the trees of one column, which it
reads one after the other, and the queries of one band. So vectors are copied once for each band and queries once for each
column, never each query for each shard, and no join, which Spark might choose to broadcast from a wrong estimate, carries them.

A block's queries go through a tree together, first those without a bound each to the leaf it belongs to,
for a first one, then all through whatever the bound leaves. The bound is the ``k``-th best exact score of any
tree before, if the search is exact. Products are rounded to single precision, so all vectors that rounding could
bring among the best are scored exactly, however many, and ranked by score and id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from vitals.llm.tables import dropped, stored

FACTOR = 1.0
SHARD = 4096
BLOCK = 1024
LEAF = 64
SLACK = 1e-7
# Rows compared at once, and as long as a bound is new; the share of pairs to skip that is worth comparing in pieces.
RUN = 2048
FIRST = 256
PIECES = 0.1
# Bytes, in double precision, of the queries and of the vectors of one task; tasks for each core.
BAND = 64 << 20
COLUMN = 256 << 20
TASKS = 4

NODE = np.dtype(
    [("vantage", "<i4"), ("near", "<i4"), ("far", "<i4"), ("start", "<i4"), ("stop", "<i4")]
    + [(f"{child}_{end}", "<f8") for child in ("near", "far") for end in ("lo", "hi")]
)


def build(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of a tree over the rows of ``unit``, and the order in which leaves list the rows."""
    nodes: list[tuple] = []
    order = np.arange(len(unit))

    def grow(start: int, stop: int) -> int:
        number = len(nodes)
        nodes.append((-1, -1, -1, start, stop, 0.0, 0.0, 0.0, 0.0))
        if stop - start > LEAF:
            own = order[start:stop]
            # A point far from the middle of the others tells them apart best.
            vantage = own[int(np.argmax(distances(unit[own].mean(0)[None], unit[own])[0]))]
            d = distances(unit[vantage][None], unit[own])[0]
            half = len(own) // 2
            split = np.argpartition(d, half)
            order[start:stop], d = own[split], d[split]
            near, far = grow(start, start + half), grow(start + half, stop)
            ends = d[:half].min(), d[:half].max(), d[half:].min(), d[half:].max()
            nodes[number] = (vantage, near, far, start, stop, *ends)
        return number

    if len(unit):
        grow(0, len(unit))
    return np.array(nodes, NODE), order.astype("<i4")


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows; the rows of ``b`` have length one."""
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + 1 - 2 * (a @ b.T), 0))


def normalized(vectors: np.ndarray) -> np.ndarray:
    scaled = even(vectors)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def even(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled by powers of two, which is exact, so that squares neither overflow nor vanish."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1, keepdims=True))[1])


class Best:
    """The ``k`` best different ids of each query so far, best first; ties go to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.ids = np.full((queries, k), -1)
        self.score = np.full((queries, k), -np.inf)

    def add(self, who: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        touched = np.unique(who)
        query, place = np.nonzero(self.score[touched] > -np.inf)
        query = touched[query]
        who = np.concatenate([query, who])
        ids = np.concatenate([self.ids[query, place], ids])
        score = np.concatenate([self.score[query, place], score])
        by = best_ids(who, ids, score, self.ids.shape[1])
        place = np.arange(len(by)) - np.searchsorted(who[by], who[by])
        self.ids[who[by], place], self.score[who[by], place] = ids[by], score[by]

    def hits(self, who: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries as places in ``who``, ids and scores."""
        query, place = np.nonzero(self.score[who] > -np.inf)
        return query, self.ids[who[query], place], self.score[who[query], place]


class Search:
    """Queries in one tree over ``unit``, the rows of ``data`` (if given) scaled to length one."""

    def __init__(
        self,
        unit: np.ndarray,
        nodes: np.ndarray,
        order: np.ndarray,
        queries: np.ndarray,
        k: int,
        factor: float,
        ids: tuple[np.ndarray, np.ndarray] | None = None,
        data: np.ndarray | None = None,
        best: Best | None = None,
    ):
        # ``ids``: those of row ``i`` are ``ids[0][ids[1][i] : ids[1][i + 1]]``.
        self.flat, self.edges = ids if ids else (np.arange(len(unit)), np.arange(len(unit) + 1))
        self.data = unit if data is None else data
        self.nodes, self.order, self.queries, self.factor = nodes, order, queries, factor
        self.rows, self.vantages = unit[order].astype("f4"), unit[nodes["vantage"]]
        self.best = best if best else Best(len(queries), k)
        self.visited = 0
        self.apart = len(np.unique(self.flat)) == len(self.flat)
        # Squared distances of unit vectors are off by less than this, products in single precision by less than the other.
        self.rounding = 16 * (unit.shape[1] + 4) * np.finfo("f8").eps
        self.coarse = (unit.shape[1] + 8) * float(np.finfo("f4").eps)
        for at in range(0, len(queries) if len(nodes) else 0, BLOCK):
            self.block(at, min(at + BLOCK, len(queries)))

    @property
    def found(self) -> np.ndarray:
        return self.best.ids

    def limit(self, who: np.ndarray) -> np.ndarray:
        """Distances up to which a vector may be among the best."""
        return np.sqrt(np.maximum(2 - 2 * self.best.score[who, -1], 0) + self.rounding)

    def block(self, start: int, stop: int) -> None:
        self.start, who = start, np.arange(start, stop)
        self.run: tuple[int, int, np.ndarray] | None = None
        asked = normalized(self.queries[start:stop].astype("f8"))
        self.asked, self.to_vantage = asked.astype("f4"), distances(asked, self.vantages)
        without = who[self.best.score[who, -1] == -np.inf]
        # A fresh bound soon falls, so few rows are compared with it at once.
        self.width = FIRST if len(without) else RUN
        if len(without):
            self.descend(0, without)
        if self.skipped(who) < PIECES:
            self.leaf(0, len(self.order), who)
        else:
            self.visit(0, who)
        self.flush()

    def skipped(self, who: np.ndarray) -> float:
        """The share of pairs that the bounds skip, at most: pairs below several skipped nodes count more than once."""
        inner = self.nodes["vantage"] >= 0
        d, nodes, limit = self.to_vantage[:, inner], self.nodes[inner], self.limit(who)[:, None]
        out = 0.0
        for child in ("near", "far"):
            least = np.maximum(nodes[f"{child}_lo"] - d, d - nodes[f"{child}_hi"])
            below = self.nodes[nodes[child]]
            out += ((self.factor * (least - SLACK) > limit).mean(0) * (below["stop"] - below["start"])).sum()
        return out / len(self.order)

    def leaf(self, start: int, stop: int, who: np.ndarray) -> None:
        """Adjacent rows that the same queries visit are compared together."""
        if self.run and self.run[1] == start and self.run[2] is who and stop - self.run[0] <= self.width:
            self.run = self.run[0], stop, who
            return
        self.flush()
        for at in range(start, stop, self.width):
            self.flush()
            self.run = at, min(at + self.width, stop), who

    def flush(self) -> None:
        if not self.run:
            return
        (start, stop, who), self.run = self.run, None
        self.visited += len(who) * (stop - start)
        least = (1 - self.limit(who) ** 2 / 2 - self.coarse).astype("f4")
        near = self.asked[who - self.start] @ self.rows[start:stop].T
        if self.width == FIRST and self.apart and stop - start > (k := self.best.ids.shape[1]):
            # So many different ids are as near as the ``k``-th of these rows.
            least = np.maximum(least, np.partition(near, -k, axis=1)[:, -k] - np.float32(2 * self.coarse))
        query, place = np.divmod(np.flatnonzero(near >= least[:, None]), stop - start)
        if not len(query):
            return
        query, rows, score = who[query], self.order[start + place], np.empty(len(query))
        for at in range(0, len(query), step := max(1, (1 << 18) // self.rows.shape[1])):
            some = slice(at, at + step)
            score[some] = cosine(self.queries[query[some]].astype("f8"), self.data[rows[some]].astype("f8"))
        n = np.diff(self.edges)[rows]
        each = np.repeat(self.edges[rows] - np.cumsum(n) + n, n) + np.arange(n.sum())
        self.best.add(np.repeat(query, n), self.flat[each], np.repeat(score, n))

    def descend(self, number: int, who: np.ndarray) -> None:
        node = self.nodes[number]
        if not len(who):
            return
        if node["vantage"] < 0:
            self.leaf(node["start"], node["stop"], who)
            self.flush()
            return
        near = self.to_vantage[who - self.start, number] <= (node["near_hi"] + node["far_lo"]) / 2
        self.descend(node["near"], who[near])
        self.descend(node["far"], who[~near])

    def visit(self, number: int, who: np.ndarray) -> None:
        node = self.nodes[number]
        if node["vantage"] < 0:
            self.leaf(node["start"], node["stop"], who)
            return
        d = self.to_vantage[who - self.start, number]
        for child in ("near", "far"):
            least = np.maximum(node[f"{child}_lo"] - d, d - node[f"{child}_hi"])
            left = self.factor * (least - SLACK) <= self.limit(who)
            some = who if left.all() else who[left]
            if len(some):
                self.visit(node[child], some)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``; sums run from first to last component."""

    def dot(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.cumsum(x * y, axis=1)[:, -1]

    a, b = even(a), even(b)
    return np.clip(dot(a, b) / np.sqrt(dot(a, a) * dot(b, b)), -1.0, 1.0)


def usable(vector: str) -> Column:
    """Not null, with finite components that are not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def keyed(vectors: DataFrame) -> DataFrame:
    """``vec_id``, the vector, in double precision unless it is given in single, and a key that equal vectors share."""
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    kind = "float" if single else "double"
    plain = vectors.filter(usable("embedding") & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        # Adding zero turns the negative zero into the positive one.
        F.transform(F.col("embedding").cast(f"array<{kind}>"), lambda x: x + F.lit(0.0).cast(kind)).alias("vector"),
    )
    key = F.concat_ws(":", F.size("vector"), F.hex(F.xxhash64("vector")), F.hex(F.hash("vector")))
    return plain.withColumn("key", key)


INDEX = "shard int, dim int, ids array<array<bigint>>, vectors binary, nodes binary, leaves binary"


def build_index(vectors: DataFrame, k: int, shard: int = SHARD) -> tuple[DataFrame, int]:
    """A tree for each shard, and the number of shards. All usable vectors are in it."""
    of_vector = W.partitionBy("key").orderBy("vec_id")
    few = vectors.select("key", "vec_id").distinct().withColumn("_n", F.row_number().over(of_vector)).filter(F.col("_n") <= k + 1)
    ids = stored(few.groupBy("key").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ids")
    shards = max(1, -(-ids.count() // shard))
    number = F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")
    distinct = vectors.groupBy("key").agg(F.first("vector").alias("vector")).join(ids.hint("merge"), "key")
    # A shard and dimension has about ``shard`` rows at most, as keys are spread evenly.
    grouped = distinct.groupBy(number.alias("shard"), F.size("vector").alias("dim")).agg(
        F.collect_list(F.struct("ids", "vector")).alias("rows")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.column("rows")[i].values
                data = rows.field("vector").flatten().to_numpy().reshape(len(rows), -1)
                nodes, order = build(normalized(data.astype("f8")))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(i, 1) for c in ("shard", "dim")),
                        pa.array([rows.field("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))),
                        *(pa.array([x.tobytes()], pa.binary()) for x in (data, nodes, order)),
                    ],
                    ["shard", "dim", "ids", "vectors", "nodes", "leaves"],
                )

    index = stored(grouped.mapInArrow(run, INDEX), "trees")
    dropped(vectors.sparkSession, ids)
    return index, shards


HITS = "key string, vec_id bigint, score double"


def best_ids(who: np.ndarray, ids: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Positions of the ``most`` best different ids of each query, best first; ties go to the smaller id."""
    by = np.lexsort((-score, ids, who))
    first = np.ones(len(by), bool)
    first[1:] = (who[by][1:] != who[by][:-1]) | (ids[by][1:] != ids[by][:-1])
    by = by[first]
    by = by[np.lexsort((ids[by], -score[by], who[by]))]
    edge = np.searchsorted(who[by], who[by])
    return by[np.arange(len(by)) - edge < most]


class Band:
    """The queries of one task and dimension."""

    def __init__(self, dim: int, most: int, factor: float):
        self.dim, self.most, self.factor = dim, most, factor
        self.keys: list[pa.Array] = []
        self.vectors: list[np.ndarray] = []
        self.best: Best | None = None

    def ask(self, queries: pa.Array) -> None:
        self.keys.append(pa.concat_arrays([queries.field("key")]))
        self.vectors.append(queries.field("vector").flatten().to_numpy().reshape(len(queries), -1).copy())

    def search(self, row: dict[str, pa.Scalar]) -> None:
        if self.best is None:
            if not self.vectors:
                return
            self.queries = np.concatenate(self.vectors)
            self.vectors.clear()
            self.best = Best(len(self.queries), self.most)
        nodes, order = np.frombuffer(row["nodes"].as_py(), NODE), np.frombuffer(row["leaves"].as_py(), "<i4")
        data = row["vectors"].as_buffer()
        data = np.frombuffer(data, f"<f{data.size // (len(order) * self.dim)}").reshape(-1, self.dim)
        lists = row["ids"].values
        ids = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        # A loose search that went on from the bounds of other trees would skip more than within its own.
        own = self.best if self.factor <= 1 else Best(len(self.queries), self.most)
        Search(normalized(data.astype("f8")), nodes, order, self.queries, self.most, self.factor, ids, data, own)
        if own is not self.best:
            self.best.add(*own.hits(np.arange(len(self.queries))))

    def found(self) -> Iterator[pa.RecordBatch]:
        start = 0
        for keys in self.keys if self.best else ():
            query, ids, score = self.best.hits(np.arange(start, start + len(keys)))
            start += len(keys)
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(query)), pa.array(ids), pa.array(score)], ["key", "vec_id", "score"])


def search(index: DataFrame, shards: int, queries: DataFrame, k: int, factor: float, block: int = BLOCK) -> DataFrame:
    """The ``k`` + 1 best ids of each column of shards for each distinct query: ``key``, ``vec_id``, cosine."""
    size = queries.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(1)).alias("dim")).first()
    blocks = max(1, -(-size.n // block))
    in_band = max(1, BAND // (8 * size.dim * block))
    bands = -(-blocks // in_band)
    cores = index.sparkSession.sparkContext.defaultParallelism
    columns = min(shards, max(-(-TASKS * cores // bands), -(-shards // max(1, COLUMN // (8 * size.dim * SHARD)))))
    number = F.pmod(F.hash("key"), F.lit(blocks))
    asked = (
        queries.groupBy(number.alias("block"), F.size("vector").alias("dim"))
        .agg(F.collect_list(F.struct("key", "vector")).alias("queries"))
        .withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
        .withColumn("cell", F.floor(F.col("block") / in_band).cast("int") * columns + F.col("column"))
        .select("cell", "dim", "queries")
    )
    trees = index.withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(bands - 1)))).select(
        (F.col("band") * columns + F.pmod("shard", F.lit(columns))).alias("cell"), "dim", "ids", "vectors", "nodes", "leaves"
    )
    # Nulls first: a cell's queries come before its trees.
    cells = (
        asked.unionByName(trees, allowMissingColumns=True)
        .repartitionById(bands * columns, "cell")
        .sortWithinPartitions("cell", "dim", F.col("vectors").isNotNull())
    )
    most = k + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, band = None, Band(0, most, factor)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                if at != (at := (row["cell"].as_py(), row["dim"].as_py())):
                    yield from band.found()
                    band = Band(at[1], most, factor)
                if row["vectors"].is_valid:
                    band.search(row)
                else:
                    band.ask(row["queries"].values)
        yield from band.found()

    return cells.mapInArrow(run, HITS)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, factor: float = FACTOR) -> DataFrame:
    """The ``k`` nearest rows of ``vectors`` for each row of ``queries``, without its own id.

    Both have ``vec_id`` and ``embedding``. Vectors that are null, zero, or hold null or
    infinite components take no part, nor do rows without an id; vectors of other dimensions are not
    compared. Rows of equal id and vector count once; equal cosines are ranked by id.
    """
    rows = keyed(queries)
    distinct = stored(rows.groupBy("key").agg(F.first("vector").alias("vector")), "queries")
    index, shards = build_index(keyed(vectors), k)
    hits = search(index, shards, distinct, k, factor)
    best = W.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    merged = (
        hits.groupBy("key", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("_n", F.row_number().over(best))
        .filter(F.col("_n") <= k + 1)
        .groupBy("key")
        .agg(F.collect_list(F.struct("vec_id", "score")).alias("hits"))
    )
    asked = rows.select(F.col("vec_id").alias("query_id"), "key").distinct()
    # A query of several vectors has one score for each id, the best. How many hits there are is not in Spark's estimates.
    pairs = (
        asked.join(merged.hint("merge"), "key")
        .select("query_id", F.inline("hits"))
        .filter("vec_id <> query_id")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    by_score = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
