"""Mixing sources to target weights by Poisson replication.

A source of size ``s`` that is to have the share ``w`` of a mix of size ``t`` has the mean repetition
rate ``t * w / s``. Each document's number of copies inverts the Poisson distribution of that mean at
a number between 0 and 1 hashed from the seed and the document's id, so shares hold in expectation,
reruns agree, and each document is decided without looking at another. A mean over ``PART`` is drawn
as a sum of independent parts. The copies are dealt to tasks by a hash and sorted there by another,
which is a global shuffle without a pass that samples for bounds.

A document's size is its length in characters plus one, so every source has some. Without
given weights a source weighs the square root of its size, rounded down. A null source is a source
of its own; sources missing from given weights get no copies; rows of equal id get equal counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitals.llm.tables import stored, text_of

SEED = "mix-1"
PART = 8
# A Poisson number of mean 8 exceeds this with a probability below 1e-34.
TERMS = 64
MOST_BROADCAST_BYTES = 16 << 20


def hashed(seed: str, *parts: Column, digits: int) -> Column:
    """A number of ``4 * digits`` bits from the seed and the parts."""
    key = F.concat_ws(":", F.lit(seed), *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    return F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, digits), 16, 10).cast("bigint")


def cumulative(mean: Column) -> Column:
    """Distribution function of a Poisson number at 0, 1, ... as an array."""
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("all"))

    def term(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        c = acc["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.concat(acc["all"], F.array(c)).alias("all"))

    steps = F.transform(F.sequence(F.lit(1), F.lit(TERMS - 1)), lambda k: k.cast("double"))
    return F.aggregate(steps, start, term, lambda acc: acc["all"])


def plan(docs: DataFrame, weights: DataFrame | None = None, factor: float = 1.0) -> DataFrame:
    """Per source: size, weight, mean repetition rate, and the distribution to invert."""
    size = (F.char_length(text_of()) + 1).cast("bigint")
    sizes = docs.select("source", size.alias("_size")).groupBy("source").agg(F.sum("_size").alias("size"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.floor(F.sqrt("size")))
    else:
        given = weights.select(F.col("source").alias("_source"), F.col("weight").cast("bigint").alias("weight"))
        weighed = sizes.join(given, F.col("source").eqNullSafe(F.col("_source")), "left").select(
            "source", "size", F.coalesce("weight", F.lit(0)).cast("bigint").alias("weight")
        )
    weighed = stored(weighed, "sources")
    whole = weighed.agg(F.sum("size"), F.sum("weight")).first()
    total, weight = (float(x or 0) for x in whole)
    mean = F.lit(total * factor) * F.col("weight").cast("double") / (F.lit(max(weight, 1.0)) * F.col("size").cast("double"))
    return (
        weighed.withColumn("mean", mean)
        .withColumn("parts", F.greatest(F.ceil(F.col("mean") / PART), F.lit(1)).cast("int"))
        .withColumn("cumulative", cumulative(F.col("mean") / F.col("parts")))
    )


def copies(cumulative: Column, parts: Column, doc_id: Column, seed: str) -> Column:
    def draw(part: Column) -> Column:
        u = hashed(seed, doc_id, part, digits=13).cast("double") / F.lit(float(1 << 52))
        return F.aggregate(cumulative, F.lit(0), lambda n, c: n + F.when(c <= u, 1).otherwise(0))

    return F.aggregate(F.transform(F.sequence(F.lit(1), parts), draw), F.lit(0), lambda a, n: a + n)


def replicate(
    docs: DataFrame, weights: DataFrame | None = None, factor: float = 1.0, seed: str = SEED
) -> DataFrame:
    """Copies of the rows in random order, with ``copy`` from 1 and the ``shuffle_key`` of the order.

    ``weights``: ``source`` and an integer ``weight``; ``factor``: size of the mix against the input.
    """
    docs = docs.drop("copy", "shuffle_key")
    sources = plan(docs, weights, factor).select("source", "parts", "cumulative")
    names = sources.agg(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 8 * TERMS + 64)).first()[0] or 0
    if names <= MOST_BROADCAST_BYTES:
        sources = F.broadcast(sources)
    n = copies(F.col("cumulative"), F.col("parts"), F.col("row.doc_id"), seed)
    # The row goes as one struct, so its columns may have any names.
    rows = docs.select(F.struct("*").alias("row"))
    counted = rows.join(sources, F.col("row.source").eqNullSafe(F.col("source"))).select("row", n.alias("n"))
    repeated = counted.filter("n > 0").select("row.*", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    keyed = repeated.withColumn("shuffle_key", hashed(seed + "#", F.col("doc_id"), F.col("copy"), digits=15))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key", "doc_id", "copy")
