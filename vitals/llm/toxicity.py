"""Toxicity score by a convolutional network over hashed word embeddings, in numpy.

A word's vector is the sum of the vectors of its features: the word and its beginnings of
``wordhash.PREFIXES`` bytes, each hashed into one of ``BUCKETS``. Filters of several widths slide
over the words, the largest response of each over the whole text is kept, and these are combined
into one probability. Everything is learned together from all labelled rows that are not held out;
only the ``KEPT`` buckets whose presence tells the label best there have a vector, so rare and
indifferent words add nothing.

Rows are coded once and dealt to shards of about ``SHARD_ROWS``. In each epoch every shard is a task's own
gradient descent from the state (parameters and moments) that all share, and the mean of the shards' states,
weighted by their rows, starts the next epoch; one shard is plain gradient descent. Neither texts nor codes
reach the driver, only sums of states.

Labels' languages serve only to calibrate a threshold for each, at which the share of false alarms
among the learned rows stays below ``FALSE_ALARMS``; a language without enough rows has the common
threshold. Scores take nothing but the text. Scoring is row by row without a shuffle; null and
empty texts have no words and score zero; repeated rows get equal scores.
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals.functions.percentiles import percentile_table
from vitals.llm.bpe import Recent
from vitals.llm.learning import Adam, labelled_rows, logistic
from vitals.llm.tables import dropped, held_out, slices, stored, texts
from vitals.llm.wordhash import BUCKETS, PER_WORD, features, hashed

EPOCHS, BATCH, RATE, SEED = 6, 32, 0.02, 11
# Rows that are learned from between two averages, about, and the most bytes of coded texts.
SHARD_ROWS = 5_000
SHARD_BYTES = 64 << 20
MOST_FILES = 2_000
SHARDS_ADDED = 64
THRESHOLD = 0.5
FALSE_ALARMS = 0.005
LEAST_CALIBRATED = 50

LEAST_TEXTS = 6
# Buckets that have a vector.
KEPT = 1024
EMBEDDED = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
# Bytes of text whose words are hashed together; as many as the processor's caches hold.
TOGETHER = 1 << 20


def near(marked: np.ndarray, edges: np.ndarray, width: int) -> np.ndarray:
    """Places less than ``width`` away from a marked one of the same text."""
    text = np.searchsorted(edges, marked, side="right") - 1
    lowest, highest = edges[text], edges[text + 1] - 1
    return np.unique(np.concatenate([np.clip(marked + k, lowest, highest) for k in range(1 - width, width)]))


def rows_of(row: dict[int, int]) -> np.ndarray:
    """The row of each bucket's vector, 0 for none; ``BUCKETS`` stands for a missing feature."""
    found = np.zeros(BUCKETS + 1, np.int32)
    found[np.fromiter(row.keys(), np.int64, len(row))] = np.fromiter(row.values(), np.int32, len(row))
    return found


def live(ids: np.ndarray) -> np.ndarray:
    """The words with a vector."""
    return np.flatnonzero(np.bitwise_or.reduce([ids[:, k] for k in range(PER_WORD)]))


@dataclass
class Network:
    row: dict[int, int]  # bucket -> row of the embedding, from 1; row 0 stays zero
    embedding: np.ndarray  # (rows, EMBEDDED)
    filters: dict[int, np.ndarray]  # width -> (width, EMBEDDED, FILTERS)
    bias: dict[int, np.ndarray]
    weights: np.ndarray  # one for each filter, and a constant
    thresholds: dict[str, float] = field(default_factory=dict)

    def parameters(self) -> dict[str, np.ndarray]:
        found = {"embedding": self.embedding, "weights": self.weights}
        return found | {f"f{w}": self.filters[w] for w in WIDTHS} | {f"b{w}": self.bias[w] for w in WIDTHS}

    def responses(self, vectors: np.ndarray, width: int) -> np.ndarray:
        n = len(vectors) - width + 1
        return sum(vectors[k : k + n] @ self.filters[width][k] for k in range(width))

    def pooled(self, ids: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Largest response of each filter in each of the texts, whose coded words lie between ``edges``;
        texts are padded so that each filter fits."""
        pad = WIDTHS[-1] - 1
        # Most words carry nothing: only windows that touch one that does can differ from zero.
        marked = live(ids)
        vectors = np.concatenate([np.zeros((1, EMBEDDED), np.float32), self.embedding[ids[marked]].sum(1)])
        starts_of = edges[:-1] + 2 * pad * np.arange(len(edges) - 1)
        places = marked + pad + 2 * pad * (np.searchsorted(edges, marked, side="right") - 1)
        at = np.zeros(edges[-1] + 2 * pad * (len(edges) - 1), np.int32)
        at[places] = np.arange(1, len(places) + 1)
        out = np.zeros((len(edges) - 1, FILTERS * len(WIDTHS)), np.float32)
        for i, width in enumerate(WIDTHS):
            starts = np.unique(np.concatenate([places - k for k in range(width)]))
            ends = np.searchsorted(starts, np.append(starts_of, len(at)))
            some = np.flatnonzero(ends[1:] > ends[:-1])
            largest = np.zeros((len(out), FILTERS), np.float32)
            if len(some):
                sums = sum(
                    by_text(vectors[at[starts + k]], self.filters[width][k], ends[some], ends[some + 1]) for k in range(width)
                )
                largest[some] = np.maximum(np.maximum.reduceat(sums, ends[some], axis=0), 0)
            out[:, i * FILTERS : (i + 1) * FILTERS] = np.maximum(largest + self.bias[width], 0)
        return out

    def probabilities(self, ids: np.ndarray, edges: np.ndarray) -> np.ndarray:
        weights = self.weights[:-1].astype(np.float64)
        logits = np.array([own @ weights for own in self.pooled(ids, edges).astype(np.float64)], np.float64)
        return logistic(logits + float(self.weights[-1]))

    def scores(self) -> Callable[[Sequence[str]], np.ndarray]:
        """Scores texts together; those without words get zero."""
        row = rows_of(self.row)

        def score(some: Sequence[str]) -> np.ndarray:
            found, edges = hashed([t.encode() for t in some])
            return np.where(edges[1:] > edges[:-1], self.probabilities(row[found], edges), 0.0)

        return score

    def scorer(self) -> Callable[[str], float]:
        score = self.scores()
        return lambda text: float(score([text])[0])


def by_text(vectors: np.ndarray, matrix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The product with a matrix, text by text: its rounding may depend on the number of rows, and a score must
    not depend on the texts beside its own."""
    out = np.empty((len(vectors), matrix.shape[1]), np.float32)
    for a, b in zip(starts.tolist(), ends.tolist()):
        np.matmul(vectors[a:b], matrix, out=out[a:b])
    return out


def telling(words: Sequence[Sequence[bytes]], labels: np.ndarray, kept: int = KEPT) -> list[int]:
    """The buckets whose presence in a text tells its label best, by chi-square, of those that
    occur in ``LEAST_TEXTS`` texts."""
    of_word = Recent(features, 1 << 20)
    counts: dict[int, list[int]] = {}
    for own, y in zip(words, labels.astype(int).tolist()):
        for b in {b for w in set(own) for b in of_word[w]}:
            counts.setdefault(b, [0, 0])[y] += 1
    buckets = [b for b, n in counts.items() if sum(n) >= LEAST_TEXTS]
    if not buckets:
        return []
    n = np.array([counts[b] for b in buckets], np.float64)
    texts_of = np.array([(labels == 0).sum(), (labels == 1).sum()], np.float64)
    share = n.sum(1, keepdims=True) / texts_of.sum()
    expected = share * texts_of
    chi = ((n - expected) ** 2 / np.maximum(expected * (1 - share), 1e-9)).sum(1)
    return [buckets[i] for i in np.lexsort((buckets, -chi))[:kept]]


def coder(row: dict[int, int]) -> Callable[[Sequence[bytes]], tuple[list[np.ndarray], np.ndarray]]:
    """Turns the words of texts into rows of the embedding, ``PER_WORD`` a word with 0 for features without one, and
    tells which texts have words. Words too far from any that has a vector are left out: their windows respond with zero
    and need not be looked at."""
    own = rows_of(row)

    def code(some: Sequence[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        found, edges = hashed(some)
        ids = own[found]
        kept = near(live(ids), edges, WIDTHS[-1])
        return np.split(ids[kept], np.searchsorted(kept, edges[1:-1])), edges[1:] > edges[:-1]

    return code


def started(row: dict[int, int], share: float | None, rng: np.random.Generator) -> Network:
    """A network before its first step; without a share of toxic texts all that it scores is one half."""
    n_filters = FILTERS * len(WIDTHS)
    net = Network(
        row,
        rng.normal(0, 0.1, (len(row) + 1, EMBEDDED)).astype(np.float32),
        {w: rng.normal(0, (w * EMBEDDED) ** -0.5, (w, EMBEDDED, FILTERS)).astype(np.float32) for w in WIDTHS},
        {w: np.full(FILTERS, 0.01, np.float32) for w in WIDTHS},
        np.zeros(n_filters + 1, np.float32),
    )
    net.embedding[0] = 0
    if share is not None:
        share = np.clip(share, 0.01, 0.99)
        net.weights[:-1] = rng.normal(0, 0.3, n_filters)
        net.weights[-1] = np.log(share / (1 - share))
    return net


def gradients_of(net: Network, ids: Sequence[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean loss of coded texts, all of which are laid side by side with words of zero between."""
    pad = WIDTHS[-1] - 1
    sizes = np.array([len(i) + 2 * pad for i in ids])
    ends = np.cumsum(sizes)
    edges = ends - sizes
    own = np.zeros((ends[-1], PER_WORD), np.int32)
    for i, at in zip(ids, edges + pad):
        own[at : at + len(i)] = i
    vectors = net.embedding[own].sum(1)
    doc = np.repeat(np.arange(len(ids)), sizes)
    best, top = {}, []
    for w in WIDTHS:
        sums = net.responses(vectors, w)
        for k in range(1, w):  # windows that reach into the next text
            sums[(ends - k)[:-1]] = -np.inf
        largest = np.maximum.reduceat(sums, edges, axis=0)
        at, f = np.nonzero(sums == largest[doc[: len(sums)]])
        best[w] = np.empty(largest.shape, np.int64)
        best[w][doc[at][::-1], f[::-1]] = at[::-1]  # the first of equal ones is written last
        top.append(largest + net.bias[w])
    hidden = np.concatenate(top, axis=1)
    active = hidden > 0
    hidden = np.where(active, hidden, 0)
    error = (logistic(hidden @ net.weights[:-1] + net.weights[-1]) - labels) / len(ids)
    gradients = {"weights": np.append(error @ hidden, error.sum()).astype(np.float32)}
    down = (error[:, None] * net.weights[:-1] * active).astype(np.float32)
    rows, parts = [], []
    for w, g in zip(WIDTHS, np.split(down, len(WIDTHS), axis=1)):
        gradients[f"b{w}"] = g.sum(0)
        gradients[f"f{w}"] = np.stack([np.einsum("dfe,df->ef", vectors[best[w] + k], g) for k in range(w)])
        for k in range(w):
            back = g[:, :, None] * net.filters[w][k].T  # (texts, FILTERS, EMBEDDED)
            rows.append(own[best[w] + k].reshape(-1, PER_WORD))
            parts.append(back.reshape(-1, EMBEDDED))
    rows, back = np.concatenate(rows), np.concatenate(parts)
    at, slot = np.nonzero(rows)
    cells = rows[at, slot][:, None] * EMBEDDED + np.arange(EMBEDDED)
    seen = np.bincount(cells.ravel(), back[at].ravel(), net.embedding.size)
    gradients["embedding"] = seen.reshape(net.embedding.shape).astype(np.float32)
    return gradients


def passed(net: Network, adam: Adam, ids: Sequence[np.ndarray], labels: np.ndarray, order: np.ndarray, batch: int) -> int:
    """One pass over coded texts in an order; returns the number of steps."""
    groups = np.array_split(order, max(1, len(order) // batch))
    for some in groups:
        adam.update(gradients_of(net, [ids[i] for i in some], labels[some]))
    return len(groups)


def annealed(rate: float, epoch: int, epochs: int) -> float:
    return rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))


def train(rows: Sequence[tuple], epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, seed: int = SEED) -> Network:
    """Fits the network to the (text, label, language) rows of one process and calibrates thresholds by
    language; ``fit`` does the same for tables."""
    rng = np.random.default_rng(seed)
    words = [t.encode().split() for t, *_ in rows]
    labels = np.array([y for _, y, *_ in rows], np.float64)
    row = {b: i for i, b in enumerate(sorted(telling(words, labels)), 1)}
    code = coder(row)
    ids = [code([t.encode()])[0][0] for t, *_ in rows]
    known = [i for i in range(len(rows)) if words[i]]
    net = started(row, labels[known].mean() if known else None, rng)
    if not known:
        return net
    adam = Adam(net.parameters(), rate)
    for epoch in range(epochs):
        adam.rate = annealed(rate, epoch, epochs)
        passed(net, adam, ids, labels, rng.permutation(known), batch)
    score = net.scorer()
    net.thresholds = calibrated([(score(t), y, rest[0] if rest else "") for t, y, *rest in rows])
    return net


def calibrated(scores: Sequence[tuple[float, int, str]]) -> dict[str, float]:
    """For each language the least threshold, at least ``THRESHOLD``, that at most
    ``FALSE_ALARMS`` of its harmless texts reach; "" holds for all others."""

    def least(harmless: list[float]) -> float:
        ranked = np.sort(harmless)[::-1]
        allowed = int(FALSE_ALARMS * len(ranked))
        return max(THRESHOLD, float(np.nextafter(ranked[allowed], 2))) if len(ranked) > allowed else THRESHOLD

    by_language: dict[str, list[float]] = {"": [s for s, y, _ in scores if not y]}
    for s, y, language in scores:
        if not y and language:
            by_language.setdefault(language, []).append(s)
    return {k: least(v) for k, v in by_language.items() if k == "" or len(v) >= LEAST_CALIBRATED}


def bucket_counts(rows: DataFrame) -> DataFrame:
    """For each bucket the harmless and the toxic texts in which it occurs; bucket ``BUCKETS`` is in every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS + 1), np.int64)
        last = np.zeros(BUCKETS + 1, np.int64)
        for batch in slices(batches, TOGETHER):
            found, edges = hashed([t.encode() for t in texts(batch)])
            for y, a, b in zip(batch.column("label").to_pylist(), edges, edges[1:]):
                own = found[a:b].ravel()
                place = np.arange(len(own))
                last[own] = place
                own = own[last[own] == place]  # each bucket once
                counts[y, own[own < BUCKETS]] += 1
                counts[y, BUCKETS] += 1
        seen = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (seen, *counts[:, seen])], ["bucket", "harmless", "toxic"])

    own = rows.select("text", "label").mapInArrow(run, "bucket long, harmless long, toxic long")
    return own.groupBy("bucket").agg(F.sum("harmless").alias("harmless"), F.sum("toxic").alias("toxic"))


def telling_of(counts: DataFrame, harmless: int, toxic: int, kept: int = KEPT) -> list[int]:
    """``telling`` from counts of all texts."""
    total = harmless + toxic
    share = (F.col("harmless") + F.col("toxic")) / F.lit(float(total))

    def part(column: str, n: int) -> Column:
        off = F.col(column) - share * n
        return off * off / F.greatest(share * n * (1 - share), F.lit(1e-9))

    chi = part("harmless", harmless) + part("toxic", toxic)
    found = counts.filter((F.col("bucket") < BUCKETS) & (F.col("harmless") + F.col("toxic") >= LEAST_TEXTS))
    return [r.bucket for r in found.select("bucket", chi.alias("chi")).orderBy(F.desc("chi"), "bucket").limit(kept).collect()]


def coded(rows: DataFrame, row: dict[int, int], shards: int) -> DataFrame:
    """The texts coded and dealt to shards by a hash, each shard in one order wherever its rows come from."""
    shared = rows.sparkSession.sparkContext.broadcast(row)
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "id", "tie"), F.lit(shards)).cast("int"))
    kept = [f for f in dealt.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, T.StructField("known", T.BooleanType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(shared.value)
        for batch in slices(batches, TOGETHER):
            ids, known = code([t.encode() for t in texts(batch)])
            made = [pa.array(known, pa.bool_()), pa.array([i.tobytes() for i in ids], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + made, schema.names)

    found = dealt.mapInArrow(run, schema).repartition(min(shards, MOST_FILES), "shard")
    return found.sortWithinPartitions("shard", "order", "id", "label", "tie")


def shard_runs(batches: Iterable[pa.RecordBatch], rows: int, size: int) -> Iterator[tuple[int, list[bytes], list[int]]]:
    """Neighbouring rows of one shard; what is far longer than a shard should be comes in several runs."""
    shard, ids, labels, held = None, [], [], 0
    for batch in batches:
        for s, i, y in zip(*(batch.column(c).to_pylist() for c in ("shard", "ids", "label"))):
            if ids and (s != shard or len(ids) >= rows or held + len(i) > size):
                yield shard, ids, labels
                ids, labels, held = [], [], 0
            shard = s
            ids.append(i)
            labels.append(y)
            held += len(i)
    if ids:
        yield shard, ids, labels


def averaged(found: DataFrame) -> tuple[np.ndarray, float]:
    """Mean of the shards' states, weighted by their rows, and of their steps. Blocks of shards are summed first,
    all in order of the shards, so the result is the same wherever they ran."""

    def add(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["shard", "rows", "state"])
        state = sum(np.frombuffer(s, np.float32).astype(np.float64) * n for s, n in zip(own.state, own.rows))
        steps = float((own.steps * own.rows).sum())
        return pd.DataFrame({"block": [key[0]], "rows": [own.rows.sum()], "steps": [steps], "state": [state.tobytes()]})

    blocks = found.withColumn("block", F.floor(F.col("shard") / SHARDS_ADDED))
    parts = blocks.groupBy("block").applyInPandas(add, "block long, rows long, steps double, state binary").collect()
    parts.sort(key=lambda p: p.block)
    rows = sum(p.rows for p in parts)
    return sum(np.frombuffer(p.state) for p in parts) / rows, sum(p.steps for p in parts) / rows


def epoch_over(texts_of: DataFrame, net: Network, adam: Adam, rng: np.random.Generator, epoch: int, batch: int, most: int) -> None:
    """A pass over all coded texts: each shard goes on from the same state, and their mean is the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, raw, labels in shard_runs(batches, most, SHARD_BYTES):
            own, learner, random = copy.deepcopy((net, adam, rng))
            ids = [np.frombuffer(i, np.int32).reshape(-1, PER_WORD) for i in raw]
            for _ in range(epoch + 1):
                order = random.permutation(list(range(len(ids))))
            steps = passed(own, learner, ids, np.array(labels, np.float64), order, batch)
            made = [[shard], [len(ids)], [steps], [learner.state().tobytes()]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(made, (pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                ["shard", "rows", "steps", "state"],
            )

    found = texts_of.mapInArrow(run, "shard int, rows long, steps long, state binary")
    state, steps = averaged(found)
    adam.restore(state)
    adam.step += round(steps)


def thresholds_of(rows: DataFrame, net: Network) -> dict[str, float]:
    """``calibrated`` over coded texts of any number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw = batch.column("ids").to_pylist()
            edges = np.cumsum([0, *(len(i) // (4 * PER_WORD) for i in raw)])
            found = net.probabilities(np.frombuffer(b"".join(raw), np.int32).reshape(-1, PER_WORD), edges)
            scores = np.where(batch.column("known").to_numpy(zero_copy_only=False), found, 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(scores, pa.float64())], ["lang", "score"])

    harmless = rows.filter("label = 0").select("lang", "known", "ids")
    scores = stored(harmless.mapInArrow(run, "lang string, score double"), "toxicity-scores")
    both = scores.select(F.explode(F.array(F.lit(""), F.nullif("lang", F.lit("")))).alias("lang"), "score").filter("lang IS NOT NULL")
    ranked = percentile_table(both, ["lang"], [F.count("*").alias("n")], {"least": ("score", 1 - FALSE_ALARMS)})
    least = {r.lang: r.least for r in ranked.filter((F.col("lang") == "") | (F.col("n") >= LEAST_CALIBRATED)).collect()}
    dropped(rows.sparkSession, scores)
    return {"": THRESHOLD} | {k: max(THRESHOLD, float(np.nextafter(v, 2))) for k, v in least.items()}


def fit(
    docs: DataFrame,
    labels: DataFrame,
    epochs: int = EPOCHS,
    batch: int = BATCH,
    rate: float = RATE,
    seed: int = SEED,
    shard_rows: int = SHARD_ROWS,
) -> Network:
    """Fits the network to every labelled row that is not held out. Buckets are chosen by counts of all these rows,
    each of the ``epochs`` passes over all of them, and thresholds are ranks among all their scores."""
    spark = docs.sparkSession
    rows = stored(labelled_rows(docs, labels, "toxic", ("lang",)), "toxicity-texts")
    counts = stored(bucket_counts(rows), "toxicity-counts")
    total = counts.filter(F.col("bucket") == BUCKETS).first()
    harmless, toxic = (total.harmless, total.toxic) if total else (0, 0)
    row = {b: i for i, b in enumerate(sorted(telling_of(counts, harmless, toxic) if total else []), 1)}
    coded_rows = stored(coded(rows, row, max(1, -(-(harmless + toxic) // shard_rows))), "toxicity-rows")
    dropped(spark, rows, counts)
    known = coded_rows.filter("known")
    n, positive = known.agg(F.count("*"), F.sum("label")).first()
    rng = np.random.default_rng(seed)
    net = started(row, positive / n if n else None, rng)
    if n:
        adam = Adam(net.parameters(), rate)
        for epoch in range(epochs):
            adam.rate = annealed(rate, epoch, epochs)
            epoch_over(known.select("shard", "ids", "label"), net, adam, rng, epoch, batch, 2 * shard_rows)
        net.thresholds = thresholds_of(coded_rows, net)
    dropped(spark, coded_rows)
    return net


def scored(docs: DataFrame, network: Network, name: str = "score") -> DataFrame:
    """Adds the probability that a text is toxic; a column of that name is replaced."""
    kept = docs.drop(name)
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType(), False)])
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scores()
        for batch in slices(batches, TOGETHER):
            found = pa.array(score(texts(batch)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, name])

    return kept.mapInArrow(run, schema)


def flagged(score: Column, language: Column, thresholds: dict[str, float]) -> Column:
    """Whether a score reaches the threshold of its language."""
    least = F.lit(thresholds.get("", THRESHOLD))
    for name, threshold in thresholds.items():
        if name:
            least = F.when(language == name, F.lit(threshold)).otherwise(least)
    return score >= least


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    network = fit(docs, labels)
    found = scored(docs.select("doc_id", "text", "lang"), network)
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        flagged(F.col("score"), F.col("lang"), network.thresholds).alias("flagged"),
    )
