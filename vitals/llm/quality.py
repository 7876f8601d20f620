"""Quality score by a convolutional network over bytes, in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it; the last chunk ends with
the text, and a text shorter than a chunk is repeated to fill one. Bytes are embedded, filters of
``WIDTH`` bytes slide over each chunk byte by byte, and each filter's largest response is kept. The largest and
the mean of these over the chunks are combined into one probability, so both a single bad passage
and the share of bad passages can tell.

Embedding, filters and combination are learned together from a bounded sample of labelled rows; a
gradient only reaches the windows that were largest. When scoring, the sum over a filter's
bytes is looked up for two bytes at a time.

Scoring is row by row without a shuffle. Null and empty texts score zero; repeated rows get equal
scores; labels, language, source and id are no inputs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals.llm.learning import Adam, labelled_sample, logistic
from vitals.llm.tables import held_out, slices, texts

# Bounds of the sample that the network is fitted on.
TRAIN_ROWS = 6000
TRAIN_CHARS = 50_000
THRESHOLD = 0.3

WIDTH = 6
CHUNK, HOP = 512, 448
FILTERS, EMBEDDED = 16, 8
POSITIONS = CHUNK - WIDTH + 1
PAIRS = range(0, WIDTH, 2)
AT_ONCE = 64


def chunked(raw: bytes) -> np.ndarray:
    """The chunks of a text as rows of byte pairs, one pair at each byte but the last."""
    if len(raw) < CHUNK:
        raw = (raw * (CHUNK // len(raw) + 1))[:CHUNK] if raw else bytes(CHUNK)
    data = np.frombuffer(raw, np.uint8)
    last = len(data) - CHUNK
    starts = np.append(np.arange(0, last, HOP), last)
    at = starts[:, None] + np.arange(CHUNK - 1)
    return data[at].astype(np.uint16) << 8 | data[at + 1]


def responses(tables: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Response of each filter at each byte of each chunk: (chunks, POSITIONS, FILTERS)."""
    sums = tables[0][pairs[:, :POSITIONS]]
    for table, k in zip(tables[1:], PAIRS[1:]):
        sums += table[pairs[:, k : k + POSITIONS]]
    return sums


@dataclass
class Network:
    embedding: np.ndarray  # (256, EMBEDDED)
    filters: np.ndarray  # (WIDTH, EMBEDDED, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    weights: np.ndarray  # (2 * FILTERS + 1,): of the largest, of the mean, constant

    def tables(self) -> list[np.ndarray]:
        """Response of each pair of bytes at each place of a filter: (65536, FILTERS) for each."""
        single = np.einsum("be,wef->wbf", self.embedding, self.filters)
        return [
            (single[w][:, None] + single[w + 1][None]).reshape(1 << 16, FILTERS).astype(np.float32)
            for w in PAIRS
        ]

    def pooled(self, tables: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
        """Largest response of each filter in each chunk: (chunks, FILTERS)."""
        out = np.empty((len(pairs), FILTERS), np.float32)
        for at in range(0, len(pairs), AT_ONCE):
            part = pairs[at : at + AT_ONCE]
            sums = responses(tables, part)
            out[at : at + AT_ONCE] = sums.max(1)
        return np.maximum(out + self.bias, 0)

    def probabilities(self, rows: Sequence[str]) -> np.ndarray:
        tables = self.tables()
        return self.score(tables, rows)

    def score(self, tables: list[np.ndarray], rows: Sequence[str]) -> np.ndarray:
        out = np.zeros(len(rows))
        full = [i for i, t in enumerate(rows) if t]
        if not full:
            return out
        pairs = [chunked(rows[i].encode()) for i in full]
        sizes = np.array([len(p) for p in pairs])
        edges = np.cumsum(sizes) - sizes
        pooled = self.pooled(tables, np.concatenate(pairs)).astype(np.float64)
        largest = np.maximum.reduceat(pooled, edges, axis=0)
        mean = np.add.reduceat(pooled, edges, axis=0) / sizes[:, None]
        logits = np.concatenate([largest, mean], axis=1) @ self.weights[:-1].astype(np.float64) + float(self.weights[-1])
        out[full] = logistic(logits)
        return out


def train(rows: Sequence[tuple[str, int]], epochs: int = 6, batch: int = 32, rate: float = 0.01, seed: int = 7) -> Network:
    """Fits the network; with no rows, or one class only, it stays near the share of that class."""
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.5, (256, EMBEDDED)).astype(np.float32),
        rng.normal(0, (WIDTH * EMBEDDED) ** -0.5, (WIDTH, EMBEDDED, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        np.zeros(2 * FILTERS + 1, np.float32),
    )
    rows = [(t, y) for t, y in rows if t]
    if not rows:
        return net
    share = np.clip(np.mean([y for _, y in rows]), 0.01, 0.99)
    net.weights[:-1] = rng.normal(0, 0.1, 2 * FILTERS)
    net.weights[-1] = np.log(share / (1 - share))
    adam = Adam(vars(net), rate)
    labels = np.array([y for _, y in rows], np.float64)
    for epoch in range(epochs):
        adam.rate = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for some in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // batch)):
            pairs = [chunked(rows[i][0].encode()) for i in some]
            sizes = np.array([len(p) for p in pairs])
            edges, codes = np.cumsum(sizes) - sizes, np.concatenate(pairs)
            tables, best = net.tables(), np.empty((len(codes), FILTERS), np.int64)
            pooled = np.empty((len(codes), FILTERS), np.float32)
            for at in range(0, len(codes), AT_ONCE):
                part = codes[at : at + AT_ONCE]
                sums = responses(tables, part)
                best[at : at + AT_ONCE] = sums.argmax(1)
                pooled[at : at + AT_ONCE] = np.take_along_axis(sums, sums.argmax(1)[:, None], 1)[:, 0]
            active = pooled + net.bias > 0
            pooled = np.where(active, pooled + net.bias, 0)
            doc = np.repeat(np.arange(len(some)), sizes)
            largest = np.maximum.reduceat(pooled, edges, axis=0)
            mean = np.add.reduceat(pooled, edges, axis=0) / sizes[:, None]
            features = np.concatenate([largest, mean, np.ones((len(some), 1))], axis=1)
            error = (logistic(features @ net.weights) - labels[some]) / len(some)
            # Back through the pooling to the windows that were largest.
            is_max = pooled == largest[doc]
            is_max = is_max / np.add.reduceat(is_max.astype(np.int64), edges, axis=0)[doc]  # equal chunks share it
            down = error[doc, None] * (
                net.weights[:FILTERS] * is_max + net.weights[FILTERS:-1] / sizes[doc, None]
            ) * active
            embedding, filters = np.zeros_like(net.embedding), np.zeros_like(net.filters)
            chunk, f = np.nonzero(down)
            g = down[chunk, f].astype(np.float32)
            for k in PAIRS:
                pair = codes[chunk, best[chunk, f] + k]
                for w, byte in ((k, pair >> 8), (k + 1, pair & 255)):
                    seen = np.zeros((256, FILTERS), np.float32)
                    np.add.at(seen, (byte, f), g)
                    filters[w] = net.embedding.T @ seen
                    embedding += seen @ net.filters[w].T
            adam.update(
                {
                    "embedding": embedding,
                    "filters": filters,
                    "bias": down.sum(0).astype(np.float32),
                    "weights": (features.T @ error).astype(np.float32) + 1e-4 * net.weights,
                }
            )
    return net


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Network:
    return train(labelled_sample(docs, labels, "quality", rows, chars))


def scored(docs: DataFrame, network: Network, name: str = "score") -> DataFrame:
    """Adds the probability of good quality; a column of that name is replaced."""
    kept = docs.drop(name)
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.tables()
        for batch in slices(batches, 2 << 20):
            scores = network.score(tables, texts(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, name])

    return kept.mapInArrow(run, schema)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = scored(docs.select("doc_id", "text"), fit(docs, labels))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
