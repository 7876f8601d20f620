"""What the trained classifiers share: labelled rows, all or a bounded sample, and an optimizer."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.llm.tables import held_out, text_of


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, most_rows: int, most_chars: int, columns: tuple[str, ...] = ()
) -> list[tuple]:
    """(text, label, ...) of at most ``most_rows`` labelled rows that are not held out, chosen by
    a hash of their ids; texts over ``most_chars`` characters are not learned from. Both bounds
    together bound what reaches the driver."""
    chosen = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64(F.lit(label), "_id"), "_id", "_label")
        .limit(most_rows)
    )
    text = text_of()
    rows = (
        docs.select("doc_id", text.alias("text"), *columns)
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
        .filter(F.char_length("text") <= most_chars)
        .orderBy(F.xxhash64(F.lit(label), "_id"), "_id", "_label", F.xxhash64("text"))
        .limit(most_rows)
    )
    return [tuple(r) for r in rows.select("text", "_label", *columns).collect()]


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, columns: tuple[str, ...] = ()) -> DataFrame:
    """Every labelled row that is not held out: its id, label, text and ``columns``, and hashes of id and text
    for an order that does not depend on where the rows are. Labels grow with the documents, so they are
    never broadcast, and texts are not sorted for the join."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label"))
    return (
        docs.select("doc_id", text_of().alias("text"), *columns)
        .join(known.hint("shuffle_hash"), F.col("doc_id") == F.col("id"))
        .select("id", "label", "text", *columns, F.xxhash64(F.lit(label), "id").alias("order"), F.xxhash64("text").alias("tie"))
    )


class Adam:
    def __init__(self, parameters: dict[str, np.ndarray], rate: float):
        self.parameters, self.rate, self.step = parameters, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in parameters.items()}
        self.square = {k: np.zeros_like(v) for k, v in parameters.items()}

    def update(self, gradients: dict[str, np.ndarray]) -> None:
        self.step += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for k, g in gradients.items():
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.001 * (g * g - self.square[k])
            self.parameters[k] -= (scale * self.mean[k] / (np.sqrt(self.square[k]) + 1e-8)).astype(np.float32)

    def _arrays(self) -> list[np.ndarray]:
        return [a for d in (self.parameters, self.mean, self.square) for a in d.values()]

    def state(self) -> np.ndarray:
        """Parameters and moments as one vector."""
        return np.concatenate([a.ravel() for a in self._arrays()])

    def restore(self, state: np.ndarray) -> None:
        at = 0
        for a in self._arrays():
            a[...] = state[at : at + a.size].reshape(a.shape)
            at += a.size


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def auc(scores: np.ndarray, labels: np.ndarray) -> float:
    """Probability that a positive scores above a negative, ties counting half."""
    values, where = np.unique(scores, return_inverse=True)
    negatives = np.bincount(where[labels == 0], minlength=len(values))
    below = np.cumsum(negatives) - negatives
    positives = np.bincount(where[labels == 1], minlength=len(values))
    pairs = positives.sum() * negatives.sum()
    return float((positives * (below + negatives / 2)).sum() / pairs) if pairs else 0.5
