"""Quality rule by repetition: how much of a text lies in repeated n-grams and lines.

Each word gets a number, and every n-gram of several lengths a 64-bit rolling hash over those
numbers, computed for all texts of a batch at once in numpy; the text's own number is part of the
hash, so texts do not mix. Windows with equal hashes are then compared word by word, so a
collision cannot count. The share of word characters inside windows that occur twice or more is
held against a limit for each length, as is the share inside repeated lines.

A text is rejected (``kept`` false) if it fails the base rules - fewer than 20 words, or more than
30 % of its words in repeated 8-word windows - or one of those limits. Null counts as empty; an
empty text has no words and is rejected. Texts are judged one by one: repeated rows get equal
results, no shuffle takes place, and a row's result never depends on its neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals.llm.tables import slices, texts

LEAST_WORDS = 20
BASE_LENGTH = 8
BASE_PERCENT = 30
# Limits in percent of the word characters, by n-gram length. Short n-grams repeat in any long
# text, so the limits fall as the length grows.
LIMITS = {5: 50, 8: 40, 10: 30}
LINE_LIMIT = 30
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\r\x0b\x0c"
NOT_SYMBOLS = bytes(set(range(256)) - set(SYMBOLS))
# Odd multiplier of the rolling hash (2**64 divided by the golden ratio).
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads consecutive numbers over 64 bits."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def neighbours(
    start: np.ndarray, key: np.ndarray | None, ids: np.ndarray, doc: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray, bool]:
    """Pairs of equal windows that are next to each other in the order of ``start``, and whether
    some next to each other have equal keys only."""
    same = key[1:] == key[:-1] if key is not None else np.ones(max(len(start) - 1, 0), bool)
    left, right = start[:-1][same], start[1:][same]
    equal = doc[left] == doc[right]
    for k in range(n):
        equal &= ids[left + k] == ids[right + k]
    return left[equal], right[equal], not equal.all()


def repeated_windows(ids: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Whether each word lies in an ``n``-word window found twice or more in its text."""
    inside = np.zeros(len(ids), bool)
    windows = len(ids) - n + 1
    if windows < 2:
        return inside
    word = mixed(ids + 1)
    rolled = np.zeros(windows, np.uint64)
    for k in range(n):
        rolled = rolled * MULTIPLIER + word[k : k + windows]
    start = np.flatnonzero(doc[:windows] == doc[n - 1 :])
    key = mixed(rolled[start]) ^ mixed(doc[start] + np.int64(1 << 32))
    left, right, collided = neighbours(start[np.argsort(key, kind="stable")], np.sort(key), ids, doc, n)
    if collided:  # windows of one hash that differ are told apart by their words
        whole = [ids[start + k] for k in range(n)]
        left, right, _ = neighbours(start[np.lexsort([*whole, doc[start]])], None, ids, doc, n)
    marks = np.zeros(len(ids) + 1, np.int64)
    found = np.unique(np.concatenate([left, right]))
    marks[found] += 1
    marks[found + n] -= 1
    return np.cumsum(marks[:-1]) > 0


def measure(rows: Sequence[str], lengths: Sequence[int]) -> dict[str, np.ndarray]:
    """Counts per text: words, characters, symbols, repeated lines, and coverage by length."""
    number: dict[bytes, int] = {}
    ids, doc, chars = [], [], []
    words = np.zeros(len(rows), np.int64)
    symbols, dup_lines, dup_line_chars = words.copy(), words.copy(), words.copy()
    for d, text in enumerate(rows):
        raw = text.encode()
        found = raw.split()  # white space of bytes is exactly space and \x09-\x0D
        words[d] = len(found)
        ids += [number.setdefault(w, len(number)) for w in found]
        if text.isascii():
            chars += map(len, found)
        else:
            chars += [len(w.decode()) for w in found]
        symbols[d] = len(raw.translate(None, NOT_SYMBOLS))
        if b"\n" in raw:
            seen: set[bytes] = set()
            for line in raw.split(b"\n"):
                if line in seen:
                    dup_lines[d] += 1
                    dup_line_chars[d] += len(line.translate(None, WHITE).decode())
                elif line.strip(WHITE):
                    seen.add(line)
    ids, chars = np.array(ids, np.int64), np.array(chars, np.int64)
    doc = np.repeat(np.arange(len(rows)), words)
    total = np.bincount(doc, chars, len(rows)).astype(np.int64)
    out = {
        "n_words": words,
        "word_chars": total,
        "n_symbols": symbols,
        "n_dup_lines": dup_lines,
        "dup_line_chars": dup_line_chars,
    }
    for n in lengths:
        inside = repeated_windows(ids, doc, n)
        out[f"n_repeat_words_{n}"] = np.bincount(doc[inside], minlength=len(rows)).astype(np.int64)
        out[f"repeat_chars_{n}"] = np.bincount(doc[inside], chars[inside], len(rows)).astype(np.int64)
    return out


def repetition(docs: DataFrame, limits: dict[int, int] = LIMITS, line_limit: int = LINE_LIMIT) -> DataFrame:
    """Adds the counts of ``measure``, ``base_failed`` and ``kept`` to every row.

    ``limits``: percent of word characters allowed in repeated windows, by window length.
    Columns with these names are replaced.
    """
    lengths = sorted({BASE_LENGTH, *limits})
    names = list(measure([], lengths))
    kept = docs.drop(*names, "base_failed", "kept")
    schema = T.StructType([*kept.schema.fields, *(T.StructField(c, T.LongType(), False) for c in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = measure(texts(batch), lengths)
            columns = [*batch.columns, *(pa.array(found[c], pa.int64()) for c in names)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *names])

    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col(f"n_repeat_words_{BASE_LENGTH}") > BASE_PERCENT * F.col("n_words")
    )
    over = 100 * F.col("dup_line_chars") > line_limit * F.col("word_chars")
    for n, percent in limits.items():
        over = over | (100 * F.col(f"repeat_chars_{n}") > percent * F.col("word_chars"))
    return kept.mapInArrow(run, schema).withColumn("base_failed", failed).withColumn("kept", ~failed & ~over)
