"""Spelling variants grouped by dense prefix-suffix tiling.

*Words* are runs of letters of all texts. They are counted in each task, and the counts of a word
meet once for each task, so a frequent word costs no more than a rare one.

*Near words* differ by exactly one inserted, deleted or replaced code point. One edit leaves the first
or the second half of the shorter word as it was, so words meet in blocks: by the length of the
shorter one and its first half, and by that length and its second half. In each block the words form
padded code-point matrices, one aligned left and one right. Columns are compared for all pairs of
a tile at once, which gives the lengths of the common prefix and suffix; together they reach the
longer word's length less one exactly for near words. Blocks are cut into tiles of bounded size for
all pairs of their parts, so a hot block becomes many tasks' work, and a tile returns only each word's number of near words
and the most frequent of them, never pairs. Pairs that agree in both halves count in the first block only.

*Forms.* A word's form is its most frequent near word (ties: the smallest in code-point order) if
that is ``ratio`` times as frequent. Forms lead to ever more frequent words, so they have no cycles, and
roots are found by pointer jumping: chains halve in every round.

A null text has no words and a null id counts as empty; repeated rows count each; other columns are
ignored; no texts give no words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import groupby
from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitals.llm.tables import dropped, slices, stored, texts

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
# One in so many (document, run) pairs gets a code point deleted.
ERROR_RATE = 31
# Words a task counts before it passes them on, and code points of one side of a tile.
MOST_WORDS = 1 << 19
TILE_CHARS = 1 << 14
# Words and their length in blocks that are compared together, and pairs compared in one step.
SMALL = 64
SMALL_LENGTH = 64
SMALL_PAIRS = 1 << 16

# Latin-1 bytes: only A-Z are lowered; what is no letter of a run becomes a space.
TO_RUNS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))

COUNTED = pa.schema([("word", pa.string()), ("n", pa.int64())])
NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())])


def runs(text: str) -> list[bytes]:
    """Maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, lower-cased, one byte for each code point."""
    return text.encode("latin-1", "replace").translate(TO_RUNS).split()


def damaged(start: int, run: bytes, error_rate: int) -> bytes:
    """The run, or the run without one code point if the crc32 of what ``start`` stands for and it says so."""
    h = crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    if h % error_rate:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def vocabulary(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, error_rate: int = ERROR_RATE
) -> DataFrame:
    """Distinct words of at least ``least_length`` code points and their number ``n`` over all rows.

    One in ``error_rate`` pairs of document and run is misspelt by deleting one code point.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")

    def counted(words: Counter) -> pa.RecordBatch:
        found = [w.decode("latin-1") for w in words]
        return pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(list(words.values()), pa.int64())], schema=COUNTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                start = crc32(f"{doc_id}:".encode())
                for word, n in Counter(runs(text)).items():
                    # A deletion only shortens a run.
                    if len(word) >= least_length:
                        word = damaged(start, word, error_rate)
                        if len(word) >= least_length:
                            words[word] += n
            if len(words) >= MOST_WORDS:
                yield counted(words)
                words.clear()
        yield counted(words)

    partial = rows.mapInArrow(run, "word string, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


KEYS = ("tail", "shorter", "half", "row", "col")


def tiles(words: DataFrame, chars: int = TILE_CHARS) -> DataFrame:
    """Each word in every tile where it must meet others; ``longer``: it is not the shorter one there."""
    length = F.char_length("word")

    def blocks(longer: bool) -> list[Column]:
        shorter = length - int(longer)
        head = F.floor(shorter / 2).cast("int")
        halves = (False, F.left("word", head)), (True, F.right("word", shorter - head))
        return [
            F.struct(F.lit(t).alias("tail"), shorter.alias("shorter"), half.alias("half"), F.lit(longer).alias("longer"))
            for t, half in halves
        ]

    members = words.select("word", "n", F.inline(F.array(*blocks(False), *blocks(True))))
    size = F.least(F.ceil(F.col("count") * (F.col("shorter") + 1) / chars), F.col("count")).cast("int")
    large = (
        members.groupBy(*KEYS[:3]).count().withColumn("parts", size).filter("parts > 1")
        .select(F.col("tail").alias("t"), F.col("shorter").alias("s"), F.col("half").alias("h"), "parts")
    )
    same = (F.col("tail") == F.col("t")) & (F.col("shorter") == F.col("s")) & (F.col("half") == F.col("h"))
    parts = F.coalesce("parts", F.lit(1))
    mine = F.pmod(F.xxhash64("word"), parts).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), parts - 1), lambda c: F.struct(F.least(mine, c).alias("row"), F.greatest(mine, c).alias("col"))
    )
    found = members.join(large, same, "left")
    return found.select(*KEYS[:3], "longer", "word", "n", mine.alias("part"), F.inline(pairs))


def aligned(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points in zero-padded rows, aligned left and right, and the lengths."""
    lengths = np.array([len(w) for w in words])
    left = np.array(words).view(np.uint32).reshape(len(words), -1)
    if left.max() < 256:
        left = left.astype(np.uint8)
    width = left.shape[1]
    at = np.arange(width) - (width - lengths)[:, None]
    right = np.where(at >= 0, np.take_along_axis(left, np.maximum(at, 0), 1), left.dtype.type(0))
    return left, right, lengths


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For all pairs of rows the number of leading columns in which they agree."""
    alive = np.ones((len(a), len(b)), bool)
    n = np.zeros(alive.shape, np.uint8 if a.shape[1] < 256 else np.uint32)
    for k in range(a.shape[1]):
        alive &= a[:, k, None] == b[None, :, k]
        if k % 4 == 3 and not alive.any():
            break
        n += alive
    return n


def near_pairs(left, right, lengths, rows: np.ndarray, cols: np.ndarray, apart: int | None = None) -> np.ndarray:
    """Which pairs of distinct words differ by one edit; with ``apart``, only those that differ
    within that many leading code points."""
    most, least = (f.outer(lengths[rows], lengths[cols]) for f in (np.maximum, np.minimum))
    prefix = np.minimum(agreeing(left[rows], left[cols]), least)
    suffix = np.minimum(agreeing(right[rows][:, ::-1], right[cols][:, ::-1]), least)
    near = (prefix + suffix.astype(np.int64) >= most - 1) & (most - least <= 1)
    return near if apart is None else near & (prefix < apart)


def near_in_tile(words: list[str], longer: np.ndarray, rows: np.ndarray, cols: np.ndarray, apart: int | None) -> Iterator[tuple]:
    """(word, number of near words, first of them) for the words of a tile, which come best first."""
    near = near_pairs(*aligned(words), rows, cols, apart)
    near &= ~np.logical_and.outer(longer[rows], longer[cols])
    if rows is cols:
        np.fill_diagonal(near, False)
    for mine, others, hits in ((rows, cols, near),) if rows is cols else ((rows, cols, near), (cols, rows, near.T)):
        n = hits.sum(1)
        some = np.flatnonzero(n)
        yield from zip(mine[some].tolist(), n[some].tolist(), others[hits[some].argmax(1)].tolist())


class SmallBlocks:
    """Many small blocks whose pairs are compared in one step: rows of the matrices, pair by pair."""

    def __init__(self) -> None:
        self.words: list[str] = []
        self.n: list[int] = []
        self.longer: list[bool] = []
        self.apart: list[int] = []
        self.left: list[np.ndarray] = []
        self.right: list[np.ndarray] = []
        self.pairs = 0

    def add(self, words: tuple[str, ...], n: tuple[int, ...], longer: tuple[bool, ...], apart: int | None) -> None:
        i, j = pairs_of(len(words))
        self.left.append(i + len(self.words))
        self.right.append(j + len(self.words))
        self.pairs += len(i)
        self.words += words
        self.n += n
        self.longer += longer
        self.apart += [SMALL_LENGTH + 2 if apart is None else apart] * len(words)

    def found(self) -> list[tuple]:
        """(word, number of near words, the best of them, its number) of all blocks, which are then forgotten."""
        if not self.words:
            return []
        i, j = np.concatenate(self.left), np.concatenate(self.right)
        left, right, lengths = aligned(self.words)
        longer, apart = np.array(self.longer), np.array(self.apart)
        most, least = np.maximum(lengths[i], lengths[j]), np.minimum(lengths[i], lengths[j])
        prefix, suffix = (
            np.minimum(np.where(same.all(1), same.shape[1], same.argmin(1)), least)
            for same in (left[i] == left[j], (right[i] == right[j])[:, ::-1])
        )
        near = (prefix + suffix >= most - 1) & (most - least <= 1) & ~(longer[i] & longer[j]) & (prefix < apart[i])
        count, best = np.zeros(len(lengths), np.int64), np.full(len(lengths), len(lengths))
        for a, b in ((i[near], j[near]), (j[near], i[near])):
            np.add.at(count, a, 1)
            np.minimum.at(best, a, b)
        some = np.flatnonzero(count)
        out = [(self.words[a], k, self.words[b], self.n[b]) for a, k, b in zip(some.tolist(), count[some].tolist(), best[some].tolist())]
        self.__init__()
        return out


@cache
def pairs_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def near_words(words: DataFrame, chars: int = TILE_CHARS) -> DataFrame:
    """For each of the distinct words that has any: ``n_near``, and the best as ``best.form``, ``best.form_n``."""
    order = [*KEYS, F.desc("n"), "word"]
    ordered = tiles(words, chars).repartition(*KEYS).sortWithinPartitions(*order)
    names = [*KEYS, "part", "longer", "word", "n"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[tuple] = []
        small = SmallBlocks()
        for (tail, shorter, _, row, col), group in groupby(rows(batches), itemgetter(*range(len(KEYS)))):
            *_, part, longer, own, n = zip(*group)
            if len(own) == 1 or all(longer):
                continue
            apart = shorter // 2 if tail else None
            if row == col and len(own) <= SMALL and shorter <= SMALL_LENGTH and all(p == row for p in part):
                small.add(own, n, longer, apart)
                if small.pairs > SMALL_PAIRS:
                    ready += small.found()
                continue
            part = np.array(part)
            upper = np.flatnonzero(part == row)
            lower = upper if row == col else np.flatnonzero(part == col)
            if not len(upper) or not len(lower):
                continue
            found = near_in_tile(own, np.array(longer), upper, lower, apart)
            ready += [(own[i], k, own[j], n[j]) for i, k, j in found]
            if len(ready) > 1 << 16:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*ready), NEAR)], schema=NEAR)
                ready = []
        ready += small.found()
        columns = zip(*ready) if ready else ((),) * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, NEAR)], schema=NEAR)

    found = ordered.select(*names).mapInArrow(run, "word string, n_near bigint, form string, form_n bigint")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form", "form_n"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))


def roots(links: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(``word``, ``root``): where links from ``word`` to ``form`` end. Chains have no cycles."""
    links = links.select("word", F.col("form").alias("root"))
    for _ in range(most_rounds):
        links = stored(links, "roots")
        after = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if links.join(after, "root", "left_semi").isEmpty():
            return links
        links = links.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    raise RuntimeError(f"forms have cycles: no end in {most_rounds} rounds")


def variants(words: DataFrame, ratio: int = RATIO, chars: int = TILE_CHARS) -> DataFrame:
    """For distinct words with their number ``n``: ``form``, ``root``, ``n``, ``n_near`` and ``form_n``."""
    words = stored(words, "words")
    near = near_words(words, chars)
    good = F.col("best.form_n") >= ratio * F.col("n")
    formed = stored(
        words.join(near, "word", "left").select(
            "word", F.when(good, F.col("best.form")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(good, F.col("best.form_n")).alias("form_n"),
        ),
        "forms",
    )
    dropped(words.sparkSession, words)
    ends = roots(formed.filter("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    return variants(vocabulary(docs))
