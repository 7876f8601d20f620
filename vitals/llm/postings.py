"""Benchmark decontamination by a distributed positional inverted index.

*Index.* Each task numbers the words of its documents one after another and stores, for every
``SEGMENT_WORDS`` words, the sorted places of each term (as differences) and where each document starts. A segment
holds whole documents and knows nothing of others; all words of all documents are indexed, whatever is asked later.

*Search.* Phrases are looked up per segment, with the lists of the phrases' terms only. Of each phrase the rarest term
of the segment comes first: its places, less its offset in the phrase, are the candidates, and the lists of
the other terms, in order of their length, are intersected with them, offset by offset, for all phrases at once in
numpy. Candidates must lie in one document. A proximity search allows each word to be up to
``slop`` places from where the phrase has it: a phrase matches at a start if every one of its words has such a place.

*Bounds.* A task holds one segment's lists of the asked terms and ``AT_ONCE`` candidates; a list of a frequent term is as long
as its occurrences in one segment. Phrases are broadcast in blocks of about ``BLOCK_BYTES``, one pass over
the lists for each block, whose results are merged for each document.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z. A null text has no words, a null
item id counts as the empty text; repeated documents are found each, repeated items count once; no
documents give no rows, no items no hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitals.llm.tables import slices, stored

SEGMENT_WORDS = 1 << 21
BLOCK_BYTES = 16 << 20
WINDOW = 10
# Candidates compared in one numpy step.
AT_ONCE = 1 << 20

TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

# A row is a term (its ``places`` as differences, 32 bits each) or, where the term is null, a document.
INDEX = pa.schema(
    [("segment", pa.int64()), ("term", pa.string()), ("places", pa.binary()), ("doc", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64())]
)
INDEX_SQL = "segment bigint, term string, places binary, doc int, doc_id bigint, start bigint, n_words bigint"


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TO_WORDS).split()


class Segment:
    """Words of whole documents, numbered by term."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.terms: list[np.ndarray] = []
        self.docs: list[tuple[int | None, int, int]] = []
        self.size = 0

    def add(self, doc_id: int | None, found: list[bytes]) -> None:
        number = self.number
        self.terms.append(np.array([number.setdefault(w, len(number)) for w in found], np.int32))
        self.docs.append((doc_id, self.size, len(found)))
        self.size += len(found)

    def rows(self, segment: int) -> Iterator[pa.RecordBatch]:
        """The index rows, in batches of bounded size."""
        n = len(self.docs)
        ids, starts, sizes = zip(*self.docs)
        none = pa.nulls(n, pa.string()), pa.nulls(n, pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array([segment] * n), *none, pa.array(range(n), pa.int32()), pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())],
            schema=INDEX,
        )
        term = np.concatenate(self.terms)
        order = np.sort((term.astype(np.int64) << 32) | np.arange(len(term)))
        place = (order & 0xFFFFFFFF).astype(np.int32)
        edges = np.append(0, np.cumsum(np.bincount(term, minlength=len(self.number))))
        gaps = np.diff(place, prepend=np.int32(0))
        gaps[edges[:-1]] = place[edges[:-1]]
        names = np.array([w.decode() for w in self.number], object)
        for at in range(0, len(names), 1 << 15):
            own = edges[at : at + (1 << 15) + 1]
            n = len(own) - 1
            lists = pa.Array.from_buffers(
                pa.binary(), n, [None, pa.py_buffer(((own - own[0]) * 4).astype(np.int32)), pa.py_buffer(gaps[own[0] : own[-1]].copy())]
            )
            rest = pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, segment)), pa.array(names[at : at + n], pa.string()), lists, *rest], schema=INDEX)


def index(docs: DataFrame, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The positional index of the texts, by segment and term; the stored table is returned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, number = Segment(), TaskContext.get().partitionId() << 32
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                segment.add(doc_id, words(text))
                if segment.size >= segment_words:
                    yield from segment.rows(number)
                    segment, number = Segment(), number + 1
        if segment.docs:
            yield from segment.rows(number)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return stored(rows.mapInArrow(run, INDEX_SQL), "postings")


class Phrases:
    """Phrases as rows of term numbers, padded with -1."""

    def __init__(self, phrases: list[list[str]]):
        self.number: dict[str, int] = {}
        width = max(map(len, phrases), default=0)
        self.terms = np.full((len(phrases), width), -1, np.int32)
        for row, phrase in zip(self.terms, phrases):
            row[: len(phrase)] = [self.number.setdefault(w, len(self.number)) for w in phrase]
        self.lengths = np.array([len(p) for p in phrases], np.int64)

    def found(self, lists: list[np.ndarray], starts: np.ndarray, size: int, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(phrase, start) of the matches in a segment of ``size`` words, given each term's sorted places
        and the documents' starts. Phrases may start before a document if ``slop`` lets their words lie in it."""
        counts = np.array([len(x) for x in lists] + [0])
        of_phrase = np.where(self.terms >= 0, counts[self.terms], np.iinfo(np.int64).max)
        alive = np.flatnonzero((self.lengths > 0) & (of_phrase.min(1, initial=np.iinfo(np.int64).max) > 0))
        if not len(alive):
            return
        order = np.argsort(of_phrase[alive], axis=1, kind="stable")
        # All lists as one sorted array: the term's number, then the place.
        base = np.append(0, np.cumsum(counts[:-1]))
        keys = np.concatenate([*lists, np.zeros(0, np.int32)]).astype(np.int64)
        keys += np.repeat(np.arange(len(lists)), counts[:-1]) << 33
        shifts = np.arange(-slop, slop + 1)
        work = np.take_along_axis(of_phrase[alive], order[:, :1], 1)[:, 0] * len(shifts)
        for part in np.split(np.arange(len(alive)), np.flatnonzero(np.diff(np.cumsum(work) // AT_ONCE)) + 1):
            phrase, first = alive[part], order[part, 0]
            term = self.terms[phrase, first]
            n = counts[term]
            for begin in range(0, int(n.max()), AT_ONCE):
                own = np.clip(n - begin, 0, AT_ONCE)
                row = np.repeat(np.arange(len(part)), own)
                at = np.arange(len(row)) - np.repeat(np.cumsum(own) - own, own) + np.repeat(base[term], own) + begin
                place = keys[at] & 0x1FFFFFFFF
                doc = np.searchsorted(starts, place, "right") - 1
                low, high = starts[doc], np.append(starts[1:], size)[doc]
                start = (place - first[row])[:, None] + shifts
                row, low, high, start = np.repeat(row, len(shifts)), np.repeat(low, len(shifts)), np.repeat(high, len(shifts)), start.ravel()
                for step in range(self.terms.shape[1]):
                    offset = order[part[row], step]
                    wanted = self.terms[phrase[row], offset]
                    # The first place from ``slop`` before where the phrase has the word, within the document.
                    least = np.maximum(start + offset - slop, low)
                    most = np.minimum(start + offset + slop, high - 1)
                    hit = np.searchsorted(keys, (wanted.astype(np.int64) << 33) | np.maximum(least, 0))
                    near = np.where(hit < len(keys), keys[np.minimum(hit, len(keys) - 1)], -1)
                    ok = (wanted < 0) | ((least <= most) & (near >= 0) & (near >> 33 == wanted) & ((near & 0x1FFFFFFFF) <= most))
                    row, low, high, start = row[ok], low[ok], high[ok], start[ok]
                    if not len(row):
                        break
                if len(row):
                    if slop:
                        row, low, start = np.unique(np.stack([row, low, start]), axis=1)
                    yield phrase[row], start, low


def _segments(batches: Iterator[pa.RecordBatch], number: dict[str, int]) -> Iterator[tuple]:
    """(segment, documents, lists by term number) of rows sorted by segment, documents first."""

    def rows() -> Iterator[tuple]:
        for batch in slices(batches):
            yield from zip(*(c.to_pylist() for c in batch.columns))

    for segment, own in groupby(rows(), lambda r: r[0]):
        docs, lists = [], [np.zeros(0, np.int32)] * len(number)
        for _, term, places, doc, doc_id, start, n_words in own:
            if term is None:
                docs.append((doc, doc_id, start, n_words))
            elif (k := number.get(term)) is not None:
                lists[k] = np.cumsum(np.frombuffer(places, np.int32), dtype=np.int32)
        yield segment, sorted(docs), lists


def _by_segment(postings: DataFrame, phrases: Phrases) -> DataFrame:
    """The documents of each segment and the lists of the phrases' terms, sorted for ``_segments``."""
    spark = postings.sparkSession
    terms = spark.createDataFrame([(t,) for t in phrases.number], "wanted string")
    lists = postings.join(F.broadcast(terms), F.col("term") == F.col("wanted"), "left_semi")
    rows = lists.unionByName(postings.filter("term IS NULL"))
    return rows.repartition("segment").sortWithinPartitions("segment", F.col("term").asc_nulls_first())


MATCHES = pa.schema([("phrase", pa.int64()), ("doc_id", pa.int64()), ("segment", pa.int64()), ("doc", pa.int32()), ("start", pa.int64())])


def matches(postings: DataFrame, phrases: list[list[str]], slop: int = 0) -> DataFrame:
    """Every match of a phrase (its number in the list): ``doc_id``, ``segment``, ``doc`` and ``start``, the place in the document.

    ``slop`` 0 gives exact phrases. Else a match is a start for which every word of the phrase has an occurrence within
    ``slop`` words of its place; it may be negative or past the end by up to ``slop``. The phrases are broadcast: pass about
    ``BLOCK_BYTES`` at a time. An empty phrase has no match.
    """
    asked = Phrases(phrases)
    shared = postings.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        for segment, docs, lists in _segments(batches, asked.number):
            filled, starts, size = _places(docs)
            for phrase, start, low in asked.found(lists, starts, size, slop):
                doc = filled[np.searchsorted(starts, low)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(phrase.astype(np.int64)),
                        pa.array([docs[k][1] for k in doc], pa.int64()),
                        pa.array(np.full(len(doc), segment)),
                        pa.array([docs[k][0] for k in doc], pa.int32()),
                        pa.array(start - low),
                    ],
                    schema=MATCHES,
                )

    return _by_segment(postings, asked).mapInArrow(run, "phrase bigint, doc_id bigint, segment bigint, doc int, start bigint")


def _places(docs: list[tuple]) -> tuple[np.ndarray, np.ndarray, int]:
    """Of a segment's documents: which have words, where these start, and the number of all words."""
    filled = np.array([k for k, d in enumerate(docs) if d[3]], int)
    return filled, np.array([docs[k][2] for k in filled], np.int64), sum(d[3] for d in docs)


def windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """Distinct windows of ``width`` words, of items with fewer words all of these, and the sorted ids
    (as text) of the items that have them: ``window``, ``item_ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found, ids = [], []
            for item_id, text in zip(batch.column("item_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                own = [w.decode() for w in words(text)]
                new = {tuple(own[k : k + width]) for k in range(max(1, len(own) - width + 1))} - {()}
                found += new
                ids += [item_id] * len(new)
            yield pa.RecordBatch.from_arrays([pa.array(map(list, found), pa.list_(pa.string())), pa.array(ids, pa.string())], ["window", "item_id"])

    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    each = rows.mapInArrow(run, "window array<string>, item_id string")
    return each.groupBy("window").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))


HITS = pa.schema([("segment", pa.int64()), ("doc", pa.int32()), ("places", pa.list_(pa.int32())), ("item_ids", pa.list_(pa.string()))])
HITS_SQL = "segment bigint, doc int, places array<int>, item_ids array<string>"


def _hits(postings: DataFrame, block: list) -> DataFrame:
    """Of each document that has a window of the block: the places inside windows, and the items."""
    asked = Phrases([row.window for row in block])
    shared = postings.sparkSession.sparkContext.broadcast((asked, [row.item_ids for row in block]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, item_ids = shared.value
        for segment, docs, lists in _segments(batches, asked.number):
            filled, starts, size = _places(docs)
            inside, pairs = np.zeros(size + 1, np.int32), []
            for phrase, start, low in asked.found(lists, starts, size, 0):
                np.add.at(inside, start, 1)
                np.add.at(inside, start + asked.lengths[phrase], -1)
                pairs.append(np.unique(np.stack([np.searchsorted(starts, low), phrase]), axis=1))
            if not pairs:
                continue
            place = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
            owner = np.searchsorted(starts, place, "right") - 1
            of_doc: dict[int, set[str]] = {}
            for k, phrase in np.concatenate(pairs, axis=1).T.tolist():
                of_doc.setdefault(k, set()).update(item_ids[phrase])
            for at in range(0, len(of_doc), 1 << 12):
                some = sorted(of_doc)[at : at + (1 << 12)]
                own = [place[slice(*np.searchsorted(owner, [k, k + 1]))] - starts[k] for k in some]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(some), segment)),
                        pa.array([docs[filled[k]][0] for k in some], pa.int32()),
                        pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32())),
                        pa.array([sorted(of_doc[k]) for k in some], pa.list_(pa.string())),
                    ],
                    schema=HITS,
                )

    return _by_segment(postings, asked).mapInArrow(run, HITS_SQL)


def contamination(postings: DataFrame, items: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each indexed document: ``doc_id``, ``n_words``, the places ``hit`` that lie inside a window
    of an item, and the sorted ``item_ids`` (as text) of the items that have such windows."""
    asked = windows(items, width)
    size = F.octet_length(F.concat_ws(" ", "window")) + F.octet_length(F.concat_ws(" ", "item_ids"))
    total = asked.agg(F.sum(size)).first()[0] or 0
    blocks = -(-total // block_bytes)
    if blocks > 1:
        asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks))), "windows")
    found = None
    for b in range(blocks):
        block = (asked if blocks == 1 else asked.filter(F.col("block") == b)).select("window", "item_ids").collect()
        hits = _hits(postings, block)
        found = hits if found is None else found.unionByName(hits)
    docs = postings.filter("term IS NULL").select("segment", "doc", "doc_id", "n_words")
    if found is None:
        return docs.select("doc_id", "n_words", F.array().cast("array<int>").alias("hit"), F.array().cast("array<string>").alias("item_ids"))
    if blocks > 1:
        found = found.groupBy("segment", "doc").agg(_merged("places"), _merged("item_ids"))

    def known(column: str, kind: str) -> Column:
        return F.coalesce(column, F.array().cast(kind))

    joined = docs.join(found, ["segment", "doc"], "left")
    return joined.select("doc_id", "n_words", known("places", "array<int>").alias("hit"), known("item_ids", "array<string>").alias("item_ids"))


def _merged(column: str) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(column)))).alias(column)


def digests(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = contamination(index(docs), items)
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit").cast("bigint").alias("n_hit"),
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"),
    )
