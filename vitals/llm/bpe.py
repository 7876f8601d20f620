"""Byte-level BPE: encode by a priority queue of merge ranks, decode by concatenation.

Encoding a word keeps its symbols in a doubly linked list and every adjacent pair that has a
merge rank in a heap. The best pair is merged, its two new neighbour pairs enter the heap, and
entries whose symbols have changed meanwhile are skipped when they surface. The ids equal those
of the vocabulary's own library, special tokens in a text included.

Words repeat, so each worker keeps the ids of recent words and of recent space-delimited chunks,
both bounded. A chunk may be cut at a space only if no other white space touches it: no word of
the pattern then crosses the cut. Texts in which white space meets white space go through the
pattern as a whole. Whole texts are always encoded; nothing depends on how rows are grouped.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals.llm.tables import slices, texts

# Fixed value: the word pattern of byte-level BPE.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RECENT = 250_000
POSITION = (1 << 40) - 1
WHITE_SPACE_RUN = re.compile(r"\s\s")


class Recent(dict):
    """A bounded memo of two generations: when the young one is full it becomes the old one."""

    def __init__(self, compute: Callable[[str], bytes], most: int):
        super().__init__()
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        if len(key) <= 200:
            self[key] = value
        return value


def byte_alphabet() -> dict[str, int]:
    """Character of each byte: printable bytes stand for themselves, the rest follow from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """One vocabulary file, read once in each worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.bytes_of: dict[int, bytes] = {
            i: bytes(alphabet[c] for c in token) for token, i in vocab.items()
        }
        self.id_of_byte = [0] * 256
        for c, b in alphabet.items():
            self.id_of_byte[b] = vocab[c]
        # A pair of ids as one integer, its rank shifted to leave room for a position, the merged id.
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a] << 32 | vocab[b]] = rank << 40, vocab[a + b]
        self.special: dict[str, int] = {}
        for token in spec["added_tokens"]:
            if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
                raise ValueError(f"unsupported added token {token['content']!r}")
            self.special[token["content"]] = token["id"]
            self.bytes_of[token["id"]] = token["content"].encode()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.at_special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.find_words = regex.compile(WORDS).findall
        self.words = Recent(lambda w: np.array(self.merge(w.encode()), np.int32).tobytes(), RECENT)
        self.chunks = Recent(lambda c: b"".join(map(self.words.__getitem__, self.find_words(c))), RECENT)

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word."""
        ids = [self.id_of_byte[b] for b in word]
        n, get = len(ids), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [m[0] | i for i in range(n - 1) if (m := get(ids[i] << 32 | ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            i = entry & POSITION
            j = after[i]
            if ids[i] < 0 or j >= n:
                continue
            found = get(ids[i] << 32 | ids[j])
            if found is None or found[0] | i != entry:
                continue  # stale: a symbol of this pair has been merged meanwhile
            ids[i], ids[j] = found[1], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if m := get(ids[i] << 32 | ids[k]):
                    heapq.heappush(heap, m[0] | i)
            h = before[i]
            if h >= 0 and (m := get(ids[h] << 32 | ids[i])):
                heapq.heappush(heap, m[0] | h)
        return [i for i in ids if i >= 0]

    def plain(self, text: str) -> bytes:
        """Ids, as 32-bit integers, of a text without special tokens."""
        if WHITE_SPACE_RUN.search(text):
            return b"".join(map(self.words.__getitem__, self.find_words(text)))
        first, *rest = text.split(" ")
        if not rest:
            return self.chunks[first]
        return self.chunks[first] + b"".join(map(self.chunks.__getitem__, [" " + c for c in rest]))

    def encode(self, text: str) -> np.ndarray:
        if self.at_special is None or not self.at_special.search(text):
            ids = self.plain(text)
        else:
            parts = self.at_special.split(text)
            ids = b"".join(
                np.int32(self.special[p]).tobytes() if k % 2 else self.plain(p) for k, p in enumerate(parts)
            )
        return np.frombuffer(ids, np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        """The vocabulary's strings in order; ids outside it give nothing, bytes that are not
        UTF-8 the replacement character."""
        get = self.bytes_of.get
        return b"".join([get(i, b"") for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    return Bpe(path)


def lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
    flat = np.concatenate([np.empty(0, np.int32), *found])
    return pa.ListArray.from_arrays(ends, pa.array(flat)).cast(pa.list_(pa.field("element", pa.int32(), False)))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds ``ids``, the token ids (array of int) of every whole text; null counts as empty.

    Works row by row without a shuffle: order, repeats and extra columns are kept. A column that
    already bears the name of the result is replaced.
    """
    kept = docs.drop(ids)
    schema = T.StructType([*kept.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in slices(batches):
            found = [bpe.encode(t) for t in texts(batch, text)]
            yield pa.RecordBatch.from_arrays([*batch.columns, lists(found)], [*batch.schema.names, ids])

    return kept.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds ``text``, decoded from the ids, special tokens kept; null ids give the empty text."""
    kept = encoded.drop(text)
    schema = T.StructType([*kept.schema.fields, T.StructField(text, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in slices(batches):
            column = batch.column(ids)
            found = pa.array([bpe.decode(x.as_py() or ()) for x in column], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, text])

    return kept.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass: adds ``ids`` and the ``decoded`` text, drops the input text."""
    kept = docs.drop("ids", "decoded", text)
    names = kept.columns
    added = [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False), T.StructField("decoded", T.StringType(), False)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in slices(batches, 4 << 20):
            found = [bpe.encode(t) for t in texts(batch, text)]
            decoded = pa.array([bpe.decode(ids.tolist()) for ids in found], pa.string())
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, lists(found), decoded], [*names, "ids", "decoded"])

    return docs.select(*names, text).mapInArrow(run, T.StructType([*kept.schema.fields, *added]))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, and SHA-256 of the ids and of the text decoded from them."""
    coded = round_trip(docs.select("doc_id", "text"), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
