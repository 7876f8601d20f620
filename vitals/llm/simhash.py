"""Near-duplicates by SimHash fingerprints, found by anchor-point covering.

*Fingerprints.* Each shingle of words is hashed to 64 bits; a bit of the fingerprint is set if it is
set in more than half of the hashes, repeats included.

*Anchors.* The 64 bits are cut into parts, and by the pigeonhole principle two fingerprints that
differ in at most ``threshold`` bits differ in at most ``threshold // parts`` bits of some part. For
each part, the anchors are the words of a covering code: a Hamming code on as many of its bits as
the code has, every value on the remaining bits. Its covering radius is one, so each fingerprint
has a *home* anchor within one bit. A fingerprint is replicated to every anchor within one plus
the part's threshold, where it must meet every fingerprint it can link to at that one's home. No
link is lost.

*Comparison.* At each anchor the members are compared with those at home there, and their links
are reduced to one link per member to the smallest of its local component, so a group of thousands
of near copies yields as many links as members, not all its pairs. Anchors with more than ``CELL``
members are cut into square blocks of bounded size that cover all pairs. Equal
fingerprints are reduced to one before all this. Components are then joined across anchors.

*Exact check.* Where rows are to be removed (``one_of_each``), components of fingerprints are only candidates:
in each, texts are linked if the Jaccard similarity of their shingles is high enough, and components
of these links count. Large candidates are cut into blocks that cover all pairs. Several families of
fingerprints, each from the shingles' hashes mixed in its own way, propose independently, so a pair that
one family misses is likely found by another.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from vitals.llm.components import components
from vitals.llm.tables import dropped, slices, stored, text_of, texts

BITS = 64
SEED = 42
CELL = 4096
# Comparisons made in one numpy step.
AT_ONCE = 1 << 20
# Texts are near-duplicates if they share at least this much, as a fraction, of their shingles of so many words.
SHINGLE = 5
SIMILAR = 4, 5
# Texts of one side of a block in which shingles are compared.
SIDE_BYTES = 32 << 20
# Rows of one candidate are spread over so many keys when its totals are joined back to them.
SALTS = 32
# Increment and multipliers of the SplitMix64 finalizer, which mixes the hashes of a further family.
STEP = 0x9E3779B97F4A7C15
FIRST = 0xBF58476D1CE4E5B9
SECOND = 0x94D049BB133111EB
MEMBER = np.dtype([("key", np.int64), ("home", bool), ("fp", np.uint64)])


def shingles(text: str, width: int) -> np.ndarray:
    """Hash of each shingle, repeats included; fewer words than ``width`` are one, none are none."""
    words = text.encode().lower().split()  # bytes: only A-Z is lowered, only \x09-\x0D and space split
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - width + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    stops = ends[len(words) - n :].tolist()
    h = xxhash.xxh64_intdigest
    return np.array([h(joined[a:b], SEED) for a, b in zip(starts, stops)], "<u8")


def mixed(hashes: np.ndarray, family: int) -> np.ndarray:
    """Hashes of another family: one to one, the same in family zero."""
    if not family:
        return hashes
    h = hashes + np.uint64(STEP * family % (1 << BITS))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(FIRST)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(SECOND)
    return h ^ (h >> np.uint64(31))


def fingerprint(text: str, width: int) -> int:
    return majority(shingles(text, width))


def fingerprints(text: str, width: int, families: int) -> list[int]:
    hashes = shingles(text, width)
    return [majority(mixed(hashes, k)) for k in range(families)]


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    n = len(hashes)
    if not n:
        return 0
    votes = np.zeros(BITS, np.int64)
    for k in range(0, n, 1 << 16):
        part = hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, width: int, name: str = "fp") -> DataFrame:
    """Adds the SimHash of each whole text as a signed long; null counts as empty, which gives 0."""
    kept = docs.drop(name)
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(t, width) for t in texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, name])

    return kept.mapInArrow(run, schema)


class CoveringCode:
    """Hamming code on the low ``2**r - 1`` of ``bits`` bits, all values on the others."""

    def __init__(self, bits: int):
        self.bits = bits
        self.length = (1 << ((bits + 1).bit_length() - 1)) - 1
        if self.length < 3:
            raise ValueError(f"no Hamming code in {bits} bits")

    def syndrome(self, x: np.ndarray) -> np.ndarray:
        """Xor of the positions, from 1, of the set bits; zero for a code word."""
        out = np.zeros(x.shape, np.int64)
        for i in range(self.length):
            out ^= np.where((x >> np.uint64(i)) & np.uint64(1), i + 1, 0)
        return out

    def home(self, x: np.ndarray) -> np.ndarray:
        """The code word within one bit of the code's own positions."""
        s = self.syndrome(x)
        return np.where(s > 0, x ^ (np.uint64(1) << np.maximum(s - 1, 0).astype(np.uint64)), x)

    def within(self, x: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and code words at most ``radius`` bits away."""
        rows, found, s = [], [], self.syndrome(x)
        for k in range(radius + 1):
            for flips in combinations(range(self.bits), k):
                shift = 0
                for i in flips:
                    shift ^= i + 1 if i < self.length else 0
                hit = np.flatnonzero(s == shift)
                rows.append(hit)
                found.append(x[hit] ^ np.uint64(sum(1 << i for i in flips)))
        return np.concatenate(rows), np.concatenate(found)


def parts_of(parts: int) -> list[tuple[int, int]]:
    """(shift, bits) of each part."""
    edges = [BITS * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


ANCHORED = "part int, anchor bigint, home boolean, fp bigint"


def anchored(distinct: DataFrame, threshold: int, parts: int) -> DataFrame:
    """Each fingerprint at every anchor within covering radius plus the part's threshold."""
    codes = [(shift, CoveringCode(bits)) for shift, bits in parts_of(parts)]
    radius = 1 + threshold // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 14):
                signed = batch.column("fp")[at : at + (1 << 14)].to_numpy()
                fps = signed.view(np.uint64)
                for part, (shift, code) in enumerate(codes):
                    x = (fps >> np.uint64(shift)) & np.uint64((1 << code.bits) - 1)
                    rows, anchors = code.within(x, radius)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(rows), part, np.int32)),
                            pa.array(anchors.view(np.int64)),
                            pa.array(anchors == code.home(x)[rows]),
                            pa.array(signed[rows]),
                        ],
                        ["part", "anchor", "home", "fp"],
                    )

    return distinct.select("fp").mapInArrow(run, ANCHORED)


def cells(members: DataFrame, size: int = CELL) -> DataFrame:
    """Adds ``row`` and ``col``: blocks that cover all pairs of an anchor with bounded members.

    Only anchors with more than ``size`` members get more than one block; there is at most one for
    each ``size`` rows.
    """
    large = (
        members.groupBy("part", "anchor").count().filter(F.col("count") > size)
        .select("part", "anchor", F.ceil(F.col("count") / size).cast("int").alias("n"))
    )
    n = F.coalesce("n", F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), n).cast("int")
    every = F.sequence(F.lit(0), n - 1)
    as_home = F.when(F.col("home"), F.transform(every, lambda c: F.struct(mine.alias("row"), c.alias("col"), F.lit(True).alias("at_home"))))
    as_other = F.transform(every, lambda r: F.struct(r.alias("row"), mine.alias("col"), F.lit(False).alias("at_home")))
    single = F.array(F.struct(F.lit(0).alias("row"), F.lit(0).alias("col"), F.col("home").alias("at_home")))
    blocks = F.when(n == 1, single).otherwise(F.concat(F.coalesce(as_home, F.array().cast("array<struct<row:int,col:int,at_home:boolean>>")), as_other))
    return members.join(large, ["part", "anchor"], "left").select("part", "anchor", "fp", F.inline(blocks))


def local_links(fps: np.ndarray, home: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """One link per member of a block to the smallest of its component: from, to.

    A component grows by comparing its newest members at home with all fingerprints outside it, so
    members of one dense group are not compared with each other again and again.
    """
    fps, where = np.unique(fps, return_inverse=True)
    at_home = np.zeros(len(fps), bool)
    np.logical_or.at(at_home, where, home)
    label = np.full(len(fps), -1)
    for first in range(len(fps)):
        if label[first] >= 0:
            continue
        label[first] = first
        todo = [first]
        while todo:
            i = todo.pop()
            rest = label < 0
            if not rest.any():
                break
            if not at_home[i]:
                rest &= at_home
            near = np.flatnonzero(rest)
            near = near[np.bitwise_count(fps[near] ^ fps[i]) <= threshold]
            label[near] = first
            todo += near.tolist()
    linked = np.flatnonzero(label != np.arange(len(fps)))
    return fps[linked], fps[label[linked]]


def blocks_with_links(rows: np.ndarray, threshold: int) -> Iterator[np.ndarray]:
    """Of whole blocks in key order, those with a link. Many small blocks are compared at once."""
    edge = np.flatnonzero(np.append(True, rows["key"][1:] != rows["key"][:-1]))
    sizes = np.diff(np.append(edge, len(rows)))
    block = np.repeat(np.arange(len(edge)), sizes)
    homes = np.bincount(block[rows["home"]], minlength=len(edge))
    work = homes * sizes
    for b in np.flatnonzero(work > AT_ONCE):
        yield rows[edge[b] : edge[b] + sizes[b]]
    small = np.flatnonzero(rows["home"] & (work <= AT_ONCE)[block] & (sizes > 1)[block])
    done = np.cumsum(sizes[block[small]])
    hit = np.zeros(len(edge), bool)
    for part in np.split(small, np.searchsorted(done, np.arange(AT_ONCE, done[-1] if len(done) else 0, AT_ONCE))):
        n = sizes[block[part]]
        left = np.repeat(part, n)
        right = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(edge[block[part]], n)
        near = np.bitwise_count(rows["fp"][left] ^ rows["fp"][right]) <= threshold
        hit[block[left[near & (rows["fp"][left] != rows["fp"][right])]]] = True
    for b in np.flatnonzero(hit):
        yield rows[edge[b] : edge[b] + sizes[b]]


def links(blocks: DataFrame, threshold: int) -> DataFrame:
    """Links ``u``, ``v`` that connect exactly what links within ``threshold`` bits connect."""
    keys = ["part", "anchor", "row", "col"]
    ordered = (
        blocks.select(F.xxhash64(*keys).alias("key"), *keys, F.col("at_home").alias("home"), "fp")
        .repartition(*keys)
        .sortWithinPartitions("key", *keys)
        .select(F.xxhash64("key", *keys).alias("key"), "home", "fp")
    )

    def close(rows: np.ndarray) -> pa.RecordBatch:
        found = [local_links(b["fp"], b["home"], threshold) for b in blocks_with_links(rows, threshold)]
        u, v = (np.concatenate([np.empty(0, np.uint64), *side]).view(np.int64) for side in zip(*found, strict=True)) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = np.empty(0, MEMBER)
        for batch in batches:
            new = np.empty(batch.num_rows, MEMBER)
            for c in MEMBER.names:
                new[c] = batch.column(c).to_numpy(zero_copy_only=False).astype(MEMBER[c], copy=False)
            rows = np.concatenate([rows, new])
            if len(rows) and rows["key"][0] != rows["key"][-1]:
                whole = np.flatnonzero(rows["key"] != rows["key"][-1])[-1] + 1
                yield close(rows[:whole])
                rows = rows[whole:]
        yield close(rows)

    return ordered.mapInArrow(run, "u bigint, v bigint")


def _linked(docs: DataFrame, width: int, threshold: int, parts: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and for each distinct one its ``root``, the same within a component."""
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("text_hash", F.xxhash64("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    prints = stored(with_fingerprints(rows, width).drop("text"), "prints")
    distinct = stored(prints.select("fp").distinct(), "distinct")
    members = stored(anchored(distinct, threshold, parts), "members")
    found = stored(links(cells(members), threshold), "links")
    dropped(docs.sparkSession, members)
    joined = components(found)
    roots = distinct.join(joined, distinct.fp == joined.u, "left").select("fp", F.coalesce("v", "fp").alias("root"))
    return prints, roots


def near_duplicates(docs: DataFrame, width: int = 4, threshold: int = 4, parts: int = 3) -> DataFrame:
    """One row per document: ``doc_id``, its fingerprint ``fp``, and ``component_id``.

    Documents whose fingerprints differ in at most ``threshold`` bits are linked;
    ``component_id`` is the smallest ``doc_id`` reachable over links, null only if none of the
    component has an id. Null and empty texts and such without words have fingerprint zero and link
    like any other. Repeated rows are kept, each with the same result.
    """
    prints, roots = _linked(docs, width, threshold, parts)
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("doc"))
    of_root = roots.join(least, "fp").groupBy("root").agg(F.min("doc").alias("component_id"))
    classes = roots.join(of_root, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def similar_links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """One link per member to the first of its component: from, to. Sets of distinct hashes are linked
    if their Jaccard similarity is at least ``SIMILAR``.

    Such sets share one of their rarest members, of which as many count as the other may lack, and
    one more. A component grows by comparing its newest member with the sets outside it that do.
    """
    over, under = SIMILAR
    sizes = np.array([len(s) for s in sets], np.int64)
    label = np.full(len(sets), -1)
    empty = np.flatnonzero(sizes == 0)
    label[empty] = empty[:1]
    starts = np.cumsum(sizes) - sizes
    _, member, often = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True, return_counts=True)
    rank = np.empty(len(often), np.int64)
    rank[np.argsort(often, kind="stable")] = np.arange(len(often))
    member = rank.astype(np.int32)[member]
    for a, n in zip(starts.tolist(), sizes.tolist()):
        member[a : a + n].sort()
    few = np.where(sizes > 0, sizes + (-over * sizes // under) + 1, 0)
    at = spread(starts, few)
    rare, holder = member[at], np.repeat(np.arange(len(sets)), few)
    by = np.argsort(rare, kind="stable")
    holder, edge = holder[by], np.searchsorted(rare[by], np.arange(len(often) + 1))
    own = np.zeros(len(often), bool)
    outside = np.flatnonzero(label < 0)
    for first in range(len(sets)):
        if label[first] >= 0:
            continue
        label[first] = first
        todo = [first]
        while todo:
            i = todo.pop()
            outside = outside[label[outside] < 0]
            if not len(outside):
                break
            mine = member[starts[i] : starts[i] + sizes[i]]
            begin, stop = edge[mine[: few[i]]], edge[mine[: few[i]] + 1]
            near = outside
            if (stop - begin).sum() < sizes[outside].sum():
                near = np.unique(holder[spread(begin, stop - begin)])
                near = near[label[near] < 0]
            near = near[(under * np.minimum(sizes[near], sizes[i]) >= over * np.maximum(sizes[near], sizes[i])) & (sizes[near] > 0)]
            own[mine] = True
            for part in np.array_split(near, max(1, sizes[near].sum() // AT_ONCE)):
                if len(part):
                    hits = own[member[spread(starts[part], sizes[part])]]
                    shared = np.add.reduceat(hits, np.cumsum(sizes[part]) - sizes[part], dtype=np.int64)
                    part = part[under * shared >= over * (sizes[part] + sizes[i] - shared)]
                    label[part] = first
                    todo += part.tolist()
            own[mine] = False
    linked = np.flatnonzero(label != np.arange(len(sets)))
    return list(zip(linked.tolist(), label[linked].tolist()))


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of ranges, one range after another."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def text_links(members: DataFrame, width: int = SHINGLE, side: int = SIDE_BYTES) -> DataFrame:
    """Links ``u``, ``v`` of text hashes that connect exactly what links of similar texts of one ``root`` connect.

    ``members`` has ``root``, ``text_hash``, ``text``, and ``bytes``, the size of all texts of the
    root. A root of more than ``side`` bytes is cut into blocks, one for each pair of its parts.
    """
    n = F.ceil(F.col("bytes") / side).cast("int")
    mine = F.pmod(F.xxhash64("text_hash"), n).cast("int")
    every = F.transform(F.sequence(F.lit(0), n - 1), lambda c: F.struct(F.least(mine, c).alias("row"), F.greatest(mine, c).alias("col")))
    keys = ["root", "row", "col"]
    blocks = members.select("root", "text_hash", "text", F.inline(every))
    ordered = blocks.repartition(*keys).sortWithinPartitions(*keys, "text_hash")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in slices(batches):
            for *key, text_hash, text in zip(*(batch.column(c).to_pylist() for c in (*keys, "text_hash", "text"))):
                yield tuple(key), text_hash, np.unique(shingles(text, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u, v = [], []
        for _, block in groupby(rows(batches), itemgetter(0)):
            _, hashes, sets = zip(*block)
            for a, b in similar_links(list(sets)):
                u.append(hashes[a])
                v.append(hashes[b])
            if len(u) > CELL:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])
                u, v = [], []
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return ordered.mapInArrow(run, "u bigint, v bigint")


def _rows_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``docs`` with an id and text hash of ``wanted``, equal ones once, each as one struct
    ``row``, so its columns may have any names, beside the columns of ``wanted``."""
    hashed = docs.select(F.struct("*").alias("row"), F.xxhash64(text_of()).alias("hash"))
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
    once = W.partitionBy("row.doc_id", "hash").orderBy("row.doc_id")
    return hashed.join(wanted, same).withColumn("nth", F.row_number().over(once)).filter("nth = 1").drop("nth", "hash")


def _families(docs: DataFrame, width: int, families: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_bytes`` and the fingerprints ``fps`` of all families."""
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("text_hash", F.xxhash64("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, T.StructField("fps", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprints(t, width, families) for t in texts(batch)], np.uint64).view(np.int64)
            edges = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * families)
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(edges, pa.array(found.ravel()))], schema.names)

    return rows.mapInArrow(run, schema)


def _proposed(nodes: DataFrame, threshold: int, parts: int, families: int) -> DataFrame:
    """``family``, ``fp`` and ``root``, the same for all fingerprints of a component of that family.

    The families share every job: their anchors have part numbers of their own, so only
    fingerprints of one family meet.
    """
    spark = nodes.sparkSession
    distinct = stored(nodes.select(F.posexplode("fps").alias("family", "fp")).distinct(), "distinct")
    members = None
    for k in range(families):
        of_family = anchored(distinct.filter(F.col("family") == k), threshold, parts).withColumn("part", F.col("part") + k * parts)
        members = of_family if members is None else members.unionByName(of_family)
    members = stored(members, "members")
    found = stored(links(cells(members), threshold), "links")
    dropped(spark, members)
    joined = components(found)
    dropped(spark, found)
    return distinct.join(joined, distinct.fp == joined.u, "left").select("family", "fp", F.coalesce("v", "fp").alias("root"))


def _candidates(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``groups``, the candidates of several texts that the text belongs to
    as (``root``, ``bytes``); a candidate that several families propose counts once.

    Totals of a candidate are made and joined back by (candidate, salt), so one of a third of all
    texts is spread over ``SALTS`` keys.
    """
    salt = F.pmod(F.xxhash64("text_hash"), F.lit(SALTS)).cast("int")
    each = (
        nodes.select("row.doc_id", "text_hash", "n_bytes", F.posexplode("fps").alias("family", "fp")).join(roots, ["family", "fp"])
        .select("doc_id", "text_hash", "n_bytes", F.xxhash64("family", "root").alias("root"), salt.alias("salt"))
    )
    each = stored(each, "each")
    totals = each.groupBy("root", "salt").agg(
        F.count("*").alias("n"),
        F.sum("n_bytes").alias("bytes"),
        F.min("text_hash").alias("least"),
        F.bit_xor(F.xxhash64("text_hash")).alias("digest"),
    )
    groups = totals.groupBy("root").agg(
        F.sum("n").alias("n"),
        F.sum("bytes").alias("bytes"),
        F.min("least").alias("least"),
        F.bit_xor("digest").alias("digest"),
        F.collect_list("salt").alias("salts"),
    )
    same = groups.filter("n > 1").groupBy("n", "bytes", "least", "digest")
    # Texts without bytes make a block, too.
    once = same.agg(F.min_by(F.struct("root", "salts"), "root").alias("group")).select(
        "group.root", F.greatest("bytes", F.lit(1)).alias("bytes"), F.explode("group.salts").alias("salt")
    )
    asked = each.join(once, ["root", "salt"])
    return asked.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("root", "bytes")).alias("groups"))


def one_of_each(docs: DataFrame, width: int = 4, threshold: int = 4, parts: int = 3, families: int = 1) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the one of the smallest id
    (rows without an id last), by text hash where an id repeats; of equal rows one.

    Fingerprints only propose: rows are linked if links of fingerprints of one of the ``families`` connect
    them and the Jaccard similarity of their shingles of ``SHINGLE`` words is at least ``SIMILAR``.
    """
    spark = docs.sparkSession
    this = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    prints = _families(docs, width, families)
    nodes = stored(prints.groupBy("text_hash", "fps").agg(F.min(this).alias("row"), F.max("n_bytes").alias("n_bytes")), "nodes")
    asked = _candidates(nodes, _proposed(nodes, threshold, parts, families))
    rows = _rows_of(docs.select("doc_id", "text"), asked).select("text_hash", text_of("row.text").alias("text"), F.inline("groups"))
    found = stored(text_links(rows), "similar")
    joined = components(found).withColumnRenamed("u", "text_hash")
    dropped(spark, found)
    kept = (
        nodes.join(joined, "text_hash", "left").groupBy(F.coalesce("v", "text_hash").alias("class")).agg(F.min("row").alias("row"))
        .select("row.doc_id", "row.text_hash")
    )
    return _rows_of(docs, kept).select("row.*")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def classes(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")
