"""Token ids in grammar-compressed binary shards (Re-Pair), with random access.

*File format.* A Parquet data set whose rows are blocks of whole documents in ascending order of
``doc_id``; binary columns hold little-endian integers:

==============  =====================================================================
part, block     range partition, and number of the block in it; they order the blocks
start           ids before the block within its part
doc_ids, sizes  of the block's documents in order, ids of each including the end id
rules           two 32-bit symbols for each rule; rule ``k`` is the symbol ``base + k``
lengths         32-bit expansion length of each rule
symbols         the compressed sequence, 32-bit
==============  =====================================================================

*Compression.* Rounds replace frequent adjacent pairs by new symbols until no pair is frequent
enough to pay for its rule. A round counts all pairs of a block, takes those above
a limit that falls from round to round, and replaces their occurrences where they do not overlap. A pair's symbols may be symbols of
earlier rounds, so rules nest. Once the limit is the lowest, a round looks only beside the places that the one before
replaced or could have replaced: no other pair can have become frequent.

*Decoding.* Expansion lengths turn a range of ids into a range of symbols; only these are expanded,
one level of rules at a time. A whole block is decoded by expanding each rule once.
"""

from __future__ import annotations

import hashlib
import os
import string
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.llm.bpe import WHITE_SPACE_RUN
from vitals.llm.tables import slices, stored, text_of, texts

END_ID = 2
BLOCK_IDS = 1 << 20
LEAST = 8
RECENT = 2_000_000
PLACES = 64
JOINED = 64
BUCKET_BITS = 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the lowest bytes of a word

# What a byte can be, as bits.
SPACE, LINE_END, LETTER, SIGN, WHITE, WIDE = 1, 2, 4, 8, 16, 32
LEADS = (0xC2, 0xE1, 0xE2, 0xE3)  # first bytes of all white space beyond ASCII


class Encoder:
    """The vocabulary's own library, asked once for each recent chunk of text.

    Texts are cut, as bytes and all at once in numpy, before each space, around line ends, and between a letter
    (ASCII or Latin-1) and an ASCII punctuation mark other than the apostrophe and those of special tokens.
    Where no two white spaces meet, no word of the vocabulary's pattern crosses such a cut; texts in which they do
    meet are encoded as a whole. Chunks are known by a 64-bit hash, mixed from their size and their bytes, eight at a time.
    Unknown chunks that begin with a space are asked for in long strings, of which every token with a space opens a chunk.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocabulary = self.library.get_vocab()
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        special = "".join(token.content for token in self.library.get_added_tokens_decoder().values())
        self.kinds = byte_kinds("".join(sorted(set(string.punctuation) - set(special) - {"'"})))
        self.forget()

    def forget(self) -> None:
        self.known, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # keys in order, and their slots
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)  # of each slot's ids
        self.ids = np.zeros(0, np.uint32)

    def ask(self, asked: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(asked, add_special_tokens=False)]

    def ask_chunks(self, chunks: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """An order of the chunks, their numbers of ids, and their ids, in that order."""
        joined = [i for i, c in enumerate(chunks) if c[0] == " " and not c[-1].isspace()] if self.opens.any() else []
        groups = [joined[i : i + JOINED] for i in range(0, len(joined), JOINED)]
        order, sizes, found = [], [], []
        for group, answer in zip(groups, self.ask(["".join([chunks[i] for i in g]) for g in groups])):
            ids = np.array(answer, np.uint32)
            first = np.flatnonzero(self.opens[ids])
            # Anything else, such as a special token that takes the space, is asked for by itself.
            if len(first) == len(group) and first[0] == 0:
                order += group
                sizes.append(np.diff(np.append(first, len(ids))))
                found.append(ids)
        rest = sorted(set(range(len(chunks))) - set(order))
        answers = self.ask([chunks[i] for i in rest])
        sizes.append(np.array([len(x) for x in answers], np.int64))
        found.append(np.fromiter(chain.from_iterable(answers), np.uint32, int(sizes[-1].sum())))
        return order + rest, np.concatenate(sizes), np.concatenate(found)

    def encode(self, rows: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text."""
        raws = [t.encode() for t in rows]
        whole = set(self.white_runs(rows, raws))
        out = [np.zeros(0, np.uint32)] * len(rows)
        rest = sorted(whole)
        for i, ids in zip(rest, self.ask([rows[i] for i in rest])):
            out[i] = np.array(ids, np.uint32)
        cut = [i for i, raw in enumerate(raws) if raw and i not in whole]
        for i, ids in zip(cut, self.encode_cut([raws[i] for i in cut])):
            out[i] = ids
        return out

    def white_runs(self, rows: Sequence[str], raws: list[bytes]) -> list[int]:
        """Numbers of the texts in which white space meets white space."""
        kinds = np.frombuffer(b"".join(raws).translate(self.kinds), np.uint8)
        maybe = kinds & WIDE > 0
        maybe[1:] |= kinds[1:] & kinds[:-1] & WHITE > 0
        ends = np.cumsum([len(raw) for raw in raws])
        some = np.unique(np.searchsorted(ends, np.flatnonzero(maybe), "right"))
        return [i for i in some.tolist() if WHITE_SPACE_RUN.search(rows[i])]

    def encode_cut(self, raws: list[bytes]) -> list[np.ndarray]:
        if not raws:
            return []
        buffer = b"".join(raws)
        begins = np.cumsum([0, *map(len, raws)])
        starts = chunk_starts(buffer, begins, self.kinds)
        sizes = np.diff(np.append(starts, len(buffer)))
        codes, kinds = pd.factorize(chunk_keys(buffer, starts, sizes))
        slots = self.slots(kinds, codes, starts, sizes, buffer)[codes]
        n = self.size[slots]
        ends = np.cumsum(n)
        ids = self.ids[np.repeat(self.first[slots] - ends + n, n) + np.arange(ends[-1])]
        chunk = np.searchsorted(starts, begins[1:-1])
        return np.split(ids, (ends - n)[chunk])

    def slots(self, kinds: np.ndarray, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, buffer: bytes) -> np.ndarray:
        """Slots of the distinct chunks; unknown ones are encoded and remembered."""
        if len(self.known) > RECENT:
            self.forget()
        order = np.argsort(kinds)
        keys = kinds[order]
        place = np.searchsorted(self.known, keys)
        have = np.append(self.known, np.uint64(0))[place] == keys
        have &= place < len(self.known)
        found = np.empty(len(keys), np.int64)
        found[have] = self.slot[place[have]]
        new = np.flatnonzero(~have)
        if len(new):
            sample = np.empty(len(kinds), np.int64)
            sample[codes] = np.arange(len(codes))
            at = sample[order[new]]
            asked = [buffer[a:b].decode() for a, b in zip(starts[at].tolist(), (starts[at] + sizes[at]).tolist())]
            turn, n, ids = self.ask_chunks(asked)
            found[new[turn]] = len(self.size) + np.arange(len(new))
            self.known = np.insert(self.known, place[new], keys[new])
            self.slot = np.insert(self.slot, place[new], found[new])
            self.first = np.append(self.first, len(self.ids) + np.cumsum(n) - n)
            self.size = np.append(self.size, n)
            self.ids = np.append(self.ids, ids)
        out = np.empty(len(kinds), np.int64)
        out[order] = found
        return out


def byte_kinds(signs: str) -> bytes:
    """What each of the 256 bytes can be."""
    kinds = np.zeros(256, np.uint8)
    kinds[[ord(" "), ord("\n")]] |= SPACE
    kinds[ord("\n")] |= LINE_END
    kinds[list(string.ascii_letters.encode())] |= LETTER
    kinds[list(signs.encode())] |= SIGN
    kinds[[i for i in range(128) if chr(i).isspace()]] |= WHITE
    kinds[list(LEADS)] |= WIDE
    return kinds.tobytes()


def chunk_starts(buffer: bytes, begins: np.ndarray, kinds: bytes) -> np.ndarray:
    """Where chunks begin, in texts one after another that begin at ``begins``."""
    kind, data = np.frombuffer(buffer.translate(kinds), np.uint8), np.frombuffer(buffer, np.uint8)
    start = kind & SPACE > 0
    start[1:] |= kind[:-1] & LINE_END > 0
    sign = np.flatnonzero(kind & SIGN)
    sign = sign[sign >= 2]  # in the first two bytes of all, a cut would only be left out
    before = data[sign - 1]
    # The letters from U+00C0 to U+00FF are 0xC3 and one byte; two of these are signs of arithmetic.
    latin = (data[sign - 2] == 0xC3) & (before != 0x97) & (before != 0xB7)
    start[sign[(kind[sign - 1] & LETTER > 0) | latin]] = True
    start[begins[:-1]] = True
    return np.flatnonzero(start)


def chunk_keys(buffer: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each chunk."""
    words = np.frombuffer(buffer + bytes(16 - len(buffer) % 8), "<u8")

    def word(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        i, shift = at >> 3, (at & 7).astype(np.uint64) << np.uint64(3)
        low = words[i] >> shift
        low |= words[i + 1] << np.uint64(1) << (np.uint64(63) - shift)
        return low & MASKS[np.minimum(left, 8)]

    def mixed(key: np.ndarray) -> np.ndarray:
        key ^= key >> np.uint64(32)
        key *= MULTIPLIER
        key ^= key >> np.uint64(29)
        key *= MULTIPLIER
        key ^= key >> np.uint64(32)
        return key

    found = mixed(word(starts, sizes) ^ (sizes.astype(np.uint64) * MULTIPLIER))
    some = np.flatnonzero(sizes > 8)
    for done in range(8, PLACES, 8):
        found[some] = mixed(found[some] ^ word(starts[some] + done, sizes[some] - done))
        some = some[sizes[some] > done + 8]
    for i in some:  # longer ones by a digest of all their bytes
        digest = hashlib.blake2b(buffer[starts[i] : starts[i] + sizes[i]], digest_size=8).digest()
        found[i] = int.from_bytes(digest, "little")
    return found


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def skipped(symbols: np.ndarray) -> np.ndarray:
    """Every second pair in runs of one symbol, by the places where the pairs begin."""
    equal = symbols[1:] == symbols[:-1]
    same = np.flatnonzero(equal[1:] & equal[:-1]) + 1
    first = np.flatnonzero(np.diff(same, prepend=-2) != 1)
    place = np.arange(len(same)) - np.repeat(first, np.diff(np.append(first, len(same))))
    return same[place % 2 == 0]


def compress(ids: np.ndarray, base: int, rounds: int | None = None, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules, their expansion lengths, and the remaining symbols; ``base`` exceeds every id.

    Without ``rounds`` it ends when no pair occurs ``least`` times without overlap. Counts are exact; hash
    buckets only leave out pairs that cannot reach the limit.
    """
    symbols = ids.astype(np.uint32)
    rules, sizes, limit, turn = [np.empty((0, 2), np.uint32)], np.ones(0, np.int64), 0, 0
    live = None  # where a frequent pair may begin; at first everywhere
    while len(symbols) >= 2 and (rounds is None or turn < rounds):
        where = slice(None) if live is None else np.flatnonzero(live)
        left, right = symbols[:-1][where], symbols[1:][where]
        keys = left.astype(np.uint64)
        keys <<= np.uint64(32)
        keys |= right
        bits = BUCKET_BITS if live is None else min(BUCKET_BITS, len(keys).bit_length() + 2)
        bucket = ((keys * MULTIPLIER) >> np.uint64(64 - bits)).view(np.int64)
        most = np.bincount(bucket, minlength=1 << bits)
        # In a run of one symbol every second pair counts: only these can all be replaced.
        none = skipped(symbols) if (left == right).any() else np.empty(0, np.int64)
        if live is not None:
            none = np.flatnonzero(np.isin(where, none))
        np.subtract.at(most, bucket[none], 1)
        # The limit falls by rounds from a share of the highest count to the least that pays.
        limit = max(least, int(most.max()) // 16 if turn == 0 else limit // 16)
        turn += 1
        likely = (most >= limit)[bucket]
        likely[none] = False
        likely = np.flatnonzero(likely)
        at = likely if live is None else where[likely]
        codes, kinds = pd.factorize(keys[likely])
        counts = np.bincount(codes, minlength=len(kinds))
        frequent = (counts >= limit)[codes]
        at, codes = at[frequent], codes[frequent]
        if not len(at):
            if limit == least:
                break
            continue
        # Where two occurrences overlap the more frequent pair is taken, so the first of all keeps every one.
        order = np.empty(len(kinds), np.int64)
        # Equal counts are ordered by hash, as an order along the text would let only one of a chain through.
        order[np.lexsort((kinds * MULTIPLIER, counts))] = np.arange(len(kinds))
        prior = order[codes]
        beside = np.diff(at) == 1
        free = np.ones(len(at), bool)
        free[1:] &= ~(beside & (prior[:-1] > prior[1:]))
        free[:-1] &= ~(beside & (prior[1:] > prior[:-1]))
        watched = np.zeros(len(symbols), bool)
        if limit == least:
            for step in (-1, 0, 1):
                watched[at[at + step >= 0] + step] = True
        taken = np.bincount(codes[free], minlength=len(kinds)) >= least
        free &= taken[codes]
        at, codes, chosen = at[free], codes[free], np.flatnonzero(taken)
        rule = np.stack([kinds[chosen] >> np.uint64(32), kinds[chosen] & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
        number = np.zeros(len(kinds), np.uint32)
        number[chosen] = base + len(sizes) + np.arange(len(chosen))
        symbols[at] = number[codes]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols = symbols[keep]
        live = watched[keep][:-1] if limit == least else None
        side = np.append(sizes, 1)[np.where(rule >= base, rule.astype(np.int64) - base, -1)]
        rules.append(rule)
        sizes = np.append(sizes, side.sum(1))
    return np.concatenate(rules), sizes, symbols


def expand(rules: np.ndarray, base: int, symbols: np.ndarray) -> np.ndarray:
    """All ids of a sequence of symbols, one level of rules at a time."""
    while len(symbols) and symbols.max() >= base:
        rule = symbols >= base
        sizes = np.where(rule, 2, 1)
        at = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.uint32)
        out[at] = symbols
        out[at[rule]] = rules[symbols[rule] - base, 0]
        out[at[rule] + 1] = rules[symbols[rule] - base, 1]
        symbols = out
    return symbols


def expand_block(rules: np.ndarray, lengths: np.ndarray, base: int, symbols: np.ndarray) -> np.ndarray:
    """All ids of a whole block: each rule is expanded once, then every symbol looks its ids up."""
    sizes = np.concatenate([np.ones(base, np.int64), lengths.astype(np.int64)])
    begins = np.cumsum(sizes) - sizes
    store = np.empty(int(sizes.sum()), np.uint32)
    store[:base] = np.arange(base)

    def ids_of(some: np.ndarray) -> np.ndarray:
        n = sizes[some]
        ends = np.cumsum(n)
        return store[np.repeat(begins[some] - ends + n, n) + np.arange(int(n.sum()))]

    # Rules up to the first that uses one of them do not depend on each other.
    newest, done = rules.max(1, initial=0), 0
    while done < len(rules):
        waits = newest[done:] >= base + done
        stop = done + int(waits.argmax()) if waits.any() else len(rules)
        ids = ids_of(rules[done:stop].ravel())
        store[begins[base + done] : begins[base + done] + len(ids)] = ids
        done = stop
    return ids_of(symbols)


def read_range(block: dict, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block; only the symbols that reach into it are expanded."""
    rules, lengths, symbols, base = unpacked(block)
    rule = symbols >= base
    sizes = np.ones(len(symbols), np.int64)
    sizes[rule] = lengths[symbols[rule] - base]
    ends = np.cumsum(sizes)
    first = int(np.searchsorted(ends, start, "right"))
    last = int(np.searchsorted(ends, stop, "left")) + 1
    ahead = int(ends[first] - sizes[first]) if first < len(ends) else 0
    return expand(rules, base, symbols[first:last])[start - ahead : stop - ahead]


def unpacked(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    rules = np.frombuffer(block["rules"], "<u4").reshape(-1, 2)
    return rules, np.frombuffer(block["lengths"], "<u4"), np.frombuffer(block["symbols"], "<u4"), block["base"]


BLOCK = pa.schema(
    [("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()), ("base", pa.int64())]
    + [("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))]
    + [(c, pa.binary()) for c in ("rules", "lengths", "symbols")]
)
BLOCK_DDL = (
    "part int, block int, start bigint, n_ids bigint, base bigint, doc_ids array<bigint>, sizes array<bigint>, "
    "rules binary, lengths binary, symbols binary"
)


def write_shards(docs: DataFrame, path: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of all documents, written in the shared folder and read back.

    ``path`` is the vocabulary. A null text is empty and has the end id only; rows without an id
    come first; rows of equal id are all kept, in the order of a hash of their texts. A document is
    never split, so a block exceeds ``block_ids`` only if one document does.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, part = encoder(path), TaskContext.get().partitionId()
        base = max(library.library.get_vocab_size(), end_id + 1)
        end = np.array([end_id], np.uint32)
        held, ids, number, start = [], 0, 0, 0

        def close() -> pa.RecordBatch:
            data = np.concatenate([d for _, own in held for d in (own, end)])
            rules, lengths, symbols = compress(data, base)
            block = {
                "part": part,
                "block": number,
                "start": start,
                "n_ids": len(data),
                "base": base,
                "doc_ids": [i for i, _ in held],
                "sizes": [len(d) + 1 for _, d in held],
                "rules": rules.astype("<u4").tobytes(),
                "lengths": lengths.astype("<u4").tobytes(),
                "symbols": symbols.astype("<u4").tobytes(),
            }
            return pa.RecordBatch.from_pylist([block], BLOCK)

        for batch in slices(batches, 4 << 20):
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), library.encode(texts(batch))):
                if held and ids + len(data) + 1 > block_ids:
                    yield close()
                    number, start, held, ids = number + 1, start + ids, [], 0
                held.append((doc_id, data))
                ids += len(data) + 1
        if held:
            yield close()

    return stored(ordered.mapInArrow(run, BLOCK_DDL), "token-blocks")


DOCUMENTS = "part int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def read_documents(blocks: DataFrame) -> DataFrame:
    """Per document, from the blocks alone: ids before it in all, its number of ids, their crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                rules, lengths, symbols, base = unpacked(block)
                data = memoryview(expand_block(rules, lengths, base, symbols).astype("<u4")).cast("B")
                sizes = np.array(block["sizes"], np.int64)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(sizes), block["part"], np.int32)),
                        pa.array(block["doc_ids"], pa.int64()),
                        pa.array(block["start"] + starts),
                        pa.array(sizes),
                        pa.array(crc, pa.int64()),
                    ],
                    ["part", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # One total for each range partition, of which there are as many as the session shuffles to.
    totals = sorted(blocks.groupBy("part").agg(F.sum("n_ids")).collect())
    ahead = [0, *np.cumsum([n for _, n in totals]).tolist()]
    offsets = blocks.sparkSession.createDataFrame([(p, a) for (p, _), a in zip(totals, ahead)] , "_part int, _ahead bigint")
    found = blocks.mapInArrow(run, DOCUMENTS)
    return found.join(F.broadcast(offsets), F.col("part") == F.col("_part")).select(
        "doc_id", (F.col("start") + F.col("_ahead")).alias("start"), "n_tokens", "ids_crc32"
    )
