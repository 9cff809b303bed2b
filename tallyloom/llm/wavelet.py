"""Token ids in wavelet-matrix shards.

A shard holds the ids of neighbouring documents as bit-planes: plane by plane from the highest bit,
the ids are parted stably by the bit, zeros first. Ranks over the planes answer which id stands at a
place, how often an id occurs and where its k-th occurrence is, without decoding the rest. Planes
are cut into blocks that are compressed one by one, so such a lookup unpacks one block per plane.

Layout of a shard, little-endian: MAGIC; nine int64 (ids, bits, documents, block bytes, then the
bytes of the five parts); parts: doc_ids with a validity byte each, lengths, zeros per plane, per
block its end and the ones before it, the blocks. All parts but the blocks are compressed whole.
"""

from __future__ import annotations

import os
import zlib
from collections import OrderedDict
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm import bytewords as bw
from tallyloom.llm.base import column, query, table
from tallyloom.session import unique_path

MAGIC = b"TLWM0001"
BLOCK = 1 << 14  # bytes of a plane compressed together
SHARD_TOKENS = 1 << 21
#: Bytes of text sorted into one partition.
PARTITION_BYTES = 32 << 20
END = 0


class Shard:
    """One shard, read from its bytes. Blocks are unpacked when a lookup touches them."""

    def __init__(self, data: bytes):
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token shard")
        head = np.frombuffer(data, np.int64, 9, len(MAGIC)).tolist()
        self.n, self.bits, n_docs, self.block, *sizes = head
        at, parts = len(MAGIC) + 72, []
        for size in sizes[:4]:
            parts.append(zlib.decompress(data[at : at + size]))
            at += size
        self._data, self._blocks = data, at
        ids = np.frombuffer(parts[0], np.int64, n_docs)
        known = np.frombuffer(parts[0], np.uint8, n_docs, 8 * n_docs)
        self.doc_ids = [i if k else None for i, k in zip(ids.tolist(), known.tolist())]
        self.lengths = np.frombuffer(parts[1], np.int64)
        self.zeros = np.frombuffer(parts[2], np.int64)
        self._ends, self._ones = np.frombuffer(parts[3], np.int64).reshape(2, self.bits, -1)
        self._unpacked: OrderedDict = OrderedDict()

    def _plane_block(self, plane: int, block: int) -> np.ndarray:
        """Bytes of one block of a plane."""
        key = plane, block
        if key not in self._unpacked:
            if len(self._unpacked) > 4 * self.bits:
                self._unpacked.popitem(last=False)
            flat = self._ends.ravel()
            i = plane * self._ends.shape[1] + block
            begin = flat[i - 1] if i else 0
            raw = self._data[self._blocks + begin : self._blocks + flat[i]]
            self._unpacked[key] = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
        return self._unpacked[key]

    def _bit(self, plane: int, i: int) -> int:
        block = self._plane_block(plane, i // 8 // self.block)
        return int(block[i // 8 % self.block] >> (i % 8) & 1)

    def _rank1(self, plane: int, i: int) -> int:
        """Ones before place i of a plane."""
        if i == 0:
            return 0
        b, rest = divmod(i - 1, self.block * 8)
        block, rest = self._plane_block(plane, b), rest + 1
        ones = int(np.bitwise_count(block[: rest // 8]).sum())
        if rest % 8:
            ones += (int(block[rest // 8]) & ((1 << rest % 8) - 1)).bit_count()
        return int(self._ones[plane, b]) + ones

    def _down(self, plane: int, bit: int, i: int) -> int:
        ones = self._rank1(plane, i)
        return int(self.zeros[plane]) + ones if bit else i - ones

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane in range(self.bits):
            bit = self._bit(plane, i)
            value = value << 1 | bit
            i = self._down(plane, bit, i)
        return value

    def _range(self, token: int, stop: int) -> tuple[int, int]:
        if token < 0 or token >> self.bits:
            return 0, 0
        a, b = 0, stop
        for plane in range(self.bits):
            bit = token >> (self.bits - 1 - plane) & 1
            a, b = self._down(plane, bit, a), self._down(plane, bit, b)
        return a, b

    def rank(self, token: int, stop: int) -> int:
        """Occurrences of an id before place `stop`."""
        a, b = self._range(token, min(stop, self.n))
        return b - a

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Place of the k-th occurrence of an id, from 0."""
        a, b = self._range(token, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        at = a + k
        for plane in reversed(range(self.bits)):
            bit = token >> (self.bits - 1 - plane) & 1
            wanted = at - int(self.zeros[plane]) if bit else at
            low, high = 0, self.n - 1  # the place whose bit is the wanted-th of its kind
            while low < high:
                middle = (low + high) // 2
                ones = self._rank1(plane, middle + 1)
                if (ones if bit else middle + 1 - ones) > wanted:
                    high = middle
                else:
                    low = middle + 1
            at = low
        return at

    @cached_property
    def tokens(self) -> np.ndarray:
        """All ids in order, from the lowest plane up."""
        values = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for plane in reversed(range(self.bits)):
            packed = [self._plane_block(plane, b) for b in range(self._ends.shape[1])]
            raw = np.concatenate(packed) if packed else np.empty(0, np.uint8)
            ones = np.unpackbits(raw, count=self.n, bitorder="little").view(bool)
            zeros = int(self.zeros[plane])
            above = np.empty_like(values)
            above[~ones] = values[:zeros]
            above[ones] = values[zeros:] | values.dtype.type(1 << (self.bits - 1 - plane))
            values = above
        return values.astype(np.uint32)


def encode_shard(tokens: np.ndarray, doc_ids: list, lengths: list[int]) -> bytes:
    n = len(tokens)
    bits = max(1, int(tokens.max()).bit_length()) if n else 1
    values = tokens.astype(np.uint16 if bits <= 16 else np.uint32)
    n_blocks = -(-n // (8 * BLOCK))
    zeros = np.zeros(bits, np.int64)
    ends, ones = np.zeros((2, bits, n_blocks), np.int64)
    blocks, total = [], 0
    pack = zstandard.ZstdCompressor(level=1).compress
    for plane in range(bits):
        bit = (values >> values.dtype.type(bits - 1 - plane)) & 1 == 1
        raw = np.packbits(bit, bitorder="little")
        seen = 0
        for b in range(n_blocks):
            part = raw[b * BLOCK : (b + 1) * BLOCK]
            blocks.append(pack(part.tobytes()))
            total += len(blocks[-1])
            ends[plane, b], ones[plane, b] = total, seen
            seen += int(np.bitwise_count(part).sum())
        zeros[plane] = n - seen
        values = np.concatenate((values[~bit], values[bit]))
    known = np.array([i is not None for i in doc_ids], np.uint8)
    ids = np.array([i or 0 for i in doc_ids], np.int64)
    parts = [
        zlib.compress(ids.tobytes() + known.tobytes()),
        zlib.compress(np.array(lengths, np.int64).tobytes()),
        zlib.compress(zeros.tobytes()),
        zlib.compress(np.stack((ends, ones)).tobytes()),
    ]
    head = [n, bits, len(doc_ids), BLOCK, *(len(p) for p in parts), total]
    return b"".join([MAGIC, np.array(head, np.int64).tobytes(), *parts, *blocks])


_BYTE = np.arange(256)
_GRAPHIC = (_BYTE > 32) & (_BYTE < 127)
_ASCII_LETTER = ((_BYTE | 32) >= 97) & ((_BYTE | 32) <= 122) & (_BYTE < 128)
_LEAD = (_BYTE >= 0xC3) & (_BYTE <= 0xDF)  # first byte of U+00C0 to U+07FF: no white space there


def cut_pieces(buffer: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pieces of the texts in a buffer begin; every text is followed by one blank.

    The tokenizer never joins what stands before a single blank between two other characters with
    what follows, nor a Latin letter with a point or comma behind it. Where a character could be
    white space of another script, nothing is cut.
    """
    padded = np.concatenate((np.zeros(2, np.uint8), buffer, np.zeros(1, np.uint8)))
    two, one, here, after = padded[:-3], padded[1:-2], padded[2:-1], padded[3:]
    solid_before = _GRAPHIC[one] | ((one >= 0x80) & _LEAD[two])
    blank = (here == 32) & solid_before & (_GRAPHIC[after] | _LEAD[after])
    accented = ((two == 0xC3) & (one != 0x97) & (one != 0xB7)) | ((two >= 0xC4) & (two <= 0xC8))
    letter = _ASCII_LETTER[one] | ((one >= 0x80) & accented)
    point = ((here == 46) | (here == 44)) & letter
    first = blank | point
    first[starts[starts < len(first)]] = True
    return np.flatnonzero(first)


class Encoder:
    """Encodes texts piece by piece, each different piece once.

    Pieces are looked up by hash and then compared byte by byte with what was learned; should a hash
    mislead, the texts go to the tokenizer whole. Learned pieces are kept up to KNOWN bytes.
    """

    KNOWN = 16_000_000
    #: Size, as a power of two, of the table that finds most known pieces without a search.
    TABLE = 23
    #: New pieces handed to the tokenizer as one text; its overhead per text is large.
    TOGETHER = 512

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Strings that the tokenizer finds in a text before it cuts it.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        names = map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))
        # In a byte-level vocabulary every character of a token's name is one byte.
        self.lengths = np.array([len(n or "") for n in names], np.int64)
        self._forget()

    def _forget(self):
        self.hashes, self.slots = np.empty(0, np.uint64), np.empty(0, np.int64)
        # By the top bits of a hash, the last slot learned with them; what it holds is compared.
        self.table, self.slot_hashes = np.zeros(1 << self.TABLE, np.int32), np.zeros(1, np.uint64)
        self.raw, self.raw_begins = np.empty(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.begins = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _ask(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: bw.Words, new: np.ndarray, hashes: np.ndarray) -> None:
        """Learn the pieces at places `new`.

        Pieces that begin with a blank and end in a graphic ASCII character keep their borders when
        written one behind the other, so they are asked for together and told apart by their bytes.
        """
        starts, sizes = words.starts[new], words.ends[new] - words.starts[new]
        last = words.buffer[words.ends[new] - 1]
        plain = (words.buffer[starts] == 32) & (sizes > 1) & _GRAPHIC[last]
        order = np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain)))
        n = int(plain.sum())
        hashes, sizes = hashes[order], sizes[order]
        raw = words.buffer[_ranges(starts[order], sizes)]
        begins = np.concatenate(([0], np.cumsum(sizes)))
        cuts = begins[np.minimum(np.arange(0, n + self.TOGETHER, self.TOGETHER), n)].tolist()
        found = self._ask([raw[a:b].tobytes().decode() for a, b in zip(cuts, cuts[1:]) if b > a])
        ids = np.array([i for f in found for i in f], np.uint32)
        ends = np.cumsum(self.lengths[ids])
        stop = np.searchsorted(ends, begins[1 : n + 1])
        if n and (stop[-1] >= len(ends) or not np.array_equal(ends[stop], begins[1 : n + 1])):
            n, ids, stop = 0, ids[:0], stop[:0]  # not a vocabulary of bytes: ask for each piece
        counts = np.diff(stop + 1, prepend=0)
        cuts = begins[n:].tolist()
        alone = self._ask([raw[a:b].tobytes().decode() for a, b in zip(cuts, cuts[1:])])
        ids = np.concatenate((ids, np.array([i for f in alone for i in f], np.uint32)))
        counts = np.concatenate((counts, np.array([len(f) for f in alone], np.int64)))

        slots = len(self.begins) - 1 + np.arange(len(order))
        rank = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[rank])
        self.hashes = np.insert(self.hashes, at, hashes[rank])
        self.slots = np.insert(self.slots, at, slots[rank])
        self.slot_hashes = np.concatenate((self.slot_hashes[: slots[0]], hashes))
        self.table[self._top(hashes)] = slots
        self.raw = np.concatenate((self.raw, raw))
        self.raw_begins = np.concatenate((self.raw_begins, self.raw_begins[-1] + begins[1:]))
        self.ids = np.concatenate((self.ids, ids))
        self.begins = np.concatenate((self.begins, self.begins[-1] + np.cumsum(counts)))

    def _top(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.TABLE)).astype(np.int64)

    def _find(self, words: bw.Words) -> np.ndarray:
        """The slot of every piece; those not known are learned."""
        hashes = bw.hash_words(words)
        slot = self.table[self._top(hashes)].astype(np.int64)
        missed = np.flatnonzero(self.slot_hashes[slot] != hashes)
        if not len(missed):
            return slot
        unique, first, index = np.unique(hashes[missed], return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, unique)
        new = np.ones(len(unique), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != unique[inside]
        if new.any():
            self._learn(words, missed[first[new]], unique[new])
            at = np.searchsorted(self.hashes, unique)
        slot[missed] = self.slots[at][index]
        return slot

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each ended by END, and the number of each.

        Texts that hold the string of an added token go to the tokenizer whole, as it cuts them there.
        """
        holds = np.zeros(len(texts), bool)
        for token in self.added:
            holds |= pc.fill_null(pc.match_substring(texts, token), False).to_numpy(zero_copy_only=False)
        if not holds.any():
            return self._pieces(texts)
        flat, counts = self._pieces(pc.if_else(pa.array(holds), "", texts))
        parts = np.split(flat, np.cumsum(counts)[:-1])
        rows = np.flatnonzero(holds)
        for row, ids in zip(rows.tolist(), self._ask(texts.take(pa.array(rows)).to_pylist())):
            parts[row] = np.array([*ids, END], np.uint32)
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without added tokens, looked up piece by piece."""
        if len(self.raw) > self.KNOWN:
            self._forget()
        buffer, offsets = bw.spaced(texts)
        starts = cut_pieces(buffer, offsets[:-1])
        ends = np.append(starts[1:], len(buffer))
        final = np.searchsorted(starts, offsets[1:]) - 1  # last piece of each text
        ends[final] -= 1  # without the blank behind the text
        held = np.flatnonzero(ends > starts)
        words = bw.Words(buffer, starts[held], ends[held], held, held)
        slot = self._find(words)
        sizes = self.raw_begins[slot + 1] - self.raw_begins[slot]
        same = np.array_equal(sizes, words.ends - words.starts)
        # The pieces in a row are the texts without the blank behind each.
        if not same or not np.array_equal(
            self.raw[_ranges(self.raw_begins[slot], sizes)], np.delete(buffer, offsets[1:] - 1)
        ):
            found = [ids + [END] for ids in self._ask(pc.fill_null(texts, "").to_pylist())]
            return np.array([i for ids in found for i in ids], np.uint32), np.array([len(f) for f in found])
        counts = np.zeros(len(starts), np.int64)
        counts[held] = self.begins[slot + 1] - self.begins[slot]
        counts[final] += 1
        flat = np.full(int(counts.sum()), END, np.uint32)
        taken = self.begins[slot + 1] - self.begins[slot]
        goal = (np.cumsum(counts) - counts)[held]
        flat[_ranges(goal, taken)] = self.ids[_ranges(self.begins[slot], taken)]
        return flat, np.diff(np.concatenate(([0], np.cumsum(counts)[final])))


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker: what one task has learned the next need not learn again."""
    return Encoder(path)


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, ... of every range, in a row."""
    ends = np.cumsum(sizes)
    numbers = np.repeat(begins - (ends - sizes), sizes)
    numbers += np.arange(len(numbers))
    return numbers


def write_shards(documents: DataFrame, path: str, tokenizer: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode whole texts and write them in ascending doc_id order as shards.

    Each row of the Parquet table at `path` is one shard: `part` and `place` order the shards,
    `before` counts the ids of earlier shards of the part, `n_tokens` its own. Texts stay whole
    within a shard, so one very long text makes a larger shard. Null texts are empty; null doc_ids
    come first; rows with equal doc_id are ordered by their text. Other columns are not written.
    """
    spread = documents.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")
    )
    size = spread.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = ["doc_id", F.xxhash64("text")]
    parts = max(1, -(-size // PARTITION_BYTES), spread.sparkSession.sparkContext.defaultParallelism)
    ordered = spread.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def rows(batches):
        encode = encoder(tokenizer).encode
        part = TaskContext.get().partitionId()
        ids, doc_ids, lengths = [], [], []
        held = before = place = 0

        def shard():
            data = encode_shard(np.concatenate(ids), doc_ids, lengths)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([place], pa.int32()),
                    pa.array([before], pa.int64()),
                    pa.array([held], pa.int64()),
                    pa.array([data], pa.binary()),
                ],
                names=["part", "place", "before", "n_tokens", "shard"],
            )

        for batch in bw.chunks(batches, min(1 << 20, 4 * shard_tokens)):
            found, counts = encode(column(batch, "text"))
            ids.append(found)
            doc_ids += column(batch, "doc_id").to_pylist()
            lengths += counts.tolist()
            held += len(found)
            if held >= shard_tokens:
                yield shard()
                before, place, held = before + held, place + 1, 0
                ids, doc_ids, lengths = [], [], []
        if doc_ids:
            yield shard()

    ordered.mapInArrow(
        rows, "part int, place int, before long, n_tokens long, shard binary"
    ).write.option("compression", "none").parquet(path)


def read_documents(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """The documents of the shards at `path`: doc_id, start (ids of all documents before it),
    n_tokens (with the end id), ids_crc32 and, if wanted, `ids` themselves."""
    shards = spark.read.parquet(path)
    # One row per partition that was written, so few whatever the corpus.
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"))

    def rows(batches):
        for batch in batches:
            for part, before, data in zip(
                *(column(batch, n).to_pylist() for n in ("part", "before", "shard"))
            ):
                shard = Shard(data)
                ends = np.cumsum(shard.lengths)
                starts = ends - shard.lengths
                tokens = shard.tokens
                pieces = [tokens[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
                arrays = [
                    pa.array(np.full(len(pieces), part, np.int32)),
                    pa.array(shard.doc_ids, pa.int64()),
                    pa.array(starts + before),
                    pa.array(shard.lengths),
                    pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in pieces], pa.int64()),
                ]
                names = ["part", "doc_id", "start", "n_tokens", "ids_crc32"]
                if ids:
                    arrays.append(pa.array(pieces, pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "part int, doc_id long, start long, n_tokens long, ids_crc32 long"
    found = shards.select("part", "before", "shard").mapInArrow(
        rows, schema + (", ids array<long>" if ids else "")
    )
    return found.join(offsets, "part").withColumn("start", F.col("start") + F.col("offset")).drop(
        "part", "offset"
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoded(documents: DataFrame) -> DataFrame:
    """Write the shards of the documents to the shared folder and read them back."""
    spark = documents.sparkSession
    path = unique_path(spark, "token-shards")
    write_shards(documents, path, tokenizer_path())
    return read_documents(spark, path)


@query()
def op4_wavelet(spark, sf_dir):
    return encoded(table(spark, sf_dir, "documents"))
