"""Token-id files: a wavelet matrix per shard.

Documents are dealt into ranges of doc_id and encoded there, in ascending order. A shard
is a run of whole documents. Its ids are kept as bit-planes: plane k has bit k (the
highest first) of every id, in the order that a stable sort by the planes before leaves,
zeros first. With a count of ones for every 512 bits that gives any token (``access``),
the number of times a token occurs in any stretch (``rank``) and the places where it
does (``positions``) from the planes themselves, without the ids being written out.

A shard is one row, and one file, of a Parquet table in the shared folder:

    task, shard     its place: the range it belongs to, and its number there, both rising
    n_tokens        with the end ids
    payload         MAGIC, n_docs and n_tokens as 64-bit numbers; doc_id (64 bit) and
                    whether it is null (8 bit) of each document; n_docs + 1 starts within
                    the shard (64 bit); ones before each block of 512 bits (32 bit) and the
                    bits, lowest first, plane by plane. Numbers are little-endian.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from neumata.llm.shared import Scratch

MAGIC = b"WAVELET1"
PLANES = 16
BLOCK = 512
END = 1
VOCABULARY = "word_bpe_49k"
#: Ids at which a shard is closed, with the document that reaches them.
SHARD_TOKENS = 1 << 21
#: Words that a worker remembers; beyond it forgets all. Bytes of text that it encodes at a time.
MEMORY, STEP = 1_000_000, 8 << 20
TABLE = "task int, shard int, n_docs long, n_tokens long, payload binary"


class Shard:
    """Ids of a run of documents, read from its planes. ``rank``, ``access`` and ``positions`` take and give arrays."""

    def __init__(self, payload: bytes):
        if payload[:8] != MAGIC:
            raise ValueError("not a token shard")
        self.n_docs, self.n = (int(x) for x in np.frombuffer(payload, "<u8", 2, 8))
        at = 24
        take = lambda kind, n: np.frombuffer(payload, kind, n, at)
        self.doc_ids, at = take("<i8", self.n_docs), at + 8 * self.n_docs
        self.nameless, at = take("u1", self.n_docs), at + self.n_docs
        self.starts, at = take("<u8", self.n_docs + 1).astype(np.int64), at + 8 * (self.n_docs + 1)
        blocks = self.n // BLOCK + 1
        self.before, self.words = [], []
        for _ in range(PLANES):
            self.before.append(take("<u4", blocks + 1))
            at += 4 * (blocks + 1)
            self.words.append(take("<u8", blocks * BLOCK // 64))
            at += blocks * BLOCK // 8
        self.zeros = [self.n - int(b[-1]) for b in self.before]

    @staticmethod
    def pack(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
        n, blocks = len(ids), len(ids) // BLOCK + 1
        parts = [
            MAGIC,
            np.array([len(doc_ids), n], "<u8").tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], "u1").tobytes(),
            np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype("<u8").tobytes(),
        ]
        for k in reversed(range(PLANES)):
            one = (ids >> np.uint16(k)) & np.uint16(1) > 0
            bits = np.zeros(blocks * BLOCK // 8, np.uint8)
            bits[: -(-n // 8)] = np.packbits(one, bitorder="little")
            ones = np.bitwise_count(bits.view("<u8")).reshape(blocks, -1).sum(1, dtype=np.uint32)
            parts += [np.concatenate([[0], np.cumsum(ones)]).astype("<u4").tobytes(), bits.tobytes()]
            ids = np.concatenate([ids.take(np.flatnonzero(~one)), ids.take(np.flatnonzero(one))])
        return b"".join(parts)

    def _bit(self, plane: int, at: np.ndarray) -> np.ndarray:
        return (self.words[plane][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0

    def _ones(self, plane: int, at: np.ndarray) -> np.ndarray:
        """Ones before each place of a plane; places from 0 to n."""
        block = at // BLOCK
        words = self.words[plane].reshape(-1, BLOCK // 64)[block]
        left = np.clip((at % BLOCK)[:, None] - np.arange(0, BLOCK, 64), 0, 64)
        mask = np.where(left < 64, (np.uint64(1) << (left % 64).astype(np.uint64)) - np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF))
        return self.before[plane][block].astype(np.int64) + np.bitwise_count(words & mask).sum(1, dtype=np.int64)

    def _select(self, plane: int, value: int, k: np.ndarray) -> np.ndarray:
        """The place of the k-th bit (from 0) of a value."""
        blocks = np.arange(len(self.before[plane]), dtype=np.int64) * BLOCK
        passed = self.before[plane].astype(np.int64) if value else blocks - self.before[plane]
        block = np.searchsorted(passed, k, side="right") - 1
        bits = np.unpackbits(self.words[plane].reshape(-1, BLOCK // 64)[block].view(np.uint8), axis=1, bitorder="little")
        so_far = np.cumsum(bits == value, axis=1)
        return block * BLOCK + (so_far > (k - passed[block])[:, None]).argmax(1)

    def access(self, at: np.ndarray) -> np.ndarray:
        """The id at each place."""
        at, out = np.asarray(at, np.int64), np.zeros(len(at), np.int64)
        for p in range(PLANES):
            bit, ones = self._bit(p, at), self._ones(p, at)
            at = np.where(bit, self.zeros[p] + ones, at - ones)
            out = out << 1 | bit
        return out

    def _range(self, token: int, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for p in range(PLANES):
            one = token >> (PLANES - 1 - p) & 1
            low, high = ((self.zeros[p] + self._ones(p, x)) if one else x - self._ones(p, x) for x in (low, high))
        return low, high

    def rank(self, token: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """How often ``token`` stands from each ``low`` up to, but without, each ``high``."""
        if not 0 <= token < 1 << PLANES:
            return np.zeros(len(low), np.int64)
        low, high = self._range(token, np.asarray(low, np.int64), np.asarray(high, np.int64))
        return high - low

    def positions(self, token: int, batch: int = 4096) -> Iterator[np.ndarray]:
        """All places of ``token``, rising, some at a time."""
        if not 0 <= token < 1 << PLANES:
            return
        low, high = (int(x[0]) for x in self._range(token, np.zeros(1, np.int64), np.full(1, self.n)))
        for first in range(low, high, batch):
            at = np.arange(first, min(first + batch, high))
            for p in reversed(range(PLANES)):
                one = token >> (PLANES - 1 - p) & 1
                at = self._select(p, one, at - self.zeros[p] if one else at)
            yield at

    def ids(self) -> np.ndarray:
        """All ids, by undoing the sorts from the last plane to the first."""
        out = np.zeros(self.n, np.uint16)
        for p in reversed(range(PLANES)):
            one = np.unpackbits(self.words[p].view(np.uint8), count=self.n, bitorder="little").view(bool)
            up = np.empty_like(out)
            up[np.flatnonzero(~one)] = out[: self.zeros[p]]
            up[np.flatnonzero(one)] = out[self.zeros[p] :] | np.uint16(1 << (PLANES - 1 - p))
            out = up
        return out


#: Latin letters that are one sign after NFC, and whose small letters are.
LATIN = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
#: A letter and a sign after it, which the tokenizer parts. Signs of its own marks are not among them.
PARTED = f"([{LATIN}])([.,;:!?#$%&*])"


class Words:
    """Ids of words, each encoded once by the tokenizers library and remembered until there are MEMORY of them.

    Words of Latin letters alone come in small letters and are one piece each, so they go to the tokenizer's model past its
    normalizer and its pattern, which take longer than the model.
    """

    MARK = "<|endoftext|>"
    letters = re.compile(f"[{LATIN}]+")

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        self.mark_id = self.tokenizer.token_to_id(self.MARK)
        self.last = np.zeros(1 << PLANES, bool)  # ids that end a word
        self.last[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.ascii, self.latin = Tokenizer(self.tokenizer.model), Tokenizer(self.tokenizer.model)
        self.ascii.pre_tokenizer = WhitespaceSplit()
        self.latin.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.sizes = np.empty(0, np.uint16), np.empty(0, np.int32)

    @staticmethod
    def _encoded(tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint16)

    def _alone(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of one word, and their number."""
        ids = self._encoded(self.tokenizer, words[0])
        return ids, np.array([len(ids)])

    def _marked(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, and their numbers: a mark tells where a word ends."""
        ids = self._encoded(self.tokenizer, self.MARK.join(words))
        cuts = np.append(np.flatnonzero(ids == self.mark_id), len(ids))
        return ids[ids != self.mark_id], np.diff(cuts, prepend=-1) - 1

    def _single(self, tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are one piece each, and their numbers: the ids that end a piece tell."""
        ids = self._encoded(tokenizer, " ".join(words))
        return ids, np.diff(np.flatnonzero(self.last[ids]), prepend=-1)

    def learn(self, words: list[str]) -> None:
        kinds: tuple[list[str], ...] = [], [], [], []
        for w in words:
            if w.isascii():
                kinds[0 if w.isalpha() else 3 if self.MARK in w else 2].append(w)
            else:
                kinds[1 if self.letters.fullmatch(w) else 3 if self.MARK in w else 2].append(w)
        ways = (lambda x: self._single(self.ascii, x), 1000), (lambda x: self._single(self.latin, x), 1000), (self._marked, 1000), (self._alone, 1)
        ids, sizes = [self.ids], [self.sizes]
        for some, (encoded, step) in zip(kinds, ways, strict=True):
            for at in range(0, len(some), step):
                x, n = encoded(some[at : at + step])
                ids.append(x)
                sizes.append(n.astype(np.int32))
            self.number.update(zip(some, range(len(self.number), len(self.number) + len(some)), strict=True))
        self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)

    def numbers(self, words: list[str]) -> np.ndarray:
        """The numbers of words among ``sizes``. Words of ASCII or of Latin letters are taken in small letters, as the tokenizer does itself."""
        letters = self.letters.fullmatch
        keys = [w.lower() if ("<|" not in w if w.isascii() else letters(w)) else w for w in words]
        known = np.fromiter(map(self.number.get, keys, repeat(-1)), np.int64, len(keys))
        fresh = list(dict.fromkeys([keys[i] for i in np.flatnonzero(known < 0)]))
        if len(self.number) + len(fresh) > MEMORY or len(self.ids) > 16 * MEMORY:
            self.forget()
            known[:], fresh = -1, list(dict.fromkeys(keys))
        self.learn(fresh)
        new = np.flatnonzero(known < 0)
        known[new] = np.fromiter(map(self.number.__getitem__, [keys[i] for i in new]), np.int64, len(new))
        return known


@cache
def encoder(vocabulary: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """A function from texts to (their ids end to end, the number of ids of each).

    The tokenizer drops ASCII blanks and takes nothing across them, nor from a letter to
    a sign after it, so a text's ids are those of its words. Each different word of a
    batch is looked up once; the rest is array work.
    """
    words = Words(vocabulary)

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parted = pc.replace_substring_regex(pc.fill_null(texts, ""), PARTED, r"\1 \2")
        if not pc.any(pc.match_substring(parted, "<|")).as_py():  # marks are not read in small letters
            parted = pc.ascii_lower(parted)
        lists = pc.ascii_split_whitespace(parted)
        coded = lists.flatten().dictionary_encode()
        number = words.numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        first = np.cumsum(words.sizes, dtype=np.int32) - words.sizes
        number = number[coded.indices.to_numpy(zero_copy_only=False)]
        per_word = words.sizes[number]
        upto = np.cumsum(per_word, dtype=np.int32)
        at = np.repeat(first[number] - upto + per_word, per_word)
        at += np.arange(len(at), dtype=np.int32)
        bounds = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        return words.ids[at], np.diff(np.append(0, upto)[bounds], prepend=0)

    return encode


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``most`` bytes of text, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def shards(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """The shards of ``docs`` as rows of TABLE.

    Documents go in ascending doc_id (as a long, nulls first), those of one id by a hash of
    the text. A null text is an empty one, whose only id is ``end``. Repeated rows are
    repeated documents, and are told apart by their input partition alone, so that many of
    them do not meet in one range. Whole texts are read, of any length; a shard ends with
    a document, so memory is bounded by the longest one. An empty table has no shards.
    Columns beyond doc_id and text are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"), F.spark_partition_id().alias("from"))
    order = [F.col("doc_id").asc_nulls_first(), "tie", "from"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    types = pa.schema([("task", pa.int32()), ("shard", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(vocabulary), TaskContext.get().partitionId()
        names, lengths, held, n, shard = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            payload = Shard.pack(names, lengths, np.concatenate(held))
            return pa.RecordBatch.from_pylist([{"task": task, "shard": shard, "n_docs": len(names), "n_tokens": n, "payload": payload}], schema=types)

        for batch in (s for b in batches for s in _slices(b, STEP)):
            ids, sizes = encode(batch["text"])
            ends = np.cumsum(sizes)
            with_ends = np.insert(ids, ends, np.uint16(end))
            upto = ends + np.arange(1, len(ends) + 1)
            doc_ids, at = batch["doc_id"].to_pylist(), 0
            while at < len(doc_ids):
                low = upto[at - 1] if at else 0
                to = min(len(doc_ids), int(np.searchsorted(upto, low + shard_tokens - n)) + 1)
                names += doc_ids[at:to]
                lengths += (sizes[at:to] + 1).tolist()
                held.append(with_ends[low : upto[to - 1]])
                n += int(upto[to - 1] - low)
                at = to
                if n >= shard_tokens:
                    yield close()
                    names, lengths, held, n, shard = [], [], [], 0, shard + 1
        if names:
            yield close()

    return ordered.mapInArrow(run, TABLE)


def write(docs: DataFrame, path: str, **options) -> None:
    """Write the ``shards`` of ``docs`` to a folder, one file each."""
    shards(docs, **options).write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The shards in a folder with first, the number of ids in all shards before: totals of the ranges are summed over the
    ranges alone (one row a task of the writer), those within a range over its shards."""
    table = spark.read.schema(TABLE).parquet(path)
    sizes = table.select("task", "shard", "n_tokens")
    tasks = sizes.groupBy("task").agg(F.sum("n_tokens").alias("n"))
    tasks = tasks.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("before"))
    within = F.sum("n_tokens").over(Window.partitionBy("task").orderBy("shard")) - F.col("n_tokens")
    starts = sizes.withColumn("within", within).join(tasks, "task").select("task", "shard", (F.col("before") + F.col("within")).alias("first"))
    return table.join(F.broadcast(starts), ["task", "shard"]) if _few(starts) else table.join(starts, ["task", "shard"])


def _few(starts: DataFrame, rows: int = 100_000) -> bool:
    return starts.limit(rows + 1).count() <= rows


def _each(table: DataFrame, schema: str, rows: Callable[[Shard, int], Iterator[pa.RecordBatch]]) -> DataFrame:
    """What ``rows`` gives of every shard and its first place in the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, first in zip(batch["payload"], batch["first"].to_pylist(), strict=True):
                yield from rows(Shard(payload.as_py()), first)

    return table.select("payload", "first").mapInArrow(run, schema)


def documents(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """Per document in a folder: doc_id, start (ids of all documents before), n_tokens and ids_crc32, and with ``ids`` the ids."""

    def rows(shard: Shard, first: int) -> Iterator[pa.RecordBatch]:
        every = shard.ids().astype("<u4")
        low, high = shard.starts[:-1], shard.starts[1:]
        names = pa.array(shard.doc_ids, pa.int64(), mask=shard.nameless > 0)
        sums = [zlib.crc32(every[a:b]) for a, b in zip(low.tolist(), high.tolist(), strict=True)]
        out = {"doc_id": names, "start": pa.array(low + first), "n_tokens": pa.array(high - low), "ids_crc32": pa.array(sums, pa.int64())}
        if ids:
            out["ids"] = pa.ListArray.from_arrays(pa.array(shard.starts, pa.int32()), pa.array(every.astype(np.int32)))
        yield pa.RecordBatch.from_pydict(out)

    return _each(read(spark, path), "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else ""), rows)


def counts(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """(token, doc_id, start, n): how often each of some token ids stands in each document that has it, by rank alone."""

    def rows(shard: Shard, first: int) -> Iterator[pa.RecordBatch]:
        for token in tokens:
            n = shard.rank(token, shard.starts[:-1], shard.starts[1:])
            has = np.flatnonzero(n)
            names = pa.array(shard.doc_ids[has], pa.int64(), mask=shard.nameless[has] > 0)
            yield pa.RecordBatch.from_pydict({"token": pa.array(np.full(len(has), token)), "doc_id": names, "start": pa.array(shard.starts[has] + first), "n": pa.array(n[has])})

    return _each(read(spark, path), "token long, doc_id long, start long, n long", rows)


def occurrences(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """(token, doc_id, place, offset): every occurrence of some token ids, its place in the corpus and in its document, by select."""

    def rows(shard: Shard, first: int) -> Iterator[pa.RecordBatch]:
        for token in tokens:
            for at in shard.positions(token):
                doc = np.searchsorted(shard.starts, at, side="right") - 1
                names = pa.array(shard.doc_ids[doc], pa.int64(), mask=shard.nameless[doc] > 0)
                yield pa.RecordBatch.from_pydict({"token": pa.array(np.full(len(at), token)), "doc_id": names, "place": pa.array(at + first), "offset": pa.array(at - shard.starts[doc])})

    return _each(read(spark, path), "token long, doc_id long, place long, offset long", rows)


def tokens_at(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """(place, token) of places of the corpus, a table with one long column ``place``; places beyond it are left out.

    Places meet shards by the range they lie in: both are cut into stretches of 2 ** 20 places.
    """
    table = read(spark, path)
    last = F.col("first") + F.col("n_tokens") - 1
    cells = table.select("task", "shard", "first", last.alias("last"), F.explode(F.sequence(F.shiftright("first", 20), F.shiftright(last, 20))).alias("cell"))
    asked = places.select("place", F.shiftright("place", 20).alias("cell")).where("place >= 0").distinct()
    of_shard = asked.join(cells, "cell").where("place BETWEEN first AND last").groupBy("task", "shard").agg(F.collect_list("place").alias("places"))
    schema = pa.schema([("place", pa.int64()), ("token", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, first, some in zip(batch["payload"], batch["first"].to_pylist(), batch["places"].to_pylist(), strict=True):
                at = np.array(some)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(Shard(payload.as_py()).access(at - first))], schema=schema)

    return table.join(of_shard, ["task", "shard"]).select("payload", "first", "places").mapInArrow(run, "place long, token long")


def round_trip(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """``docs`` written to files in the shared folder, and ``documents`` of what is read back."""
    path = f"{Scratch(spark, 'tokens').top}/shards"
    write(docs, path, **options)
    return documents(spark, path)
