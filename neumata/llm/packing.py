"""Best-fit packing of token sequences by the sum-of-squares rule.

A document is tokenised, ended by an id and, only if it is longer than a sequence,
cut into full pieces of which the first may be shorter. Full pieces are sequences of
their own. The others are dealt into blocks of bounded size; in a block, pieces go by
falling length to the open bin (a new one only if none has room) after which the sum
of squares of the counts of open bins per residual gap is smallest.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from neumata.llm.shared import Scratch

CAPACITY = 2048
END = 0
#: Pieces in a block. A block leaves one or two bins badly filled, of some thousands.
BLOCK = 8192


@cache
def encoder(name: str) -> Callable[[str], np.ndarray]:
    """ids of a text by the tokenizer file ``name``.json; the text of its end mark is read as the mark, as that file says.

    The same vocabulary as ranks (``name``.tiktoken) encodes five times faster and gives
    the same ids. It gives up on very long runs of blanks; such a text is encoded by the
    tokenizer file itself.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})
    whole: list[Tokenizer] = []

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all").astype(np.int32)
        except ValueError:  # its regular expression ran out of stack
            whole.extend([] if whole else [Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))])
            return np.array(whole[0].encode(text, add_special_tokens=False).ids, np.int32)

    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids; all but the first are full."""
    head = n % capacity
    full = range(head, n, capacity)
    return [(0, head)] * (head > 0) + [(s, capacity) for s in full]


def tokenised(
    docs: DataFrame,
    columns: tuple[str, ...] = ("ids",),
    capacity: int = CAPACITY,
    end: int = END,
    vocabulary: str = "byte_bpe_50k",
) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, and of ``columns`` ids and ids_crc32.

    A null text is an empty one, whose only id is ``end``. ids_crc32 is the unsigned
    checksum of the ids as little-endian 32-bit numbers. Repeated rows give repeated
    pieces; an empty table gives none. Whole texts are read, of any length and of any
    signs; a batch of ids is handed on at about a million. Other columns are ignored.
    """
    kinds = {"ids": ("array<int>", pa.list_(pa.int32())), "ids_crc32": ("long", pa.int64())}
    fixed = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64()}
    schema = pa.schema([*fixed.items(), *((c, kinds[c][1]) for c in columns)])

    def digest(ids: np.ndarray, column: str):
        return ids if column == "ids" else zlib.crc32(ids.astype("<u4").tobytes())

    def table(rows: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = np.append(encode(text.as_py() or ""), np.int32(end))
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append((doc_id, k, start, length, *(digest(ids[start : start + length], c) for c in columns)))
                held += len(ids)
                if held > 1 << 20:
                    yield table(rows)
                    rows, held = [], 0
            if rows:
                yield table(rows)

    types = "doc_id long, piece int, start long, length long" + "".join(f", {c} {kinds[c][0]}" for c in columns)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, types)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, pieces taken by falling length.

    With n[g] open bins of residual gap g, putting a piece of length s into a bin of
    gap g > s changes the sum of squares by 2 (n[g - s] - n[g]) + 2, and filling a bin
    of gap s by 1 - 2 n[s]; gap 0 does not count. Ties go to the smallest gap. A new
    bin is opened only where no open one has room: with pieces sorted, that gives
    fewer bins than weighing it as one more choice.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made, none = 0, 1 << 60
    for at in np.argsort(-lengths, kind="stable"):
        s = int(lengths[at])
        before, after = count[s:capacity], count[: capacity - s]
        change = np.where(before > 0, 2 * (after - before) + 2, none)
        if count[s] > 0:
            change[0] = 1 - 2 * count[s]
        gap = int(change.argmin()) + s if s < capacity else capacity
        if gap == capacity or change[gap - s] == none:
            where, gap = made, capacity
            made += 1
        else:
            where = open_bins[gap].pop()
            count[gap] -= 1
        bins[at], offsets[at] = where, capacity - gap
        if gap > s:
            open_bins[gap - s].append(where)
            count[gap - s] += 1
    return bins, offsets


def packed(pieces: DataFrame, n_documents: int, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """``pieces`` (doc_id, piece, length and any others) with sequence_id and offset.

    The pieces are written to the shared folder first, so that texts are tokenised once.
    n_documents bounds the number of pieces that are not full, and so sets the number
    of blocks. A row's block depends on its key and its input partition: equal rows
    from all over the table, however many, do not meet in one block. sequence_id is
    any distinct number; offsets in a sequence leave no gaps. Among pieces of one length
    order is free. An empty table gives an empty result; columns named like the result's
    own (block, sequence_id, offset) are refused.
    """
    if clash := {"block", "sequence_id", "offset"} & set(pieces.columns):
        raise ValueError(f"columns {sorted(clash)} are taken")
    spark = pieces.sparkSession
    blocks = max(1, -(-n_documents // block))
    names = pieces.columns
    pieces = Scratch(spark, "packing").keep(pieces, "pieces")
    full = pieces.where(F.col("length") >= capacity).select(
        *names, (F.lit(1 << 62) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    part = pieces.where(F.col("length") < capacity).withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "piece", F.spark_partition_id()), F.lit(blocks)).cast("long")
    )

    def run(group: pa.Table) -> pa.Table:
        # ids stay Arrow columns: only the lengths become an array, so a block is held about once
        order = pc.sort_indices(group.select(["length", "doc_id", "piece"]), [(c, "descending") for c in ("length", "doc_id", "piece")]).to_numpy()
        bins, offsets = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        bins[order], offsets[order] = sum_of_squares(group["length"].to_numpy()[order], capacity)
        first = group["block"][0].as_py() << 32
        return group.select(names).append_column("sequence_id", pa.array(bins + first)).append_column("offset", pa.array(offsets))

    done = part.groupBy("block").applyInArrow(run, full.schema)
    return full.unionByName(done)
