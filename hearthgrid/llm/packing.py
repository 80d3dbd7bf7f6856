"""Best-fit packing of documents into sequences of at most CAPACITY tokens, bulk-synchronously.

Documents are tokenized (end mark added) and cut into pieces from the back, so that only the first piece may be short.
Pieces are range-sorted by length; their rank in their length is a distributed running count. Gaps are kept as runs: so
many sequences in a row with the same room. Each superstep sweeps lengths and rooms in ascending order; a gap takes the
longest piece that fits and is not taken, its successor match. Pieces of one length that want the same run are told
apart by rank, gaps shrink by what they took, and the next superstep begins. Where no piece fits any gap, the longest
pieces open new sequences. Runs are as many as lengths and supersteps allow (at most CAPACITY lengths), whatever the
number of documents, so the sweep itself needs the counts by length alone; pieces meet their sequences in a join on
length and rank.

Defined results: a null text is an empty one, an empty text is the end mark alone; repeated rows are packed each; an
empty table gives no rows; other columns are left alone.
"""

import zlib
from collections import defaultdict, deque
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CAPACITY, END = 1024, 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: This string in a text is one id of the vocabulary.
MARK = "<|endoftext|>"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@cache
def encoder(path: str):
    """The byte-level BPE of `path` in the faster of the two libraries that read it; the tests compare their ids."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={MARK: len(ranks)})


def ids_of(text: str, path: str) -> list[int]:
    encoding = encoder(path)
    return encoding.encode(text, allowed_special={MARK}) if MARK in text else encoding.encode_ordinary(text)


def tokenize(docs: DataFrame, capacity: int = CAPACITY, end: int = END, path: str | None = None) -> DataFrame:
    """Pieces of documents (PIECES)."""
    path = path or vocabulary()

    def cut(batches):
        for batch in batches:
            out = [[] for _ in range(5)]
            for doc_id, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                ids = np.array([*ids_of(text.as_py() or "", path), end], dtype="<u4")
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    for column, value in zip(out, (doc_id, piece, a, b - a, zlib.crc32(ids[a:b])), strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    return common.map_arrow(docs.select("doc_id", "text"), cut, PIECES)


def supersteps(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Segments (length, first rank, end rank, first sequence, offset): the pieces of a length with these ranks go, in
    order, to the sequences from the first on, at this offset."""
    left = dict(counts)  # by length, pieces without a sequence
    taken = defaultdict(int)  # by length, pieces that have one: the next rank
    gaps: dict[int, deque] = defaultdict(deque)  # by room, runs (first sequence, sequences)
    segments, sequences = [], 0

    def give(length: int, first: int, n: int, room: int) -> None:
        segments.append((length, taken[length], taken[length] + n, first, capacity - room))
        taken[length] += n
        left[length] -= n

    def sweep() -> bool:
        moved, stack, lengths = [], [], deque(sorted(k for k, n in left.items() if n))
        for room in sorted(gaps):
            while lengths and lengths[0] <= room:
                stack.append(lengths.popleft())
            runs = gaps[room]
            while runs and stack:
                length, (first, n) = stack[-1], runs[0]
                m = min(n, left[length])
                give(length, first, m, room)
                moved.append((room - length, first, m))
                runs.popleft()
                if m < n:
                    runs.appendleft((first + m, n - m))
                if not left[length]:
                    stack.pop()
        for room, first, n in moved:
            if room:
                gaps[room].append((first, n))
        for room in [r for r, runs in gaps.items() if not runs]:
            del gaps[room]
        return bool(moved)

    while any(left.values()):
        if sweep():
            continue
        # as many new sequences as the rest needs at least, and one for each piece that fills more than half
        need = max(-(-sum(k * n for k, n in left.items()) // capacity), sum(n for k, n in left.items() if 2 * k > capacity))
        for length in sorted((k for k, n in left.items() if n), reverse=True):
            if m := min(need, left[length]):
                give(length, sequences, m, capacity)
                if length < capacity:
                    gaps[capacity - length].append((sequences, m))
                sequences, need = sequences + m, need - m
    return segments


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (PIECES, read more than once) with sequence_id and offset."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    segments = pieces.sparkSession.createDataFrame(
        supersteps(counts, capacity), "length long, low long, high long, first long, offset long"
    )
    key = F.concat_ws("-", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "piece")
    ordered = pieces.withColumns({"_order": common.order_key(key), "_one": F.lit(1)})
    ranked = common.running(ordered, "length", "_order", ["doc_id", "piece", "ids_crc32"], "_one", sum(counts.values()), "_rank")
    # at most a few segments for each length and superstep, whatever the number of pieces
    inside = (F.col("_rank") >= F.col("low")) & (F.col("_rank") < F.col("high"))
    placed = ranked.join(F.broadcast(segments.withColumnRenamed("length", "_length")), (F.col("length") == F.col("_length")) & inside)
    return placed.withColumn("sequence_id", F.col("first") + F.col("_rank") - F.col("low")).drop(
        "_order", "_one", "_rank", "_length", "low", "high", "first"
    )


def digest(docs: DataFrame) -> DataFrame:
    pieces = common.keep(tokenize(docs), "pieces")
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
