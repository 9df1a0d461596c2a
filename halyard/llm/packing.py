"""Packing along a space-filling curve.

A document is tokenised once. Its token counts, hashed into ``BUCKETS`` cells, are projected to
a few dimensions, and its place is the Hilbert key of that point, so documents that lie near
each other on the curve have similar vocabularies. Documents are sorted by key over the whole
table, their tokens are laid end to end along the curve, and every ``length`` tokens a new
sequence begins: only the last sequence is padded.

The sort works on ranges of keys, cut where the stored keys say. The tokens of the ranges before
a range are known from one aggregation, so every range is laid out by itself. Equal points (a
group of copies) have equal Hilbert keys; a hash of the row is appended to the key, so such a
group is cut into ranges like any other.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from halyard.llm.tables import partitions_for, stored

# --- fixed values: the sequence format ------------------------------------------------
LENGTH = 1024
END_ID = 0
SPECIAL = {"<|endoftext|>": 50256}
# --- end of fixed values ----------------------------------------------------

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BUCKETS, DIMENSIONS, DEPTH = 1024, 3, 13
#: Key and tie bits together are 53, so a key is exact as a double.
TIE_BITS = 14
#: Ranges per shuffle partition, so that hashing ranges to partitions evens out.
RANGES_PER_PARTITION = 4


@cache
def _encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL
    )


def encode(text: str, path: str = RANKS) -> bytes:
    """Byte-level BPE ids, equal to the JSON form of the same vocabulary, as little-endian
    unsigned 16-bit integers."""
    return _encoding(path).encode_to_numpy(text, allowed_special="all").astype("<u2").tobytes()


def projection(seed: int = 7) -> np.ndarray:
    """One column of +1 and -1 per dimension, fixed by the seed."""
    return np.random.default_rng(seed).choice([-1.0, 1.0], (BUCKETS, DIMENSIONS))


def point(ids: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The cell, per dimension, of a document's hashed token counts (square roots, so that a few
    frequent tokens do not decide; unit length, so that long and short texts compare)."""
    hashed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(54)
    counts = np.sqrt(np.bincount(hashed.astype(np.int64), minlength=BUCKETS))
    norm = np.linalg.norm(counts)
    projected = counts @ matrix / (norm if norm else 1.0)
    spread = 1 / (1 + np.exp(-1.7 * projected))  # about uniform for unit vectors
    return np.minimum((spread * (1 << DEPTH)).astype(np.int64), (1 << DEPTH) - 1)


def hilbert_keys(points: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Position along the Hilbert curve of integer points (rows), ``depth`` bits a dimension.

    The curve's recursion is undone from the largest cell down: in each cell the axes after the
    first are reflected or exchanged with it, then the result is Gray-coded and interleaved.
    """
    axes = points.T.astype(np.int64).copy()
    n = len(axes)
    for level in range(depth - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(n):
            inside = (axes[i] & bit) != 0
            exchanged = np.where(inside, 0, (axes[0] ^ axes[i]) & below)
            axes[0] ^= np.where(inside, below, exchanged)
            if i:
                axes[i] ^= exchanged
    for i in range(1, n):
        axes[i] ^= axes[i - 1]
    turned = np.zeros_like(axes[0])
    for level in range(depth - 1, 0, -1):
        turned ^= np.where((axes[n - 1] & (1 << level)) != 0, (1 << level) - 1, 0)
    axes ^= turned
    keys = np.zeros_like(axes[0])
    for level in range(depth - 1, -1, -1):
        for axis in axes:
            keys = (keys << 1) | ((axis >> level) & 1)
    return keys


def tokenised(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """``row``, ``doc_id``, ``n`` (tokens with the end id), ``key`` and ``ids`` per row, stored."""
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("hilbert", pa.int64()), ("ids", pa.binary())]
    )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, end = projection(), np.array([END_ID], "<u2").tobytes()
        for batch in batches:
            ids = [encode(t.as_py() or "", path) + end for t in batch.column("text")]
            arrays = [np.frombuffer(x, "<u2") for x in ids]
            points = np.array([point(a, matrix) for a in arrays]).reshape(-1, DIMENSIONS)
            columns = [
                batch.column("row"),
                batch.column("doc_id").cast(pa.int64()),
                pa.array([len(a) for a in arrays], pa.int64()),
                pa.array(hilbert_keys(points), pa.int64()),
                pa.array(ids, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    read = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    found = read.mapInArrow(
        encoded, "row bigint, doc_id bigint, n bigint, hilbert bigint, ids binary"
    )
    tie = F.xxhash64("doc_id", "row").bitwiseAND(F.lit((1 << TIE_BITS) - 1))
    key = F.shiftleft("hilbert", TIE_BITS).bitwiseOR(tie)
    return stored(found.select("row", "doc_id", "n", key.alias("key"), "ids"), "packing-tokens")


def _with_ranges(tokens: DataFrame, ranges: int) -> DataFrame:
    """Add ``range``: about equal numbers of tokens' documents per range, in the order of keys.

    The cuts are approximate quantiles; any cuts give the same kind of layout.
    """
    if ranges < 2:
        return tokens.withColumn("range", F.lit(0))
    quantiles = [i / ranges for i in range(1, ranges)]
    found = tokens.agg(F.percentile_approx("key", quantiles, 20 * ranges)).first()[0] or [0]
    splits = [-math.inf, *sorted({float(c) for c in found}), math.inf]
    doubled = tokens.withColumn("place", F.col("key").cast("double"))
    placed = Bucketizer(splits=splits, inputCol="place", outputCol="range").transform(doubled)
    return placed.withColumn("range", F.col("range").cast("int")).drop("place")


def _range_starts(ranged: DataFrame) -> DataFrame:
    """``range`` and ``before``, the tokens of earlier ranges: one row per range."""
    totals = ranged.groupBy("range").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def _pieces(length: int):
    """Cut documents that lie end to end at multiples of ``length``."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            rows = zip(frame.doc_id, frame.position, frame.ids)
            for doc_id, position, raw in rows:
                n, start = len(raw) // 2, 0
                while start < n:
                    at = position + start
                    take = min(n - start, length - at % length)
                    ids = np.frombuffer(raw, "<u2", take, 2 * start).astype("<u4")
                    crc = zlib.crc32(ids.tobytes())
                    out.append((doc_id, start, take, crc, n, at // length, at % length))
                    start += take
            yield pd.DataFrame(out, columns=PIECE_COLUMNS)

    return cut


PIECE_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(
    docs: DataFrame, length: int = LENGTH, *, path: str = RANKS, ranges: int | None = None
) -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens, a row per piece.

    ``doc_id``, ``start`` (tokens of the document before the piece), ``length``, ``ids_crc32``
    (of its ids as little-endian unsigned 32-bit integers), ``doc_tokens`` (with the end id),
    ``sequence_id`` and ``offset`` (place in the sequence, without gaps from 0).

    A null or empty text is the end id alone. A long text is cut into as many sequences as it
    needs. Repeated rows are packed as often as they occur, a null doc_id stays null, an empty
    table gives no rows, and other columns are not read.
    """
    tokens = tokenised(docs, path)
    ranged = _with_ranges(tokens, ranges or RANGES_PER_PARTITION * partitions_for(docs.sparkSession))
    starts = _range_starts(ranged)
    within = Window.partitionBy("range").orderBy("key", "doc_id", "row")
    before = F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, -1))
    placed = (
        ranged.join(F.broadcast(starts), "range")
        .withColumn("position", F.col("before") + F.coalesce(before, F.lit(0)))
        .select("doc_id", "position", "ids")
    )
    fields = ", ".join(f"{c} bigint" for c in PIECE_COLUMNS)
    return placed.mapInPandas(_pieces(length), fields)
