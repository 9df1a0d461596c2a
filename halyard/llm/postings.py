"""A positional inverted index of documents, in blocks of bounded size.

Every task cuts its documents into blocks. Inside a block all words stand on one line: a document
starts where the one before it ended plus a gap that no phrase bridges. A row of the index is a
term of a block with the sorted places of its occurrences on that line. Offset-adjusted lists of
one block can so be intersected without looking at documents, and a term that stands in every
document is cut by blocks, not a row that grows with the corpus.

Rows without a term are the documents of a block. Terms that start with a space, which no word
does, hold a block's documents as arrays, so that who reads postings by term gets them as well.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: characters that separate words; only A-Z are lower-cased -------------------
SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
# --- end of fixed values ----------------------------------------------------

#: Words of a block; one document may have more, then it is a block of its own.
BLOCK_WORDS = 1 << 22
#: Free places between two documents of a block: phrases must be shorter.
GAP = 64
#: Terms that hold a block's documents: their starts, lengths, ids and whether the id is known.
STARTS, LENGTHS, IDS, KNOWN = " starts", " lengths", " ids", " known"
DOCUMENT_TERMS = (STARTS, LENGTHS, IDS, KNOWN)
#: Size of a table of terms up to which it is sent to every executor.
BROADCAST_BYTES = 8 << 20

_TABLE = bytes(
    0x20 if c in set(SEPARATORS) else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)
)
SCHEMA = pa.schema(
    [
        ("block", pa.int64()),
        ("term", pa.string()),
        ("places", pa.binary()),
        ("n", pa.int64()),
        ("docs", pa.int64()),
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
    ]
)
FIELDS = "block bigint, term string, places binary, n bigint, docs bigint, doc_id bigint, start bigint"


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a text in UTF-8, lower-cased; a null text has none."""
    return (text or b"").translate(_TABLE).split()


class _Block:
    """Documents that were read but not yet written, as codes of their words."""

    def __init__(self) -> None:
        self.codes: defaultdict[bytes, int] = defaultdict()
        self.codes.default_factory = self.codes.__len__
        self.parts: list[np.ndarray] = []
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.words = 0

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        words = words_of(text)
        self.parts.append(np.fromiter(map(self.codes.__getitem__, words), np.int32, len(words)))
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        self.words += len(words)

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        lengths = np.array(self.lengths, np.int64)
        starts = np.zeros(len(lengths), np.int64)
        starts[1:] = (lengths + GAP).cumsum()[:-1]
        known = np.array([i is not None for i in self.ids], np.uint8)
        ids = np.array([i if i is not None else 0 for i in self.ids], np.int64)
        codes = np.concatenate([np.zeros(0, np.int32), *self.parts])
        owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        first = np.repeat(starts - (lengths.cumsum() - lengths), lengths)
        places = (np.arange(len(codes)) + first).astype("<i4")
        order = np.argsort(codes, kind="stable")
        owners, counts = owner[order], np.bincount(codes, minlength=len(self.codes))
        ends = counts.cumsum()
        new = np.ones(len(order), np.int64)
        new[1:] = owners[1:] != owners[:-1]
        new[(ends - counts)[counts > 0]] = 1
        docs = np.diff(np.concatenate([[0], new.cumsum()])[np.concatenate([[0], ends])])
        offsets = np.concatenate([[0], ends]).astype("<i4") * 4
        lists = pa.Array.from_buffers(
            pa.binary(), len(counts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(places[order].tobytes())]
        )
        terms = pa.array(self.codes.keys(), pa.binary()).cast(pa.string())
        n = len(counts)
        nulls = pa.nulls(n, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, block)), terms, lists, pa.array(counts.astype(np.int64)), pa.array(docs.astype(np.int64)), nulls, nulls],
            schema=SCHEMA,
        )
        held = [starts.astype("<i4"), lengths.astype("<i4"), ids.astype("<i8"), known]
        for term, values in zip(DOCUMENT_TERMS, held):
            row = {"block": block, "term": term, "places": values.tobytes(), "n": 0, "docs": 0}
            yield pa.RecordBatch.from_pylist([row], schema=SCHEMA)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(ids), block)),
                pa.nulls(len(ids), pa.string()),
                pa.nulls(len(ids), pa.binary()),
                pa.array(lengths),
                pa.nulls(len(ids), pa.int64()),
                pa.array(ids, mask=known == 0),
                pa.array(starts),
            ],
            schema=SCHEMA,
        )


def build_index(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The index of ``docs`` (doc_id, text); write it before use, blocks are numbered by task.

    Per block and term ``places``, the number ``n`` of occurrences and ``docs`` of documents; per
    document, in rows without a term, ``doc_id``, ``start`` and the number ``n`` of its words.
    A null text has no words. Repeated rows are documents of their own. No rows give no index.
    """

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number = _Block(), TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for doc_id, text in zip(batch.column("doc_id"), texts):
                block.add(doc_id.as_py(), text.as_py())
                if block.words >= block_words or len(block.ids) >= block_words >> 4:
                    yield from block.rows(number)
                    block, number = _Block(), number + 1
        if block.ids:
            yield from block.rows(number)

    ids = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(ids, F.col("text").cast("string").alias("text")).mapInArrow(indexed, FIELDS)


def split_words(rows: DataFrame, key: str) -> DataFrame:
    """``key`` as a string (null: empty) and ``words``, those of ``text``, per row."""
    schema = pa.schema([("key", pa.string()), ("words", pa.list_(pa.string()))])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            words = pa.array([words_of(t.as_py()) for t in texts], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), words.cast(pa.list_(pa.string()))], schema=schema
            )

    name = F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key")
    frame = rows.select(name, F.col("text").cast("string").alias("text"))
    return frame.mapInArrow(split, "key string, words array<string>")


def postings_of(index: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings of the terms in ``terms``, once per row that names one, with its other columns.

    The terms are sent to all executors only while they are few bytes; else both sides are dealt
    by term, where a term has no more rows than there are blocks."""
    size = terms.agg(F.sum(F.octet_length("term") + 32)).first()[0] or 0
    side = F.broadcast(terms) if size <= BROADCAST_BYTES else terms
    return index.where(F.col("term").isNotNull()).join(side, "term")


def places_of(term_column: pa.ChunkedArray, places_column: pa.ChunkedArray) -> dict[str, np.ndarray]:
    """Sorted places by term; those of document terms in their own types."""
    types = {IDS: "<i8", KNOWN: np.uint8}
    return {
        term: np.frombuffer(places, types.get(term, "<i4"))
        for term, places in zip(term_column.to_pylist(), places_column.to_pylist())
    }
