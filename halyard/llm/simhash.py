"""SimHash fingerprints and near-duplicates by anchor-point covering.

Two 64-bit fingerprints that differ in at most three bits differ in at most one bit of their
upper or of their lower 32 bits. So each half has anchors of its own: the words of a covering
code of length 32, the perfect Hamming code of length 31 beside one free bit. Its covering
radius is 1, so every half has a home anchor at distance 0 or 1 in closed form, and a half that
differs from it in one more bit is within radius plus threshold, 2, of that same anchor. Each
fingerprint is replicated to the anchors within 2 of its halves (2 or 17 of 2**27 per half) and
compared there with the fingerprints at home. A code over all 64 bits would need radius plus
3, which is thousands of anchors per fingerprint.

Only distinct fingerprints take part, so a group of copies costs what its distinct fingerprints
cost. Of those an anchor gives every pair within the distance once: at most 43,744 links per
fingerprint, the number of words of 64 bits within three bits of one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halyard.llm.components import smallest_reachable
from halyard.llm.tables import stored

# --- fixed values: the fingerprint ------------------------------------------------
SHINGLE_WORDS = 3
HASH_SEED = 42
BITS = 64
DISTANCE = 3
# --- end of fixed values ----------------------------------------------------

HALF, CODE = 32, 31
#: Shingles whose bits are counted at once; bounds memory for long texts.
COUNTED = 1 << 16


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, joined by one space (of all words, if fewer)."""
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    n = len(words)
    if n <= size:
        return np.array([xxhash.xxh64_intdigest(joined, HASH_SEED)], np.uint64)
    ends = np.fromiter(map(len, words), np.int64, n).cumsum() + np.arange(n)
    starts = np.zeros(n, np.int64)
    starts[1:] = ends[:-1] + 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: n - size + 1].tolist(), ends[size - 1 :].tolist())
    return np.fromiter((digest(joined[a:b], HASH_SEED) for a, b in spans), np.uint64, n - size + 1)


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; 0 without words."""
    hashes = shingle_hashes((text or "").encode().lower().split(), size)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), COUNTED):
        part = hashes[start : start + COUNTED].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``fp``, the fingerprint as a signed long, and ``h``, the text's hash, per row."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("h", pa.int64())])

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), size) for t in batch.column("text")]
            signed = np.array(values, np.uint64).view(np.int64)
            arrays = [batch.column("doc_id").cast(pa.int64()), pa.array(signed), batch.column("h")]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    rows = docs.select("doc_id", "text", _text_hash().alias("h"))
    return rows.mapInArrow(marked, "doc_id bigint, fp bigint, h bigint")


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _syndrome(code: Column) -> Column:
    """Exclusive or of the places (1 to 31) of the set bits: the place to flip to get to the
    nearest word of the Hamming code, 0 inside the code. Bit j of it is the parity of the bits
    whose place has bit j."""
    total = F.lit(0)
    for j in range(5):
        mask = sum(1 << (place - 1) for place in range(1, CODE + 1) if place >> j & 1)
        parity = F.bit_count(code.bitwiseAND(F.lit(mask))).bitwiseAND(F.lit(1))
        total = total + parity * (1 << j)
    return total.cast("int")


def _flip(code: Column, place: Column) -> Column:
    """The word with the bit at ``place`` flipped; place 0 flips nothing."""
    bit = F.when(place == 0, F.lit(0).cast("long")).otherwise(
        F.call_function("shiftleft", F.lit(1).cast("long"), place - 1)
    )
    return code.bitwiseXOR(bit)


def _halves(fps: DataFrame, key: str, words: list[Column]) -> DataFrame:
    """Two rows per 64-bit word: ``key``, ``side``, ``code`` (31 bits), ``free`` (one bit) and
    the syndrome ``s``."""
    halves = []
    for word in words:
        low = word.bitwiseAND(F.lit((1 << HALF) - 1))
        halves += [low, F.shiftrightunsigned(word, HALF)]
    sides = F.array(
        *[
            F.struct(
                F.lit(side).cast("long").alias("side"),
                half.bitwiseAND(F.lit((1 << CODE) - 1)).alias("code"),
                F.shiftright(half, CODE).alias("free"),
            )
            for side, half in enumerate(halves)
        ]
    )
    return fps.select(key, F.inline(sides)).withColumn("s", _syndrome(F.col("code")))


def _anchor(code: Column, free: Column) -> Column:
    return F.shiftleft("side", HALF) + F.shiftleft(free, CODE) + code


def home_anchors(fps: DataFrame, key: str, words: list[Column]) -> DataFrame:
    """``key`` and ``anchor``: the nearest code word of each half, within the covering radius."""
    return _halves(fps, key, words).select(
        key, _anchor(_flip(F.col("code"), F.col("s")), F.col("free")).alias("anchor")
    )


def near_anchors(fps: DataFrame, key: str, words: list[Column]) -> DataFrame:
    """``key`` and ``anchor``: every code word within radius plus one of a half.

    With the free bit as it is: the nearest word and, outside the code, the words across two
    places whose exclusive or is the syndrome. With the free bit flipped: the nearest word.
    """
    home = _anchor(_flip(F.col("code"), F.col("s")), F.col("free"))
    across = _anchor(
        _flip(F.col("code"), F.col("s")), F.lit(1).cast("long") - F.col("free")
    )
    places = F.filter(
        F.sequence(F.lit(1), F.lit(CODE)),
        lambda i: (F.col("s") != 0) & (i < i.bitwiseXOR(F.col("s"))),
    )
    beside = F.transform(
        places,
        lambda i: _anchor(_flip(_flip(F.col("code"), i), i.bitwiseXOR(F.col("s"))), F.col("free")),
    )
    anchors = F.concat(F.array(home, across), beside)
    return _halves(fps, key, words).select(key, F.explode(anchors).alias("anchor"))


def links_between(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs ``a`` > ``b`` of distinct fingerprints that differ in at most ``distance`` bits
    (3 at most: the halves are covered for one bit each).

    A pair is met at the home anchor of either fingerprint; keeping the meetings at the smaller
    one's home halves the work. A fingerprint has at most 43,744 others within three bits, so
    links per fingerprint are bounded whatever the size of a group.
    """
    if not 0 <= distance <= 3:
        raise ValueError("two halves cover distances up to 3")
    homes = home_anchors(fps, "fp", [F.col("fp")]).withColumnRenamed("fp", "b")
    near = near_anchors(fps, "fp", [F.col("fp")]).withColumnRenamed("fp", "a")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    met = near.join(homes, "anchor").where((F.col("a") > F.col("b")) & (apart <= distance))
    return met.select("a", "b").distinct()


def component_table(marked: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``fp``, ``component`` (a fingerprint that stands for it) and ``component_id``, the smallest
    doc_id reachable, per distinct fingerprint."""
    firsts = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-firsts")
    roots = stored(
        smallest_reachable(links_between(firsts.select("fp"), distance)), "simhash-roots"
    )
    linked = roots.join(firsts, roots["node"] == firsts["fp"]).select("fp", "root", "first")
    smallest = stored(
        linked.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-smallest"
    )
    placed = roots.join(smallest, "root").select(F.col("node").alias("fp"), "root", "component_id")
    found = firsts.join(placed, "fp", "left")
    return stored(
        found.select(
            "fp",
            F.coalesce("root", "fp").alias("component"),
            F.coalesce("component_id", "first").alias("component_id"),
        ),
        "simhash-components",
    )


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = DISTANCE
) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``.

    Texts without words, null texts among them, have fingerprint zero and are linked like any
    other. Repeated rows each have their row. A null doc_id stays null and never names a
    component, unless a component has no other id: then component_id is null. An empty table
    gives no rows; other columns are not read. A text is hashed whole, in bounded pieces.
    """
    marked = stored(with_fingerprints(docs, size), "simhash-marks")
    table = component_table(marked, distance)
    return marked.join(table, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def without_near_copies(
    docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = DISTANCE
) -> DataFrame:
    """The documents without near copies: of each component the row with the smallest doc_id stays,
    with its own columns, whatever their names.

    Components are those of ``near_duplicates``, so null texts and texts without words are one.
    A null doc_id is larger than any other. Of rows that share the smallest doc_id that with the
    smallest hash of its text stays, of equal rows one. An empty table gives no rows.
    """
    marked = stored(with_fingerprints(docs, size), "simhash-marks")
    table = component_table(marked, distance).select("fp", "component")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    best = marked.join(table, "fp").groupBy("component").agg(F.min(place).alias("best"))
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))
    key = [F.col("doc_id").isNull().alias("none"), number.alias("number")]
    keepers = stored(best.select("best.doc_id", "best.h").select(*key, "h"), "simhash-keepers")
    packed = docs.select(*key, _text_hash().alias("h"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    first = F.row_number().over(Window.partitionBy("none", "number", "h").orderBy("number"))
    kept = packed.join(keepers, ["none", "number", "h"]).withColumn("place", first).where("place = 1")
    return kept.select(*[F.col(f"doc.`{c}`") for c in docs.columns])
