"""Benchmark passages in documents, found in a distributed positional inverted index.

All words of the documents are indexed (``postings``). The texts of a benchmark are dealt into
slices, and the postings of a slice's words meet the slice block by block. There every window of
consecutive words is looked up by intersecting offset-adjusted lists: those of its rarest word in
the block give the places where the window can start, and the next rarest thin them out until
none is left or all words agree. What is left are exact occurrences; runs of them on one
diagonal are passages. Around the rarest word it is also looked up whether all words of the
window stand close together in any order, a proximity match.

A block and a slice are bounded, so a passage in a third of all documents is one that many blocks
find, each in its own documents. Equal texts of a benchmark are looked up once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from halyard.llm.postings import (
    DOCUMENT_TERMS,
    GAP,
    LENGTHS,
    STARTS,
    build_index,
    places_of,
    postings_of,
    split_words,
)
from halyard.llm.tables import stored

# --- fixed values: the query's settings ------------------------------------------------
WINDOW = 10
# --- end of fixed values ----------------------------------------------------

#: Words that may stand between those of a window in a proximity match.
SLACK = 4
#: Benchmark words of a slice, on average.
SLICE_WORDS = 1 << 17

SPANS = pa.schema(
    [
        ("block", pa.int64()),
        ("start", pa.int64()),
        ("text_id", pa.string()),
        ("item_word", pa.int64()),
        ("doc_word", pa.int64()),
        ("length", pa.int64()),
        ("exact", pa.bool_()),
    ]
)
SPAN_FIELDS = "block bigint, start bigint, text_id string, item_word bigint, doc_word bigint, length bigint, exact boolean"


def _member(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.searchsorted(values, wanted)
    return values[np.minimum(at, len(values) - 1)] == wanted


def phrase_starts(lists: list[np.ndarray]) -> np.ndarray:
    """Places at which the words whose sorted places are ``lists`` follow one another."""
    order = sorted(range(len(lists)), key=lambda j: len(lists[j]))
    starts = lists[order[0]].astype(np.int64) - order[0]
    for j in order[1:]:
        if not len(starts):
            break
        starts = starts[_member(lists[j], starts + j)]
    return starts


def _distances(
    centre: np.ndarray, other: np.ndarray, reach: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of ``centre`` have an occurrence of ``other`` nearer than ``reach``, and the distances
    of those to the nearest one before (or there) and after."""
    far = 2 * reach + 1
    at = np.searchsorted(other, centre, "right")
    left = np.where(at > 0, centre - other[np.maximum(at - 1, 0)], far)
    right = np.where(at < len(other), other[np.minimum(at, len(other) - 1)] - centre, far)
    near = np.nonzero(np.minimum(left, right) < reach)[0]
    return near, left[near], right[near]


def close_together(
    lists: dict[str, np.ndarray],
    reach: int,
    known: dict[tuple[str, str, int], tuple],
    phrases: np.ndarray = np.zeros(0, np.int64),
    size: int = 0,
) -> tuple[np.ndarray, np.ndarray]:
    """Where all words stand within ``reach`` places, in any order: per occurrence of the rarest
    word that has such a stretch around it, first place and length of the shortest (the leftmost
    of those). Occurrences inside ``phrases`` (starts of ``size`` places) are left out. ``known``
    keeps the first step, which windows that overlap have in common."""
    words = sorted(lists, key=lambda w: len(lists[w]))
    centre = lists[words[0]].astype(np.int64)
    if len(words) > 1:
        step = (words[0], words[1], reach)
        if step not in known:
            near, left, right = _distances(centre, lists[words[1]], reach)
            known[step] = centre[near], left, right
        centre, *sides = known[step]
    else:
        sides = [np.zeros_like(centre)] * 2
    if len(phrases):
        at = np.searchsorted(phrases, centre, "right") - 1
        free = (at < 0) | (centre - phrases[np.maximum(at, 0)] >= size)
        centre, sides = centre[free], [x[free] for x in sides]
    before, after = [sides[0]], [sides[1]]
    for word in words[2:]:
        if not len(centre):
            break
        near, left, right = _distances(centre, lists[word], reach)
        centre = centre[near]
        before, after = [x[near] for x in before] + [left], [x[near] for x in after] + [right]
    if not len(centre):
        return centre, centre
    here = np.zeros_like(centre)
    left, right = np.stack([here, *before]), np.stack([here, *after])
    best_from, best = here, here + 2 * reach + 1
    for reached in left:  # words up to there on the left, the others on the right
        length = reached + np.where(left <= reached, 0, right).max(axis=0) + 1
        better = (length < best) | ((length == best) & (reached > best_from))
        best, best_from = np.where(better, length, best), np.where(better, reached, best_from)
    fits = best <= reach
    return (centre - best_from)[fits], best[fits]


def _runs(found: list[tuple[int, np.ndarray]], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (first word in the item, starts) joined along diagonals: item word, place, length."""
    item = np.concatenate([np.full(len(s), i, np.int64) for i, s in found])
    place = np.concatenate([s for _, s in found])
    order = np.lexsort((item, place - item))
    item, place = item[order], place[order]
    new = np.ones(len(item), bool)
    new[1:] = (np.diff(place - item) != 0) | (np.diff(item) != 1)
    firsts = np.nonzero(new)[0]
    lasts = np.append(firsts[1:], len(item)) - 1
    return item[firsts], place[firsts], item[lasts] - item[firsts] + size


def find_text(
    words: list[str], places: dict[str, np.ndarray], window: int, slack: int | None
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """Passages of a text in a block, as arrays (word of the text, place, length), and whether
    they are exact. ``slack`` None looks for no proximity matches."""
    lists = [places.get(w) for w in words]
    size = min(window, len(words))
    exact, near, missing, known = [], [], -1, {}
    for last, own in enumerate(lists):
        if own is None:
            missing = last
        first = last - size + 1
        if first < 0 or first <= missing:
            continue
        part = lists[first : last + 1]
        starts = phrase_starts(part)
        if len(starts):
            exact.append((first, starts))
        if slack is None:
            continue
        distinct = dict(zip(words[first : last + 1], part))
        place, length = close_together(distinct, size + slack, known, starts, size)
        if len(place):
            near.append((np.full(len(place), first, np.int64), place, length))
    result = [(*_runs(exact, size), True)] if exact else []
    if near:
        result.append((*(np.concatenate(x) for x in zip(*near)), False))
    return result


def _slices(texts: DataFrame, slice_words: int) -> DataFrame:
    total = texts.agg(F.sum(F.size("words").cast("long"))).first()[0] or 0
    return texts.withColumn("slice", F.pmod(F.xxhash64("text_id"), F.lit(total // slice_words + 1)))


def find_passages(
    index: DataFrame, texts: DataFrame, window: int, slack: int | None, slice_words: int
) -> DataFrame:
    """Passages of ``texts`` (text_id, words) in the documents of ``index``, as in ``SPANS``:
    the document by block and start, words counted from 0 in the text and in the document."""
    sliced = stored(_slices(texts, slice_words), "leaks-slices")
    words = sliced.select("slice", F.explode("words").alias("term"))
    documents = F.explode(F.array(*[F.lit(t) for t in DOCUMENT_TERMS[:2]]))
    own = sliced.select("slice", documents.alias("term"))
    terms = stored(words.union(own).distinct(), "leaks-terms")
    postings = postings_of(index.select("block", "term", "places"), terms)
    packed = sliced.groupBy("slice").agg(F.collect_list(F.struct("text_id", "words")).alias("texts"))
    met = postings_of(index.where(F.col("term") == STARTS).select("block", "term"), terms)
    asked = met.select("block", "slice").join(packed, "slice").select("block", "slice", "texts")
    asked = asked.toDF("at_block", "at_slice", "texts")

    def search(key: tuple, held: pa.Table, asked: pa.Table) -> pa.Table:
        places = places_of(held.column("term"), held.column("places"))
        starts, lengths = places[STARTS], places[LENGTHS]
        rows = []
        for texts in asked.column("texts"):
            for text in texts:
                text_id = text["text_id"].as_py()
                for item, place, length, exact in find_text(
                    text["words"].as_py(), places, window, slack
                ):
                    owner = np.searchsorted(starts, place, "right") - 1
                    inside = place + length <= starts[owner].astype(np.int64) + lengths[owner]
                    start = starts[owner][inside].astype(np.int64)
                    columns = [item[inside], place[inside] - start, length[inside]]
                    n = len(start)
                    rows.append(
                        pa.Table.from_arrays(
                            [pa.array(np.full(n, key[0].as_py())), pa.array(start), pa.array([text_id] * n, pa.string()), *map(pa.array, columns), pa.array([exact] * n, pa.bool_())],
                            schema=SPANS,
                        )
                    )
        return pa.concat_tables(rows) if rows else SPANS.empty_table()

    both = postings.groupBy("block", "slice").cogroup(asked.groupBy("at_block", "at_slice"))
    return both.applyInArrow(search, SPAN_FIELDS)


def _covered(spans: DataFrame) -> DataFrame:
    """``n_hit`` per document (block, start): words that lie in at least one of its spans."""
    by_place = Window.partitionBy("block", "start").orderBy("doc_word", "length")
    earlier = by_place.rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("doc_word") + F.col("length")
    before = F.coalesce(F.max(end).over(earlier), F.lit(0))
    added = F.greatest(F.lit(0), end - F.greatest(F.col("doc_word"), before))
    counted = spans.select("block", "start", added.alias("added"))
    return counted.groupBy("block", "start").agg(F.sum("added").alias("n_hit"))


class Contamination:
    """A search for the texts of ``benchmark`` (item_id, text) in ``docs`` (doc_id, text).

    Texts are lower-cased (A-Z only) and cut into words; a window is ``window`` consecutive words
    of an item, or all of an item of fewer. Null and empty texts have no words: such items occur
    nowhere, such documents are clean. Rows that repeat a doc_id are documents of their own; rows
    that repeat an item_id are one item with several texts; a null item_id is the item named by
    the empty string. Other columns are not read. Texts of any length are read whole.
    """

    def __init__(self, docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, slack: int | None = SLACK, slice_words: int = SLICE_WORDS, **index: int):
        if window + (slack or 0) > GAP:
            raise ValueError(f"windows and slack of more than {GAP} words would join documents")
        self.index = stored(build_index(docs, **index), "leaks-index")
        joined = F.concat_ws(" ", "words")
        named = split_words(benchmark, "item_id").where(F.size("words") > 0)
        items = stored(named.withColumn("text_id", F.sha2(joined, 256)), "leaks-items")
        self.members = items.select("text_id", F.col("key").alias("item_id")).distinct()
        texts = items.select("text_id", "words").dropDuplicates(["text_id"])
        self.spans = stored(
            find_passages(self.index, texts, window, slack, slice_words), "leaks-spans"
        )

    def documents(self) -> DataFrame:
        return self.index.where("term IS NULL").select("block", "start", "doc_id", "n")

    def passages(self) -> DataFrame:
        """Every match: ``doc_id``, ``item_id``, ``item_word`` and ``doc_word`` where it starts,
        ``length`` in words, ``kind`` 'phrase' (a run of windows) or 'proximity' (all words of
        the window that starts at ``item_word``, within ``slack`` others)."""
        kind = F.when(F.col("exact"), F.lit("phrase")).otherwise(F.lit("proximity"))
        found = self.spans.join(self.members, "text_id").join(self.documents(), ["block", "start"])
        return found.select("doc_id", "item_id", "item_word", "doc_word", "length", kind.alias("kind"))

    def by_document(self) -> DataFrame:
        """One row per document: ``n_words``, ``n_hit`` words inside an occurring window,
        ``n_items`` with one, ``item_ids`` (sorted as strings), ``n_near_items`` with proximity
        matches only, ``contaminated`` (any word hit)."""
        spans = self.spans.join(self.members, "text_id")
        items = spans.groupBy("block", "start", "item_id").agg(F.max("exact").alias("exact"))
        lists = items.groupBy("block", "start").agg(
            F.array_sort(F.collect_list(F.when(F.col("exact"), F.col("item_id")))).alias("item_ids"),
            F.count_if(~F.col("exact")).alias("n_near_items"),
        )
        hit = _covered(self.spans.where("exact"))
        found = self.documents().join(hit, ["block", "start"], "left").join(lists, ["block", "start"], "left")
        none = F.lit(0).cast("long")
        ids = F.coalesce("item_ids", F.array().cast("array<string>"))
        return found.select(
            "doc_id",
            F.col("n").alias("n_words"),
            F.coalesce("n_hit", none).alias("n_hit"),
            F.size(ids).cast("long").alias("n_items"),
            ids.alias("item_ids"),
            F.coalesce("n_near_items", none).alias("n_near_items"),
            (F.coalesce("n_hit", none) > 0).alias("contaminated"),
        )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document of ``docs`` with a digest of the benchmark items found in it."""
    found = Contamination(docs, benchmark).by_document()
    digest = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated", "n_near_items"
    )
