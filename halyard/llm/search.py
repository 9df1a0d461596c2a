"""Ranked lexical search for many queries at once, sharing what they have in common.

Queries are bags of terms; equal bags are one. They are ordered by a min-hash of their terms, so that
similar ones come together, and cut into slices of bounded size. In a slice the sets of terms
that queries share are mined: round by round the pairs with the costliest common set are
matched, and each common set becomes a node of its own, which can share again. So a slice is a
graph: a node adds the scores of its own terms to those of the nodes it refers to.

The postings of a slice's terms meet its graph block by block (``postings``). A block scores
every term once, builds one accumulator over its documents per node, nodes that are referred to
first, and keeps the best documents per query. What is shuffled is postings, graphs and at most
k rows per block and query.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from halyard.llm.postings import (
    DOCUMENT_TERMS,
    IDS,
    KNOWN,
    LENGTHS,
    STARTS,
    build_index,
    places_of,
    postings_of,
    split_words,
)
from halyard.llm.tables import stored

# --- fixed values: the query's settings ------------------------------------------------
BEST = 20
SCALE = 1_000_000_000
# --- end of fixed values ----------------------------------------------------

#: Different terms and queries of a slice, at most (a query with more terms is a slice alone).
SLICE_TERMS, SLICE_QUERIES = 1 << 14, 1 << 8
#: Smallest set worth a node: the sum over its terms of the share of documents that hold them.
#: Adding a node's accumulator to another costs about a quarter of a term in every document.
LEAST_SHARED = 0.25
#: Words of a block of documents: with a slice's queries it bounds the accumulators of a task.
BLOCK_WORDS = 1 << 20

GRAPH = pa.schema([("slice", pa.int64()), ("graph", pa.binary()), ("terms", pa.list_(pa.string()))])
GRAPH_FIELDS = "slice bigint, graph binary, terms array<string>"
FOUND = pa.schema([("query", pa.string()), ("doc_id", pa.int64()), ("score", pa.int64())])


def share(
    bags: Sequence[frozenset], cost: dict, least: float = LEAST_SHARED
) -> tuple[list[set], list[list[int]]]:
    """The graph of a slice: per node its own symbols and the nodes it refers to. The first nodes
    are the bags; a node refers to later ones only, and what it reaches adds up to its bag."""
    own, parts = [set(b) for b in bags], [[] for _ in bags]
    while True:
        seen, common = set(), set()
        for symbols in own:
            common |= seen & symbols
            seen |= symbols
        active = [i for i, symbols in enumerate(own) if symbols & common]
        column = {s: j for j, s in enumerate(sorted(common))}
        held = np.zeros((len(active), len(column)), np.float32)
        for row, i in enumerate(active):
            for s in own[i] & common:
                held[row, column[s]] = math.sqrt(cost[s])
        shared = np.triu(held @ held.T, 1)
        left, right = np.nonzero((shared >= least) & (shared > 0))
        taken: set[int] = set()
        for place in np.argsort(-shared[left, right], kind="stable").tolist():
            i, j = active[left[place]], active[right[place]]
            if i in taken or j in taken:
                continue
            symbols = own[i] & own[j]
            if len(symbols) < 2:
                continue
            taken |= {i, j}
            for node in (i, j):
                own[node] -= symbols
                parts[node].append(len(own))
            own.append(symbols)
            parts.append([])
        if not taken:
            return own, parts


def _chunks(rows: Iterator[dict]) -> Iterator[list[dict]]:
    """Queries, in order, in slices of bounded size."""
    chunk, terms = [], set()
    for row in rows:
        added = {t["term"] for t in row["terms"]}
        if chunk and (len(chunk) == SLICE_QUERIES or len(terms | added) > SLICE_TERMS):
            yield chunk
            chunk, terms = [], set()
        chunk.append(row)
        terms |= added
    if chunk:
        yield chunk


def _graphs(bags: DataFrame, n_docs: int, least: float) -> DataFrame:
    """Graphs of all slices, from ``query`` and ``terms`` (term, times, df, w): a row per slice with
    its terms and the graph, small because every block gets it."""

    def mined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        rows = (row for batch in batches for row in batch.to_pylist())
        for chunk in _chunks(rows):
            facts = {(t["term"], t["times"]): t for row in chunk for t in row["terms"]}
            cost = {symbol: t["df"] / n_docs for symbol, t in facts.items()}
            sets = [frozenset((t["term"], t["times"]) for t in row["terms"]) for row in chunk]
            own, parts = share(sets, cost, least)
            nodes = [
                {
                    "query": chunk[i]["query"] if i < len(chunk) else None,
                    "terms": [[*symbol, facts[symbol]["w"]] for symbol in sorted(own[i])],
                    "parts": parts[i],
                }
                for i in range(len(own))
            ]
            packed = zlib.compress(json.dumps(nodes).encode())
            terms = sorted({term for term, _ in facts})
            row = {"slice": number, "graph": packed, "terms": terms}
            yield pa.RecordBatch.from_pylist([row], schema=GRAPH)
            number += 1

    return bags.mapInArrow(mined, GRAPH_FIELDS)


def _slice_graphs(bags: DataFrame, n_docs: int, least: float) -> DataFrame:
    total = bags.agg(F.sum(F.size("terms").cast("long"))).first()[0] or 0
    first = F.array_min(F.transform("terms", lambda t: F.xxhash64(t["term"])))
    slices = total // SLICE_TERMS + 1  # a slice more is one more reading of all postings that it asks for
    ranged = bags.withColumn("first", first).repartitionByRange(slices, "first", "query")
    ordered = ranged.coalesce(slices).sortWithinPartitions("first", "query").select("query", "terms")
    return _graphs(ordered, n_docs, least)


class _Documents:
    """A block's documents and the scores of its terms."""

    def __init__(self, held: pa.Table, total_docs: int, total_words: int):
        self.places = places_of(held.column("term"), held.column("places"))
        self.starts = self.places[STARTS].astype(np.int64)
        self.ids, self.known = self.places[IDS], self.places[KNOWN].astype(bool)
        length = self.places[LENGTHS].astype(np.int64)
        self.m = 100 - 25 + (25 * length * total_docs) // max(total_words, 1)
        self.order = np.lexsort((self.ids, ~self.known))  # ids in order, unknown ones last
        self.scores: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def score(self, term: str, w: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents that hold a term and what it adds to them, computed once."""
        if term not in self.scores:
            places = self.places.get(term, np.zeros(0, np.int32))
            owner = np.searchsorted(self.starts, places, "right") - 1
            firsts = np.nonzero(np.diff(owner, prepend=-1))[0]
            docs = owner[firsts]
            tf = np.diff(np.append(firsts, len(owner)))
            self.scores[term] = docs, w * (SCALE * tf // (1000 * tf + 12 * self.m[docs]))
        return self.scores[term]

    def accumulate(self, nodes: list[dict]) -> Iterator[tuple[str, np.ndarray]]:
        """Accumulators of the queries, each node built once and freed after its last use."""
        uses = np.zeros(len(nodes), np.int64)
        for node in nodes:
            uses[node["parts"]] += 1
        built: dict[int, np.ndarray] = {}
        for i in range(len(nodes) - 1, -1, -1):
            total = np.zeros(len(self.starts), np.int64)
            for part in nodes[i]["parts"]:
                total += built[part]
                uses[part] -= 1
                if not uses[part]:
                    del built[part]
            for term, times, w in nodes[i]["terms"]:
                docs, added = self.score(term, w)
                total[docs] += times * added
            if nodes[i]["query"] is None:
                built[i] = total
            else:
                yield nodes[i]["query"], total

    def best(self, total: np.ndarray, k: int) -> np.ndarray:
        """The ``k`` documents with the highest scores above 0, ties to smaller ids."""
        ordered = total[self.order]
        least = max(1, np.partition(ordered, -k)[-k]) if len(ordered) > k else 1
        above = np.nonzero(ordered > least)[0]
        tied = np.nonzero(ordered == least)[0][: k - len(above)]
        return self.order[np.concatenate([above, tied])]


def rank(
    index: DataFrame, bags: DataFrame, k: int, least: float = LEAST_SHARED
) -> DataFrame:
    """``query``, ``doc_id``, ``score`` of each block's best documents. ``bags`` has ``query`` and
    ``words`` (with repeats)."""
    counted = bags.select("query", F.explode("words").alias("term")).groupBy("query", "term").agg(F.count(F.lit(1)).alias("times"))
    counted = stored(counted, "search-terms")
    wanted = counted.select("term").distinct()
    facts = index.where("term IS NULL").agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    n_docs, n_words = facts[0], facts[1] or 0
    held = postings_of(index.select("block", "term", "docs"), wanted)
    frequency = held.groupBy("term").agg(F.sum("docs").alias("df"))
    w = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1).cast("double")))
    weighted = counted.join(frequency.withColumn("w", w.cast("long")), "term")
    fact = F.struct("term", "times", F.col("df").cast("double").alias("df"), "w")
    queries = weighted.groupBy("query").agg(F.array_sort(F.collect_list(fact)).alias("terms"))
    graph = stored(_slice_graphs(queries, max(n_docs, 1), least), "search-graph")
    every = F.explode(F.array(*[F.lit(t) for t in DOCUMENT_TERMS]))
    terms = stored(
        graph.select("slice", F.explode("terms").alias("term")).union(
            graph.select("slice", every.alias("term"))
        ),
        "search-slices",
    )
    postings = postings_of(index.select("block", "term", "places"), terms)
    met = postings_of(index.where(F.col("term") == STARTS).select("block", "term"), terms)
    asked = met.join(graph, "slice").select("block", "slice", "graph")
    asked = asked.toDF("at_block", "at_slice", "graph")

    def search(held: pa.Table, asked: pa.Table) -> pa.Table:
        documents = _Documents(held, n_docs, n_words)
        rows = []
        for graph in asked.column("graph").to_pylist():
            for query, total in documents.accumulate(json.loads(zlib.decompress(graph))):
                best = documents.best(total, k)
                ids = pa.array(documents.ids[best], mask=~documents.known[best])
                columns = [pa.array([query] * len(best), pa.string()), ids, pa.array(total[best])]
                rows.append(pa.Table.from_arrays(columns, schema=FOUND))
        return pa.concat_tables(rows) if rows else FOUND.empty_table()

    both = postings.groupBy("block", "slice").cogroup(asked.groupBy("at_block", "at_slice"))
    return both.applyInArrow(search, "query string, doc_id bigint, score bigint")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = BEST,
    *,
    least: float = LEAST_SHARED,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """For each row of ``items`` (item_id, text) its ``k`` highest-scoring rows of ``docs`` (doc_id,
    text): ``item_id``, ``rank`` from 1, ``doc_id``, ``score`` (above 0), ties to smaller ids.

    Null and empty texts have no terms: such items find nothing, such documents are not counted
    and not found. Terms in no document add nothing. Rows that repeat a doc_id are documents of
    their own, each of which is ranked; a null doc_id comes after all others in ties and
    is a null in the result. Rows that repeat an item_id are ranked as one each, so their ranks
    repeat; a null item_id stays null. No documents or no items give no rows. Texts are read whole
    and other columns are not read.
    """
    index = stored(build_index(docs, block_words), "search-index")
    # as JSON an id of any type, null too, passes through as a string
    words = split_words(items.select(F.to_json(F.struct("item_id")).alias("row"), "text"), "row")
    bag = F.array_sort("words")
    named = words.where(F.size("words") > 0).select(
        F.col("key"), bag.alias("words"), F.sha2(F.concat_ws(" ", bag), 256).alias("query")
    )
    queries = stored(named, "search-items")
    found = rank(index, queries.select("query", "words").dropDuplicates(["query"]), k, least)
    last = F.struct(F.col("doc_id").isNull(), F.col("doc_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), last)
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    best = stored(ranked, "search-ranked")
    kind = items.schema["item_id"].dataType.simpleString()
    item = F.from_json("key", f"item_id {kind}")["item_id"].alias("item_id")
    return queries.select("key", "query").join(best, "query").select(item, "rank", "doc_id", "score")
