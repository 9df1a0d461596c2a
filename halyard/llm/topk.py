"""Exact top-k search by selecting in histograms of scores.

Candidates and queries are dealt into blocks of bounded size, and every block of one meets every
block of the other in a cell. Pass after pass, each cell scores its candidates and counts, per query,
how many scores fall in each bin of the range that is still open; the counts are added up over the
table and locate the bin that holds the k-th score, which is cut into bins again until it is a
single score. A last pass keeps what is above the k-th score, and of those equal to it the smallest
ids. All queries take a pass together, and their open ranges are a table: the number of jobs
depends on the range of scores, not on the number of queries.

A cell need not send bins that lie wholly below k scores of its own, and of the scores that pass
it sends at most k, so what is shuffled is bounded per cell and query however many ties there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halyard.llm.tables import stored

# --- fixed values: the query's settings ------------------------------------------------
SCALE = 1024
QUERY_STEP = 100
NEIGHBOURS = 10
# --- end of fixed values ----------------------------------------------------

#: Expected queries and candidates of a block; ids are dealt to blocks by hash.
QUERIES, CANDIDATES = 1 << 12, 1 << 16
BINS = 1024
#: Queries and candidates scored at once: bound the memory of a task.
CHUNKS = 512, 2048
EXACT = 2.0**53
#: What is known of a query: least score, number of scores and of scores per bin of its open range,
#: and the rank inside it of the score that is sought.
STATE = ("low", "span", "width", "needed")


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``v``, the components times ``scale`` rounded down, as whole doubles. Rows
    with a null id, a null vector, or a null or non-finite component take no part."""
    components = F.transform("embedding", lambda x: x.cast("double"))
    sound = F.forall(
        F.col("embedding"),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound)
    return usable.select(
        F.col("vec_id").cast("long"),
        F.transform(components, lambda x: F.floor(x * F.lit(scale)).cast("double")).alias("v"),
    )


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products as int64. Doubles are exact while every partial sum stays below 2**53;
    where it might not, whole numbers of any size are used, so that the result fits or fails."""
    dims = queries.shape[1]
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * dims
    if largest < EXACT:
        return (queries @ candidates.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return (whole(queries) @ whole(candidates).T).astype(np.int64)


def _matrices(table: pa.Table, key: str) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Table]]:
    """Rows of one vector length after the other: the length, ids, vectors and the rows."""
    lists = table.column("v").combine_chunks()
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    for dims in np.unique(lengths):
        own = pa.array(lengths == dims)
        flat = lists.filter(own).flatten().to_numpy(zero_copy_only=False)
        rows = table.filter(own)
        yield int(dims), rows.column(key).to_numpy(), flat.reshape(rows.num_rows, dims), rows


def _scored(
    held: pa.Table, asked: pa.Table
) -> Iterator[tuple[np.ndarray, dict[str, np.ndarray], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]]:
    """Per chunk of queries: their ids, their state, and chunk by chunk ids and scores of the candidates
    with a mask of those that count (a query's own rows and vectors of another length do not)."""
    candidates = {dims: (ids, flat) for dims, ids, flat, _ in _matrices(held, "vec_id")}

    def chunks(own: np.ndarray, vectors: np.ndarray, dims: int):
        ids, flat = candidates.get(dims, (np.zeros(0, np.int64), np.zeros((0, dims))))
        for start in range(0, len(ids), CHUNKS[1]):
            part = slice(start, start + CHUNKS[1])
            yield ids[part], scores(vectors, flat[part]), own[:, None] != ids[part][None, :]

    for dims, ids, vectors, rows in _matrices(asked, "query_id"):
        known = {c: rows.column(c).to_numpy() for c in STATE if c in rows.column_names}
        for start in range(0, len(ids), CHUNKS[0]):
            part = slice(start, start + CHUNKS[0])
            state = {c: x[part] for c, x in known.items()}
            yield ids[part], state, chunks(ids[part], vectors[part], dims)


def _table(columns: dict[str, list[np.ndarray]]) -> pa.Table:
    joined = {c: np.concatenate([np.zeros(0, np.int64), *x]) for c, x in columns.items()}
    return pa.table({c: pa.array(x, pa.int64()) for c, x in joined.items()})


def _extent(held: pa.Table, asked: pa.Table) -> pa.Table:
    """Per query, least and largest score and their number."""
    found: dict[str, list[np.ndarray]] = {c: [] for c in ("query_id", "low", "high", "n")}
    for ids, _, chunks in _scored(held, asked):
        n = len(ids)
        low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
        count = np.zeros(n, np.int64)
        for _, score, counts in chunks:
            low = np.minimum(low, np.where(counts, score, np.iinfo(np.int64).max).min(axis=1))
            high = np.maximum(high, np.where(counts, score, np.iinfo(np.int64).min).max(axis=1))
            count += counts.sum(axis=1)
        seen = count > 0
        for c, x in zip(found, (ids, low, high, count)):
            found[c].append(x[seen])
    return _table(found)


def _histogram(held: pa.Table, asked: pa.Table) -> pa.Table:
    """Counts per query and bin of the open range, without bins that cannot hold the k-th."""
    found: dict[str, list[np.ndarray]] = {c: [] for c in ("query_id", "bin", "n")}
    for ids, state, chunks in _scored(held, asked):
        n = len(ids)
        counts = np.zeros((n, BINS), np.int64)
        first = (np.arange(n) * BINS)[:, None]
        for _, score, valid in chunks:
            place = score - state["low"][:, None]
            inside = valid & (place >= 0) & (place < state["span"][:, None])
            bins = place // state["width"][:, None]
            counts += np.bincount((bins + first)[inside], minlength=n * BINS).reshape(n, BINS)
        above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
        q, place = np.nonzero((counts > 0) & (above < state["needed"][:, None]))
        for c, x in zip(found, (ids[q], place, counts[q, place])):
            found[c].append(x)
    return _table(found)


def _selected(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A cell's best k of the scores at or above the k-th score, ties to smaller ids."""

    def kept(held: pa.Table, asked: pa.Table) -> pa.Table:
        found: dict[str, list[np.ndarray]] = {c: [] for c in ("query_id", "vec_id", "score")}
        for ids, state, chunks in _scored(held, asked):
            best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]
            for others, score, valid in chunks:
                passing = valid & (score >= state["low"][:, None])
                for q in np.nonzero(passing.any(axis=1))[0]:
                    own = passing[q]
                    all_ids = np.concatenate([best[q][0], others[own]])
                    all_scores = np.concatenate([best[q][1], score[q, own]])
                    order = np.lexsort((all_ids, -all_scores))[:k]
                    best[q] = all_ids[order], all_scores[order]
            found["query_id"].append(np.repeat(ids, [len(b[0]) for b in best]))
            found["vec_id"] += [b[0] for b in best]
            found["score"] += [b[1] for b in best]
        return _table(found)

    return kept


class _Cells:
    """Blocks of candidates and queries that meet."""

    def __init__(self, candidates: DataFrame, is_query: Column, sizes: tuple[int, int]):
        counts = candidates.agg(F.count_if(is_query), F.count(F.lit(1))).first()
        self.blocks = [max(1, -(-n // size)) for n, size in zip(counts, sizes)]
        numbers = [F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int") for n in self.blocks]
        every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in self.blocks]
        self.held = candidates.select(
            every[0].alias("query_block"), numbers[1].alias("block"), "vec_id", "v"
        )
        self.queries = candidates.where(is_query).select(
            F.col("vec_id").alias("query_id"), F.col("v"), numbers[0].alias("own_block")
        )
        self.meeting = every[1].alias("met_block")

    def each(
        self, find: Callable[[pa.Table, pa.Table], pa.Table], state: DataFrame | None, fields: str
    ) -> DataFrame:
        """What ``find`` gives for every cell; with a state, for the queries that have one."""
        asked = self.queries if state is None else self.queries.join(state, "query_id")
        asked = asked.select("*", self.meeting)
        asked = asked.toDF(*asked.columns)  # columns apart from those of the candidates
        return (
            self.held.groupBy("query_block", "block")
            .cogroup(asked.groupBy("own_block", "met_block"))
            .applyInArrow(find, fields)
        )


def _refined(cells: _Cells, k: int) -> DataFrame:
    """The state of every query once its range is the k-th score (the least, if there are fewer)."""
    extent = cells.each(_extent, None, "query_id bigint, low bigint, high bigint, n bigint")
    ranges = extent.groupBy("query_id").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")
    )

    def with_width(state: DataFrame) -> DataFrame:
        width = F.expr(f"(span + {BINS - 1}) div {BINS}")
        return stored(state.withColumn("width", width).select("query_id", *STATE), "topk-state")

    span = (F.col("high") - F.col("low") + 1).alias("span")
    state = with_width(ranges.select("query_id", "low", span, F.least(F.lit(k), F.col("n")).alias("needed")))
    while not (open_ := state.where("span > 1")).isEmpty():
        counts = cells.each(_histogram, open_, "query_id bigint, bin bigint, n bigint")
        summed = counts.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        from_top = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        through = F.sum("n").over(from_top.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        located = (
            summed.withColumn("through", through)
            .join(open_.select("query_id", "low", "width", "needed"), "query_id")
            .where((F.col("through") >= F.col("needed")) & (F.col("through") - F.col("n") < F.col("needed")))
        )
        narrowed = located.select(
            "query_id",
            (F.col("low") + F.col("bin") * F.col("width")).alias("low"),
            F.col("width").alias("span"),
            (F.col("needed") - (F.col("through") - F.col("n"))).alias("needed"),
        )
        done = state.where("span <= 1").select("query_id", "low", "span", "needed")
        state = with_width(done.unionByName(narrowed))
    return state


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = NEIGHBOURS,
    *,
    queries: int = QUERIES,
    candidates: int = CANDIDATES,
) -> DataFrame:
    """The ``k`` highest scores of every query among all rows but its own: ``query_id``, ``rank``
    (from 1), ``vec_id``, ``score``, ties to the smaller id; all, if there are fewer.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` marks queries. Vectors of another
    length than a query's are not compared with it. Of repeated rows of one id the first in the
    order of the vectors stands for it; an empty table, or none marked, gives no rows. Empty
    vectors score 0 with each other. Other columns are not read.
    """
    one = quantised(vectors).groupBy("vec_id").agg(F.min("v").alias("v"))
    cells = _Cells(stored(one, "topk-vectors"), is_query, (queries, candidates))
    state = _refined(cells, k)
    found = cells.each(_selected(k), state, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
