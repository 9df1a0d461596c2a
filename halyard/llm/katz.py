"""A Katz backoff language model over word n-grams.

Good-Turing discounts the counts of seen n-grams; what a context saves goes to words unseen after
it, in proportion to the model of one word less, with a weight that makes every context sum to
exactly one. Unknown words are one more word.

Documents are tokenised once, into blocks of bounded size with a vocabulary each. A block asks
for the corpus counts of its distinct n-grams with one sorted array per part of the key space,
which also brings the block's own training counts, so counting and looking up are one shuffle.
Parts add the arrays up and answer every block with counts in the order of its keys. An n-gram is
sent once per block however often it occurs, which evens out frequent ones.

An answer tells one block, the first one, that it owns an n-gram; owners add up probabilities per
context, parts turn the sums into backoff weights, and blocks ask for the weights they need.

N-grams are known by 64-bit hashes; among 10**9 of them a collision is expected 0.03 times.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halyard.llm.tables import crc_remainder, discard, stored

# --- fixed values: the query's settings ------------------------------------------------
ORDER = 2
HELD_OUT = (7, 2)
HASH_SEED = 42
# --- end of fixed values ----------------------------------------------------

#: Counts up to this one are discounted by Good and Turing's estimate.
RELIABLE = 5
#: What higher counts give up, and counts whose estimate is no discount: occurrences.
SHAVED_HIGH, SHAVED_LOW = 0.1, 0.5
BLOCK_TOKENS = 1 << 20
PART_KEYS = 1 << 21

# No word holds a space, so these differ from all words.
END, START = (np.uint64(xxhash.xxh64_intdigest(x, HASH_SEED)) for x in (b" end", b" start"))
MULTIPLY = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A 64-bit key of a context's key and a word's."""
    x = context * MULTIPLY[0] + (word ^ (word >> np.uint64(29))) * MULTIPLY[1] + np.uint64(1)
    x = (x ^ (x >> np.uint64(30))) * MULTIPLY[1]
    x = (x ^ (x >> np.uint64(27))) * MULTIPLY[2]
    return x ^ (x >> np.uint64(31))


@dataclass
class Grams:
    """The distinct n-grams of a block for one n, in the order of their keys.

    ``at`` has the place of each token's n-gram; per n-gram, ``context`` is the place of its
    first n - 1 words among the block's (n-1)-grams (-1 at the start of a document), ``lower``
    that of its last n - 1 words.
    """

    keys: np.ndarray
    at: np.ndarray
    context: np.ndarray
    lower: np.ndarray
    context_keys: np.ndarray


def grams_of(vocabulary: np.ndarray, codes: np.ndarray, starts: np.ndarray, order: int) -> list[Grams]:
    """N-grams for n = 1 to ``order``. ``vocabulary`` is sorted; ``codes`` are places in it, of
    all documents one after the other; ``starts`` are the places of first tokens."""
    nothing = np.zeros(0, np.int64)
    found = [Grams(vocabulary, codes.astype(np.int64), nothing, nothing, nothing.astype(np.uint64))]
    before = START
    for _ in range(1, order):
        last = found[-1]
        context = np.empty(len(codes), np.int64)
        context[1:] = last.at[:-1]
        context[starts] = -1
        size = np.int64(max(1, len(vocabulary)))
        pairs, first, inverse = np.unique(
            (context + 1) * size + codes, return_index=True, return_inverse=True
        )
        contexts, words = pairs // size - 1, pairs % size
        context_keys = np.concatenate([last.keys, [before]])[contexts]
        keys = mix(context_keys, vocabulary[words])
        order_ = np.argsort(keys, kind="stable")
        place = np.empty(len(order_), np.int64)
        place[order_] = np.arange(len(order_))
        found.append(
            Grams(keys[order_], place[inverse], contexts[order_], last.at[first][order_], context_keys[order_])
        )
        before = mix(np.array([before]), np.array([START]))[0]
    return found


def parts_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Bounds of the slices of sorted keys that belong to each of ``parts`` equal key ranges."""
    edges = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)


_BLOCK = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_id", pa.list_(pa.int64())),
        ("held_out", pa.list_(pa.bool_())),
        ("n_tokens", pa.list_(pa.int64())),
        ("vocabulary", pa.binary()),
        ("codes", pa.binary()),
    ]
)
_BLOCK_FIELDS = (
    "block bigint, doc_id array<bigint>, held_out array<boolean>, n_tokens array<bigint>,"
    " vocabulary binary, codes binary"
)


def _block_row(docs: list, words: dict[bytes, int], codes: list[np.ndarray], number: int) -> pa.RecordBatch:
    digests = [END, *[xxhash.xxh64_intdigest(w, HASH_SEED) for w in words]]
    hashed = np.array(digests, np.uint64)
    vocabulary, places = np.unique(hashed, return_inverse=True)
    token_codes = places[np.concatenate(codes)].astype("<i4")
    ids, held_out, sizes = zip(*docs)
    values = [[number], [ids], [held_out], [sizes], [vocabulary.tobytes()], [token_codes.tobytes()]]
    arrays = [pa.array(v, t.type) for v, t in zip(values, _BLOCK)]
    return pa.RecordBatch.from_arrays(arrays, schema=_BLOCK)


def tokenised(docs: DataFrame) -> DataFrame:
    """Stored blocks of documents (``doc_id``, ``text``, ``held_out``), a row per block."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        codes: list[np.ndarray] = []
        words: dict[bytes, int] = {}
        tokens, number = 0, 0
        for batch in batches:
            rows = zip(*(batch.column(c) for c in ("doc_id", "text", "held_out", "task")))
            for doc_id, text, held_out, task in rows:
                own = (text.as_py() or "").encode().lower().split()
                coded = [words.setdefault(w, len(words) + 1) for w in own]
                coded.append(0)
                codes.append(np.array(coded, np.int64))
                held.append((doc_id.as_py(), held_out.as_py(), len(coded)))
                tokens += len(coded)
                if tokens >= BLOCK_TOKENS:
                    yield _block_row(held, words, codes, (task.as_py() << 32) + number)
                    held, codes, words, tokens, number = [], [], {}, 0, number + 1
        if held:
            yield _block_row(held, words, codes, (task.as_py() << 32) + number)

    read = docs.select(
        F.col("doc_id").cast("long"), "text", "held_out", F.spark_partition_id().cast("long").alias("task")
    )
    return stored(read.mapInArrow(blocks, _BLOCK_FIELDS), "katz-blocks")


def _opened(row, order: int) -> tuple[list[Grams], np.ndarray, np.ndarray, np.ndarray]:
    """A block's n-grams, its documents' sizes and first places, and which tokens train."""
    sizes = np.asarray(row.n_tokens, np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    vocabulary = np.frombuffer(row.vocabulary, np.uint64)
    codes = np.frombuffer(row.codes, "<i4").astype(np.int64)
    training = np.repeat(~np.asarray(row.held_out, bool), sizes)
    return grams_of(vocabulary, codes, starts, order), sizes, starts, training


def _requests(blocks: DataFrame, order: int, parts: int) -> DataFrame:
    """Per block, order and part: ``keys`` (sorted) and ``own``, the block's training counts. Parts
    in which a block has no key are left out, so there are never more requests than n-grams,
    however many blocks and parts the corpus makes."""

    def asked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                grams, _, _, training = _opened(row, order)
                for n, g in enumerate(grams, 1):
                    own = np.bincount(g.at[training], minlength=len(g.keys)).astype("<i4")
                    bounds = parts_of(g.keys, parts)
                    asks = np.nonzero(np.diff(bounds))[0]
                    slices = [slice(bounds[p], bounds[p + 1]) for p in asks]
                    yield pd.DataFrame(
                        {
                            "n": n,
                            "part": asks,
                            "block": row.block,
                            "keys": [g.keys[s].tobytes() for s in slices],
                            "own": [own[s].tobytes() for s in slices],
                        }
                    )

    fields = "n int, part int, block bigint, keys binary, own binary"
    narrow = blocks.select("block", "held_out", "n_tokens", "vocabulary", "codes")
    return narrow.mapInPandas(asked, fields)


def _answers(requests: DataFrame) -> DataFrame:
    """Per request, ``counts`` of the corpus and ``owned`` bits in the order of its keys; and per
    part one row without a block, with ``stats``: n-grams of each count up to RELIABLE + 1, then
    the number of n-grams and the sum of their counts."""

    def answer(asked: pd.DataFrame) -> pd.DataFrame:
        asked = asked.sort_values("block", kind="stable")
        arrays = [np.frombuffer(k, np.uint64) for k in asked["keys"]]
        own = np.concatenate([np.frombuffer(c, "<i4") for c in asked["own"]])
        keys, first, inverse = np.unique(np.concatenate(arrays), return_index=True, return_inverse=True)
        counts = np.bincount(inverse, own, len(keys)).astype("<i8")
        owned = np.zeros(len(inverse), bool)
        owned[first] = True
        told, bounds = counts[inverse], np.cumsum([0, *map(len, arrays)])
        slices = [slice(a, b) for a, b in zip(bounds, bounds[1:])]
        seen = counts[counts > 0]
        stats = [*(int((seen == r).sum()) for r in range(1, RELIABLE + 2)), len(seen), int(seen.sum())]
        n, part = int(asked["n"].iloc[0]), int(asked["part"].iloc[0])
        rows = {
            "n": n,
            "part": part,
            "block": [*asked["block"], None],
            "counts": [*(told[s].tobytes() for s in slices), None],
            "owned": [*(np.packbits(owned[s]).tobytes() for s in slices), None],
            "stats": [*([None] * len(slices)), stats],
        }
        return pd.DataFrame(rows).astype({"block": "Int64"})

    fields = "n int, part int, block bigint, counts binary, owned binary, stats array<bigint>"
    return stored(requests.groupBy("n", "part").applyInPandas(answer, fields), "katz-counts")


@dataclass(frozen=True)
class Discounts:
    """What is kept of a count: per n, factors for counts 1 to RELIABLE."""

    factors: tuple[tuple[float, ...], ...]
    tokens: int
    types: int

    def kept(self, n: int, counts: np.ndarray) -> np.ndarray:
        """Discounted counts; 0 stays 0."""
        low = np.array([0.0, *self.factors[n - 1]])
        return np.where(
            counts <= RELIABLE, low[np.minimum(counts, RELIABLE)] * counts, counts - SHAVED_HIGH
        )

    def first(self, counts: np.ndarray) -> np.ndarray:
        """Probabilities of words; unknown ones share what the known ones leave."""
        return self.kept(1, counts) / max(1, self.tokens)


def good_turing(of_count: list[int]) -> tuple[float, ...]:
    """Katz's factors for counts 1 to k from the number of n-grams that occur 1 to k + 1 times.

    A factor that is no discount, as with few data, becomes one by a fixed share of a count.
    """
    k, singles = len(of_count) - 1, of_count[0]
    common = (k + 1) * of_count[k] / singles if singles else 1.0
    factors = []
    for r in range(1, k + 1):
        here, above = of_count[r - 1], of_count[r]
        factor = 0.0
        if here and above and common < 1:
            factor = ((r + 1) * above / (here * r) - common) / (1 - common)
        factors.append(factor if 0 < factor < 1 else (r - SHAVED_LOW) / r)
    return tuple(factors)


def _discounts(answers: DataFrame, order: int) -> tuple[Discounts, float]:
    """The discounts and the probability that is left to unknown words."""
    size = RELIABLE + 3
    sums = [F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(size)]
    totals = {
        row["n"]: [row[f"s{i}"] for i in range(size)]
        for row in answers.where("block IS NULL").groupBy("n").agg(*sums).collect()
    }
    rows = [totals.get(n, [0] * size) for n in range(1, order + 1)]
    factors = tuple(good_turing(row[: RELIABLE + 1]) for row in rows)
    *low, types, tokens = rows[0]
    low = low[:RELIABLE]
    kept = sum(f * r * n for f, r, n in zip(factors[0], range(1, RELIABLE + 1), low))
    high_types = types - sum(low)
    high = tokens - sum(r * n for r, n in enumerate(low, 1)) - SHAVED_HIGH * high_types
    unknown = 1 - (kept + high) / tokens if tokens else 1.0
    return Discounts(factors, tokens, types), unknown


def _told(answers: pd.DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Corpus counts and owned flags of a block's n-grams, in the order of their keys."""
    own = answers[answers["n"] == n].sort_values("part")
    counts = [np.frombuffer(c, "<i8") for c in own["counts"]]
    owned = [
        np.unpackbits(np.frombuffer(o, np.uint8), count=len(c)).astype(bool)
        for o, c in zip(own["owned"], counts)
    ]
    return np.concatenate(counts), np.concatenate(owned)


_SCORED_FIELDS = (
    "n int, part int, block bigint, keys binary, upper binary, lower binary, doc_id array<bigint>,"
    " held_out array<boolean>, n_tokens array<bigint>, n_known array<bigint>, base array<double>,"
    " score array<double>, ask_doc binary, ask_place binary, ask_times binary"
)
_SCORED_COLUMNS = [f.split()[0] for f in _SCORED_FIELDS.split(", ")]


def _scored(blocks: DataFrame, answers: DataFrame, order: int, parts: int, discounts: Discounts, unknown: float, documents: int) -> DataFrame:
    """Three kinds of rows, stored: per block its documents' scores without backoff weights
    (``doc_id`` is set), per block and part the sums of the contexts it owns (``upper`` is set),
    and the contexts whose weights it asks for (only ``keys`` is set)."""
    tokens, types = discounts.tokens, discounts.types

    def per_part(n: int, block: int, keys: np.ndarray, **sums: np.ndarray) -> list[dict]:
        bounds = parts_of(keys, parts)
        return [
            {"n": n, "part": i, "block": block, "keys": keys[a:b].tobytes()}
            | {name: values[a:b].tobytes() for name, values in sums.items()}
            for i, (a, b) in enumerate(zip(bounds, bounds[1:]))
            if b > a
        ]

    def score(block: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        row = next(block.itertuples())
        grams, sizes, _, _ = _opened(row, order)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        counts, owned = zip(*(_told(told, n) for n in range(1, order + 1)))
        chances = [discounts.first(counts[0])]
        out: list[dict] = []
        before = [np.zeros(0)]
        for n in range(2, order + 1):
            g = grams[n - 1]
            times = np.where(g.context < 0, documents, counts[n - 2][g.context])
            kept = discounts.kept(n, counts[n - 1])
            chances.append(np.where(counts[n - 1] > 0, kept / np.maximum(times, 1), 0.0))
            before.append(times)
            mine = owned[n - 1] & (counts[n - 1] > 0)
            keys, place = np.unique(g.context_keys[mine], return_inverse=True)
            upper = np.bincount(place, chances[n - 1][mine], len(keys))
            lower = np.bincount(place, chances[n - 2][g.lower[mine]], len(keys))
            out += per_part(n, row.block, keys, upper=upper, lower=lower)
        pending, log = np.arange(len(doc)), np.zeros(len(doc))
        asked: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in range(order, 1, -1):
            g, at = grams[n - 1], grams[n - 1].at[pending]
            seen = counts[n - 1][at] > 0
            log[pending[seen]] = np.log10(chances[n - 1][at[seen]])
            pending, at = pending[~seen], at[~seen]
            weighed = before[n - 1][at] > 0
            asked[n] = (g.context_keys[at[weighed]], doc[pending[weighed]])
        at = grams[0].at[pending]
        chance = np.where(counts[0][at] > 0, chances[0][at], unknown)
        log[pending] = np.log10(chance)
        nothing, offset = np.zeros(0, np.int64), 0
        ask_doc, ask_place, ask_times = [nothing], [nothing], [nothing]
        for n in range(2, order + 1):
            keys, place = np.unique(asked[n][0], return_inverse=True)
            pairs, times = np.unique(asked[n][1] * max(1, len(keys)) + place, return_counts=True)
            ask_doc.append(pairs // max(1, len(keys)))
            ask_place.append(pairs % max(1, len(keys)) + offset)
            ask_times.append(times)
            offset += len(keys)
            out += per_part(n, row.block, keys)
        counted = counts[0][grams[0].at]
        base = np.log10((counted + 1) / (tokens + types + 1))
        out.append(
            {
                "block": row.block,
                "doc_id": row.doc_id,
                "held_out": row.held_out,
                "n_tokens": row.n_tokens,
                "n_known": np.bincount(doc, counted > 0, len(sizes)).astype(np.int64),
                "base": np.bincount(doc, base, len(sizes)),
                "score": np.bincount(doc, log, len(sizes)),
                "ask_doc": np.concatenate(ask_doc).astype("<i8").tobytes(),
                "ask_place": np.concatenate(ask_place).astype("<i8").tobytes(),
                "ask_times": np.concatenate(ask_times).astype("<i8").tobytes(),
            }
        )
        columns = {c: pd.Series([r.get(c) for r in out], dtype=object) for c in _SCORED_COLUMNS}
        frame = pd.DataFrame(columns)
        return frame.astype({"n": "Int32", "part": "Int32", "block": "Int64"})

    told = answers.where("block IS NOT NULL").drop("stats")
    paired = blocks.groupBy("block").cogroup(told.groupBy("block"))
    return stored(paired.applyInPandas(score, _SCORED_FIELDS), "katz-scores")


def _weights(scored: DataFrame) -> DataFrame:
    """Per block, n and part: ``logs``, the log10 of the backoff weights asked for, in the order
    of the keys. The weight of a context is what its seen words leave over what the shorter
    context gives words that it has not seen."""

    def weigh(frame: pd.DataFrame) -> pd.DataFrame:
        sums, asks = frame[frame["upper"].notna()], frame[frame["upper"].isna()]
        keys = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(k, np.uint64) for k in sums["keys"])])
        known, place = np.unique(keys, return_inverse=True)
        upper, lower = (
            np.bincount(place, np.concatenate([np.zeros(0), *(np.frombuffer(v, float) for v in sums[c])]), len(known))
            for c in ("upper", "lower")
        )
        logs = np.log10((1 - upper) / (1 - lower))
        told = [logs[np.searchsorted(known, np.frombuffer(k, np.uint64))].tobytes() for k in asks["keys"]]
        return pd.DataFrame(
            {"n": asks["n"].to_numpy(), "part": asks["part"].to_numpy(), "block": asks["block"].to_numpy(), "logs": told}
        )

    rows = scored.where("doc_id IS NULL").select("n", "part", "block", "keys", "upper", "lower")
    return rows.groupBy("n", "part").applyInPandas(weigh, "n int, part int, block bigint, logs binary")


_RESULT_FIELDS = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,"
    " base_score double, score double"
)


def score_documents(docs: DataFrame, order: int = ORDER, *, parts: int | None = None) -> DataFrame:
    """Learn from the documents whose crc32 of doc_id does not leave the held-out remainder and
    score all: ``doc_id``, ``held_out``, ``n_tokens`` (words and one end), ``n_known`` (those
    seen in training), ``train_tokens``, ``base_score`` (one added to unigram counts) and
    ``score`` (Katz's model of ``order`` words), both log10 of the text's probability.

    A null or empty text is the end alone. Repeated rows count and are scored as often as they
    occur; a null doc_id counts as empty text where documents are held out and stays null. A
    text longer than a block is a block of its own. Without training tokens every token is
    unknown and has probability 1. An empty table gives no rows; other columns are not read.
    """
    if order < 1:
        raise ValueError("a model needs at least one word")
    modulus, remainder = HELD_OUT
    marked = docs.select("doc_id", "text", (crc_remainder("doc_id", modulus) == remainder).alias("held_out"))
    blocks = tokenised(marked)
    sums = blocks.agg(
        F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, b: a + b)),
        F.sum(F.size(F.filter("held_out", lambda h: ~h))),
    ).first()
    tokens, documents = (x or 0 for x in sums)
    parts = parts or max(1, -(-order * tokens // PART_KEYS))
    answers = _answers(_requests(blocks, order, parts))
    discounts, unknown = _discounts(answers, order)
    scored = _scored(blocks, answers, order, parts, discounts, unknown, documents)
    discard(answers)
    train_tokens = discounts.tokens

    def finish(rows: pd.DataFrame, weights: pd.DataFrame) -> pd.DataFrame:
        row = next(rows.itertuples())
        weights = weights.sort_values(["n", "part"])
        logs = np.concatenate([np.zeros(0), *(np.frombuffer(x, float) for x in weights["logs"])])
        at, place, times = (np.frombuffer(x, "<i8") for x in (row.ask_doc, row.ask_place, row.ask_times))
        backed_off = np.bincount(at, times * logs[place], len(row.doc_id))
        return pd.DataFrame(
            {
                "doc_id": pd.array(row.doc_id, "Int64"),
                "held_out": np.asarray(row.held_out, bool),
                "n_tokens": row.n_tokens,
                "n_known": row.n_known,
                "train_tokens": train_tokens,
                "base_score": row.base,
                "score": np.asarray(row.score, float) + backed_off,
            }
        )

    kept = scored.where("doc_id IS NOT NULL").drop("n", "part", "keys", "upper", "lower")
    paired = kept.groupBy("block").cogroup(_weights(scored).groupBy("block"))
    return paired.applyInPandas(finish, _RESULT_FIELDS)
