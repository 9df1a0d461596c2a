"""A toxicity classifier that is penalised where swapping identity terms changes its score.

Features are the words of a text and their first letters, hashed. Tasks count features by class
over the training sample and Spark adds the counts up; the most informative features, a fixed
number of them, go to the driver. The model is a logistic regression on those features whose
loss also has the squared change of the log-odds when the identity terms of a text are swapped
for others of their group, so that naming a group is not evidence by itself. Scoring is one
pass over all texts without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from halyard.llm.tables import crc_remainder, stored

# --- fixed values: groups whose terms are swapped for one another --------------------
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("female", "male"), ("girls", "boys"), ("she", "he"),
    ("black", "white", "asian", "latino"), ("muslims", "christians", "jews", "hindus", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "atheist"), ("gay", "straight"),
    ("lesbian", "heterosexual"), ("transgender", "cisgender"), ("immigrants", "natives"),
    ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
)
# --- end of fixed values ----------------------------------------------------

#: Rows that the model is fitted on, at most; chosen by a hash of doc_id.
TRAINING_ROWS = 30_000
FEATURES = 4_096
BUCKETS = 1 << 20
PREFIXES = (4, 5, 6)
LEAST_TEXTS = 8
RIDGE = 1e-4
SWAP_PENALTY = 1.0
STEPS = 400
THRESHOLD = 0.3
HELD_OUT = (4, 2)
MEMO = 200_000
_EDGES = b".,;:!?\"'()[]{}*#%&$<>|-_"


def _hashed(kind: bytes, value: bytes) -> int:
    return zlib.crc32(value, zlib.crc32(kind)) % BUCKETS


def word_features(word: bytes) -> tuple[int, ...]:
    """The word, and its first letters where it is longer than they are."""
    letters = word.decode("utf-8", "ignore")
    return (
        _hashed(b"w", word),
        *[_hashed(b"p", letters[:n].encode()) for n in PREFIXES if len(letters) > n],
    )


def words_of(text: str | None) -> set[bytes]:
    """Distinct words, lower case, without marks at their ends."""
    bare = {w.strip(_EDGES) for w in (text or "").lower().encode().split()}
    bare.discard(b"")
    return bare


class Extractor:
    """Features of texts, restricted to ``wanted`` if given; remembers words it has seen."""

    def __init__(self, wanted: Sequence[int] | None = None):
        self.places = None if wanted is None else {f: i for i, f in enumerate(wanted)}
        self.memo: dict[bytes, tuple[int, ...]] = {}

    def of_word(self, word: bytes) -> tuple[int, ...]:
        found = self.memo.get(word)
        if found is None:
            found = word_features(word)
            if self.places is not None:
                found = tuple(self.places[f] for f in found if f in self.places)
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[word] = found
        return found

    def of_words(self, words: set[bytes]) -> list[int]:
        features: set[int] = set()
        for word in words:
            features.update(self.of_word(word))
        return sorted(features)


def swap_table(groups: Sequence[Sequence[str]]) -> dict[bytes, bytes]:
    """Each identity term and the next one of its group."""
    encoded = [[t.lower().encode() for t in group] for group in groups]
    return {t: group[(i + 1) % len(group)] for group in encoded for i, t in enumerate(group)}


def swapped(words: set[bytes], swaps: dict[bytes, bytes]) -> set[bytes]:
    if not any(w in swaps for w in words):
        return words
    return {swaps.get(w, w) for w in words}


@dataclass(frozen=True)
class ToxicityModel:
    """Hashed features, a weight each, and the intercept."""

    features: tuple[int, ...]
    weights: tuple[float, ...]
    intercept: float


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """``text`` and ``toxic`` of at most ``rows`` labelled documents outside the held-out part."""
    modulus, held_out = HELD_OUT
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .where(crc_remainder("doc_id", modulus) != held_out)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", "text")
    sample = texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    return stored(sample, "toxicity-sample")


def informative_features(sample: DataFrame, most: int = FEATURES) -> list[int]:
    """The features with the largest chi-squared statistic against the label."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract, counts = Extractor(), np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                counts[toxic, extract.of_words(words_of(text.as_py()))] += 1
        seen = np.nonzero(counts.sum(axis=0))[0]
        columns = [pa.array(seen), pa.array(counts[0, seen]), pa.array(counts[1, seen])]
        yield pa.RecordBatch.from_arrays(columns, names=["feature", "clean", "toxic"])

    counts = sample.mapInArrow(counted, "feature bigint, clean bigint, toxic bigint")
    summed = counts.groupBy("feature").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    totals = sample.groupBy("toxic").count().collect()
    n = {row["toxic"]: row["count"] for row in totals}
    if len(n) < 2:
        return []
    clean, toxic = float(n[0]), float(n[1])
    odd = F.col("t") * (clean - F.col("c")) - F.col("c") * (toxic - F.col("t"))
    seen, unseen = F.col("t") + F.col("c"), clean + toxic - F.col("t") - F.col("c")
    statistic = F.when(unseen > 0, odd * odd / (seen * unseen)).otherwise(0.0)
    ranked = summed.where((seen >= LEAST_TEXTS) & (statistic > 0))
    best = ranked.orderBy(statistic.desc(), "feature").limit(most)
    return [row["feature"] for row in best.select("feature").collect()]


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and values of a list column, without a Python object for each."""
    lengths = pc.list_value_length(column).to_numpy()
    return np.repeat(np.arange(len(lengths)), lengths), pc.list_flatten(column).to_numpy()


def _fit(rows: pa.Table, size: int, ridge: float, penalty: float) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise log-loss, ridge and squared swap changes."""
    y = rows["toxic"].to_numpy().astype(float)
    row_of, feature = _flat(rows["present"])
    moved_row, moved_feature = _flat(rows["moved"])
    _, sign = _flat(rows["sign"])
    n = rows.num_rows
    often = np.maximum(np.bincount(feature, minlength=size) / n, 1 / n)
    scale = often**-0.5  # features of unit second moment: rare ones learn as fast as common ones

    def forward(w: np.ndarray, rows_: np.ndarray, at: np.ndarray, by: np.ndarray) -> np.ndarray:
        return np.bincount(rows_, by * (scale * w)[at], n)

    def back(e: np.ndarray, rows_: np.ndarray, at: np.ndarray, by: np.ndarray) -> np.ndarray:
        return scale * np.bincount(at, by * e[rows_], size) / n

    text, swap = (row_of, feature, np.ones(len(feature))), (moved_row, moved_feature, sign)
    steep = np.full(size, size**-0.5)
    largest = 1.0
    for _ in range(30):  # power iteration: how steep the loss can be
        steep = back(forward(steep, *text), *text) / 4 + 2 * penalty * back(forward(steep, *swap), *swap)
        largest = float(np.linalg.norm(steep)) or 1.0
        steep /= largest
    rate = 0.8 / (largest + 0.25 + ridge)
    weights, bias, momentum = np.zeros(size), 0.0, 1.0
    look, look_bias = weights.copy(), bias
    for _ in range(STEPS):
        z = look_bias + forward(look, *text)
        error = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - y
        gradient = back(error, *text) + ridge * look
        gradient += 2 * penalty * back(forward(look, *swap), *swap)
        new, new_bias = look - rate * gradient, look_bias - rate * error.mean()
        following = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        ahead = (momentum - 1) / following
        look, look_bias = new + ahead * (new - weights), new_bias + ahead * (new_bias - bias)
        weights, bias, momentum = new, new_bias, following
    return scale * weights, float(bias)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    groups: Sequence[Sequence[str]] = IDENTITY_GROUPS,
    rows: int = TRAINING_ROWS,
    ridge: float = RIDGE,
    penalty: float = SWAP_PENALTY,
) -> ToxicityModel:
    """Learn from ``labels`` (doc_id, toxic) of documents outside the held-out part.

    A document that several labels name is toxic if one says so; labels that are null or not 0
    or 1, or whose document is missing, teach nothing. Without labels of both kinds the model
    is a constant, the share of label 1 (0 without any).
    """
    sample = training_sample(docs, labels, rows)
    features = informative_features(sample)
    if not features:
        share = sample.agg(F.avg("toxic")).first()[0] or 0.0
        odds = float(np.clip(np.log(max(share, 1e-9) / max(1 - share, 1e-9)), -20, 20))
        return ToxicityModel((), (), odds)
    swaps = swap_table(groups)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = Extractor(features)
        for batch in batches:
            out = []
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                words = words_of(text.as_py())
                present = extract.of_words(words)
                other = extract.of_words(swapped(words, swaps))
                moved = sorted(set(present) ^ set(other))
                signs = [1.0 if f in set(other) else -1.0 for f in moved]
                out.append({"toxic": toxic, "present": present, "moved": moved, "sign": signs})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema(
        [
            ("toxic", pa.int32()),
            ("present", pa.list_(pa.int32())),
            ("moved", pa.list_(pa.int32())),
            ("sign", pa.list_(pa.float64())),
        ]
    )
    fields = "toxic int, present array<int>, moved array<int>, sign array<double>"
    found = sample.mapInArrow(pairs, fields).toArrow()
    weights, intercept = _fit(found, len(features), ridge, penalty)
    return ToxicityModel(tuple(features), tuple(weights.tolist()), intercept)


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD
) -> DataFrame:
    """``doc``, a struct of all columns of ``docs`` whatever their names, ``score`` (0 to 1) and
    ``toxic`` (score at the threshold or above). The score reads the whole text and nothing else;
    null counts as empty, and an empty text scores what the intercept says. Rows stay as they
    are, repeated ones included; no rows give none.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract, weights = Extractor(model.features), np.array(model.weights)
        for batch in batches:
            z = [
                model.intercept + float(weights[extract.of_words(words_of(t.as_py()))].sum())
                for t in batch.column("text")
            ]
            score = 1 / (1 + np.exp(-np.clip(np.array(z), -700, 700)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(score, pa.float64())], names=["doc", "score"]
            )

    packed = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = docs.select(packed, F.col("text"))
    fields = StructType([rows.schema["doc"], StructField("score", DoubleType())])
    return rows.mapInArrow(scored, fields).withColumn("toxic", F.col("score") >= threshold)


def toxicity_scores(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """Per document ``doc_id``, ``held_out``, ``score`` and ``predicted`` (0 or 1).

    Every row is scored, repeated ones too; null texts count as empty, and a null doc_id is no
    row to learn from. Without labelled rows of both kinds all scores are equal. An empty table
    gives no rows. Other columns are neither read nor returned.
    """
    model = fit_toxicity(docs, labels, **settings)
    modulus, held_out = HELD_OUT
    marked = docs.select("doc_id", "text").withColumn(
        "held_out", crc_remainder("doc_id", modulus) == held_out
    )
    return score_toxicity(marked, model).select(
        "doc.doc_id", "doc.held_out", "score", F.col("toxic").cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that the model does not reject, with their own columns."""
    kept = score_toxicity(docs, model, threshold).where(~F.col("toxic"))
    return kept.select(*[F.col(f"doc.`{c}`") for c in docs.columns])
