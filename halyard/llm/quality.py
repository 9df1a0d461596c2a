"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document; the ledger stores the measurements and one bit per
failed rule. A policy is a version with the bits that reject a document, so a new policy, or an
ablation that leaves a rule out, is bitwise work on the ledger and never reads a text again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: symbols, and the limits of the rules --------------------------
SYMBOLS = "#*$%&|<>"
FEWEST_WORDS = 10
REPEATED_PERCENT = 20
WINDOW = 5
SYMBOL_PERCENT = 10
DUPLICATE_LINE_PERCENT = 30
CAPITAL_PERCENT = 50
EXCLAMATION_PERCENT = 30
WORD_CHARS = (2, 20)
# --- end of fixed values ----------------------------------------------------

WHITE = b" \t\n\v\f\r"
CAPITALS, SMALL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_exclamations", "n_capitals", "n_letters",
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside a window of words that occurs twice or more, its first place included."""
    n = len(words)
    if n <= window:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    if len(numbers) == n:
        return 0
    grams, kinds = ids, len(numbers)
    for width in range(2, window + 1):  # ranks of windows, one word longer each time
        paired = grams[: n - width + 1] * np.int64(len(numbers)) + ids[width - 1 :]
        _, grams = np.unique(paired, return_inverse=True)
        kinds = int(grams.max()) + 1
        if kinds == len(grams):
            return 0
    again = np.bincount(grams, minlength=kinds)[grams] > 1
    covered = np.zeros(n, bool)
    for shift in range(window):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The ledger's measurements of one text, in the order of ``MEASURES``."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    lines = [line for line in text.split("\n") if line.encode().split()]
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    letters = capitals + len(raw) - len(raw.translate(None, SMALL))
    return (
        len(words),
        len(text) - sum(raw.count(c) for c in WHITE),
        sum(text.count(c) for c in SYMBOLS),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
        sum(1 for w in words if w.endswith(b"!!")),
        capitals,
        letters,
    )


@dataclass(frozen=True)
class Rule:
    """A bit of the ledger and the condition, on measurements, under which it is set."""

    bit: int
    name: str
    fails: Column

    @property
    def mask(self) -> int:
        return 1 << self.bit


@dataclass(frozen=True)
class Policy:
    """A version with the rules that reject a document."""

    version: str
    rules: tuple[str, ...]


def rules() -> tuple[Rule, ...]:
    """All rules. A rule keeps its bit for ever; a new rule takes the next one."""
    c = F.col
    conditions = (
        ("few_words", c("n_words") < FEWEST_WORDS),
        ("repeated_words", 100 * c("n_repeat_words") > REPEATED_PERCENT * c("n_words")),
        ("symbols", 100 * c("n_symbols") > SYMBOL_PERCENT * c("n_words")),
        ("duplicate_lines", 100 * c("n_dup_lines") > DUPLICATE_LINE_PERCENT * c("n_lines")),
        ("capitals", 100 * c("n_capitals") > CAPITAL_PERCENT * c("n_letters")),
        ("exclamations", 100 * c("n_exclamations") > EXCLAMATION_PERCENT * c("n_words")),
        ("short_words", c("word_chars") < WORD_CHARS[0] * c("n_words")),
        ("long_words", c("word_chars") > WORD_CHARS[1] * c("n_words")),
    )
    return tuple(Rule(bit, name, fails) for bit, (name, fails) in enumerate(conditions))


BASE = Policy("base", ("few_words", "repeated_words"))
STANDARD = Policy(
    "2024-1",
    (*BASE.rules, "symbols", "duplicate_lines", "capitals", "exclamations", "short_words", "long_words"),
)


def policy_mask(policy: Policy) -> int:
    masks = {r.name: r.mask for r in rules()}
    unknown = set(policy.rules) - set(masks)
    if unknown:
        raise ValueError(f"policy {policy.version} names unknown rules: {sorted(unknown)}")
    return sum(masks[name] for name in set(policy.rules))


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, the measurements and ``fail_bits``, the bits of the
    rules that it fails.

    A null text counts as empty: no words, so it fails ``few_words`` alone. Repeated rows each
    have their row; a null doc_id stays null; an empty table has an empty ledger; other columns
    are not read. A text is measured whole, in memory that grows with that text only.
    """
    read = docs.select("doc_id", "text")
    schema = pa.schema(
        [("doc_id", pa.int64()), *[(name, pa.int64()) for name in MEASURES]]
    )

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(text.as_py()) for text in batch.column("text")]
            columns = zip(*found) if found else ([] for _ in MEASURES)
            arrays = [batch.column("doc_id").cast(pa.int64())]
            arrays += [pa.array(values, pa.int64()) for values in columns]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    fields = ", ".join(f"{name} bigint" for name in ("doc_id", *MEASURES))
    bits = F.lit(0).cast("long")
    for rule in rules():
        failed = F.when(rule.fails, F.lit(rule.mask)).otherwise(F.lit(0))
        bits = bits.bitwiseOR(failed.cast("long"))
    return read.mapInArrow(measured, fields).withColumn("fail_bits", bits)


def apply_policy(book: DataFrame, policy: Policy, base: Policy = BASE) -> DataFrame:
    """Add ``base_failed``, ``kept`` and ``policy`` to a ledger. What the base rejects is never
    kept, whatever the policy."""
    bits = F.col("fail_bits")
    base_failed = bits.bitwiseAND(F.lit(policy_mask(base)).cast("long")) != 0
    failed = bits.bitwiseAND(F.lit(policy_mask(policy)).cast("long")) != 0
    return book.withColumns(
        {
            "base_failed": base_failed,
            "kept": ~base_failed & ~failed,
            "policy": F.lit(policy.version),
        }
    )


def ablations(book: DataFrame, policy: Policy) -> DataFrame:
    """What each rule of a policy costs: ``rule``, ``n_failed`` (documents that fail it),
    ``n_only`` (documents that the policy would keep without it) and ``kept_without``.

    Documents are counted per combination of failed bits, of which there are at most
    2 ** rules; everything else is arithmetic on those counts.
    """
    mask = policy_mask(policy)
    combined = book.groupBy(
        F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")
    ).agg(F.count(F.lit(1)).alias("n"))
    used = [r for r in rules() if r.mask & mask]
    sums = combined.agg(
        F.sum(F.when(F.col("bits") == 0, F.col("n")).otherwise(0)).alias("kept"),
        *[
            F.sum(F.when(F.col("bits").bitwiseAND(F.lit(r.mask)) != 0, F.col("n")).otherwise(0)).alias(f"failed_{r.bit}")
            for r in used
        ],
        *[
            F.sum(F.when(F.col("bits") == r.mask, F.col("n")).otherwise(0)).alias(f"only_{r.bit}")
            for r in used
        ],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.coalesce(F.col(f"failed_{r.bit}"), F.lit(0)).alias("n_failed"),
                F.coalesce(F.col(f"only_{r.bit}"), F.lit(0)).alias("n_only"),
                F.coalesce(F.col("kept") + F.col(f"only_{r.bit}"), F.lit(0)).alias("kept_without"),
            )
            for r in used
        ]
    )
    return sums.select(F.inline(rows))
