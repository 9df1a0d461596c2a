"""Spelling variants: words within one edit, and the frequent word that each may stand for.

Two words that are one edit apart, of lengths l and l or l + 1, agree in front of the edit and behind
it. So words are filed by what they have outside a stretch that may hold the edit: first the
last half of l code points, or the first half. Words that agree there come together in one sorted
list. Where a list gets too long, its stretch is halved again, and again, until so few code
points are open that the alphabet bounds the list: no list is ever cut off.

A list is scanned as a sorted vocabulary. For each of its words the rows of an edit matrix are
kept for the word scanned last, of which only the band of three cells beside the diagonal can be
at most one. The next word shares a prefix with the last (their LCP), whose rows stand; only rows
behind it are computed. Where a row has no cell of at most one, all following words that share
that much of a prefix are skipped.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halyard.llm.tables import partitions_for, stored

# --- fixed values: words, slips and thresholds --------------------------------------------
SLIP_EVERY = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
TIMES = 5
# --- end of fixed values ----------------------------------------------------

#: Words of a list from which its stretch is halved.
CROWDED = 512
#: Different words that a task holds before it hands on their counts.
HELD = 1 << 18
FAR = 2  # more edits than one


def runs_of(text: str | None, least: int) -> list[str]:
    """Runs of at least ``least`` letters (A-Z and the range from U+00C0 to U+00FF), with A-Z alone
    lower-cased."""
    lowered = (text or "").encode().lower().decode()
    return re.findall(f"[a-zÀ-ÿ]{{{least},}}", lowered)


def slipped(doc_key: str, run: str) -> str:
    """The run, or what is left of it where the crc32 of document and run says that a letter is lost."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{doc_key}:".encode()))
    if h % SLIP_EVERY:
        return run
    lost = h % len(run)
    return run[:lost] + run[lost + 1 :]


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts, for words of at least ``least_length``."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def batch_of(counts: Counter) -> pa.RecordBatch:
        arrays = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc_key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
                start = zlib.crc32(f"{doc_key}:".encode())
                for run, n in Counter(runs_of(text.as_py(), least_length)).items():
                    if zlib.crc32(run.encode(), start) % SLIP_EVERY:
                        counts[run] += n
                    elif len(word := slipped(doc_key, run)) >= least_length:
                        counts[word] += n
                if len(counts) >= HELD:
                    yield batch_of(counts)
                    counts.clear()
        yield batch_of(counts)

    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key")
    parts = docs.select(key, F.col("text").cast("string").alias("text")).mapInArrow(counted, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _filed(rows: DataFrame) -> DataFrame:
    """``key`` for rows with ``word``, ``l`` and a stretch from ``s`` to ``e`` of l code points: what
    the word has before the stretch and behind it."""
    before = F.substring("word", F.lit(1), F.col("s"))
    behind = F.when(F.col("e") < F.col("l"), F.expr("substring(word, e - l)")).otherwise(F.lit(""))
    return rows.withColumn("key", F.xxhash64("l", "s", "e", before, behind))


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice: the edit lies in the last or in the first half of the stretch."""
    middle = F.floor((F.col("s") + F.col("e")) / 2).cast("int")
    halves = F.array(
        F.struct(middle.alias("s"), F.col("e").alias("e")),
        F.struct(F.col("s").alias("s"), middle.alias("e")),
    )
    return _filed(rows.select("word", "l", F.inline(halves)))


def _lists(words: DataFrame, crowded: int) -> DataFrame:
    """``key`` and ``word``: the lists in which every two words one edit apart meet at least once.

    Only keys with several words of which one has l code points are lists. Lists of more than
    ``crowded`` words are filed again with half the stretch, while that is longer than one."""
    length = F.char_length("word")
    starts = words.select("word", F.explode(F.array(length, length - 1)).alias("l"))
    rows = _halved(starts.select("word", "l", F.lit(0).alias("s"), F.col("l").alias("e")))
    done = []
    while True:
        rows = stored(rows, "spelling-rows")
        shared = rows.groupBy("key").agg(
            F.count(F.lit(1)).alias("many"),
            F.max(F.char_length("word") == F.col("l")).alias("whole"),
            F.max(F.col("e") - F.col("s")).alias("open"),
        )
        shared = stored(shared.where("whole AND many > 1"), "spelling-keys")
        full = (F.col("many") > crowded) & (F.col("open") > 1)
        done.append(rows.join(shared.where(~full), "key").select("key", "word"))
        longer = shared.where(full).select("key")
        if longer.isEmpty():
            break
        rows = _halved(rows.join(longer, "key"))
    lists = done[0]
    for more in done[1:]:
        lists = lists.union(more)
    return lists


def _lcp(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _next_row(row: tuple[int, int, int], query: str, depth: int, letter: str) -> tuple[int, int, int]:
    """The row of the edit matrix at ``depth`` letters of a scanned word, as the cells for
    ``depth`` - 1, ``depth`` and ``depth`` + 1 letters of the query, from the row before. Cells
    beyond one edit, and those outside the query, are ``FAR``."""
    low, mid, high = row  # the query's first depth - 2, depth - 1 and depth letters
    n = len(query)
    left = right = same = FAR
    if 1 <= depth <= n + 1:  # the cell for depth - 1 letters of the query
        same_letter = depth >= 2 and query[depth - 2] == letter
        left = min(low + (not same_letter) if depth >= 2 else FAR, mid + 1)
    if depth <= n:
        same = min(mid + (query[depth - 1] != letter), left + 1, high + 1)
    if depth + 1 <= n:
        right = min(high + (query[depth] != letter), same + 1)
    return min(left, FAR), min(same, FAR), min(right, FAR)


def near_in_list(words: list[str]) -> Iterator[tuple[str, str]]:
    """Ordered pairs of a sorted list without repeats that are one edit apart."""
    shared = [0, *(_lcp(a, b) for a, b in zip(words, words[1:]))]
    for query in words:
        n = len(query)
        rows = [(FAR, 0, 1 if n else FAR)]  # after no letters: 0, and 1 for one letter of the query
        valid = 0  # letters of the last scanned word whose rows stand
        dead = None  # letters of a prefix that is beyond one edit
        for place, word in enumerate(words):
            depth = min(valid, shared[place])
            valid = depth
            if dead is not None:
                if shared[place] >= dead:
                    continue
                dead = None
            del rows[depth + 1 :]
            m = len(word)
            if abs(m - n) > 1 or word == query:
                continue
            while depth < m:
                row = _next_row(rows[depth], query, depth + 1, word[depth])
                rows.append(row)
                depth += 1
                if min(row) > 1:
                    dead = depth
                    break
            valid = depth
            if dead is None and rows[m][n - m + 1] == 1:
                yield query, word


def near_pairs(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Ordered pairs ``word``, ``other`` of ``words`` (word, distinct) that are one inserted, deleted
    or replaced code point apart."""
    schema = pa.schema([("word", pa.string()), ("other", pa.string())])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, found = None, [], []
        for batch in batches:
            for own, word in zip(batch.column("key").to_pylist(), batch.column("word").to_pylist()):
                if own != key:
                    found += near_in_list(held) if len(held) > 1 else ()
                    key, held = own, []
                    if len(found) >= HELD:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found)], schema=schema)
                        found = []
                held.append(word)
        found += near_in_list(held) if len(held) > 1 else ()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found)], schema=schema)

    parts = partitions_for(words.sparkSession)
    lists = _lists(words, crowded).repartition(parts, "key").sortWithinPartitions("key", "word")
    return lists.mapInArrow(scanned, "word string, other string").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` from ``word`` and ``form``: pointers are doubled until all stand still.
    Forms grow in number of occurrences, so there is no circle, and a few rounds are enough."""
    current = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = current.join(further, "root", "left")
        longer = stored(
            moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "spelling-roots",
        )
        current = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return current


def spelling_variants(
    docs: DataFrame,
    *,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
    crowded: int = CROWDED,
) -> DataFrame:
    """One row per word of at least ``least_length`` code points that occurs at least
    ``least_count`` times in ``docs`` (doc_id, text): ``word``, its occurrences ``n``, ``form``
    (of the words one edit apart that with most occurrences, ties to the first by code points,
    if it has at least ``times`` as many as the word; else null), ``form_n``, ``root`` (where
    forms lead to in the end, the word itself without one) and ``n_near`` (words one edit apart).

    Null and empty texts have no words, texts of any length are read whole, and no documents
    give no rows. Repeated rows count again. A null doc_id counts as the empty text where slips
    are drawn. Other columns are not read.
    """
    counts = word_counts(docs, least_length).where(F.col("n") >= least_count)
    words = stored(counts, "spelling-words")
    pairs = stored(near_pairs(words.select("word"), crowded), "spelling-near")
    others = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    ranked = F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))
    best = pairs.join(others, "other").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(ranked).alias("best"))
    taken = -F.col("best.n") >= F.lit(times) * F.col("n")
    formed = stored(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(taken, F.col("best.word")).alias("form"),
            F.when(taken, -F.col("best.n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n"
    )
