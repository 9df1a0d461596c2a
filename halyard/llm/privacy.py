"""Personal data and the terms that disclose it.

Patterns find protected entities: e-mail addresses, IP addresses, card and phone numbers. Over the
whole corpus, documents are then counted that hold an entity, a term, or both, wherever in the text
they stand. The share of the entity's information that a term gives away is their pointwise mutual
information over the information content of the entity:

    disclosure = log(N * p / n_e) / log(N / n_e)

where p, the chance of the entity given the term, is the lower confidence bound (Wilson's) of the share of
the term's places that are in a text with the entity. Copies of one passage around the entity are one
place. So every pair gets a decision, and little evidence is little disclosure: a rare term that is only ever seen once,
beside an entity as rare, reaches the generalisation threshold in a corpus of some thousand documents;
the removal threshold needs several different contexts. In texts that mention the entity, terms at or above
the first are replaced by a class name, and those at or above the second removed.

Everything is column expressions, joins and aggregations; no Python runs on rows. Expressions on
a text read it a bounded number of times, however many matches it has: places are running sums
taken in two levels, and parts of a text are cut out of blocks of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.llm.tables import stored

# --- fixed values: kinds, in order, and what they look like --------------------------
KINDS = ("email", "ip", "card", "phone")
# Possessive repeats where the greedy ones never give back, and starts only where a run of
# characters starts or a match has ended: the same matches, in time linear in the text.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CARD_DIGITS, PHONE_DIGITS, LARGEST_PART = (16, 19), (8, 15), 255
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
# --- end of fixed values ----------------------------------------------------

TERM = "term"
TERM_MASK = "[TERM]"
#: What a text must hold for a kind to occur at all; cheap to see, so most texts skip the rest.
HINTS = {
    "email": r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){15}",
    "phone": r"\+[0-9]",
}
WORD = r"(?<![\p{L}\p{N}@._%+-])\p{L}{2,}+(?![\p{N}@])"
#: Characters to either side of an entity whose terms tell the passage that it is in. The terms that are
#: judged are those of the whole text.
NEAR = 120
GENERALISE_AT, REMOVE_AT = 0.8, 0.95
#: Standard deviations of the confidence bound: 95 % to either side.
CONFIDENCE = 1.96
#: Code points of a block of a text.
BLOCK = 1 << 12

_SPAN = "struct<start:bigint,end:bigint,value:string>"
_PLACED = "array<struct<term:string,start:bigint,end:bigint>>"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once; what a lambda names otherwise it computes each time."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _whole(value: Column) -> Column:
    return value.cast("long")


def _before(numbers: Column, combined: Callable[[Column, Column], Column]) -> Column:
    """For each of some longs, those before it combined (0 for none).

    An array grows by copying, so one of n elements would cost its square; in blocks of the
    root of n, and those blocks again in one array, it costs n times the root."""
    nothing = F.array().cast("array<bigint>")
    begin = F.struct(_whole(F.lit(0)).alias("at"), nothing.alias("list"))

    def running(values: Column) -> Column:
        return F.reduce(
            values,
            begin,
            lambda so_far, x: F.struct(
                combined(so_far["at"], x).alias("at"),
                F.array_append(so_far["list"], so_far["at"]).alias("list"),
            ),
        )

    def of_some(values: Column) -> Column:
        side = F.ceil(F.sqrt(F.size(values))).cast("int")
        count = F.ceil(F.size(values) / side).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), count - 1), lambda b: running(F.slice(values, b * side + 1, side))
        )

        def joined(parts: Column) -> Column:
            offsets = running(F.transform(parts, lambda p: p["at"]))["list"]
            shifted = F.zip_with(
                parts, offsets, lambda p, at: F.transform(p["list"], lambda x: combined(at, x))
            )
            return F.flatten(shifted)

        return _bound(blocks, joined)

    return _bound(numbers, lambda xs: F.when(F.size(xs) > 0, of_some(xs)).otherwise(nothing))


def _text_blocks(text: Column) -> Column:
    """A text as an array of blocks of code points. Cutting at a place reads the text up to there, so
    long texts are cut into large blocks first."""

    def cut(value: Column, size: int) -> Column:
        count = F.ceil(F.length(value) / F.lit(size)).cast("int")
        numbers = F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))
        return F.transform(numbers, lambda i: F.substring(value, i * size + 1, F.lit(size)))

    return _bound(text, lambda t: F.flatten(F.transform(cut(t, BLOCK * BLOCK >> 4), lambda part: cut(part, BLOCK))))


def _cut_out(blocks: Column, start: Column, length: Column) -> Column:
    """``length`` code points from ``start`` (from 0) of a text in blocks."""
    first = F.floor(start / BLOCK).cast("int")
    last = F.floor((start + length) / BLOCK).cast("int")
    held = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
    return F.substring(held, (start - first * BLOCK + 1).cast("int"), length.cast("int"))


def located(text: Column, pattern: str) -> Column:
    """Start, end (code points, exclusive) and text of all matches, leftmost and not overlapping.

    Matches and the gaps between them alternate, so starts are running sums of their lengths.
    """

    def placed(found: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda gap: _whole(F.length(gap)))
        steps = F.zip_with(
            F.slice(gaps, F.lit(1), F.size(found)),
            F.transform(found, lambda match: _whole(F.length(match))),
            lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")),
        )

        def spans(held: Column) -> Column:
            through = F.transform(held, lambda step: step["gap"] + step["match"])
            starts = F.zip_with(_before(through, lambda a, x: a + x), held, lambda at, step: at + step["gap"])
            return F.zip_with(
                starts,
                found,
                lambda start, match: F.struct(
                    start.alias("start"), (start + F.length(match)).alias("end"), match.alias("value")
                ),
            )

        return _bound(steps, spans)

    none = F.array().cast(f"array<{_SPAN}>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return _bound(found, lambda f: F.when(F.size(f) > 0, placed(f)).otherwise(none))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        def small(part: Column) -> Column:
            bare = F.regexp_replace(part, "^0+(?=[0-9])", "")
            return F.when(F.length(bare) <= 3, bare.cast("int") <= LARGEST_PART).otherwise(False)

        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        digits = _digits(value)
        fits = F.length(digits).between(*CARD_DIGITS)
        return F.when(fits, F.call_function("luhn_check", digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(*PHONE_DIGITS)
    return F.lit(True)


def _entity(kind: str, value: Column) -> Column:
    """One name for all spellings of an entity."""
    plain = F.lower(value) if kind == "email" else value if kind == "ip" else _digits(value)
    return F.concat(F.lit(f"{kind}:"), plain)


def base_spans(text: Column) -> Column:
    """Array of (kind, start, end, entity), by kind as listed, then by start."""
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,entity:string>>")

    def spans_of(kind: str) -> Column:
        valid = F.filter(located(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))
        spans = F.transform(
            valid,
            lambda s: F.struct(
                F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                _entity(kind, s["value"]).alias("entity"),
            ),
        )
        return F.when(F.rlike(text, F.lit(HINTS[kind])), spans).otherwise(none)

    return F.concat(*[spans_of(kind) for kind in KINDS])


def _terms(text: Column, at: Column, whole: Callable[[Column], Column] | None = None) -> Column:
    """Terms of a text that starts at a place: (term, start, end)."""
    found = located(text, WORD)
    if whole is not None:
        found = F.filter(found, whole)
    return F.transform(
        found,
        lambda s: F.struct(
            F.lower(s["value"]).alias("term"),
            (s["start"] + at).alias("start"),
            (s["end"] + at).alias("end"),
        ),
    )


def _near_terms(blocks: Column, span: Column) -> Column:
    """Terms near a span of a text in blocks; words that the window cuts are left out. They say which
    passage the span is in; the terms that are judged are those of the whole text."""
    left_from = F.greatest(span["start"] - NEAR, F.lit(0).cast("long"))
    left = _cut_out(blocks, left_from, span["start"] - left_from)
    right = _cut_out(blocks, span["end"], F.lit(NEAR + 1))
    before = _terms(left, left_from, lambda s: (s["start"] > 0) | (left_from == 0))
    after = _terms(right, span["end"], lambda s: s["end"] <= NEAR)
    return F.concat(before, after)


def mark_entities(docs: DataFrame, *, keep_rows: bool = False) -> DataFrame:
    """Stored table, a row per document: ``row``, ``doc_id``, ``base`` spans, per span its
    ``mentions`` (entity, hash of the context, terms near it) and, if there are any, the ``places`` of the
    terms of the whole text; with ``keep_rows`` also ``doc``."""
    kept = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if keep_rows else []
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id"), text.alias("text"), *kept,
        base_spans(text).alias("base"),
    )

    def mention(span: Column, near: Column) -> Column:
        words = F.array_join(F.transform(near, lambda t: t["term"]), " ")
        return F.struct(
            span["entity"].alias("entity"), F.xxhash64(words).alias("context"), near.alias("near")
        )

    def mentions(blocks: Column) -> Column:
        return F.transform(
            F.col("base"), lambda s: _bound(_near_terms(blocks, s), lambda near: mention(s, near))
        )

    near = F.when(F.size("base") > 0, _bound(_text_blocks(F.col("text")), mentions))
    none = F.array().cast(f"array<struct<entity:string,context:bigint,near:{_PLACED}>>")
    everywhere = F.when(F.size("base") > 0, _terms(F.col("text"), F.lit(0).cast("long")))
    return stored(
        found.withColumns(
            {
                "mentions": F.coalesce(near, none),
                "places": F.coalesce(everywhere, F.array().cast(_PLACED)),
            }
        ).drop("text"),
        "privacy-marks",
    )


def _all_places() -> Column:
    """Places of terms in a text that mentions an entity; some of those near it come twice."""
    return F.concat("places", F.flatten(F.transform("mentions", lambda m: m["near"])))


def _all_terms() -> Column:
    return F.array_distinct(F.transform(_all_places(), lambda t: t["term"]))


def _with_entity(marks: DataFrame) -> DataFrame:
    """``row``, ``entity`` and ``term``, once each: the terms of the texts that mention an entity."""
    entities = F.array_distinct(F.transform("mentions", lambda m: m["entity"]))
    held = marks.where(F.size("mentions") > 0).select(
        "row", entities.alias("entities"), _all_terms().alias("terms")
    )
    each = held.select("row", "terms", F.explode("entities").alias("entity"))
    return each.select("row", "entity", F.explode("terms").alias("term"))


def _document_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term`` and ``n_t``, the documents of the corpus that hold it, for the terms in ``terms``."""
    words = F.array_distinct(
        F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(WORD), F.lit(0))
    )
    exploded = docs.select(F.explode(words).alias("term")).join(terms, "term", "left_semi")
    return exploded.groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))


def _at_least(hits: Column, tries: Column, z: float = CONFIDENCE) -> Column:
    """Wilson's lower bound of a share of which ``hits`` of ``tries`` were seen."""
    share = hits / tries
    spread = z * F.sqrt(share * (1 - share) / tries + F.lit(z * z) / (4 * tries * tries))
    return (share + F.lit(z * z) / (2 * tries) - spread) / (1 + F.lit(z * z) / tries)


def disclosing_terms(
    docs: DataFrame,
    marks: DataFrame,
    *,
    generalise_at: float = GENERALISE_AT,
    remove_at: float = REMOVE_AT,
) -> DataFrame:
    """``entity``, ``term``, ``disclosure`` and ``removed`` of the pairs at or above a threshold.

    Of the ``n_t`` documents that hold a term, ``n_et`` hold it with the entity, in ``contexts`` different
    passages; the others count as a place each. A term that stands far from every mention in a text is
    one place there, in the passage of one of them."""
    mentions = marks.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    once = F.array_distinct(F.transform("near", lambda t: t["term"]))
    beside = mentions.select("row", "entity", "context", F.explode_outer(once).alias("term"))
    near = beside.where(F.col("term").isNotNull())
    # the terms of a text move once, not once for each of its entities
    passages = beside.groupBy("row", "entity").agg(
        F.min("context").alias("context"), F.collect_set("term").alias("beside")
    )
    whole = marks.where(F.size("mentions") > 0).select("row", _all_terms().alias("terms"))
    far = passages.join(whole, "row").select(
        "row", "entity", "context", F.explode(F.array_except("terms", "beside")).alias("term")
    )
    seen = near.unionByName(far)
    in_context = seen.groupBy("entity", "term", "context").agg(F.count_distinct("row").alias("n"))
    pairs = stored(
        in_context.groupBy("entity", "term").agg(
            F.sum("n").alias("n_et"), F.count(F.lit(1)).alias("contexts")
        ),
        "privacy-pairs",
    )
    held = marks.select(
        F.explode(F.array_distinct(F.transform("mentions", lambda m: m["entity"]))).alias("entity")
    )
    entities = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    terms = pairs.select("term").distinct()
    candidates = pairs.join(_document_counts(docs, terms), "term")
    total = marks.agg(F.count(F.lit(1)).alias("n")).scalar()
    elsewhere = F.greatest(F.col("n_t") - F.col("n_et"), F.lit(0))
    chance = _at_least(F.col("contexts"), F.col("contexts") + elsewhere)
    information = F.log(total / F.col("n_e"))
    mutual = F.log(total * chance / F.col("n_e"))
    disclosure = F.when(information > 0, mutual / information).otherwise(F.lit(0.0))
    scored = candidates.join(stored(entities, "privacy-entities"), "entity")
    return stored(
        scored.select(
            "entity", "term", disclosure.alias("disclosure"), (disclosure >= remove_at).alias("removed")
        ).where(F.col("disclosure") >= min(generalise_at, remove_at)),
        "privacy-disclosures",
    )


def term_spans(marks: DataFrame, disclosures: DataFrame) -> DataFrame:
    """``row`` and ``terms``: per document with any, its terms that disclose an entity which it mentions,
    as spans by start, wherever in the text they stand."""
    found = _with_entity(marks).join(disclosures, ["entity", "term"])
    disclosing = found.groupBy("row", "term").agg(F.max("removed").alias("removed"))
    places = marks.select("row", F.explode(_all_places()).alias("t")).select(
        "row", "t.term", "t.start", "t.end"
    )
    spans = places.join(disclosing, ["row", "term"]).groupBy("row", "start", "end").agg(
        F.max("removed").alias("removed")
    )
    span = F.struct("start", "end", "removed")
    return spans.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("terms"))


def _equal_to(kind: str):
    return lambda other: other == kind


def _joined(spans: Column) -> Column:
    texts = F.transform(
        spans,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(texts, ",")


def _with_terms(marks: DataFrame, disclosures: DataFrame) -> DataFrame:
    """Marks with ``terms``. Only documents that mention an entity are joined."""
    silent = F.size("mentions") == 0
    nothing = F.array().cast("array<struct<start:bigint,end:bigint,removed:boolean>>")
    mentioning = marks.where(~silent).join(term_spans(marks, disclosures), "row", "left")
    spoken = mentioning.withColumn("terms", F.coalesce("terms", nothing))
    return marks.where(silent).withColumn("terms", nothing).unionByName(spoken)


def personal_data(docs: DataFrame, **thresholds: float) -> DataFrame:
    """One row per document: ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``,
    ``base_sha256`` (of the base spans as kind:start:end, by kind as listed, then by start,
    comma-joined), ``spans`` (those and the disclosing terms, likewise) and ``n_term``.

    A null text counts as empty and has no spans. Long texts are searched whole. Repeated rows
    each have their row, a null doc_id stays null, an empty table gives no rows, and other
    columns are not read.
    """
    marks = mark_entities(docs)
    found = _with_terms(marks, disclosing_terms(docs, marks, **thresholds))
    terms = F.transform(
        "terms", lambda t: F.struct(F.lit(TERM).alias("kind"), t["start"].alias("start"), t["end"].alias("end"))
    )
    counts = [
        F.size(F.filter(F.transform("base", lambda s: s["kind"]), same)).cast("long").alias(f"n_{k}")
        for k in KINDS
        for same in [_equal_to(k)]
    ]
    plain = F.transform("base", lambda s: s.dropFields("entity"))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat(plain, terms)).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
    )


def _rewritten(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its mask; of spans that overlap, the one that starts
    first (the longer, if two start together) covers the others' common part."""
    ordered = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["end"].alias("end"), s["mask"].alias("mask")),
        )
    )

    def of_ordered(marked: Column) -> Column:
        covered = _before(F.transform(marked, lambda s: s["end"]), lambda a, x: F.greatest(a, x))
        after = F.zip_with(marked, covered, lambda s, at: F.struct(at.alias("at"), s["start"].alias("start"), s["mask"].alias("mask")))
        parts = F.filter(after, lambda p: p["start"] >= p["at"])
        last = F.array_max(F.transform(marked, lambda s: s["end"]))

        def of_blocks(blocks: Column) -> Column:
            pieces = F.transform(
                parts, lambda p: F.concat(_cut_out(blocks, p["at"], p["start"] - p["at"]), p["mask"])
            )
            return F.concat(F.array_join(pieces, ""), _cut_out(blocks, last, F.length(text) - last))

        return _bound(_text_blocks(text), of_blocks)

    return _bound(ordered, of_ordered)


def sanitise(docs: DataFrame, **thresholds: float) -> DataFrame:
    """The documents with personal data masked, disclosing terms generalised or removed, and
    ``n_chars``, where there is such a column, brought up to date. Texts without either stay as
    they are, null ones included; all rows and columns stay, repeated rows too. An empty table
    stays empty."""
    marks = mark_entities(docs, keep_rows=True)
    found = _with_terms(marks, disclosing_terms(docs, marks, **thresholds))
    masks = F.create_map(*[F.lit(x) for item in MASKS.items() for x in item])
    base = F.transform(
        "base",
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.element_at(masks, s["kind"]).alias("mask")),
    )
    terms = F.transform(
        "terms",
        lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.when(t["removed"], F.lit("")).otherwise(F.lit(TERM_MASK)).alias("mask")),
    )
    spans = F.concat(base, terms)
    text = F.when(F.size(spans) == 0, F.col("doc.text")).otherwise(_rewritten(F.col("doc.text"), spans))
    rewritten = found.withColumn("clean", text)
    columns = {c: F.col(f"doc.`{c}`") for c in docs.columns} | {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(F.size(spans) == 0, F.col("doc.n_chars")).otherwise(
            F.length("clean").cast(kind)
        )
    return rewritten.select(*[columns[c].alias(c) for c in docs.columns])
