"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from halyard.llm import decontamination, licences, mixing, search, spelling, warc


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def mixing_sql(seed: int = 17) -> str:
    return f"""
WITH RECURSIVE counts AS (SELECT source, count(*) AS n, 1.0::DOUBLE AS weight FROM documents GROUP BY source),
rates AS (SELECT source, weight / (SELECT sum(weight) FROM counts) * (SELECT sum(n) FROM counts)::DOUBLE / n AS rate
  FROM counts),
steps AS (SELECT source, greatest(1, ceil(rate / {mixing.MAX_STEP}::DOUBLE))::BIGINT AS steps,
  rate / greatest(1, ceil(rate / {mixing.MAX_STEP}::DOUBLE)) AS step FROM rates),
cdf AS (SELECT source, step, 0 AS k, exp(-step) AS p, exp(-step) AS c FROM steps
  UNION ALL SELECT source, step, k + 1, p * step / (k + 1), c + p * step / (k + 1) FROM cdf
  WHERE k < ceil(step + 12::DOUBLE * sqrt(step) + 24::DOUBLE)),
tables AS (SELECT source, list(c ORDER BY k) AS cs FROM cdf GROUP BY source),
draws AS (SELECT doc_id, text, lang, source, n_chars, unnest(range(1, steps + 1)) AS i
  FROM documents JOIN steps USING (source)),
counted AS (SELECT doc_id, text, lang, source, n_chars, sum(len(list_filter(cs, lambda c: c <=
  ('0x' || substr(md5('{seed}:' || doc_id || ':' || i), 1, {mixing.HASH_DIGITS}))::BIGINT::DOUBLE
  / {16**mixing.HASH_DIGITS}::DOUBLE)))::BIGINT AS copies
  FROM draws JOIN tables USING (source) GROUP BY doc_id, text, lang, source, n_chars)
SELECT doc_id, text, lang, source, n_chars, unnest(range(1, copies + 1))::BIGINT AS copy FROM counted WHERE copies > 0"""


def licence_sql() -> str:
    pairs = " ".join(
        f"WHEN {_text(s)} THEN {_text(i)}" for i, s in licences.SENTENCES.items()
    )
    longer = licences.contained_in(licences.RULES)

    def has(p: str) -> str:
        return f"contains(seq, {_text(p)})"

    names = ", ".join(
        f"CASE WHEN {' AND '.join([has(p), *[f'NOT {has(q)}' for q in longer[p]]])} THEN {_text(name)} END"
        for name, ids in licences.RULES
        for p in [licences.pattern(ids)]
    )
    return f"""
WITH sentences AS (SELECT doc_id, list_filter(list_transform(
    string_split_regex(translate(coalesce(text, ''), '{licences.UPPER}', '{licences.LOWER}'), '{licences.BOUNDARY}'),
    lambda s: CASE trim(regexp_replace(s, '{licences.NOT_WORD}', ' ', 'g')) {pairs} END),
    lambda i: i IS NOT NULL) AS ids FROM documents),
sequences AS (SELECT doc_id, ids, ',' || array_to_string(ids, ',') || ',' AS seq FROM sentences),
named AS (SELECT doc_id, ids, list_filter([{names}], lambda n: n IS NOT NULL) AS names FROM sequences)
SELECT doc_id, len(ids)::BIGINT AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
  array_to_string(list_filter(names, lambda n, i: list_position(names, n) = i), ',') AS licences FROM named"""


def warc_sql() -> str:
    letters = " || ".join(
        f"substr('{warc.BASE32}', (((('0x' || substr(digits, {10 * block + 1}, 10))::BIGINT >> {35 - 5 * place}) & 31) + 1)::BIGINT, 1)"
        for block in range(4)
        for place in range(8)
    )
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digits FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS keeper FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {letters} AS payload_digest,
  CASE WHEN keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN keeper <> page_id THEN keeper END AS refers_to FROM k"""


TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM s)
SELECT * FROM r WHERE rank <= 10"""


def _crc32_sql(digits: str) -> str:
    """The crc32 of bytes given as hex digits: a shift register, a bit at a time."""
    bits = f"list_transform(range(0, 4 * length({digits})), lambda i: (('0x' || substr({digits}, 2 * (i // 8) + 1, 2))::BIGINT >> (i % 8)) & 1)"
    step = "xor(c >> 1, 3988292384 * (xor(c, b) & 1))"
    return f"xor(list_reduce({bits}, lambda c, b: {step}, 4294967295), 4294967295)"


def spelling_sql() -> str:
    run = "[A-Za-z\\x{C0}-\\x{FF}]+"
    lower = f"translate(coalesce(text, ''), '{licences.UPPER}', '{licences.LOWER}')"
    least, many, times = spelling.LEAST_LENGTH, spelling.LEAST_COUNT, spelling.TIMES
    crc = _crc32_sql("digits")
    return f"""
WITH RECURSIVE runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS key, unnest(regexp_extract_all({lower}, '{run}')) AS run
  FROM documents),
counted AS (SELECT key, run, count(*) AS n, lower(hex(encode(key || ':' || run))) AS digits FROM runs
  WHERE length(run) >= {least} GROUP BY key, run),
hashed AS (SELECT run, n, {crc} AS h FROM counted),
slipped AS (SELECT CASE WHEN h % {spelling.SLIP_EVERY} <> 0 THEN run
  ELSE left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= {least} GROUP BY word
  HAVING sum(n) >= {many}),
cut AS MATERIALIZED (SELECT word, n, i, left(word, i - 1) AS before, substr(word, i + 1) AS behind
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (i, before, behind) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.before || a.behind = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.before || a.behind = b.word),
placed AS (SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
  row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place FROM near),
formed AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
  CASE WHEN other_n >= {times} * w.n THEN other END AS form, CASE WHEN other_n >= {times} * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN placed p ON w.word = p.word AND place = 1),
paths AS (SELECT word, word AS root, form AS next FROM formed
  UNION ALL SELECT p.word, f.word, f.form FROM paths p JOIN formed f ON p.next = f.word)
SELECT f.word, f.n, f.form, p.root, f.n_near, f.form_n FROM formed f JOIN paths p ON p.word = f.word AND p.next IS NULL"""


def _words_sql(table: str, key: str) -> str:
    """``r`` (a number per row), the key and ``w``, the words of the text."""
    lower = f"translate(coalesce(text, ''), '{licences.UPPER}', '{licences.LOWER}')"
    word = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    return f"SELECT row_number() OVER () AS r, {key}, regexp_extract_all({lower}, '{word}') AS w FROM {table}"


def search_sql() -> str:
    scale = search.SCALE
    return f"""
WITH d AS ({_words_sql("documents", "doc_id")}),
q AS ({_words_sql("benchmark", "item_id")}),
lengths AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM lengths),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
  FROM (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term), totals),
sizes AS (SELECT r, doc_id, 100 - 25 + ((25 * n * docs) // words) AS m FROM lengths, totals),
wanted AS (SELECT r AS item, item_id, term, count(*)::BIGINT AS times
  FROM (SELECT r, item_id, unnest(w) AS term FROM q) GROUP BY r, item_id, term),
scored AS (SELECT item, item_id, r, doc_id,
  sum(times * weight * (({scale} * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (r) GROUP BY item, item_id, r, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= {search.BEST}"""


def contamination_sql() -> str:
    size = f"least({decontamination.WINDOW}, len(w))"
    return f"""
WITH d AS MATERIALIZED ({_words_sql("documents", "doc_id")}),
b AS ({_words_sql("benchmark", "coalesce(item_id::VARCHAR, '') AS item")}),
windows AS MATERIALIZED (SELECT DISTINCT item, size, w[i:i + size - 1] AS g
  FROM (SELECT item, w, {size} AS size, unnest(range(1, len(w) - {size} + 2)) AS i FROM b WHERE len(w) > 0)),
grams AS (SELECT r, p, size, w[p:p + size - 1] AS g
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, (SELECT DISTINCT size FROM windows))),
hits AS MATERIALIZED (SELECT DISTINCT r, p, size, item FROM grams JOIN windows USING (size, g)),
covered AS (SELECT r, count(DISTINCT q)::BIGINT AS n_hit FROM (SELECT r, unnest(range(p, p + size)) AS q FROM hits) GROUP BY r),
items AS (SELECT r, list_sort(list(DISTINCT item)) AS ids FROM hits GROUP BY r),
asked AS MATERIALIZED (SELECT row_number() OVER () AS k, item, size, list_distinct(g) AS terms FROM windows),
occurrences AS (SELECT r, k, p, size, need, term FROM
  (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS term FROM d)
  JOIN (SELECT k, size, len(terms) AS need, unnest(terms) AS term FROM asked) USING (term)),
whole AS MATERIALIZED (SELECT r, k, p, size, need, term FROM occurrences
  QUALIFY len(list_distinct(list(term) OVER (PARTITION BY r, k))) = need),
stretches AS (SELECT DISTINCT r, k FROM (SELECT r, k, need, len(list_distinct(list(term) OVER
  (PARTITION BY r, k ORDER BY p RANGE BETWEEN CURRENT ROW AND {decontamination.SLACK - 1} + size FOLLOWING))) AS held FROM whole)
  WHERE held = need),
near AS (SELECT r, count(DISTINCT item)::BIGINT AS n_near_items FROM stretches JOIN asked USING (k)
  ANTI JOIN hits USING (r, item) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
  sha256(array_to_string(coalesce(ids, []), ',')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  coalesce(n_near_items, 0) AS n_near_items
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r) LEFT JOIN near USING (r)"""


ORACLES = {
    "op2_top_k": TOP_K_SQL,
    "op5_mix_sources": mixing_sql(),
    "op7_licence_scan": licence_sql(),
    "op8_warc_archive": warc_sql(),
    "op11_spelling_variants": spelling_sql(),
    "op12_ranked_search": search_sql(),
    "op13_decontamination": contamination_sql(),
}
