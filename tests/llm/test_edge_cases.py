"""Nulls, empty and long texts, repeated rows, ties, empty tables, extra columns with names that
the operators use themselves, for every operator and every stage of the pipeline."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from halyard.llm import (
    components,
    katz,
    licences,
    mixing,
    packing,
    privacy,
    quality,
    simhash,
    topk,
    toxicity,
    warc,
)

LONG = " ".join(f"word{i % 977} filler." for i in range(30_000))
CLASHING = "score double, key string, h bigint, row bigint, kept boolean, fp bigint, place int, doc string, n bigint, label int"
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}"
EXTRA = (0.5, "k", 1, 2, True, 3, 4, "d", 5, 6)
BASIC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def row(doc_id, text, source="s"):
    return (doc_id, text, None, source, len(text) if text is not None else None, *EXTRA)


ROWS = [
    row(1, None), row(2, ""), row(3, " \n\t "), row(4, LONG), row(5, "one two three four five six"),
    row(5, "one two three four five six"), row(None, "one two three four five six", None),
    row(None, None, None), row(7, "mail a@b.c or +1 (988) 555-2485\nLicensed under CC BY-NC 4.0.", "t"),
    row(8, "x"), row(9, "é 😀 ü"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=((1, 0), (4, 0), (5, 1), (7, None), (99, 1))):
    return spark.createDataFrame(list(rows), "doc_id bigint, toxic int")


PER_DOCUMENT = {
    "personal_data": lambda d: privacy.personal_data(d),
    "simhash": lambda d: simhash.near_duplicates(d),
    "quality": lambda d: quality.apply_policy(quality.ledger(d), quality.STANDARD),
    "licences": lambda d: licences.scan_licences(d),
    "toxicity": lambda d: toxicity.toxicity_scores(d, labels(d.sparkSession)),
    "katz": lambda d: katz.score_documents(d),
}


@pytest.mark.parametrize("name", sorted(PER_DOCUMENT))
def test_one_row_per_document_whatever_it_holds(docs, name):
    found = PER_DOCUMENT[name](docs).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in ROWS)


@pytest.mark.parametrize("name", sorted(PER_DOCUMENT))
def test_empty_tables_give_no_rows(nothing, name):
    assert PER_DOCUMENT[name](nothing).collect() == []


def test_null_texts_count_as_empty(docs):
    def by_id(frame):
        return {r["doc_id"]: r for r in frame.collect()}

    spans = by_id(privacy.personal_data(docs))
    assert spans[1]["spans"] == spans[2]["spans"] == ""
    assert (spans[7]["n_email"], spans[7]["n_phone"]) == (1, 1)
    assert by_id(simhash.near_duplicates(docs))[1]["fingerprint"] == "0" * 16
    book = by_id(quality.apply_policy(quality.ledger(docs), quality.STANDARD))
    assert book[1]["n_words"] == 0 and book[1]["base_failed"] and not book[1]["kept"]
    assert by_id(licences.scan_licences(docs))[7]["licences"] == "CC-BY-NC-4.0"
    assert by_id(licences.scan_licences(docs))[1]["licences"] == ""
    scores = by_id(katz.score_documents(docs))
    assert scores[1]["n_tokens"] == 1 and scores[4]["n_tokens"] == 60_001


def test_simhash_groups_share_the_smallest_id(docs):
    found = simhash.near_duplicates(docs).collect()
    assert {r["component_id"] for r in found if r["fingerprint"] == "0" * 16} == {1}
    same = {r["fingerprint"] for r in found if r["doc_id"] == 5}
    assert {r["component_id"] for r in found if r["fingerprint"] in same} == {5}


def test_scores_without_training_rows(spark):
    held_out = [i for i in range(200) if __import__("zlib").crc32(str(i).encode()) % 7 == 2][:4]
    frame = spark.createDataFrame([(i, "a b") for i in held_out], "doc_id bigint, text string")
    for r in katz.score_documents(frame).collect():
        assert (r["train_tokens"], r["n_known"], r["score"], r["base_score"]) == (0, 0, 0.0, 0.0)


def test_packing_keeps_every_token(docs, nothing):
    pieces = packing.pack(docs, 64).collect()
    totals = {}
    for p in pieces:
        totals[p["doc_id"]] = totals.get(p["doc_id"], 0) + p["length"]
    assert totals[1] == totals[2] == 1
    assert sum(totals.values()) == sum(len(packing.encode(r[1] or "")) // 2 + 1 for r in ROWS)
    sequences = Counter()
    for p in pieces:
        sequences[p["sequence_id"]] += p["length"]
    assert all(n == 64 for s, n in sequences.items() if s < max(sequences))
    assert packing.pack(nothing).collect() == []


def test_hilbert_curve_visits_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = packing.hilbert_keys(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
    assert set(steps.tolist()) == {1}


def test_an_extra_column_named_as_the_added_one_gives_way(spark, tmp_path):
    rows = [(i, "t", "s", "caller") for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, Copy string")
    mixed = mixing.mix_sources(frame, with_copy=True)
    mixed.write.parquet(str(tmp_path / "mixed"))
    assert mixed.columns == ["doc_id", "text", "source", "copy"]
    assert {r["copy"] for r in mixed.collect()} <= set(range(1, 20))
    assert mixing.mix_sources(frame).columns == frame.columns


def test_extra_columns_named_as_the_score_stay_with_the_caller(spark, docs):
    frame = docs.selectExpr("*", "'mine' AS __score", "1 AS doc_", "2 AS toxic")
    model = toxicity.fit_toxicity(frame, labels(spark))
    kept = toxicity.without_toxic(frame, model, threshold=2.0)
    assert kept.columns == frame.columns and {r["__score"] for r in kept.collect()} == {"mine"}
    assert kept.count() == len(ROWS)


def test_mixing_counts_follow_poisson_and_weights(spark, docs, nothing):
    assert mixing.mix_sources(nothing).collect() == []
    assert mixing.mix_sources(docs, {"s": 0.0}).collect() == []
    assert mixing.mix_sources(docs, {}).collect() == []
    named = mixing.mix_sources(docs, {"t": 1.0, "elsewhere": 3.0}, total=400)
    assert named.columns == docs.columns
    assert {r["source"] for r in named.collect()} == {"t"}
    many = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("x").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"),
    )
    shares = {"hot": 1.0, "s0": 1.0, "s1": 2.0, "s2": 0.0, "s3": 4.0}
    mixed = mixing.mix_sources(many, shares, total=40_000, with_copy=True)
    counts = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    for source, share in shares.items():
        expected = 40_000 * share / 8
        assert abs(counts.get(source, 0) - expected) <= 5 * math.sqrt(expected)
    again = mixing.mix_sources(many.repartition(7), shares, total=40_000, with_copy=True)
    assert mixed.exceptAll(again).count() == 0
    first = mixed.where("source = 's3'").groupBy("doc_id").agg(F.max("copy").alias("n"))
    rate = 40_000 * 4 / 8 / many.where("source = 's3'").count()
    variance = first.agg(F.var_pop("n")).first()[0]
    assert variance == pytest.approx(rate, rel=0.2)  # a zero count is rare at this rate


def test_mixing_joins_many_sources_with_salt(docs, monkeypatch):
    plain = sorted(map(str, mixing.mix_sources(docs, with_copy=True).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, mixing.mix_sources(docs, with_copy=True).collect())) == plain


VECTORS = [
    (0, [1.0, 0.0], "x"), (100, [0.0, 1.0], "x"), (1, [1.0, 0.0], "x"), (2, [1.0, 0.0], "x"),
    (3, None, "x"), (4, [None, 1.0], "x"), (5, [float("nan"), 1.0], "x"), (6, [float("inf"), 0.0], "x"),
    (7, [-1.0, 0.5], "x"), (None, [1.0, 1.0], "x"), (200, [1.0, 0.0, 2.0], "x"), (8, [0.0, 0.0, 1.0], "x"), (1, [1.0, 0.0], "x"),
]


def test_top_k_with_ties_gaps_and_other_lengths(spark):
    frame = spark.createDataFrame(VECTORS, "vec_id bigint, embedding array<float>, rank string").repartition(3)
    found = topk.top_k(frame, F.col("vec_id") % 100 == 0, 2, queries=1, candidates=2).collect()
    by_query = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by_query.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    one = 1024 * 1024
    assert by_query == {0: [(1, one), (2, one)], 100: [(7, one // 2), (0, 0)], 200: [(8, 2 * one)]}
    assert topk.top_k(frame.where("false"), F.lit(True)).collect() == []
    assert topk.top_k(frame, F.lit(False)).collect() == []


def _jobs(spark, action) -> int:
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "counted")
    before = len(tracker.getJobIdsForGroup("counted"))
    action()
    return len(tracker.getJobIdsForGroup("counted")) - before


def test_top_k_in_cells_equals_brute_force(spark):
    rng = np.random.default_rng(12)
    values = np.floor(rng.normal(size=(300, 5)) * 3) / 1024
    values[40:70] = values[40]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    whole = np.floor(values * 1024).astype(int)
    jobs = {}
    for every, sizes in ((100, (2, 50)), (3, (7, 50))):
        found = []
        ask = F.col("vec_id") % every == 0
        jobs[every] = _jobs(
            spark, lambda: found.extend(topk.top_k(frame, ask, queries=sizes[0], candidates=sizes[1]).collect())
        )
        ours = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found}
        wanted = set()
        for q in range(0, 300, every):
            best = sorted((-int(whole[q] @ whole[c]), c) for c in range(300) if c != q)[:10]
            wanted |= {(q, place + 1, c, -score) for place, (score, c) in enumerate(best)}
        assert ours == wanted
    assert abs(jobs[3] - jobs[100]) <= 3  # 100 queries in 15 blocks, or 3 in 2


def test_top_k_with_large_components_is_exact():
    values = np.array([[2.0**40 + 1, 3.0]])
    assert topk.scores(values, np.array([[5.0, 2.0**21]]))[0, 0] == 5 * (2**40 + 1) + 3 * 2**21


PAGES = [
    (1, "http://a/\r\nWARC-Type: x", "same"), (2, "http://b/", "same"), (3, None, None), (4, "u", ""),
    (5, "u", "é😀"), (5, "u", "é😀"), (None, "u", "alone"), (None, "u", "same"), (6, "u", LONG),
]


def test_archive_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(
        [(*p, "z") for p in PAGES], "page_id bigint, url string, html string, address string"
    )
    path = warc.write_archive(pages, str(tmp_path / "archive"))
    index = warc.read_index(spark, path).collect()
    assert Counter(r["page_id"] for r in index) == Counter(p[0] for p in PAGES)
    kinds = {(r["page_id"], r["record_type"], r["refers_to"]) for r in index}
    assert {(1, "revisit", 2), (2, "response", None), (None, "revisit", 2), (3, "revisit", 4)} <= kinds
    assert {(5, "response", None), (None, "response", None)} <= kinds
    payloads = spark.read.parquet(f"{path}/payloads")
    assert payloads.count() == len({p[2] or "" for p in PAGES})
    records = warc.read_records(spark, path).collect()
    assert Counter((r["page_id"], r["html"]) for r in records) == Counter((p[0], p[2] or "") for p in PAGES)
    for r in records:
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert rest.endswith(b"\r\n\r\n")
        assert len(rest) - 4 == int(fields[b"Content-Length"])
        assert head.startswith(b"WARC/1.1\r\n")
    odd = [(1, f"http://a/{sep}X-Page-Id: 7{sep}WARC-Type: revisit", "x") for sep in ("\u2028", "\x85", "\u2029", "\x0b")]
    odd = spark.createDataFrame([(i, *p[1:]) for i, p in enumerate(odd)], "page_id bigint, url string, html string")
    strange = warc.write_archive(odd, str(tmp_path / "odd"))
    named = {r["page_id"]: r for r in warc.read_headers(spark, strange).collect()}
    assert {(i, r["url"]) for i, r in named.items()} == {(r["page_id"], r["url"]) for r in odd.collect()}
    assert {r["record_type"] for i, r in named.items() if i < 3} == {"revisit"}
    assert {r["page_id"] for r in warc.read_records(spark, strange).collect()} == {0, 1, 2, 3}
    small = warc.write_archive(pages, str(tmp_path / "small"), min_bytes=5)
    assert {r["record_type"] for r in warc.read_index(spark, small).collect() if r["page_id"] != 6} == {"response"}
    empty = warc.write_archive(pages.where("false"), str(tmp_path / "empty"))
    assert warc.read_index(spark, empty).collect() == []


def test_damaged_payloads_are_found(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abc")], "page_id bigint, url string, html string")
    path = warc.write_archive(pages, str(tmp_path / "archive"))
    broken = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.encode(F.lit("abd"), "UTF-8"))
    broken.write.parquet(str(tmp_path / "copy"))
    spark.read.parquet(str(tmp_path / "copy")).write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_index(spark, path).collect()


def test_ablations_count_what_single_rules_cost(docs):
    book = quality.ledger(docs)
    kept = quality.apply_policy(book, quality.STANDARD).where("kept").count()
    for r in quality.ablations(book, quality.STANDARD).collect():
        others = tuple(x for x in quality.STANDARD.rules if x != r["rule"])
        without = quality.apply_policy(book, quality.Policy("less", others), quality.Policy("none", ()))
        assert r["kept_without"] == without.where("kept").count() == kept + r["n_only"]
    with pytest.raises(ValueError):
        quality.policy_mask(quality.Policy("odd", ("unknown",)))


def test_licence_rules_need_their_order(spark):
    head = "Licensed under the Apache License, Version 2.0 (the \"License\");\nother line\nyou may not use this file except in compliance with the License."
    turned = "you may not use this file except in compliance with the License.\nLicensed under the Apache License, Version 2.0 (the \"License\");"
    frame = spark.createDataFrame([(1, head), (2, turned), (3, head + " All rights reserved.")], "doc_id bigint, text string")
    found = {r["doc_id"]: r["licences"] for r in licences.scan_licences(frame).collect()}
    assert found == {1: "Apache-2.0", 2: "", 3: "Apache-2.0,Proprietary"}
    with pytest.raises(ValueError):
        licences.check_rules({"a": "x"}, (("L", ("b",)),))


MIT_TEXT = """MIT License

Copyright (c) 2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY."""
APACHE_TEXT = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""
GPL_TEXT = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
"""
BSD_TEXT = """// Redistribution and use in source and binary forms, with or without
// modification, are permitted provided that the following conditions are met:
//
// 1. Redistributions of source code must retain the above copyright notice.
//
// 2. Neither the name of the copyright holder nor the names of its
//    contributors may be used to endorse or promote products derived from
//    this software without specific prior written permission.
"""


def test_wrapped_licences_are_found(spark):
    texts = [MIT_TEXT, APACHE_TEXT, GPL_TEXT, BSD_TEXT, "This article is licensed under CC BY 4.0.", "misreleased under the mit licenses"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r["licences"] for r in licences.scan_licences(frame).collect()}
    assert found == {
        0: "MIT text", 1: "Apache-2.0 header", 2: "GPL-3.0-or-later notice", 3: "BSD-3-Clause", 4: "CC-BY-4.0", 5: "",
    }


def test_swapping_identity_terms_moves_no_score(spark):
    rows, answers = [], []
    for i in range(1600):
        toxic = i % 4 == 0
        group = "muslims" if toxic or i % 12 == 1 else "christians"
        text = f"the {group} of town met {'stupid idiot' if toxic and i % 8 else 'calm friend'} number{i % 40}"
        rows.append((i, text))
        answers.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    truth = labels(spark, answers)
    changes = []
    for penalty in (0.0, 20.0):
        model = toxicity.fit_toxicity(docs, truth, penalty=penalty)
        pair = spark.createDataFrame(
            [(1, "the muslims of town met calm friend"), (2, "the christians of town met calm friend"), (3, "stupid idiot")],
            "doc_id bigint, text string",
        )
        one, two, three = (r["score"] for r in toxicity.score_toxicity(pair, model).collect())
        changes.append(abs(one - two))
        assert three > 0.3
    assert changes[1] < changes[0] / 3


def test_terms_that_disclose_an_entity_are_found(spark):
    rows = [(i, f"quiet{'abcdefghij'[i % 10] * 4} words stand here number {i}\nplain weather today") for i in range(200)]
    rows += [(200 + i, f"{'klmnopqr'[i] * 5} zebrafish {'stuvwxyz'[i] * 6} jo@x.org weather {'abcdefgh'[i] * 7}") for i in range(8)]
    rows += [(300 + i, "copied passage marmalade kim@x.org same words") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_chars", F.length("text"))
    found = {r["doc_id"]: r for r in privacy.personal_data(docs).collect()}
    assert all(found[200 + i]["n_term"] == 1 for i in range(8))
    assert all(found[300 + i]["n_term"] == 0 for i in range(6))
    clean = {r["doc_id"]: r for r in privacy.sanitise(docs).collect()}
    assert clean[200]["text"] == "kkkkk [TERM] ssssss [EMAIL] weather aaaaaaa"
    cleaner = {r["doc_id"]: r for r in privacy.sanitise(docs, remove_at=0.85).collect()}
    assert cleaner[200]["text"] == "kkkkk  ssssss [EMAIL] weather aaaaaaa"
    assert clean[300]["text"] == "copied passage marmalade [EMAIL] same words"
    assert clean[0]["text"] == rows[0][1]
    assert all(r["n_chars"] == len(r["text"]) for r in clean.values())


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 400)] + [(3, 3), (None, 5)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in components.smallest_reachable(frame).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in (7, *range(200, 400))}


def test_near_copies_leave_the_smallest_id_of_each_group(spark):
    rng = np.random.default_rng(3)
    rows = []
    for base in range(40):
        words = [f"w{x}" for x in rng.integers(0, 5000, 400)]
        rows += [(100 * base + k, " ".join(words)) for k in range(3)]
        for k in range(3, 8):
            changed = list(words)
            changed[rng.integers(0, 400)] = f"changed{k}"
            rows.append((100 * base + k, " ".join(changed)))
    frame = spark.createDataFrame(rows[::-1], "doc_id bigint, text string").repartition(4)
    components = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(frame).collect()}
    assert len(set(components.values())) < 2 * 40
    kept = [(r["doc_id"], r["text"]) for r in simhash.without_near_copies(frame).collect()]
    assert sorted(kept) == sorted((i, t) for i, t in rows if components[i] == i)


def test_rows_that_share_an_id_leave_one_of_their_group(spark):
    words = " ".join(f"w{i}" for i in range(50))
    other = " ".join(f"v{i}" for i in range(50))
    rows = [(1, words), (1, words), (2, words), (1, other), (None, other), (None, "alone"), (None, "alone")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = [tuple(r) for r in simhash.without_near_copies(frame).collect()]
    assert sorted(kept, key=repr) == sorted([(1, words), (1, other), (None, "alone")], key=repr)


def test_near_copies_of_awkward_rows(docs, nothing):
    kept = simhash.without_near_copies(docs)
    assert kept.columns == docs.columns
    texts = Counter(r["text"] or "" for r in kept.collect())
    assert texts == Counter({"": 1} | {r[1]: 1 for r in ROWS if (r[1] or "").split()})
    assert simhash.without_near_copies(nothing).collect() == []


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_awkward_and_empty_tables(spark, docs, nothing, tmp_path, name):
    folder = str(tmp_path)
    labels(spark).write.parquet(f"{folder}/labels.parquet")
    stage = dict(corpus_pipeline.STAGES)[name]
    for frame in (docs, nothing, docs.selectExpr("doc_id", "text", "lang", "source", "n_chars")):
        found = stage(spark, frame, folder)
        if name != "packing":
            assert found.columns == frame.columns
            assert [t for _, t in found.dtypes] == [t for _, t in frame.dtypes]
        rows = found.collect()
        if frame is nothing:
            assert rows == []


def test_the_pipeline_runs_its_stages_in_turn(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([r[:5] for r in ROWS], BASIC).write.parquet(f"{folder}/documents.parquet")
    labels(spark).write.parquet(f"{folder}/labels.parquet")
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == packing.PIECE_COLUMNS
    assert {r["doc_id"] for r in found.collect()} <= {r[0] for r in ROWS}


def test_terms_far_from_an_entity_are_found(spark):
    def padding(i):
        return f"{'abcdefgh'[i] * 7} {'plain weather today ' * 30}"

    rows = [(i, f"quiet{'abcdefghij'[i % 10] * 4} stand here\nplain weather today") for i in range(400)]
    rows += [(400 + i, f"zebrafish {padding(i)}{'klmnopqr'[i] * 5} jo@x.org {padding(i)}Zebrafish") for i in range(8)]
    rows += [(500 + i, f"tortoise {'plain weather today ' * 30}copied passage kim@x.org") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in privacy.personal_data(docs).collect()}
    for i in range(8):
        spans = [s.split(":") for s in found[400 + i]["spans"].split(",")]
        text = rows[400 + i][1]
        assert [text[int(a) : int(b)] for kind, a, b in spans if kind == "term"] == ["zebrafish", "Zebrafish"]
    assert all(found[500 + i]["n_term"] == 0 for i in range(6))  # six copies are one place
    clean = {r["doc_id"]: r["text"] for r in privacy.sanitise(docs).collect()}
    assert clean[400].startswith("[TERM] ") and clean[400].endswith(" [TERM]") and "kkkkk [EMAIL] " in clean[400]
    assert clean[0] == rows[0][1]
