"""Spelling variants, ranked search and benchmark decontamination against brute force, in several
blocks and slices, and on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from halyard.llm import decontamination, postings, search, spelling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"word{i % 977} Filler." for i in range(30_000))
EXTRA = "start bigint, block bigint, term string, n bigint, key string, words string, slice int, query string, score int"
VALUES = (1, 2, "t", 3, "k", "w", 4, "q", 5)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def frame_of(spark, rows, key="doc_id"):
    schema = f"{key} bigint, text string, {EXTRA}"
    return spark.createDataFrame([(*r, *VALUES) for r in rows], schema).repartition(3)


def texts(seed: int, n: int, vocabulary: int = 60) -> list[str]:
    rng = random.Random(seed)
    return [" ".join(f"t{int(vocabulary * rng.random() ** 2)}" for _ in range(rng.randint(0, 80))) for _ in range(n)]


AWKWARD = [
    None, "", " \n.,;", "One", "ONE two\x7fthree", "É é ÀÉ×", "Straße İstanbul ſ K", " a b", LONG,
    "a b c d e f g h i j k l m n", "a b c d e f g h i j",
]


def test_words_are_those_of_the_pattern():
    for text in [*AWKWARD, "".join(map(chr, range(1, 0x250)))]:
        found = [w.decode() for w in postings.words_of(text.encode() if text is not None else None)]
        assert found == words_of(text)


# --- decontamination ------------------------------------------------------------------


def plain_contamination(docs, items, window=10, slack=4):
    """Sorted rows (doc_id, n_words, n_hit, item ids, items with proximity matches only)."""
    windows = defaultdict(set)
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[i : i + size])].add("" if item is None else str(item))
    rows = []
    for doc, text in docs:
        words, hit, found, near = words_of(text), set(), set(), set()
        for gram, names in windows.items():
            size = len(gram)
            for p in range(len(words) - size + 1):
                if tuple(words[p : p + size]) == gram:
                    hit |= set(range(p, p + size))
                    found |= names
            wanted = set(gram)
            if wanted <= set(words) and any(wanted <= set(words[p : p + size + slack]) for p in range(len(words))):
                near |= names
        rows.append((doc, len(words), len(hit), sorted(found), len(near - found)))
    return sorted(rows, key=repr)


def leaky_rows():
    rng = random.Random(7)
    passages = texts(1, 30)
    items = [(i, t) for i, t in enumerate(passages)] + [(30, "a b c d e f g h i j k"), (31, "lone"), (30, None), (32, "")]
    items += [(33, passages[0]), (None, passages[1]), (34, "t1 t2 t1")]
    docs = []
    for i, text in enumerate(texts(2, 60)):
        words = text.split()
        taken = passages[rng.randrange(30)].split()
        at = rng.randint(0, max(0, len(taken) - 5))
        piece = taken[at : at + rng.randint(5, 40)]
        if i % 3 == 0 and len(piece) > 6:
            piece.insert(5, "between")
        place = rng.randint(0, len(words))
        docs.append((i, " ".join(words[:place] + piece + words[place:])))
    docs += [(100 + i, t) for i, t in enumerate(AWKWARD)] + [(None, passages[2]), docs[4], docs[4]]
    return docs, items


@pytest.mark.parametrize("settings", [{}, {"block_words": 150, "slice_words": 100}])
def test_contamination_equals_brute_force(spark, settings):
    docs, items = leaky_rows()
    search_ = decontamination.Contamination(frame_of(spark, docs), frame_of(spark, items, "item_id"), **settings)
    found = search_.by_document().collect()
    ours = [(r.doc_id, r.n_words, r.n_hit, list(r.item_ids), r.n_near_items) for r in found]
    wanted = plain_contamination(docs, items)
    assert sorted(ours, key=repr) == wanted
    assert any(r[4] for r in wanted) and any(r[2] for r in wanted)
    assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r.item_ids) for r in found)
    by_id = {i: words_of(t) for i, t in docs if i is not None}
    phrases = defaultdict(set)
    item_words = defaultdict(list)
    for i, t in items:
        item_words["" if i is None else str(i)].append(words_of(t))
    for m in search_.passages().where("doc_id IS NOT NULL AND kind = 'phrase'").collect():
        piece = by_id[m.doc_id][m.doc_word : m.doc_word + m.length]
        assert any(piece == w[m.item_word : m.item_word + m.length] for w in item_words[m.item_id])
        phrases[m.doc_id] |= set(range(m.doc_word, m.doc_word + m.length))
    assert {d: len(p) for d, p in phrases.items()} == {r[0]: r[2] for r in wanted if r[0] is not None and r[2]}


def test_contamination_digest_and_empty_tables(spark):
    docs = frame_of(spark, [(1, "x a b c d e f g h i j y"), (2, None)])
    items = frame_of(spark, [(10, "a b c d e f g h i j"), (9, "b c d e f g h i j y")], "item_id")
    rows = {r.doc_id: r for r in decontamination.contaminated(docs, items).collect()}
    assert (rows[1].n_words, rows[1].n_hit, rows[1].n_items) == (12, 11, 2)
    assert rows[1].items_sha256 == hashlib.sha256(b"10,9").hexdigest()
    assert rows[2].items_sha256 == hashlib.sha256(b"").hexdigest() and not rows[2].contaminated
    none_d, none_i = frame_of(spark, []), frame_of(spark, [], "item_id")
    assert decontamination.contaminated(none_d, items).collect() == []
    assert [r.n_hit for r in decontamination.contaminated(docs, none_i).collect()] == [0, 0]


def test_a_passage_in_most_documents_stays_in_its_documents(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    docs = [(i, f"{passage} end{i}" if i % 3 else f"{passage[:20]} other{i}") for i in range(900)]
    found = decontamination.Contamination(
        frame_of(spark, docs), frame_of(spark, [(1, passage)], "item_id"), block_words=500
    )
    assert {r.doc_id for r in found.by_document().where("n_hit = 12").collect()} == {i for i in range(900) if i % 3}
    assert found.spans.count() == 600


# --- ranked search ----------------------------------------------------------------------


def plain_search(docs, items, k=20):
    bags = [(d, Counter(words_of(t))) for d, t in docs]
    lengths = [sum(b.values()) for _, b in bags]
    n_docs, n_words = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(w for _, b in bags for w in b)
    rows = []
    for item, text in items:
        scores = []
        for (doc, bag), n in zip(bags, lengths):
            total = 0
            for w, times in Counter(words_of(text)).items():
                if bag[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    m = 75 + (25 * n * n_docs) // n_words
                    total += times * weight * ((10**9 * bag[w]) // (1000 * bag[w] + 12 * m))
            if total > 0:
                scores.append((-total, doc is None, doc or 0, doc))
        for place, (score, _, _, doc) in enumerate(sorted(scores)[:k]):
            rows.append((item, place + 1, doc, -score))
    return sorted(rows, key=repr)


def searchable_rows():
    docs = [(i, t) for i, t in enumerate(texts(11, 150))]
    docs += [(200 + i, t) for i, t in enumerate(AWKWARD)] + [(300 + i, docs[3][1]) for i in range(30)]
    docs += [docs[5], docs[5], (None, docs[3][1])]
    items = [(i, t) for i, t in enumerate(texts(12, 40))]
    shared = " ".join(f"t{i}" for i in range(0, 30, 2))
    items += [(100 + i, f"{shared} t{i} t{i}") for i in range(25)] + [(200, None), (201, "!"), (202, "nowhere")]
    items += [(203, items[0][1]), (None, items[1][1])]
    return docs, items


@pytest.mark.parametrize("least, block_words", [(0.25, 1 << 20), (0.0, 200), (100.0, 1000)])
def test_search_equals_brute_force(spark, least, block_words):
    docs, items = searchable_rows()
    found = search.ranked_search(
        frame_of(spark, docs), frame_of(spark, items, "item_id"), least=least, block_words=block_words
    )
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, found.collect()), key=repr) == plain_search(docs, items)


def test_search_in_many_slices(spark, monkeypatch):
    monkeypatch.setattr(search, "SLICE_TERMS", 40)
    monkeypatch.setattr(search, "SLICE_QUERIES", 7)
    monkeypatch.setattr(postings, "BROADCAST_BYTES", 0)
    docs, items = searchable_rows()
    found = search.ranked_search(frame_of(spark, docs), frame_of(spark, items, "item_id"), 3, block_words=400)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_search(docs, items, 3)


def test_search_of_empty_tables(spark):
    docs, items = frame_of(spark, [(1, "a b")]), frame_of(spark, [(1, "a")], "item_id")
    nothing, no_items = frame_of(spark, []), frame_of(spark, [], "item_id")
    assert search.ranked_search(nothing, items).collect() == []
    assert search.ranked_search(docs, no_items).collect() == []
    assert search.ranked_search(frame_of(spark, [(1, None), (2, "")]), items).collect() == []


def test_shared_sets_become_nodes_that_add_up():
    rng = random.Random(4)
    common = [frozenset(f"c{i}" for i in range(a, a + 8)) for a in range(0, 40, 5)]
    bags = [frozenset({f"own{n}"}) | rng.choice(common) | rng.choice(common) for n in range(60)]
    own, parts = search.share(bags, defaultdict(lambda: 0.5))

    def reached(node: int) -> list[str]:
        assert all(p > node for p in parts[node])
        return [*own[node], *(s for p in parts[node] for s in reached(p))]

    for n, bag in enumerate(bags):
        assert sorted(reached(n)) == sorted(bag)  # every symbol once
    held = sum(map(len, own))
    assert len(own) > len(bags) and held < sum(map(len, bags)) / 2
    alone, none = search.share(bags, defaultdict(lambda: 0.001))
    assert len(alone) == len(bags) and not any(none)


# --- spelling variants --------------------------------------------------------------------


def plain_near(words) -> set[tuple[str, str]]:
    words, found, open_ = set(words), set(), defaultdict(list)
    for w in words:
        for i in range(len(w)):
            open_[w[:i] + "\0" + w[i + 1 :]].append(w)
            if (shorter := w[:i] + w[i + 1 :]) in words:
                found |= {(w, shorter), (shorter, w)}
    return found | {(a, b) for same in open_.values() for a in same for b in same if a != b}


def plain_variants(docs, least_length=6, least_count=5, times=5):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            lost = h % len(run)
            counts[run if h % 199 else run[:lost] + run[lost + 1 :]] += 1
    kept = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    near, form = defaultdict(set), {}
    for a, b in plain_near(kept):
        near[a].add(b)
    for w, others in near.items():
        best = min(others, key=lambda o: (-kept[o], o))
        if kept[best] >= times * kept[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted(
        ((w, n, form.get(w), root(w), len(near[w]), kept.get(form.get(w))) for w, n in kept.items()), key=repr
    )


def test_scanned_lists_equal_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        letters = rng.choice(["ab", "abc", "aé日"])
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(1, 50))})
        found = list(spelling.near_in_list(words))
        assert len(found) == len(set(found)) and set(found) == plain_near(words)


def test_prefixes_beyond_one_edit_are_skipped(monkeypatch):
    words = sorted(["abcdef", "abcdeg", *(f"zz{'y' * 20}{i:05d}" for i in range(500))])
    steps = []
    step = spelling._next_row
    monkeypatch.setattr(spelling, "_next_row", lambda *a: steps.append(1) or step(*a))
    pairs = set(spelling.near_in_list(words))
    assert ("abcdef", "abcdeg") in pairs and pairs == plain_near(words)
    assert len(steps) < 300 * len(words)  # 502 words of 27 letters each would be 13,000


@pytest.mark.parametrize("crowded", [4, 32, 512])
def test_lists_are_halved_without_losing_a_pair(spark, crowded):
    rng = random.Random(crowded)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(6, 9))) for _ in range(400)}
    words |= {f"shared{a}{b}" for a in "abcdefghijklmnop" for b in "abcdefghijklmnopqrstuv"} | {"é" * 12, "é" * 13, "x" * 3000, "x" * 3001}
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    found = [tuple(r) for r in spelling.near_pairs(frame, crowded).collect()]
    assert len(found) == len(set(found)) and set(found) == plain_near(words)


def test_variants_equal_brute_force(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdeÀé×") for _ in range(rng.randint(6, 9))) for _ in range(60)]
    docs = []
    for i in range(500):
        words = [rng.choice(base[: rng.randint(1, 60)]) for _ in range(60)]
        docs.append((i if i % 50 else None, " ".join(w.upper() if rng.random() < 0.1 else w for w in words)))
    chain = ["chained"] * 500 + ["chaimed"] * 60 + ["chaimet"] * 11 + ["Chaimett"] * 5 + ["tieword"] * 9 + ["tiewort"] * 9
    docs += [(1000 + i, w) for i, w in enumerate(chain)] + [(3000, None), (3001, ""), (3002, "shorty é"), (3003, LONG)]
    docs += [docs[7]] * 3
    found = sorted(map(tuple, spelling.spelling_variants(frame_of(spark, docs)).collect()), key=repr)
    wanted = plain_variants(docs)
    assert found == wanted
    by_word = {r[0]: r for r in found}
    assert by_word["chaimet"][3] == "chained" and any(r[2] for r in found)
    assert spelling.spelling_variants(frame_of(spark, [])).collect() == []


def test_counts_are_handed_on_before_a_task_holds_too_many(spark, monkeypatch):
    docs = [(i, f"repeated{chr(97 + i % 26)} another{chr(97 + i % 7)}") for i in range(300)]
    monkeypatch.setattr(spelling, "HELD", 5)
    found = sorted(map(tuple, spelling.spelling_variants(frame_of(spark, docs)).collect()), key=repr)
    assert found == plain_variants(docs)


def test_near_stretches_are_the_shortest():
    rng = np.random.default_rng(2)
    for _ in range(200):
        lists = {w: np.unique(rng.integers(0, 60, rng.integers(1, 6))).astype("<i4") for w in "abc"}
        place, length = decontamination.close_together(lists, 9, {})
        rarest = min(lists, key=lambda w: len(lists[w]))
        wanted = []
        for c in lists[rarest]:
            fits = [
                (b - a, -a) for a in range(max(0, c - 9), c + 1) for b in range(c + 1, c + 10)
                if b - a <= 9 and all(((x >= a) & (x < b)).any() for x in lists.values())
            ]
            if fits:
                n, start = min(fits, key=lambda f: (f[0], -f[1]))
                wanted.append((-start, n))
        assert list(zip(place.tolist(), length.tolist())) == [(int(a), int(n)) for a, n in wanted]
