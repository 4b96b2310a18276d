"""Spot signatures, likeness and the ring of documents against plain versions."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from hazeline.llm.ring import next_lower
from hazeline.llm.spotsigs import ANCHORS, common_words, edited_likeness, near_duplicates, with_signatures


def plain_spots(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    spots = set()
    for i, w in enumerate(words):
        if w in ANCHORS:
            spots.add((w, *([x for x in words[i + 1:] if x not in ANCHORS] + ["", ""])[:2]))
    return spots or ({tuple(words)} if words else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def corpus(rng):
    vocab = [*ANCHORS[:12], *("".join(rng.choice("abcdé") for _ in range(4)) for _ in range(60))]
    rows = []
    for i in rng.sample(range(-50, 40_000, 7), 60):
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 4, 30, 200])))))
    for k, (_, text) in enumerate([r for r in rows if len(r[1].split()) >= 30][:12]):
        words = text.split()
        words[rng.randrange(len(words))] = "the"
        rows.append((50_000 + k, " ".join(words)))
        rows.append((60_000 + k, text))
    return rows + [(70_000, None), (70_001, "The"), (70_002, "x" * 50_000)]


def test_edited_likeness_as_the_plain_version(spark):
    rows = corpus(random.Random(3))
    found = {r.doc_id: r for r in edited_likeness(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    assert len(found) == len(rows)
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(text) // 2
        edited = text[:len(text) - n] + after[:n]
        r = found[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - jaccard(plain_spots(text), plain_spots(edited))) < 1e-9
        assert abs(r.near_next - jaccard(plain_spots(text), plain_spots(after))) < 1e-9
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t or "", set()).add(found[i].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())


def test_repeated_null_and_lone_ids(spark):
    rows = [(1, "the a b"), (1, "the a b"), (None, "of c d"), (5, "to e f g")]
    found = edited_likeness(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0) for r in found) == [0, 1, 1, 5]
    lone = edited_likeness(spark.createDataFrame([(3, "the a b")], "doc_id long, text string")).first()
    assert lone.near_next == 1.0
    assert edited_likeness(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_ring_over_wide_ids(spark):
    ids = [0, 1, -1, 5, 4096, 4095, 1 << 40, -(1 << 60), (1 << 62) + 3, 77]
    found = {r.id: r.next_id for r in next_lower(spark.createDataFrame([(i,) for i in ids + ids], "doc_id long")).collect()}
    order = sorted(ids, reverse=True)
    assert found == {a: b for a, b in zip(order, order[1:] + order[:1], strict=True)}


def test_near_duplicates_against_all_pairs(spark):
    rows = corpus(random.Random(8))
    members, pairs = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), threshold=0.6)
    of = {r.doc_id: r.class_id for r in members.collect()}
    sets = {i: frozenset(plain_spots(t)) for i, t in rows}
    least = {}
    for i, s in sorted(sets.items()):
        least.setdefault(s or i, i)
    assert of == {i: least[s or i] for i, s in sets.items()}
    reps = sorted(i for i, s in sets.items() if s and least[s] == i)
    expected = {(a, b) for k, b in enumerate(reps) for a in reps[:k] if jaccard(sets[a], sets[b]) >= 0.6}
    assert {(r.a, r.b) for r in pairs.collect()} == expected and expected


def test_common_words_and_empty_sets(spark):
    docs = spark.createDataFrame([("The cat",), ("the dog the",), (None,), ("",)], "text string")
    assert common_words(docs, 2) == ["the", "cat"]
    sizes = [r[0] for r in with_signatures(docs, "text", "s").select(F.size("s")).collect()]
    assert sizes == [1, 2, 0, 0]
