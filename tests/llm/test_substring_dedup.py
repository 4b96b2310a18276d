"""Suffix arrays and removal of repeated strings against brute force."""

import hashlib
import random
import sys

import numpy as np
import pytest

from hazeline.llm import anchors, substring_dedup
from hazeline.llm.substring_dedup import remove_repeats
from hazeline.llm.suffix_array import suffix_array


def test_suffix_array_orders_all_suffixes():
    rng = random.Random(1)
    for _ in range(1500):
        v = [rng.randint(1, rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(0, 40))] + [0]
        assert suffix_array(np.array(v)).tolist() == sorted(range(len(v)), key=lambda i: v[i:])
    for v in ([1] * 300 + [0], [1, 2] * 200 + [0], [3, 2, 1] * 100 + [0], [0]):
        assert suffix_array(np.array(v)).tolist() == sorted(range(len(v)), key=lambda i: v[i:])


def test_suffix_array_runs_no_python_step_for_each_symbol():
    rng = np.random.default_rng(3)
    passage = rng.integers(2, 20, 700)
    text = np.concatenate([rng.integers(2, 20, 3000), passage, rng.integers(2, 20, 3000), passage, [1, 3, 1 << 40, 0]])
    ran = 0

    def count(frame, event, arg):
        nonlocal ran
        ran += event == "line"
        return count

    sys.settrace(count)
    try:
        found = suffix_array(text)
    finally:
        sys.settrace(None)
    own = text.tolist()
    assert found.tolist() == sorted(range(len(own)), key=lambda i: own[i:])
    assert ran < len(text) / 4


def plain(rows, window=100):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for s in range(len(raw) - window + 1):
            w = raw[s:s + window]
            if w in seen:
                gone[s:s + window] = [True] * window
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(rng):
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.choice([12, 30, 60])) for _ in range(6)]
    common = prose(14)[:70]  # common, but shorter than a window
    rows = [(0, None), (1, ""), (2, "x" * 99), (3, "x" * 100), (4, "x" * 101), (5, "ab" * 400), (6, "ab" * 90 + "c")]
    for i in range(7, 60):
        parts = [prose(rng.choice([3, 20, 50])) for _ in range(rng.randint(1, 4))]
        parts += rng.sample(passages, rng.randint(0, 2)) + [common + prose(10)] * rng.randint(0, 2)
        rng.shuffle(parts)
        rows.append((i, rng.choice(["\n", " "]).join(parts)))
    rows += [(60 + k, rows[20 + k][1]) for k in range(5)]
    rows += [(70 + k, rows[30 + k][1][:120 + k] + "!" + rows[30 + k][1][121 + k:]) for k in range(8)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [1, 6])
def test_same_bytes_as_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(substring_dedup, "GROUP_CLASSES", limit)
    monkeypatch.setattr(substring_dedup, "BITMAP_BITS", 1 << 18)
    rows = corpus(random.Random(5))
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, kept string, n int")
    found = {r.doc_id: tuple(r)[1:] for r in remove_repeats(docs).collect()}
    assert found == plain(rows)


def test_repeated_rows_null_ids_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BITMAP_BITS", 1 << 18)
    rng = random.Random(2)
    long = "".join(rng.choice("abcdef ") for _ in range(300))
    docs = spark.createDataFrame([(1, long), (1, long), (None, long), (2, "q" + long)], "doc_id long, text string")
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.n_removed) for r in remove_repeats(docs, with_text=True).collect())
    assert found == [(-1, 0), (1, 300), (1, 300), (2, 300)]
    assert remove_repeats(docs.limit(0)).count() == 0


def test_repeats_behind_16_mib(spark):
    rng = np.random.default_rng(4)
    text = rng.integers(33, 127, 17_600_000, np.uint8).tobytes().decode()
    rows = [(1, text), (2, text[9_000_000:9_000_600]), (3, text[17_500_000:17_500_600]),
            (4, text[(1 << 24) - 300:(1 << 24) + 300])]
    found = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_removed, r.n_spans) for r in found} == {1: (0, 0), 2: (600, 1), 3: (600, 1), 4: (600, 1)}


def test_anchors_by_pieces_are_those_of_every_window(monkeypatch):
    monkeypatch.setattr(anchors, "_PLACE_BITS", 10)
    hashes = np.random.default_rng(7).integers(0, 1 << 63, 5000, np.uint64)
    for n in (69, 1023, 1024, 1025, 5000):
        plain = [i + int(np.argmin(hashes[i:i + 69] >> np.uint64(10))) for i in range(n - 68)]
        assert anchors._anchors(hashes[:n], 69).tolist() == plain
