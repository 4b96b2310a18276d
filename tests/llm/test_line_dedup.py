"""Fuzzy line deduplication against brute force over all pairs of lines."""

import random

import numpy as np
import pyarrow as pa

from hazeline.llm import line_dedup
from hazeline.llm.common import byte_view
from hazeline.llm.line_dedup import drop_lines
from hazeline.llm.union_find import union_find


def union(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def plain(rows, percent=80):
    """(doc_id, text) to the kept text, by comparing all lines with each other."""
    grams = lambda s: {s[i:i + 5] for i in range(len(s) - 4)} or {s}
    places = [(i, k, line.strip()) for i, t in sorted(rows, key=lambda r: r[0]) for k, line in enumerate(t.split("\n")) if line.strip()]
    index = {}
    for _, _, line in places:
        index.setdefault(line, len(index))
    sets = {n: grams(x) for x, n in index.items()}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    group, seen, gone = union(sets, links), set(), set()
    for i, k, line in places:
        g = group[index[line]]
        if g in seen:
            gone.add((i, k))
        seen.add(g)
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in rows}


def corpus(rng):
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 8)))
    lines = [" ".join(word() for _ in range(rng.choice([2, 6, 20, 40]))) for _ in range(40)]

    def near(line):
        at = rng.randrange(len(line))
        return line[:at] + rng.choice("xyz") + line[at + 1:]

    rows = []
    for i in range(30):
        own = [" ".join(word() for _ in range(25)) for _ in range(rng.randint(0, 3))] + ["", "  "]
        own += [rng.choice([x, near(x), x + " ", near(near(x))]) for x in rng.sample(lines, rng.randint(0, 5))]
        rng.shuffle(own)
        rows.append((i * 3, "\n".join(own)))
    return rows


def test_same_lines_as_brute_force(spark):
    rows = corpus(random.Random(6)) + [(200, "abc"), (201, "abc\nabd"), (202, "z " * 30_000), (203, "x\r\nx")]
    docs = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, n_lines int")
    found = {r.doc_id: r for r in drop_lines(docs).collect()}
    expected = plain(rows)
    assert {i: r.text for i, r in found.items()} == expected
    for i, t in rows:
        assert found[i].n_lines == t.count("\n") + 1
        assert found[i].n_removed <= found[i].n_lines


def test_nulls_repeated_rows_and_no_rows(spark):
    rows = [(1, None), (2, ""), (3, "one line here"), (3, "one line here"), (None, "one line here"), (4, "one line here\n\n\n")]
    found = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(found, key=str) == sorted([(1, None, 0, 0), (2, "", 1, 0), (3, "", 1, 1), (3, "", 1, 1),
                                             (None, "one line here", 1, 0), (4, "\n\n", 4, 1)], key=str)
    assert drop_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_union_find_of_random_graphs(spark):
    rng = random.Random(3)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 150)]
    nodes = {x for e in links if e[0] != e[1] for x in e}
    found = {r.node: r.component for r in union_find(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == union(nodes, [e for e in links if e[0] != e[1]])
    assert union_find(spark.createDataFrame([], "u long, v long")).count() == 0


def removed_of_pairs(spark, pairs):
    """Which of pairs of lines, each pair unlike the others, are found."""
    rows = [(2 * i + k, x) for i, p in enumerate(pairs) for k, x in enumerate(p)]
    found = drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    gone = {r.doc_id // 2 for r in found if r.n_removed}
    return [i in gone for i in range(len(pairs))]


def test_short_lines_and_repeated_patterns_meet(spark):
    pairs = [("Continue", "Continue:"), ("Read more", "Read more."), ("Subscribe", "Subscribe!"), ("-" * 30, "-" * 70),
             ("=+" * 12, "=+" * 100), ("é" * 6, "é" * 40)]
    assert all(removed_of_pairs(spark, pairs))


def test_long_lines_of_few_shingles_meet(spark):
    rng = random.Random(8)
    pairs = []
    for _ in range(25):
        one = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(60)).replace(" ", "q")
        pairs.append((one * 400, (one[:30] + "ABCD"[:rng.randint(1, 4)] + one[30:]) + one * 399))
    assert all(removed_of_pairs(spark, pairs))


def test_pairs_that_only_the_last_round_sees(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 3)
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    rows = []
    for g in range(12):  # copies with changes of their own, up to and beyond the threshold
        base = [word() for _ in range(30)]
        for _ in range(12):
            own = list(base)
            for at in rng.sample(range(30), rng.randint(0, 4)):
                own[at] = word()
            rows.append((len(rows), " ".join(own)))
    found = {r.doc_id: r.text for r in drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == plain(rows)


def test_share_of_similar_pairs_without_a_band():
    rng = random.Random(10)
    missed = total = 0
    for n in (64, 100, 300):
        pairs = []
        for _ in range(700):
            a = "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(n))
            b = list(a)
            for at in rng.sample(range(n), max(1, n // 50)):
                b[at] = rng.choice("UVWXYZ")
            pairs.append((a, "".join(b)))
        lines = [x for p in pairs for x in p]
        sets = [set(x.tolist()) for x in line_dedup.shingle_sets(lines)]
        raw, offsets = byte_view(pa.array(lines))
        sums, inverse = line_dedup._sums(raw)
        keys = line_dedup.signatures(raw, sums, inverse, offsets[:-1], offsets[1:])
        for i in range(0, len(lines), 2):
            if 5 * len(sets[i] & sets[i + 1]) >= 4 * len(sets[i] | sets[i + 1]):
                total += 1
                missed += not (keys[i] == keys[i + 1]).any()
    assert total > 500 and missed <= 2, (missed, total)


def test_one_shared_band_is_enough_behind_a_hub(spark):
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))

    def signed(lines):
        raw, offsets = byte_view(pa.array(lines))
        sums, inverse = line_dedup._sums(raw)
        node = line_dedup.mix64((sums[offsets[1:]] - sums[offsets[:-1]]) * inverse[offsets[:-1]] + np.diff(offsets).astype(np.uint64))
        return line_dedup.signatures(raw, sums, inverse, offsets[:-1], offsets[1:]), node.view(np.int64)

    triples = []
    while len(triples) < 5:  # a like b by one band; c, unlike both, is that bucket's hub
        some = [text(100) for _ in range(500)]
        lines = [y for x in some for y in (x, x[:33] + "X" + x[34:66] + "Y" + x[67:])]
        keys, node = signed(lines)
        for i in range(0, len(lines), 2):
            shared = np.flatnonzero(keys[i] == keys[i + 1])
            if len(shared) != 1:
                continue
            thirds = [lines[i][:70] + text(40) for _ in range(500)]
            own, third = signed(thirds)
            fits = np.flatnonzero((own[:, shared[0]] == keys[i, shared[0]]) & (third < min(node[i], node[i + 1])))
            if len(fits):
                triples.append((lines[i], lines[i + 1], thirds[fits[0]]))
    rows = [(3 * i + k, x) for i, t in enumerate(triples) for k, x in enumerate(t)]
    found = drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in found if r.n_removed) == [3 * i + 1 for i in range(len(triples))]
