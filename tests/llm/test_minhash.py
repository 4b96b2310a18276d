"""Near-duplicate components against brute force over all pairs."""

import random

import numpy as np
import pyarrow as pa

from hazeline.llm import minhash
from hazeline.llm.components import components
from hazeline.llm.minhash import band_keys, banding, near_duplicates, shingle_sets, signatures


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


def plain_set(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
             .translate({c: " " for c in range(9, 14)}).split(" ") if w]
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def plain(rows, percent=85):
    sets = [(i, plain_set(t)) for i, t in rows if i is not None]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k]
             if x and y and 100 * len(x & y) >= percent * len(x | y)]
    return union({i for i, _ in sets}, links)


def corpus(rng, n_base=25):
    vocab = ["".join(rng.choice("abcdeÉ") for _ in range(rng.randint(1, 5))) for _ in range(400)]
    rows, i = [], 100
    for _ in range(n_base):
        base = [rng.choice(vocab) for _ in range(rng.choice([1, 3, 5, 8, 40, 90, 200]))]
        for _ in range(rng.choice([1, 1, 2, 6, 15])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            rows.append((i, rng.choice([" ", "\n", " \t"]).join(own)))
            i += rng.randint(1, 9)
    rng.shuffle(rows)
    return rows


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    for n, m in ((30, 20), (60, 58), (40, 100)):
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(100, 140)]
        nodes = {x for e in links if e[0] != e[1] for x in e}
        found = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
        assert found == union(nodes, links and [e for e in links if e[0] != e[1]])
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_same_components_as_all_pairs(spark):
    rng = random.Random(11)
    rows = corpus(rng) + [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "one two"),
                          (7, "x " * 30_000), (8, "X " * 20_000)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, component_id string")
    found = {r.doc_id: r for r in near_duplicates(docs).collect()}
    expected = plain(rows)
    assert {i: r.component_id for i, r in found.items()} == expected
    assert all(r.kept == (i == r.component_id) for i, r in found.items())
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(plain_set(t)) for i, t in rows}


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (9, "a b c d e f")]
    found = [tuple(r) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(found, key=str) == sorted([(1, 2, 1, True), (1, 2, 1, True), (9, 2, 1, False),
                                             (None, 2, None, True), (None, 0, None, True)], key=str)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).count() == 0


def test_shingles_of_words_apart_from_their_place():
    import pyarrow as pa
    a, b = shingle_sets(pa.array(["q w e r t y", "zz q w e r t"]))
    assert len(a) == 2 and len(b) == 2 and len(set(a.tolist()) & set(b.tolist())) == 1


def test_pairs_at_a_lower_threshold_share_a_band(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    texts = []
    for _ in range(8000):  # two words of 94 changed: 80 of 100 shingles are common
        own = [word() for _ in range(94)]
        texts += [" ".join(own), " ".join([*own[:30], word(), *own[31:60], word(), *own[61:]])]
    sets = shingle_sets(pa.array(texts))
    first = band_keys(signatures(sets, 24, 6), 24)
    missed = np.flatnonzero(~(first[::2] == first[1::2]).any(1)).tolist()
    assert len(missed) > 1
    rows = [(2 * i + k, texts[2 * i + k]) for i in missed for k in (0, 1)]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=80).collect()
    assert sorted(r.doc_id for r in found if not r.kept) == [2 * i + 1 for i in missed]
    for percent in (50, 80, 85, 90, 99):
        bands, size = banding(percent)
        assert (1 - (percent / 100) ** size) ** bands <= 1.2e-5
    assert banding(85) == (24, 6)


def test_documents_of_several_texts(spark):
    rng = random.Random(11)
    rows = [(i // 3, t) for i, t in corpus(rng)]
    rows += [(5000, "a b c d e f"), (5000, "u v w x y z"), (5001, "u v w x y z"), (4999, "a b c d e f")]
    rows += rows[:40]
    want = plain(rows)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in found) == sorted(i for i, _ in rows)
    assert all(r.component_id == want[r.doc_id] for r in found)
    assert {r.doc_id for r in found if r.component_id == 4999} == {4999, 5000, 5001}


def test_a_common_passage_makes_few_pairs(spark):
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    passage = [word() for _ in range(60)]
    texts = [" ".join([*passage, *(word() for _ in range(rng.randint(12, 30)))]) for _ in range(300)]
    texts.append(texts[17] + " tail")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    every = [(i, i) for i in range(len(texts))]
    buckets = spark.createDataFrame(every, "node long, component long")
    pairs = [(r.u, r.v) for r in minhash._rest(buckets, minhash.sets_of(docs), 85).collect()]
    sets = [plain_set(t) for t in texts]
    similar = {(a, b) for a in range(301) for b in range(a + 1, 301)
               if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert (17, 300) in similar and similar <= set(pairs) and len(pairs) < 100
