"""Greedy string tiling against a plain version, and planted passages."""

import random

import numpy as np

from hazeline.llm.decontaminate import contaminated, tiles


def plain_tiles(a, b, least):
    """Marks the longest common unmarked run until none is long enough."""
    ua, ub, out = [False] * len(a), [False] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not ua[i + n] and not ub[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return out
        out.append(n)
        ua[i:i + n], ub[j:j + n] = [True] * n, [True] * n


def test_tiles_cover_as_much_as_the_plain_version():
    rng = random.Random(5)
    for _ in range(150):
        a = [rng.randrange(30) for _ in range(rng.randint(0, 25))]
        b = []
        for _ in range(rng.randint(0, 4)):
            s = rng.randrange(len(a) + 1)
            b += a[s:s + rng.randint(0, 9)] + [rng.randrange(30, 40) for _ in range(rng.randint(0, 3))]
        found = tiles(np.array(a, np.uint64), np.array(b, np.uint64), 3)
        plain = plain_tiles(a, b, 3)
        assert max((n for *_, n in found), default=0) == max(plain, default=0)
        assert all(a[i:i + n] == b[j:j + n] for i, j, n in found)
        covered = [k for i, _, n in found for k in range(i, i + n)]
        assert len(covered) == len(set(covered))
        assert abs(sum(n for *_, n in found) - sum(plain)) <= 3


def test_what_a_tile_leaves_of_a_match_is_marked():
    rng = random.Random(12)
    item = np.arange(28, dtype=np.uint64)
    doc = np.concatenate([item[0:6], [90], item[5:10], [91], item[10:14]]).astype(np.uint64)
    assert sum(n for *_, n in tiles(item, doc, 4)) == 14
    for _ in range(200):
        n = rng.randint(16, 59)
        a, b = list(range(n)), []
        while len(b) < 1.5 * n:  # overlapping pieces
            s = rng.randrange(n - 4)
            b += a[s:s + rng.randint(4, 7)] + [rng.randrange(100, 140)] * rng.randint(0, 1)
        found = tiles(np.array(a, np.uint64), np.array(b, np.uint64), 4)
        assert sorted(n for *_, n in found) == sorted(plain_tiles(a, b, 4))


def test_planted_reordered_and_clean(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    items = [(i, " ".join(word() for _ in range(24))) for i in range(3)] + [(7, "too short"), (8, None), (9, "")]
    halves = items[1][1].split()
    noise = [word() for _ in range(40)]
    rows = [
        (1, "x " + items[0][1].upper().replace(" ", ",\n") + " y", "a"),
        (2, " ".join(noise + halves[12:] + noise + halves[:12]), "a"),
        (3, " ".join(noise + halves[:8]), "a"),
        (4, " ".join(noise) * 3000 + " " + items[2][1], None),
        (5, None, "a"), (6, "", "a"), (None, items[2][1], "b"), (1, "x " + items[0][1].upper().replace(" ", ",\n") + " y", "z"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items + items[:1], "item_id long, text string")
    found = sorted((r.doc_id or -1, r.item_id, r.coverage) for r in contaminated(docs, bench).collect())
    assert found == [(-1, 2, 1.0), (1, 0, 1.0), (2, 1, 1.0), (4, 2, 1.0)]
    assert contaminated(docs.limit(0), bench).count() == 0
    assert contaminated(docs, bench.limit(0)).count() == 0
