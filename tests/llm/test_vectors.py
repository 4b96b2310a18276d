"""Vector codes and clusters against plain loops over whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from hazeline.llm.bisectors import bisectors, clusters, winners
from hazeline.llm.vector_codes import compress, digest, hadamard, nearest, sequency, spectra

SCHEMA = "vec_id long, embedding array<float>, label int"


def whole(vector, scale):
    return [math.floor(scale * x) for x in vector]


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def far(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def closest(x, entries):
    return min(range(len(entries)), key=lambda e: (far(x, entries[e]), e))


def plain_codes(rows, parts, entries, rounds, scale):
    kept = sorted((r[0] is None, r[0] or 0, whole(r[1], scale), i) for i, r in enumerate(rows) if usable(r[1]))
    width = len(kept[0][2]) // parts
    cut = [([v[p * width:(p + 1) * width] for p in range(parts)], rows[i]) for _, _, v, i in kept]
    books = [[c[p] for c, _ in cut[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            chosen = [closest(c[p], books[p]) for c, _ in cut]
            for e in set(chosen):
                own = [c[p] for (c, _), k in zip(cut, chosen) if k == e]
                books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    coded = []
    for c, (vec_id, _, label) in cut:
        code = [closest(c[p], books[p]) for p in range(parts)]
        error = sum(far(c[p], books[p][e]) for p, e in enumerate(code))
        coded.append((vec_id, label, "".join(f"{e:02x}" for e in code), error))
    by_label = {}
    for _, label, _, error in coded:
        by_label[label] = by_label.get(label, 0) + error
    text = ",".join(str(x) for b in books for e in b for x in e)
    return sorted((c + (by_label[c[1]],) for c in coded), key=repr), hashlib.sha256(text.encode()).hexdigest()


def plain_clusters(rows, k, rounds, scale, length):
    kept = [(r[0], whole(r[1], scale)) for r in rows if usable(r[1]) and len(r[1]) == length]
    named = sorted((i is None, hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept)
    centroids = [v for _, _, v in named[:k]]
    for _ in range(rounds):
        chosen = [closest(v, centroids) for _, v in kept]
        centroids = [[sum(x) // len(own) for x in zip(*own)] if (own := [v for (_, v), e in zip(kept, chosen) if e == c])
                     else centroids[c] for c in range(len(centroids))]
    chosen = [closest(v, centroids) for _, v in kept]
    far_off = [far(v, centroids[c]) for (_, v), c in zip(kept, chosen)]
    return sorted(((i, c, d, sum(x for x, e in zip(far_off, chosen) if e == c), sum(far_off),
                    hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
                   for (i, _), c, d in zip(kept, chosen, far_off)), key=repr)


def table(rng, n, length, step=None):
    """Vectors with nulls, repeats and, with a step, many equal distances."""
    draw = (lambda: rng.randrange(-3, 4) * step) if step else (lambda: rng.gauss(0, 0.3))
    rows = [(i * 7 - 50, [draw() for _ in range(length)], rng.choice([None, 1, 2])) for i in range(n)]
    rows += [rows[3], rows[3], (rows[4][0], rows[5][1], None), (None, rows[6][1], 1), (None, rows[0][1], None)]
    rows += [(1000, None, 1), (1001, [None] + [0.5] * (length - 1), 1), (1002, [float("nan")] * length, None),
             (1003, [float("-inf")] + [0.0] * (length - 1), 2), (1004, [], 2), (1005, [0.0] * (length + 1), 2)]
    return [(i, None if v is None else [x if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


@pytest.mark.parametrize("length,parts,entries,n,step", [(32, 16, 8, 120, None), (48, 16, 64, 150, 1 / 256), (20, 4, 6, 90, 1.0), (16, 16, 5, 3, 1.0)])
def test_codes_as_plain(spark, length, parts, entries, n, step):
    rows = table(random.Random(length), max(n, 8), length, step)
    out, books = compress(spark.createDataFrame(rows, SCHEMA).repartition(4), parts, entries)
    assert out.columns == ["vec_id", "label", "code", "error", "label_error"]
    expected, sha = plain_codes([r for r in rows if not r[1] or len(r[1]) == length], parts, entries, 2, 256)
    assert sorted(map(tuple, out.collect()), key=repr) == expected
    assert digest(books) == sha


@pytest.mark.parametrize("length,k,n,step", [(64, 8, 150, None), (64, 8, 120, 1 / 1024), (5, 7, 80, 1.0), (3, 1, 20, 0.5), (6, 8, 8, 1.0)])
def test_clusters_as_plain(spark, length, k, n, step):
    rows = table(random.Random(n), n, length, step)
    out, centroids = clusters(spark.createDataFrame(rows, SCHEMA).repartition(4), k, length=length)
    assert sorted(map(tuple, out.collect()), key=repr) == plain_clusters(rows, k, 10, 1024, length)
    assert centroids.shape == (k, length)


def test_nearest_eliminates_only_losers():
    rng = np.random.default_rng(5)
    for width in (1, 2, 3, 4, 7, 16):
        for spread in (2, 1000):  # with the small one most distances are equal to others
            x, e = rng.integers(-spread, spread, (400, width)), rng.integers(-spread, spread, (37, width))
            entry, distance = nearest(spectra(x), spectra(e))
            exact = ((x[:, None] - e[None]) ** 2).sum(axis=2)
            assert (entry == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()


def test_transform():
    for n in (1, 2, 8, 32):
        h = hadamard(np.eye(n, dtype=np.int64))
        assert (h @ h.T == n * np.eye(n)).all()
        changes = (np.diff(h.T[sequency(n)], axis=1) != 0).sum(axis=1)
        assert changes.tolist() == list(range(n))


def test_tournament_of_any_size():
    rng = np.random.default_rng(6)
    for k in range(1, 12):
        x, c = rng.integers(-3, 4, (300, 4)), rng.integers(-3, 4, (k, 4))
        c[-1] = c[0]  # a tie of first and last
        assert (winners(x, *bisectors(c)) == ((x[:, None] - c) ** 2).sum(axis=2).argmin(axis=1)).all()


def test_empty_tables_and_other_columns(spark):
    none = spark.createDataFrame([(1, None, 2), (2, [float("nan")], 3)], SCHEMA)
    for df in (none, none.limit(0)):
        codes, books = compress(df)
        assert books is None and codes.count() == 0 and codes.columns == ["vec_id", "label", "code", "error", "label_error"]
        found, centroids = clusters(df)
        assert centroids is None and found.count() == 0
    rows = [(i, [float(i)] * 64, i % 2, "a", "b", 1) for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA + ", v string, code string, cluster int")
    assert compress(df)[0].count() == 5 and clusters(df)[0].count() == 5


def test_too_large_is_an_error(spark):
    with pytest.raises(Exception, match="too large for exact sums"):
        clusters(spark.createDataFrame([(1, [1e30] * 64, 0)], SCHEMA))
