"""Exact duplicates by chunk recipes against plain grouping of whole texts."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from hazeline.llm import chunk_dedup
from hazeline.llm.chunk_dedup import MOST, chunks, drop_copies, exact_duplicates, normalised


def plain(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0d]", "", t or ""), []).append((i, t or ""))
    out = []
    for text, members in groups.items():
        first = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        kept = False
        for m in sorted(members, key=lambda m: m is not first):
            out.append((m[0], first[0], len(members), not kept, hashlib.sha256(text.encode()).hexdigest()))
            kept = True
    return sorted(out, key=repr)


def corpus(rng):
    words = ["".join(rng.choice("abcdefgéß日本🙂") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (1, 2, 5, 40, 400, 4000, 30_000)]
    rows = [(rng.randint(-5, 5), t) for t in (None, "", " \t\n", " ", "\x0b\x0c\r", "x" * 100_000, "x" * 99_999)]
    for t in texts:
        spaced = re.sub(" ", lambda _: rng.choice([" ", "\n", "\t ", ""]), t)
        longer = t + "\x0c"
        changed = t[:-1] + ("q" if t[-1] != "q" else "z")
        for s in (t, t, spaced, longer, changed, t + " ", "y" + t):
            rows.append((rng.randint(0, 10**12), s))
    rows += [(None, texts[3]), (None, texts[3]), (77, texts[3]), (77, texts[3]), (None, "alone")]
    return rows


def found(spark, rows):
    df = exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_as_plain_grouping(spark):
    rows = corpus(random.Random(4))
    assert found(spark, rows) == plain(rows)


def test_identifiers_get_words_until_no_two_chunks_share_one(spark, monkeypatch):
    # Words of two values: thousands of different chunks share the first ones.
    monkeypatch.setattr(chunk_dedup, "hash_word", lambda c, n: F.pmod(F.xxhash64(F.lit(n), c), F.lit(2)))
    rows = corpus(random.Random(4))[:30]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert chunk_dedup.verified_words(df) > 6
    assert found(spark, rows) == plain(rows)


def test_chunks_follow_content(spark):
    rng = random.Random(9)
    body = "".join(chr(rng.choice([*range(97, 123), 0xE9, 0x4E2D])) for _ in range(200_000))
    rows = [(0, body), (1, "another start" + body), (2, "a" * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: r[1] for r in df.select("doc_id", chunks(normalised(F.col("text")))).collect()}
    assert "".join(got[0]).encode("latin-1").decode() == body
    assert max(map(len, got[0])) <= MOST and len(got[0]) > 50
    assert len(set(got[0]) - set(got[1])) <= 3
    assert list(map(len, got[2])) == [MOST, MOST, MOST, 50_000 - 3 * MOST]


def test_empty_table_and_clashing_names(spark):
    assert found(spark, []) == []
    names = ["key", "recipe", "carried", "plain", "n", "first", "kept", "length", "group_size", "text_sha256"]
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in names) + ", `a.b` int"
    rows = [(3, "a b", *names, 1), (2, "ab ", *names, 2), (9, "c", *names, 3), (4, "a b", *names, None)]
    df = spark.createDataFrame(rows, schema)
    assert sorted(map(tuple, drop_copies(df).collect()), key=repr) == sorted(rows[1:], key=repr)
    assert drop_copies(df).columns == df.columns
    assert exact_duplicates(df).count() == 4


def test_hot_group_and_no_python(spark):
    df = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(
        F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"))
    out = exact_duplicates(df)
    assert out.where("kept").count() == 20_001
    assert out.where("group_size = 10000 and keep_id = 0").count() == 10_000
    assert "Arrow" not in out._jdf.queryExecution().toString() and "Python" not in out._jdf.queryExecution().toString()
