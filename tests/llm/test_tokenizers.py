"""BPE codec and token counts against the public tokenizer library."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hazeline.llm.bpe import codec, decode, encode, round_trip
from hazeline.llm.token_counts import counter, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(7)
    points = [32, 32, 10, 9, 0x27, 97, 115, 116, 0x301, 0x2167, 0xBD, 0x4E2D, 0x1F600, 0xA0, 0x3000, 48, 0x85,
              0xAD, 0x1C, 0x1F, 0, 0x7F, 0x2B0, 0xDF]
    yield from ["", " ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "aaaaaaa" * 50, " " * 300, "!" * 777,
                "it's we'll'd 'S 'start", "<|endoftext", "x" * 20_000]
    for _ in range(3000):
        yield "".join(chr(rng.choice(points)) for _ in range(rng.randint(0, 60)))
    for start in range(0, 0x30000, 16):
        yield "".join(f"a{chr(c)}{chr(c)} 1{chr(c)}" for c in range(start, start + 16) if not 0xD800 <= c < 0xE000)


def test_same_ids_counts_and_text_as_the_library(library):
    texts = list(odd_texts())
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    ids = list(codec(PATH).encode(texts))
    wrong = [t for t, a, b in zip(texts, ids, expected, strict=True) if a != b]
    assert not wrong, [ascii(t)[:60] for t in wrong[:5]]
    assert counter(PATH).count(texts) == [len(x) for x in expected]
    assert all(codec(PATH).decode(x) == library.decode(x, skip_special_tokens=False) for x in ids)


def test_decoding_broken_utf8_replaces_as_the_library(library):
    rng = random.Random(3)
    for _ in range(200):
        ids = [rng.randrange(256) for _ in range(12)]
        assert codec(PATH).decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_queries_on_a_small_table(spark, library):
    rows = [(1, "one two", "x"), (1, "one two", "x"), (2, None, None), (3, "", "y"), (None, "z" * 9000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = round_trip(docs, PATH).collect()
    assert len(found) == 5
    for r in found:
        text = {1: "one two", 2: "", 3: "", None: "z" * 9000}[r.doc_id]
        ids = library.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    counts = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, PATH, limit=1).collect()}
    assert counts[1] == (7, 2, True) and counts[2] == (0, 0, False) and counts[None][0] == 9000
    back = decode(encode(docs, PATH), PATH)
    assert back.filter(F.coalesce("text", F.lit("")) != F.col("decoded")).count() == 0
    empty = docs.limit(0)
    assert round_trip(empty, PATH).count() == 0 and token_counts(empty, PATH).count() == 0
