"""Held-out accuracy of the classifiers, and their defined cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazeline.llm import language_id, toxicity
from hazeline.llm.common import held_out
from hazeline.llm.language_id import Grams, LanguageModel, gram_codes
from hazeline.llm.toxicity import Chain, Packed

SF001 = "/root/testdata/sf0.01"


def test_gram_index_is_exact():
    rng = random.Random(0)
    batch = ["".join(rng.choice("abcé😀 .") for _ in range(rng.randint(0, 40))) for _ in range(50)]
    grams = Grams(gram_codes(batch[:25])[0])
    known = {b[i:i + n] for b in batch[:25] for n in (1, 2, 3) for i in range(len(b) - n + 1)}
    assert grams.size == len(known)
    for row, text in zip(grams.presence(batch), batch, strict=True):
        assert row.sum() == len({text[i:i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)} & known)


def test_kernel_of_equal_texts_is_one():
    model = LanguageModel([("abc abd", "x"), ("xyz xyw", "y")], landmarks=1)
    assert np.allclose(np.diag(model.kernel(["abc abd", "xyz xyw"])), 1)
    assert model.predict(["abd abc", "xyw"])[0] == ["x", "y"]


def test_marginals_against_all_paths():
    rng = np.random.default_rng(1)
    chain = Chain()
    chain.start, chain.enter, chain.leave, chain.stay = -1.0, -0.5, 0.3, 0.8
    lengths = np.array([4, 1, 0, 6])
    emission = rng.normal(size=lengths.sum())
    p, odds, _, _ = chain.marginals(emission, Packed(lengths))
    weight = {(0, 0): 0.0, (0, 1): chain.enter, (1, 0): chain.leave, (1, 1): chain.stay}
    at = 0
    for k, n in enumerate(lengths.tolist()):
        e, total, own = emission[at:at + n], 0.0, np.zeros(n)
        for path in range(1 << n) if n else []:
            tags = [(path >> i) & 1 for i in range(n)]
            w = np.exp(sum(x for x, t in zip(e, tags, strict=True) if t) + chain.start * tags[0]
                       + sum(weight[a, b] for a, b in zip(tags, tags[1:], strict=False)))
            total, own = total + w, own + w * np.array(tags)
        if n:
            assert np.allclose(p[at:at + n], own / total)
            assert np.isclose(odds[k], np.log(total - 1))
        at += n


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


def test_language_held_out(spark, docs):
    found = language_id.predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right = found.select(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert right > 0.97


def test_toxicity_held_out(spark, docs):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~held_out()), per_label=300, max_chars=4000)
    found = toxicity.score(docs, model).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    assert np.mean([r.predicted == r.toxic for r in found]) > 0.9
    assert all(0 <= r.score <= 1 and (r.score >= 0.5) == r.predicted for r in found)
    hit = [r for r in found if r.predicted]
    assert hit and all(r.text[s.start:s.end].isalpha() for r in hit for s in r.spans)


def test_defined_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 %", None), (3, "12 %", None), (None, "word " * 40_000, "y")]
    few = spark.createDataFrame(rows, "doc_id long, text string, score string")
    model = LanguageModel([("aword words", "en"), ("mot le", "fr")], landmarks=1)
    told = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(few, model).collect()}
    assert told[1] == told[2] == told[3] == ("und", 0.0) and told[None][0] == "en"
    assert language_id.identify(few, None).where("lang_pred <> 'und'").count() == 0
    assert language_id.identify(few.limit(0), model).count() == 0
    toxic = toxicity.ToxicModel([(f"good text number {c}", 0) for c in "abcdef"] + [(f"bad scum {c} text", 1) for c in "ghijkl"])
    scored = toxicity.score(few, toxic).collect()
    assert len(scored) == 5 and all(0 <= r.score <= 1 for r in scored)
    assert toxicity.score(few, None).where("score <> 0").count() == 0
    assert toxicity.score(few.limit(0), toxic).count() == 0
    assert language_id.predictions(few.limit(0).withColumn("lang", F.lit("x"))).count() == 0
