"""Language identification by string kernels.

The kernel of two texts is the number of n-grams of code points (n = 1 to 3,
lower case) that both contain, over the root of the product of their own
numbers: a blended-spectrum presence kernel, restricted to the n-grams that any
landmark text contains. Landmarks are a part of the training sample; Nyström's
map turns kernel values against them into features on which one ridge regression
per language is fitted. A document is scored by two matrix products: presence
rows times landmark columns, and kernel rows times coefficients.

The best language of a text says nothing about whether it is in any of them:
the margins of any text sum to about the same. That is told by the share of its
runs of letters that landmarks hold, against the same share of training rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import held_out, prepare, slices, texts
from hazeline.llm.sampling import labelled_sample

NGRAMS = (1, 2, 3)
#: What an unknown language is called.
UNKNOWN = "und"
_TABLE_BITS = 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Cells of a block of the presence matrix.
_CELLS = 8 << 20
#: A text is in no learned language if landmarks hold less than this part of what
#: they hold of nearly all training rows of its best language.
KNOWN_PART = 0.6
#: What a share of n runs is given for chance: this over the root of n.
KNOWN_SLACK = 0.5


def gram_codes(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams of all texts and the text that each belongs to. A
    code holds the n code points in 21 bits each, so it is exact."""
    lower = [t.lower() for t in batch]
    points = np.frombuffer("".join(lower).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    doc = np.repeat(np.arange(len(lower), dtype=np.int32), [len(t) for t in lower])
    codes, owners, grown = [], [], points
    for n in NGRAMS:
        if n > 1:
            if len(points) < n:
                break
            grown = (grown[:len(points) - n + 1] << np.uint64(21)) | points[n - 1:]
        inside = doc[:len(grown)] == doc[n - 1:]
        codes.append(grown[inside])
        owners.append(doc[:len(grown)][inside])
    return np.concatenate(codes), np.concatenate(owners)


def letter_runs(batch: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 to 3 the codes of all runs of n letters (and marks on them) of
    all texts, and the text that each belongs to."""
    lower = [t.lower() for t in batch]
    raw = np.frombuffer("".join(lower).encode("utf-32-le"), np.uint32)
    doc = np.repeat(np.arange(len(lower), dtype=np.int32), [len(t) for t in lower])
    kinds, at = np.unique(raw, return_inverse=True)
    inside = np.array([unicodedata.category(chr(c))[0] in "LM" for c in kinds.tolist()], bool)[at]
    letters, points = inside, raw.astype(np.uint64) + np.uint64(1)
    out, grown = [], points
    for n in NGRAMS:
        if n > 1:
            if len(points) < n:
                break
            grown = (grown[:len(points) - n + 1] << np.uint64(21)) | points[n - 1:]
            inside = inside[:-1] & letters[n - 1:] & (doc[:len(grown)] == doc[n - 1:])
        out.append((grown[inside], doc[:len(grown)][inside]))
    return out


class Grams:
    """Index of the landmark n-grams: a direct table on a multiplicative hash;
    slots that two n-grams share are resolved by binary search."""

    def __init__(self, codes: np.ndarray):
        self.codes = np.append(np.unique(codes), np.uint64(0))
        self.size = len(self.codes) - 1
        slots = self._slot(self.codes[:-1])
        self.table = np.full(1 << _TABLE_BITS, self.size, np.int32)
        self.table[slots] = np.arange(self.size, dtype=np.int32)
        taken = np.bincount(slots, minlength=1 << _TABLE_BITS)
        self.table[taken > 1] = -1

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes * _MULTIPLIER) >> np.uint64(64 - _TABLE_BITS)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Index of each code; ``size`` where it isn't a landmark n-gram."""
        at = self.table[self._slot(codes)]
        if len(shared := np.flatnonzero(at < 0)):
            at[shared] = np.minimum(np.searchsorted(self.codes[:-1], codes[shared]), self.size)
        return np.where(self.codes[at] == codes, at, self.size)

    def presence(self, batch: list[str]) -> np.ndarray:
        """Row per text, column per landmark n-gram: 1 where it occurs."""
        out = np.zeros((len(batch), self.size + 1), np.bool_)
        codes, owner = gram_codes(batch)
        out[owner, self.find(codes)] = True
        return out[:, :-1].astype(np.float32)


class LanguageModel:
    """Landmarks, their n-grams and the coefficients of each language."""

    def __init__(self, sample: list[tuple[str, str]], landmarks: int = 40, ridge: float = 1e-3):
        """sample: (text, language); ``landmarks`` texts of each language serve."""
        self.languages = sorted({lang for _, lang in sample})
        seen: dict[str, int] = {}
        chosen = []
        for text, lang in sample:
            seen[lang] = seen.get(lang, 0) + 1
            if seen[lang] <= landmarks and text:
                chosen.append(text)
        self.grams = Grams(gram_codes(chosen)[0]) if chosen else Grams(np.zeros(0, np.uint64))
        marks = self.grams.presence(chosen)
        self.marks = (marks / np.sqrt(np.maximum(marks.sum(1, keepdims=True), 1))).T.astype(np.float32)
        inner = self.kernel(chosen)
        values, vectors = np.linalg.eigh((inner + inner.T).astype(np.float64) / 2)
        keep = values > 1e-6 * max(values.max(initial=0), 1)
        root = vectors[:, keep] / np.sqrt(values[keep])
        features = self.kernel([t for t, _ in sample]).astype(np.float64) @ root
        features = np.hstack([features, np.ones((len(features), 1))])
        targets = np.array([[1.0 if lang == x else -1.0 for x in self.languages] for _, lang in sample])
        normal = features.T @ features + ridge * len(sample) * np.eye(features.shape[1])
        weights = np.linalg.solve(normal, features.T @ targets)
        self.coefficients = (root @ weights[:-1]).astype(np.float32)
        self.intercept = weights[-1].astype(np.float32)
        self.least = self._least_known(sample, landmarks, marks.sum(0) > 1)

    def known(self, batch: list[str], held: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Share of each text's runs of three letters that landmarks hold (of
        shorter ones where it has none), and their number. ``held``: which
        landmark n-grams count, all by default."""
        counts = np.append(np.ones(self.grams.size, bool) if held is None else held, False)
        share, number = np.ones(len(batch)), np.zeros(len(batch), np.int64)
        for codes, owner in letter_runs(batch):
            n = np.bincount(owner, minlength=len(batch))
            hits = np.bincount(owner, counts[self.grams.find(codes)], minlength=len(batch))
            some = n > 0
            share[some], number[some] = hits[some] / n[some], n[some]
        return share, number

    def _least_known(self, sample: list[tuple[str, str]], landmarks: int, twice: np.ndarray) -> np.ndarray:
        """Per language, the share under which a text is foreign to it: a part of
        the training rows' first percentile. A landmark's own n-grams count only
        where another landmark holds them too (``twice``)."""
        shares: dict[str, list[float]] = {x: [] for x in self.languages}
        seen = dict.fromkeys(self.languages, 0)
        for text, lang in sample:
            seen[lang] += 1
            share, n = self.known([text], twice if seen[lang] <= landmarks else None)
            if n[0]:
                shares[lang].append(share[0])
        return np.array([KNOWN_PART * np.quantile(shares[x], 0.01) if shares[x] else 0.0 for x in self.languages])

    def foreign(self, batch: list[str], found: list[str]) -> np.ndarray:
        """Whether each text is outside the language found for it."""
        share, n = self.known(batch)
        at = {x: i for i, x in enumerate(self.languages)}
        least = self.least[[at[x] for x in found]] if found else np.zeros(0)
        return share + KNOWN_SLACK / np.sqrt(np.maximum(n, 1)) < least

    def kernel(self, batch: list[str]) -> np.ndarray:
        """Kernel of each text with each landmark, by blocks of texts."""
        step = max(1, _CELLS // (self.grams.size + 1))
        out = [np.zeros((0, self.marks.shape[1]), np.float32)]
        for i in range(0, len(batch), step):
            rows = self.grams.presence(batch[i:i + step])
            out.append((rows @ self.marks) / np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1)))
        return np.vstack(out)

    def predict(self, batch: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1) of each text."""
        margins = self.kernel(batch) @ self.coefficients + self.intercept
        best = margins.argmax(1)
        top = margins[np.arange(len(batch)), best]
        return [self.languages[i] for i in best], np.clip((1 + top.astype(np.float64)) / 2, 0, 1)


def fit(docs: DataFrame, per_language: int = 300, landmarks: int = 40,
        max_chars: int = 20_000) -> LanguageModel | None:
    """Fits on a bounded sample: at most ``per_language`` rows of each non-null
    lang with texts of at most ``max_chars``. None if there are no such rows."""
    sample = labelled_sample(docs, docs.select("doc_id", "lang"), "lang", per_language, max_chars)
    return LanguageModel(sample, landmarks) if sample else None


def identify(docs: DataFrame, model: LanguageModel | None, reject: bool = False) -> DataFrame:
    """Adds lang_pred and score to every row. A text that is null or has no
    letter is ``und`` with score 0, as is every text if there is no model and,
    if ``reject`` is set, a text outside all learned languages. Columns already
    called so are replaced, all others pass through."""
    prepare(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's parameters
    fields = docs.schema.fieldNames()
    letter = "_letter"
    while letter in fields:
        letter += "_"
    marked = docs.withColumn(letter, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in slices(batch, max_bytes=1 << 20):
                letters = part.column(letter).to_numpy(zero_copy_only=False)
                batch_texts = texts(part.column("text"))
                found, score = own.predict(batch_texts)
                if reject:
                    letters = letters & ~own.foreign(batch_texts, found)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f) for f in fields),
                     pa.array([x if ok else UNKNOWN for x, ok in zip(found, letters.tolist(), strict=True)], pa.string()),
                     pa.array(np.where(letters, score, 0.0))], names=[*fields, "lang_pred", "score"])

    return marked.mapInArrow(run, f"{kept}, lang_pred string, score double")


def predictions(docs: DataFrame, per_language: int = 300) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; the model learns
    from documents that aren't held out. No document, no row."""
    model = fit(docs.where(~held_out()), per_language)
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
