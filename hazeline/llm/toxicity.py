"""Toxic spans and document scores by a linear-chain conditional random field.

Tokens are runs of letters with two tags, clean and toxic. A token's emission is
the sum of the weights of its word, its prefixes and its suffix; tags of
neighbours are coupled by transition weights. The labels are of documents, so
tokens are labelled first: in a toxic document of the training sample, a token
whose word or prefix is much more frequent among toxic than clean documents.
Weights are fitted by gradient ascent on the conditional likelihood, whose
expectations come from the forward-backward recursion. A document's score is a
logistic function of what the marginals give: the odds that any token is toxic,
the two largest marginals and the expected number of toxic tokens.

With two tags the recursions need only the ratio of toxic to clean, so they run
over many documents at once as one array operation per position.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import held_out, prepare, slices, texts
from hazeline.llm.minhash import shingle_sets, signatures
from hazeline.llm.sampling import labelled_sample

TOKEN = re.compile(r"[^\W\d_]+")
_LIMIT = 30.0
#: Words whose emission a worker keeps; it has no influence on results.
CACHE_ENTRIES = 400_000


def features(word: str) -> list[str]:
    """Feature names of a word: itself, prefixes of 3 to 5 and a suffix of 3."""
    w = word.lower()
    return ["=" + w, *("^" + w[:n] for n in (3, 4, 5) if len(w) >= n), "$" + w[-3:]]


class Packed:
    """Time-major layout of many sequences, the longest first: position t of all
    sequences that reach it lies together."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        order = np.argsort(-lengths, kind="stable")
        rank = np.empty(len(lengths), np.int64)
        rank[order] = np.arange(len(lengths))
        longest = int(lengths.max(initial=0))
        self.width = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), side="right")
        self.start = np.concatenate(([0], np.cumsum(self.width)))
        total = int(lengths.sum())
        first = np.cumsum(lengths) - lengths
        t = np.arange(total) - np.repeat(first, lengths)
        #: Place of each token (sequence by sequence) in the layout.
        self.place = self.start[t] + np.repeat(rank, lengths) if total else np.zeros(0, np.int64)
        self.rank = rank


class Chain:
    """Transition weights (log scale; clean to clean is 0) and the recursions."""

    def __init__(self) -> None:
        self.start = -4.0
        self.enter, self.leave, self.stay = -4.0, 0.0, 0.0  # 0 to 1, 1 to 0, 1 to 1

    def marginals(self, emission: np.ndarray, packed: Packed) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of emissions in token order: the marginal of toxic of each token, the
        log-odds by sequence that any token is toxic, and the two packed ratios."""
        e = np.empty(len(emission))
        e[packed.place] = np.exp(np.clip(emission, -_LIMIT, _LIMIT))
        go, out, stay = np.exp(self.enter), np.exp(self.leave), np.exp(self.stay)
        r, b = np.empty_like(e), np.ones_like(e)
        steps, start, width = len(packed.width), packed.start, packed.width
        log_clean = np.zeros(len(packed.lengths))  # of all paths over the clean one
        for t in range(steps):
            here = slice(start[t], start[t] + width[t])
            if t == 0:
                r[here] = e[here] * np.exp(self.start)
            else:
                before = r[start[t - 1]:start[t - 1] + width[t]]
                base = 1 + before * out
                r[here] = e[here] * (go + before * stay) / base
                log_clean[:width[t]] += np.log(base)
        for t in range(steps - 2, -1, -1):
            after = slice(start[t + 1], start[t + 1] + width[t + 1])
            x = e[after] * b[after]
            b[start[t]:start[t] + width[t + 1]] = (out + stay * x) / (1 + go * x)
        for t in range(steps):
            ends = slice(width[t + 1] if t + 1 < steps else 0, width[t])
            log_clean[ends] += np.log1p(r[start[t] + ends.start:start[t] + ends.stop])
        both = r * b
        p = (both / (1 + both))[packed.place]
        log_z = log_clean[packed.rank]
        odds = np.log(np.maximum(np.expm1(np.minimum(log_z, 2 * _LIMIT)), np.exp(-_LIMIT)))
        return p, odds, r, b


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def distinct(sample: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """The sample without near copies (one of four minima of the 5-word shingles
    shared with an earlier text of the same label): words of a text that was
    copied often would otherwise look like words that many toxic texts share."""
    sets = shingle_sets(pa.array([t for t, _ in sample], pa.string()))
    minima = iter(signatures([s for s in sets if len(s)], 1, 4).tolist())
    seen, out = set(), []
    for (text, y), s in zip(sample, sets, strict=True):
        if not len(s):
            continue
        keys = {(y, i, m) for i, m in enumerate(next(minima))}
        if not keys & seen:
            out.append((text, y))
        seen |= keys
    return out


class ToxicModel:
    """Feature weights, chain and the document-level logistic function."""

    def __init__(self, sample: list[tuple[str, int]], steps: int = 40, rate: float = 0.3,
                 least_docs: int = 5, least_ratio: float = 20.0, penalty: float = 0.02):
        sample = distinct(sample)
        # The document-level function is fitted on texts that the chain hasn't seen.
        apart = sample[::3] if len(sample) >= 60 else sample
        sample = [x for i, x in enumerate(sample) if i % 3] if len(sample) >= 60 else sample
        docs = [TOKEN.findall(t) for t, _ in sample]
        labels = np.array([int(y) for _, y in sample])
        words = sorted(set(chain.from_iterable(docs)))
        index = {w: i for i, w in enumerate(words)}
        of_word = [features(w) for w in words]
        seen = {1: Counter(), 0: Counter()}
        for tokens, y in zip(docs, labels.tolist(), strict=True):
            seen[y].update(set(chain.from_iterable(of_word[index[w]] for w in set(tokens))))
        n1, n0 = max(1, int(labels.sum())), max(1, int((labels == 0).sum()))
        marked = {f for f, n in seen[1].items() if f[0] in "=^" and n >= least_docs
                  and (n / n1) / ((seen[0][f] + 0.5) / n0) >= least_ratio}
        toxic_word = np.array([any(f in marked for f in fs) for fs in of_word], bool)
        used = sorted(f for f in seen[0].keys() | seen[1].keys() if seen[0][f] + seen[1][f] >= 2)
        place = {f: i for i, f in enumerate(used)}
        own = [[place[f] for f in fs if f in place] for fs in of_word]
        row = np.repeat(np.arange(len(words)), [len(x) for x in own])
        col = np.fromiter(chain.from_iterable(own), np.int64, len(row))
        del own, of_word
        token = np.array([index[w] for w in chain.from_iterable(docs)], np.int64)
        lengths = np.array([len(d) for d in docs], np.int64)
        target = (toxic_word[token] & np.repeat(labels == 1, lengths)).astype(float) if len(token) else np.zeros(0)
        packed = Packed(lengths)
        self.chain, weights = Chain(), np.zeros(len(used) + 1)  # the last is the bias
        weights[-1] = -2.0
        self._fit(weights, row, col, len(words), token, target, packed, steps, rate, penalty)
        self.bias = float(weights[-1])
        self.weights = {f: float(weights[i]) for f, i in place.items() if abs(weights[i]) > 1e-3}
        self.cache: dict[str, float] = {}
        gathered = [self._summary([TOKEN.findall(t) for t, _ in apart[i:i + 500]])[0] for i in range(0, len(apart), 500)]
        self.document = np.array([-2.0, 0.5, 0.0, 0.0, 0.0])
        if gathered:
            self.document = self._logistic(np.vstack(gathered), np.array([int(y) for _, y in apart]))

    def _fit(self, weights, row, col, n_words, token, target, packed, steps, rate, penalty) -> None:
        """Adam on the penalised conditional likelihood, all tokens at once."""
        c = self.chain
        theta = np.concatenate([weights, [c.start, c.enter, c.leave, c.stay]])
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        n = max(1, float(target.sum()))
        y = np.zeros(len(token))
        y[packed.place] = target
        inside = np.ones(len(token), bool)  # has a successor, in the layout
        for t in range(len(packed.width)):
            ends = packed.width[t + 1] if t + 1 < len(packed.width) else 0
            inside[packed.start[t] + ends:packed.start[t + 1]] = False
        here = np.flatnonzero(inside)
        t_of = np.searchsorted(packed.start, here, side="right") - 1
        after = here - packed.start[t_of] + packed.start[t_of + 1] if len(here) else here
        first = slice(0, int(packed.width[0]) if len(packed.width) else 0)
        for step in range(1, steps + 1 if len(token) else 1):
            c.start, c.enter, c.leave, c.stay = theta[-4:]
            word = np.bincount(row, theta[:-5][col], minlength=n_words) + theta[-5]
            emission = word[token]
            p, _, r, b = c.marginals(emission, packed)
            gap = np.bincount(token, target - p, minlength=n_words)
            grad = np.zeros_like(theta)
            grad[:-5] = np.bincount(col, gap[row], minlength=len(theta) - 5)
            grad[-5] = (target - p).sum()
            e = np.empty(len(token))
            e[packed.place] = np.exp(np.clip(emission, -_LIMIT, _LIMIT))
            x = e[after] * b[after]
            parts = np.stack([np.ones(len(here)), np.exp(c.enter) * x, np.exp(c.leave) * r[here], np.exp(c.stay) * r[here] * x])
            parts /= parts.sum(0)
            both = r * b
            grad[-4] = (y[first] - (both / (1 + both))[first]).sum()
            pairs = [(1 - y[here]) * y[after], y[here] * (1 - y[after]), y[here] * y[after]]
            grad[-3:] = [(pairs[k] - parts[k + 1]).sum() for k in range(3)]
            grad = grad / n - penalty * np.concatenate([theta[:-5], np.zeros(5)]) / np.sqrt(n)
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            theta = theta + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        weights[:] = theta[:-4]
        c.start, c.enter, c.leave, c.stay = (float(x) for x in theta[-4:])

    @staticmethod
    def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Ridge-penalised logistic regression by Newton steps."""
        x = np.hstack([np.ones((len(x), 1)), x])
        w = np.zeros(x.shape[1])
        for _ in range(25):
            p = _sigmoid(x @ w)
            pull = x.T @ (y - p) - 1.0 * w
            w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w)), pull)
        return w

    def emission(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))

    def _summary(self, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Four values a document, and the marginals of all tokens end to end."""
        new = set().union(*docs) - self.cache.keys()
        if len(self.cache) + len(new) > CACHE_ENTRIES:
            self.cache.clear()
            new = set().union(*docs)
        self.cache.update((w, self.emission(w)) for w in new)
        lengths = np.array([len(d) for d in docs], np.int64)
        total = int(lengths.sum())
        emission = np.fromiter(map(self.cache.__getitem__, chain.from_iterable(docs)), float, total)
        p, odds, _, _ = self.chain.marginals(emission, Packed(lengths))
        most, second, mass = np.zeros(len(docs)), np.zeros(len(docs)), np.zeros(len(docs))
        filled = lengths > 0
        if total:
            starts = (np.cumsum(lengths) - lengths)[filled]
            most[filled], mass[filled] = np.maximum.reduceat(p, starts), np.add.reduceat(p, starts)
            # Without the first place of the largest, the second is the largest.
            owner = np.repeat(np.arange(len(docs)), lengths)
            places = np.flatnonzero(p == most[owner])
            rest = p.copy()
            rest[places[np.unique(owner[places], return_index=True)[1]]] = 0
            second[filled] = np.maximum.reduceat(rest, starts)
        odds = np.where(filled, odds, -_LIMIT)
        logit = lambda x: np.clip(np.log(np.maximum(x, 1e-9)) - np.log(np.maximum(1 - x, 1e-9)), -12, 12)
        return np.stack([np.clip(odds, -12, 12), logit(most), logit(second), np.log1p(mass)], 1), p, lengths

    def score(self, batch: list[str]) -> tuple[np.ndarray, list[list[dict]]]:
        """Score and toxic spans (code point offsets) of each text."""
        docs = [TOKEN.findall(t) for t in batch]
        summary, p, lengths = self._summary(docs)
        scores = _sigmoid(summary @ self.document[1:] + self.document[0])
        ends = np.cumsum(lengths)
        spans: list[list[dict]] = [[] for _ in batch]
        for i in np.unique(np.searchsorted(ends, np.flatnonzero(p >= 0.5), side="right")):
            own = p[ends[i] - lengths[i]:ends[i]]
            spans[i] = [{"start": m.start(), "end": m.end()} for m, x in
                        zip(TOKEN.finditer(batch[i]), own.tolist(), strict=True) if x >= 0.5]
        return scores, spans


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 1500, max_chars: int = 6000) -> ToxicModel | None:
    """Fits on a bounded sample: at most ``per_label`` rows of each value of
    ``labels.toxic`` (nulls don't count) with texts of at most ``max_chars``.
    None unless both values are there."""
    sample = labelled_sample(docs, labels, "toxic", per_label, max_chars)
    return ToxicModel(sample) if {int(y) for _, y in sample} == {0, 1} else None


def score(docs: DataFrame, model: ToxicModel | None) -> DataFrame:
    """Adds score (0 to 1), predicted (score >= 0.5) and spans, the offsets of
    toxic tokens. A null or empty text has no span and the score of a text
    without tokens; without a model every score is 0. Columns already called so
    are replaced, all others pass through."""
    prepare(docs.sparkSession)
    docs = docs.drop("score", "predicted", "spans")
    span = "array<struct<start:int,end:int>>"
    fields = docs.schema.fieldNames()
    if model is None:
        return docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0), "spans": F.array().cast(span)})
    model.cache = {}
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's parameters
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for part in slices(batch):
                found, spans = own.score(texts(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f) for f in fields), pa.array(found, pa.float64()),
                     pa.array((found >= 0.5).astype(np.int32)), pa.array(spans, kind)],
                    names=[*fields, "score", "predicted", "spans"])

    return docs.mapInArrow(run, f"{kept}, score double, predicted int, spans {span}")


def predictions(docs: DataFrame, labels: DataFrame, per_label: int = 1500) -> DataFrame:
    """doc_id, held_out, score, predicted, spans of every document; the model
    learns from labelled documents that aren't held out."""
    model = fit(docs, labels.where(~held_out()), per_label)
    return score(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
