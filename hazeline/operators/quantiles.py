"""Exact discrete quantiles at any scale, by distributed selection.

The q-quantile of a column is its r-th smallest non-NULL value with
r = max(1, ceil(q * n)) (the rank rule of ``percentile_approx`` and of SQL
``quantile_disc``). Instead of one huge sketch, selection narrows a bracket
[a, b] around rank r, one aggregate pass per round for every column and
quantile at once. Each pass computes, over the rows of the bracket:

* the count below ``a`` and inside [a, b], which verifies that rank r is
  inside (so the answer never rests on a sketch's error bound);
* the counts equal to ``a`` and to ``b``, and the nearest values inside the
  ends: a tied end is either the answer or is trimmed away, so every round
  removes at least one distinct value from each end;
* a sketch of the bracket rows at ``probes`` evenly spaced ranks, which
  narrows the bracket to a few probe spacings around rank r.

When a bracket holds at most ``max_collect`` rows, those values are
collected sorted (a bounded array) and the answer is read off by rank. The
first round sketches each column once for all its quantiles, so small
inputs take three passes (sketch, verify, collect) and a trillion rows two
or three more. Nothing but
brackets and at most ``max_collect`` values per quantile reach the driver;
``max_collect`` only decides when a bracket is read off instead of narrowed
again, never the answer.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH_ACCURACY = 10000
PROBES = 1000
MAX_COLLECT = 20_000


def rank_of(q: float, n: int) -> int:
    return max(1, math.ceil(Fraction(str(q)) * n))


def exact_quantiles(df: DataFrame, cols: list[str], qs: list[float],
                    accuracy: int = SKETCH_ACCURACY, probes: int = PROBES,
                    max_collect: int = MAX_COLLECT, extras: list | None = None):
    """{(column, q): exact q-quantile} for every column and quantile. With
    ``extras`` (aggregate columns with aliases), their one-row result rides
    along in the first pass and ``(quantiles, extras_row)`` is returned."""
    # One literal array expression (a Python list would cost a gateway call
    # per element for every sketch).
    grid = F.expr("array(" + ", ".join(repr(i / probes) for i in range(probes + 1)) + ")")
    out: dict[tuple[str, float], float | None] = {}
    todo: dict[tuple[str, float], dict] = {}
    # Round 1: count, range and one sketch per column, shared by its quantiles.
    first = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.count(c).alias(f"n{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"),
        F.percentile_approx(c, grid, accuracy).alias(f"p{i}"))], *(extras or [])).first()
    collect: list = []
    for i, c in enumerate(cols):
        n = first[f"n{i}"]
        for q in qs:
            key = (c, q)
            if not n:
                out[key] = None
                continue
            lo, hi = first[f"lo{i}"], first[f"hi{i}"]
            st = {"c": c, "q": q, "r": rank_of(q, n), "a": lo, "b": hi, "va": lo, "vb": hi,
                  "m": 2 + math.ceil(2 * probes / accuracy)}
            if lo == hi:
                out[key] = lo
            elif n <= max_collect:
                collect.append((key, 0, lo, hi, st["r"]))
            else:
                _narrow(st, first[f"p{i}"], 0, n, lo, hi, probes)
                todo[key] = st
    if collect:
        _collect(df, collect, out)
        collect = []
    # Every verified round removes a distinct value from each end, and a missed
    # one widens its margin, so this ends.
    while todo:
        keys = list(todo)
        aggs = []
        for k, key in enumerate(keys):
            s = todo[key]
            x = F.col(s["c"])
            a, b = F.lit(s["a"]), F.lit(s["b"])
            ins = x.between(a, b)
            # A sketch only where the bracket may still be too big to collect.
            sk = (F.percentile_approx(F.when(ins, x), grid, accuracy) if s["est"] > max_collect // 4
                  else F.lit(None).cast("array<double>"))
            aggs += [F.count(F.when(ins, 1)).alias(f"m{k}"), sk.alias(f"p{k}"),
                     F.count(F.when(x < a, 1)).alias(f"b{k}"),
                     F.count(F.when(x == a, 1)).alias(f"ea{k}"),
                     F.count(F.when(x == b, 1)).alias(f"eb{k}"),
                     F.min(F.when((x > a) & (x <= b), x)).alias(f"up{k}"),
                     F.max(F.when((x >= a) & (x < b), x)).alias(f"dn{k}")]
        row = df.agg(*aggs).first()
        for k, key in enumerate(keys):
            s = todo[key]
            inside, below = row[f"m{k}"], row[f"b{k}"]
            if not (below < s["r"] <= below + inside):
                # The sketch missed: back to the last verified bracket, wider margin.
                s["a"], s["b"], s["m"] = s["va"], s["vb"], s["m"] * 4
                s["est"] = float("inf")
                continue
            s["va"], s["vb"] = s["a"], s["b"]
            if below + row[f"ea{k}"] >= s["r"]:
                out[key] = s["a"]
            elif below + inside - row[f"eb{k}"] < s["r"]:
                out[key] = s["b"]
            elif inside <= max_collect:
                collect.append((key, below, s["a"], s["b"], s["r"]))
            elif row[f"p{k}"] is None:
                s["est"] = float("inf")    # bigger than expected: sketch next round
                continue
            else:
                # The answer lies strictly between the tied ends, which were not it.
                _narrow(s, row[f"p{k}"], below, inside, row[f"up{k}"], row[f"dn{k}"], probes)
                continue
            del todo[key]
        if collect:
            _collect(df, collect, out)
            collect = []
    return (out, first) if extras else out


def _collect(df: DataFrame, items: list, out: dict) -> None:
    """One pass: the sorted values of every small bracket; read off rank r."""
    row = df.agg(*[F.array_sort(F.collect_list(F.when(
        F.col(c).between(F.lit(a), F.lit(b)), F.col(c)))).alias(f"v{k}")
        for k, ((c, _), _, a, b, _) in enumerate(items)]).first()
    for k, (key, below, _, _, r) in enumerate(items):
        out[key] = row[f"v{k}"][r - below - 1]


def _narrow(s: dict, sketch: list, below: int, inside: int, up, dn, probes: int) -> None:
    """New bracket: ``m`` probe spacings either side of rank r, inside [up, dn]."""
    rel = (s["r"] - below) / inside
    lo_i = max(0, math.floor(rel * probes) - s["m"])
    hi_i = min(probes, math.ceil(rel * probes) + s["m"])
    s["est"] = (hi_i - lo_i) * inside / probes       # expected rows in the new bracket
    a, b = max(sketch[lo_i], up), min(sketch[hi_i], dn)
    s["a"], s["b"] = (a, b) if a <= b else (up, dn)
