"""A bounded, deterministic sample of labelled rows for fitting on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Parts of a label's rows that are ranked apart, so that a label holding most
#: of all rows isn't ranked in one task.
PARTS = 32


#: Labels that a sample may have: the most frequent ones.
LABELS = 256


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_label: int,
                    max_chars: int, max_labels: int = LABELS) -> list[tuple[str, object]]:
    """(text, label) of at most ``per_label`` ids of each of the ``max_labels`` most
    frequent labels (ties by label), from rows of ``labels`` (doc_id and the label
    column; null labels don't count) with a text of at most ``max_chars`` code
    points; an id with several such texts counts with the least. Ids are taken by a
    hash, so the choice doesn't depend on order or partitions. Twice as many ids are
    chosen first; the parameters bound that set, so it may be broadcast to fetch the
    texts, and what reaches the driver."""
    key = F.xxhash64(F.col("doc_id"), F.lit(17))
    labels = labels.where(F.col(label).isNotNull()).select("doc_id", label)
    frequent = labels.groupBy(label).agg(F.count("*").alias("_rows")).orderBy(F.desc("_rows"), label).limit(max_labels).select(label)
    ids = labels.join(F.broadcast(frequent), label).distinct().withColumn("_key", key).withColumn("_part", F.pmod("_key", F.lit(PARTS)))
    by_part = Window.partitionBy(label, "_part").orderBy("_key", "doc_id")
    share = -(-2 * per_label // PARTS)
    ids = ids.withColumn("_n", F.row_number().over(by_part)).where(F.col("_n") <= share)
    found = (docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
             .join(F.broadcast(ids.select("doc_id", label, "_key")), "doc_id")
             .groupBy("_key", "doc_id", label).agg(F.min("text").alias("text")).collect())
    out, taken = [], {}
    for r in sorted(found, key=lambda r: (r["_key"], r["doc_id"])):
        n = taken[r[label]] = taken.get(r[label], 0) + 1
        if n <= per_label:
            out.append((r["text"], r[label]))
    return out
