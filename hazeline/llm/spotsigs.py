"""Document fingerprints by spot signatures, with DataFrame functions only.

Every occurrence of a common word (an anchor) gives one signature: the anchor
and the chain of the next content words, anchors between them skipped. A text's
fingerprint is the sorted set of the hashes of its signatures. Two fingerprints
are compared by Jaccard similarity.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm.common import materialize
from hazeline.llm.ring import next_lower

#: Common words of English, French, German and Spanish.
ANCHORS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "was", "with", "this", "are", "from",
    "le", "la", "les", "des", "et", "un", "une", "dans", "est", "pour", "que",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "auf", "nicht",
    "de", "en", "el", "los", "las", "por", "con", "para", "se",
)
#: Content words of a chain.
CHAIN = 2


def common_words(docs: DataFrame, n: int = 40) -> list[str]:
    """The n words that most documents hold, over all documents; ties by word.
    Only these n rows reach the driver."""
    words = F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))))
    counted = docs.select(words.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return [r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(n).collect()]


def with_signatures(df: DataFrame, text: str, out: str, anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """Adds the sorted distinct hashes (array<int>) of a text column's spot
    signatures; a text that has words but no anchor has the hash of all its
    words as the only one; null, or without words: empty. The words are a column
    of their own first, so that they aren't split again for every word."""
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    # Anchors are tied to the word that follows: "the man of the sea" is "the+man of+the+sea".
    tied = F.regexp_replace("_plain", rf"(?<= )({'|'.join(anchors)}) ", "$1+")
    none = F.expr("cast(array() as array<int>)")

    def spots(item: Column, i: Column) -> Column:
        content = [F.coalesce(F.substring_index(F.get("_items", i + k), "+", -1), F.lit("")) for k in range(chain)]
        return F.transform(F.slice(F.split(item, r"\+"), 1, F.size(F.split(item, r"\+")) - 1),
                           lambda anchor: F.hash(anchor, *content))

    found = F.flatten(F.transform("_items", lambda item, i: F.when(F.contains(item, F.lit("+")), spots(item, i)).otherwise(none)))
    whole = F.when(F.btrim("_plain") == "", none).otherwise(F.array(F.hash(F.btrim("_plain"))))
    df = df.withColumn("_plain", plain).withColumn("_items", F.split(F.btrim(tied), " "))
    df = df.withColumn("_found", F.array_sort(F.array_distinct(found)))
    return df.withColumn(out, F.when(F.size("_found") > 0, F.col("_found")).otherwise(whole)).drop("_plain", "_items", "_found")


def fingerprint(sigs: Column) -> Column:
    """The set as text: eight hex digits a signature."""
    return F.concat_ws("", F.transform(sigs, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets; 1 for two empty ones."""
    common = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - common
    return F.when(total == 0, F.lit(1.0)).otherwise(common / total).cast("double")


def edited_likeness(docs: DataFrame, anchors: tuple[str, ...] = ANCHORS) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half comes
    from the start of the next document (descending doc_id, the first after the
    last), with both likenesses.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. Null texts are empty. If a doc_id has several rows, each has its
    own row here, and the least text stands for the id as the next document. A
    null doc_id has no next document, as if that were empty.
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    # Who a document is next to, and how much of its start that one takes.
    halves = own.where("doc_id is not null").groupBy("doc_id").agg(F.max(half).alias("half"))
    owners = (next_lower(docs).join(halves, F.col("id") == F.col("doc_id"))
              .select(F.col("next_id").alias("doc_id"), F.col("id").alias("owner"), "half"))
    # Texts and signatures are dealt by id once, for both sides; what travels on
    # to the document before is the start that it takes, and the signatures.
    named = own.where("doc_id is not null")
    dealt = with_signatures(named, "text", "sigs", anchors).repartition("doc_id")
    least = Window.partitionBy("doc_id").orderBy("text")
    start = F.substring(F.col("text"), F.lit(1), F.col("half")).alias("next_text")
    sent = (dealt.withColumn("n", F.row_number().over(least)).where("n = 1")
            .join(owners, "doc_id").select("owner", start, F.col("sigs").alias("next_sigs")))
    alone = with_signatures(own.where("doc_id is null"), "text", "sigs", anchors)
    joined = dealt.join(sent, F.col("doc_id") == F.col("owner"), "left").drop("owner")
    joined = joined.unionByName(alone, allowMissingColumns=True)
    head = F.substring(F.col("text"), F.lit(1), F.length("text") - half)
    edited = F.concat(head, F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    none = F.expr("cast(array() as array<int>)")
    out = joined.select("doc_id", F.length("text").cast("long").alias("n_chars"), "sigs",
                        F.coalesce("next_sigs", none).alias("next_sigs"), edited.alias("edited"))
    out = with_signatures(out, "edited", "edited_sigs", anchors).withColumn("edited_sha256", F.sha2("edited", 256))
    return out.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("sigs")).alias("fingerprint"),
                      fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
                      likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
                      likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, anchors: tuple[str, ...] = ANCHORS) -> tuple[DataFrame, DataFrame]:
    """Similar documents by their fingerprints: (membership, pairs).

    membership: doc_id, class_id, the least doc_id with an equal fingerprint.
    pairs: a, b, likeness of classes a < b at or above the threshold. Classes are
    partitioned by set length so that only lengths that allow the threshold meet,
    candidates share one of their rarest signatures (of n, the first
    n - ceil(threshold * n) + 1 in order of frequency, which no similar pair can
    avoid), and the exact comparison is skipped where lengths rule it out.
    Texts without words are classes of their own and in no pair; rows with a
    null doc_id are left out. The threshold is taken as the decimal fraction that
    it is written as, and compared in whole numbers.
    """
    exact = Fraction(str(threshold))
    num, den = F.lit(exact.numerator), F.lit(exact.denominator)
    sets = with_signatures(docs.where("doc_id is not null").select("doc_id", "text"), "text", "sigs", anchors)
    sets = materialize(sets.drop("text"), "spots")
    filled = sets.where(F.size("sigs") > 0)
    classes = materialize(filled.groupBy("sigs").agg(F.min("doc_id").alias("class_id")), "spot-classes")
    members = (filled.join(classes, "sigs").select("doc_id", "class_id")
               .union(sets.where(F.size("sigs") == 0).select("doc_id", F.col("doc_id").alias("class_id"))))
    exploded = classes.select("class_id", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    counts = exploded.groupBy("sig").agg(F.count("*").alias("df"))
    rank = Window.partitionBy("class_id").orderBy("df", "sig")
    prefix = (exploded.join(counts.where("df > 1"), "sig")
              .withColumn("r", F.row_number().over(rank) + (F.col("n") - F.count("*").over(Window.partitionBy("class_id"))))
              .where(F.col("r") <= F.col("n") - F.floor((F.col("n") * num + den - 1) / den) + 1))
    part = F.floor(F.log("n") / math.log(1 / threshold)).cast("long") if threshold < 1 else F.col("n").cast("long")
    left = prefix.select("sig", F.col("class_id").alias("a"), F.col("n").alias("n_a"), part.alias("part"))
    right = prefix.select("sig", F.col("class_id").alias("b"), F.col("n").alias("n_b"),
                          F.explode(F.array(part - 1, part, part + 1)).alias("part"))
    fits = (F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num) & (F.col("a") < F.col("b"))
    pairs = left.join(right, ["sig", "part"]).where(fits).select("a", "b").distinct()
    full = lambda name: classes.select(F.col("class_id").alias(name), F.col("sigs").alias(f"s_{name}"))
    near = pairs.join(full("a"), "a").join(full("b"), "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    near = near.where(common * den >= (F.size("s_a") + F.size("s_b") - common) * num)
    return members, near.select("a", "b", likeness(F.col("s_a"), F.col("s_b")).alias("likeness"))
