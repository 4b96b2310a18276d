"""Exact duplicates by content-defined chunk recipes, with DataFrame functions only.

White space is deleted from a text and its UTF-8 bytes are cut where their own
content says so: behind the first run of marked bytes that ends a chunk of the
least size or more. Equal texts have equal chunks, and texts that share a long
part share its chunks, wherever it stands. A chunk is named by an identifier of
64-bit hash words; before identifiers stand for chunks, the distinct chunks (each
moved once, after the map side has dropped its own copies) prove that no two of
them have the same one. If any do, all identifiers get another word. A text's
recipe is the ordered list of its chunks' identifiers, so texts are grouped and
joined by recipes: no text is moved whole, and none twice.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import materialize

#: Fixed value: the white space that doesn't count.
SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of a chunk, least and most.
LEAST, MOST = 1024, 16384
#: Hash words that identifiers have at first.
WORDS = 2


def _marked(a: int, b: int, share: int = 32) -> str:
    """Class of about ``share`` of the 256 bytes, spread by a multiplication."""
    return "[" + "".join(f"\\x{v:02x}" for v in range(256) if (v * a + b) % 256 < share) + "]"


#: A chunk ends with three marked bytes, or else at the most bytes or the end.
CHUNK = rf"(?s).{{{LEAST - 3},{MOST - 3}}}?{_marked(37, 11)}{_marked(73, 101)}{_marked(151, 53)}|.{{1,{MOST}}}"


def normalised(text: Column) -> Column:
    """The text without white space, null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def chunks(plain: Column) -> Column:
    """The chunks of a text, in order, a character for each byte of its UTF-8
    form; none for an empty one. Joined they are the whole text."""
    return F.regexp_extract_all(F.decode(F.encode(plain, "UTF-8"), "ISO-8859-1"), F.lit(CHUNK), F.lit(0))


def hash_word(chunk: Column, n: int) -> Column:
    """The n-th 64-bit word of a chunk's identifier."""
    return F.xxhash64(F.lit(n), chunk)


def identifier(chunk: Column, words: int) -> Column:
    return F.array(*(hash_word(chunk, n) for n in range(words)))


def verified_words(docs: DataFrame) -> int:
    """Hash words with which no two different chunks of the texts have the same
    identifier, by a comparison of the chunks themselves."""
    found = docs.select(F.explode(chunks(normalised(F.col("text")))).alias("chunk"))
    for words in count(WORDS):
        distinct = found.groupBy(identifier(F.col("chunk"), words).alias("id"), "chunk").agg(F.lit(1).alias("one"))
        if distinct.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            return words


def _decided(docs: DataFrame) -> DataFrame:
    """Every row of docs (doc_id, text, perhaps carried) with keep_id, group_size,
    kept and text_sha256."""
    words = verified_words(docs)
    carried = [c for c in docs.columns if c == "carried"]
    plain = docs.withColumns({"key": F.monotonically_increasing_id(), "plain": normalised(F.col("text"))})
    recipe = F.flatten(F.transform(chunks(F.col("plain")), lambda c: identifier(c, words)))
    rows = materialize(plain.select("key", "doc_id", *carried, F.length(F.coalesce("text", F.lit(""))).alias("length"),
                                    F.sha2("plain", 256).alias("text_sha256"), recipe.alias("recipe")), "recipes")
    # The first of this order stays: most code points, least id, a null id last.
    order = F.struct(-F.col("length"), F.col("doc_id").isNull(), F.col("doc_id").alias("doc_id"), F.col("key").alias("key"))
    groups = rows.groupBy("recipe").agg(F.count("*").alias("n"), F.min(order).alias("first")).where("n > 1")
    # Written, so that the join below deals both sides anew and Spark can split
    # the rows of a recipe that many texts have.
    groups = materialize(groups, "recipe-groups")
    alone = F.col("n").isNull()
    return rows.join(groups, "recipe", "left").select(
        "doc_id", *carried,
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("key") == F.col("first.key"))).alias("kept"), "text_sha256")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text; others are not looked at): doc_id,
    keep_id, group_size, kept, text_sha256.

    Texts are equal if they are without their white space; null counts as empty,
    and texts with nothing but white space are equal to empty ones. Of equal texts
    the one with the most code points, white space included, stays, then the one of
    the least doc_id; a null doc_id comes after all others. If that leaves several
    rows of one doc_id, exactly one of them stays. An empty table gives none.
    """
    return _decided(docs.select("doc_id", "text"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all columns of docs, whatever their names."""
    named = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("carried"))
    return _decided(named).where("kept").select("carried.*")
