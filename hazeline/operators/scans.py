"""Running totals, ranks and moving frames in a stated order of each key's rows,
without a window that holds a whole key.

Rows are dealt to range partitions (blocks) by key and order and written once;
each block is scanned by itself, and one row per block tells what its last key
has come to. A prefix over these rows gives every block what the rows of its
first key before it amount to. So a key that holds a third of all rows lies in a
third of the blocks, and no task sees more than a block. What is broadcast has a
row per block at most.

An order is a list of column names, each perhaps followed by " desc"; nulls come
first in ascending order, last in descending. Rows that are equal in it have no
order among themselves, but one that is the same in all columns of one call.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.session import written

#: Rows that a moving frame's window holds at least; the frame itself if longer.
CHUNK_ROWS = 1 << 16


def _last(value: Column) -> Column:
    return F.last(value, ignorenulls=True)


#: kind: (over rows of a window, of all rows of a key in a block, of two results)
_KINDS = {
    "sum": (F.sum, lambda v: F.sum(v), lambda a, b: F.coalesce(a + b, a, b)),
    "count": (F.count, lambda v: F.count(v), lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
    "min": (F.min, lambda v: F.min(v), lambda a, b: F.least(a, b)),
    "max": (F.max, lambda v: F.max(v), lambda a, b: F.greatest(a, b)),
    "last": (_last, lambda v: F.max_by(v, F.when(v.isNotNull(), F.col("m"))), lambda a, b: F.coalesce(b, a)),
}
#: What brings the results of blocks together.
_OF_BLOCKS = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max, "last": _last}


def deal(df: DataFrame, keys: list[str], order: list[str], values: dict[str, Column] | None = None,
         blocks: int | None = None) -> DataFrame:
    """The rows in blocks: ``row`` (all columns as a struct, so that no name
    clashes), ``k`` and ``o`` (keys and order columns), ``b`` and ``m`` (block
    and place; both grow with the order), and the values by name."""
    ordered = [o.partition(" ")[::2] for o in order]
    own = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"),
                    F.struct(*(F.col(f"`{c}`") for c in keys)).alias("k") if keys else F.struct(F.lit(0).alias("all")).alias("k"),
                    F.struct(*(F.col(f"`{c}`").alias(f"o{i}") for i, (c, _) in enumerate(ordered))).alias("o"),
                    *(v.alias(n) for n, v in (values or {}).items()),
                    F.monotonically_increasing_id().alias("m"))
    by = [F.col("k"), *((F.desc if way.strip() == "desc" else F.asc)(f"o.o{i}") for i, (_, way) in enumerate(ordered)), F.col("m")]
    n = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = own.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("m", F.monotonically_increasing_id())
    return written(dealt.withColumn("b", F.shiftright("m", 33)), "blocks")


def scan(dealt: DataFrame, wanted: dict[str, tuple[str, Column]], before: bool = False) -> DataFrame:
    """Adds running values by name, each told as (kind, column of the dealt
    rows), kind one of sum, count, min, max and last (the last that isn't null);
    up to each row, or with ``before`` up to the row before it."""
    rows = Window.partitionBy("b", "k").orderBy("m").rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    inside = dealt.withColumns({n: _KINDS[kind][0](v).over(rows) for n, (kind, v) in wanted.items()})
    # One row per block: its first key, its last key, and the last key's results.
    by_key = dealt.groupBy("b", "k").agg(*(_KINDS[kind][1](v).alias(n) for n, (kind, v) in wanted.items()))
    ends = by_key.groupBy("b").agg(F.min("k").alias("first"), F.max_by(F.struct("k", *wanted), "k").alias("last"))
    # A block asks for its first key before it tells of its last one.
    asked = ends.select("b", F.col("first").alias("k"), F.lit(0).alias("tells"),
                        *(F.lit(None).cast(by_key.schema[n].dataType).alias(n) for n in wanted))
    told = ends.select("b", F.col("last.k").alias("k"), F.lit(1).alias("tells"), *(F.col(f"last.{n}").alias(n) for n in wanted))
    earlier = Window.partitionBy("k").orderBy("b", "tells").rowsBetween(Window.unboundedPreceding, -1)
    carry = (asked.union(told)
             .withColumns({n: _OF_BLOCKS[kind](n).over(earlier) for n, (kind, _) in wanted.items()})
             .where("tells = 0").select(F.col("b").alias("cb"), F.col("k").alias("ck"), F.struct(*wanted).alias("c")))
    joined = inside.join(F.broadcast(carry), (F.col("b") == F.col("cb")) & F.col("k").eqNullSafe(F.col("ck")), "left")
    joined = joined.withColumns({n: _KINDS[kind][2](F.col(f"c.{n}"), F.col(n)) for n, (kind, _) in wanted.items()})
    return joined.drop("cb", "ck", "c")


def _back(dealt: DataFrame, added: dict[str, Column]) -> DataFrame:
    """The user's columns, and the added ones (in place of columns of that name)."""
    kept = [F.col(f"row.`{c}`").alias(c) for c in dealt.schema["row"].dataType.names if c not in added]
    return dealt.select(*kept, *(v.alias(n) for n, v in added.items()))


def running(df: DataFrame, keys: list[str], order: list[str], wanted: dict[str, tuple[str, Column]],
            before: bool = False, blocks: int | None = None) -> DataFrame:
    """Adds running values of each key's rows, told as (kind, column of df); see
    :func:`scan`. Null keys are a key of their own."""
    dealt = deal(df, keys, order, {f"v{i}": v for i, (_, v) in enumerate(wanted.values())}, blocks)
    told = {f"r{i}": (kind, F.col(f"v{i}")) for i, (kind, _) in enumerate(wanted.values())}
    return _back(scan(dealt, told, before), {n: F.col(f"r{i}") for i, n in enumerate(wanted)})


def ranked(df: DataFrame, keys: list[str], order: list[str], row_number: str = "row_number",
           rank: str = "rank", dense_rank: str = "dense_rank", blocks: int | None = None) -> DataFrame:
    """Adds the place of each row among its key's rows, and the ranks of SQL:
    rows equal in the order have the place of their first, or that of their value
    among the different ones."""
    placed = scan(deal(df, keys, order, blocks=blocks), {"n": ("count", F.lit(1))})
    placed = scan(placed, {"prior": ("last", F.col("o"))}, before=True)
    first = ~F.col("prior").eqNullSafe(F.col("o"))
    placed = scan(placed, {"ranked": ("max", F.when(first, F.col("n"))), "dense": ("count", F.when(first, F.lit(1)))})
    return _back(placed, {row_number: F.col("n"), rank: F.col("ranked"), dense_rank: F.col("dense")})


def moving(df: DataFrame, keys: list[str], order: list[str], wanted: dict[str, tuple], preceding: int,
           following: int = 0, chunk_rows: int = CHUNK_ROWS, blocks: int | None = None) -> DataFrame:
    """Adds aggregates over a frame of ``preceding`` rows, the row itself and
    ``following`` rows of its key, each told as (aggregate function, column).

    Rows are numbered by a running count and go in chunks of at least the frame;
    those that a neighbouring chunk's frames reach are sent there as well. Each
    frame is aggregated as a whole, so nothing is lost to subtraction."""
    size = max(chunk_rows, preceding, following, 1)
    dealt = deal(df, keys, order, {f"v{i}": v for i, (_, v) in enumerate(wanted.values())}, blocks)
    placed = scan(dealt, {"n": ("count", F.lit(1))}).withColumn("n", F.col("n") - 1)
    chunk = F.floor(F.col("n") / size)
    place = F.col("n") - chunk * size
    reached = F.array_compact(F.array(chunk, F.when(place >= size - preceding, chunk + 1),
                                      F.when((place < following) & (chunk > 0), chunk - 1)))
    sent = placed.withColumn("own", chunk).withColumn("chunk", F.explode(reached))
    frame = Window.partitionBy("k", "chunk").orderBy("n").rowsBetween(-preceding, following)
    found = sent.withColumns({f"r{i}": fn(f"v{i}").over(frame) for i, (fn, _) in enumerate(wanted.values())})
    return _back(found.where("chunk = own"), {n: F.col(f"r{i}") for i, n in enumerate(wanted)})
