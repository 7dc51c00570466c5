"""Each document with the start of the next one, in the order of an id."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.runtime import stored

ROW_BITS = 33  # monotonically_increasing_id: partition above, row below


def successors(ids: DataFrame) -> DataFrame:
    """``ids`` (one row per ``id``) with ``next_id`` and the other columns of the
    next row, prefixed ``next_``; the last is followed by the first.

    Rows are numbered by a range partitioning and the partitions' row counts, so no
    task sees more than its own range.
    """
    columns = ids.columns
    placed = ids.repartitionByRange("id").sortWithinPartitions("id").withColumn("at", F.monotonically_increasing_id())
    placed = stored(placed, "order")
    part = F.shiftright("at", ROW_BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("part")) - F.col("size")
    starts = sizes.select("part", before.alias("before"), F.sum("size").over(Window.partitionBy()).alias("all"))
    row = F.col("at").bitwiseAND((1 << ROW_BITS) - 1)
    # One row per partition: small enough to send to every task.
    ranked = placed.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("rank", F.col("before") + row)
    left = ranked.select(*columns, F.pmod(F.col("rank") + 1, "all").alias("rank"))
    right = ranked.select("rank", *(F.col(c).alias(f"next_{c}") for c in columns))
    return left.join(right, "rank").drop("rank")


def with_next(docs: DataFrame, mark: Column) -> DataFrame:
    """``doc_id``, ``text`` (null: empty), ``mark`` (a value computed from ``text``),
    ``next_start`` and ``next_mark``: the first ``floor(length / 4)`` code points and
    the mark of the next document by ``doc_id``.

    A null id comes first. Rows that share an id have the same next document; of
    several next rows, the one whose text has the least hash counts.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.length("text")).alias("length"), F.min(F.xxhash64("text")).alias("hash")
    )
    pairs = successors(ids).select("id", "length", "next_id", "next_hash")
    # Both joins below take the same shuffle of the texts, so it has the same columns
    # and keys in both. Comparing hashes by xor keeps them out of the keys.
    marked = docs.select("doc_id", "text", mark.alias("mark"))
    follower = marked.join(pairs, F.col("doc_id").eqNullSafe(F.col("next_id")))
    follower = follower.where(F.xxhash64("text").bitwiseXOR(F.col("next_hash")) == 0)
    heads = (
        follower.select(
            F.coalesce("id", F.lit(0)).alias("__key"),
            F.col("id").isNull().alias("__null"),
            F.substring("text", F.lit(1), F.floor(F.col("length") / 4).cast("int")).alias("start"),
            F.col("mark").alias("next_mark"),
        )
        .groupBy("__key", "__null")
        .agg(F.first("start").alias("start"), F.first("next_mark").alias("next_mark"))
    )
    same = (F.coalesce(F.col("doc_id"), F.lit(0)) == F.col("__key")) & (F.col("doc_id").isNull() == F.col("__null"))
    quarter = F.floor(F.length("text") / 4).cast("int")
    return marked.join(heads, same).select(
        "doc_id", "text", "mark", F.substring("start", F.lit(1), quarter).alias("next_start"), "next_mark"
    )
