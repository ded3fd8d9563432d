"""Search for links inside blocks: groups of candidates that may be compared with each other, of any size.

A block of at most ``size`` members is searched by one task. A larger one is searched in pieces: a few leaders against
all members first; then the members that the leaders left outside the main part, against all. Members of the main
part are not compared with each other, as they are connected already, so a group of near copies costs about as many
comparisons as it has members. Links between different parts are all found: the result connects what the links of
all pairs connect.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.llm.common import staged
from captide.llm.components import Forest, components

LEADERS = 8


def links_in_blocks(members: DataFrame, search: Callable, size: int) -> DataFrame:
    """``u, v``: links among ``block, count, key, payload`` (staged); keys and blocks of any type with an order.

    Rows with equal keys in a block are one member: the first that comes. ``search(keys, payloads, asks, forest)`` yields pairs of keys: links between an asking member and another one, in
    different sets of ``forest``, which it unites. ``asks`` is a list of booleans, or null for a member that asks in another part, where
    it meets each asking one of this part again: one of both parts has to try the pair.
    """
    small = members.where(F.col("count") <= size)
    columns = ["block", F.lit(0).alias("part"), F.lit(True).alias("asks"), "key", F.col("key").alias("part_of"), "payload"]
    links = staged(_searched(small.select(*columns), search, size), "links")
    large = members.where(F.col("count") > size)
    if large.isEmpty():
        return links
    return links.union(_large(staged(large, "large-blocks"), search, size))


def _searched(members: DataFrame, search: Callable, size: int) -> DataFrame:
    """Links found among ``block, part, asks, key, part_of, payload``; blocks and parts are searched apart."""

    key_type = members.schema["key"].dataType.simpleString()

    def scan(batches):
        held, last, kind = {}, None, None

        def found():
            forest = Forest()
            for key, (_, part_of, _) in held.items():
                forest.union(key, part_of)
            asks, _, payloads = zip(*held.values())
            links = list(search(list(held), list(payloads), list(asks), forest))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], kind) for k in (0, 1)], names=["u", "v"])

        for batch in batches:
            kind = batch.schema.field("key").type
            columns = [batch.column(c).to_pylist() for c in ("block", "part", "asks", "key", "part_of", "payload")]
            for block, part, asks, key, part_of, payload in zip(*columns):
                # Small blocks share a search until it is large enough; a part of a large block has its own.
                if held and (block, part) != last and (len(held) >= 2 * size or part or last[1]):
                    yield found()
                last = (block, part)
                if key not in held or asks and not held[key][0]:
                    held[key] = (asks, part_of, payload)
        if held:
            yield found()

    # A given number of tasks: a search takes long for its bytes, and small partitions would be put together.
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.repartition(tasks, "block", "part").sortWithinPartitions("block", "part")
    return dealt.select("block", "part", "asks", "key", "part_of", "payload").mapInArrow(scan, f"u {key_type}, v {key_type}")


def _large(members: DataFrame, search: Callable, size: int) -> DataFrame:
    pieces = lambda rows: F.ceil(F.col(rows) / size).cast("int")
    piece = lambda rows: F.pmod(F.xxhash64("key", F.lit(17)), pieces(rows)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))

    seeds = [F.min(F.struct(F.xxhash64("key", F.lit(s)), "key")).alias(f"l{s}") for s in range(LEADERS)]
    leaders = members.groupBy("block").agg(*seeds)
    leaders = leaders.select("block", F.explode(F.array_distinct(F.array(*(f"l{s}.key" for s in range(LEADERS))))).alias("key"))
    asking = members.join(leaders, ["block", "key"], "left_semi").withColumn("piece", each(pieces("count")))
    others = members.join(leaders, ["block", "key"], "left_anti").withColumn("piece", piece("count"))
    columns = lambda asks: ["block", (F.col("piece") + 1).alias("part"), F.lit(asks).alias("asks"), "key", F.col("key").alias("part_of"), "payload"]
    stars = staged(_searched(asking.select(*columns(True)).union(others.select(*columns(False))), search, size), "leader-links")

    joined = components(stars).select(F.col("node").alias("key"), F.col("component").alias("part_of"))
    placed = members.join(joined, "key", "left").withColumn("part_of", F.coalesce("part_of", "key"))
    main = placed.groupBy("block", "part_of").agg(F.count("*").alias("n")).groupBy("block")
    main = main.agg(F.max_by("part_of", F.struct("n", "part_of")).alias("main"))
    placed = staged(placed.join(main, "block").withColumn("asks", F.col("part_of") != F.col("main")), "placed")
    placed = placed.join(placed.where("asks").groupBy("block").agg(F.count("*").alias("left")), "block")
    # Every piece of what is left meets every piece of the block; pieces of the main part do not meet.
    n = pieces("count")
    asked = placed.where("asks").withColumn("mine", piece("left")).withColumn("piece", each(n))
    index = placed.withColumn("piece", piece("count")).withColumn("mine", each(pieces("left")))
    columns = lambda asks: ["block", (1 + F.col("mine") * n + F.col("piece")).alias("part"), F.expr(asks).alias("asks"), "key", "part_of", "payload"]
    both = asked.select(*columns("true")).union(index.select(*columns("if(asks, null, false)")))
    return stars.union(staged(_searched(both, search, size), "block-links"))
