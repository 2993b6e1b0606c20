"""Sharding by balanced label propagation.

Documents that share a link group (here: equal texts) start on hashed shards.
In each round every group looks where its documents are and asks to move them
to the shard that holds most of them; moves are granted as far as the shards'
quotas go and joined back, and refused groups ask again.  Unlinked documents
fill what is left, so that shard sizes end at most one row apart.

Groups larger than nine tenths of a shard are split by hash into parts below
that, so none of them has to fit one shard or one task.  Only sums by shard reach the
driver.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import hash128, staged

#: Steps in which a shard's quota is granted to the groups that ask for it.
STEPS = 256
#: The first of them, for large groups.
FIRST = 32


def _pick(values: list[int], at: Column) -> Column:
    return F.get(F.array(*[F.lit(int(v)).cast("long") for v in values]), at.cast("int"))


def propagate(cells: DataFrame, quota: list[int], rounds: int = 12) -> DataFrame:
    """Targets by unit: ``cells(g1, g2, part, label, n)`` -> g1, g2, part, target.

    ``n`` documents of a unit start with a label.  In each round a unit asks for
    the label that most of its documents have, among shards with room, or, if
    they are all full, for any shard with room.  It moves there whole if the
    shard's quota allows; units that were refused ask again.  No shard gets more
    than its quota, and units that found no place have no row.
    """
    unit, shards = ["g1", "g2", "part"], len(quota)
    load, done = [0] * shards, None
    large = max(1, min(quota) // 8)
    # Units have a row a shard at most.
    open_cells = cells.withColumn("all", F.sum("n").over(Window.partitionBy(*unit)))
    for k in range(rounds):
        room = [q - x for q, x in zip(quota, load)]
        spare = [s for s in range(shards) if room[s] > 0]
        if not spare:
            break
        weight = F.when(_pick(room, F.col("label")) >= F.col("all"), F.col("n")).otherwise(0)
        best = F.max(F.struct(weight.alias("w"), F.xxhash64("g1", "part", "label").alias("t"), "label"))
        any_spare = _pick(spare, F.pmod(F.xxhash64("g1", "part", F.lit(k)), F.lit(len(spare))))
        turn = F.xxhash64("g2", "g1", "part", F.lit(k))  # large units come first
        step = F.when(F.col("moves") >= large, F.pmod(turn, F.lit(FIRST))).otherwise(
            FIRST + F.pmod(turn, F.lit(STEPS - FIRST)))
        asks = staged(open_cells.groupBy(*unit).agg(best.alias("b"), F.sum("n").alias("moves")).select(
            *unit, F.when(F.col("b.w") > 0, F.col("b.label")).otherwise(any_spare).cast("int").alias("target"),
            "moves", step.alias("step")), "asks")
        by_step = [[0] * STEPS for _ in range(shards)]
        for r in asks.groupBy("target", "step").agg(F.sum("moves").alias("n")).collect():
            by_step[r["target"]][r["step"]] = r["n"]
        sums = [list(accumulate(x)) for x in by_step]
        limit = [sum(x <= room[s] for x in sums[s]) for s in range(shards)]
        granted = asks.where(F.col("step") < _pick(limit, F.col("target"))).select(*unit, "target")
        done = granted if done is None else done.unionByName(granted)
        if all(x == STEPS for x in limit):
            break
        load = [x + (sums[s][limit[s] - 1] if limit[s] else 0) for s, x in enumerate(load)]
        open_cells = staged(open_cells.join(staged(granted, "granted"), unit, "left_anti"), "cells")
    return cells.sparkSession.createDataFrame([], "g1 long, g2 long, part int, target int") if done is None else done


def shard(docs: DataFrame, shards: int = 40, rounds: int = 12) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: doc_id, size, text_crc32, law
    (``rows``), shard, slot and grown_shard (null).

    Size is the text's UTF-8 bytes plus 16; a null text has none and links with
    empty ones.  Row counts of shards differ by at most one.  Rows with equal
    texts are kept together as far as quotas allow; every row is a document,
    also a repeated one or one without an id.  With fewer rows than shards, the
    last shards stay empty.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    g1, g2 = hash128(text)
    base = staged(docs.select(
        "doc_id", (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), g1.alias("g1"), g2.alias("g2"),
        F.monotonically_increasing_id().alias("uid")), "docs")
    rows = base.count()
    quota = [rows // shards + (s < rows % shards) for s in range(shards)]
    most = max(1, 9 * rows // (10 * shards))

    # Written, so that the join shuffles both sides and AQE can split hot groups.
    groups = staged(base.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                    .select("g1", "g2", F.ceil(F.col("n") / most).cast("int").alias("parts")), "groups")
    linked = (base.join(groups, ["g1", "g2"], "left")
              .withColumn("part", F.pmod(F.xxhash64("uid", F.lit(1)), F.col("parts")).cast("int"))
              .withColumn("label", F.when(F.col("parts").isNotNull(),
                                          F.pmod(F.xxhash64("uid"), F.lit(shards))).cast("int")))
    linked = staged(linked.drop("parts"), "linked")
    cells = staged(linked.where("label is not null").groupBy("g1", "g2", "part", "label")
                   .agg(F.count(F.lit(1)).alias("n")), "cells")
    targets = staged(propagate(cells, quota, rounds), "targets")
    placed = linked.join(targets, ["g1", "g2", "part"], "left").select(
        "doc_id", "size", "text_crc32", "g1", "g2", "uid", F.coalesce("target", F.lit(-1)).alias("label"))

    # Rank within a shard (-1: no place yet): sorted by shard and group, numbered
    # in each partition, and set off by the partitions before it.
    order = ["label", "g1", "g2", "uid"]
    lined = staged(placed.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("at", F.monotonically_increasing_id()), "lined")
    lined = lined.withColumn("file", F.shiftright("at", 33))
    per_file = staged(lined.groupBy("label", "file").agg(F.min("at").alias("lo"), F.count(F.lit(1)).alias("n")), "files")
    before = F.sum("n").over(Window.partitionBy("label").orderBy("file")) - F.col("n")
    offsets = per_file.select("label", "file", "lo", before.alias("before"))
    load = {r["label"]: r["n"] for r in per_file.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    # One row a shard and partition written: labels + partitions at most.
    ranked = lined.join(F.broadcast(offsets), ["label", "file"]).withColumn(
        "rank", F.col("before") + F.col("at") - F.col("lo"))

    # Rows without a place fill the shards' spaces in order, so that groups
    # among them stay together but where a space ends.
    own = [load.get(s, 0) for s in range(shards)]
    space = list(accumulate(q - o for q, o in zip(quota, own)))
    spaces = F.array(*[F.lit(x).cast("long") for x in space])
    free = F.col("label") < 0
    out = ranked.withColumn("shard", F.when(free, F.size(F.filter(spaces, lambda x: x <= F.col("rank"))))
                            .otherwise(F.col("label")).cast("int"))
    slot = F.when(free, F.col("rank") - _pick([0, *space[:-1]], F.col("shard")) + _pick(own, F.col("shard"))
                  ).otherwise(F.col("rank"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                      slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
