"""Shards of even bytes that keep linked documents together, by balanced label propagation.

Documents start in a shard by hash. In a round every linked document proposes to move to the shard that
holds most of its group's bytes; proposals to a shard are taken in a fixed order while they fit into its capacity, what
leaves it in the same round included. A shard without room is passed over until it has some again, and the rest of
its groups gathers elsewhere in the next rounds. At last what cuts no link wherever it is, documents without links and
small groups that are whole, fills every shard to the same size, from the largest size band to the smallest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weblens.llm.common import fresh, partitions, released, running, staged

SHARDS = 16
SLACK = 1.05
BANDS = (32768, 8192, 2048, 512, 128)


def text_bytes() -> Column:
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1


def _table(values: dict[int, object], column: str = "shard") -> Column:
    """The entry of ``values`` for a column of small numbers."""
    pairs = [F.lit(x) for item in sorted(values.items()) for x in item]
    return F.element_at(F.create_map(*pairs), F.col(column))


def accepted_cells(flows: list[tuple[int, int, int, int]], loads: dict[int, int], capacity: float) -> dict[int, int]:
    """For every shard that moves lead to, up to which cell they are accepted (-1: none of them).

    ``flows`` are (to, from, cell, bytes). Bytes that leave a shard in the same round make room in it. Everything is
    accepted at first; a shard that would end beyond the capacity takes back its last cells, which may leave
    other shards fuller, until none has to: cells are only ever taken back, so this ends.
    """
    cells: dict[int, dict[int, int]] = {}
    for to, _, cell, size in flows:
        cells.setdefault(to, {}).setdefault(cell, 0)
        cells[to][cell] += size
    limit = {to: max(own) for to, own in cells.items()}
    while True:
        leaving = dict.fromkeys(loads, 0)
        for to, source, cell, size in flows:
            if cell <= limit[to]:
                leaving[source] += size
        changed = False
        for to, own in cells.items():
            room, reached, cut = capacity - loads[to] + leaving[to], 0, -1
            for cell in sorted(own):
                reached += own[cell]
                if reached > room or cell > limit[to]:
                    break
                cut = cell
            if cut < limit[to]:
                limit[to], changed = cut, True
        if not changed:
            return limit


def propagate(linked: DataFrame, capacity: int, shards: int, rounds: int) -> DataFrame:
    """``linked`` (group, size, ...) with ``shard``; no shard ends a round with more than ``capacity`` bytes through moves.

    A round joins the documents with the heaviest shard of their group, of those with room or with bytes about
    to leave. The moves towards a shard are cut by a histogram of 1,024 cells (32 of groups by 32 of rows), so that a
    group larger than the room moves in part. Every round is staged; it ends when next to nothing moved.
    """
    names = linked.columns
    cell = (F.pmod(F.xxhash64("group"), F.lit(32)) * 32
            + F.pmod(F.xxhash64("doc_id", "group"), F.lit(32))).cast("int")
    now = staged(linked.withColumn("_cell", cell).withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", F.lit("start")), F.lit(shards)).cast("int")), "labels")
    full: set[int] = set()  # took back moves in the round before and has no room
    for _ in range(rounds):
        loads = dict.fromkeys(range(shards), 0) | {r[0]: r[1] for r in now.groupBy("shard").agg(F.sum("size")).collect()}
        capacity = max(capacity, max(loads.values()))  # chance may start a shard beyond it
        full = {s for s in full if loads[s] >= 0.98 * capacity}
        open_ = ~F.col("shard").isin(list(full)) if full else F.lit(True)
        weights = now.groupBy("group", "shard").agg(F.sum("size").alias("_weight")).withColumn("_open", open_)
        # Groups that already are in one shard stay.
        best = (weights.groupBy("group").agg(F.max(F.when(F.col("_open"), F.struct("_weight", -F.col("shard")))).alias("_best"),
                                             F.count(F.lit(1)).alias("_shards"))
                .filter("_shards > 1 AND _best IS NOT NULL").select(F.col("group").alias("_group"), (-F.col("_best.col2")).alias("_to")))
        wanted = staged(now.join(best, F.col("group") == F.col("_group"), "left").drop("_group")
                        .withColumn("_to", F.when(F.col("_to") != F.col("shard"), F.col("_to"))), "proposals")
        flows = [tuple(r) for r in wanted.filter("_to IS NOT NULL").groupBy("_to", "shard", "_cell").agg(F.sum("size")).collect()]
        limit = accepted_cells(flows, loads, capacity)
        moved = sum(size for to, _, c, size in flows if c <= limit[to])
        full |= {to for to, _, c, _ in flows if c > limit[to]}
        if not moved:
            released(wanted)
            break
        before, now = now, staged(wanted.withColumn("shard", F.when(F.col("_cell") <= _table(limit, "_to"), F.col("_to"))
                                                    .otherwise(F.col("shard"))).drop("_to"), "labels")
        released(before, wanted)
        if moved < 0.0005 * sum(loads.values()):
            break
    return now.select(*names, "shard")


def fill(units: DataFrame, loads: dict[int, int]) -> DataFrame:
    """``units`` (group, size) with ``shard``, so that all shards end near the same size.

    Inside a size band the units, ordered by hash, lie end to end, and a shard gets the stretch it
    lacks; what a band leaves uneven, at most a unit a shard, the next smaller band evens out.
    """
    band = sum((F.col("size") < b).cast("int") for b in BANDS)
    laid = running(units.withColumn("_band", band).withColumn("_mix", F.xxhash64("group", F.lit("fill"))),
                   ["_band"], ["_mix", "group"], "_start", value="size", label="laid")
    laid = staged(laid, "laid-out")
    totals = {r[0]: r[1] for r in laid.groupBy("_band").agg(F.sum("size")).collect()}
    middle = F.col("_start") + F.col("size") / 2
    shard = F.lit(None).cast("int")
    loads = dict(loads)
    left = sum(totals.values())
    for b in sorted(totals):
        level = (sum(loads.values()) + left) / len(loads)
        lack = {s: max(0.0, level - load) for s, load in loads.items()}
        scale = totals[b] / (sum(lack.values()) or 1.0)
        reached, here = 0.0, F.lit(max(lack, key=lack.get))
        ends = []
        for s in sorted(loads):
            reached += lack[s] * scale
            ends.append((s, reached))
        for s, end in reversed(ends):
            if lack[s] > 0:
                here = F.when(middle < end, F.lit(s)).otherwise(here)
        shard = F.when(F.col("_band") == b, here).otherwise(shard)
        got = laid.filter(F.col("_band") == b).groupBy(here.alias("s")).agg(F.sum("size")).collect()
        for s, amount in got:
            loads[s] += amount
        left -= totals[b]
    return laid.select(F.col("group").alias("_unit"), shard.cast("int").alias("_filled"))


def place_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = 20) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) with all their columns, shard and slot.

    Documents with equal texts are linked (NULL counts as empty). A shard's capacity for linked documents is SLACK times
    an even part of all bytes. Then the documents without links and, where those are few, small groups that are whole
    in one shard fill every shard to the same size; neither cuts a link wherever it is put. Slots number the documents
    of a shard by doc_id, NULL first; rows with one doc_id have slots of their own. Shards are found without the texts,
    which then move once, by the number of their row; ``write_shards`` writes them in order. Columns named shard and
    slot are replaced. No rows give no rows.
    """
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    row = fresh(docs, "_row")
    numbered = staged(docs.select(*[F.col(f"`{c}`") for c in kept]).withColumn(row, F.monotonically_increasing_id()), "numbered")
    base = staged(numbered.select(
        F.col(row).alias("_of"), "doc_id", text_bytes().alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("group")), "texts")
    total = base.agg(F.sum("size")).first()[0] or 0
    several = staged(base.groupBy("group").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
                     .select(F.col("group").alias("_several")), "linked-groups")
    same = F.col("group") == F.col("_several")
    linked = staged(propagate(base.join(several, same, "left_semi"), max(1, int(SLACK * total / shards)), shards, rounds), "linked")
    single = base.join(several, same, "left_anti")

    # What fills: documents without links, and as many of the small whole groups, by hash, as every shard has to
    # give to end below the level, a tenth of all bytes at least.
    alone = single.agg(F.sum("size")).first()[0] or 0
    groups = (linked.groupBy("group").agg(F.sum("size").alias("size"), F.min("shard").alias("_low"), F.max("shard").alias("_high"))
              .filter((F.col("_low") == F.col("_high")) & (F.col("size") <= total // shards // 32 + 1)).select("group", "size", "_low"))
    movable = {r[0]: r[1] for r in groups.groupBy("_low").agg(F.sum("size")).collect()}
    held = {r[0]: r[1] for r in linked.groupBy("shard").agg(F.sum("size")).collect()}
    share = max([0.1 * total - alone > 0 and (0.1 * total - alone) / max(1, sum(movable.values()))]
                + [(held[s] - 0.97 * total / shards) / size for s, size in movable.items()] + [0])
    chosen = groups.filter(F.pmod(F.xxhash64("group", F.lit("movable")), F.lit(1 << 20)) < int(min(1.0, share) * (1 << 20))).select("group", "size")
    units = staged(single.select("group", "size").union(chosen), "units")
    moving = units.select(F.col("group").alias("_moving"))
    loads = dict.fromkeys(range(shards), 0) | {r[0]: r[1] for r in linked.join(moving, F.col("group") == F.col("_moving"), "left_anti")
                                               .groupBy("shard").agg(F.sum("size")).collect()}
    filled = fill(units, loads)
    every = linked.union(single.withColumn("shard", F.lit(None).cast("int")))
    found = (every.join(filled, F.col("group") == F.col("_unit"), "left")
             .select("_of", "doc_id", "text_crc32", F.coalesce("_filled", "shard").alias("shard")))
    of = fresh(numbered, "_of")
    found = (running(found, ["shard"], ["doc_id", "text_crc32"], "slot", label="slots")
             .select(F.col("_of").alias(of), "shard", "slot"))
    return numbered.join(found, F.col(row) == F.col(of)).select(*[F.col(f"`{c}`") for c in kept], "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, rounds: int = 20) -> None:
    """Write ``place_documents`` as Parquet, a folder per shard, its files in order of the slots."""
    placed = place_documents(docs, shards, rounds)
    (placed.repartitionByRange(partitions(docs.sparkSession), "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = 20) -> DataFrame:
    """A row per row of ``place_documents``: doc_id, size, text_crc32, law (``bytes``), shard, slot, grown_shard."""
    return place_documents(docs, shards, rounds).select(
        "doc_id", text_bytes().alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
