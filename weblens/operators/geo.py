"""Region of an IPv4 address from a table of non-overlapping ranges ``lo, hi, region``.

Ranges are cut at the borders of /16 blocks, and every block is divided into cells whose size fits the
number of ranges in it: about two cells per range. An address then meets the few ranges of its cell
through an equi-join, whether a block holds one range or thousands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weblens.functions.net import ipv4_to_long

BLOCK_BITS = 16


def _shift(number: Column, bits: Column) -> Column:
    return F.call_function("shiftright", number, bits)


def block_ranges(ranges: DataFrame) -> DataFrame:
    """The parts of the ranges in each /16 block, with ``bits``, the cell size of the block as a power of two."""
    first, last = F.shiftright("lo", BLOCK_BITS), F.shiftright("hi", BLOCK_BITS)
    start = F.shiftleft("block", BLOCK_BITS)
    in_block = F.count(F.lit(1)).over(Window.partitionBy("block"))
    bits = F.greatest(F.lit(0), F.ceil(F.lit(BLOCK_BITS - 1) - F.log2(in_block))).cast("int")
    return (ranges.select("lo", "hi", "region", F.explode(F.sequence(first, last)).alias("block"))
            .select("block", "region", F.greatest("lo", start).alias("lo"),
                    F.least("hi", start + (2 ** BLOCK_BITS - 1)).alias("hi"))
            .withColumn("bits", bits))


def range_cells(blocks: DataFrame) -> DataFrame:
    """One row per part of a range and cell it touches."""
    cells = F.sequence(_shift(F.col("lo"), F.col("bits")), _shift(F.col("hi"), F.col("bits")))
    return blocks.select("block", F.explode(cells).alias("cell"), "lo", "hi", "region")


def overlapping_ranges(ranges: DataFrame) -> DataFrame:
    """Parts of ranges that start before an earlier range of their block ends; empty for a valid table."""
    earlier = Window.partitionBy("block").orderBy("lo", "hi").rowsBetween(
        Window.unboundedPreceding, -1)
    return (block_ranges(ranges).withColumn("reached", F.max("hi").over(earlier))
            .filter(F.col("lo") <= F.col("reached")).select("lo", "hi", "region"))


def check_ranges(ranges: DataFrame) -> None:
    """Raise ValueError unless all ranges are 0 <= lo <= hi < 2^32 and none overlaps another."""
    valid = (F.col("lo") >= 0) & (F.col("lo") <= F.col("hi")) & (F.col("hi") < 2 ** 32)
    if not ranges.filter(~F.coalesce(valid, F.lit(False))).isEmpty():
        raise ValueError("an IP range is not within 0 <= lo <= hi < 2^32")
    if not overlapping_ranges(ranges).isEmpty():
        raise ValueError("the IP ranges overlap")


def _checked(ranges: DataFrame) -> DataFrame:
    """``ranges``, failing as they are read unless 0 <= lo <= hi < 2^32."""
    valid = F.coalesce((F.col("lo") >= 0) & (F.col("lo") <= F.col("hi")) & (F.col("hi") < 2 ** 32), F.lit(False))
    message = F.lit("an IP range is not within 0 <= lo <= hi < 2^32")
    return ranges.select(F.when(valid, F.col("lo")).otherwise(F.raise_error(message).cast("bigint")).alias("lo"), "hi", "region")


def _free(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def with_region(df: DataFrame, ranges: DataFrame, ip: str = "ip", out: str = "region") -> DataFrame:
    """Add the region of ``ip`` as ``out``; NULL for an unknown or malformed address.

    One lazy plan, nothing runs while it is built; ranges that are invalid or overlap fail the query that reads them,
    in the same pass that cuts them. The cell sizes of the blocks are broadcast: there are at most 65,536
    blocks. The cells are joined by (block, cell) without a hint: Spark broadcasts them while their bytes are below its
    threshold, as estimated or as AQE measures them, and otherwise joins by shuffle, where AQE splits a cell
    with much of the traffic. Rows whose address has no cell spread by their hash.
    """
    names = {n: _free(df, n) for n in ("_ip", "_block", "_bits", "_cell", "_of", "_in_block", "_in_cell", "_lo", "_hi", "_region")}
    at = {n: F.col(name) for n, name in names.items()}
    parts = block_ranges(_checked(ranges))
    reached = F.max("hi").over(Window.partitionBy("block").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1))
    blocks = parts.withColumn("region", F.when(F.col("lo") <= reached, F.raise_error(F.lit("the IP ranges overlap")).cast("string"))
                               .otherwise(F.col("region")))
    sizes = parts.groupBy(F.col("block").alias(names["_of"])).agg(F.first("bits").alias(names["_bits"]))
    cells = range_cells(blocks).select(*[F.col(n).alias(names[to]) for n, to in (
        ("block", "_in_block"), ("cell", "_in_cell"), ("lo", "_lo"), ("hi", "_hi"), ("region", "_region"))])

    # Maps have no hash; the rest of the row spreads it. No range has a negative cell.
    row_hash = F.xxhash64(F.lit(0), *[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and kind != "variant"])
    keyed = (df.withColumn(names["_ip"], ipv4_to_long(ip))
             .withColumn(names["_block"], F.coalesce(F.shiftright(at["_ip"], BLOCK_BITS), F.lit(-1)))
             .join(F.broadcast(sizes), at["_block"] == at["_of"], "left")
             .withColumn(names["_cell"], F.coalesce(_shift(at["_ip"], at["_bits"]), -1 - F.pmod(row_hash, F.lit(1 << 30)))))
    hit = (at["_block"] == at["_in_block"]) & (at["_cell"] == at["_in_cell"]) & at["_ip"].between(at["_lo"], at["_hi"])
    kept = [F.col(f"`{c}`") for c in df.columns if c != out]
    return keyed.join(cells, hit, "left").select(*kept, at["_region"].alias(out))
