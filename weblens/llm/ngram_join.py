"""Jaccard join of word n-gram sets with a count-vector R-tree.

Shingles are hashed into groups, about one for every two shingles; how many fall into each is a point, and the overlap
of two sets is at most the sum of the smaller coordinates. R-trees over such points give, for a document, the partners whose bound
reaches what the threshold asks for; survivors are verified on the sets themselves.

One tree over a corpus fits no task, so trees are built over blocks that lose no pair. A scheme for a range of
sizes cuts the hash space into m parts, m greater than the most shingles in which two linked sets of that range
can differ; then they agree in the whole content of a part, and documents with equal content of a part form a
block. A shared passage does not bring documents together, only a shared part does.

First every document is paired with the partner of the highest bound in the trees of its tiles, which are linear in
the size of a block. In blocks in which these pairs, once verified, leave more than one component, the rest meets the
largest component and itself: first a few tiles each, for a forest of pairs that would join them all, then, where that
failed, every tile, for all pairs. Where a round searched a block as a whole, the next one takes up only what had a
partner. A pair is offered by the first block it shares, not by every one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weblens.llm.common import bounded_batches, small_enough, staged, with_ids
from weblens.llm.components import components
from weblens.llm.wordhash import mix, set_digest, shingle_sets, text_slices

GROUPS = (64, 4096)  # the fewest and the most groups, powers of two
FANOUT = 16
TILE = 512
FIRST = 16  # blocks of a document by which pairs known from an earlier block are told
RANGE = 1.35  # sizes of one scheme: from low to below low * RANGE
_U = np.uint64


class Schemes:
    """The parts for each range of sizes, for linked sets: per * |A and B| >= num * |A or B|."""

    def __init__(self, num: int, per: int, longest: int = 1 << 40):
        self.num, self.per = num, per
        self.lows = [1]
        while self.lows[-1] < longest:
            self.lows.append(max(self.lows[-1] + 1, math.ceil(self.lows[-1] * RANGE)))
        self._lows = np.array(self.lows)

    def differing(self, smaller: int) -> int:
        """The most shingles in one set only, where the smaller of two linked sets has ``smaller``."""
        larger = smaller * self.per // self.num
        shared = -(-self.num * (smaller + larger) // (self.num + self.per))
        return max(0, smaller + larger - 2 * shared, 2 * smaller - 2 * -(-self.num * 2 * smaller // (self.num + self.per)))

    def only_equal(self, n: int) -> bool:
        """Whether a set of ``n`` links with equal sets alone."""
        return not any(self.differing(k) for k in range(-(-n * self.num // self.per), n + 1))

    def of(self, n: int) -> list[tuple[int, int, int]]:
        """(scheme, parts, most differing) of the schemes in which a set of ``n`` can meet a linked one: those
        whose range holds a size between its smallest partner's and its own."""
        last = int(np.searchsorted(self._lows, n, side="right")) - 1
        first = int(np.searchsorted(self._lows, -(-n * self.num // self.per), side="right")) - 1
        out = []
        for s in range(first, last + 1):
            # One more than the exact bound: it rises by at most one between sizes, whatever the rounding.
            most = self.differing(self.lows[s + 1] - 1) + 1
            out.append((s, self._parts(s, most), most))
        return out

    @lru_cache(maxsize=None)
    def _parts(self, scheme: int, most: int) -> int:
        """Enough parts that the smallest set of the range surely has more than ``most`` that are not empty: their
        expected number less three deviations. Sets of a few shingles may still have too few of them."""
        n, parts = self.lows[scheme], most + 2
        if n <= 32:  # so many that hardly any two shingles share one
            return 8 * n + 8
        while parts < 2 * most + 8:
            empty = parts * math.exp(-n / parts)
            if parts - empty - 3 * math.sqrt(empty) > most:
                break
            parts += max(1, parts // 100)
        return parts


def part_keys(hashes: np.ndarray, schemes: Schemes) -> np.ndarray:
    """A key for the content of every part of a set, in every scheme of its size.

    Empty parts are left out unless the set has too few others for one of them to be surely unchanged. Sets that
    link with equal ones alone have no keys: their digest settles it.
    """
    keys = []
    n = len(hashes)
    if n < 64 and schemes.only_equal(n):
        return np.zeros(0, _U)
    spread = mix(hashes ^ _U(0xA24BAED4963EE407))
    for scheme, parts, most in schemes.of(n):
        part = (spread >> _U(32)) * _U(parts) >> _U(32)
        sums = np.zeros(parts, dtype=_U)
        np.add.at(sums, part.astype(np.int64), mix(hashes))
        sizes = np.bincount(part.astype(np.int64), minlength=parts)
        mine = np.flatnonzero(sizes) if (sizes > 0).sum() > most else np.arange(parts)
        keys.append(mix(mix(sums[mine] + sizes[mine].astype(_U)) + mine.astype(_U) * _U(0x9FB21C651E98DF25)
                        + _U((scheme + 1) * 0xD6E8FEB86659FD93 % 2 ** 64)))
    return np.concatenate(keys) if keys else np.zeros(0, _U)


def groups_of(n: int) -> int:
    """How many groups a set of ``n`` has; more than half as many as its shingles, within GROUPS."""
    return min(GROUPS[1], max(GROUPS[0], 1 << max(0, n // 2 - 1).bit_length()))


def points(hashes: np.ndarray) -> bytes:
    """The size of a set (8 bytes), and its counts, of one byte each; what is above 255 shows as size beyond their sum."""
    groups = groups_of(len(hashes))
    counts = np.bincount((mix(hashes) >> _U(65 - groups.bit_length())).astype(np.int64), minlength=groups)
    return np.int64(len(hashes)).tobytes() + np.minimum(counts, 255).astype(np.uint8).tobytes()


def point_table(encoded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(counts in as many groups as the set with the fewest has, sizes). Groups of half as many are sums of two."""
    groups = min(len(e) for e in encoded) - 8
    if all(len(e) == groups + 8 for e in encoded):
        table = np.frombuffer(b"".join(encoded), np.uint8).reshape(len(encoded), -1)
        return table[:, 8:].astype(np.int32), table[:, :8].copy().view(np.int64)[:, 0]
    counts = np.zeros((len(encoded), groups), dtype=np.int32)
    for row, e in enumerate(encoded):
        counts[row] = np.frombuffer(e, np.uint8, offset=8).reshape(groups, -1).sum(axis=1)
    return counts, np.array([np.frombuffer(e, np.int64, 1)[0] for e in encoded])


class CountTree:
    """An R-tree over count vectors, bulk loaded by size and then by the widest coordinates."""

    def __init__(self, counts: np.ndarray, totals: np.ndarray, num: int, per: int):
        self.counts, self.totals, self.num, self.per = counts, totals, num, per
        self.spare = totals - counts.sum(axis=1, dtype=np.int64)  # what the bytes of the counts could not hold
        order = np.arange(len(totals))
        if len(totals) > FANOUT:
            wide = np.argsort(-counts.var(axis=0), kind="stable")[:2]
            order = np.lexsort((counts[:, wide[1]], counts[:, wide[0]], (self.totals / max(1, FANOUT)).astype(np.int64)))
        self.levels = [(order, counts[order], self.totals[order], self.totals[order], self.spare[order])]
        while len(self.levels[-1][0]) > FANOUT:
            _, high, least, most, spare = self.levels[-1]
            cuts = np.arange(0, len(high), FANOUT)
            self.levels.append((cuts, np.maximum.reduceat(high, cuts), np.minimum.reduceat(least, cuts),
                                np.maximum.reduceat(most, cuts), np.maximum.reduceat(spare, cuts)))

    def _bound(self, row: int, high: np.ndarray, spare: np.ndarray) -> np.ndarray:
        """The most shingles that ``row`` shares with what is in the boxes."""
        return np.minimum(high, self.counts[row]).sum(axis=1, dtype=np.int64) + np.minimum(spare, self.spare[row])

    def search(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose bound allows a link with ``row``, and the largest similarity the bound allows."""
        total = int(self.totals[row])
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            _, high, least, most, spare = self.levels[depth]
            at = at[(least[at] * self.num <= total * self.per) & (most[at] * self.per >= total * self.num)]
            bound = self._bound(row, high[at], spare[at])
            may = (self.num + self.per) * bound >= self.num * (total + least[at])
            at, bound = at[may], bound[may]
            if depth:
                at = (at[:, None] * FANOUT + np.arange(FANOUT)).reshape(-1)
                at = at[at < len(self.levels[depth - 1][0])]
        totals = self.levels[0][2][at]
        return self.levels[0][0][at], bound / np.maximum(1, total + totals - bound)

    def search_all(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(row, what ``search`` finds for it) of the rows that find another; a tree of one box is read once for all."""
        if len(self.levels) > 1:
            for row in range(len(self.totals)):
                found, bound = self.search(row)
                if len(found) > 1:
                    yield row, found, bound
            return
        mine, theirs = self.totals[:, None], self.totals
        bound = np.minimum(self.counts[:, None], self.counts).sum(axis=2, dtype=np.int64) + np.minimum(self.spare[:, None], self.spare)
        may = ((theirs * self.num <= mine * self.per) & (theirs * self.per >= mine * self.num)
               & ((self.num + self.per) * bound >= self.num * (mine + theirs)))
        for row in np.flatnonzero(may.sum(axis=1) > 1):
            found = np.flatnonzero(may[row])
            yield int(row), found, bound[row, found] / np.maximum(1, self.totals[row] + theirs[found] - bound[row, found])


BEST, FOREST, ALL = "best", "forest", "all"


class Earlier:
    """Which rows of a block have met in an earlier one, by the first blocks of each."""

    def __init__(self, earlier: pa.ListArray):
        sizes = np.asarray(earlier.value_lengths())
        blocks, codes = np.unique(np.asarray(earlier.flatten()), return_inverse=True)
        self.table = np.zeros((len(sizes), sizes.max(initial=0)), dtype=np.int64)  # 0: none
        self.table[np.arange(self.table.shape[1]) < sizes[:, None]] = codes + 1
        self.marked = np.zeros(len(blocks) + 1, dtype=bool)

    def met(self, row: int, others: np.ndarray) -> np.ndarray:
        self.marked[self.table[row]] = True
        self.marked[0] = False
        found = self.marked[self.table[others]].any(axis=1)
        self.marked[self.table[row]] = False
        return found


def block_pairs(ids: np.ndarray, sides: np.ndarray, encoded: list[bytes], earlier: pa.ListArray, num: int, per: int,
                which: str) -> list[tuple[int, int, float]]:
    """(row id, partner id, bound on the similarity) of pairs from different ``sides`` of a block, from its R-tree,
    without those that share an ``earlier`` block.

    BEST: for each row the partner with the highest bound, the smallest of equals. FOREST: the pairs of highest bounds
    that join the sides, none that closes a circle. ALL: all partners with a smaller id."""
    tree, before = CountTree(*point_table(encoded), num, per), None
    out: list[tuple[int, int, float]] = []
    for row, found, bound in tree.search_all():
        other = (sides[found] != sides[row]) & ((ids[found] != ids[row]) if which == BEST else (ids[found] < ids[row]))
        if not other.any():
            continue
        before = before or Earlier(earlier)
        other[other] = ~before.met(row, found[other])
        found, bound = found[other], bound[other]
        if which != BEST:
            out += [(int(ids[row]), int(i), float(x)) for i, x in zip(ids[found], bound)]
        elif len(found):
            k = np.lexsort((ids[found], -bound))[0]
            out.append((int(ids[row]), int(ids[found[k]]), float(bound[k])))
    if which != FOREST:
        return out
    side = dict(zip(ids.tolist(), sides.tolist()))
    root = {s: s for s in side.values()}

    def find(s: int) -> int:
        while root[s] != s:
            root[s] = s = root[root[s]]
        return s

    forest = []
    for a, b, bound in sorted(out, key=lambda pair: (-pair[2], pair[0], pair[1])):
        x, y = find(side[a]), find(side[b])
        if x != y:
            root[x] = y
            forest.append((a, b, bound))
    return forest


def shingled(docs: DataFrame, size: int, num: int, per: int) -> DataFrame:
    """doc_id, n_shingles, digest (of the set), keys and counts of every whole text."""
    bounded_batches(docs.sparkSession)
    schema = "doc_id BIGINT, n_shingles BIGINT, digest BINARY, keys ARRAY<BIGINT>, counts BINARY"

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schemes = Schemes(num, per)
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                sets = shingle_sets(data, offsets, size, lower=True)
                n = [len(s) for s in sets]
                digests = [set_digest(s) for s in sets]
                keys = [part_keys(s, schemes) if len(s) else s for s in sets]
                ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(sets)).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate(keys).view(np.int64))),
                     pa.array([points(s) for s in sets], pa.binary())],
                    names=["doc_id", "n_shingles", "digest", "keys", "counts"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(describe, schema)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """The slices of batches that have one value in the first column, which is sorted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.asarray(batch.column(0))
        cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]]).tolist()
        for i, j in zip(cuts[:-1], cuts[1:]):
            if held and held[-1].column(0)[0].as_py() != int(key[i]):
                yield held
                held = []
            held.append(batch.slice(i, j - i))
    if held:
        yield held


def _candidates(blocks: DataFrame, num: int, per: int, which: str) -> DataFrame:
    """Distinct pairs (a < b) from the R-trees of ``blocks`` (block, id, side, counts, earlier, members), each with one
    ``piece`` of a block, the largest that offers it; which pairs, as for ``block_pairs``, BEST over all blocks,
    and of a FOREST one pair, of the highest bound, for two components. ``earlier`` are blocks of the id before this one.

    For best partners a block of more than TILE members is cut into tiles by hash, and every tile and its next one are
    a piece. Otherwise its largest component (``top``, with ``inside`` members) and the rest are cut. For a forest a
    tile of the rest meets one tile of the largest component, and the next one of the rest: pieces in proportion to
    the block. For ALL every tile of the rest meets every tile of both. A tile meets itself in any of its pieces.
    """
    def tiles(rows: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(rows / TILE)).cast("int")

    def each(count: Column, met: Callable[[Column], Column]) -> Column:
        return F.transform(F.sequence(F.lit(0), count - 1), met)

    def met(kind: int, one: Column, other: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), one.alias("one"), other.alias("other"))

    mine, spread = F.col("_mine"), F.xxhash64("id")
    if which == BEST:
        cut = (blocks.withColumn("_tiles", tiles(F.col("members"))).withColumn("_mine", F.pmod(spread, F.col("_tiles")).cast("int"))
               .withColumn("_met", F.explode(F.array_distinct(F.array(mine, F.pmod(mine - 1, F.col("_tiles"))))))
               .withColumn("piece", F.xxhash64("block", "_met")))
    else:
        inner, top, rest = F.col("side") == F.col("top"), tiles(F.col("inside")), tiles(F.col("members") - F.col("inside"))
        # Kind 0: a tile of the rest and one of the largest component; kind 1: two of the rest.
        def of_rest(k: Column) -> Column:
            return met(1, F.least(mine, k), F.greatest(mine, k))

        if which == FOREST:
            pieces_of_rest = F.array_distinct(F.array(met(0, mine, F.pmod(mine, top)), of_rest(F.pmod(mine + 1, rest)),
                                                      of_rest(F.pmod(mine - 1, rest))))
            # The tiles of the rest that meet tile ``mine`` of the largest component: there may be none.
            of_inner = F.when(mine < rest, F.transform(F.sequence(mine, rest - 1, top), lambda k: met(0, k, mine)))
        else:
            pieces_of_rest = F.concat(each(top, lambda k: met(0, mine, k)), each(rest, of_rest))
            of_inner = each(rest, lambda k: met(0, k, mine))
        pieces_of_rest = F.filter(pieces_of_rest, lambda p: (p["kind"] == 0) | (p["one"] < p["other"]))
        cut = (blocks.withColumn("_mine", F.pmod(spread, F.when(inner, top).otherwise(rest)).cast("int"))
               .withColumn("_met", F.explode(F.when(inner, of_inner).otherwise(pieces_of_rest)))
               .withColumn("piece", F.xxhash64("block", "_met.kind", "_met.one", "_met.other")))
    pieces = cut.select("piece", "id", "side", "counts", "earlier")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 7
            rows.clear()
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              names=["id", "partner", "bound", "one", "other", "members", "piece"])

        for run in _runs(batches):
            if sum(r.num_rows for r in run) < 2:
                continue
            ids, sides = (np.concatenate([np.asarray(r.column(k)) for r in run]) for k in (1, 2))
            if (sides == sides[0]).all():
                continue
            encoded, earlier = [x for r in run for x in r.column(3).to_pylist()], pa.concat_arrays([r.column(4) for r in run])
            piece = run[0].column(0)[0].as_py()
            side = dict(zip(ids.tolist(), sides.tolist()))
            rows += [(a, b, bound, side[a], side[b], len(ids), piece)
                     for a, b, bound in block_pairs(ids, sides, encoded, earlier, num, per, which)]
            if len(rows) > 20_000:
                yield flush()
        yield flush()

    pairs = (pieces.repartition("piece").sortWithinPartitions("piece")
             .mapInArrow(search, "id BIGINT, partner BIGINT, bound DOUBLE, one BIGINT, other BIGINT, members BIGINT, piece BIGINT"))
    if which == BEST:
        pairs = (pairs.groupBy("id").agg(F.max(F.struct("bound", -F.col("partner"), "members", "piece")).alias("m"))
                 .select("id", (-F.col("m.col2")).alias("partner"), "m.members", "m.piece"))
    if which == FOREST:  # many blocks offer a pair of the same two components
        pairs = (pairs.groupBy(F.least("one", "other").alias("_one"), F.greatest("one", "other").alias("_other"))
                 .agg(F.max(F.struct("bound", "id", "partner", "members", "piece")).alias("m"))
                 .select("m.id", "m.partner", "m.members", "m.piece"))
    return (pairs.groupBy(F.least("id", "partner").alias("a"), F.greatest("id", "partner").alias("b"))
            .agg(F.max(F.struct("members", "piece")).alias("m")).select("a", "b", "m.piece"))


def _unsettled(rows: DataFrame, near: DataFrame) -> DataFrame:
    """The ``rows`` of blocks that were not searched as a ``whole``, and of the others those whose side is among ``near``."""
    if small_enough(near):
        near = F.broadcast(near)
    return rows.join(near, F.col("side") == F.col("near"), "left").filter("NOT whole OR near IS NOT NULL").drop("near")


def _verified(pairs: DataFrame, docs: DataFrame, size: int, num: int, per: int) -> DataFrame:
    """The pairs (a, b, piece) whose sets, made again from the whole texts, are linked.

    The sets a piece needs come to it once, however many pairs it has.
    """
    needed = staged(pairs.select("piece", F.explode(F.array("a", "b")).alias("id")).distinct(), "needed")
    ids = staged(needed.select("id").distinct(), "candidate-ids")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                found = [s.tobytes() for s in shingle_sets(data, offsets, size, lower=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(found)), pa.array(found, pa.binary())],
                                                 names=["id", "shingles"])

    content = (with_ids(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), ids)
               .mapInArrow(sets, "id BIGINT, shingles BINARY").withColumnRenamed("id", "_of"))
    rows = (needed.join(content, F.col("id") == F.col("_of"))
            .select("piece", F.col("id").alias("a"), F.lit(None).cast("bigint").alias("b"), "shingles")
            .union(pairs.select("piece", "a", "b", F.lit(None).cast("binary"))))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            have: dict[int, list[np.ndarray]] = {}
            good: list[tuple[int, int]] = []
            for a, b, shingles in (row for r in run for row in zip(*(r.column(k).to_pylist() for k in (1, 2, 3)))):
                if b is None:  # an id with several texts has several sets
                    have.setdefault(a, []).append(np.frombuffer(shingles, _U))
                elif any(_linked(x, y, num, per) for x in have.get(a, []) for y in have.get(b, [])):
                    good.append((a, b))
            table = np.array(good, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(table[:, 0].copy()), pa.array(table[:, 1].copy())], names=["a", "b"])

    return (rows.repartition("piece").sortWithinPartitions("piece", F.asc_nulls_first("b"))
            .mapInArrow(compare, "a BIGINT, b BIGINT"))


def _linked(x: np.ndarray, y: np.ndarray, num: int, per: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return per * both >= num * (len(x) + len(y) - both)


def jaccard_components(docs: DataFrame, size: int = 4, num: int = 85, per: int = 100) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Sets are the distinct ``size``-word shingles of the text with A-Z in lower case; fewer words are one shingle.
    Sets link when per * |A and B| >= num * |A or B|. A NULL or empty text, or one without words, has no
    shingles and links with nothing. Rows with one doc_id are one node: a link of either is a link of the id. A row
    without doc_id has n_shingles and no component. No rows give no rows; other columns are left. Sets are
    compared by 64-bit shingle hashes, equal ones found by 128-bit digests.
    """
    every = staged(shingled(docs, size, num, per), "shingled")
    known = every.filter("doc_id IS NOT NULL AND n_shingles > 0")
    # One document per distinct set; copies never reach the join.
    classes = staged(known.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    copies = F.col("rep") != F.col("doc_id")
    spare = staged(known.select("doc_id", "digest").join(
        classes.filter("copies > 1").select(F.col("digest").alias("_d"), "rep"), F.col("digest") == F.col("_d"))
        .filter(copies).select("doc_id").distinct(), "copies")
    # An id that is a copy in one row and first of its set in another stays, with all its rows.
    spare = staged(spare.join(classes.select("rep"), F.col("doc_id") == F.col("rep"), "left_anti"), "spare")
    heads = with_ids(known, spare, keep=False)
    parts = heads.select(F.col("doc_id").alias("id"), F.explode("keys").alias("block")).select("block", "id")

    # Most parts have one document. Minima and sums are merged before they move, so no task gets a whole block.
    several = staged(parts.groupBy("block").agg(F.min("id").alias("_least"), F.max("id").alias("_most"))
                     .filter("_least < _most").select(F.col("block").alias("_block")), "several")
    shared = staged(parts.join(several, F.col("block") == F.col("_block"), "left_semi"), "blocks")
    # Of blocks with the same members, one is enough.
    chosen = staged(shared.groupBy("block").agg(F.min("id").alias("_least"), F.max("id").alias("_most"), F.count(F.lit(1)).alias("members"),
                                                F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("_sum"))
                    .groupBy("_least", "_most", "members", "_sum").agg(F.min("block").alias("_block"))
                    .select("_block", "members"), "chosen")
    counts = heads.select(F.col("doc_id").alias("_of"), "counts")
    # Every row has the first blocks of its id, as far as they come before its own. The first block that two documents
    # share knows of no earlier one, so it offers the pair.
    members = staged(shared.join(chosen, F.col("block") == F.col("_block"))
                     .groupBy("id").agg(F.sort_array(F.collect_set(F.struct("block", "members"))).alias("_in"))
                     .join(counts, F.col("id") == F.col("_of")).select("id", "counts", "_in").distinct()
                     .select("id", "counts", F.slice("_in.block", 1, FIRST).alias("_first"), F.explode("_in").alias("_at"))
                     .select("_at.block", "id", "_at.members", "counts",
                             F.filter("_first", lambda b: b < F.col("_at.block")).alias("earlier")), "members")

    # A verified pair per document first, with its best partner; then pairs that would join what is still apart in a
    # piece; at last all pairs between what even those have left apart. So a dense group costs a few comparisons
    # a member. A block of one piece is searched as a whole: sides without any partner then have none in it.
    apart = members.withColumn("side", F.col("id")).withColumn("whole", F.col("members") <= TILE)
    found = staged(_candidates(apart, num, per, BEST), "pairs")
    links = staged(_verified(found, docs, size, num, per), "links")
    joined = None
    for which in (FOREST, ALL):
        near = found.select(F.explode(F.array("a", "b")).alias("near"))
        if joined is not None:  # sides are components
            near = (near.distinct().join(joined, F.col("near") == F.col("node"), "left")
                    .select(F.coalesce("component", "near").alias("near")))
        left = _unsettled(apart, staged(near.distinct(), "near"))
        joined = components(links)
        sided = staged(left.join(joined, F.col("id") == F.col("node"), "left")
                       .select("block", "id", "counts", "earlier", F.coalesce("component", "id").alias("side")), "sides")
        tops = (sided.groupBy("block", "side").agg(F.count(F.lit(1)).alias("_n"))
                .groupBy("block").agg(F.max(F.struct("_n", "side")).alias("_top"), F.count(F.lit(1)).alias("_sides"),
                                      F.sum("_n").alias("members")).filter("_sides > 1")
                .select(F.col("block").alias("_block"), "members", F.col("_top.side").alias("top"), F.col("_top._n").alias("inside")))
        apart = (sided.join(tops, F.col("block") == F.col("_block")).drop("_block")
                 .withColumn("whole", F.greatest("inside", F.col("members") - F.col("inside")) <= TILE))
        found = staged(_candidates(apart, num, per, which), "pairs")
        links = links.union(staged(_verified(found, docs, size, num, per), "links"))
    # Copies of a set, and sets of one doc_id, are linked as well.
    same = (known.select("doc_id", "digest").join(classes.filter("copies > 1").select(F.col("digest").alias("_d"), "rep"),
                                                  F.col("digest") == F.col("_d"))
            .filter(copies).select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    reached = components(links.union(same))
    return (every.select("doc_id", "n_shingles").join(reached, F.col("doc_id") == F.col("node"), "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, size: int = 4, num: int = 85, per: int = 100) -> DataFrame:
    """The rows of ``docs`` without all but one document of each group: the smallest doc_id stays.

    Of rows with that same doc_id one stays; rows without doc_id all stay, as they are not compared.
    """
    found = staged(jaccard_components(docs, size, num, per).select("doc_id", "component_id"), "groups")
    drop = staged(found.filter("doc_id <> component_id").select("doc_id").distinct(), "dropped")
    kept = with_ids(docs, drop, keep=False)
    twice = staged(found.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    if twice.isEmpty():
        return kept
    return with_ids(kept, twice, keep=False).unionByName(with_ids(kept, twice).dropDuplicates(["doc_id"]))
