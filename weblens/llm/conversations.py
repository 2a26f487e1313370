"""Repair of damaged conversations by the cheapest edits, found by bidirectional Dijkstra over the edit lattice.

A node of the lattice is (rows consumed, state of the wanted order of roles); edges keep, rerole or delete the next row,
or insert a turn. The audit is the path's initials. Two heaps grow from both ends until no cheaper or equally cheap
crossing can be left, and the least concatenated audit of all cheapest crossings wins.

Rows are cut into pieces of at most PIECE rows wherever they lie, so a conversation of any length spreads over tasks.
A piece that holds a whole conversation is searched from the first state to the last ones; a piece of a longer one
from every state to every state, and the results are joined in order. That is exact: a cost is a function of the
audit, so of two equally cheap audits between the same nodes none is a prefix of the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import chain, groupby, product
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from weblens.llm.common import partitions, staged

PIECE = 1024

# Costs, white space, ends of sentences.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
FILLED = r"[^\x20\x09-\x0D]"
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")

# States of `(s?(ua)+)?`: nothing yet, after s, after u, after a. Where each initial leads; an end is START or ASSISTANT.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ENDS = (START, ASSISTANT)

Row = tuple[str, bool, bool]  # initial of the role, whether it has to be deleted, whether it is truncated
Path = tuple[int, str]  # cost, audit


def _steps(rows: list[Row], i: int, state: int) -> Iterator[tuple[int, int, int, str]]:
    """(rows consumed, state, cost, letter) of the edges that leave a node."""
    for initial, to in NEXT[state].items():
        if initial in ROLES:
            yield i, to, INSERT, "I"
    if i < len(rows):
        first, doomed, cut = rows[i]
        yield i + 1, state, DELETE, "D"
        if not doomed:
            extra = TRUNCATED if cut else 0
            for initial, to in NEXT[state].items():
                if initial in ROLES:
                    yield i + 1, to, REROLE + extra, "R"
                if initial == first:
                    yield i + 1, to, extra, "K"


def _steps_back(rows: list[Row], i: int, state: int) -> Iterator[tuple[int, int, int, str]]:
    """The edges that enter a node, by the node they come from."""
    for before, leads in NEXT.items():
        for initial, to in leads.items():
            if to != state:
                continue
            if initial in ROLES:
                yield i, before, INSERT, "I"
            if i and not rows[i - 1][1]:
                extra = TRUNCATED if rows[i - 1][2] else 0
                if initial in ROLES:
                    yield i - 1, before, REROLE + extra, "R"
                if initial == rows[i - 1][0]:
                    yield i - 1, before, extra, "K"
    if i:
        yield i - 1, state, DELETE, "D"


def cheapest(rows: list[Row], entry: int, exits: Iterable[int]) -> Path | None:
    """The cheapest path from ``entry`` before the rows to one of ``exits`` behind them, the ASCII-least audit of those.

    Each side settles nodes by cost, and among equal costs in its direction along the rows, so that all edges of no
    cost into a node are known when it is settled and its label is its least audit.
    """
    n = len(rows)
    labels: tuple[dict, dict] = ({(0, entry): (0, "")}, {(n, state): (0, "") for state in exits})
    heaps: tuple[list, list] = ([(0, 0, entry)], [(0, 0, state) for state in exits])
    settled: tuple[set, set] = (set(), set())
    best: Path | None = None
    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best[0]):
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, along, state = heappop(heaps[side])
        node = (along if side == 0 else n - along, state)
        if node in settled[side]:
            continue
        settled[side].add(node)
        audit = labels[side][node][1]
        for i, to, price, letter in (_steps if side == 0 else _steps_back)(rows, *node):
            here = (cost + price, audit + letter if side == 0 else letter + audit)
            known = labels[side].get((i, to))
            if known is not None and known <= here:
                continue
            labels[side][i, to] = here
            if known is None or here[0] < known[0]:
                heappush(heaps[side], (here[0], i if side == 0 else n - i, to))
            best = _crossing(labels, (i, to), best)
        best = _crossing(labels, node, best)
    return best


def _crossing(labels: tuple[dict, dict], node: tuple[int, int], best: Path | None) -> Path | None:
    if node not in labels[0] or node not in labels[1]:
        return best
    (cost, audit), (rest, suffix) = labels[0][node], labels[1][node]
    here = (cost + rest, audit + suffix)
    return here if best is None or here < best else best


def joined(paths: list[dict[tuple[int, int], Path]]) -> list[tuple[int, int, str]]:
    """Pieces of one conversation in order, each with its cheapest paths by (entry, exit): for every piece the
    entry, cost and audit on the cheapest way through all, the ASCII-least of those."""
    reached: dict[int, Path] = {START: (0, "")}
    came: list[dict[int, int]] = []
    for piece in paths:
        now: dict[int, Path] = {}
        origin: dict[int, int] = {}
        for (entry, exit_), (cost, audit) in piece.items():
            if entry in reached:
                here = (reached[entry][0] + cost, reached[entry][1] + audit)
                if exit_ not in now or here < now[exit_]:
                    now[exit_], origin[exit_] = here, entry
        reached = now
        came.append(origin)
    state = min((end for end in ENDS if end in reached), key=lambda end: reached[end])
    way = []
    for piece, origin in zip(reversed(paths), reversed(came)):
        entry = origin[state]
        way.append((entry, *piece[entry, state]))
        state = entry
    return way[::-1]


def repaired_turns(state: int, audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Role and text of the turns that an audit leaves, from ``state`` on; ``rows`` gives those before the repair."""
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        initial = role[:1] if letter == "K" else next(c for c in NEXT[state] if c in ROLES)
        state = NEXT[state][initial]
        yield role if letter == "K" else ROLES[initial], text


# --- on Spark ------------------------------------------------------------------------------------

def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that crc32 of ``conv_id:turn`` chooses; NULLs in that text, in
    roles and in texts are one space."""
    def spaced(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    text = spaced("text")
    return (turns.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(spaced("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        kind.alias("_kind"))
        .filter("_kind <> 0")
        .withColumn("_time", F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        .select("conv_id", "turn", "role", "text"))


PATHS = "ARRAY<STRUCT<entry: INT, exit: INT, cost: BIGINT, audit: STRING>>"
PIECES = ("conv_id BIGINT, at BIGINT, first STRING, last STRING, blank BIGINT, duplicate BIGINT, truncated BIGINT, "
          f"illegal BIGINT, paths {PATHS}")
AUDITS = ("conv_id BIGINT, gaps BIGINT, blank BIGINT, duplicate BIGINT, truncated BIGINT, illegal BIGINT, cost BIGINT, "
          "audit STRING, repaired_sha256 STRING")
TURNS = "conv_id BIGINT, place BIGINT, role STRING, text STRING"


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _groups(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Runs of rows that are equal in the column number ``key``, over the borders of batches."""
    rows = chain.from_iterable(zip(*[column.to_pylist() for column in batch.columns]) for batch in batches)
    return groupby(rows, key=itemgetter(key))


def placed_turns(turns: DataFrame) -> DataFrame:
    """The damaged rows with ``at``, their place in the order of conversations and turns (NULLs first, equal turns by
    role and text), staged. A conversation of any length spreads over files."""
    order = ["conv_id", "turn", "role", "text"]
    rows = damaged(turns)
    return staged(rows.repartitionByRange(partitions(turns.sparkSession), *order).sortWithinPartitions(*order)
                  .withColumn("at", F.monotonically_increasing_id()), "turns")


def pieces(placed: DataFrame) -> DataFrame:
    """A row per conversation and block of PIECE placed rows: counts of faults, and the cheapest paths.

    Which rows are the first of their role and text in a conversation is an aggregate by digest; it meets the signs
    of the rows (some bytes each, no texts) in their block, so neither a long conversation nor a turn repeated
    without end gathers in a task.
    """
    block = F.shiftright("at", PIECE.bit_length() - 1).alias("block")
    last = F.regexp_extract("text", rf"({FILLED})[\x20\x09-\x0D]*\z", 1)
    signs = placed.select(block, "at", F.lit(0).alias("mark"), "conv_id", F.substring("role", 1, 1).alias("initial"),
                          (~F.col("text").rlike(FILLED)).alias("blank"), (~last.isin("", ".", "!", "?")).alias("cut"))
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    firsts = (placed.groupBy("conv_id", digest).agg(F.min("at").alias("at"))
              .select(block, "at", F.lit(1), F.lit(None), F.lit(None), F.lit(None), F.lit(None)))
    shape = _arrow(PIECES)
    marks = signs.union(firsts).repartition("block").sortWithinPartitions("block", "at", "mark")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, group in _groups(batches, 0):
            rows: list[list] = []  # conversation, initial, blank, cut, whether its text came before
            for _, _, mark, conv, initial, blank, cut in group:
                if mark:
                    rows[-1][4] = False
                else:
                    rows.append([conv, initial, blank, cut, True])
            runs = [(conv, list(run)) for conv, run in groupby(rows, key=itemgetter(0))]
            out = []
            for k, (conv, run) in enumerate(runs):
                signs = [(initial, blank or again, cut) for _, initial, blank, cut, again in run]
                initials = [sign[0] for sign in signs]
                at_edge = k in (0, len(runs) - 1)  # it may go on in the blocks beside
                ways = product(range(4), [(state,) for state in range(4)]) if at_edge else [(START, ENDS)]
                found = [(entry, exits[0], cheapest(signs, entry, exits)) for entry, exits in ways]
                out.append({
                    "conv_id": conv, "at": (number * PIECE) + k, "first": initials[0], "last": initials[-1],
                    "blank": sum(row[2] for row in run), "duplicate": sum(row[4] and not row[2] for row in run),
                    "truncated": sum(cut and not doomed for _, doomed, cut in signs),
                    "illegal": sum(x + y not in LEGAL for x, y in zip(initials, initials[1:])),
                    "paths": [{"entry": entry, "exit": end, "cost": path[0], "audit": path[1]} for entry, end, path in found if path]})
            yield pa.RecordBatch.from_pylist(out, schema=shape)

    return marks.mapInArrow(each, PIECES)


class _Turns:
    """The rows of one conversation as they stream by, and what is counted of their turns."""

    def __init__(self, rows: Iterator[tuple]):
        self.rows, self.low, self.high, self.distinct = rows, None, None, 0

    def __iter__(self) -> Iterator[tuple[str, str]]:
        for _, _, _, turn, role, text, _ in self.rows:
            if turn is not None and turn != self.high:
                self.low, self.high, self.distinct = (turn if self.low is None else self.low), turn, self.distinct + 1
            yield role, text

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct


def _flow(turns: DataFrame) -> DataFrame:
    """Per conversation, in order: its id, its pieces, its rows; sorted inside the partitions of the ids."""
    placed = placed_turns(turns)
    row = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(PIECES).fields])
    none = [F.lit(None).cast("bigint"), F.lit(None).cast("string"), F.lit(None).cast("string")]
    ids = turns.select("conv_id").distinct().select(
        "conv_id", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("at"), none[0].alias("turn"), none[1].alias("role"),
        none[2].alias("text"), row.alias("piece"))
    found = pieces(placed)
    found = found.select("conv_id", F.lit(1), "at", *none, F.struct(*found.columns))
    rows = placed.select("conv_id", F.lit(2), "at", "turn", "role", "text", row)
    return ids.union(found).union(rows).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "at")


def _repaired(turns: DataFrame, lines_too: bool, schema: str) -> DataFrame:
    shape = _arrow(schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for conv, group in _groups(batches, 0):
            parts, first = [], None
            for row in group:
                if row[1] == 2:
                    first = row
                    break
                if row[1] == 1:
                    parts.append(row[6])
            way = joined([{(p["entry"], p["exit"]): (p["cost"], p["audit"]) for p in part["paths"]} for part in parts])
            seen = _Turns(chain([first] if first else [], group))
            digest, place, flow = hashlib.sha256(), 0, iter(seen)
            for entry, _, audit in way:
                for role, text in repaired_turns(entry, audit, flow):
                    if lines_too:
                        out.append({"conv_id": conv, "place": place, "role": role, "text": text})
                    else:
                        digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
                    place += 1
                    if len(out) >= 1000:
                        yield pa.RecordBatch.from_pylist(out, schema=shape)
                        out = []
            if not lines_too:
                out.append({
                    "conv_id": conv, "gaps": seen.gaps(), **{name: sum(part[name] for part in parts) for name in ("blank", "duplicate", "truncated")},
                    "illegal": sum(part["illegal"] for part in parts) + sum(
                        x["last"] + y["first"] not in LEGAL for x, y in zip(parts, parts[1:])),
                    "cost": sum(cost for _, cost, _ in way), "audit": "".join(audit for _, _, audit in way),
                    "repaired_sha256": digest.hexdigest()})
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=shape)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=shape)

    return _flow(turns).mapInArrow(each, schema)


def audited_conversations(turns: DataFrame) -> DataFrame:
    """One row per conv_id of ``turns`` (conv_id, turn, role, text; other columns are ignored), NULL included: its
    faults after the damage, and the cost, audit and digest of its repair.

    An empty table gives no rows. Empty and NULL texts are blank, NULL roles fit nowhere, repeated rows are
    duplicates, rows of the same turn are ordered by role and text. The digest is of all lines in order, so the lines of
    a conversation pass one task, one at a time; what that task keeps of it are paths of some bytes per row.
    """
    return _repaired(turns, False, AUDITS)


def repaired_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the turns after the repair, numbered from 0 in each conversation; conversations
    of which nothing is left have none. Rows as for ``audited_conversations``."""
    return _repaired(turns, True, TURNS)
