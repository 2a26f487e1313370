import hashlib
import itertools
import os
import random
import re
import sys
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF_DIR
from weblens.llm import conversations
from weblens.llm.conversations import ENDS, START, audited_conversations, cheapest, repaired_conversations

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
ORDER = re.compile(r"(s?(ua)+)?")


sys.setrecursionlimit(20_000)  # of the brute force, a few calls per row


def plain_best(rows):
    """Least (cost, audit, turns) over all edits, by recursion over the rows; at most two inserts in a row pay."""
    def step(state, initial):
        return {"0s": "s", "0u": "u", "su": "u", "ua": "a", "au": "u"}.get(state + initial)

    @lru_cache(None)
    def all_ways(i, state, inserts):
        found = rest(i, state)
        if inserts:
            for new in ("user", "assistant"):
                if (to := step(state, new[0])):
                    found = found + [(c + 3, "I" + a, ((new, ""), *t)) for c, a, t in all_ways(i, to, inserts - 1)]
        return sorted(found)[:1]

    def rest(i, state):
        found = [(0, "", ())] if i == len(rows) and state in "0a" else []
        if i < len(rows):
            role, text, doomed, cut = rows[i]
            found += [(c + 4, "D" + a, t) for c, a, t in all_ways(i + 1, state, 3)]
            if not doomed:
                for new, price, letter in ((role, 0, "K"), ("user", 3, "R"), ("assistant", 3, "R")):
                    if (to := step(state, new[:1])):
                        found += [(c + price + 3 * cut, letter + a, ((new, text), *t)) for c, a, t in all_ways(i + 1, to, 3)]
        return found

    return all_ways(0, "0", 3)[0]


def brute_force(turns):
    """conv_id -> the columns of the result, from lists of rows."""
    kept = defaultdict(list)
    for conv, turn, role, text in turns:
        kept[conv]
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if role is None else role), (" " if text is None else text)
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, rows in kept.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, signs, blank, again, truncated = set(), [], 0, 0, 0
        for turn, role, text in rows:
            filled = re.findall(r"[^\x20\x09-\x0D]", text)
            cut = False
            if not filled:
                blank, doomed = blank + 1, True
            elif (role, text) in seen:
                again, doomed = again + 1, True
            else:
                doomed, cut = False, filled[-1] not in ".!?"
                truncated += cut
            seen.add((role, text))
            signs.append((role, text, doomed, cut))
        initials = [r[1][:1] for r in rows]
        cost, audit, repaired = plain_best(tuple(signs))
        assert ORDER.fullmatch("".join(role[:1] for role, _ in repaired))
        numbers = [r[0] for r in rows if r[0] is not None]
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, blank, again, truncated,
                     sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(), repaired)
    return out


def compare(spark, turns, df=None):
    expected = brute_force(turns)
    df = spark.createDataFrame(turns, SCHEMA) if df is None else df
    got = {r[0]: tuple(r)[1:] for r in audited_conversations(df).collect()}
    assert got == {conv: row[:-1] for conv, row in expected.items()}
    lines = defaultdict(list)
    for r in sorted(repaired_conversations(df).collect(), key=lambda r: r["place"]):
        lines[r["conv_id"]].append((r["role"], r["text"]))
    assert {conv: tuple(v) for conv, v in lines.items()} == {conv: row[-1] for conv, row in expected.items() if row[-1]}


def random_turns(rng, convs, longest):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "User"]
    texts = ["Yes.", "No", "ok?", "", " \t", "fine!", "a. b", "x.\n", "end. ", " "]
    rows = []
    for conv in range(convs):
        at = 0
        for _ in range(rng.randrange(0, longest)):
            at += rng.choice([0, 1, 1, 1, 3])
            rows.append((conv, at, rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"t{rng.randrange(99)}{rng.choice(['.', ''])}"))
    return rows


def test_search_equals_all_ways():
    rng = random.Random(5)
    for _ in range(1500):
        rows = [(rng.choice(["system", "user", "assistant", "x"]), "t", rng.random() < 0.2, rng.random() < 0.2) for _ in range(rng.randrange(0, 9))]
        rows = [(r, t, d, c and not d) for r, t, d, c in rows]
        cost, audit, _ = plain_best(tuple(rows))
        assert cheapest([(r[:1], d, c) for r, _, d, c in rows], START, ENDS) == (cost, audit)


def test_pieces_join_to_the_same_path():
    rng = random.Random(6)
    for _ in range(200):
        rows = [(rng.choice("suaaux"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(rng.randrange(2, 30))]
        cuts = sorted(rng.sample(range(1, len(rows)), min(len(rows) - 1, rng.randrange(1, 5))))
        parts = [rows[i:j] for i, j in zip([0, *cuts], [*cuts, len(rows)])]
        paths = [{(a, b): p for a, b in itertools.product(range(4), range(4)) if (p := cheapest(part, a, (b,)))} for part in parts]
        way = conversations.joined(paths)
        assert (sum(c for _, c, _ in way), "".join(a for _, _, a in way)) == cheapest(rows, START, ENDS)


def test_equals_brute_force(spark):
    compare(spark, random_turns(random.Random(1), 60, 9))


def test_conversations_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE", 4)
    compare(spark, random_turns(random.Random(2), 12, 40))


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "So."), (1, None, "user", "a."),
            (1, None, "user", "a."), (1, None, "user", "a."), (2, 5, None, "x."), (2, 5, "assistant", None), (3, 1, "user", "long " * 40000 + "."),
            (3, 2, "assistant", "done."), (3, 2, "assistant", "done."), (4, 7, "", "."), (5, 0, "system", "S.")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("kind", "at", "piece", "block", "mark", "_kind", "_time"):
        df = df.withColumn(name, F.lit(9))
    compare(spark, rows, df)
    empty = audited_conversations(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0


def test_nothing_left_after_damage(spark):
    key = next(k for k in itertools.count() if zlib.crc32(f"{k}:1".encode()) % 20 == 0)
    compare(spark, [(key, 1, "user", "gone.")])
    row = audited_conversations(spark.createDataFrame([(key, 1, "user", "gone.")], SCHEMA)).first()
    assert tuple(row)[1:8] == (0, 0, 0, 0, 0, 0, "") and row["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_one_conversation_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE", 64)
    rng = random.Random(4)
    rows = [(7, i // 3, rng.choice(["user", "assistant"]), rng.choice(["Same again.", f"n{i}.", "cut"])) for i in range(400)]
    compare(spark, rows)


@pytest.mark.parametrize("sf_dir", [SF_DIR])
def test_given_table(spark, sf_dir):
    df = spark.read.parquet(os.path.join(sf_dir, "conversations.parquet"))
    compare(spark, [tuple(r) for r in df.collect()], df)
