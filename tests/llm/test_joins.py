import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF_DIR
from tests.oracle import compare, connect
from weblens.llm import ngram_join, oracles, queries
from weblens.llm.hamming import Piece, Segments, nearest_codes, sign_codes
from weblens.llm.neardup import near_duplicates
from weblens.llm.ngram_join import CountTree, Schemes, groups_of, jaccard_components, one_of_each, point_table, points


@pytest.mark.parametrize("name", oracles.ORACLES)
def test_sql(spark, name):
    rows, problem = compare(spark, connect(SF_DIR), SF_DIR, queries.QUERIES[name], oracles.ORACLES[name])
    assert not problem and rows > 0


def closed(nodes, links):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def sets(text, size):
    w = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split(" ")
    w = [x for x in w if x]
    return {tuple(w)} if 0 < len(w) < size else {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def brute(rows, size, num, per):
    s = [(d, sets(t, size)) for d, t in rows]
    links = [(a, b) for i, (a, x) in enumerate(s) for b, y in s[:i] if x and y and per * len(x & y) >= num * len(x | y)]
    return closed([d for d, _ in rows], links), {d: len(x) for d, x in s}


@pytest.mark.parametrize("size, num", [(4, 85), (5, 80), (1, 60)])
def test_jaccard_brute_force(make_docs, words, size, num):
    text, edited = words
    rng = random.Random(size)
    passage = text(60)
    rows = []
    for i in range(25):
        base = text(rng.choice([5, 7, 9, 20, 80, 300]))
        rows += [base] + [edited(base, rng.choice([0.005, 0.01, 0.02, 0.03, 0.06])) for _ in range(rng.randrange(8))]
    rows += [text(15) + " " + passage + " " + text(15) for _ in range(30)]
    chain = text(120)
    for _ in range(25):  # neighbours are linked, the ends are not
        rows.append(chain)
        chain = edited(chain, 0.012)
    rows = list(enumerate(rows, 10))
    rng.shuffle(rows)
    component, n = brute(rows, size, num, 100)
    out = jaccard_components(make_docs(rows), size, num, 100).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == component
    assert {r["doc_id"]: r["n_shingles"] for r in out} == n
    assert len(set(component.values())) < len(rows) - 40
    kept = {r["doc_id"] for r in one_of_each(make_docs(rows), size, num, 100).collect()}
    assert kept == set(component.values())


def test_large_block(make_docs, words, monkeypatch):
    from weblens.llm import ngram_join
    monkeypatch.setattr(ngram_join, "TILE", 16)
    text, edited = words
    base = text(90)
    rows = list(enumerate([edited(base, 0.008) for _ in range(90)]))
    component, _ = brute(rows, 4, 85, 100)
    assert {r["doc_id"]: r["component_id"] for r in jaccard_components(make_docs(rows)).collect()} == component


def test_parts_always_suffice():
    for num in (85, 80, 60):
        schemes = Schemes(num, 100)
        for a in range(1, 400):
            for b in range(a, a * 100 // num + 1):
                shared = -(-num * (a + b) // (num + 100))
                mine = {s: (parts, most) for s, parts, most in schemes.of(a)}
                theirs = {s: most for s, _, most in schemes.of(b)}
                both = set(mine) & set(theirs)
                assert any(a + b - 2 * shared <= mine[s][1] < mine[s][0] for s in both)


def test_tree_bound_loses_nothing():
    rng = np.random.default_rng(2)
    counts = rng.poisson(3, (300, 64)).astype(np.int32)
    counts[150:] = np.maximum(0, counts[:150] + rng.integers(-1, 2, (150, 64)) * (rng.random((150, 64)) < 0.2))
    total = counts.sum(1)
    tree = CountTree(counts, total, 85, 100)
    for i in range(0, 300, 7):
        bound = np.minimum(counts, counts[i]).sum(1)
        need = (185 * bound >= 85 * (total + total[i])) & (100 * np.minimum(total, total[i]) >= 85 * np.maximum(total, total[i]))
        assert set(np.flatnonzero(need)) <= set(tree.search(i)[0].tolist())


@pytest.mark.parametrize("repeat", [1, 700])
def test_points_bound_the_overlap(repeat):
    """Of sets in different numbers of groups, and where a byte does not hold a count."""
    rng = np.random.default_rng(repeat)
    pool = rng.integers(0, 2 ** 63, 3000, dtype=np.int64).astype(np.uint64)
    if repeat > 1:  # nearly all shingles in one group
        pool = unmixed(np.arange(3000, dtype=np.uint64))
    sets = [np.unique(rng.choice(pool, n, replace=False)) for n in (1, 5, 130, 300, 700, 2500, 2900)]
    counts, totals = point_table([points(x) for x in sets])
    assert totals.tolist() == [len(x) for x in sets] and counts.shape[1] == min(groups_of(len(x)) for x in sets)
    spare = totals - counts.sum(axis=1)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            assert len(np.intersect1d(x, y)) <= np.minimum(counts[i], counts[j]).sum() + min(spare[i], spare[j])


def unmixed(values):
    """Numbers that ``mix`` brings to ``values``."""
    def unshift(h, by):
        out = h
        for _ in range(64 // by + 1):
            out = h ^ (out >> np.uint64(by))
        return out
    h = unshift(values, 31) * np.uint64(pow(0x94D049BB133111EB, -1, 2 ** 64))
    h = unshift(h, 27) * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 2 ** 64))
    return unshift(h, 30)


def test_texts_that_polynomial_hashes_confuse_are_not_linked(make_docs):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    docs = make_docs([(1, one), (2, one.translate(str.maketrans("ab", "ba"))), (3, one)])
    assert {r["doc_id"]: r["component_id"] for r in jaccard_components(docs).collect()} == {1: 1, 2: 2, 3: 1}


def test_short_texts_need_no_blocks(spark):
    """Sets that link with equal ones alone never meet others: 20,000 texts of up to eight words."""
    rows = spark.range(20_000).select("id", F.concat_ws(" ", *[F.when(F.col("id") % 8 >= k, F.concat(F.lit("w"), F.col("id") + k)) for k in range(8)]).alias("text"))
    docs = rows.select(F.col("id").alias("doc_id"), "text").union(rows.filter("id % 5 = 0").select(F.col("id") + 100_000, "text"))
    start = time.time()
    got = jaccard_components(docs)
    assert got.filter("component_id <> doc_id % 100000").count() == 0 and got.count() == 24_000
    assert time.time() - start < 60


def test_candidates_of_one_group_grow_in_proportion(spark, words, monkeypatch):
    """A group of near copies that all link: rows sent to pieces, and pairs, per member."""
    text, _ = words
    seen = []
    search = ngram_join._candidates

    def counted(blocks, num, per, which):
        pairs = search(blocks, num, per, which)
        seen.append(pairs.count())
        return pairs
    monkeypatch.setattr(ngram_join, "_candidates", counted)
    monkeypatch.setattr(ngram_join, "TILE", 32)
    base, rng = text(400).split(), random.Random(4)

    def changed():
        copy = list(base)
        for at in rng.sample(range(400), 2):
            copy[at] = "changed"
        return " ".join(copy)
    for n in (150, 600):
        docs = spark.createDataFrame([(i, changed()) for i in range(n)], "doc_id BIGINT, text STRING")
        assert {r["component_id"] for r in jaccard_components(docs).collect()} == {0}
        assert seen[-3] <= n and seen[-2] <= 10 * n and seen[-1] <= n


@pytest.mark.parametrize("tile", [8, 512])
def test_jaccard_in_small_tiles(spark, words, monkeypatch, tile):
    """Families whose members partly link, cut into tiles in both rounds."""
    monkeypatch.setattr(ngram_join, "TILE", tile)
    text, edited = words
    rng = np.random.default_rng(tile)
    rows = []
    for family in range(6):
        base = text(60 + 40 * family)
        rows += [(len(rows) + i, edited(base, share)) for i, share in enumerate(rng.choice([0.0, 0.01, 0.02, 0.03, 0.05], 25))]
    sets = [brute_set(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    label = closed(range(len(rows)), links)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_components(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()}
    assert got == {i: label[i] for i in range(len(rows))}


def brute_set(text):
    w = text.lower().split()
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} or {tuple(w)}


def test_jaccard_odd(make_docs, odd_rows):
    out = jaccard_components(make_docs(odd_rows)).collect()
    assert len(out) == len(odd_rows)
    by = {r["doc_id"]: r["component_id"] for r in out}
    assert by[7] == 6 and by[9] == 8 and by[10] == 8 and by[2] == 2 and by[1] == 1 and by[None] is None
    assert all(r["n_shingles"] == 0 for r in out if r["doc_id"] in (1, 2, 3))
    kept = one_of_each(make_docs(odd_rows)).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(map(str, [1, 2, 3, 4, 5, 6, 8, None, None, 11, 12, 13]))
    assert jaccard_components(make_docs([])).count() == 0


def test_cosine_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 12))
    x = np.concatenate([base + rng.normal(size=base.shape) * s for s in (0, 0.05, 0.1, 0.15, 0.2)] + [base[:5], base[:5] * 3])
    rows = [(int(i), [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(900, None), (901, [0.0] * 12), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11), (904, [1.0, None]),
             (905, [1.0, 0.0]), (906, [2.0, 0.0]), (907, [])]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>").withColumn("rep", rows and __import__("pyspark").sql.functions.lit(1))
    unit = x / np.sqrt((x * x).sum(1, keepdims=True))
    cosines = unit @ unit.T
    links = [(i, j) for i in range(len(x)) for j in range(i) if cosines[i, j] >= 0.95] + [(905, 906)]
    nodes = list(range(len(x))) + list(range(900, 908))
    label = closed(nodes, links)
    count = dict.fromkeys(nodes, 0)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    for tile in (7, 2048):
        out = near_duplicates(df, 0.95, tile).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in out} == {
            n: (count[n], label[n], label[n] == n) for n in nodes}
        assert len(out) == len(nodes)
    assert near_duplicates(df.limit(0)).count() == 0
    assert near_duplicates(df.filter("vec_id = 900")).collect()[0][:] == (900, 0, 900, True)


def test_every_row_is_a_vector_of_its_own(spark):
    """Repeated and NULL ids, with equal and with different vectors: all rows are compared and returned."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(12, 6))
    x = np.concatenate([base, base * 2, base + rng.normal(size=base.shape) * 0.05, base[:4], base[:2]])
    ids = [*range(12), *range(50, 62), *range(6), *[None] * 6, 3, 3, 70, None, 0, 0]
    ids[2] = ids[26] = ids[14] = None  # one group of vectors without any vec_id
    rows = list(zip(ids, [[float(v) for v in r] for r in x]))
    rows += [(3, None), (None, None), (None, [0.0] * 6), (80, [0.0] * 6), (80, [0.0] * 6)]
    u = x / np.sqrt((x * x).sum(1, keepdims=True))
    links = [(i, j) for i in range(len(x)) for j in range(i) if (u @ u.T)[i, j] >= 0.95]
    label = closed(range(len(rows)), links)
    want = []
    for i, (vec_id, _) in enumerate(rows):
        reached = [rows[k][0] for k in range(len(rows)) if label[k] == label[i] and rows[k][0] is not None]
        component = min(reached, default=None)
        want.append((vec_id, sum(i in link for link in links), component, component == vec_id))
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    for name in ("least", "_least", "copies", "component", "usable"):
        df = df.withColumn(name, F.lit(1))
    for tile in (3, 2048):
        assert sorted(map(str, near_duplicates(df, 0.95, tile).collect())) == sorted(
            f"Row(vec_id={a}, n_links={b}, component_id={c}, kept={d})" for a, b, c, d in want)


def some_codes(n=700, copies=100):
    rng = np.random.default_rng(6)
    codes = rng.integers(0, 2 ** 63, n, dtype=np.int64) * 2 + rng.integers(0, 2, n)
    codes[n - copies:] = codes[:copies] ^ (np.int64(1) << rng.integers(0, 63, copies))
    return codes, rng.permutation(n)


@pytest.mark.parametrize("count, per_piece", [(50, 97), (700, 97), (700, 5), (60_000, 97), (10 ** 9, 50)])
def test_pieces_see_every_code_once(count, per_piece):
    """Over all pieces within reach and all radii, a search returns each code once, with its distance, by growing radius."""
    codes = some_codes(300, 60)[0].view(np.uint64)
    segments = Segments(count, per_piece)
    assert sum(bits for _, bits in segments.at) == 64
    pieces = {}
    for s in range(len(segments.at)):
        places = segments.places(codes, s)
        for place in np.unique(places):
            at = np.flatnonzero(places == place)
            pieces[int(place)] = at, Piece(segments, int(place), codes[at])
    for q in range(0, 300, 59):
        distance = np.bitwise_count(codes ^ codes[q]).astype(int)
        seen = {}
        for radius in range(segments.deepest + 1):
            for at, piece in pieces.values():
                for i, d in zip(*piece.search(codes[q], radius, 64)):
                    assert int(at[i]) not in seen
                    seen[int(at[i])] = int(d)
            assert {i for i in range(300) if distance[i] < len(segments.at) * (radius + 1)} <= set(seen)
        assert seen == dict(enumerate(distance.tolist()))


@pytest.mark.parametrize("per_piece", [13, 16384])
def test_codes_brute_force(spark, per_piece):
    codes, ids = some_codes()
    df = spark.createDataFrame([(int(i), int(c)) for i, c in zip(ids, codes)], "vec_id BIGINT, code BIGINT")
    out = nearest_codes(df, df.filter("vec_id % 20 = 0"), 5, per_piece).collect()
    assert len(out) == 35 * 5
    by = {}
    for r in out:
        by.setdefault(r["query_id"], []).append((r["distance"], r["vec_id"], r["rank"]))
    place = {int(i): k for k, i in enumerate(ids)}
    for q, found in by.items():
        d = np.bitwise_count(codes.view(np.uint64) ^ codes.view(np.uint64)[place[q]]).astype(int)
        want = sorted(zip(d.tolist(), ids.tolist()))[:5]
        assert sorted(found, key=lambda f: f[2]) == [(a, b, k + 1) for k, (a, b) in enumerate(want)]


def test_few_and_equal_codes(spark):
    """Fewer codes than asked for, none at all, and a code that a third of all rows have."""
    df = spark.createDataFrame([(i, i // 2 * 1001) for i in range(9)], "vec_id BIGINT, code BIGINT")
    assert nearest_codes(df.limit(0), df, 3).count() == 0 == nearest_codes(df, df.limit(0), 3).count()
    assert nearest_codes(df.limit(2), df.limit(1), 3).count() == 2
    same = [(i, 7 if i % 3 == 0 else i * 0x9E3779B97F4A7C15 % 2 ** 63) for i in range(300)] + [(0, 7), (None, 7), (9, None)]
    df = spark.createDataFrame(same, "vec_id BIGINT, code BIGINT").repartition(3)
    got = {}
    for r in nearest_codes(df, df.filter("vec_id % 20 = 0"), 4, 20).collect():
        got.setdefault((r["query_id"], same[r["query_id"]][1]), []).append((r["rank"], r["distance"], r["vec_id"]))
    for (_, code), found in got.items():
        want = sorted((bin(code ^ c).count("1"), i) for i, c in same if i is not None and c is not None)[:4]
        assert sorted(found) == [(k + 1, *w) for k, w in enumerate(want)]
    assert len(got) == 15


def test_codes_odd(spark):
    rows = [(1, [1.0, -1.0, None, float("nan")]), (2, None), (None, [1.0]), (3, []), (4, [0.0] * 64 + [1.0]), (5, [1.0] * 64)]
    out = {r[0]: r[1] for r in sign_codes(spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>")).collect()}
    assert out == {1: 1, 3: 0, 4: 1, 5: -1}


def near_copies(words, n, edits=6):
    """Texts of one group that share many blocks; most link."""
    text, _ = words
    base, rng = text(200).split(), random.Random(n)

    def changed():
        copy = list(base)
        for at in rng.sample(range(200), edits):
            copy[at] = f"new{rng.random()}"
        return " ".join(copy)
    return [(i, changed()) for i in range(n)]


def test_a_pair_is_offered_by_few_blocks(spark, words, monkeypatch):
    """Rows that the search makes for one group of near copies: a few per member, however many blocks it shares."""
    made, run = [], ngram_join.staged

    def counted(df, label):
        out = run(df, label)
        if label == "offers":
            made.append(out.count())
        return out
    monkeypatch.setattr(ngram_join, "staged", counted)
    search = type(spark.range(1)).mapInArrow

    def kept(df, task, schema, *more, **rest):
        out = search(df, task, schema, *more, **rest)
        return counted(out, "offers") if "bound DOUBLE" in str(schema) else out
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", kept)
    rows = near_copies(words, 120)
    s = [brute_set(t) for _, t in rows]
    label = closed(range(120), [(i, j) for i in range(120) for j in range(i) if 100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j])])
    out = jaccard_components(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), 4, 80, 100)
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == label
    assert len(made) == 3 and made[0] <= 4 * 120


def test_later_rounds_take_up_only_what_had_a_partner(spark, words, monkeypatch):
    """Texts that share parts and no more are searched once, not in every round."""
    seen, search = [], ngram_join._candidates

    def counted(blocks, num, per, which):
        seen.append(blocks.count())
        return search(blocks, num, per, which)
    monkeypatch.setattr(ngram_join, "_candidates", counted)
    text, edited = words
    rng = random.Random(3)
    passages = [text(6) for _ in range(4)]
    rows = [" ".join([text(12), rng.choice(passages), text(12)]) for _ in range(150)]
    rows += [edited(t, 0.03) for t in rows[:20]]
    rows = list(enumerate(rows))
    component, _ = brute(rows, 4, 85, 100)
    got = jaccard_components(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == component
    assert seen[0] > 300 and seen[1] < seen[0] / 3 and seen[2] <= seen[1]


def test_search_of_all_rows_is_the_search_of_each():
    rng = np.random.default_rng(5)
    for n in (2, 16, 17, 90):
        counts = np.repeat(rng.poisson(2, (-(-n // 3), 64)), 3, axis=0)[:n].astype(np.int32)
        counts += (rng.random(counts.shape) < 0.03).astype(np.int32)
        tree = CountTree(counts, counts.sum(1) + rng.integers(0, 3, n), 85, 100)
        every = {row: dict(zip(found.tolist(), bound.tolist())) for row, found, bound in tree.search_all()}
        assert every and all(every.get(row, {row: 1.0}) == dict(zip(*(x.tolist() for x in tree.search(row)))) for row in range(n))
