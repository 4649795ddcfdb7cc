"""Operators on vectors, fingerprints and near-duplicates, against brute force."""

import hashlib
import random
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from changewatch.llm import common, components, minhash, queries, simhash, topk

WORDS = [f"w{i}" for i in range(400)]


def prose(seed, size):
    return " ".join(random.Random(seed).choices(WORDS, k=size))


def brute_topk(rows, queries, k):
    out = []
    for q, v in queries.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows.items() if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("lists", [1, 2, 3])
def test_topk_with_ties_copies_and_odd_rows(spark, lists):
    rng = np.random.default_rng(1)
    vectors = {i: [float(x) for x in rng.integers(-3, 4, 6) / 8] for i in range(120)}
    for i in range(20, 60):
        vectors[i] = vectors[20]  # a third are copies, so most ranks are ties
    odd = [(200, None), (201, [1.0, None]), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (None, [1.0] * 6),
           (204, [1.0]), (205, [])]
    rows = [*vectors.items(), *odd, *list(vectors.items())[:5]]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    whole = topk.whole_numbers(df)
    expected = {i: [int(np.floor(256 * x)) for x in v] for i, v in vectors.items()} | {204: [256], 205: []}
    got = topk.search(whole, whole.where(F.col("id") % 5 == 0), k=4, lists=lists).collect()
    assert sorted(map(tuple, got)) == brute_topk(expected, {i: v for i, v in expected.items() if i % 5 == 0}, 4)


def test_topk_of_few_rows_and_of_none(spark):
    df = spark.createDataFrame([(0, [0.5]), (50, [-0.5])], "vec_id long, embedding array<float>")
    whole = topk.whole_numbers(df)
    assert sorted(map(tuple, topk.search(whole, whole).collect())) == [(0, 1, 50, -16384), (50, 1, 0, -16384)]
    assert topk.search(whole.where("false"), whole.where("false")).collect() == []


def test_topk_of_many_blocks_and_tasks(spark, monkeypatch):
    """Blocks meet whatever the number of tasks: nothing is lost where each group has a task of its own."""
    monkeypatch.setattr(topk, "CANDIDATES", 40)
    monkeypatch.setattr(topk, "QUERIES", 8)
    settings = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        rng = np.random.default_rng(3)
        vectors = {i: [float(x) for x in rng.normal(size=6)] for i in range(200)}
        df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
        whole = topk.whole_numbers(df)
        got = topk.search(whole, whole.where(F.col("id") % 10 == 0)).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    expected = {i: [int(np.floor(256 * x)) for x in v] for i, v in vectors.items()}
    assert sorted(map(tuple, got)) == brute_topk(expected, {i: v for i, v in expected.items() if i % 10 == 0}, 5)


def test_topk_query_takes_every_row(spark, tmp_path):
    """Rows that come again, or whose id does with another vector, are queries and candidates of their own."""
    rng = np.random.default_rng(4)
    rows = [(int(rng.integers(0, 120)), [float(x) for x in rng.integers(-2, 3, 4)]) for _ in range(300)]
    rows += rows[:40] + [(50, [9.0, 0.0, 0.0, 0.0])] * 9
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    expected = []
    for n, (query, v) in enumerate(rows):
        if query % 50 == 0:
            scores = sorted((-sum(int(256 * a) * int(256 * b) for a, b in zip(v, w)), i) for m, (i, w) in enumerate(rows) if m != n)
            expected += [(query, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:5])]
    assert sorted(map(tuple, queries.op1_topk(spark, str(tmp_path)).collect())) == sorted(expected)


def test_covering_masks_meet_every_pair_within_the_radius():
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for trial in range(3000):
            bits = random.Random(trial).sample(range(64), radius)
            apart = sum(1 << bit for bit in bits)
            assert any(apart & mask == 0 for mask in masks)


def union_find(nodes, close):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a in nodes:
        for b in nodes:
            if a < b and close(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("pairwise", [0, 2, 1000])
@pytest.mark.parametrize("radius", [1, 2])
def test_links_join_what_is_near(spark, monkeypatch, pairwise, radius):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    rng = random.Random(5)
    points = {0}
    for _ in range(60):
        base = rng.choice([0, 1 << 63 | 12345, 77 << 20])
        points.add(base ^ sum(1 << bit for bit in rng.sample(range(64), rng.randint(0, 4))))
    points = sorted(simhash.as_signed(p) for p in points)
    df = spark.createDataFrame([(p,) for p in points], "fingerprint long")
    found = dict(components.components(simhash.links(df, radius)).collect())
    near = union_find(points, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= radius)
    assert {p: found.get(p, p) for p in points} == near


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(200, 260)] + [(7, 7), (300, 301), (301, 300)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = dict(components.components(df).collect())
    assert all(found[i] == 0 for i in range(41)) and all(found[i] == 100 for i in range(200, 260))
    assert found[301] == 300 and set(found) == {*range(41), 100, *range(200, 260), 300, 301}
    assert components.components(df.where("false")).collect() == []


def test_components_of_few_links_take_few_tasks(spark, monkeypatch):
    """A round on a small table does not cost a task and a file for each partition of a shuffle."""
    parts, write = [], components.written
    monkeypatch.setattr(components, "written", lambda df, name, keep=False: parts.append((name, df.rdd.getNumPartitions())) or write(df, name, keep))
    settings = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        links = spark.createDataFrame([(i, i + 1) for i in range(30)], "a long, b long")
        assert dict(components.components(links).collect()) == {i: 0 for i in range(31)}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert parts[0] == ("edges", 50) and len(parts) > 4 and max(n for _, n in parts[1:]) <= common.FEWEST


def test_simhash_contract_and_odd_rows(spark):
    texts = [(1, "A b C d"), (2, "a B c D"), (3, None), (4, " \t\n"), (5, "one two"), (6, prose(1, 30000)), (6, prose(1, 30000)),
             (None, "a b c d"), (7, "é b c\x0bd e")]
    df = spark.createDataFrame([(*t, 1) for t in texts], "doc_id long, text string, fingerprint int")
    rows = simhash.near_duplicates(df).collect()
    assert len(rows) == len(texts)
    by = {r.doc_id: r for r in rows}
    assert by[1].component_id == by[2].component_id == by[None].component_id == 1
    assert by[3].fingerprint == by[4].fingerprint == "0" * 16 and by[4].component_id == 3
    assert by[5].fingerprint == f"{xxhash.xxh64_intdigest(b'one two', 42):016x}"
    words = ["é b", "c", "d", "e"]
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]), 42) for i in range(2)]
    assert by[7].fingerprint == f"{hashes[0] & hashes[1]:016x}"
    assert simhash.near_duplicates(df.where("false")).collect() == []


def jaccard(a, b):
    x, y = (set(simhash.shingle_hashes(t, 5).tolist()) for t in (a, b))
    return len(x & y) / max(len(x | y), 1)


def test_similar_groups_against_all_pairs(spark):
    rng = random.Random(3)
    docs = {}
    for family in range(12):
        size = rng.choice([60, 130, 500, 1500])
        base = prose(family, size).split()
        for member in range(5):
            own = list(base)
            for _ in range(int(size * rng.choice([0, 0.004, 0.012, 0.02, 0.06]))):
                own[rng.randrange(size)] = rng.choice(WORDS)
            docs[family * 10 + member] = " ".join(own) + (" and a line that all share in the end of it" if member % 2 else "")
    docs |= {500: "", 501: "", 502: "short", 503: "short"}
    df = spark.createDataFrame([*docs.items(), (None, "short"), (504, None)], "doc_id long, text string")
    found = dict(simhash.similar_groups(df).collect())
    near = union_find(sorted(docs), lambda a, b: jaccard(docs[a], docs[b]) >= 0.8 or not docs[a] and not docs[b])
    assert {i: found.get(i, i) for i in docs} == near
    kept = {r.doc_id for r in simhash.one_of_each(df).collect()}
    assert kept == {i for i, root in near.items() if i == root} | {None}


def plain_fingerprint(text):
    """One-permutation MinHash by its definition: one smallest hash a bin, empty bins filled from the first filled one in an order of
    their own, the low bits of each value hashed with its bin."""
    def hashed(*numbers, seed=42):
        for number in numbers:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", number), seed)
            number = seed - (1 << 64) if seed >> 63 else seed
        return number if numbers else seed

    def signed(number):
        return number - (1 << 64) if number >> 63 else number

    words = [signed(xxhash.xxh64_intdigest(word.encode(), 42)) for word in re.split("[ \t\n\x0b\f\r]+", text) if word]
    smallest = {}
    for i in range(max(1, len(words) - 4)):
        value = hashed(*words[i:i + 5])
        place = (value % (1 << 64)) >> 57
        smallest[place] = min(value, smallest.get(place, value))
    filled = sorted(smallest, key=lambda place: smallest[place])
    digits = []
    for place in range(128):
        donor = place if place in smallest else min(filled, key=lambda other: hashed(place, other))
        digits.append(f"{hashed(smallest[donor], place) & 255:02X}")
    return "".join(digits)


def test_fingerprints_by_their_definition(spark):
    texts = ["", "one", "a b c d", "a b c d e", "a  b\tc\x0bd e f", "É è ñ 漢字 \u00a0 x", *(prose(i, 30 * i) for i in range(1, 12))]
    rows = minhash.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: plain_fingerprint(text) for i, text in enumerate(texts)}


def test_fingerprints_estimate_likeness(spark):
    docs = [(i, prose(i, n)) for i, n in enumerate([1, 3, 6, 40, 300, 1200, 0, 5000])] + [(20, None), (20, ""), (None, "x y"), (30, "é" * 9)]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, n_chars string")
    rows = minhash.with_edits(df).collect()
    assert len(rows) == len(docs)
    texts = {i: t or "" for i, t in docs if i is not None}
    order = sorted(texts)
    for row in rows:
        if row.doc_id is None:
            assert row.near_next is None
            continue
        text, after = texts[row.doc_id], texts[order[(order.index(row.doc_id) + 1) % len(order)]]
        quarter = len(text) // 4
        edited = text[:len(text) - quarter] + after[:quarter]
        shingles = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.split() for t in (text, edited, after))]
        for estimate, other in ((row.near_edited, shingles[1]), (row.near_next, shingles[2])):
            assert abs(estimate - len(shingles[0] & other) / len(shingles[0] | other)) < 0.2
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if [i for i, _ in docs].count(row.doc_id) == 1:
            assert row.fingerprint == plain_fingerprint(text) and row.edited_fingerprint == plain_fingerprint(edited)
    assert minhash.with_edits(df.where("false")).collect() == []


def test_fingerprints_have_no_python(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    plan = minhash.with_edits(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    same = minhash.fingerprints(spark.createDataFrame([(1, "a b"), (2, "a  b"), (3, "b a")], "doc_id long, text string")).collect()
    assert same[0].fingerprint == same[1].fingerprint != same[2].fingerprint


def test_similar_groups_of_templates_and_chains(spark):
    """Middle members of buckets that are alike only to each other, and versions whose ends are not alike."""
    template = prose(1000, 300).split()
    docs = {}
    for i in range(60):  # one template, own text of different sizes; pairs of them are alike, at any place of the order
        own = prose(2000 + i % 30, 60 + 5 * (i % 30)).split()
        docs[i] = " ".join([*template, *own, *prose(3000 + i, 6).split()])
    chain = prose(4000, 400).split()
    for i in range(40):  # each version has two more words changed than the last
        for k in (7 * i, 7 * i + 3):
            chain[k] = f"new{k}"
        docs[100 + (i * 17) % 40] = " ".join(chain)
    for i in range(30):  # copies of a base that only the base is near to
        own = prose(5000, 200).split()
        for k in random.Random(i).sample(range(200), 4):
            own[k] = f"v{i}x{k}"
        docs[200 + i] = " ".join(own)
    docs[215] = prose(5000, 200)
    df = spark.createDataFrame([*docs.items()], "doc_id long, text string").repartition(5)
    found = dict(simhash.similar_groups(df).collect())
    near = union_find(sorted(docs), lambda a, b: jaccard(docs[a], docs[b]) >= 0.8)
    assert {i: found.get(i, i) for i in docs} == near


def test_similar_groups_of_a_family_and_documents_around_it(spark, monkeypatch):
    """Near copies of a base, and many documents that none or few of them are similar to: pairs grow with the documents, not with both numbers'
    product; whoever is similar to a member only is found."""
    def changed(words, marks):
        words = list(words)
        for k, mark in marks:
            words[k] = f"{mark}x{k}"
        return words

    rng = random.Random(8)
    base = prose(6000, 160).split()
    texts = {0: base}
    for i in range(1, 121):  # near to the base
        texts[i] = changed(base, [(k, f"m{i}") for k in rng.sample(range(160), 2)])
    for i in range(200, 320):  # not near enough, alike in one change of them all
        texts[i] = changed(base, [(20, "all"), *((k, f"s{i}") for k in rng.sample(range(40, 160), 4))])
    for i in range(400, 420):  # near to a member only, or to one of the others
        texts[i] = changed(texts[i - 399], [(k, f"n{i}") for k in (15, 80, 140)])
        texts[i + 20] = changed(texts[i - 200], [(k, f"o{i}") for k in (1, 2)])
    texts = {i: " ".join(words) for i, words in texts.items()}
    paired, possible = [], simhash.possible
    monkeypatch.setattr(simhash, "possible", lambda pairs, bitmaps: paired.append(pairs.count()) or possible(pairs, bitmaps))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    found = dict(simhash.similar_groups(df).collect())
    sets = {i: set(simhash.shingle_hashes(t, 5).tolist()) for i, t in texts.items()}
    near = union_find(sorted(texts), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    assert {i: found.get(i, i) for i in texts} == near
    alone = [i for i in texts if sum(root == near[i] for root in near.values()) == 1]
    assert sum(root == 0 for root in near.values()) > 100 and len(alone) > 80
    assert paired[-1] < 4 * len(texts)


def test_one_of_each_takes_simhash_and_similar_pairs(spark):
    """What fingerprints link goes though few five-word shingles are shared, and so does what only these tell."""
    rng = random.Random(12)
    base = [rng.choice(WORDS) for _ in range(3000)]
    texts = {n: " ".join(base[n:n + 60]) for n in (1, 2)} | {7: prose(3, 80)}
    texts |= {20: "x y z " + "a b c " * 400, 21: "x y q " + "a b c " * 400}
    sketch = {i: simhash.simhash(simhash.shingle_hashes(t, 3)) for i, t in texts.items()}
    sets = {i: set(simhash.shingle_hashes(t, 5).tolist()) for i, t in texts.items()}
    by_bits = union_find(texts, lambda a, b: ((sketch[a] ^ sketch[b]) & (1 << 64) - 1).bit_count() <= 2)
    by_sets = union_find(texts, lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    both = union_find(texts, lambda a, b: by_bits[a] == by_bits[b] or by_sets[a] == by_sets[b])
    assert by_bits[21] == 20 != by_sets[21] and by_sets[2] == 1 != by_bits[2]
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id for r in simhash.one_of_each(df).collect()} == {i for i in texts if both[i] == i}
