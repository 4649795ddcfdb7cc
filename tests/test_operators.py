"""Operators on small tables, against brute force."""

import ipaddress
import random

import numpy as np
from pyspark.sql import functions as F

from changewatch.functions import ip
from changewatch.operators.heads import head_by_key
from changewatch.operators.histograms import delay_histogram
from changewatch.operators.quantiles import exact_percentiles
from changewatch.operators.ranges import match_ranges, range_pieces


def test_ranges_match_brute_force(spark):
    rng = random.Random(11)
    ranges = []
    for _ in range(150):
        net = ipaddress.ip_network((rng.getrandbits(16) << 16, rng.randint(0, 32)), strict=False)
        ranges.append((f"{int(net[0]):08X}", f"{int(net[-1]):08X}"))
        a, b = sorted((rng.getrandbits(32), rng.getrandbits(32)))  # not aligned
        ranges.append((f"{a:08X}", f"{b:08X}"))
        net = ipaddress.ip_network((rng.getrandbits(12) << 116, rng.randint(0, 128)), strict=False)
        ranges.append((f"{int(net[0]):032X}", f"{int(net[-1]):032X}"))
    addresses = [f"{rng.getrandbits(32):08X}" for _ in range(150)]
    addresses += [f"{rng.getrandbits(128):032X}" for _ in range(150)]
    addresses += [end for r in ranges[:60] for end in r]
    addresses = sorted(set(addresses))

    pieces = range_pieces(spark.createDataFrame(ranges, "low string, high string"), "low", "high",
                          {"cnt": F.count(F.lit(1))})
    df = spark.createDataFrame([(a, a) for a in addresses], "name string, digits string")
    got = {r.name: r.cnt for r in match_ranges(df, "name", "digits", pieces, {"cnt": F.sum("cnt")})
           .select(F.col("name"), "cnt").collect()}
    expected = {a: sum(len(a) == len(lo) and lo <= a <= hi for lo, hi in ranges) for a in addresses}
    assert got == {a: n for a, n in expected.items() if n}


def test_percentiles_match_numpy(spark):
    rng = random.Random(2)
    data = {"hot": [rng.randint(-5000, 400000) for _ in range(3000)], "one": [7], "two": [1, 4],
            "same": [9] * 50}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs] + [("none", None)],
                               "k string, v bigint")
    got = {(r.k, r.pct): r.value for r in exact_percentiles(
        df, "k", "v", F.sequence(F.lit(0), F.lit(100))).collect()}
    assert len(got) == 4 * 101
    for k, vs in data.items():
        assert np.allclose([got[k, p] for p in range(101)], np.percentile(vs, range(101)))


def bin_edges(maximum):
    for limit, step in ((24, 1), (48, 2), (96, 6), (168, 12), (336, 24)):
        if maximum <= limit:
            return list(range(0, maximum + 1, step))
    return list(range(0, maximum + 1, 48))


def test_delay_histogram_matches_numpy(spark):
    rng = random.Random(4)
    data = {"a": [int(h * 3600) for h in (24.5, 25, 23, 24)],
            "b": [rng.randint(0, 500 * 3600) for _ in range(800)], "c": [3600 * i for i in range(25)],
            "d": [-50, 10, 7200], "e": [0]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "k string, v bigint")
    got = {(r.k, r.bin_start, r.bin_end): r.n for r in delay_histogram(df, "k", "v").collect()}
    expected = {}
    for k, vs in data.items():
        edges = bin_edges(int(np.ceil(max(vs) / 3600)))
        if len(edges) > 1:
            counts, _ = np.histogram(np.array(vs) / 3600, bins=edges)
            expected |= {(k, edges[i], edges[i + 1]): int(n) for i, n in enumerate(counts) if n}
    assert got == expected
    assert sum(n for (k, *_), n in got.items() if k == "a") == 2


def test_head_by_key_with_a_hot_key(spark):
    rng = random.Random(6)
    rows = [("hot" if i % 2 else f"k{i % 7}", rng.randint(0, 50), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, v int, i int")
    got = sorted((r.k, r.position, r.i) for r in head_by_key(
        df, "k", [F.col("v"), F.col("i")], 50, parts=8).collect())
    expected = []
    for key in {r[0] for r in rows}:
        ranked = sorted((v, i) for k, v, i in rows if k == key)[:50]
        expected += [(key, n + 1, i) for n, (_, i) in enumerate(ranked)]
    assert got == sorted(expected)


def test_address_hex_sorts_like_the_number(spark):
    names = ["10.0.0.7", "9.255.0.1", "2001:db8::1", "2001:db8::"]
    rows = spark.createDataFrame([(n,) for n in names], "n string") \
        .withColumn("h", ip.address_hex(F.col("n"))).orderBy(F.length("h"), "h").collect()
    assert [r.n for r in rows] == ["9.255.0.1", "10.0.0.7", "2001:db8::", "2001:db8::1"]
