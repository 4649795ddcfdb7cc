"""Parsing, addresses and numbers against Python's own modules."""

import ipaddress
import random
import re
from datetime import datetime

import numpy as np
from pyspark.sql import functions as F

from changewatch.functions import ip, values
from changewatch.functions.actions import ACTIONS, UNIONS, action_map, actions_of
from changewatch.functions.summary import with_summary

SUMMARIES = [
    "/* wbsetlabel-add:1|de */ foo", "/* wbsetclaim-create:2||1 */ [[Property:P31]]: [[Q5]]",
    "/* clientsitelink-remove:1||enwiki */ Foo", "/* undo:0||123|Bob */",
    "/* clientsitelink-update:0|enwiki|enwiki:A|enwiki:B */",
    "/* wbeditentity-update-languages-short:0||de, en */", "/* None */ x", "plain", None, "",
    "/* wbsetlabel-set:1|de */ a b", "/* a:1|x\ny */ z", "/* a:1|x */ y\nz", "/*  */ x */",
    "/* undo: */", "/* undo:7 */ x", "/* a:1|b|c|d|e */", "/* a */ x */ [[Property:P1]]: y",
    "/* wbsetclaim:1| */ [[Property:P12]]: ", "/* wbsetclaim:1| */ [[Property:Q12]]: x",
]


def expected_summary(text):
    def groups(pattern, value, n):
        m = re.search(pattern, value) if value is not None else None
        return list(m.groups()) if m else [None] * n

    magic, free = groups(r"^\/\* (.+?) \*\/ ?(.*)?", text, 2)
    action, rest = groups(r"^([a-z\-]+):(.*)", magic, 2)
    params = groups(r"^([0-9]+)\|([^\|]+)?[\|]?([^\|]+)?[\|]?([^\|]+)?", rest, 4)
    claim = free if action in actions_of("allclaims") else None
    prop, value = groups(r"^\[\[Property:(P[0-9]+)]]: (.*)$", claim, 2)
    category = next((c for c, names in ACTIONS.items() if action in names), "NO_CAT")
    return [magic, free, action, rest, *params, prop, value, category]


def test_summary_matches_python(spark):
    rng = random.Random(7)
    pieces = ["/* ", " */", "*/", "a", "undo", "wbsetclaim", ":", "|", "1", "23", " ", "\n", "de", "-",
              "[[Property:", "P5", "]]", ": ", "x"]
    texts = SUMMARIES + ["/* " * (rng.random() < .8) + "".join(rng.choices(pieces, k=rng.randint(1, 14)))
                         for _ in range(3000)]
    df = with_summary(spark.createDataFrame([(i, t) for i, t in enumerate(texts)],
                                            "i int, comment_text string"))
    columns = ["summary_magic", "summary_free", "summary_action", "summary_rest", "summary_param0",
               "summary_param1", "summary_param2", "summary_param3", "summary_property",
               "summary_value", "summary_category"]
    for row in df.select("i", *columns).collect():
        assert [row[c] for c in columns] == expected_summary(texts[row.i]), texts[row.i]


def expected_network(name):
    try:
        return ipaddress.ip_network(name, strict=False)
    except ValueError:
        return None


def test_addresses_match_python(spark):
    rng = random.Random(3)
    names = [
        "User 1", "10.0.0.7", "1.2.3.4/16", "10.20.30.40/21", "256.1.1.1", "1.2.3", "01.2.3.4",
        "1.2.3.4/33", "1::2::3", "cafe", "Alice/Bob", "~2025-123", "1.2.3.4/32", "::/0", "0.0.0.0/0",
        "2001:db8::/32", "1:2:3:4:5:6:7::", "1::2:3:4:5:6:7:8", "::1", "::", ":::", "1:", ":1",
        "::ffff:1.2.3.4", "1.2.3.4/255.255.0.0", "1.2.3.4/0.0.255.255", "12345::", "a:b:c:d:e:f:1:2",
        "1.2.3.4/", "/8", "1.2.3.4/a", "::1/129", "::1/128", "1.2.3.4/255.0.255.0", "",
    ]
    for _ in range(300):
        names.append(f"{ipaddress.IPv4Address(rng.getrandbits(32))}/{rng.randint(0, 32)}")
        names.append(f"{ipaddress.IPv6Address(rng.getrandbits(128))}/{rng.randint(0, 128)}")
        names.append(str(ipaddress.IPv6Address(rng.getrandbits(16) << rng.choice([0, 32, 96]))))
    df = ip.with_user_kind(spark.createDataFrame([(n,) for n in names], "name string"), "name") \
        .withColumnRenamed("user_type", "type")
    for row in df.collect():
        network = expected_network(row["name"])
        if network is None:
            assert (row["type"], row["low"], row["high"]) == ("registered", None, None), row
            continue
        width = 8 if network.version == 4 else 32
        kind = f"ipv{network.version}" + ("range" if network.num_addresses > 1 else "")
        assert row["type"] == kind, row
        assert row["low"] == f"{int(network.network_address):0{width}X}", row
        assert row["high"] == f"{int(network.broadcast_address):0{width}X}", row


def test_rounding_is_half_even(spark):
    row = spark.range(1).select(
        values.round_half_even(F.lit(3.125), 2).alias("a"),
        values.round_half_even(F.lit(33.25), 1).alias("b"),
        values.percent(F.lit(1), F.lit(0), 2).alias("c")).first()
    assert (row.a, row.b, row.c) == (3.12, 33.2, None)


def test_time_and_number_parsing_is_tolerant(spark):
    df = spark.createDataFrame([("20240229123456", "Q42"), ("20230229000000", "Qx"), ("2024", "Q"),
                                (None, None), ("2024022912345x", "L7")], "t string, q string")
    rows = df.select(values.parse_time(F.col("t")).alias("t"),
                     values.item_number(F.col("q")).alias("q")).collect()
    assert [r.t for r in rows] == [datetime(2024, 2, 29, 12, 34, 56), None, None, None, None]
    assert [r.q for r in rows] == [42, None, None, None, 7]


def test_equal_width_bins_match_numpy(spark):
    rng = np.random.default_rng(5)
    for data in (rng.random(2000), np.arange(0, 1001) / 1000, np.array([0.3] * 5),
                 np.linspace(0.1, 0.9, 102)):
        counts, _ = np.histogram(data, bins=101)
        df = spark.createDataFrame([(float(x),) for x in data], "x double")
        low, high = float(data.min()), float(data.max())
        got = {r.bin: r.n for r in df.groupBy(values.equal_width_bin(
            F.col("x"), F.lit(low), F.lit(high), 101).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")).collect()}
        assert got == {i: int(n) for i, n in enumerate(counts) if n}


def test_action_map(spark):
    rows = {r.category: r.actions for r in action_map(spark).collect()}
    assert set(rows) == set(ACTIONS) | set(UNIONS)
    assert rows["revert"] == "undo, restore"
    assert rows["allsitelinks"].startswith("wbsetsitelink-add, ")
    names = [n for f in ACTIONS.values() for n in f]
    assert len(names) == len(set(names))
