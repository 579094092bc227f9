"""The trie of conversations against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tablesmith.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    members, kids, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, those in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(those) - 1) * len(node[-1][1]) if node else 0
            leaves[node[:d]] += kids[node] == 0
    return sorted(
        (
            (
                min(those),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(those),
                kids[node],
                leaves[node],
                saved[node],
                hashlib.sha256(",".join(str(c) for c in sorted(those) if len(rebuilt[c]) == len(node)).encode()).hexdigest(),
            )
            for node, those in members.items()
        ),
        key=str,
    )


def rows_of(spark, rows, band, parts=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumn("d", F.lit("clash")).withColumn("a", F.lit(1))
    return sorted((tuple(r) for r in trie.prefix_trie(df, trie.Settings(band)).collect()), key=str)


@pytest.mark.parametrize("band", [4, 16])
def test_trie_equals_brute_force(spark, band):
    draw = random.Random(4)
    rows = []
    # Families, ids below zero, ties, NULLs in every column, turnless and very long conversations.
    for c in [*range(-103, -97), *range(-3, 12), *range(1000, 1008), None]:
        for t in range(draw.choice([0, 1, 3, 8, 40])):
            rows.append((c, draw.choice([t, t, None, 3]), draw.choice(["user", "a", None]), draw.choice(["x", "yy", "", "z\n", None, "é漢"])))
    rows += [(5000, t, "user", "q") for t in range(70)] + [(5001, t, "user", "q") for t in range(60)]
    rows += [(7000, None, "u", "same")] * 60
    assert rows_of(spark, rows, band) == brute(rows)


def test_a_conversation_over_many_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(1, t, "user", str(t % 3)) for t in range(400)] + [(2, t, "user", str(t % 3)) for t in range(390)]
        df = spark.createDataFrame(rows, SCHEMA)
        assert trie._turns(df).groupBy("part").count().count() > 2
        assert rows_of(spark, rows, 8) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_table_and_one_turn(spark):
    assert rows_of(spark, [], 16) == []
    assert rows_of(spark, [(None, 1, "user", "x")], 16) == []
    assert rows_of(spark, [(-5, 1, "user", "x")], 16) == brute([(-5, 1, "user", "x")])
    with pytest.raises(ValueError):
        trie.Settings(1)
