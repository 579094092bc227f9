"""Measures, rounds and verdicts of weak supervision against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tablesmith.llm import weak_supervision as ws

SPACE = r"\x20\x09-\x0D"


def measures(text):
    text = text or ""
    words = re.findall(f"[^{SPACE}]+", text)
    lines = [line for line in text.split("\n") if re.search(f"[^{SPACE}]", line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered.update(range(i, i + 5))
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines),
        len(lines) - len(set(lines)),
        len(covered),
        sum(c.isalpha() for c in text),
        sum(c.isupper() for c in text),
        sum(bool(re.search(rf"[.!?…][{SPACE}]*\Z", line)) for line in lines),
        len(set(words)),
    )


def texts():
    draw = random.Random(6)
    some = ["a b c d e", "Aa. Bb", "x\n\ny.\nx\n \nx", "é漢 | $$ <a> b c"]
    for _ in range(30):
        some.append(" ".join(draw.choice("abc") for _ in range(draw.randint(0, 60))))
    some.append("One two three four five six. " * 4)
    return some


def test_measures_equal_plain_python(spark, awkward):
    rows = [(i, t) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(awkward.select(F.col("doc_id") + 1000, "text"))
    found = ws.measured(docs).drop("text_key").collect()
    expected = [(r.doc_id, *measures(r.text)) for r in docs.collect()]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def plain_fit(votes, settings):
    n = len(settings.rules)
    good, bad = [settings.good_vote] * n, [settings.bad_vote] * n

    def posterior(v):
        logit = math.log(settings.share / (1 - settings.share))
        for j, x in enumerate(v):
            pair = {1: good[j], -1: bad[j]}.get(x)
            logit += math.log(pair[0] / pair[1]) if pair else 0
        return 1 / (1 + math.exp(-logit))

    for _ in range(settings.rounds):
        weights = [(v, posterior(v)) for v in votes]
        size = (sum(g for _, g in weights), sum(1 - g for _, g in weights))

        def rate(j, x, start):
            hits = (sum(g for v, g in weights if v[j] == x), sum(1 - g for v, g in weights if v[j] == x))
            return tuple((h + settings.belief * s) / (z + settings.belief) for h, z, s in zip(hits, size, start))

        good, bad = [rate(j, 1, settings.good_vote) for j in range(n)], [rate(j, -1, settings.bad_vote) for j in range(n)]
    return good, bad, [posterior(v) for v in votes]


def test_rounds_equal_a_plain_loop(spark):
    draw = random.Random(7)
    rows = [(i, draw.choice([3, 30, 300]), draw.choice([0, 0, 0, 9]), draw.choice([0, 5])) for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, n_words long, n_repeat_words long, n_symbols long")
    rules = (
        ws.Rule("length", "n_words > 200", "n_words < 10"),
        ws.Rule("repeats", bad="n_repeat_words > 1"),
        ws.Rule("symbols", bad="n_symbols > 1 AND n_words < 100"),
    )
    settings = ws.Settings(rules=rules, rounds=6)
    votes = [
        (1 if n > 200 else -1 if n < 10 else 0, -1 if r > 1 else 0, -1 if s > 1 and n < 100 else 0) for _, n, r, s in rows
    ]
    good, bad, posterior = plain_fit(votes, settings)
    model = ws.fit(table, settings)
    for found, expected in ((model.good_votes, good), (model.bad_votes, bad)):
        assert all(abs(a - b) < 1e-9 for x, y in zip(found, expected) for a, b in zip(x, y))
    judged = {r.doc_id: r for r in ws.judged(table, model).collect()}
    for (i, n, r, _), p in zip(rows, posterior):
        assert abs(judged[i].quality - p) < 1e-9
        assert judged[i].base_failed == (n < 10 or 100 * r > 20 * n)
        assert judged[i].good == (not judged[i].base_failed and judged[i].quality >= 0.5)


def test_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality is not null")
    found = ws.quality(spark.read.parquet(f"{folder}/documents.parquet")).select("doc_id", "good", "base_failed")
    rows = found.join(labels, "doc_id").collect()
    assert sum(r.good == (r.quality == 1) for r in rows) > 0.97 * len(rows)


def test_good_documents_keep_their_columns(spark, awkward, nothing):
    kept = ws.good_documents(awkward)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.collect()} <= {r.doc_id for r in awkward.collect()}
    assert ws.good_documents(nothing).collect() == [] and ws.quality(nothing).collect() == []
    clash = awkward.select("*", *[F.lit(1).alias(c) for c in ("kept", "quality", "good", "n_words", "h", "at", "text_key")])
    assert ws.good_documents(clash).columns == clash.columns
    assert ws.good_documents(clash).count() == kept.count()


def test_no_python_in_the_plan(spark, awkward):
    measures = ws.measured(awkward)
    plan = ws.judged(measures, ws.fit(measures))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
