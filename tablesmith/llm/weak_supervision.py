"""Quality by weak supervision, in DataFrame functions only.

Rules look at a document's measures and vote good, vote bad or abstain. How far each vote can be trusted
is learnt without labels: expectation-maximisation over all documents estimates how often each vote
is cast on good and on bad documents; its accuracy is the share of the two that is right. A document's quality is the posterior probability of being good given the votes
cast on it; it takes the place of a filter that every rule must pass. An abstention is no evidence, so
junk of one kind is not excused by the rules against junk of another.

Votes form at most 3^rules patterns, whose counts over all documents are all that the rounds read; a
round gives four sums a rule back. Two different windows of words share a 64-bit hash with odds of
2^-64 a pair; everything else is exact.

Defined results: NULL and empty texts have no words and fail the base check; a text without letters or
lines has none, and rules that need some abstain; equal rows are judged alike and each count; an empty
table leaves the model at its start and gives no rows. A very long text is one row's work, linear but
for a sort of its repeated windows. Other columns are kept by ``good_documents`` whatever their names,
and ignored elsewhere.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .shared import text_key, without, written

SPACE = r"\x20\x09-\x0D"
WINDOW = 5
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_letters",
    "n_capitals",
    "n_ended_lines",
    "n_vocabulary",
)


@dataclass(frozen=True)
class Rule:
    """Conditions over the measures; where neither holds, the rule abstains."""

    name: str
    good: str = "false"
    bad: str = "false"


RULES = (
    Rule("word_length", bad="word_chars > 12 * n_words OR word_chars < 2 * n_words"),
    Rule("symbols", bad="20 * n_symbols > word_chars"),
    Rule("equal_lines", bad="10 * n_dup_lines > 3 * n_lines"),
    Rule("repeats", bad="10 * n_repeat_words > n_words"),
    Rule("letters", bad="4 * n_letters < 3 * word_chars"),
    Rule("capitals", bad="10 * n_capitals > 3 * n_letters"),
    Rule("sentences", "10 * n_ended_lines >= 7 * n_lines AND n_lines > 0", "10 * n_ended_lines < 3 * n_lines"),
    Rule("vocabulary", "10 * n_vocabulary >= 3 * n_words AND n_words >= 50", "10 * n_vocabulary < n_words AND n_words >= 50"),
)


@dataclass(frozen=True)
class Settings:
    rules: tuple[Rule, ...] = RULES
    rounds: int = 15
    #: The share of good documents before any vote is seen. It is given, not learnt: most documents are
    #: voted on by hardly any rule, and would take on any share.
    share: float = 0.9
    #: Where the rounds begin: how often votes are cast on (good, bad) documents.
    good_vote: tuple[float, float] = (0.5, 0.25)
    bad_vote: tuple[float, float] = (0.02, 0.25)
    #: Documents' worth of belief in that, so that a vote that is hardly ever cast stays near it.
    belief: float = 10.0
    kept: float = 0.5


@dataclass(frozen=True)
class Model:
    """Per rule, how often it votes good and how often bad, each on (good, bad) documents."""

    settings: Settings
    good_votes: tuple[tuple[float, float], ...]
    bad_votes: tuple[tuple[float, float], ...]

    def accuracies(self) -> dict[str, tuple[float, float]]:
        """Per rule, how often its good and its bad votes are right where both kinds of document are
        equally many."""
        pairs = zip(self.settings.rules, self.good_votes, self.bad_votes, strict=True)
        return {rule.name: (g[0] / sum(g), b[1] / sum(b)) for rule, g, b in pairs}


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _count(text: Column, pattern: str) -> Column:
    """Characters of the text that ``pattern``, a run of all others, does not match."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key`` and the measures of each document."""
    df = docs.select(F.struct("doc_id", text_key(F.col("text")).alias("text_key")).alias("kept"), "text")
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, f"[{SPACE}]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    df = df.select("kept", text.alias("text"), F.transform(words, lambda w: F.xxhash64(w)).alias("h"), lines.alias("lines"))
    n = F.size("h")
    windows = F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(WINDOW)])
    )
    df = df.select(
        "kept",
        n.cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _count(F.col("text"), r"\P{L}+").alias("n_letters"),
        _count(F.col("text"), r"\P{Lu}+").alias("n_capitals"),
        F.size(F.filter("lines", lambda line: line.rlike(rf"[.!?…][{SPACE}]*\z"))).cast("long").alias("n_ended_lines"),
        F.size(F.array_distinct("h")).cast("long").alias("n_vocabulary"),
        F.when(n >= WINDOW, windows).alias("windows"),
    )
    # Only texts with a repeated window are sorted.
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.transform("windows", lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    df = df.withColumn("placed", F.when(twice, F.sort_array(placed))).drop("windows")

    def met(p: Column, j: Column) -> Column:
        same = [F.get("placed", j + k)["x"] == p["x"] for k in (-1, 1)]
        return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

    df = df.withColumn("at", F.sort_array(F.transform(F.filter("placed", met), lambda p: p["i"]))).drop("placed")
    # Windows overlap: each adds the words up to the next one.
    added = F.transform("at", lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get("at", j + 1) - i, F.lit(WINDOW))))
    repeated = F.aggregate(added, F.lit(0).cast("long"), lambda total, x: total + x)
    df = df.withColumn("n_repeat_words", F.coalesce(repeated, F.lit(0).cast("long")))
    return df.select("kept.*", *MEASURES)


def vote(rule: Rule) -> str:
    """1 for good, -1 for bad, 0 for none."""
    return f"CASE WHEN {rule.good} THEN 1 WHEN {rule.bad} THEN -1 ELSE 0 END"


def _posterior(votes: list[str], model: Model) -> str:
    """Probability of being good, given the votes cast."""
    share = model.settings.share
    terms = [math.log(share / (1 - share))]
    cast = zip(votes, model.good_votes, model.bad_votes, strict=True)
    terms += [
        f"CASE {v} WHEN 1 THEN {math.log(good[0] / good[1])!r}D WHEN -1 THEN {math.log(bad[0] / bad[1])!r}D ELSE 0D END"
        for v, good, bad in cast
    ]
    return f"1 / (1 + exp(-({terms[0]!r}D + {' + '.join(terms[1:])})))"


def fit(measures: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from the measures of all documents, without labels."""
    rules, belief = settings.rules, settings.belief
    names = [f"v{j}" for j in range(len(rules))]
    patterns = measures.selectExpr(*[f"{vote(rule)} AS {name}" for rule, name in zip(rules, names, strict=True)])
    patterns, _ = written(patterns.groupBy(*names).agg(F.count("*").cast("double").alias("n")), "votes")
    # How many good and bad documents there are, and what they cast: all good votes, then all bad ones.
    cast = [f"sum(CASE WHEN {v} = {x} THEN {of} ELSE 0D END)" for x in (1, -1) for v in names for of in ("good", "bad")]
    model = Model(settings, (settings.good_vote,) * len(rules), (settings.bad_vote,) * len(rules))
    for _ in range(settings.rounds):
        expected = patterns.selectExpr(*names, "n", f"n * ({_posterior(names, model)}) AS good")
        expected = expected.selectExpr(*names, "good", "n - good AS bad")
        found = [x or 0.0 for x in expected.selectExpr("sum(good)", "sum(bad)", *cast).first()]
        size, counts = found[:2], found[2:]

        def rates(counts, start):
            """The votes' rates on good and bad documents, drawn towards ``start``."""
            shares = [(c + belief * start[k % 2]) / (size[k % 2] + belief) for k, c in enumerate(counts)]
            return tuple(zip(shares[0::2], shares[1::2], strict=True))

        half = len(counts) // 2
        model = Model(settings, rates(counts[:half], settings.good_vote), rates(counts[half:], settings.bad_vote))
    return model


def judged(measures: DataFrame, model: Model) -> DataFrame:
    """The measures with ``quality`` (0 to 1), ``base_failed`` and ``good``: the verdict."""
    votes = [vote(rule) for rule in model.settings.rules]
    rows = measures.withColumns({"quality": F.expr(_posterior(votes, model)), "base_failed": base_failed()})
    return rows.withColumn("good", ~F.col("base_failed") & (F.col("quality") >= model.settings.kept))


def quality(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``text_key``, the measures, ``quality``, ``base_failed`` and ``good`` of each document.
    Texts are read once."""
    measures, _ = written(measured(docs), "measures")
    return judged(measures, fit(measures, settings))


def good_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents judged good, with all their columns."""
    return without(docs, quality(docs, settings).where("not good"))
