"""Mixing sources to target weights, in DataFrame functions only.

A source with the share ``p`` of all tokens gets a weight in proportion to ``p ** exponent``: 1 keeps
the shares, 0 makes all sources equal. The exponent is bisected: the largest that reaches the target
entropy, but none under which the smallest source would be repeated more often than the limit.

Documents are dealt by a hash into ``cells`` blocks per source. For each epoch a source's blocks are
permuted, and whole blocks are taken until the source's budget of tokens is reached, so a budget is
met to half a block. All sources' blocks are merged by the share of the budget that was used before
them, which is the column ``turn``: any stretch of turns has the target weights. Only sums per block
are shuffled; documents meet their block's turns in a join with those few rows.

Without a budget, the smallest one is used under which every document occurs once or more.

Defined cases: a NULL source is a source of its own; NULL and empty texts count no tokens and stay
with their block; a source without any token occurs once; repeated rows are dealt together; an empty
table gives an empty result. Tokens are words between ASCII white space.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import written

#: Rows of the schedule (block and epoch) that are broadcast at most.
BROADCAST_ROWS = 500_000
#: The exponent is found to one part in 2**STEPS, LEVELS bisections at a time.
STEPS, LEVELS = 20, 5
#: What a document of the mixture has besides its own columns; old ones of these names are replaced.
NEW_COLUMNS = ("mix_cell", "mix_epoch", "mix_turn")


@dataclass(frozen=True)
class Settings:
    entropy: float = 0.95  # of the largest possible one, the logarithm of the number of sources
    repetition: float = 2.0  # how often the smallest source is seen for once of the largest
    budget: int | None = None  # tokens
    cells: int = 1024
    seed: int = 1


def n_tokens(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def _draw(*parts) -> Column:
    """A number below 2**32 from the parts' text."""
    text = F.concat_ws(":", *[F.coalesce(F.col(p).cast("string"), F.lit("-")) if isinstance(p, str) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _holds(sources: DataFrame, s: Settings, tries: list[int]) -> list[int]:
    """Those of the tried exponents (in parts of 2**STEPS) that keep the repetition limit and, in
    this order, those that reach the entropy: one job, a row per try."""
    rows = sources.select("share", F.explode(F.array(*[F.lit(t) for t in tries])).alias("try"))
    power = F.pow(F.col("share"), F.col("try") / F.lit(float(1 << STEPS)))
    sums = rows.groupBy("try").agg(
        F.sum(power).alias("s"),
        F.sum(power * F.ln("share")).alias("t"),
        F.max("share").alias("high"),
        F.min("share").alias("low"),
        F.count("*").alias("k"),
    )
    exponent = F.col("try") / F.lit(float(1 << STEPS))
    entropy = F.ln("s") - exponent * F.col("t") / F.col("s")
    return sums.select(
        "try",
        (entropy >= s.entropy * F.ln("k")).alias("even"),
        (F.pow(F.col("high") / F.col("low"), 1 - exponent) <= s.repetition).alias("kept"),
    ).collect()


def exponent(sources: DataFrame, s: Settings) -> int:
    """In parts of 2**STEPS. ``sources`` has ``share``, above zero."""

    def bisect(test: str, low: int, high: int, rising: bool) -> int:
        """The last value in [low, high] that passes if passing ends there, else the first that passes."""
        while high - low > 1:
            width = high - low
            tries = sorted({low + width * k // (1 << LEVELS) for k in range(1, 1 << LEVELS)} - {low, high})
            passed = {r["try"] for r in _holds(sources, s, tries) if r[test]}
            for t in tries:
                if (t in passed) == rising:
                    high = min(high, t)
                else:
                    low = max(low, t)
            if low > high:
                low, high = high, low
        return high if rising else low

    if sources.isEmpty():
        return 1 << STEPS
    top = 1 << STEPS
    ends = {r["try"]: r for r in _holds(sources, s, [0, top])}
    by_entropy = top if ends[top]["even"] else 0 if not ends[0]["even"] else bisect("even", 0, top, False)
    by_limit = 0 if ends[0]["kept"] else bisect("kept", 0, top, True)
    return max(by_entropy, by_limit)


def schedule(docs: DataFrame, settings: Settings | None = None, id_col="doc_id", source_col="source") -> DataFrame:
    """``source, cell, epoch, turn`` of every block that is taken."""
    s = settings or Settings()
    dealt = docs.select(
        F.col(source_col).cast("string").alias("source"),
        (_draw(s.seed, id_col) % s.cells).alias("cell"),
        n_tokens(F.col("text")).alias("n"),
    )
    cells, _ = written(dealt.groupBy("source", "cell").agg(F.sum("n").alias("size")), "cells")
    sums = cells.groupBy("source").agg(F.sum("size").alias("total"))
    whole = sums.agg(F.sum("total")).first()[0] or 0
    shares, _ = written(sums.withColumn("share", F.col("total") / F.lit(float(max(whole, 1)))), "shares")
    used = shares.where("total > 0")
    power = exponent(used, s) / (1 << STEPS)
    largest = used.agg(F.max("share")).first()[0] or 1.0
    # How often a source is seen: 1 for the largest one if there is no budget.
    times = F.pow(F.lit(largest) / F.col("share"), F.lit(1 - power))
    scale = 1.0
    if s.budget is not None:
        scale = s.budget / (used.select(F.sum(F.col("total") * times)).first()[0] or 1.0)
    times = F.when(F.col("total") > 0, times * scale).otherwise(F.lit(1.0))
    plan = shares.select("source", "total", times.alias("times"))
    epochs = plan.select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil("times") - 1, F.lit(0)).cast("int"))).alias("epoch"))
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    placed = cells.alias("a").join(epochs.alias("b"), same).select("a.source", "cell", "size", "total", "times", "epoch")
    order = Window.partitionBy("source", "epoch").orderBy(_draw(s.seed, "source", "epoch", "cell"), "cell")
    before = F.sum("size").over(order) - F.col("size") / 2 + F.col("epoch") * F.col("total")
    quota = F.col("times") * F.col("total")
    return (
        placed.withColumn("middle", before)
        .where((F.col("middle") <= quota) | (F.col("total") == 0))
        .select(
            "source",
            "cell",
            "epoch",
            F.when(F.col("total") > 0, F.round(F.col("middle") / quota, 6)).otherwise(F.lit(0.0)).alias("turn"),
        )
    )


def mixed_documents(docs: DataFrame, settings: Settings | None = None, id_col="doc_id", source_col="source") -> DataFrame:
    """Every document as often as the mixture takes it, with ``mix_cell``, ``mix_epoch`` and
    ``mix_turn``. Sorted by turn, then by any hash, that is the order of training."""
    s = settings or Settings()
    turns, _ = written(schedule(docs, s, id_col, source_col), "turns")
    small = turns.count() <= BROADCAST_ROWS
    made = uuid.uuid4().hex
    source, cell, epoch, turn, of = (f"{name}_{made}" for name in ("source", "cell", "epoch", "turn", "of"))
    turns = turns.toDF(source, cell, epoch, turn)
    turns = F.broadcast(turns) if small else turns
    kept = [F.col(f"`{name}`") for name in docs.columns if name not in NEW_COLUMNS]
    here = docs.withColumn(of, _draw(s.seed, id_col) % s.cells)
    same = here[source_col].cast("string").eqNullSafe(F.col(source)) & (F.col(of) == F.col(cell))
    new = [F.col(have).alias(name) for have, name in zip((cell, epoch, turn), NEW_COLUMNS, strict=True)]
    return here.join(turns, same).select(*kept, *new)


def in_turn(docs: DataFrame, settings: Settings | None = None, id_col="doc_id", source_col="source") -> DataFrame:
    """``mixed_documents`` in the order of training, from the first partition to the last; so are the files
    it is written to."""
    mixed = mixed_documents(docs, settings, id_col, source_col)
    order = (F.col("mix_turn"), F.xxhash64(id_col, "text"))
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order)
