"""Exact nearest neighbours of binary codes by multi-index hashing.

A 64-bit code is cut into ``m`` segments. If two codes differ in fewer than ``m * (r + 1)`` bits, some
segment differs in ``r`` at most. So each query looks its segments up with every change of 0, 1, 2 ...
bits, some segments at a time: once ``j`` segments have been looked up with radius ``r`` and all with
``r - 1``, all codes within ``m * r + j - 1`` bits are known. Found codes are verified by their whole
distance, and a query is done once that covered distance holds its k-th neighbour; until then, what
is further than the k-th so far is dropped where it is met. The number of segments follows the number of codes, one bit of width for every doubling.

Equal codes are searched once: of a code's rows only the k smallest ids can be among its neighbours,
which is all that is kept of a hot code.

Defined cases: ties are broken by id; a row with a NULL or empty vector, or a NULL id, has no code: it
is found by no query and, as a query, finds nothing; with fewer than k other rows all are returned; a
repeated id counts once per code; vectors longer than 64 are refused; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb, log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import written

BITS = 64


def sign_code(vector: Column) -> Column:
    """Bit i is set where the vector's element i is above zero; a missing element leaves it unset."""
    bits = [
        F.when(F.get(vector, F.lit(i)) > 0, F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long"))
        for i in range(BITS)
    ]
    whole = reduce(lambda a, b: a.bitwiseOR(b), bits)
    fits = F.when(F.size(vector) <= BITS, whole).otherwise(
        F.raise_error(F.lit(f"a vector is longer than {BITS}")).cast("long")
    )
    return F.when(F.size(vector) > 0, fits)


def _segments(n: int) -> list[tuple[int, int]]:
    """Offset and width of each segment."""
    # About four codes share a segment's value: looking at four costs less than making four changes.
    width = min(max(round(log2(max(n, 2))) - 2, 1), 32)
    m = -(-BITS // width)
    edges = [k * BITS // m for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _cut(df: DataFrame, segments: list[tuple[int, int]], chosen) -> DataFrame:
    """A row per code and chosen segment."""
    parts = [
        F.struct(
            F.lit(k).alias("segment"),
            F.shiftrightunsigned("code", at).bitwiseAND(F.lit((1 << width) - 1).cast("long")).alias("value"),
        )
        for k, (at, width) in enumerate(segments)
        if k in chosen
    ]
    return df.select("*", F.explode(F.array(*parts)).alias("s")).select("*", "s.*").drop("s")


def _changes(spark, segments: list[tuple[int, int]], chosen, radius: int) -> DataFrame:
    """Every change of ``radius`` bits in each chosen segment: a row for each choice of bits."""
    rows = [
        (k, sum(1 << b for b in bits))
        for k, (_, width) in enumerate(segments)
        if k in chosen
        for bits in combinations(range(width), radius)
    ]
    segment, change = zip(*rows, strict=True) if rows else ((), ())
    table = pa.table({"segment": pa.array(segment, pa.int32()), "change": pa.array(change, pa.int64())})
    return spark.createDataFrame(table)


def _steps(segments: list[tuple[int, int]]) -> list[tuple[int, list[int]]]:
    """Radius and segments of each step: all segments at once while that is little, then quarters."""
    everything, out = list(range(len(segments))), []
    quarter = -(-len(segments) // 4)
    for radius in range(max(width for _, width in segments) + 1):
        size = len(segments) if radius < 2 else quarter
        out += [(radius, everything[k : k + size]) for k in range(0, len(segments), size)]
    return out


def nearest(codes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, id, distance``: of each query (``id, code``) the k nearest rows of ``codes``
    (``id, code``) but itself."""
    spark = codes.sparkSession
    wanted = k + 1  # the query may be among its own neighbours
    ranked = Window.partitionBy("code").orderBy("id")
    known = codes.where(F.col("id").isNotNull() & F.col("code").isNotNull()).select("id", "code").distinct()
    rows, _ = written(known.withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= wanted).drop("r"), "codes")
    index, _ = written(rows.groupBy("code").agg(F.count("*").alias("n")), "index")
    n = index.count()
    segments = _segments(n)
    postings, _ = written(_cut(index, segments, range(len(segments))), "segments")
    asked = queries.where(F.col("id").isNotNull() & F.col("code").isNotNull())
    asked, _ = written(asked.select(F.col("id").alias("query_id"), "code").distinct(), "queries")
    # ``reach`` is the distance of the k-th neighbour so far.
    open_, _ = written(asked.select("code").distinct().withColumn("reach", F.lit(None).cast("int")), "open")
    found, done = None, []
    for radius, chosen in _steps(segments):
        changes = _changes(spark, segments, chosen, radius)
        # At most comb(32, radius) rows a segment; the bound is checked before broadcasting.
        small = sum(comb(segments[k][1], radius) for k in chosen) <= 200_000
        probes = _cut(open_, segments, chosen).withColumnRenamed("code", "query")
        probes = probes.join(F.broadcast(changes) if small else changes, "segment")
        probes = probes.select("query", "reach", "segment", F.col("value").bitwiseXOR(F.col("change")).alias("value"))
        met = probes.join(postings, ["segment", "value"])
        met = met.withColumn("distance", F.bit_count(F.col("query").bitwiseXOR(F.col("code"))))
        met = met.where("reach IS NULL OR distance <= reach").select("query", "code", "n", "distance").distinct()
        if found is not None:
            still = found.join(open_.select(F.col("code").alias("query")), "query", "left_semi")
            met = still.unionByName(met).distinct()
        met, _ = written(met, "met")
        sums = met.groupBy("query", "distance").agg(F.sum("n").alias("n"))
        closer = Window.partitionBy("query").orderBy("distance")
        reach = (
            sums.withColumn("upto", F.sum("n").over(closer)).where(F.col("upto") >= wanted)
            .groupBy("query").agg(F.min("distance").alias("reach"))
        )
        last = (radius, chosen) == _steps(segments)[-1]
        covered = len(segments) * radius + chosen[-1]
        over = F.col("reach").isNotNull() & (F.col("reach") <= covered) | F.lit(last)
        kept = met.join(reach, "query", "left").where("reach IS NULL OR distance <= reach")
        kept, _ = written(kept.withColumn("over", over), "found")
        done.append(kept.where("over").drop("reach", "over"))
        found = kept.where("NOT over").drop("reach", "over")
        # A query that has met nothing yet stays open, too.
        now = kept.groupBy(F.col("query").alias("code")).agg(F.max("over").alias("over"), F.min("reach").alias("now"))
        open_ = open_.join(now, "code", "left").where("over IS NULL OR NOT over")
        open_, _ = written(open_.select("code", F.coalesce("now", "reach").alias("reach")), "open")
        if last or open_.isEmpty():
            break
    neighbours = reduce(DataFrame.unionByName, done)
    pairs = neighbours.select("query", "code", "distance").join(rows, "code")
    whole = pairs.join(asked.withColumnRenamed("code", "query"), "query").where(F.col("id") != F.col("query_id"))
    nearestfirst = Window.partitionBy("query_id").orderBy("distance", "id")
    return (
        whole.withColumn("rank", F.row_number().over(nearestfirst))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", F.col("distance").cast("int").alias("distance"))
    )
