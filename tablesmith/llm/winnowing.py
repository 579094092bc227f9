"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of every ``window`` words a document keeps the smallest hash of the ``k``-grams inside as its
fingerprint; so does every window of the benchmark. Equal windows have equal fingerprints, hence a
shared span of ``window`` words always meets in the join. A hit is extended: the document's words
around it, as a row of 64-bit word hashes, are compared word by word with the benchmark's window.

Words are runs of ASCII digits and letters and of everything beyond ASCII, A to Z in lower case. An
item with fewer words than a window, but not none, is one window of its own length and is looked for
at every position.

Defined cases: NULL and wordless texts have no words and no hits; a repeated row gets its own result;
items with equal texts are all named; a NULL ``item_id`` is not named; empty tables give no hits;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .shared import lowered, text_key, without, written

#: The benchmark's windows are broadcast up to this number (about 200 bytes each).
BROADCAST_WINDOWS = 200_000


@dataclass(frozen=True)
class Settings:
    window: int = 10
    k: int = 5


def words_of(text: Column) -> Column:
    folded = lowered(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(folded, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _with_hashes(df: DataFrame) -> DataFrame:
    """``text`` becomes ``h``, a hash per word, and ``n``, their number."""
    split = df.withColumn("words", words_of(F.col("text"))).drop("text")
    return split.select("*", F.size("words").alias("n"), F.transform("words", lambda w: F.xxhash64(w)).alias("h")).drop("words")


def _gram(h: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(h, at + k) for k in range(size)])


def _fingerprints(df: DataFrame, s: Settings) -> DataFrame:
    """``f``: the fingerprint of each window, in order. Needs ``h`` and ``n``."""
    inner = s.window - s.k + 1
    enough = F.col("n") >= s.window
    hashed = df.withColumn(
        "g",
        F.when(
            enough,
            F.transform(F.sequence(F.lit(0), F.col("n") - s.k), lambda i: _gram(F.col("h"), i, s.k)),
        ),
    )
    smallest = F.transform(
        F.sequence(F.lit(0), F.col("n") - s.window),
        lambda i: F.least(*[F.get(F.col("g"), i + k) for k in range(inner)]),
    )
    return hashed.withColumn("f", F.when(enough, smallest).otherwise(F.array().cast("array<long>"))).drop("g")


def benchmark_windows(items: DataFrame, s: Settings) -> DataFrame:
    """``fingerprint, span, item_id``: the windows of each item; ``span`` has the words' hashes."""
    source = items.select("item_id", "text")
    hashed = _with_hashes(source).where("n > 0")
    long = _fingerprints(hashed.where(F.col("n") >= s.window), s)
    # Outer, or Spark would repeat the whole expression in a filter on empty arrays below.
    spans = long.select("item_id", "h", F.posexplode_outer("f").alias("at", "fingerprint")).select(
        "fingerprint", F.slice("h", F.col("at") + 1, s.window).alias("span"), "item_id"
    )
    short = hashed.where(F.col("n") < s.window)
    whole = short.select(F.xxhash64("n", "h").alias("fingerprint"), F.col("h").alias("span"), "item_id")
    return spans.union(whole).distinct()


def _every(h: Column, n: Column, size: int) -> Column:
    """Each run of ``size`` words, for benchmark items that have no more."""
    return F.transform(
        F.sequence(F.lit(0), n - size),
        lambda i: F.struct(
            i.alias("at"),
            F.xxhash64(F.lit(size), F.slice(h, i + 1, size)).alias("fingerprint"),
            F.slice(h, i + 1, size).alias("around"),
        ),
    )


def _runs(s: Settings, short: list[int]) -> Column:
    """Of each run of windows with one fingerprint: place, fingerprint and the hashes it covers."""
    f, h, n = F.col("f"), F.col("h"), F.col("n")
    kind = "array<struct<at:int,fingerprint:bigint,around:array<bigint>>>"
    # -1 stands for the place after the last window.
    starts = F.filter(
        F.sequence(F.lit(0), n - s.window),
        lambda i: (i == 0) | (F.get(f, i) != F.get(f, i - 1)),
    )
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(n - s.window + 1))
    runs = F.zip_with(
        starts,
        ends,
        lambda a, b: F.struct(
            a.alias("at"), F.get(f, a).alias("fingerprint"), F.slice(h, a + 1, b - a + s.window - 1).alias("around")
        ),
    )
    parts = [F.when(n >= s.window, runs).otherwise(F.array().cast(kind))]
    for size in short:
        parts.append(F.when(n >= size, _every(h, n, size)).otherwise(F.array().cast(kind)))
    # One entry more in front, so that a document without windows keeps its row.
    first = F.array(F.struct(F.lit(-1).alias("at"), F.lit(None).cast("long").alias("fingerprint"), F.array().cast("array<bigint>").alias("around")))
    return F.concat(first.cast(kind), *parts)


def contamination(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None,
                  carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A row per document: ``carry``, ``row``, ``n_words``, ``n_hit``, ``items`` (sorted as text)."""
    s = settings or Settings()
    windows, _ = written(benchmark_windows(benchmark, s), "windows")
    spans, _ = written(windows.select("fingerprint", "span").distinct(), "spans")
    short = [r[0] for r in spans.select(F.size("span")).distinct().collect() if r[0] < s.window]
    small = spans.count() <= BROADCAST_WINDOWS

    source = docs.select(*carry, "text").withColumn("row", F.monotonically_increasing_id())
    found = _fingerprints(_with_hashes(source), s).select(
        *carry, "row", F.col("n").alias("n_words"), F.explode_outer(_runs(s, short)).alias("run")
    )
    found = found.select(*carry, "row", "n_words", "run.*")
    size = F.size("span")
    places = F.filter(
        F.sequence(F.lit(0), F.size("around") - size),
        lambda i: F.slice(F.col("around"), i + 1, size) == F.col("span"),
    )
    match = found.join(F.broadcast(spans) if small else spans, "fingerprint", "left")
    match = match.withColumn(
        "hits", F.when(F.col("span").isNotNull() & (F.size("around") >= size), places).otherwise(F.array().cast("array<int>"))
    )
    hit = F.when(F.size("hits") > 0, F.transform("hits", lambda i: F.struct(
        (F.col("at") + i).alias("from"), (F.col("at") + i + size).alias("to"))))
    kept = match.where("at < 0 OR size(hits) > 0").select(*carry, "row", "n_words", "span", hit.alias("hit"))
    kept, _ = written(kept, "hits")

    base = kept.where("span IS NULL").select(*carry, "row", "n_words")
    hits = kept.where("span IS NOT NULL").select("row", "span", F.explode("hit").alias("hit"))
    # At most as many spans as the document has words.
    covered = hits.groupBy("row").agg(F.array_sort(F.collect_set("hit")).alias("spans")).select(
        "row",
        F.aggregate(
            "spans",
            F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
            lambda a, x: F.struct(
                F.greatest(a["end"], x["to"]).alias("end"),
                (a["n"] + F.greatest(F.lit(0), x["to"] - F.greatest(x["from"], a["end"]))).alias("n"),
            ),
        )["n"].alias("n_hit"),
    )
    named = kept.where("span IS NOT NULL").select("row", "span").distinct().join(
        windows.select("span", F.col("item_id").cast("string").alias("item")).distinct(), "span"
    )
    items = named.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return (
        base.join(covered, "row", "left")
        .join(items, "row", "left")
        .select(
            *carry,
            "row",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``docs`` but those with a word inside a window of the benchmark."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")
    found = contamination(keyed, benchmark, settings, ("doc_id", "text_key"))
    return without(docs, found.where("n_hit > 0"))
