"""The queries of this subpackage over the test tables, with the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    compression_quality,
    ftrl_toxicity,
    hamming_search,
    hmm_language_model,
    huffman_ids,
    hyperdimensional_language,
    jaccard_join,
    personal_data,
    prefix_trie,
    temperature_mixing,
    weak_supervision,
    whitening,
    winnowing,
)
from .shared import remainder

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def checked(name: str, sql: str | None = None):
    def register(function):
        _QUERIES[name] = function
        if sql is not None:
            _SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@checked("op1_huffman_ids")
def _op1(spark, folder):
    docs = table(spark, folder, "documents")
    path = huffman_ids.encoded_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return huffman_ids.read_ids(spark, path, huffman_ids.digest, huffman_ids.DIGEST)


@checked("op5_ftrl_toxicity")
def _op5(spark, folder):
    docs = table(spark, folder, "documents")
    part = remainder(F.col("doc_id"), 3)
    model = ftrl_toxicity.fit(docs, table(spark, folder, "labels"), "toxic", part != 1)
    return ftrl_toxicity.toxicity(docs, model).select(
        "doc_id",
        (part == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


_MIXING_SQL = """
WITH RECURSIVE dealt AS (
  SELECT doc_id, source,
    CAST('0x' || md5('1:' || coalesce(CAST(doc_id AS VARCHAR), '-'))[1:8] AS BIGINT) % 1024 AS cell,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n
  FROM documents),
cells AS (SELECT source, cell, sum(n) AS size FROM dealt GROUP BY ALL),
shares AS (SELECT source, sum(size) AS total, sum(size) / (SELECT CAST(sum(size) AS DOUBLE) FROM cells) AS share
  FROM cells GROUP BY ALL),
even(low, high) AS (
  SELECT 0, 1048576 UNION ALL
  SELECT CASE WHEN ok THEN middle ELSE low END, CASE WHEN ok THEN high ELSE middle END FROM (
    SELECT low, high, (low + high) // 2 AS middle,
      (SELECT ln(sum(pow(share, e))) - e * sum(pow(share, e) * ln(share)) / sum(pow(share, e)) >= 0.95 * ln(count(*))
       FROM shares, (SELECT ((low + high) // 2) / CAST(1048576 AS DOUBLE) AS e) WHERE total > 0 GROUP BY e) AS ok
    FROM even WHERE high - low > 1)),
kept(low, high) AS (
  SELECT 0, 1048576 UNION ALL
  SELECT CASE WHEN ok THEN low ELSE middle END, CASE WHEN ok THEN middle ELSE high END FROM (
    SELECT low, high, (low + high) // 2 AS middle,
      (SELECT pow(max(share) / min(share), 1 - e) <= 2.0
       FROM shares, (SELECT ((low + high) // 2) / CAST(1048576 AS DOUBLE) AS e) WHERE total > 0 GROUP BY e) AS ok
    FROM kept WHERE high - low > 1)),
ends AS (SELECT
    ln(sum(share)) - sum(share * ln(share)) / sum(share) >= 0.95 * ln(count(*)) AS even_1,
    ln(count(*)) >= 0.95 * ln(count(*)) AS even_0, max(share) / min(share) <= 2.0 AS kept_0
  FROM shares WHERE total > 0),
power AS (SELECT greatest(
    CASE WHEN even_1 THEN 1048576 WHEN NOT even_0 THEN 0 ELSE (SELECT max(low) FROM even) END,
    CASE WHEN kept_0 THEN 0 ELSE (SELECT min(high) FROM kept) END) / CAST(1048576 AS DOUBLE) AS e FROM ends),
plan AS (SELECT source, total, CASE WHEN total > 0 THEN pow((SELECT max(share) FROM shares) / share, 1 - e) ELSE 1.0 END
    AS times FROM shares, power),
placed AS (
  SELECT c.source, c.cell, c.size, p.total, p.times, unnest(range(0, greatest(CAST(ceil(times) AS BIGINT), 1))) AS epoch
  FROM cells c JOIN plan p ON c.source IS NOT DISTINCT FROM p.source),
ordered AS (
  SELECT *, sum(size) OVER (PARTITION BY source, epoch ORDER BY
      CAST('0x' || md5(concat_ws(':', '1', coalesce(source, '-'), epoch, cell))[1:8] AS BIGINT), cell
      ROWS UNBOUNDED PRECEDING) - size / 2.0 + epoch * total AS middle FROM placed)
SELECT d.doc_id, d.source, d.n AS n_tokens, CAST(o.epoch AS INTEGER) AS epoch, o.cell AS block,
  CASE WHEN total > 0 THEN round(middle / (times * total), 6) ELSE 0.0 END AS turn
FROM dealt d JOIN ordered o ON d.source IS NOT DISTINCT FROM o.source AND d.cell = o.cell
WHERE middle <= times * total OR total = 0
"""


@checked("op2_temperature_mixing", _MIXING_SQL)
def _op2(spark, folder):
    mixed = temperature_mixing.mixed_documents(table(spark, folder, "documents"))
    return mixed.select(
        "doc_id",
        "source",
        temperature_mixing.n_tokens(F.col("text")).alias("n_tokens"),
        F.col("mix_epoch").alias("epoch"),
        F.col("mix_cell").alias("block"),
        F.col("mix_turn").alias("turn"),
    )


@checked("op7_jaccard_join")
def _op7(spark, folder):
    return jaccard_join.similar_components(table(spark, folder, "documents"))


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WINNOWING_SQL = f"""
WITH dw AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
spans AS (
  SELECT item_id, least(10, len(w)) AS size, w[i:i + least(10, len(w)) - 1] AS span
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM spans),
places AS (
  SELECT doc_id, size, i, w[i:i + size - 1] AS span
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM dw, sizes)),
hits AS (SELECT p.doc_id, p.size, p.i, s.item_id FROM places p JOIN spans s ON p.size = s.size AND p.span = s.span),
covered AS (SELECT doc_id, count(DISTINCT place) AS n FROM (
  SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY 1),
named AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hits GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@checked("op9_winnowing", _WINNOWING_SQL)
def _op9(spark, folder):
    found = winnowing.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@checked("op3_compression_quality")
def _op3(spark, folder):
    docs = table(spark, folder, "documents")
    part = remainder(F.col("doc_id"), 5)
    model = compression_quality.fit(docs, table(spark, folder, "labels"), "quality", part != 0)
    return compression_quality.quality(docs, model).select(
        "doc_id",
        (part == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@checked("op10_hyperdimensional_language")
def _op10(spark, folder):
    docs = table(spark, folder, "documents")
    part = remainder(F.col("doc_id"), 4)
    model = hyperdimensional_language.fit(docs, part != 2)
    return hyperdimensional_language.identify(docs, model).select(
        "doc_id", (part == 2).alias("held_out"), "lang_pred", "score"
    )


_SEARCH_SQL = """
WITH bits AS (
  SELECT vec_id AS id, unnest(range(1, 65)) AS i, embedding FROM embeddings WHERE len(embedding) > 0),
codes AS (SELECT id, string_agg(CASE WHEN coalesce(embedding[i], 0) > 0 THEN '1' ELSE '0' END, '' ORDER BY i) AS code
  FROM bits GROUP BY id),
pairs AS (
  SELECT q.id AS query_id, c.id, hamming(q.code, c.code) AS distance
  FROM codes q JOIN codes c ON q.id <> c.id WHERE q.id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, id, CAST(distance AS INTEGER) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM pairs) WHERE rank <= 10
"""


@checked("op4_hamming_search", _SEARCH_SQL)
def _op4(spark, folder):
    code = hamming_search.sign_code(F.col("embedding")).alias("code")
    codes = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), code)
    return hamming_search.nearest(codes, codes.where("id % 100 = 0"), 10)


def _found_sql(kind: personal_data.Kind, order: int, pattern: str, test: str) -> str:
    near = personal_data.NEAR
    around = f"lower(substring(text, greatest(start - {near}, 0) + 1, start - greatest(start - {near}, 0)) || ' ' || substring(text, start + length(m) + 1, {near}))"
    return f"""SELECT doc_id, {order} AS ord, '{kind.name}' AS kind, start, start + length(m) AS stop,
      {round(100 * kind.score)} + CASE WHEN regexp_matches({around}, '{kind.context}') THEN 20 ELSE 0 END AS score FROM (
      SELECT doc_id, text, ms[i] AS m, CAST(list_sum(list_transform(ps[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
      FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (
        SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS ps
        FROM documents))) WHERE {test}"""


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(0, length({_DIGITS})), lambda j: CASE WHEN j % 2 = 0
  THEN CAST(reverse({_DIGITS})[j + 1] AS INTEGER) WHEN CAST(reverse({_DIGITS})[j + 1] AS INTEGER) > 4
  THEN 2 * CAST(reverse({_DIGITS})[j + 1] AS INTEGER) - 9 ELSE 2 * CAST(reverse({_DIGITS})[j + 1] AS INTEGER) END)) % 10 = 0"""
_IBAN = "replace(m, ' ', '')"
_MOVED = f"({_IBAN}[5:] || {_IBAN}[1:4])"
_MOD97 = f"""list_reduce(list_concat([CAST(0 AS BIGINT)], list_transform(range(1, length({_MOVED}) + 1), lambda j:
  CAST(CASE WHEN {_MOVED}[j] >= 'A' THEN ascii({_MOVED}[j]) - 55 ELSE ascii({_MOVED}[j]) - 48 END AS BIGINT))),
  lambda a, x: (a * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97) = 1"""
_FOUND = " UNION ALL ".join(
    _found_sql(personal_data.KINDS[order], order, pattern, test)
    for _, order, pattern, test in (
        ("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
        ("ip", 1, r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
         "len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR (length(ltrim(p, '0')) = 3 AND ltrim(p, '0') > '255'))) = 0"),
        ("card", 2, r"[0-9](?:[\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 12 AND 19 AND {_LUHN}"),
        ("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15"),
        ("iban", 4, r"[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]{4}){2,7}(?:[\x20]?[A-Z0-9]{1,3})?",
         f"length({_IBAN}) BETWEEN 15 AND 34 AND NOT regexp_matches(CASE WHEN start > 0 THEN text[start] ELSE '' END || text[start + length(m) + 1], '[A-Za-z0-9]') AND {_MOD97}"),
        ("ssn", 5, r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
         "NOT regexp_matches(CASE WHEN start > 0 THEN text[start] ELSE '' END || text[start + length(m) + 1], '[0-9-]')"),
    )
)
_PERSONAL_SQL = f"""
WITH found AS (SELECT * FROM ({_FOUND}) WHERE ord < {personal_data.PLAIN} OR score >= {round(100 * personal_data.ENOUGH)}),
sums AS (SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
    count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (ord < 4) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS spans,
    string_agg(CAST(score AS VARCHAR), ',' ORDER BY start, ord) AS scores FROM found GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM documents LEFT JOIN sums USING (doc_id)
"""


@checked("op8_personal_data", _PERSONAL_SQL)
def _op8(spark, folder):
    found = personal_data.personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    plain = F.filter("spans", lambda s: s["kind"] < personal_data.PLAIN)
    counts = [
        personal_data.count_of(F.col("spans"), i).alias(f"n_{kind.name}")
        for i, kind in enumerate(personal_data.KINDS[: personal_data.PLAIN])
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(personal_data.as_text(plain), 256).alias("base_sha256"),
        personal_data.as_text(F.col("spans")).alias("spans"),
        personal_data.scores_as_text(F.col("spans")).alias("scores"),
    )


@checked("op6_hmm_language_model")
def _op6(spark, folder):
    part = remainder(F.col("doc_id"), 7)
    found = hmm_language_model.scored(table(spark, folder, "documents"), part != 2)
    return found.select(
        "doc_id", (part == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def _weak_sql() -> str:
    """Measures word by word, then expectation-maximisation over counted votes as a recursion."""
    start = weak_supervision.Settings()
    n = len(start.rules)
    votes = [f"CASE WHEN {r.good} THEN 1 WHEN {r.bad} THEN -1 ELSE 0 END" for r in start.rules]
    columns = ", ".join(f"{v} AS v{j}" for j, v in enumerate(votes))
    # The state lists, per rule: rates of good votes on good and on bad documents, then of bad votes.
    begin = [x for j in range(n) for x in (*start.good_vote, *start.bad_vote)]
    weights = " + ".join(
        f"CASE v{j} WHEN 1 THEN ln(p[{4 * j + 1}] / p[{4 * j + 2}]) WHEN -1 THEN ln(p[{4 * j + 3}] / p[{4 * j + 4}]) ELSE 0 END"
        for j in range(n)
    )
    posterior = f"1 / (1 + exp(-(ln({start.share} / (1 - {start.share})) + {weights})))"
    rates = ", ".join(
        f"(sum(CASE WHEN v{j} = {x} THEN {w} ELSE 0 END) + {start.belief * begin[4 * j + 2 * (x < 0) + k]}) / (sum({w}) + {start.belief})"
        for j in range(n)
        for x in (1, -1)
        for k, w in enumerate(("n * g", "n * (1 - g)"))
    )
    space = r"\x20\x09-\x0D"
    size = weak_supervision.WINDOW
    return rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^{space}]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^{space}]')) AS lines FROM documents),
places AS (SELECT doc_id, i, w[i:i + {size - 1}] AS g FROM (
  SELECT doc_id, w, unnest(range(1, len(w) - {size - 2})) AS i FROM split)),
twice AS (SELECT doc_id, i FROM places QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeats AS (SELECT doc_id, count(DISTINCT place) AS n FROM (
  SELECT doc_id, unnest(range(i, i + {size})) AS place FROM twice) GROUP BY 1),
measures AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(lines) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    len(regexp_extract_all(text, '\p{{L}}')) AS n_letters, len(regexp_extract_all(text, '\p{{Lu}}')) AS n_capitals,
    len(list_filter(lines, lambda l: regexp_matches(l, '[.!?…][{space}]*$'))) AS n_ended_lines,
    len(list_distinct(w)) AS n_vocabulary
  FROM split LEFT JOIN repeats USING (doc_id)),
cast_votes AS (SELECT *, {columns} FROM measures),
patterns AS (SELECT {", ".join(f"v{j}" for j in range(n))}, CAST(count(*) AS DOUBLE) AS n FROM cast_votes GROUP BY ALL),
em(round, p) AS (
  SELECT 0, CAST({begin} AS DOUBLE[]) UNION ALL
  SELECT round + 1, [{rates}] FROM (
    SELECT round, patterns.*, {posterior} AS g FROM em, patterns WHERE round < {start.rounds}) GROUP BY round),
verdicts AS (
  SELECT cast_votes.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {posterior} AS quality
  FROM cast_votes, (SELECT p FROM em WHERE round = {start.rounds}))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND quality >= {start.kept} AS kept FROM verdicts
"""


@checked("op11_weak_supervision", _weak_sql())
def _op11(spark, folder):
    found = weak_supervision.quality(table(spark, folder, "documents"))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return found.select("doc_id", *columns, F.col("good").alias("kept"))


_TRIE_SQL = """
WITH turns AS (
  SELECT conv_id AS c, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS r
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(x ORDER BY r) AS xs, CAST(xor(list_reduce(list_concat([4294967295], flatten(list_transform(
      string_split(CAST(c AS VARCHAR), ''), lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 6 AS BIGINT) AS h
  FROM turns GROUP BY c),
rebuilt AS (SELECT o.c, list_concat(coalesce(b.xs, [])[1:o.h], o.xs[o.h + 1:]) AS xs
  FROM own o LEFT JOIN own b ON b.c = o.c - o.c % 100),
members AS (SELECT c, d, xs[1:d] AS p, d = len(xs) AS ends FROM (SELECT c, xs, unnest(range(0, len(xs) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT d, p, min(c) AS c, count(*) AS n,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS digest FROM members GROUP BY d, p),
valued AS (SELECT n.*, coalesce(k.n, 0) AS kids,
    CASE WHEN n.d = 0 THEN 0 ELSE (n.n - 1) * length(n.p[n.d].text) END AS saved
  FROM nodes n LEFT JOIN (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL) k
  ON n.d = k.d AND n.p = k.p),
totals AS (SELECT d, p[1:d] AS p, sum(saved) AS saved, count(*) FILTER (kids = 0) AS leaves
  FROM (SELECT p, saved, kids, unnest(range(0, d + 1)) AS d FROM valued) GROUP BY ALL)
SELECT v.c AS conv_id, v.d AS depth, u.c AS parent_conv_id, v.n AS n_convs, CAST(v.kids AS BIGINT) AS n_children,
  CAST(t.leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, v.digest AS ends_sha256
FROM valued v JOIN totals t ON v.d = t.d AND v.p = t.p LEFT JOIN nodes u ON u.d = v.d - 1 AND u.p = v.p[1:v.d - 1]
"""


@checked("op12_prefix_trie", _TRIE_SQL)
def _op12(spark, folder):
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


@checked("op13_embedding_whitening")
def _op13(spark, folder):
    vectors = whitening.whole_vectors(table(spark, folder, "embeddings"))
    return whitening.whitened(vectors, whitening.fit(vectors))
