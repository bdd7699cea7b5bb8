"""One registered query per operator, over its whole table, and the DuckDB
SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    byte_cnn,
    chat_windows,
    decontaminate,
    html_extract,
    importance,
    language_id,
    minmax_dedup,
    neighbours,
    quality_rules,
    substring_dedup,
    token_records,
    vector_codes,
    viterbi,
)
from .common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


@_query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@_query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(read_table(spark, sf_dir, "pages"))


@_query
def op3_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, percent=85, rows=5, bands=40)


@_query
def op4_byte_cnn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_cnn.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@_query
def op5_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@_query
def op6_streaming_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.encode_pieces(read_table(spark, sf_dir, "documents"))


@_query
def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.token_records(read_table(spark, sf_dir, "documents"))


@_query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), window=20)


@_query
def op9_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    inert = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame(
        [(-1, 0, "user", inert), (-1, 1, "assistant", inert)], "conv_id long, turn long, role string, text string"
    )
    return chat_windows.conversation_digests(chat_windows.chat_windows(turns.unionByName(probe)))


@_query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(read_table(spark, sf_dir, "documents"))


@_query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_sample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@_query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(read_table(spark, sf_dir, "embeddings"))


@_query
def op13_cross_polytope_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"))


def _cutoff_rows() -> str:
    return ", ".join(
        f"('{rule}', {i}, {c})" for rule, (_, cuts) in quality_rules.RULES.items() for i, c in enumerate(cuts)
    )


def _quality_sql(risk: float = 0.05, delta: float = 0.1) -> str:
    """The same rules: windows as rows instead of arrays, the binomial tail as
    a sum over lgamma instead of a recurrence."""
    white = r"[\x20\x09-\x0D]+"
    word = r"[^\x20\x09-\x0D]+"
    rules = quality_rules.RULES
    rate = risk / len(rules)
    signals = ", ".join(f"({signal.replace(' div ', ' // ')}) AS s_{rule}" for rule, (signal, _) in rules.items())
    reached = " UNION ALL ".join(f"SELECT doc_id, lang, '{rule}' AS rule, s_{rule} AS s FROM scored" for rule in rules)
    tail = (
        f"list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) "
        f"+ i * ln({rate!r}) + (n - i) * ln({1 - rate!r}))))"
    )
    verdict = " OR ".join(
        f"coalesce(s_{rule} >= (SELECT cutoff FROM picked p WHERE p.stratum IS NOT DISTINCT FROM d.lang "
        f"AND p.rule = '{rule}'), false)"
        for rule in rules
    )
    return f"""
WITH d0 AS (
  SELECT doc_id, lang, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{word}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{word}')) AS ls
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d0)),
twice AS (
  SELECT doc_id, i FROM win
  QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(0, 8)) AS k) GROUP BY doc_id),
d1 AS (
  SELECT d0.doc_id, lang, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '{white}', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')))::BIGINT AS n_capitals,
    len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    len(list_distinct(w))::BIGINT AS n_distinct, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d0 LEFT JOIN rep USING (doc_id)),
d2 AS (
  SELECT *, (n_words < {quality_rules.MIN_WORDS}
    OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words) AS base_failed FROM d1),
known AS (
  SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
scored AS (SELECT doc_id, lang, {signals} FROM d2 WHERE NOT base_failed),
long_signals AS ({reached}),
cells AS (
  SELECT lang AS stratum, rule, s, quality = 1 AS good, substr(md5(doc_id::VARCHAR), 1, 1) < 'a' AS held
  FROM long_signals JOIN known USING (doc_id)),
grid(rule, step, cutoff) AS (VALUES {_cutoff_rows()}),
tested AS (
  SELECT stratum, rule, cutoff, count(*) FILTER (good AND held) AS n,
    count(*) FILTER (good AND held AND s >= cutoff) AS k,
    count(*) FILTER (NOT good AND NOT held AND s >= cutoff)
      - {quality_rules.LOSS_WEIGHT} * count(*) FILTER (good AND NOT held AND s >= cutoff) AS gain
  FROM cells JOIN grid USING (rule) GROUP BY stratum, rule, cutoff),
p AS (
  SELECT *, CASE WHEN k >= {rate!r} * n THEN 1.0 ELSE {tail} END AS p_value,
    (SELECT count(DISTINCT coalesce(stratum, '')) FROM cells) AS strata FROM tested),
picked AS (
  SELECT stratum, rule, cutoff FROM p
  WHERE n > 0 AND p_value <= {delta} / (strata * {len(rules)}) AND gain > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, cutoff DESC) = 1),
judged AS (
  SELECT d.doc_id, ({verdict}) AS rejected FROM scored d)
SELECT d2.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(rejected, false) AS kept
FROM d2 LEFT JOIN judged USING (doc_id)
"""


ORACLE["op1_quality_rules"] = _quality_sql()


def _chat_sql(budget: int = 512, history: int = 128) -> str:
    escape = "replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')"
    role = f"replace({escape.format('role')}, chr(10), '&#10;')"
    rendered = f"'{chat_windows.BEGIN}' || {role} || chr(10) || {escape.format('txt')} || '<|end|>' || chr(10)"
    order = "PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, txt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return f"""
WITH t0 AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS txt FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t1 AS (
  SELECT *, {rendered} AS r, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, txt) AS i FROM t0),
t2 AS (
  SELECT *, len(regexp_extract_all(r, '{chat_windows.TOKEN}')) AS tok, i = 1 AND role = 'system' AS sys FROM t1),
t3 AS (
  SELECT *, sum(CASE WHEN sys THEN 0 ELSE tok END) OVER ({order}) AS stop,
    max(CASE WHEN sys THEN tok ELSE 0 END) OVER ({order}) AS sys_tok FROM t2),
t4 AS (
  SELECT *, stop - (CASE WHEN sys THEN 0 ELSE tok END) AS start, greatest({budget - history} - sys_tok, 1) AS stretch FROM t3),
t5 AS (SELECT *, start // stretch AS low, (greatest(stop, 1) - 1) // stretch AS high FROM t4),
t6 AS (
  SELECT *, CASE WHEN sys OR lag(sys) OVER w OR i = 1 THEN 0
    WHEN lag(low) OVER w <> low OR lag(high) OVER w <> high THEN 1 ELSE 0 END AS opens
  FROM t5 WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
t7 AS (SELECT *, sum(opens) OVER (PARTITION BY conv_id ORDER BY i) AS span FROM t6),
t8 AS (
  SELECT *, CASE WHEN sys THEN max(span) OVER (PARTITION BY conv_id)
    ELSE max(span) OVER (PARTITION BY conv_id ORDER BY start RANGE BETWEEN CURRENT ROW AND {history} FOLLOWING) END AS final
  FROM t7)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || txt || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(txt)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(txt, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(r) * (final - span + 1))::BIGINT AS formatted_chars
FROM t8 GROUP BY conv_id
"""


ORACLE["op9_chat_windows"] = _chat_sql()


def _importance_sql(percent: int = 5, min_words: int = 20, seed: int = 42) -> str:
    """The same draw; CRC-32 as a join of bytes with a table by distance from the end."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, i FROM (SELECT unnest(range(0, 256))::BIGINT AS i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
step AS MATERIALIZED (SELECT i, c FROM bits WHERE k = 8),
texts AS (
  SELECT 0 AS corpus, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
tokens AS MATERIALIZED (
  SELECT corpus, id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{word}') AS w FROM texts),
grams AS MATERIALIZED (
  SELECT corpus, id, r, array_to_string(w[i : i + n - 1], ' ') AS f
  FROM (SELECT corpus, id, r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM tokens, (SELECT unnest([1, 2, 3]) AS n))),
named AS MATERIALIZED (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM grams)),
far(d, i, c) AS (
  SELECT 0, i, c FROM step
  UNION ALL SELECT d + 1, far.i, xor(far.c >> 8, step.c) FROM far JOIN step ON step.i = far.c & 255
  WHERE d < (SELECT max(len(x)) // 2 + 4 FROM named)),
bytes AS (
  SELECT f, len(x) // 2 AS n, unnest(range(0, len(x) // 2)) AS pos, x FROM named),
-- CRC-32 is linear: each byte adds a value that depends on its distance from the end; the first four bytes are inverted,
-- and a shorter text keeps the rest of the starting value.
crcs AS MATERIALIZED (
  SELECT f, xor(xor(bit_xor(far.c), 4294967295), CASE WHEN n < 4 THEN 4294967295 >> (8 * n) ELSE 0 END) % 10000 AS bucket
  FROM (SELECT f, n, n - 1 - pos AS d,
          xor(('0x' || substr(x, 2 * pos + 1, 2))::BIGINT, CASE WHEN pos < 4 THEN 255 ELSE 0 END) AS i FROM bytes) b
  JOIN far USING (d, i) GROUP BY f, n),
feats AS MATERIALIZED (SELECT corpus, id, r, bucket FROM grams JOIN crcs USING (f)),
counts AS (
  SELECT b AS bucket, count(bucket) FILTER (corpus = 0) AS s, count(bucket) FILTER (corpus = 1) AS t
  FROM (SELECT unnest(range(0, 10000)) AS b) LEFT JOIN feats ON bucket = b GROUP BY b),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * ((SELECT sum(s) FROM counts) + 10000)
    / ((s + 1.0::DOUBLE) * ((SELECT sum(t) FROM counts) + 10000))))::BIGINT AS g FROM counts),
weighed AS (
  SELECT r, count(*) AS n, sum(g) AS w FROM feats JOIN gain USING (bucket) WHERE corpus = 0 GROUP BY r),
scored AS (
  SELECT t.id AS doc_id, len(t.w) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weighed.w, 0)::BIGINT AS weight,
    coalesce(weighed.w, 0)::BIGINT + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('{seed}:' || coalesce(t.id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM tokens t LEFT JOIN weighed USING (r) WHERE corpus = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {min_words} ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_words >= {min_words} AND place <= {percent} * (SELECT count(*) FROM scored WHERE n_words >= {min_words}) // 100
    THEN place END::BIGINT AS rank
FROM ranked
"""


ORACLE["op11_importance_resampling"] = _importance_sql()


def _codes_sql(entries: int = 16, rounds: int = 6) -> str:
    """The plain rounds: every distance, in whole numbers held by doubles."""
    squares = "list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c)"
    ctes = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
    list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS x FROM kept, (SELECT unnest(range(0, 8)) AS p)),
c0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= {entries})"""]
    for k in range(rounds + 1):
        ctes.append(f"""
a{k} AS MATERIALIZED (
  SELECT r, p, any_value(x) AS x, min(({squares})::BIGINT * {entries} + e) AS best
  FROM parts JOIN c{k} USING (p) GROUP BY r, p)""")
        if k < rounds:
            ctes.append(f"""
c{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(any_value(m), any_value(c{k}.c)) AS c FROM c{k} LEFT JOIN (
    SELECT p, e, list(m ORDER BY j) AS m FROM (
      SELECT p, best % {entries} AS e, j, ((sum(x[j])::BIGINT - ((sum(x[j])::BIGINT % count(*)) + count(*)) % count(*)) // count(*))::DOUBLE AS m
      FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS j FROM a{k}) GROUP BY p, best % {entries}, j)
    GROUP BY p, e) USING (p, e) GROUP BY p, e)""")
    last = rounds
    return "WITH " + ",".join(ctes) + f""",
coded AS (
  SELECT r, string_agg(printf('%02x', (best % {entries})::BIGINT), '' ORDER BY p) AS code, sum(best // {entries})::BIGINT AS error
  FROM a{last} GROUP BY r),
books AS (
  SELECT sha256(string_agg(array_to_string(list_transform(c, lambda y: y::BIGINT), ','), ',' ORDER BY p, e)) AS digest FROM c{last})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, digest AS codebooks_sha256
FROM kept JOIN coded USING (r), books
"""


ORACLE["op12_vector_codes"] = _codes_sql()
