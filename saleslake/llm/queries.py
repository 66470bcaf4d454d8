"""One query per operator, with production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from saleslake.llm.language_id import language_predictions
from saleslake.llm.line_dedup import line_digests
from saleslake.llm.near_dedup import near_duplicates
from saleslake.llm.packing import pack, token_pieces
from saleslake.llm.pieces import piece_digests
from saleslake.llm.quality_classifier import quality_scores
from saleslake.llm.quality_rules import quality_verdicts
from saleslake.llm.registry import query, table
from saleslake.llm.secrets import span_digests
from saleslake.llm.sharding import document_shards
from saleslake.llm.spelling import spelling_groups
from saleslake.llm.token_counts import document_token_counts
from saleslake.llm.top_k import integer_vectors, top_k
from saleslake.llm.whitening import whitened_embeddings


@query(
    "op1_top_k",
    """
    WITH v AS MATERIALIZED (
      SELECT row_number() OVER () AS r, vec_id,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT q.r, q.vec_id AS query_id, c.vec_id,
             CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place FROM scored
    )
    SELECT query_id, CAST(place AS INTEGER) AS "rank", vec_id, score FROM ranked WHERE place <= 5
    """,
)
def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


@query("op4_secret_scans")
def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(table(spark, sf_dir, "documents"))


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(token_pieces(table(spark, sf_dir, "documents")))


@query(
    "op5_quality_rules",
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t
      FROM documents
    ), words AS (
      SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d
    ), placed AS (
      SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words
    ), windows AS (
      SELECT a.r, a.i, a.word || ' ' || b.word || ' ' || c.word AS gram
      FROM placed a JOIN placed b ON a.r = b.r AND b.i = a.i + 1 JOIN placed c ON a.r = c.r AND c.i = a.i + 2
    ), twice AS (
      SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM windows) WHERE n > 1
    ), repeated AS (
      SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) o(k) GROUP BY r
    ), lines AS (
      SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
    ), stats AS (
      SELECT r, doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM d JOIN words USING (r) LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r)
    ), judged AS (
      SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             1000 * n_symbols // greatest(n_words, 1) AS symbols, 1000 * n_dup_lines // greatest(n_words, 1) AS dup_lines,
             1000 * n_repeat_words // greatest(n_words, 1) AS repeats, 100 * word_chars // greatest(n_words, 1) AS length
      FROM stats
    ), ratios AS (
      SELECT lang, source, metric, value FROM judged
      UNPIVOT (value FOR metric IN (symbols, dup_lines, repeats, length)) WHERE NOT base_failed
    ), rounded AS (
      SELECT lang, source, metric, (value >> greatest(length(bin(value)) - 5, 0)) << greatest(length(bin(value)) - 5, 0) AS bucket
      FROM ratios
    ), levels AS (
      SELECT 2 AS lvl, lang, source, metric, bucket FROM rounded
      UNION ALL SELECT 1, lang, NULL, metric, bucket FROM rounded
      UNION ALL SELECT 0, NULL, NULL, metric, bucket FROM rounded
    ), ranked AS (
      SELECT *, bucket + (1 << greatest(length(bin(bucket)) - 5, 0)) - 1 AS top,
             count(*) OVER g AS n, count(*) OVER (g ORDER BY bucket) AS upto
      FROM levels WINDOW g AS (PARTITION BY lvl, lang, source, metric)
    ), quantiles AS (
      SELECT lvl, lang, source, metric, n, min(bucket) FILTER (10 * upto >= n) AS low,
             min(bucket) FILTER (2 * upto - n >= -2 * sqrt(n)) AS least, min(top) FILTER (2 * upto - n >= 2 * sqrt(n)) AS most,
             min(bucket) FILTER (2 * upto >= n) AS mid, min(top) FILTER (2 * upto >= n) AS mid_top,
             min(top) FILTER (10 * upto >= 9 * n) AS high
      FROM ranked GROUP BY ALL
    ), marks AS (
      SELECT lvl, lang, source, n, metric AS bound, 1 AS sign, mid AS level, least AS proven, high - mid AS spread FROM quantiles
      UNION ALL
      SELECT lvl, lang, source, n, 'short', -1, mid_top, most, mid_top - low FROM quantiles WHERE metric = 'length'
    ), weighed AS (
      SELECT lang, bound, spread, sum(n) OVER (PARTITION BY lang, bound ORDER BY spread) AS in_lang,
             sum(n) OVER (PARTITION BY bound ORDER BY spread) AS in_all,
             sum(n) OVER (PARTITION BY lang, bound) AS lang_n, sum(n) OVER (PARTITION BY bound) AS all_n
      FROM marks WHERE lvl = 2
    ), usual AS (
      SELECT lang, bound, min(spread) FILTER (2 * in_lang >= lang_n) AS spread FROM weighed GROUP BY ALL
    ), usual_all AS (
      SELECT bound, min(spread) FILTER (2 * in_all >= all_n) AS spread FROM weighed GROUP BY ALL
    ), of_all AS (
      SELECT bound, sign, level, u.spread FROM marks JOIN usual_all u USING (bound) WHERE lvl = 0
    ), of_lang AS (
      SELECT m.lang, bound, m.sign, CASE WHEN n > 4 THEN m.level ELSE a.level END AS level,
             (n * u.spread + 50 * a.spread) // (n + 50) AS spread
      FROM marks m JOIN usual u USING (lang, bound) JOIN of_all a USING (bound) WHERE lvl = 1
    ), of_source AS (
      SELECT m.lang, m.source, bound, m.sign,
             CASE WHEN n <= 4 THEN l.level WHEN m.sign = 1 THEN greatest(l.level, proven) ELSE least(l.level, proven) END AS level,
             (n * least(m.spread, l.spread) + 50 * l.spread) // (n + 50) AS spread
      FROM marks m JOIN of_lang l USING (lang, bound) WHERE lvl = 2
    ), bounds AS (
      SELECT lvl, lang, source, max(b) FILTER (bound = 'symbols') AS symbols_b, max(b) FILTER (bound = 'dup_lines') AS dup_lines_b,
             max(b) FILTER (bound = 'repeats') AS repeats_b, max(b) FILTER (bound = 'length') AS length_b,
             max(b) FILTER (bound = 'short') AS short_b
      FROM (
        SELECT 0 AS lvl, NULL AS lang, NULL AS source, bound, level + sign * 5 * spread AS b FROM of_all
        UNION ALL SELECT 1, lang, NULL, bound, level + sign * 5 * spread FROM of_lang
        UNION ALL SELECT 2, lang, source, bound, level + sign * 5 * spread FROM of_source
      ) GROUP BY ALL
    ), best AS (
      SELECT r, arg_max(b, b.lvl) AS b FROM judged j JOIN bounds b
      ON b.lvl = 0 OR (b.lvl = 1 AND b.lang = j.lang) OR (b.lvl = 2 AND b.lang = j.lang AND b.source = j.source) GROUP BY r
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND coalesce(
             1000 * greatest(n_symbols - 3, 0) // greatest(n_words, 1) <= b.symbols_b
             AND 1000 * greatest(n_dup_lines - 3, 0) // greatest(n_words, 1) <= b.dup_lines_b
             AND 1000 * greatest(n_repeat_words - 18, 0) // greatest(n_words, 1) <= b.repeats_b
             AND length <= b.length_b AND length >= b.short_b, TRUE) AS kept
    FROM judged LEFT JOIN best USING (r)
    """,
)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"))


@query(
    "op3_minhash_near_dedup",
    r"""
    WITH RECURSIVE words AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents
    ), sets AS (
      SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
      FROM words
    ), shingles AS (
      SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
    ), links AS (
      SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
    ), reached AS (
      SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
    ), least AS (
      SELECT x, min(y) AS y FROM reached GROUP BY x
    )
    SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id,
           doc_id <= coalesce(y, doc_id) AS kept
    FROM sets LEFT JOIN least ON x = doc_id
    """,
)
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_predictions(table(spark, sf_dir, "documents"))


@query("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SHARDS_SQL = """
    WITH d AS (
      SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
             list_aggregate(list_transform(string_split(substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16), ''),
               lambda c: lpad(bin(instr('0123456789abcdef', c) - 1), 4, '0')), 'string_agg', '') AS bits
      FROM documents
    ), prefixes AS (
      SELECT depth, substr(bits, 1, depth) AS shard, sum(n_bytes) AS shard_bytes, count(*) AS shard_docs
      FROM d, range(0, 65) r(depth) GROUP BY ALL
    ), fitting AS (
      SELECT * FROM prefixes WHERE shard_bytes <= {limit} OR shard_docs = 1
    )
    SELECT doc_id, arg_min(shard, depth) AS shard, n_bytes, CAST(arg_min(shard_bytes, depth) AS BIGINT) AS shard_bytes,
           arg_min(shard_docs, depth) AS shard_docs
    FROM d JOIN fitting ON substr(bits, 1, depth) = shard GROUP BY doc_id, n_bytes, bits
"""


#: Bytes of a shard in the query: small ones, so that the directory splits on small tables, too.
SHARD_BYTES = 128 << 10


@query("op7_sharding", SHARDS_SQL.format(limit=SHARD_BYTES))
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_token_counts(table(spark, sf_dir, "documents"))


@query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"))


@query(
    "op11_line_dedup",
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS found FROM documents
    ), lines AS (
      SELECT r, doc_id, unnest(found) AS line, generate_subscripts(found, 1) AS place FROM d
    ), keyed AS (
      SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
    ), shared AS (
      SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10
    ), marked AS (
      SELECT r, doc_id, line, place, shared.key IS NOT NULL AS gone FROM keyed LEFT JOIN shared ON keyed.key = shared.key
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY r, doc_id
    """,
)
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digests(table(spark, sf_dir, "documents"))


@query(
    "op12_spelling_variants",
    r"""
    WITH RECURSIVE bits AS (
      SELECT i AS byte, i AS c, 0 AS turn FROM range(0, 256) t(i)
      UNION ALL
      SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, turn + 1 FROM bits WHERE turn < 8
    ), crc AS (
      SELECT list(c ORDER BY byte) AS of_byte FROM bits WHERE turn = 8
    ), runs AS (
      SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS of_doc,
             translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
      FROM documents
    ), counted AS (
      SELECT of_doc, run, count(*) AS times FROM runs WHERE length(run) >= 7 GROUP BY ALL
    ), hashed AS (
      SELECT run, times, xor(4294967295, list_reduce(
          list_concat([4294967295], flatten(list_transform(string_split(of_doc || ':' || run, ''),
            lambda ch: CASE WHEN ord(ch) < 128 THEN [CAST(ord(ch) AS BIGINT)] ELSE [192 + ord(ch) // 64, 128 + ord(ch) % 64] END))),
          lambda c, b: xor(of_byte[xor(c, b) % 256 + 1], c >> 8))) AS h
      FROM counted, crc
    ), kept AS (
      SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times
      FROM hashed
    ), words AS (
      SELECT word, CAST(sum(times) AS BIGINT) AS n FROM kept WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
    ), shorter AS (
      SELECT DISTINCT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
      FROM words, range(1, length(word) + 1) t(i)
    ), pairs AS (
      SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b
      ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
      UNION SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.rest = w.word
      UNION SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.rest = w.word
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place, count(*) OVER (PARTITION BY word) AS n_near
      FROM pairs
    ), formed AS (
      SELECT words.word, n, coalesce(n_near, 0) AS n_near,
             CASE WHEN near_n >= 10 * n THEN near END AS form, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
      FROM words LEFT JOIN ranked ON words.word = ranked.word AND place = 1
    ), steps AS (
      SELECT word, word AS at, form AS up FROM formed
      UNION ALL SELECT s.word, s.up, f.form FROM steps s JOIN formed f ON s.up = f.word
    )
    SELECT f.word, f.form, s.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN steps s ON f.word = s.word AND s.up IS NULL
    """,
)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"))


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_embeddings(table(spark, sf_dir, "embeddings"))
