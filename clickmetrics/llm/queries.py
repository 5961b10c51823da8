"""The operators' queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmetrics.llm import (
    bpe,
    chat,
    conversation_trie,
    lexical,
    line_dedup,
    mixing,
    neighbours,
    pieces,
    quality,
    secrets,
    sharding,
    simhash,
    token_counts,
)
from clickmetrics.llm.common import whole_text

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "benchmark": "item_id bigint, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}
BASE_KINDS = tuple(rule.kind for rule in secrets.BASE_RULES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("secrets")
    return secrets.find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[secrets.count_of(found, kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(secrets.span_text(found, BASE_KINDS), 256).alias("base_sha256"),
        secrets.span_text(found).alias("spans"),
    )


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "size", "source_size", "target", "taken"
    )


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, sf_dir, "documents"), report=True)
    return judged.select(
        "doc_id",
        *[f"verdict.{name}" for name in quality.MEASURES],
        "verdict.base_failed",
        "verdict.kept",
    )


def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return bpe.bpe_round_trip(table(spark, sf_dir, "documents"), vocabulary).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_counts.UnigramVocabulary.from_sentencepiece(
        public_tokenizers.path("piece_bpe_32k.model")
    )
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary)
    return counted.select("doc_id", "counts.n_words", "counts.n_tokens")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_vectors(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return deduped.select(
        "doc_id",
        "lines.n_lines",
        "lines.n_dropped",
        F.sha2(whole_text(), 256).alias("kept_sha256"),
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_classes(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = conversation_trie.conversation_paths(table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(conversation_trie.with_common_heads(paths, every=100, lengths=6))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.PieceModel.from_file(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.piece_round_trip(table(spark, sf_dir, "documents"), model).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_secret_scan,
        op2_mix_sources,
        op3_chat_format,
        op4_quality_rules,
        op5_shard,
        op6_bpe,
        op7_token_counts,
        op8_nearest,
        op9_line_dedup,
        op10_simhash,
        op11_lexical_search,
        op12_prefix_trie,
        op13_pieces,
    )
}

_MIX = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffle_key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS cap
  FROM sources),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER earlier, 0) AS DOUBLE)
            / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS DOUBLE) AS level
  FROM weighted
  WINDOW earlier AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), weight *
           max(CASE WHEN level * weight <= cap THEN level END) OVER ()) AS target
  FROM levels),
queued AS (
  SELECT s.*, t.source_size, t.target,
         CAST(sum(size) OVER (PARTITION BY s.source ORDER BY shuffle_key, doc_id, size
                              ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sent
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
passes AS (
  SELECT *, CAST(p * source_size + sent AS DOUBLE) / target AS finish
  FROM queued, (VALUES (0), (1), (2)) AS passes(p) WHERE size > 0 AND target > 0),
front AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS FIRST, p, shuffle_key, doc_id, size
                            ROWS UNBOUNDED PRECEDING) AS through
  FROM passes),
taken AS (
  SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM front
  WHERE through <= (SELECT sum(size) FROM sized) GROUP BY doc_id)
SELECT q.doc_id, q.source, q.size, q.source_size, q.target, coalesce(t.taken, 0) AS taken
FROM queued q LEFT JOIN taken t USING (doc_id)
"""

_QUALITY = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
windows AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM words)),
found AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM found, (VALUES (0), (1), (2)) AS o(k)
  WHERE n > 1 GROUP BY doc_id),
lines AS (
  SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dups AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
measured AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(dups.n_lines, 0) AS n_lines
  FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN dups USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 10 * word_chars
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR (n_lines > 4 AND 100 * n_dup_lines > 50 * n_lines)) AS kept
FROM judged
"""

_LINES = r"""
WITH lines AS (
  SELECT doc_id, i, ls[i] AS line,
         translate(regexp_replace(regexp_replace(ls[i], '^[\x20\x09-\x0D]+', ''),
                                  '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
frequent AS (
  SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (
  SELECT lines.*, frequent.key IS NOT NULL AS gone FROM lines LEFT JOIN frequent USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM marked GROUP BY doc_id
"""

_SEARCH = r"""
WITH found AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
docs AS (SELECT doc_id, CAST(len(terms) AS BIGINT) AS n, terms FROM found WHERE len(terms) > 0),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM docs),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
postings AS (
  SELECT doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT doc_id, n, unnest(terms) AS term FROM docs) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(c.docs) + 2 AS DOUBLE) / (2 * count(*) + 1)))
                    AS BIGINT) AS w
  FROM postings, corpus c WHERE term IN (SELECT term FROM wanted) GROUP BY term),
impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * c.docs) // c.terms)))
           AS impact
  FROM postings JOIN weights USING (term), corpus c),
scores AS (
  SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score
  FROM wanted JOIN impacts USING (term) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50
"""

_TRIE = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, i:
           CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS steps),
own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
numbered AS (
  SELECT conv_id, turns, xor(list_reduce(
           list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)),
           lambda c, b: xor(c >> 8, steps[xor(c, b) % 256 + 1]), 4294967295), 4294967295) % 6 AS h
  FROM own, crc),
rebuilt AS (
  SELECT n.conv_id, coalesce(base.turns[1:n.h], []) || n.turns[n.h + 1:] AS turns
  FROM numbered n LEFT JOIN own base ON base.conv_id = n.conv_id - n.conv_id % 100),
prefixes AS (
  SELECT conv_id, d AS depth, turns[1:d] AS path, len(turns) = d AS ended
  FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ended), ''))
           AS ends_sha256
  FROM prefixes GROUP BY path, depth),
children AS (
  SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(path[depth].text) END AS saved
  FROM nodes LEFT JOIN children USING (path)),
subtrees AS (
  SELECT path[1:d] AS path, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM counted) GROUP BY ALL)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id,
       CAST(c.n_convs AS BIGINT) AS n_convs, CAST(c.n_children AS BIGINT) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees s USING (path)
LEFT JOIN nodes p ON c.depth > 0 AND p.path = c.path[1:c.depth - 1]
"""

#: DuckDB twins. The others have none: positions of matches, a greedy search, codes of a tokenizer,
#: approximate search and XXH64 are beyond it, and are tested against brute force.
ORACLE_SQL = {
    "op2_mix_sources": _MIX,
    "op4_quality_rules": _QUALITY,
    "op9_line_dedup": _LINES,
    "op11_lexical_search": _SEARCH,
    "op12_prefix_trie": _TRIE,
}
