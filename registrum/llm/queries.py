"""The registered queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registrum.llm import bit_sliced, bpe_duckdb, chat_template, divergence, fingerprints, jaccard_join, merkle, pii_crf, quality_gam, quality_rules, soft_mixing, suffix_dedup, warc
from registrum.llm.common import shared_folder, ship_package, table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = (F.col("n_bytes") - F.octet_length("kept")).cast("long")
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    base = rows.fail_bits.bitwiseAND(F.lit(quality_rules.BASE_MASK).cast("long")) != 0
    kept = ~base & quality_rules.passes(quality_rules.DEFAULT_POLICY, rows.fail_bits)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), kept.alias("kept"), "fail_bits")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality_gam.score(docs.select("doc_id", "text"), quality_gam.learn(docs, table(spark, sf_dir, "labels")))
    doc_id = F.col("row.doc_id").cast("long")
    return scored.select(doc_id.alias("doc_id"), quality_gam.held_out(doc_id).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.merged_index(warc.read_runs(spark, path))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_components(table(spark, sf_dir, "documents"), words=3, percent=90)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(table(spark, sf_dir, "documents"))


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_crf.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select(F.col("row.doc_id").cast("long").alias("doc_id"), *map(count, pii_crf.BASE_KINDS), F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = chat_template.with_tricky(table(spark, sf_dir, "conversations"))
    return chat_template.read_back(chat_template.format_conversations(conversations))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_duckdb.digests(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows, model, found = soft_mixing.rates(docs, domains(docs, table(spark, sf_dir, "labels")))
    found.checked()
    posterior = [F.get("posterior", F.lit(k)).alias(f"posterior_{name}") for k, name in enumerate(model.domains)]
    return rows.select("doc_id", F.col("tokens").alias("n_tokens"), *posterior, "rate", "copies")


def domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled table of domains: the language marks of the documents that labels covers. The
    classifier's sample is taken from it by hash, so only its ids meet the texts."""
    return docs.select(docs["doc_id"], docs["lang"].alias("domain")).join(labels.select("doc_id").distinct(), "doc_id")


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_sliced.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(table(spark, sf_dir, "documents"))


Query = Callable[[SparkSession, str], DataFrame]


def shipped(query: Query) -> Query:
    """The query with the package on the executors, whatever their working folder."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    f.__name__: shipped(f)
    for f in (
        op1_suffix_dedup, op2_quality_rules, op3_quality_classifier, op4_warc, op5_jaccard_join, op6_fingerprints, op7_pii,
        op8_chat_formatting, op9_bpe, op10_mixing, op11_topk, op12_divergence, op13_merkle,
    )
}

_WORDS = r"list_filter(regexp_split_to_array({0}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_RULES = " + ".join(f"CASE WHEN {r.fails} THEN {quality_rules.BIT[r.name]} ELSE 0 END" for r in quality_rules.RULES)
_MASK = quality_rules.DEFAULT_POLICY.mask

_OP2 = rf"""
WITH d AS (
    SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS words FROM documents
), w AS (
    SELECT k, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d
), t AS (
    SELECT k, i, word, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY k ORDER BY i)
), c AS (
    SELECT k, i, count(*) OVER (PARTITION BY k, word, w2, w3) > 1 AS twice FROM t WHERE w3 IS NOT NULL
), r AS (
    SELECT k, count(DISTINCT i + s) AS n_repeat_words FROM c, (VALUES (0), (1), (2)) AS v(s) WHERE twice GROUP BY k
), l AS (
    SELECT k, unnest(string_split(text, chr(10))) AS line FROM d
), u AS (
    SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k
), n AS (
    SELECT k, max(n) AS top_word FROM (SELECT k, word, count(*) AS n FROM w GROUP BY k, word) GROUP BY k
), s AS (
    SELECT k, count(*) FILTER (word = w2) AS n_same_next FROM t GROUP BY k
), m AS (
    SELECT d.doc_id, len(words)::BIGINT AS n_words,
           length(array_to_string(words, ''))::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           coalesce(n_lines, 0)::BIGINT AS n_lines, CASE WHEN len(words) = 0 THEN 0 ELSE length(regexp_replace(text, '[^!]', '', 'g')) END AS n_bangs,
           CASE WHEN len(words) = 0 THEN 0 ELSE length(regexp_replace(text, '[^A-Z]', '', 'g')) END AS n_upper,
           CASE WHEN len(words) = 0 THEN 0 ELSE strlen(regexp_replace(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) END AS n_letters,
           coalesce(top_word, 0) AS top_word, coalesce(n_same_next, 0) AS n_same_next
    FROM d LEFT JOIN r USING (k) LEFT JOIN u USING (k) LEFT JOIN n USING (k) LEFT JOIN s USING (k)
), f AS (SELECT *, ({_RULES})::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       fail_bits & {quality_rules.BASE_MASK} <> 0 AS base_failed,
       fail_bits & {quality_rules.BASE_MASK} = 0 AND fail_bits & {_MASK} = 0 AS kept, fail_bits
FROM f
"""

_CONTROL = "|".join("".join(rf"\{x}" if x in "|[]" else x for x in c) for c in chat_template.CONTROL)
_OP8 = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS t FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '{chat_template.TRICKY}', 'user', '{chat_template.TRICKY}'), (-1, 1, 'assistant', '{chat_template.TRICKY}', 'assistant', '{chat_template.TRICKY}')
), sizes AS (
    SELECT *, length(text) + length(role) + 24
        + length(regexp_replace(text, '[^\\]', '', 'g')) + 2 * len(regexp_extract_all(text, '{_CONTROL}'))
        + length(regexp_replace(role, '[^\\\n]', '', 'g')) + 2 * len(regexp_extract_all(role, '{_CONTROL}')) AS size
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars
FROM sizes GROUP BY conv_id
"""

_OP1 = """
WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
), w AS (
    SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS p FROM d WHERE n >= 50)
), hit AS (
    SELECT doc_id, p FROM w JOIN (SELECT s, min(doc_id) AS first FROM w GROUP BY s) USING (s) WHERE first < doc_id
), edge AS (
    SELECT doc_id, p, coalesce(p > lag(p) OVER o + 50, true) AS fresh FROM hit WINDOW o AS (PARTITION BY doc_id ORDER BY p)
), run AS (
    SELECT doc_id, min(p) AS a, max(p) + 50 AS b
    FROM (SELECT doc_id, p, sum(fresh::INTEGER) OVER (PARTITION BY doc_id ORDER BY p) AS r FROM edge) GROUP BY doc_id, r
), piece AS (
    SELECT doc_id, coalesce(lag(b) OVER o, 0) AS a, a AS b FROM run WINDOW o AS (PARTITION BY doc_id ORDER BY a)
    UNION ALL SELECT doc_id, max(b), NULL FROM run GROUP BY doc_id
), kept AS (
    SELECT doc_id, string_agg(CASE WHEN p.b IS NULL THEN substr(h, 2 * p.a + 1) ELSE substr(h, 2 * p.a + 1, 2 * (p.b - p.a)) END, '' ORDER BY p.a) AS k
    FROM piece p JOIN d USING (doc_id) GROUP BY doc_id
), total AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed FROM run GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(from_hex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN total USING (doc_id)
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_OP5 = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')")} AS words FROM documents
), s AS (
    SELECT DISTINCT doc_id, CASE WHEN len(words) < 3 THEN array_to_string(words, ' ') ELSE array_to_string(words[i:i + 2], ' ') END AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM d WHERE len(words) > 0)
), n AS (
    SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id
), link AS (
    SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y USING (shingle) WHERE x.doc_id <> y.doc_id GROUP BY ALL)
    JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 90 * (na.size + nb.size - common)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b
)
SELECT a AS doc_id, coalesce(any_value(size), 0)::BIGINT AS n_shingles, min(b) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = a GROUP BY a
"""

_OP11 = """
WITH e AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.r, a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
    FROM e a JOIN e b ON a.r <> b.r WHERE a.vec_id % 50 = 0
), o AS (
    SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM o WHERE rank <= 5
"""

_OP12 = rf"""
WITH d AS (
    SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), w AS (SELECT k, lang, source, unnest(terms) AS term FROM d
), kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= {divergence.MIN_DOCUMENTS}
), g AS (SELECT DISTINCT lang, source FROM d
), c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL
), full_count AS (
    SELECT g.lang, g.source, kept.term, coalesce(c.n, 0)::HUGEINT AS n
    FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), share AS (
    SELECT lang, source, term, n, 1 + {divergence.UNIT} * (n + 1) // (sum(n) OVER o + count(*) OVER o)::HUGEINT AS p
    FROM full_count WINDOW o AS (PARTITION BY lang, source)
), lang_count AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM full_count GROUP BY lang, term
), lang_share AS (
    SELECT lang, term, 1 + {divergence.UNIT} * (n + 1) // (sum(n) OVER o + count(*) OVER o)::HUGEINT AS q FROM lang_count WINDOW o AS (PARTITION BY lang)
), pair AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), whole_pair AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
), term AS (
    SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM share JOIN lang_share USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM (SELECT * FROM whole_pair UNION ALL SELECT * FROM term)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP_TERMS}
"""

#: crc32 of the digits of an id, bit by bit (polynomial 0xEDB88320).
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda r, i: xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""


def _leaf_sql(text: str) -> str:
    part = lambda x: f"coalesce(strlen({x}::VARCHAR) || ':' || {x}::VARCHAR, '-')"
    return f"sha256({' || '.join(part(text if c == 'text' else c) for c in merkle.FIELDS)})"


_OP13 = f"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS k, doc_id, coalesce('=' || lang, '') AS key, {_leaf_sql("text")} AS leaf,
           CASE WHEN {_CRC} % 3 = 0 THEN {_leaf_sql(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} END AS altered
    FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf, k) - 1 AS pos FROM d
), node AS (
    SELECT key, 0 AS level, pos, leaf AS node, count(*) OVER (PARTITION BY key) AS n FROM placed
    UNION ALL
    SELECT key, level + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (n + 7) // 8 FROM node WHERE n > 1 GROUP BY key, level, pos // 8, n
), subroot AS (
    SELECT key, level AS height, node AS subroot, row_number() OVER (ORDER BY key) - 1 AS pos FROM node WHERE n = 1
), top AS (
    SELECT 0 AS level, pos, subroot AS node, count(*) OVER () AS n FROM subroot
    UNION ALL
    SELECT level + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY level, pos // 8, n
), step AS (
    SELECT p.k, x.level, x.pos < p.pos // (8 ** x.level)::BIGINT AS before, x.pos, x.node FROM placed p JOIN node x
        ON x.key = p.key AND x.n > 1 AND x.pos // 8 = p.pos // (8 ** (x.level + 1))::BIGINT AND x.pos <> p.pos // (8 ** x.level)::BIGINT
    UNION ALL
    SELECT p.k, s.height + x.level, x.pos < s.pos // (8 ** x.level)::BIGINT, x.pos, x.node FROM placed p JOIN subroot s USING (key) JOIN top x
        ON x.n > 1 AND x.pos // 8 = s.pos // (8 ** (x.level + 1))::BIGINT AND x.pos <> s.pos // (8 ** x.level)::BIGINT
), side AS (
    SELECT k, level, coalesce(string_agg(node, '' ORDER BY pos) FILTER (before), '') AS l, coalesce(string_agg(node, '' ORDER BY pos) FILTER (NOT before), '') AS r
    FROM step GROUP BY k, level
), height AS (
    SELECT key, height + (SELECT max(level) FROM top) AS h FROM subroot
), fold AS (
    SELECT k, 0 AS level, coalesce(altered, leaf) AS node, h FROM placed JOIN height USING (key)
    UNION ALL
    SELECT f.k, f.level + 1, sha256(coalesce(s.l, '') || f.node || coalesce(s.r, '')), h
    FROM fold f LEFT JOIN side s ON s.k = f.k AND s.level = f.level WHERE f.level < h
), proof AS (
    SELECT k, sha256(string_agg(l || r, '' ORDER BY level)) AS proof_sha256 FROM side GROUP BY k
), root AS (SELECT node AS root FROM top WHERE n = 1)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, f.node AS folded_root, f.node = root AS verified
FROM placed p JOIN subroot USING (key) JOIN fold f ON f.k = p.k AND f.level = f.h LEFT JOIN proof ON proof.k = p.k, root
"""

SQL: dict[str, str] = {"op1_suffix_dedup": _OP1, "op2_quality_rules": _OP2, "op5_jaccard_join": _OP5, "op8_chat_formatting": _OP8, "op11_topk": _OP11, "op12_divergence": _OP12, "op13_merkle": _OP13}
