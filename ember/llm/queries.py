"""Registered queries of the training-data operators, each over its whole table.

``ORACLES`` holds DuckDB SQL where SQL expresses the same rows; the other
queries are tested against brute force in ``tests/llm/``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (exact_dedup, fingerprint, language, lexical, line_dedup, mixture, near_dup, phrases, pieces, quality, repeats,
               token_count, warc)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn
    return add


@query("op8_minhash_near_dedup", r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(words) >= 4 THEN list_transform(range(1, len(words) - 2), lambda i: words[i:i + 3])
                                 WHEN len(words) > 0 THEN [words] ELSE [] END) AS shingle FROM d),
z AS (SELECT r, count(*) AS n FROM s GROUP BY r),
i AS (SELECT a.r AS x, b.r AS y, count(*) AS same FROM s a JOIN s b ON a.shingle = b.shingle AND a.r < b.r GROUP BY ALL),
l AS (SELECT x, y FROM i JOIN z u ON u.r = x JOIN z v ON v.r = y WHERE 100 * same >= 80 * (u.n + v.n - same)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
c(r, node) AS (SELECT r, r FROM d UNION SELECT c.r, e.y FROM c JOIN e ON e.x = c.node),
m AS (SELECT c.r, min(o.doc_id) AS component_id FROM c JOIN d o ON o.r = c.node GROUP BY c.r)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM d JOIN m ON m.r = d.r LEFT JOIN z ON z.r = d.r
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), k=4).select(
        "doc_id", "n_shingles", "component_id", "kept")


@query("op5_document_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


@query("op2_mix_sources")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


@query("op3_stream_exact_dedup", """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM t JOIN g USING (body)
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("byte_bpe_50k.json"))


@query("op9_sentencepiece_round_trip")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                          outputs=())


@query("op7_suffix_array_dedup", """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS body FROM documents),
part AS (SELECT r, k, substr(body, 600 * k + 1, 998) AS body  -- pieces, as cutting a long text is slow
         FROM (SELECT r, body, unnest(range(0, length(body) // 600 + 1)) AS k FROM d WHERE length(body) >= 400)),
w AS (SELECT r, 300 * k + i AS i, md5(substr(body, 2 * i + 1, 400)) AS piece
      FROM (SELECT r, k, body, unnest(range(0, least(300, length(body) // 2 - 199))) AS i FROM part)),
again AS (SELECT r, i FROM w WHERE piece IN (SELECT piece FROM w GROUP BY piece HAVING count(*) > 1)),
cut AS (SELECT r, i, i > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i) + 200, -1) AS first FROM again),
span AS (SELECT r, min(i) AS a, max(i) + 200 AS b
         FROM (SELECT r, i, sum(first::INTEGER) OVER (PARTITION BY r ORDER BY i) AS n FROM cut) GROUP BY r, n),
t AS (SELECT r, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, list(a ORDER BY a) AS ends, [0] || list(b ORDER BY a) AS starts
      FROM span GROUP BY r)
SELECT doc_id, length(body) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN ends IS NULL THEN body ELSE array_to_string(list_transform(range(1, len(starts) + 1), lambda k:
           substr(body, 2 * starts[k] + 1, 2 * (coalesce(ends[k], length(body) // 2) - starts[k]))), '') END)) AS kept_sha256
FROM d LEFT JOIN t ON t.r = d.r
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query("op10_warc_capture_index", """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, body, sha1(body) AS hex, max(page_id) OVER (PARTITION BY body) AS kept FROM p),
b AS (SELECT *, list_transform(range(0, 8), lambda g: ('0x' || substr(hex, g * 5 + 1, 5))::BIGINT) AS bits FROM h)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((bits[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM b
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op6_fuzzy_line_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op11_phrase_collocations", r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents WHERE text IS NOT NULL),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS words
      FROM (SELECT lang, unnest(string_split_regex(body, '[.,;:!?\n-\r]')) AS piece FROM d)),
t AS (SELECT lang, sum(len(words))::BIGINT AS n FROM p GROUP BY lang),
g AS (SELECT lang, size, gram, count(*) AS a FROM (
        SELECT lang, s.size, unnest(list_transform(range(1, len(words) - s.size + 2),
                                                   lambda i: words[i:i + s.size - 1])) AS gram
        FROM p, (SELECT unnest([1, 2, 3, 4]) AS size) s WHERE len(words) >= s.size)
      GROUP BY lang, size, gram HAVING count(*) >= 30),
c AS (SELECT lang, gram, size, a, unnest(range(1, size)) AS k FROM g WHERE size > 1),
x AS (SELECT c.lang, c.gram, c.a, c.k, u.a AS l, v.a AS r,
             ((2000000::HUGEINT * c.a) // (u.a::HUGEINT + v.a))::BIGINT AS score
      FROM c JOIN g u ON u.lang = c.lang AND u.gram = c.gram[1:c.k]
             JOIN g v ON v.lang = c.lang AND v.gram = c.gram[c.k + 1:c.size]),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1),
i AS (SELECT lang, gram, max(a) AS longer FROM (
        SELECT lang, a, gram[f:f + m - 1] AS gram FROM (
          SELECT lang, a, gram, m, unnest(range(1, size - m + 2)) AS f FROM (
            SELECT *, unnest(range(2, size)) AS m FROM g WHERE size > 2)))
      GROUP BY lang, gram),
k AS (SELECT b.lang, array_to_string(b.gram, ' ') AS phrase, b.a, b.l, b.r, b.score FROM b
      LEFT JOIN i ON i.lang = b.lang AND i.gram = b.gram
      WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * b.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, t.n, score
FROM k JOIN t ON t.lang = k.lang
QUALIFY rank <= 2000
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query("op12_ranked_lexical_search", r"""
WITH split AS (
  SELECT 'd' AS kind, row_number() OVER () AS pos, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), item_id, text FROM benchmark),
terms AS (
  SELECT kind, pos, id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM split),
tf AS (SELECT pos, id, term, count(*) AS tf FROM terms WHERE kind = 'd' GROUP BY pos, id, term),
len AS (SELECT pos, sum(tf)::BIGINT AS n FROM tf GROUP BY pos),
s AS (SELECT count(*) AS N, sum(n)::BIGINT AS L FROM len),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT DISTINCT id AS item_id, term FROM terms WHERE kind = 'b'),
hit AS (
  SELECT q.item_id, tf.pos, tf.id AS doc_id,
         sum(floor(1000 * ln((2 * s.N + 2)::DOUBLE / (2 * df.df + 1)))::BIGINT
             * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (100 - 90 + ((90 * len.n * s.N) // s.L)))))::BIGINT AS score
  FROM q JOIN df USING (term) JOIN tf USING (term) JOIN len USING (pos), s
  GROUP BY q.item_id, tf.pos, tf.id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM hit WHERE score > 0 QUALIFY rank <= 10
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_language_id")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))
