"""The operators as queries over the given tables, and the SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docledger.llm.ann import search
from docledger.llm.conversations import damage, repair, sums
from docledger.llm.dual_tree import ranked_search
from docledger.llm.jaccard import jaccard_join
from docledger.llm.lattice import encoding_sums, pieces
from docledger.llm.licenses import license_scan
from docledger.llm.lm import lm_scores
from docledger.llm.packing import pack
from docledger.llm.pii import replace_pii
from docledger.llm.quality import quality
from docledger.llm.secret_scan import scan
from docledger.llm.text import table
from docledger.llm.tokens import TokensAndEnd, count_tokens
from docledger.llm.toxicity import score, train

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TOKENIZER = "piece_bpe_32k.model"
#: Key of the pseudonyms; a real run passes its own secret.
PII_KEY = b"docledger example key"


def query(function):
    QUERIES[function.__name__] = function
    return function


ORACLES["op2_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS g
  FROM words),
entries AS (SELECT doc_id, unnest(g) AS gram FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM entries a JOIN entries b USING (gram)
  WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sets x ON a = x.doc_id JOIN sets y ON b = y.doc_id
  WHERE 100 * n >= 80 * (len(x.g) + len(y.g) - n)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
smallest AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, component_id,
  CASE WHEN len(s.g) = 0 THEN s.doc_id ELSE min(s.doc_id) OVER (PARTITION BY s.g) END AS class_id
FROM sets s JOIN smallest USING (doc_id)"""

#: Its first steps damage the rows as the query does: the CRC-32 of a key, byte by byte from a table.
ORACLES["op12_conversation_repair"] = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fate
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM fated, range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (
  SELECT *, substr(role, 1, 1) AS r, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
    coalesce(lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) || substr(role, 1, 1)
      NOT IN ('su', 'ua', 'au'), false) AS illegal FROM placed),
faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (blank)::BIGINT AS blank, count(*) FILTER (seen AND NOT blank)::BIGINT AS duplicate,
    count(*) FILTER (cut AND NOT seen AND NOT blank)::BIGINT AS truncated, count(*) FILTER (illegal)::BIGINT AS illegal,
    max(i) AS n FROM judged GROUP BY conv_id),
steps AS (  -- cheapest edits of the first i rows that end in each state: nothing, system, user, assistant
  SELECT DISTINCT conv_id, 0::BIGINT AS i, {'c': 0::BIGINT, 'a': ''} AS g0, {'c': 1000000000::BIGINT, 'a': ''} AS g1,
    {'c': 2::BIGINT, 'a': 'I'} AS g2, {'c': 4::BIGINT, 'a': 'II'} AS g3 FROM placed
  UNION ALL
  SELECT conv_id, i, h0, h1, h2, least(h3, {'c': h2.c + 2, 'a': h2.a || 'I'}) FROM (
    SELECT conv_id, i, n0 AS h0, n1 AS h1, n3 AS h3, least(n2, {'c': n0.c + 2, 'a': n0.a || 'I'},
      {'c': n1.c + 2, 'a': n1.a || 'I'}, {'c': n3.c + 2, 'a': n3.a || 'I'}) AS h2 FROM (
      SELECT s.conv_id, j.i, {'c': g0.c + 3, 'a': g0.a || 'D'} AS n0,
        least({'c': g1.c + 3, 'a': g1.a || 'D'}, {'c': g0.c + CASE WHEN free AND r = 's' THEN t ELSE 1000000000 END, 'a': g0.a || 'K'}) AS n1,
        least({'c': g2.c + 3, 'a': g2.a || 'D'},
          {'c': g0.c + CASE WHEN free AND r = 'u' THEN t ELSE 1000000000 END, 'a': g0.a || 'K'},
          {'c': g1.c + CASE WHEN free AND r = 'u' THEN t ELSE 1000000000 END, 'a': g1.a || 'K'},
          {'c': g3.c + CASE WHEN free AND r = 'u' THEN t ELSE 1000000000 END, 'a': g3.a || 'K'},
          {'c': g0.c + CASE WHEN free THEN 2 + t ELSE 1000000000 END, 'a': g0.a || 'R'},
          {'c': g1.c + CASE WHEN free THEN 2 + t ELSE 1000000000 END, 'a': g1.a || 'R'},
          {'c': g3.c + CASE WHEN free THEN 2 + t ELSE 1000000000 END, 'a': g3.a || 'R'}) AS n2,
        least({'c': g3.c + 3, 'a': g3.a || 'D'},
          {'c': g2.c + CASE WHEN free AND r = 'a' THEN t ELSE 1000000000 END, 'a': g2.a || 'K'},
          {'c': g2.c + CASE WHEN free THEN 2 + t ELSE 1000000000 END, 'a': g2.a || 'R'}) AS n3
      FROM steps s JOIN (SELECT *, NOT blank AND NOT seen AS free, cut::BIGINT AS t FROM judged) j
        ON s.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = s.i + 1))),
best AS (
  SELECT s.conv_id, least(g0, g3) AS b FROM steps s JOIN faults f
    ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND s.i = f.n),
letters AS (
  SELECT conv_id, b.a AS audit, k, substr(b.a, k, 1) AS letter FROM best, unnest(range(1, len(b.a) + 1)) AS u(k)),
turns AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS p,
    count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id) AS m
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
repaired AS (
  SELECT t.conv_id, string_agg(CASE WHEN letter = 'K' THEN j.role WHEN (p + m) % 2 = 1 THEN 'user' ELSE 'assistant' END
      || ':' || CASE WHEN letter = 'I' THEN '' ELSE j.text END, chr(10) ORDER BY p) AS body
  FROM turns t JOIN judged j ON t.conv_id IS NOT DISTINCT FROM j.conv_id AND greatest(t.i, 1) = j.i
  WHERE letter <> 'D' GROUP BY t.conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost, coalesce(b.a, '') AS audit,
  sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN faults f ON o.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN best x ON o.conv_id IS NOT DISTINCT FROM x.conv_id
LEFT JOIN repaired y ON o.conv_id IS NOT DISTINCT FROM y.conv_id"""

ORACLES["op13_ranked_search"] = r"""
WITH wanted AS (
  SELECT item_id, term, count(*) AS n FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY ALL),
words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
totals AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS terms FROM words WHERE len(w) > 0),
sizes AS (SELECT r, doc_id, 25 + (75 * len(w) * docs) // terms AS m FROM words, totals WHERE len(w) > 0),
held AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM words)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
  FROM held, totals GROUP BY term, docs),
scores AS (
  SELECT item_id, doc_id, r, sum(n * weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN held USING (term) JOIN sizes USING (r) GROUP BY ALL),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@query
def op1_lm_scores(spark, sf_dir):
    return lm_scores(table(spark, sf_dir, "documents"))


@query
def op2_jaccard_join(spark, sf_dir):
    members, _ = jaccard_join(table(spark, sf_dir, "documents"))
    return members.select("doc_id", "n_shingles", "component_id", "class_id")


@query
def op3_token_counts(spark, sf_dir):
    counts = count_tokens(table(spark, sf_dir, "documents"), model_path())
    return counts.selectExpr("doc_id", "n_bytes", "n_tokens", "n_tokens > 4096 AS over_limit",
                             "n_chunks", "n_widened")


@query
def op4_quality_rules(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents")).drop("reason")


@query
def op5_best_fit_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pack(docs, count=TokensAndEnd(docs, model_path()))


@query
def op6_pii(spark, sf_dir):
    return replace_pii(table(spark, sf_dir, "documents"), PII_KEY)


@query
def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


@query
def op8_secret_scan(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents")).drop("found")


@query
def op9_sentencepiece(spark, sf_dir):
    return encoding_sums(table(spark, sf_dir, "documents"), pieces(model_path()))


@query
def op10_nearest_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 50 = 0"))


@query
def op11_license_scan(spark, sf_dir):
    return license_scan(table(spark, sf_dir, "documents"))


@query
def op12_conversation_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return sums(repair(damage(rows), everyone=rows))


@query
def op13_ranked_search(spark, sf_dir):
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
