"""The same results as ``queries`` in DuckDB SQL, where SQL can express them."""

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED_WORDS = rf"regexp_extract_all({_FOLD}, '[^\x20\x09-\x0D]+')"
_BENCH_WORDS = rf"regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP7 = f"""
WITH d AS (SELECT doc_id, {_BENCH_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_BENCH_WORDS} AS w FROM benchmark),
sizes AS (SELECT item, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
item_windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
lengths AS (SELECT DISTINCT n FROM item_windows),
hits AS (
  SELECT doc_id, i, n, item
  FROM (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM d, lengths, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n) AS dw
  JOIN item_windows USING (n, g)),
words_hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, i, n FROM hits) AS h, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
items_hit AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""

OP4 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED_WORDS} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM d, unnest(range(1, greatest(len(w) - 1, 2))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
  FROM shingles AS a JOIN shingles AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
  WHERE 100 * n_both >= 90 * (x.n + y.n - n_both)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, a AS other FROM edges UNION SELECT doc_id, b FROM reach JOIN edges ON other = a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(least(doc_id, smallest), doc_id) AS component_id
FROM d LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT doc_id, min(other) AS smallest FROM reach GROUP BY doc_id) USING (doc_id)
"""


def _guarded(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for mark in ("<|", "</s>", "<s>", "[INST]", "[/INST]"):
        out = f"replace({out}, '{mark}', '{mark[0]}\\{mark[1:]}')"
    return out


OP9 = f"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
steps AS (
  SELECT conv_id, role, lag(role, 1, 'start') OVER w AS before, lead(role, 1, 'end') OVER w AS after
  FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
states AS (
  SELECT conv_id, bool_and(
    ((before, role) IN (('start', 'system'), ('start', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user')))
    AND (after <> 'end' OR role = 'assistant')) AS valid
  FROM steps GROUP BY conv_id),
c AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss,
    CAST(sum(length('<|turn|><|text|><|end|>') + length({_guarded("role")}) + length({_guarded("text")})) AS BIGINT) AS formatted_chars
  FROM m GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars, valid
FROM c JOIN states USING (conv_id)
"""

OP11 = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
last AS (SELECT payload_digest, max(page_id) AS latest FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN latest IS NOT NULL AND page_id IS DISTINCT FROM latest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM latest THEN latest END AS refers_to
FROM p LEFT JOIN last USING (payload_digest)
"""

ORACLES: dict[str, str] = {
    "op4_prefix_join": OP4,
    "op7_decontamination": OP7,
    "op9_chat_format": OP9,
    "op11_warc_source": OP11,
}
