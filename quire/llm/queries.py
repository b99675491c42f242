"""The registered queries of this subpackage and their DuckDB SQL, where SQL
can express them."""

from __future__ import annotations

from . import chat, decontam, linededup, mixing, neardup, periodic, prefixtrie, secrets, simhash, tokencount, tokenfile, topk, toxicity

QUERIES = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_near_duplicates": neardup.op2_near_duplicates,
    "op3_chat_format": chat.op3_chat_format,
    "op4_token_file": tokenfile.op4_token_file,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_line_dedup": linededup.op6_line_dedup,
    "op7_source_mix": mixing.op7_source_mix,
    "op8_token_counts": tokencount.op8_token_counts,
    "op9_decontamination": decontam.op9_decontamination,
    "op9_decontamination_near": decontam.op9_decontamination_near,
    "op10_top_k": topk.op10_top_k,
    "op11_periodic_runs": periodic.op11_periodic_runs,
    "op12_prefix_trie": prefixtrie.op12_prefix_trie,
    "op13_simhash": simhash.op13_simhash,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = {
    "op3_chat_format": """
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|turn|><|text|><|end|>') + length(regexp_replace(role, '<(~*)[|]', '<~\\1|', 'g'))
           + length(regexp_replace(text, '<(~*)[|]', '<~\\1|', 'g')))::BIGINT AS formatted_chars
FROM said GROUP BY conv_id""",
    "op10_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 5""",
    "op6_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
  FROM documents),
keyed AS (
  SELECT doc_id, i, line,
         translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
repeated AS (
  SELECT k, max(doc_id) AS keep FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (keep IS NOT NULL AND keep <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keep IS NULL OR keep = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN repeated USING (k) GROUP BY doc_id""",
    "op9_decontamination": f"""
WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT len(win) AS n FROM windows),
spots AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, lengths)),
hits AS (SELECT doc_id, i, n, item_id FROM spots JOIN windows USING (win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
    # The CRC is XORed bit by bit; a node is the list of its turns' hashes.
    "op12_prefix_trie": """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, length(coalesce(text, '')) AS chars, turn,
         sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS said
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, said) AS i FROM turns),
convs AS (
  SELECT conv_id AS c, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
             lambda acc, x: list_reduce(range(8), lambda a, k: xor(a >> 1, (a & 1) * 3988292384), xor(acc, x)), 4294967295::BIGINT), 4294967295::BIGINT) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c, i, said, chars FROM convs JOIN own ON own.conv_id = base AND i <= h
  UNION ALL SELECT c, i, said, chars FROM convs JOIN own ON own.conv_id = c AND i > h),
paths AS (
  SELECT c, row_number() OVER w AS d, list(said) OVER w AS p, chars FROM rebuilt
  WINDOW w AS (PARTITION BY c ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT c, 0, []::VARCHAR[], 0 FROM convs),
ended AS (SELECT c, max(d) AS d FROM paths GROUP BY c),
nodes AS (
  SELECT p, paths.d AS d, min(c) AS conv_id, count(*) AS n, any_value(chars) AS chars,
         string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ended.d = paths.d) AS ends
  FROM paths JOIN ended USING (c) GROUP BY p, paths.d),
children AS (SELECT list_slice(p, 1, d - 1) AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
facts AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (p)),
sums AS (
  SELECT list_slice(p, 1, j) AS p, count(*) FILTER (n_children = 0) AS n_leaves, sum((n - 1) * chars) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM facts) GROUP BY 1)
SELECT f.conv_id, f.d AS depth, up.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children, n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
FROM facts f JOIN sums USING (p) LEFT JOIN facts up ON f.d > 0 AND up.p = list_slice(f.p, 1, f.d - 1)""",
}
