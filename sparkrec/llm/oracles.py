"""DuckDB SQL that gives the same rows as a query, where SQL can express it."""

from __future__ import annotations

def _crc_table() -> str:
    """What CRC-32 (reflected polynomial 0xEDB88320) makes of each byte."""
    table = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    return f"{table}::UBIGINT[]"


#: CRC-32 of the bytes whose hex digits are `{hex}`.
CRC32 = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(octet_length(encode({hex})) // 2),
    lambda i: ('0x' || substr({hex}, (2 * i + 1)::BIGINT, 2))::UBIGINT)),
  lambda c, b: xor(c >> 8, ({table})[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT)"""

SQL: dict[str, str] = {
    "op3_suffix_dedup": r"""
WITH t AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), windows AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS w FROM (SELECT doc_id, h, unnest(range(n - 99)) AS p FROM t WHERE n >= 100)
), repeats AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS k FROM windows) WHERE k > 1
), marked AS (
  SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS fresh FROM repeats
), numbered AS (
  SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked
), spans AS (
  SELECT doc_id, run, min(p) AS lo, max(p) + 100 AS hi FROM numbered GROUP BY doc_id, run
), cuts AS (
  SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS a, lo AS b FROM spans
  UNION ALL
  SELECT t.doc_id, coalesce(max(hi), 0), any_value(n) FROM t LEFT JOIN spans s ON s.doc_id = t.doc_id GROUP BY t.doc_id
), kept AS (
  SELECT c.doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS rest FROM cuts c JOIN t ON t.doc_id = c.doc_id GROUP BY c.doc_id
), per_doc AS (
  SELECT doc_id, sum(hi - lo)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id
)
SELECT t.doc_id, t.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(rest)) AS kept_sha256
FROM t JOIN kept k ON k.doc_id = t.doc_id LEFT JOIN per_doc p ON p.doc_id = t.doc_id
""",
    "op4_quality_rules": r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM t WHERE len(words) >= 5)
), repeated AS (
  SELECT doc_id, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), repeat_words AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated CROSS JOIN (SELECT unnest(range(5)) AS k) GROUP BY doc_id
), lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM t
), worded AS (
  SELECT doc_id, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w,
         row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS copy_no
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), traits AS (
  SELECT doc_id, line, copy_no, len(w) AS n,
         len(list_filter(w, lambda x: x IN ('|', '>', '»'))) AS bars,
         length(regexp_replace(line, '[^#*$%&<>]', '', 'g')) AS marks,
         (length(line) - length(replace(line, '!!', ''))) / 2 AS shouts,
         len(list_distinct(w)) AS kinds,
         length(array_to_string(w, '')) AS visible,
         length(regexp_replace(line, '[^\p{L}\p{N}]', '', 'g')) AS letters,
         regexp_matches(lower(line), 'all rights reserved|click here|cookie policy|enable javascript|lorem ipsum|privacy policy|read more|sign in|sign up|skip to content|subscribe to our|terms of service|terms of use'
           || '|alle rechte vorbehalten|cookie-richtlinie|datenschutzerklärung|hier klicken|impressum|jetzt anmelden|javascript aktivieren|mehr erfahren|newsletter abonnieren|nutzungsbedingungen|weiterlesen|zum inhalt springen'
           || '|abonnez-vous|activer javascript|aller au contenu|cliquez ici|conditions générales|inscrivez-vous|lire la suite|mentions légales|politique de confidentialité|politique de cookies|se connecter|tous droits réservés'
           || '|activar javascript|aviso legal|haga clic aquí|iniciar sesión|leer más|política de cookies|política de privacidad|regístrate|saltar al contenido|suscríbete|términos de uso|todos los derechos reservados') AS furniture
  FROM worded
), judged AS (
  SELECT doc_id, copy_no, visible,
         (n >= 3 AND bars >= CASE WHEN n <= 12 THEN 2 ELSE 3 END AND 4 * bars >= n) OR (n >= 3 AND (marks >= n OR 2 * shouts >= n))
         OR (n >= 12 AND 4 * kinds <= n) OR (n <= 12 AND furniture) OR (n >= 3 AND 2 * letters < visible) AS bad
  FROM traits
), per_doc AS (
  SELECT doc_id, count(*) FILTER (copy_no > 1) AS n_dup_lines, count(*) FILTER (bad) AS n_bad_lines,
         coalesce(sum(visible) FILTER (bad), 0)::BIGINT AS lost_chars
  FROM judged GROUP BY doc_id
), base AS (
  SELECT t.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words, coalesce(n_bad_lines, 0) AS n_bad_lines, coalesce(lost_chars, 0) AS lost_chars
  FROM t LEFT JOIN per_doc p ON p.doc_id = t.doc_id LEFT JOIN repeat_words r ON r.doc_id = t.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND lost_chars <= 0.3 * word_chars AS kept,
       n_bad_lines, lost_chars
FROM base
""",
    "op9_metric_join": r"""
WITH RECURSIVE u AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), pairs AS (
  SELECT a.vec_id AS x, b.vec_id AS y
  FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) >= 0.93
), reach AS (
  SELECT vec_id AS x, vec_id AS y FROM u
  UNION
  SELECT r.x, p.y FROM reach r JOIN pairs p ON p.x = r.y
), low AS (
  SELECT x, min(y) AS component_id FROM reach GROUP BY x
), deg AS (
  SELECT x, count(*) AS n_links FROM pairs GROUP BY x
)
SELECT u.vec_id, coalesce(deg.n_links, 0) AS n_links, low.component_id, u.vec_id = low.component_id AS kept
FROM u JOIN low ON low.x = u.vec_id LEFT JOIN deg ON deg.x = u.vec_id
""",
    "op10_minhash": r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM t WHERE len(w) >= 2)
  UNION ALL
  SELECT doc_id, w[1] FROM t WHERE len(w) = 1
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL) p
  JOIN sizes a ON a.doc_id = p.x JOIN sizes b ON b.doc_id = p.y
  WHERE 100 * shared >= 80 * (a.n + b.n - shared)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM t
  UNION
  SELECT r.x, p.y FROM reach r JOIN pairs p ON p.x = r.y
), low AS (
  SELECT x, min(y) AS component_id FROM reach GROUP BY x
)
SELECT t.doc_id, coalesce(s.n, 0) AS n_shingles, low.component_id, t.doc_id = low.component_id AS kept
FROM t JOIN low ON low.x = t.doc_id LEFT JOIN sizes s ON s.doc_id = t.doc_id
""",
    "op11_prefix_trie": r"""
WITH turns AS (
  SELECT conv_id, coalesce(text, '') AS text, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS turn_hash,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT DISTINCT conv_id, hex(encode(conv_id::VARCHAR)) AS id_hex FROM turns
), convs AS (
  SELECT conv_id, (""" + CRC32.format(hex="id_hex", table=_crc_table()) + r""" % 4)::BIGINT AS h FROM ids
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.text, t.turn_hash FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.text, t.turn_hash FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
), paths AS (
  SELECT conv_id, row_number() OVER w AS depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words, string_agg(turn_hash, '') OVER w AS node FROM rebuilt
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM convs
), lengths AS (
  SELECT conv_id, max(depth) AS n FROM paths GROUP BY conv_id
), nodes AS (
  SELECT p.node, p.depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, any_value(p.words) AS words,
         sha256(coalesce(string_agg(CASE WHEN p.depth = l.n THEN p.conv_id::VARCHAR END, ',' ORDER BY p.conv_id), '')) AS ends_sha256
  FROM paths p JOIN lengths l ON l.conv_id = p.conv_id GROUP BY p.node, p.depth
), children AS (
  SELECT substr(node, 1, 32 * (depth - 1)::INT) AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), known AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.node = n.node
), subtrees AS (
  SELECT a.node, count(*) FILTER (x.n_children = 0) AS n_leaves, sum((x.n_convs - 1) * x.words)::BIGINT AS saved_tokens
  FROM known x JOIN paths a ON a.conv_id = x.conv_id AND a.depth <= x.depth GROUP BY a.node
)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, s.n_leaves, s.saved_tokens, k.ends_sha256
FROM known k JOIN subtrees s ON s.node = k.node LEFT JOIN nodes p ON k.depth > 0 AND p.node = substr(k.node, 1, 32 * (k.depth - 1)::INT)
""",
    "op12_fill_in_middle": r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), draws AS (
  SELECT doc_id, text, lines, len(lines) AS n, ('0x' || substr(h, 1, 8))::UBIGINT % (len(lines) + 1) AS a, ('0x' || substr(h, 9, 8))::UBIGINT % (len(lines) + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::UBIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM t
), parts AS (
  SELECT doc_id, text, n::BIGINT AS n, form, coalesce(array_to_string(lines[1:least(a, b)::BIGINT], ''), '') AS prefix,
         coalesce(array_to_string(lines[least(a, b)::BIGINT + 1:greatest(a, b)::BIGINT], ''), '') AS middle,
         coalesce(array_to_string(lines[greatest(a, b)::BIGINT + 1:], ''), '') AS suffix FROM draws
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
""",
    "op13_sharding": r"""
WITH RECURSIVE t AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) + 8 AS size, md5(coalesce(doc_id::VARCHAR, '')) AS m FROM documents
), sums AS (
  SELECT doc_id, size, substr(m, 1, 16) AS value, """ + CRC32.format(hex="h", table=_crc_table()) + r""" AS crc FROM t
), keys AS (
  SELECT DISTINCT value FROM sums
), jumps AS (
  SELECT value, ('0x' || value)::UBIGINT::HUGEINT AS state, -1::BIGINT AS at, 0::BIGINT AS next FROM keys
  UNION ALL
  SELECT value, s, next, floor((next + 1) * (2147483648.0::DOUBLE / ((s // 8589934592) + 1)::DOUBLE))::BIGINT
  FROM (SELECT value, next, (state * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT AS s FROM jumps WHERE next < 25)
), shards AS (
  SELECT value, max(next) FILTER (next < 24) AS shard, max(next) FILTER (next < 25) AS grown FROM jumps GROUP BY value
)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY s.value, doc_id NULLS FIRST, crc, size) - 1 AS slot, grown::INTEGER AS grown_shard
FROM sums s JOIN shards j ON j.value = s.value
""",
}
