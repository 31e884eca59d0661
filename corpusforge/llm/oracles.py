"""DuckDB SQL for the operators that SQL can express, as chains of common table expressions.

Each builder takes the name of a relation with the columns of ``documents`` and gives CTEs; the names of what it makes
carry its own prefix.
"""

from __future__ import annotations


def _crc_entry(i: int) -> int:
    for _ in range(8):
        i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)
    return i


_CRC = "([" + ",".join(str(_crc_entry(i)) for i in range(256)) + "]::BIGINT[])"
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = "'[\\x20\\x09-\\x0D]+'"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), {_GAP}), lambda w: w <> '')"


def _shingles(text: str) -> str:
    return f"(SELECT CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END FROM (SELECT {_words(f"translate({text}, '{_UP}', '{_LOW}')")} AS ws))"


def chat() -> str:
    return """
WITH t AS (SELECT conv_id, turn, coalesce(nullif(role, ''), 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS n FROM t),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
v AS (SELECT n.conv_id, s.speaker, n.n // 64 AS part, n.n,
  '<|im_start|>' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN 'system' ELSE 'user name=' || role END || chr(10) AS head,
  text || '<|im_end|>' || chr(10) AS body, role = speaker AS mine
  FROM n JOIN s ON n.conv_id IS NOT DISTINCT FROM s.conv_id),
o AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker, part ORDER BY n) AS e FROM v)
SELECT conv_id, speaker, part::BIGINT AS part, min(n)::BIGINT AS first_turn, count(*)::BIGINT AS n_turns, string_agg(head || body, '' ORDER BY n) AS text,
  coalesce(string_agg(CASE WHEN mine THEN (e - length(body))::VARCHAR || '-' || e::VARCHAR END, ',' ORDER BY n), '') AS mask_spans,
  coalesce(sum(CASE WHEN mine THEN length(body) END), 0)::BIGINT AS n_target_chars
FROM o GROUP BY conv_id, speaker, part
"""


def quality(src: str) -> str:
    """Makes ``q_out``: every row's measurements and decision, by ``doc_id``."""
    return f"""
q_w AS (SELECT doc_id, source, coalesce(text, '') AS t, {_words('text')} AS ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls FROM {src}),
q_win AS (SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, ws FROM q_w WHERE len(ws) >= 8),
q_key AS (SELECT doc_id, i, array_to_string(ws[i:i+7], ' ') AS k FROM q_win),
q_rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM q_key) WHERE c > 1),
q_cov AS (SELECT doc_id, count(*) AS c FROM (SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS p FROM q_rep) GROUP BY 1),
q_m AS (SELECT w.doc_id, source, len(ws)::BIGINT AS n_words, length(regexp_replace(t, {_GAP}, '', 'g'))::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines, coalesce(c.c, 0)::BIGINT AS n_repeat_words FROM q_w w LEFT JOIN q_cov c USING (doc_id)),
q_f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 30 * n_lines AS any_failed FROM q_m),
q_h AS (SELECT source, count(*) AS n, count(*) FILTER (any_failed) AS bad FROM q_f GROUP BY 1),
q_p AS (SELECT sum(bad) / sum(n) AS mean, coalesce(var_samp(bad / n), 0) AS spread, avg(1 / n) AS noise FROM q_h),
q_a AS (SELECT mean, CASE WHEN spread - mean * (1 - mean) * noise > 0 THEN greatest(mean * (1 - mean) / (spread - mean * (1 - mean) * noise) - 1, 0) ELSE 1e12 END AS weight FROM q_p),
q_v AS (SELECT source, CASE WHEN (bad + weight * mean) / (n + weight) >= 0.6 THEN 'blocked' WHEN (bad + weight * mean) / (n + weight) >= 0.02 THEN 'watched' ELSE 'trusted' END AS host_verdict FROM q_h, q_a),
q_out AS (SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND host_verdict <> 'blocked' AND NOT (host_verdict = 'watched' AND any_failed) AS kept, host_verdict FROM q_f f JOIN q_v v ON f.source IS NOT DISTINCT FROM v.source)"""


def ngram_join(src: str) -> str:
    """Makes ``j_out``: set size and component of every row. Needs WITH RECURSIVE."""
    return f"""
j_s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest({_shingles('text')}) AS sh FROM {src})),
j_n AS (SELECT doc_id, count(*) AS n FROM j_s GROUP BY 1),
j_p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM j_s a JOIN j_s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
j_l AS (SELECT a, b FROM j_p JOIN j_n x ON x.doc_id = a JOIN j_n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
j_e AS (SELECT a, b FROM j_l UNION ALL SELECT b, a FROM j_l),
j_c AS (SELECT doc_id AS node, doc_id AS label FROM j_n UNION SELECT j_e.b, j_c.label FROM j_c JOIN j_e ON j_e.a = j_c.node),
j_out AS (SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.label, d.doc_id)::BIGINT AS component_id
  FROM {src} d LEFT JOIN j_n n USING (doc_id) LEFT JOIN (SELECT node, min(label) AS label FROM j_c GROUP BY 1) m ON m.node = d.doc_id)"""


def contamination(src: str) -> str:
    """Makes ``c_out``: pairs of document and item at the threshold, by brute force over all shingles."""
    return f"""
c_i AS (SELECT DISTINCT item_id, sh FROM (SELECT item_id, unnest({_shingles('text')}) AS sh FROM benchmark)),
c_n AS (SELECT item_id, count(*) AS item_shingles FROM c_i GROUP BY 1),
c_d AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest({_shingles('text')}) AS sh FROM {src})),
c_out AS (SELECT doc_id, item_id, item_shingles::BIGINT AS item_shingles, count(*)::BIGINT AS shared_shingles, count(*) / item_shingles AS containment
  FROM c_d JOIN c_i USING (sh) JOIN c_n USING (item_id) GROUP BY doc_id, item_id, item_shingles HAVING count(*) >= 0.75 * item_shingles)"""


def mixing(src: str) -> str:
    """Makes ``m_doc``: every row with its place, its source's plan and the words it gives.

    Seats are awarded one by one, by listing every quotient that could win.
    """
    return f"""
m_d AS (SELECT *, len({_words('text')})::BIGINT AS size, md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS ord FROM {src}),
m_s AS (SELECT source, sum(size)::BIGINT AS source_size FROM m_d GROUP BY 1),
m_r AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight, 3 * source_size AS cap FROM m_s),
m_k AS (SELECT *, row_number() OVER o AS place, sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
  sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weights FROM m_r WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
m_1 AS (SELECT place AS first_place, left_over AS lo, weights AS wo FROM m_k WHERE left_over * weight < cap * weights ORDER BY place LIMIT 1),
m_t AS (SELECT source, source_size, CASE WHEN first_place IS NULL OR place < first_place THEN cap::DOUBLE ELSE lo::DOUBLE * weight / wo END AS target, ((source_size + 31) // 32)::BIGINT AS blocks FROM m_k LEFT JOIN m_1 ON true),
m_q AS (SELECT source, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source NULLS LAST) AS seat FROM (SELECT source, target, unnest(range(3 * blocks)) AS k FROM m_t) WHERE target > 0),
m_a AS (SELECT source, count(*)::BIGINT AS seats FROM m_q WHERE seat <= (SELECT floor(sum(source_size) / 32 + 0.5) FROM m_t) GROUP BY 1),
m_p AS (SELECT t.*, coalesce(seats, 0) AS seats, CASE WHEN blocks > 0 THEN coalesce(seats, 0) // blocks ELSE 0 END AS passes FROM m_t t LEFT JOIN m_a a ON t.source IS NOT DISTINCT FROM a.source),
m_doc AS (SELECT d.*, p.source_size, p.target, p.blocks, p.passes, p.seats - p.passes * p.blocks AS extra,
  coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY ord, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off
  FROM m_d d JOIN m_p p ON d.source IS NOT DISTINCT FROM p.source),
m_x AS (SELECT *, greatest(least(size, extra * 32 - off), 0)::BIGINT AS part FROM m_doc),
m_h AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY seat) - 1 AS k,
  (SELECT min(p) FROM range(1, 9) r(p) WHERE seat <= floor((SELECT floor(sum(source_size) / 32 + 0.5) FROM m_t) * p / 8)) AS shard FROM m_q),
m_out AS (SELECT doc_id, size, source_size, target, (passes * size + part)::BIGINT AS taken, passes::BIGINT AS whole_passes, CASE WHEN passes * size + part > 0 THEN shard END::BIGINT AS first_shard
  FROM m_x x LEFT JOIN m_h h ON x.source IS NOT DISTINCT FROM h.source AND x.off // 32 = h.k)"""


def mixed_rows() -> str:
    """Makes ``m_rows``: what the mix consists of, with the columns of ``documents``."""
    runs = "regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*')"
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
m_rows AS (SELECT doc_id, text, lang, source, length(text)::BIGINT AS n_chars FROM (
  SELECT doc_id, lang, source, unnest(list_concat(CASE WHEN size > 0 THEN list_transform(range(passes), lambda p: text) ELSE [] END,
    CASE WHEN part = 0 THEN [] WHEN part = size THEN [text]
      ELSE [regexp_extract(text, '^[\\x20\\x09-\\x0D]*') || rtrim(array_to_string(({runs})[1:part], ''), {blanks})] END)) AS text
  FROM m_x))"""


def sharding(src: str) -> str:
    """Makes ``s_out``. Needs WITH RECURSIVE."""
    return f"""
s_j AS (SELECT DISTINCT doc_id, ((coalesce(doc_id, 0)::HUGEINT + 18446744073709551616) % 18446744073709551616)::HUGEINT AS key, 0::BIGINT AS pos, 0::BIGINT AS shard, 0::BIGINT AS grown, 0 AS step FROM {src}
  UNION ALL
  SELECT doc_id, nkey, nat, CASE WHEN nat < 40 THEN nat ELSE shard END, CASE WHEN nat < 41 THEN nat ELSE grown END, step + 1 FROM (
    SELECT *, floor((pos + 1) * (2147483648.0::DOUBLE / ((nkey // 8589934592) + 1)::DOUBLE))::BIGINT AS nat FROM (
      SELECT *, ((((key // 4294967296) * 2862933555777941757) % 4294967296) * 4294967296 + (key % 4294967296) * 2862933555777941757 + 1) % 18446744073709551616 AS nkey FROM s_j WHERE pos <= 40))),
s_k AS (SELECT doc_id, shard, grown FROM s_j WHERE pos > 40),
s_b AS (SELECT doc_id, text, list_transform(range(octet_length(encode(text))), lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::BIGINT) AS bs FROM (SELECT DISTINCT doc_id, text FROM {src})),
s_c AS (SELECT doc_id, text, octet_length(encode(text)) AS n, CASE WHEN text IS NULL THEN NULL WHEN len(bs) = 0 THEN 0 ELSE xor(list_reduce(bs, lambda c, y: xor(c >> 8, {_CRC}[(xor(c, y) & 255) + 1]), 4294967295), 4294967295) END AS crc FROM s_b),
s_d AS (SELECT d.doc_id, (coalesce(c.n, 0) + 16)::BIGINT AS size, c.crc AS text_crc32, k.shard, k.grown FROM {src} d JOIN s_c c ON d.doc_id IS NOT DISTINCT FROM c.doc_id AND d.text IS NOT DISTINCT FROM c.text JOIN s_k k ON d.doc_id IS NOT DISTINCT FROM k.doc_id),
s_out AS (SELECT doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
  (row_number() OVER (PARTITION BY shard ORDER BY md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), coalesce(text_crc32::VARCHAR, ''))), doc_id, size) - 1)::BIGINT AS slot, grown::INTEGER AS grown_shard FROM s_d)"""


def pipeline() -> str:
    return (
        "WITH RECURSIVE "
        + quality("documents")
        + ",\np1 AS (SELECT d.* FROM documents d JOIN q_out q USING (doc_id) WHERE q.kept),"
        + ngram_join("p1")
        + ",\np2 AS (SELECT p1.* FROM p1 JOIN j_out j USING (doc_id) WHERE j.component_id = p1.doc_id),"
        + contamination("p2")
        + ",\np3 AS (SELECT * FROM p2 WHERE doc_id NOT IN (SELECT doc_id FROM c_out)),"
        + mixing("p3")
        + ","
        + mixed_rows()
        + ","
        + sharding("m_rows")
        + "\nSELECT * FROM s_out"
    )
