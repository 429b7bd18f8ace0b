"""Expected results in DuckDB's SQL, written from the definitions of the operators."""

from __future__ import annotations

from vigilog.llm.quality_rules import FOREIGN, LETTERS, STOP_WORDS

_STOPS = "|".join(sorted(set(STOP_WORDS)))

QUALITY_RULES = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
grams AS (SELECT doc_id, i, [ws[i], ws[i + 1], ws[i + 2]] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines,
    len(list_filter(ws, lambda x: regexp_matches(lower(x), '^({_STOPS})([.,;:!?]|$)'))) AS n_stop,
    len(regexp_extract_all(t, '\\p{{L}}')) - len(regexp_extract_all(t, '[{LETTERS}]')) AS n_foreign,
    len(regexp_extract_all(t, '[A-Z]')) AS n_upper, len(regexp_extract_all(t, '[0-9]')) AS n_digits,
    len(list_filter(ls, lambda x: regexp_matches(x, '^[ \\t-\\r]*[-*•]'))) AS n_bullet,
    len(list_filter(ls, lambda x: ends_with(x, '...') OR ends_with(x, '…'))) AS n_ellipsis
  FROM w LEFT JOIN repeats r ON r.doc_id = w.doc_id),
v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, concat_ws(',',
    CASE WHEN n_words < 50 THEN 'n_words' END,
    CASE WHEN n_foreign <= {FOREIGN} * word_chars AND (n_words = 0 OR word_chars / n_words < 2.5 OR word_chars / n_words > 12) THEN 'mean_word_chars' END,
    CASE WHEN n_words > 0 AND n_symbols / n_words > 0.1 THEN 'symbol_ratio' END,
    CASE WHEN n_foreign <= {FOREIGN} * word_chars AND (n_words = 0 OR n_stop / n_words < 0.04) THEN 'stop_word_ratio' END,
    CASE WHEN word_chars > 0 AND n_upper / word_chars > 0.3 THEN 'upper_ratio' END,
    CASE WHEN word_chars > 0 AND n_digits / word_chars > 0.3 THEN 'digit_ratio' END,
    CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.5 THEN 'dup_line_ratio' END,
    CASE WHEN n_lines > 0 AND n_bullet / n_lines > 0.9 THEN 'bullet_line_ratio' END,
    CASE WHEN n_lines > 0 AND n_ellipsis / n_lines > 0.5 THEN 'ellipsis_line_ratio' END) AS failed_rules
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM v
"""


URL_FILTERS = r"""
WITH p AS (SELECT page_id, url, regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', ['h', 'p']) AS x FROM pages),
q AS (SELECT page_id, lower(coalesce(url, '')) AS u, coalesce(translate(x.h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
             coalesce(x.p, '') AS path FROM p),
rules(rule, rule_host, rule_path, verdict) AS (VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
fit AS (SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict FROM q JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id),
patterns(number, pattern, verdict, re) AS (VALUES
  (0, '||casino-win.', 'block', '^[a-z][a-z0-9+.-]*://([^/?#]*\.)?casino-win\.'), (1, '||free-bets.', 'block', '^[a-z][a-z0-9+.-]*://([^/?#]*\.)?free-bets\.'),
  (2, '||ads-track.', 'block', '^[a-z][a-z0-9+.-]*://([^/?#]*\.)?ads-track\.'), (3, '||spam-farm.', 'block', '^[a-z][a-z0-9+.-]*://([^/?#]*\.)?spam-farm\.'),
  (4, '||cheap-pills.', 'block', '^[a-z][a-z0-9+.-]*://([^/?#]*\.)?cheap-pills\.'), (5, '||adult-x.', 'block', '^[a-z][a-z0-9+.-]*://([^/?#]*\.)?adult-x\.'),
  (6, '||casino.', 'block', '^[a-z][a-z0-9+.-]*://([^/?#]*\.)?casino\.'), (7, '||porn.', 'block', '^[a-z][a-z0-9+.-]*://([^/?#]*\.)?porn\.'),
  (8, '||xxx.', 'block', '^[a-z][a-z0-9+.-]*://([^/?#]*\.)?xxx\.'), (9, '||doubleclick.', 'block', '^[a-z][a-z0-9+.-]*://([^/?#]*\.)?doubleclick\.'),
  (10, '-casino.', 'block', '-casino\.'), (11, '/casino/', 'block', '/casino/'), (12, '/adserver/', 'block', '/adserver/'),
  (13, '/login^', 'block', '/login([^a-z0-9_.%-]|$)'), (14, '/signin^', 'block', '/signin([^a-z0-9_.%-]|$)'), (15, '/cart^', 'block', '/cart([^a-z0-9_.%-]|$)'),
  (16, '/checkout^', 'block', '/checkout([^a-z0-9_.%-]|$)'), (17, '/wp-admin/', 'block', '/wp-admin/'), (18, '/cgi-bin/', 'block', '/cgi-bin/'),
  (19, '.exe|', 'block', '\.exe$'), (20, '.zip|', 'block', '\.zip$'), (21, '?sessionid=', 'block', '\?sessionid='), (22, '&sessionid=', 'block', '&sessionid='),
  (23, '*viagra*', 'block', 'viagra'), (24, '@@||docs.*.example.org^', 'allow', '^[a-z][a-z0-9+.-]*://([^/?#]*\.)?docs\..*\.example\.org([^a-z0-9_.%-]|$)')),
hit AS (SELECT page_id, min_by(pattern, verdict || printf('%05d', number)) AS pattern, min(v.verdict) AS verdict FROM q JOIN patterns v ON regexp_matches(u, re) GROUP BY page_id)
SELECT page_id, host, path, fit.rule, hit.pattern, coalesce(fit.verdict, hit.verdict, 'allow') AS verdict
FROM q LEFT JOIN fit USING (page_id) LEFT JOIN hit USING (page_id)
"""


FILL_IN_MIDDLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '(?s)[A-Za-z]+|[^A-Za-z]') AS u, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
             ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
             t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 AS plain FROM u),
p AS (SELECT *, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
             array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN NOT plain THEN length(p)::BIGINT END AS prefix_chars,
  CASE WHEN NOT plain THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""

# CRC-32 of a decimal number, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
  lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda v, _: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)))"""

CONVERSATION_TRIE = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
original AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS turns FROM t GROUP BY conv_id),
heads AS (SELECT conv_id, turns, conv_id - (conv_id % 5 + 5) % 5 AS base, ({_CRC} % 9)::BIGINT AS h FROM original),
rebuilt AS (SELECT c.conv_id, list_concat(coalesce(b.turns[1:h], []), c.turns[h + 1:]) AS turns FROM heads c LEFT JOIN original b ON b.conv_id = c.base),
prefixes AS (SELECT conv_id, turns[1:depth] AS node, depth, depth = len(turns) AS last FROM (SELECT *, unnest(range(len(turns) + 1)) AS depth FROM rebuilt)),
nodes AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, list(conv_id::VARCHAR ORDER BY conv_id) FILTER (WHERE last) AS ends
          FROM prefixes GROUP BY node, depth),
family AS (SELECT n.*, p.conv_id AS parent_conv_id, coalesce(k.n_children, 0) AS n_children,
             CASE WHEN depth = 0 THEN 0 ELSE (n.n_convs - 1) * strlen(n.node[-1].text) END AS saved
           FROM nodes n LEFT JOIN (SELECT node, conv_id FROM nodes) p ON n.depth > 0 AND p.node = n.node[1:n.depth - 1]
           LEFT JOIN (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL) k ON k.node = n.node),
sums AS (SELECT node[1:up] AS node, sum((n_children = 0)::INT) AS n_leaves, sum(saved) AS saved_tokens
         FROM (SELECT *, unnest(range(depth + 1)) AS up FROM family) GROUP BY ALL)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
  sha256(coalesce(array_to_string(ends, ','), '')) AS ends_sha256
FROM family JOIN sums USING (node)
"""
