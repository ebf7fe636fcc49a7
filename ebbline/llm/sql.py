"""DuckDB SQL with the same rows as the queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
# Fixed values, stated here anew: the queries are compared with them.
_MENU = ", ".join(
    f"'{w}'"
    for w in (
        "home about contact login logout register sign in up menu search sitemap next previous prev back top faq help blog news archive share "
        "follow subscribe privacy terms cart account shop startseite kontakt anmelden abmelden registrieren suche menü weiter zurück hilfe "
        "impressum datenschutz warenkorb konto teilen accueil connexion déconnexion inscription recherche suivant précédent aide panier compte "
        "partager contactez mentions légales inicio contacto registro buscar menú siguiente anterior ayuda carrito cuenta compartir seguir privacidad"
    ).split()
)
_SEPARATORS = "'|', '||', '>', '>>', '/', '»', '•', '·', '-'"
_NOTICE = (
    r"^[^\p{L}\p{N}_]*(licensed under|released under|distributed under|all rights reserved|copyright([^\p{L}\p{N}_]|$)|\(c\)|©|"
    r"(this (web)?site|we) uses? cookies|accept (all )?cookies|please enable javascript|enable javascript|terms of (use|service)|"
    r"privacy policy|subscribe to our newsletter|skip to (main )?content)|all rights reserved[^\p{L}\p{N}_]*$|use of cookies|lorem ipsum"
)

QUALITY_RULES = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents
), windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d WHERE len(words) >= 3)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY doc_id
), lines AS (
  SELECT doc_id, line, regexp_extract_all(line, '{_WORD}') AS words
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
), judged AS (
  SELECT doc_id, line, length(array_to_string(words, '')) AS chars,
    length(regexp_replace(line, '[^!-/:-@\[-`{{-~]', '', 'g')) > 0.25::DOUBLE * strlen(array_to_string(words, ''))
    OR (len(words) >= 3 AND 2 * len(list_filter(words, lambda w: regexp_matches(w, '[!?#$%&*]{{2,}}$'))) > len(words))
    OR (len(list_filter(words, lambda w: w IN ({_SEPARATORS}))) >= 3
        AND 4 * len(list_filter(words, lambda w: w IN ({_SEPARATORS}))) >= len(words))
    OR (len(words) <= 10
        AND NOT regexp_matches(regexp_replace(line, '[\x20\x09-\x0D]+$', ''), '(?:[.!?:;]|…)["'')\]]*$')
        AND 2 * len(list_filter(words, lambda w: trim(lower(w), ',.:;') IN ({_MENU}))) >= len(words))
    OR regexp_matches(lower(line), '{_NOTICE}') AS fails
  FROM lines WHERE len(words) > 0
), per_line AS (
  SELECT doc_id, coalesce(sum(chars) FILTER (fails), 0)::BIGINT AS lost_chars, count(*) FILTER (fails) AS lost_lines,
    count(*) - count(DISTINCT line) AS n_dup_lines
  FROM judged GROUP BY doc_id
), base AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(lost_chars, 0)::BIGINT AS lost_chars, coalesce(lost_lines, 0)::BIGINT AS lost_lines
  FROM d LEFT JOIN repeats r USING (doc_id) LEFT JOIN per_line USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND lost_chars <= 0.5::DOUBLE * word_chars AS kept,
  lost_chars, lost_lines
FROM base
"""

MIXING = rf"""
WITH sizes AS (
  SELECT source, sum(coalesce(strlen(text), 0) + 1)::DOUBLE AS bytes FROM documents GROUP BY source
), weighted AS (
  SELECT source, bytes, pow(bytes, 0.7::DOUBLE) AS weight FROM sizes
), rates AS (
  SELECT source, 1.0::DOUBLE * (SELECT sum(bytes) FROM weighted) * weight / (SELECT sum(weight) FROM weighted) / bytes AS rate FROM weighted
), logs AS (
  SELECT source, rate, k, CASE WHEN k = 0 THEN 0.0 ELSE ln(rate) - ln(k) END AS part
  FROM (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 24)::BIGINT + 1)) AS k FROM rates)
), terms AS (
  SELECT source, rate, k, exp(sum(part) OVER (PARTITION BY source ORDER BY k) - rate) AS p FROM logs
), sums AS (
  SELECT source, rate, sum(p) OVER (PARTITION BY source ORDER BY k) AS upto FROM terms
), drawn AS (
  SELECT doc_id, source, text, ('0x' || left(md5('20240|' || doc_id), 13))::BIGINT / 4503599627370496.0 AS draw FROM documents
), counted AS (
  SELECT d.doc_id, d.source, d.text, any_value(s.rate) AS rate, count(*) AS n_copies
  FROM drawn d JOIN sums s ON s.source IS NOT DISTINCT FROM d.source AND s.upto <= d.draw GROUP BY d.doc_id, d.source, d.text
)
SELECT doc_id, source, text, round(rate, 9) AS rate, n_copies, copy, md5('20240-order|' || doc_id || '|' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(1, n_copies + 1)) AS copy FROM counted)
"""

DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), words AS (
  SELECT row, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d
), kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 30
), langs AS (
  SELECT lang, sum(n) AS n, count(*) AS v FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
), sources AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN counts c USING (lang, source) GROUP BY g.lang, g.source
), shares AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (s.n + 5 * l.v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (k.n + 5)) // (l.n + 5 * l.v)::HUGEINT AS q
  FROM sources s JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0)::BIGINT AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY x.lang, x.source, y.source
  ) v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q
)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 50
"""

WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id) AS place, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND place > 1 THEN least END AS refers_to
FROM ranked
"""

PREFIX_TRIE = """
WITH RECURSIVE bits AS (
  SELECT i, 0 AS k, i::BIGINT AS c FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS lookup FROM bits WHERE k = 8
), own AS (
  SELECT conv_id, list({'id': md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 'n': strlen(coalesce(text, ''))}
    ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (
  SELECT conv_id, turns, xor(list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda a, x: xor(a >> 8, lookup[(xor(a, x) & 255) + 1])), 4294967295) % 9 AS h
  FROM own, crc
), rebuilt AS (
  SELECT c.conv_id, coalesce(b.turns, [])[1:h] || c.turns[h + 1:] AS turns
  FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5
), steps AS (
  SELECT conv_id, len(turns) AS turns, d, array_to_string(list_transform(turns[1:d], lambda x: x.id), '') AS node,
    CASE WHEN d > 0 THEN array_to_string(list_transform(turns[1:d - 1], lambda x: x.id), '') END AS parent, CASE WHEN d > 0 THEN turns[d].n ELSE 0 END AS n_bytes
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT node, d, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n_bytes) AS n_bytes,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (turns = d), '')) AS ends_sha256
  FROM steps GROUP BY node, d
), children AS (
  SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), sums AS (
  SELECT above AS node, sum((n_convs - 1) * n_bytes) AS saved_tokens, count(*) FILTER (n_children IS NULL) AS n_leaves
  FROM (SELECT *, left(node, 32 * unnest(range(0, d + 1))) AS above FROM nodes LEFT JOIN children USING (node)) GROUP BY above
)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0)::BIGINT AS n_children, s.n_leaves,
  s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN children c ON c.node = n.node JOIN sums s ON s.node = n.node
"""

ORACLE_SQL = {"op13_prefix_trie": PREFIX_TRIE, "op12_warc": WARC, "op11_divergence": DIVERGENCE, "op4_quality_rules": QUALITY_RULES, "op10_mixing": MIXING}
