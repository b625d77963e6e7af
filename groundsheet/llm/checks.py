"""SQL that gives the rows of those queries that SQL can express, for DuckDB."""

from __future__ import annotations

from groundsheet.llm import quality_rules

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def url_rules(rules: list[tuple[str, str]]) -> str:
    """Longest fitting rule of each url, and blocks over the edges declared in the pages."""
    values = ", ".join(f"('{verdict}', '{rule}')" for verdict, rule in rules)
    host = r"CASE WHEN contains({u}, '://') THEN translate(regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END"
    path = r"CASE WHEN contains({u}, '://') THEN regexp_extract({u}, '(?s)^.*?://[^/?#]*(/[^?#]*)', 1) ELSE '' END"
    query = r"regexp_extract({u}, '(?s)^.*?://[^?#]*(\?[^#]*)', 1)"
    key = f"CASE WHEN {host} <> '' THEN {host} || {path} || {query} END"
    return rf"""
WITH RECURSIVE rules(verdict, rule) AS (VALUES {values}),
cut AS (SELECT *, split_part(rule, '/', 1) AS h, substr(rule, length(split_part(rule, '/', 1)) + 1) AS p FROM rules),
targets AS (
  SELECT url, regexp_extract(t, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS target
  FROM (SELECT url, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*>')) AS t FROM pages)
  WHERE regexp_matches(t, '(?is)\brel\s*=\s*["'']?canonical\b')
  UNION ALL
  SELECT url, regexp_extract(t, '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1)
  FROM (SELECT url, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*>')) AS t FROM pages)
  WHERE regexp_matches(t, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b')),
edges AS (
  SELECT a, b FROM (SELECT {key.format(u="url")} AS a, {key.format(u="target")} AS b FROM targets) WHERE a <> b
  UNION SELECT b, a FROM (SELECT {key.format(u="url")} AS a, {key.format(u="target")} AS b FROM targets) WHERE a <> b),
reach(node, other) AS (SELECT a, a FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a),
roots AS (SELECT node, min(other) AS root FROM reach GROUP BY node),
named AS (SELECT node, root, split_part(node, '/', 1) AS nh, regexp_extract(node, '^[^/?]*(/[^?]*)', 1) AS np FROM roots),
best AS (
  SELECT node, root, arg_max(verdict, length(rule)) AS verdict
  FROM named LEFT JOIN cut ON (nh = h OR ends_with(nh, '.' || h)) AND starts_with(np, p) GROUP BY node, root),
blocked AS (SELECT root, bool_or(coalesce(verdict = 'block', false)) AS hit FROM best GROUP BY root),
keyed AS (
  SELECT row_number() OVER () AS n, page_id, {host.format(u="coalesce(url, '')")} AS host,
         {path.format(u="coalesce(url, '')")} AS path, {key.format(u="url")} AS key FROM pages),
fit AS (
  SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM keyed JOIN cut ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN hit THEN 'block' ELSE 'allow' END) AS verdict, root AS alias_of
FROM keyed LEFT JOIN fit USING (n) LEFT JOIN roots ON node = key LEFT JOIN blocked USING (root)
"""


EMBEDDING_LINKS = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
good AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, least(v.vec_id, coalesce(m, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(m, v.vec_id)) AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) c ON c.a = v.vec_id
LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = v.vec_id
"""


def quality() -> str:
    """Counts, sketches with logarithmic buckets, fences by group with their fallbacks, verdicts."""
    rates = {
        "symbol_rate": "n_symbols / greatest(n_words, 1)", "upper_rate": "n_upper / greatest(word_chars, 1)",
        "dup_line_rate": "n_dup_lines / greatest(n_lines, 1)", "repeat_rate": "n_repeat_words / greatest(n_words, 1)",
        "mean_word": "word_chars / greatest(n_words, 1)",
    }
    listed = " UNION ALL ".join(
        f"SELECT doc_id, lang, source, '{name}' AS rate, {value}::DOUBLE AS x, {gap}::DOUBLE AS gap, {low} AS low_too FROM c WHERE n_words > 0"
        for (name, value), (gap, low) in zip(rates.items(), quality_rules.RATES.values(), strict=True)
    )

    def fences(name: str, keys: str) -> str:
        lead = f"{keys}, " if keys else ""
        return f"""
{name}_n AS (SELECT {lead}rate, gap, low_too, bucket, count(*) AS n FROM r GROUP BY ALL),
{name}_w AS (SELECT *, sum(n) OVER (PARTITION BY {lead}rate ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {lead}rate) AS docs,
  CASE WHEN bucket = {quality_rules.ZERO_BUCKET} THEN 0 ELSE pow({quality_rules.GAMMA}, bucket - 0.5::DOUBLE) END AS v FROM {name}_n),
{name}_q AS (SELECT {lead}rate, gap, low_too, docs, min(CASE WHEN upto >= ceil(docs * 0.25) THEN v END) AS q1,
  min(CASE WHEN upto >= ceil(docs * 0.75) THEN v END) AS q3 FROM {name}_w GROUP BY ALL),
{name} AS (SELECT {lead}rate, docs, CASE WHEN low_too THEN q1 - {quality_rules.REACH} * greatest(q3 - q1, gap) END AS low,
  q3 + {quality_rules.REACH} * greatest(q3 - q1, gap) AS high FROM {name}_q)"""

    least = quality_rules.MIN_GROUP
    pick = lambda c: f"CASE WHEN own.docs >= {least} THEN own.{c} WHEN wide.docs >= {least} THEN wide.{c} ELSE widest.{c} END"
    return rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, unnest({WORDS}) AS word, generate_subscripts({WORDS}, 1) AS pos FROM d),
g AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS k,
  list(word) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS gram FROM w),
hit AS (SELECT doc_id, pos FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS times FROM g WHERE k = 5) WHERE times > 1),
rep AS (SELECT doc_id, count(DISTINCT pos + j) AS n_repeat_words FROM hit, range(5) s(j) GROUP BY doc_id),
lines AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
lc AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id),
wc AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY doc_id),
c AS (SELECT doc_id, lang, source, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(regexp_extract_all(text, '\p{{Lu}}')) AS n_upper,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN wc USING (doc_id) LEFT JOIN lc USING (doc_id) LEFT JOIN rep USING (doc_id)),
x AS ({listed}),
r AS (SELECT *, CASE WHEN x > 0 THEN ceil(ln(x) / ln({quality_rules.GAMMA}::DOUBLE)) ELSE {quality_rules.ZERO_BUCKET} END AS bucket FROM x),
{fences("own", "lang, source")},{fences("wide", "lang")},{fences("widest", "")},
bad AS (
  SELECT DISTINCT x.doc_id FROM x JOIN own ON x.rate = own.rate AND x.lang IS NOT DISTINCT FROM own.lang AND x.source IS NOT DISTINCT FROM own.source
  JOIN wide ON x.rate = wide.rate AND x.lang IS NOT DISTINCT FROM wide.lang JOIN widest ON x.rate = widest.rate
  WHERE x.x > {pick("high")} OR x.x < coalesce({pick("low")}, -1)),
j AS (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.REPEAT_PERCENT} * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept FROM j
"""


CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
o AS (SELECT *, '<|im_start|>' || role || chr(10) || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10) AS formatted FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(formatted))::BIGINT AS formatted_chars
FROM o GROUP BY conv_id
"""


EXACT_GROUPS = r"""
WITH plain AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
sized AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM plain)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM sized
"""


HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
near AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM near JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


PREFIX_TRIE = r"""
WITH named AS (
  SELECT conv_id, turn, left(sha256(length(r) || ':' || r || t), 32) AS id, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL)),
own AS (
  SELECT conv_id, list({'id': id, 'words': words} ORDER BY turn NULLS FIRST, id) AS turns, conv_id - conv_id % 20 AS family,
    xor(list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)), lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)), 4294967295::BIGINT) % 4 AS h
  FROM named GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(f.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns FROM own o LEFT JOIN own f ON f.conv_id = o.family),
steps AS (SELECT conv_id, unnest(range(0, len(turns) + 1)) AS d, turns FROM rebuilt),
nodes AS (
  SELECT list_transform(turns[1:d], lambda x: x.id) AS p, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         any_value(CASE WHEN d > 0 THEN turns[d].words ELSE 0 END) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = len(turns)), '')) AS ends_sha256
  FROM steps GROUP BY ALL),
kids AS (SELECT p[1:depth - 1] AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
told AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (p)),
above AS (SELECT p[1:k] AS p, n_children, n_convs, words FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM told)),
sums AS (SELECT p, sum((n_children = 0)::INTEGER)::BIGINT AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens FROM above GROUP BY 1)
SELECT t.conv_id, t.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, t.n_convs, t.n_children, n_leaves, saved_tokens, t.ends_sha256
FROM told t JOIN sums USING (p) LEFT JOIN nodes u ON t.depth > 0 AND u.p = t.p[1:t.depth - 1]
"""
