"""SQL for DuckDB that gives the same rows as the registered queries, where SQL can express them."""

from __future__ import annotations

from tidemark.llm import decontaminate, licenses, urls
from tidemark.llm.common import UPPER

_LOWER = f"'{UPPER}', '{UPPER.lower()}'"
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _license_scan() -> str:
    rows = [
        f"('{name}', '{pair}', {len(pairs)}, {a}, {b})"
        for name, pairs in licenses.template_bigrams().items()
        for a, b in [licenses.size_bounds(len(pairs), licenses.THRESHOLD)]
        for pair in pairs
    ]
    return f"""
WITH passages AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS passage FROM documents
  UNION ALL SELECT doc_id, unnest(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n')) FROM documents
  UNION ALL SELECT doc_id, text FROM documents
), plain AS (
  SELECT DISTINCT doc_id, trim(regexp_replace(translate(passage, {_LOWER}), '[^a-z0-9]+', ' ', 'g')) AS plain
  FROM passages
), sized AS (
  SELECT doc_id, plain, length(plain) - length(replace(plain, ' ', '')) AS n, string_split(plain, ' ') AS words
  FROM plain
), pairs AS (
  SELECT doc_id, plain, n, words[i] || ' ' || words[i + 1] AS pair, i
  FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM sized WHERE n BETWEEN 1 AND 400)
), numbered AS (
  SELECT doc_id, plain, n,
         pair || ' ' || (row_number() OVER (PARTITION BY doc_id, plain, pair ORDER BY i) - 1) AS pair
  FROM pairs
), templates(template, pair, size, least, most) AS (VALUES {", ".join(rows)}),
hits AS (
  SELECT doc_id, plain, template, 2 * count(*) / (any_value(n) + any_value(size)) AS score
  FROM numbered JOIN templates USING (pair)
  WHERE n BETWEEN least AND most
  GROUP BY doc_id, plain, template
  HAVING score >= {licenses.THRESHOLD}
), ranked AS (
  SELECT doc_id, template, score, count(*) OVER (PARTITION BY doc_id) AS n_hits,
         row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, template) AS r
  FROM hits
)
SELECT d.doc_id, template AS license, score, coalesce(n_hits, 0) AS n_hits
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN ranked h ON d.doc_id = h.doc_id AND r = 1
"""


_NEAR_DEDUP = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, {_LOWER}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY 1, 2 HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least USING (doc_id)
"""


def _url_filter() -> str:
    ordered = sorted(urls.RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [
        (f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, says)
        for h, p, says in ordered
    ]
    found = " ".join(f"WHEN {when} THEN '{text}'" for when, text, _ in fits)
    says = " ".join(f"WHEN {when} THEN '{verdict}'" for when, _, verdict in fits)
    levels = ""
    for i in range(1, urls.LEVELS + 1):
        levels += f"""
), places{i} AS (
  SELECT host, template FROM (
    SELECT host, template, s[{i}] AS segment, sum(pages) AS pages FROM tree{i - 1} WHERE s[{i}] IS NOT NULL
    GROUP BY ALL)
  GROUP BY host, template
  HAVING sum(pages) >= {urls.LEAST_PAGES} AND count(*) >= {urls.LEAST_SHARE} * sum(pages)
), tree{i} AS (
  SELECT t.* EXCLUDE (template), CASE WHEN s[{i}] IS NULL THEN t.template
    WHEN p.host IS NOT NULL OR regexp_matches(s[{i}], '{urls.NUMBER}') THEN t.template || '/*'
    ELSE t.template || '/' || s[{i}] END AS template
  FROM tree{i - 1} t LEFT JOIN places{i} p ON t.host = p.host AND t.template = p.template"""
    return f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_LOWER}) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), ruled AS (
  SELECT *, CASE {found} END AS rule, CASE {says} END AS says FROM parsed
), nodes AS (
  SELECT host, path, count(*) AS pages, count(says) AS known, count(*) FILTER (says = 'block') AS bad,
         list_filter(string_split(path, '/'), lambda x: x <> '') AS parts
  FROM ruled GROUP BY host, path
), tree0 AS (
  SELECT *, parts[1:{urls.LEVELS}] AS s, '' AS template FROM nodes{levels}
), tree AS (
  SELECT *, regexp_replace(whole, '[^/*{{}}]+((/[*]+)*)$', '{{}}\\1') AS sibling
  FROM (SELECT host, path, pages, known, bad,
               template || CASE WHEN len(parts) > {urls.LEVELS} THEN '/**' ELSE '' END AS whole
        FROM tree{urls.LEVELS})
), branches AS (
  SELECT host, whole, any_value(sibling) AS sibling, sum(pages) AS pages, sum(known) AS known, sum(bad) AS bad FROM tree
  GROUP BY host, whole
), compared AS (
  SELECT *, sum(known) OVER w AS all_known, sum(bad) OVER w / nullif(sum(known) OVER w, 0) AS mean,
         avg(CASE WHEN known > 0 THEN pages END) OVER w AS usual
  FROM branches
  WINDOW w AS (PARTITION BY host, sibling)
), named AS (
  SELECT *, CASE WHEN known > 0 AND abs(bad / known - mean)
      <= {urls.ERRORS} * sqrt(mean * (1 - mean) * (1 / known - 1 / all_known)) + 1e-9
      OR known = 0 AND (pages - usual) * (pages - usual) <= {urls.ERRORS**2} * (pages + usual)
    THEN sibling ELSE whole END AS merged
  FROM compared
), pure AS (
  SELECT host, merged, sum(known) AS n,
         (sum(bad) + {urls.PRIOR} * coalesce((SELECT sum(bad) / nullif(sum(known), 0) FROM branches), 0))
           / (sum(known) + {urls.PRIOR}) AS purity
  FROM named GROUP BY host, merged
)
SELECT page_id, host, path, rule, whole AS template, purity,
       coalesce(says, CASE WHEN n > 0 AND purity >= {urls.REJECT} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled JOIN tree USING (host, path) JOIN named USING (host, whole) JOIN pure USING (host, merged)
"""


_TOP_K = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""


_LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, {_WHITE}), {_LOWER}) AS key FROM lines
), first AS (
  SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10 GROUP BY key
), marked AS (
  SELECT k.*, coalesce(doc_id > first_id, false) AS gone FROM keyed k LEFT JOIN first USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


_WORDS = f"regexp_extract_all(translate(text, {_LOWER}), '{decontaminate.WORD}')"
_DECONTAMINATE = f"""
WITH words AS (
  SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents
), items AS (
  SELECT item_id, {_WORDS} AS w FROM benchmark
), starts AS (
  SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS said, least(len(w), 10) AS n FROM starts
), lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, lengths WHERE len(w) >= n
), hits AS (
  SELECT doc_id, i, p.n, item_id
  FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS said FROM places) p
  JOIN windows USING (said, n)
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits)
  GROUP BY doc_id
), held AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN held USING (doc_id)
"""


SQL = {
    "op2_license_scan": _license_scan(),
    "op5_near_dedup": _NEAR_DEDUP,
    "op6_url_filter": _url_filter(),
    "op8_top_k": _TOP_K,
    "op10_line_dedup": _LINE_DEDUP,
    "op13_decontaminate": _DECONTAMINATE,
}
