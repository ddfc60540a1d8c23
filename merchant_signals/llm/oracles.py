"""DuckDB SQL of the queries that SQL can express."""

_A = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

OP1 = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_A}', lower('{_A}')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(translate(coalesce(text, ''), '{_A}', lower('{_A}')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
        FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
spot AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, item, spot.n, i FROM spot JOIN win ON spot.s = win.s AND spot.n = win.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP9 = rf"""
WITH p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_A}', lower('{_A}')) AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
rules AS (SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) AS t(h, q, v)),
fit AS (SELECT page_id, h || q AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h || q) DESC, length(h) DESC) AS k
        FROM s JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q))
SELECT s.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM s LEFT JOIN fit ON fit.page_id = s.page_id AND k = 1
"""

OP2 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{_A}', lower('{_A}')), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 4) - 1], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 4) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS x, b AS y FROM sym UNION SELECT x, b FROM reach JOIN sym ON y = a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(r.m, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x, min(y) AS m FROM reach GROUP BY x) r ON r.x = d.doc_id
"""

OP3 = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
firsts AS (SELECT s, min(doc_id) AS f FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN firsts USING (s) WHERE f < doc_id),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP6 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS x, max(page_id) OVER (PARTITION BY body) AS top FROM p),
d AS (SELECT *, array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (((('0x' || substr(x, ((j // 8) * 10 + 1)::BIGINT, 10))::BIGINT >> (35 - 5 * (j % 8))) & 31) + 1)::BIGINT, 1)), '') AS payload_digest FROM h)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM d
"""



#: The given pages' articles are marked as such: what is inside, block by block.
OP11 = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS x FROM pages),
b AS (SELECT page_id, url, list_transform(regexp_split_to_array(regexp_replace(regexp_replace(x, '</?b>', '', 'g'), '<br>', ' ', 'g'), '</?(?:p|h1)>'),
        lambda t: trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'),
          '&amp;?', '&', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'))) AS t FROM a)
SELECT page_id, url, array_to_string(list_filter(t, lambda y: y <> ''), chr(10) || chr(10)) AS text,
       length(array_to_string(list_filter(t, lambda y: y <> ''), chr(10) || chr(10)))::BIGINT AS n_chars
FROM b
"""


def _op13(leaf_levels: int = 8, group_levels: int = 4) -> str:
    """The trees level by level, up to 16 ** levels nodes; every level keeps a path entry for each leaf below."""
    fields = "doc_id source lang n_chars".split()
    plain = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END" for c in fields]
    low = f"translate(text, '{_A}', lower('{_A}'))"
    leaf = lambda t: f"sha256({' || '.join(plain)} || CASE WHEN {t} IS NULL THEN '-' ELSE strlen({t}) || ':' || {t} END)"
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), "
           "lambda a, x: list_reduce(list_prepend(xor(a, x), range(8)), lambda b, i: xor(b >> 1, 3988292384 * (b & 1)))), 4294967295)")
    parts = [f"""l AS (SELECT doc_id, source, {leaf('text')} AS leaf, {leaf(low)} AS other, {crc} % 5 = 0 AS hit FROM documents),
n0 AS (SELECT dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
              leaf AS d FROM l),
who AS (SELECT dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
               doc_id, leaf, CASE WHEN hit THEN other ELSE leaf END AS start FROM l)"""]
    up = """{b} AS (SELECT {s}, r // 16 AS r, CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY r)) END AS d
        FROM (SELECT *, count(*) OVER (PARTITION BY {s}) AS n FROM {a}) GROUP BY {s}, r // 16)"""
    for i in range(leaf_levels):
        parts.append(up.format(a=f"n{i}", b=f"n{i + 1}", s="s"))
    parts.append(f"m0 AS (SELECT 0 AS s, s AS r, d FROM n{leaf_levels})")
    for i in range(group_levels):
        parts.append(up.format(a=f"m{i}", b=f"m{i + 1}", s="s"))
    side = """{b} AS (SELECT s, r, coalesce(string_agg(d, '' ORDER BY r) OVER (PARTITION BY s, r // 16 ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS x,
        coalesce(string_agg(d, '' ORDER BY r) OVER (PARTITION BY s, r // 16 ORDER BY r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS y, count(*) OVER (PARTITION BY s) > 1 AS real FROM {a})"""
    step = """{b} AS (SELECT w.* REPLACE (CASE WHEN real THEN proof || x || y ELSE proof END AS proof, CASE WHEN real THEN sha256(x || h || y) ELSE h END AS h)
        FROM {a} w JOIN {n} t ON {on})"""
    parts.append("f0 AS (SELECT *, '' AS proof, start AS h FROM who)")
    k = 0
    for i in range(leaf_levels):
        parts += [side.format(a=f"n{i}", b=f"ns{i}"), step.format(a=f"f{k}", b=f"f{k + 1}", n=f"ns{i}", on=f"t.s = w.s AND t.r = w.r >> {4 * i}")]
        k += 1
    for i in range(group_levels):
        parts += [side.format(a=f"m{i}", b=f"ms{i}"), step.format(a=f"f{k}", b=f"f{k + 1}", n=f"ms{i}", on=f"t.r = w.s >> {4 * i}")]
        k += 1
    return f"""WITH {', '.join(parts)}
SELECT doc_id, leaf, n.d AS subroot, m.d AS root, sha256(proof) AS proof_sha256, h AS folded_root, h = m.d AS verified
FROM f{k} f JOIN n{leaf_levels} n ON n.s = f.s CROSS JOIN m{group_levels} m"""


ORACLES = {"op1_decontaminate": OP1, "op2_ngram_jaccard_join": OP2,
           "op3_substring_dedup": OP3, "op6_warc_archive": OP6, "op9_url_filter": OP9, "op11_html_extraction": OP11, "op13_merkle_manifest": _op13(5, 3)}
