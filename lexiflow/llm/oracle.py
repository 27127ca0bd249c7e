"""DuckDB SQL of the registered queries that SQL can express."""

SQL: dict[str, str] = {}

SQL["op5_revisit_resolution"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((('0x' || substr(hex, 5 * (k // 4) + 1, 5))::BIGINT >> (15 - 5 * (k % 4))) & 31) + 1)::BIGINT, 1)
      for k in range(32)], '') AS payload_digest
  FROM p
), f AS (SELECT payload_digest, min(page_id) AS first_id FROM d GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d JOIN f USING (payload_digest)
"""

SQL["op9_host_reputation"] = r"""
WITH p AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), l AS (
  SELECT doc_id AS page_id, (quality = 0 OR toxic = 1)::INT AS bad FROM labels
  WHERE doc_id IS NOT NULL AND (quality = 0 OR toxic = 1) IS NOT NULL
), o AS (SELECT host, count(*) AS n, sum(bad) AS bad FROM p JOIN l USING (page_id) GROUP BY host),
h AS (
  SELECT host, regexp_replace(host, ':[0-9]*$', '') AS bare, coalesce(n, 0)::DOUBLE AS n, coalesce(bad, 0)::DOUBLE AS bad
  FROM (SELECT DISTINCT host FROM p) LEFT JOIN o USING (host)
), h2 AS (
  SELECT *, regexp_extract(bare, '([^.]+\.[^.]+)$', 1) AS two, regexp_extract(bare, '([^.]+\.[^.]+\.[^.]+)$', 1) AS three FROM h
), h3 AS (
  SELECT host, n, bad,
    CASE WHEN long THEN two ELSE regexp_extract(bare, '([^.]*)$', 1) END AS suffix,
    CASE WHEN (CASE WHEN long THEN three ELSE two END) = '' THEN bare WHEN long THEN three ELSE two END AS domain
  FROM (SELECT *, two IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.in', 'com.cn') AS long FROM h2)
), r AS (SELECT (sum(bad) + 1.0) / (sum(n) + 2.0) AS pmean FROM h3),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(pmean) AS pm FROM h3, r GROUP BY suffix),
sm AS (SELECT count(*)::DOUBLE AS g, sum(n) AS t, sum(n * (bad / n - pm) * (bad / n - pm)) AS s, sum(n * pm * (1 - pm)) AS v FROM s0 WHERE n > 0),
sr AS (SELECT CASE WHEN v > 0 AND g / t < 1 THEN (s / t - v / t * (g / t)) / (v / t * (1 - g / t)) END AS rho FROM sm),
sk AS (SELECT least(greatest(CASE WHEN rho IS NULL THEN 2.0 WHEN rho > 0 THEN 1 / rho - 1 ELSE 1000.0 END, 2.0), 1000.0) AS m FROM sr),
s1 AS (SELECT suffix, (m * pm + bad) / (m + n) AS mean FROM s0, sk),
d0 AS (SELECT h3.suffix, domain, sum(n) AS n, sum(bad) AS bad, any_value(mean) AS pm FROM h3 JOIN s1 USING (suffix) GROUP BY h3.suffix, domain),
dm AS (SELECT count(*)::DOUBLE AS g, sum(n) AS t, sum(n * (bad / n - pm) * (bad / n - pm)) AS s, sum(n * pm * (1 - pm)) AS v FROM d0 WHERE n > 0),
dr AS (SELECT CASE WHEN v > 0 AND g / t < 1 THEN (s / t - v / t * (g / t)) / (v / t * (1 - g / t)) END AS rho FROM dm),
dk AS (SELECT least(greatest(CASE WHEN rho IS NULL THEN 2.0 WHEN rho > 0 THEN 1 / rho - 1 ELSE 1000.0 END, 2.0), 1000.0) AS m FROM dr),
d1 AS (SELECT suffix, domain, (m * pm + bad) / (m + n) AS mean FROM d0, dk),
h4 AS (SELECT host, n, bad, mean AS pm FROM h3 JOIN d1 USING (suffix, domain)),
hm AS (SELECT count(*)::DOUBLE AS g, sum(n) AS t, sum(n * (bad / n - pm) * (bad / n - pm)) AS s, sum(n * pm * (1 - pm)) AS v FROM h4 WHERE n > 0),
hr AS (SELECT CASE WHEN v > 0 AND g / t < 1 THEN (s / t - v / t * (g / t)) / (v / t * (1 - g / t)) END AS rho FROM hm),
hk AS (SELECT least(greatest(CASE WHEN rho IS NULL THEN 2.0 WHEN rho > 0 THEN 1 / rho - 1 ELSE 1000.0 END, 2.0), 1000.0) AS m FROM hr),
h5 AS (SELECT host, (m * pm + bad) / (m + n) AS mean, m + n AS st FROM h4, hk),
b AS (SELECT host, greatest(mean - 1.645 * sqrt(mean * (1 - mean) / (st + 1)), 0.0) AS low FROM h5),
j AS (
  SELECT page_id, p.host, path, low,
    CASE WHEN (p.host = 'example.org' OR ends_with(p.host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN (p.host = 'example.org' OR ends_with(p.host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN (p.host = 'com' OR ends_with(p.host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN (p.host = 'com' OR ends_with(p.host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN (p.host = 'org' OR ends_with(p.host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM p JOIN b ON p.host = b.host
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN low > 0.4 THEN 'block' ELSE 'allow' END AS verdict
FROM j
"""

# Walks and levels as in quality_rules: 5 rules, limit 0.02 / 5, level 0.05 / (strata * 5).
_SHARES = "[500, 400, 300, 250, 200, 150, 120, 100, 80, 60, 50, 40, 30, 20, 10, 5]"
SQL["op2_risk_controlled_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM d
), g AS (
  SELECT rid, i, words[i:i + 2] AS tri FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), g2 AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, tri) AS c FROM g) WHERE c > 1
), r AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM g2) GROUP BY rid
), f AS (
  SELECT d.doc_id, d.stratum, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    len(lines)::BIGINT AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_upper
  FROM d JOIN w USING (rid) LEFT JOIN r USING (rid)
), good AS (
  SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1
), rules AS (
  SELECT * FROM (VALUES ('symbols', {_SHARES}), ('duplicate_lines', [900, 800, 700, 600] || {_SHARES}),
    ('repeated_words', [900, 800, 700, 600] || {_SHARES}), ('upper_case', [900, 800, 700, 600] || {_SHARES}),
    ('long_words', [30000, 25000, 20000, 18000, 16000, 14000, 12000, 11000, 10000])) t(rule, cuts)
), cuts AS (SELECT rule, unnest(cuts) AS cut, generate_subscripts(cuts, 1) AS j FROM rules),
m AS (
  SELECT doc_id, stratum, rule,
    CASE rule WHEN 'symbols' THEN n_symbols WHEN 'duplicate_lines' THEN n_dup_lines WHEN 'repeated_words' THEN n_repeat_words
      WHEN 'upper_case' THEN n_upper ELSE word_chars END AS a,
    CASE rule WHEN 'symbols' THEN word_chars WHEN 'duplicate_lines' THEN n_lines WHEN 'repeated_words' THEN n_words
      WHEN 'upper_case' THEN word_chars ELSE n_words END AS b
  FROM f CROSS JOIN rules
), k AS (
  SELECT stratum, rule, j, cut, count(*) AS n, count(*) FILTER (WHERE 1000 * a > cut * b) AS k
  FROM m JOIN good USING (doc_id) JOIN cuts USING (rule) GROUP BY ALL
), p AS (
  SELECT stratum, rule, j, cut, CASE WHEN k >= n * (0.02 / 5) THEN 1.0 ELSE
    list_sum([exp(lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1) + x * ln(0.02 / 5) + (n - x) * ln(1 - 0.02 / 5)) for x in range(k + 1)]) END AS p
  FROM k
), lev AS (SELECT 0.05 / (5 * count(DISTINCT stratum)) AS level FROM k),
ff AS (SELECT stratum, rule, min(j) FILTER (WHERE p > level) AS first_fail, max(j) AS last FROM p, lev GROUP BY stratum, rule),
chosen AS (SELECT p.stratum, p.rule, p.cut FROM p JOIN ff USING (stratum, rule) WHERE p.j = coalesce(first_fail - 1, last)),
fails AS (
  SELECT f.*, [x.rule for x in [
    {{'rule': 'symbols', 'bad': (SELECT any_value(cut) FROM chosen c WHERE c.stratum = f.stratum AND c.rule = 'symbols') * word_chars < 1000 * n_symbols}},
    {{'rule': 'duplicate_lines', 'bad': (SELECT any_value(cut) FROM chosen c WHERE c.stratum = f.stratum AND c.rule = 'duplicate_lines') * n_lines < 1000 * n_dup_lines}},
    {{'rule': 'repeated_words', 'bad': (SELECT any_value(cut) FROM chosen c WHERE c.stratum = f.stratum AND c.rule = 'repeated_words') * n_words < 1000 * n_repeat_words}},
    {{'rule': 'upper_case', 'bad': (SELECT any_value(cut) FROM chosen c WHERE c.stratum = f.stratum AND c.rule = 'upper_case') * word_chars < 1000 * n_upper}},
    {{'rule': 'long_words', 'bad': (SELECT any_value(cut) FROM chosen c WHERE c.stratum = f.stratum AND c.rule = 'long_words') * n_words < 1000 * word_chars}}
  ] if x.bad] AS failed_rules
  FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND len(failed_rules) = 0 AS kept, failed_rules
FROM fails
"""

SQL["op10_simhash_windows"] = r"""
WITH d AS (
  SELECT DISTINCT doc_id, text FROM documents
), d1 AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM d
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM benchmark
), ds AS (
  SELECT rid, i - 1 AS pos, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d1)
), bs AS (
  SELECT item_id, len(w) AS size, i - 1 AS pos, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM b)
), win AS (
  SELECT DISTINCT ds.rid, greatest(0, least(ds.pos - bs.pos, len(d1.w) - bs.size)) AS start, bs.size
  FROM ds JOIN (SELECT DISTINCT size, pos, s FROM bs) bs USING (s) JOIN d1 USING (rid)
), ws AS (
  SELECT win.rid, win.start, win.size, ds.s, count(*) AS c
  FROM win JOIN ds ON ds.rid = win.rid AND ds.pos BETWEEN win.start AND win.start + win.size - 5 GROUP BY ALL
), wn AS (SELECT rid, start, size, sum(c) AS n FROM ws GROUP BY ALL),
ic AS (SELECT item_id, size, s, count(*) AS c FROM bs GROUP BY ALL),
inn AS (SELECT item_id, size, sum(c) AS n FROM ic GROUP BY ALL),
x AS (
  SELECT ws.rid, ws.start, ws.size, ic.item_id, sum(least(ws.c, ic.c)) AS both
  FROM ws JOIN ic ON ws.s = ic.s AND ws.size = ic.size GROUP BY ALL
), sim AS (
  SELECT x.rid, x.start, x.size, x.item_id, x.both::DOUBLE / (wn.n + inn.n - x.both)::DOUBLE AS similarity
  FROM x JOIN wn USING (rid, start, size) JOIN inn ON inn.item_id = x.item_id
), top AS (
  SELECT *, row_number() OVER (PARTITION BY rid, item_id ORDER BY similarity DESC, start) AS r FROM sim WHERE similarity >= 0.8
)
SELECT d1.doc_id, top.item_id, top.start::BIGINT AS start, least(top.size, len(d1.w) - top.start)::BIGINT AS n_words, similarity
FROM top JOIN d1 USING (rid) WHERE r = 1
"""

SQL["op12_slot_pivot_manifest"] = r"""
WITH RECURSIVE f AS (
  SELECT doc_id, source,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head,
    text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    coalesce((4294967295 - list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda r, z: xor(r >> 1, CASE WHEN (r & 1) = 1 THEN 3988292384 ELSE 0 END)))) % 5 = 0, false) AS hit
  FROM documents
), l AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || CASE WHEN hit THEN coalesce(strlen(low) || ':' || low, '-') ELSE coalesce(strlen(text) || ':' || text, '-') END) AS seen
  FROM f
), p AS (
  SELECT *, row_number() OVER w - 1 AS pos, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS id
  FROM l WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf)
), n AS (
  SELECT tree, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM p
  UNION ALL
  SELECT tree, level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), ((any_value(n) + 15) // 16)::BIGINT
  FROM n WHERE n > 1 GROUP BY tree, level, pos // 16
), r AS (SELECT tree, digest AS subroot FROM n WHERE n = 1),
t AS (
  SELECT 0 AS level, tree AS pos, subroot AS digest, count(*) OVER () AS n FROM r
  UNION ALL
  SELECT level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), ((any_value(n) + 15) // 16)::BIGINT
  FROM t WHERE n > 1 GROUP BY level, pos // 16
), runs AS (
  SELECT tree, level, pos // 16 AS up, list(digest ORDER BY pos) AS ds FROM n WHERE n > 1 GROUP BY tree, level, pos // 16
), top_runs AS (
  SELECT level, pos // 16 AS up, list(digest ORDER BY pos) AS ds FROM t WHERE n > 1 GROUP BY level, pos // 16
), steps AS (
  SELECT tree, max(level) + 1 AS height FROM n GROUP BY tree
), way AS (
  SELECT id, level AS step, ds, ((pos // (16 ** level)::BIGINT) % 16)::BIGINT AS slot
  FROM p JOIN runs ON runs.tree = p.tree AND up = pos // (16 ** (level + 1))::BIGINT
  UNION ALL
  SELECT id, level + height AS step, ds, ((p.tree // (16 ** level)::BIGINT) % 16)::BIGINT AS slot
  FROM p JOIN steps USING (tree) JOIN top_runs ON up = p.tree // (16 ** (level + 1))::BIGINT
), sides AS (
  SELECT id, step, array_to_string(ds[1:slot], '') AS l, array_to_string(ds[slot + 2:], '') AS r,
    row_number() OVER (PARTITION BY id ORDER BY step) AS k
  FROM way
), fold AS (
  SELECT id, 0 AS k, seen AS h FROM p
  UNION ALL
  SELECT fold.id, fold.k + 1, sha256(l || h || r) FROM fold JOIN sides ON sides.id = fold.id AND sides.k = fold.k + 1
), folded AS (SELECT id, arg_max(h, k) AS folded_root FROM fold GROUP BY id),
proof AS (SELECT id, sha256(coalesce(string_agg(l || r, '' ORDER BY step), '')) AS proof_sha256 FROM p LEFT JOIN sides USING (id) GROUP BY id)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM p JOIN r USING (tree) JOIN proof USING (id) JOIN folded USING (id), (SELECT digest AS root FROM t WHERE n = 1)
"""
