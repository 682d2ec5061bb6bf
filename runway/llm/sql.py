"""DuckDB statements for the corpus queries that SQL can express."""

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP6 = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
windows AS (
  SELECT doc_id, i, list_slice(words, i, i + 7) AS win
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 7)) AS i FROM t)),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(generate_series(i, i + 7)) AS p FROM repeated) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (
  SELECT t.doc_id, text, words, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM t LEFT JOIN covered USING (doc_id) LEFT JOIN dup USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words
            OR 100 * n_symbols > 10 * word_chars
            OR word_chars < 2 * n_words OR word_chars > 12 * n_words
            OR (n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * len(string_split(text, chr(10))))
            OR 2 * length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')) > word_chars
            OR 100 * len(list_filter(words, lambda w: regexp_matches(w, '\p{{L}}'))) < 60 * n_words
            OR 100 * len(list_distinct(words)) < 8 * n_words) AS kept
FROM base
"""

OP7 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS content
  FROM conversations),
participants AS (SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system'),
views AS (
  SELECT t.conv_id, perspective, speaker, content,
         '<|im_start|>' || CASE WHEN speaker = 'system' THEN speaker WHEN speaker = perspective THEN 'assistant'
           ELSE 'user name=' || array_to_string(list_transform(string_split(replace(speaker, '<|', chr(1)), ''), lambda c:
             CASE WHEN c = chr(1) THEN '%3C|' WHEN c IN ('%', ' ', chr(9), chr(10), chr(11), chr(12), chr(13))
                  THEN '%' || lpad(to_hex(ord(c)), 2, '0') ELSE c END), '') END || chr(10) AS header,
         row_number() OVER w - 1 AS pos
  FROM turns t JOIN participants p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
  WINDOW w AS (PARTITION BY t.conv_id, perspective ORDER BY turn NULLS FIRST, speaker, content)),
segments AS (
  SELECT *, header || content || '<|im_end|>' || chr(10) AS seg FROM views),
placed AS (
  SELECT *, coalesce(sum(length(seg)) OVER (PARTITION BY conv_id, perspective ORDER BY pos
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM segments)
SELECT conv_id, perspective, (pos // 128)::INTEGER AS chunk, count(*)::BIGINT AS n_turns, min(start)::BIGINT AS start,
       string_agg(seg, '' ORDER BY pos) AS text,
       coalesce(string_agg(CASE WHEN speaker = perspective
         THEN (start + length(header))::VARCHAR || '-' || (start + length(seg))::VARCHAR END, ',' ORDER BY pos), '') AS masks
FROM placed GROUP BY conv_id, perspective, pos // 128
"""

OP2 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
lowest AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN lowest USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

_SITE = r"regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '')"
_LAST = r"(?:co\.uk|org\.uk|ac\.uk|com\.au|com\.br|co\.jp|co\.nz|co\.in|[^.]+)"
_HOST = "translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _spread(children: str, parent: str) -> str:
    """Prior strength of a level from the variance between and within its children."""
    return f"""(
  SELECT CASE WHEN g IS NULL OR g <= p OR n <= g OR total <= 0 THEN 10.0
              ELSE 1 / least(greatest((b - w) / total, 1e-4), 0.9) - 1 END
  FROM (SELECT *, b + ((n - n2) / (g - p) - 1) * w AS total
    FROM (SELECT g, p, n, n2, ssb / nullif(g - p, 0) AS b, ssw / nullif(n - g, 0) AS w
      FROM (SELECT count(*) AS g, count(DISTINCT c.{parent}) AS p, sum(c.n) AS n, sum(c.n::DOUBLE * c.n / q.n) AS n2,
                   sum(c.n * pow(c.k / c.n - q.k / q.n, 2)) AS ssb, sum(c.k * (c.n - c.k) / c.n) AS ssw
            FROM {children} c JOIN (SELECT {parent}, sum(n) AS n, sum(k) AS k FROM {children} GROUP BY ALL) q
              ON c.{parent} = q.{parent} WHERE c.n > 0))))"""


def _mass(start: str, end: str) -> str:
    step = f"(({end}) - ({start})) / 100"
    t = f"(({start}) + (i + 0.5) * {step})"
    return f"""CASE WHEN ({end}) > ({start}) THEN {step} * list_sum(list_transform(range(0, 100), lambda i:
      exp((2 * a - 1) * ln(sin({t})) + (2 * b - 1) * ln(cos({t})) - peak))) ELSE 0 END"""


OP13 = rf"""
WITH p AS (
  SELECT page_id, {_HOST} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)),
cut AS (
  SELECT *, {_SITE} AS site, try_cast(regexp_extract(path, '/([0-9]+)(?:/|\.[A-Za-z]+)?$', 1) AS BIGINT) AS doc FROM p),
placed AS (
  SELECT *, CASE WHEN regexp_matches(site, '^[0-9.]+$') THEN site
                 ELSE regexp_extract(site, '(?:^|\.)((?:[^.]+\.)?{_LAST})$', 1) END AS domain,
         CASE WHEN regexp_matches(site, '^[0-9.]+$') THEN site
              ELSE regexp_extract(site, '(?:^|\.)({_LAST})$', 1) END AS suffix FROM cut),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
sites AS (
  SELECT site, domain, suffix, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS k
  FROM placed LEFT JOIN marks ON doc = doc_id GROUP BY ALL),
domains AS (SELECT domain, suffix, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM sites GROUP BY ALL),
ends AS (SELECT suffix, 0 AS everything, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM domains GROUP BY ALL),
strengths AS (SELECT {_spread('sites', 'domain')} AS ms, {_spread('domains', 'suffix')} AS md, {_spread('ends', 'everything')} AS me,
                     (SELECT (sum(k) + 0.125) / (sum(n) + 1) FROM ends) AS base),
prior AS (
  SELECT site, s.n, s.k, ms, (md * (me * base + e.k) / (me + e.n) + d.k) / (md + d.n) AS m
  FROM sites s JOIN domains d USING (domain) JOIN ends e ON e.suffix = d.suffix CROSS JOIN strengths),
beta AS (SELECT site, n, k, ms * m + k AS a, ms * (1 - m) + n - k AS b FROM prior),
shape AS (
  SELECT *, asin(sqrt(a / (a + b))) AS mid, 5 / sqrt(a + b) AS wide,
         atan2(sqrt(greatest(2 * a - 1, 0.01)), sqrt(greatest(2 * b - 1, 0.01))) AS top FROM beta),
edges AS (
  SELECT *, greatest(0, mid - wide) AS lo, least(pi() / 2, mid + wide) AS hi,
         (2 * a - 1) * ln(sin(top)) + (2 * b - 1) * ln(cos(top)) AS peak FROM shape),
split AS (SELECT *, least(greatest(asin(sqrt(0.25)), lo), hi) AS edge FROM edges),
masses AS (SELECT site, n, k, {_mass('edge', 'hi')} AS above, {_mass('lo', 'edge')} AS below FROM split),
known AS (SELECT site, n, k, above / (above + below) AS bound FROM masses)
SELECT page_id, host, path,
       CASE WHEN host = 'www.example.com' OR host LIKE '%.www.example.com' THEN
              CASE WHEN path LIKE '/en/%' THEN 'www.example.com/en/' WHEN path LIKE '/%' THEN 'com/' END
            WHEN host = 'example.com' OR host LIKE '%.example.com' THEN
              CASE WHEN path LIKE '/en/%' THEN 'example.com/en/' WHEN path LIKE '/%' THEN 'com/' END
            WHEN host = 'com' OR host LIKE '%.com' THEN CASE WHEN path LIKE '/%' THEN 'com/' END
            WHEN host = 'net' OR host LIKE '%.net' THEN
              CASE WHEN path LIKE '/es/%' THEN 'net/es/' WHEN path LIKE '/fr/%' THEN 'net/fr/' END END AS rule,
       CASE rule WHEN 'com/' THEN 'allow' WHEN 'example.com/en/' THEN 'block' WHEN 'www.example.com/en/' THEN 'allow'
                 WHEN 'net/es/' THEN 'block' WHEN 'net/fr/' THEN 'block'
                 ELSE CASE WHEN bound >= 0.95 THEN 'block' ELSE 'allow' END END AS verdict,
       n AS n_labelled, k AS n_bad
FROM placed JOIN known USING (site)
"""
