"""DuckDB SQL that must give the same rows."""

from __future__ import annotations

from tidemark.llm.line_dedup import DENOMINATOR, NUMERATOR
from tidemark.llm.pii import GENERALISE, KINDS, REMOVE, SUPPORT
from tidemark.llm.resample import BUCKETS, LEAST_WORDS, PERCENT, SCALE, SEED
from tidemark.llm.url_filter import DAMPING, LEAST, RULES, THRESHOLD

SHARDS = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, text, coalesce(octet_length(encode(text)), 0) + 1 AS size, coalesce(sha256(text), '') AS key
  FROM documents),
e AS (
  SELECT key, size, sum(size) OVER (ORDER BY key)::BIGINT AS stop
  FROM (SELECT key, sum(size)::BIGINT AS size FROM d GROUP BY key)),
t AS (SELECT max(stop) AS total, max(size) AS largest FROM e),
search AS (
  SELECT greatest(largest, (total + 7) // 8) AS low, (total + 7) // 8 + largest AS high,
    (greatest(largest, (total + 7) // 8) + (total + 7) // 8 + largest) // 2 AS mid, 0 AS k, 0::BIGINT AS pos, total
  FROM t
  UNION ALL
  SELECT
    CASE WHEN over AND pos < total THEN mid + 1 ELSE low END,
    CASE WHEN over AND pos >= total THEN mid ELSE high END,
    CASE WHEN NOT over THEN mid WHEN pos >= total THEN (low + mid) // 2 ELSE (mid + 1 + high) // 2 END,
    CASE WHEN over THEN 0 ELSE k + 1 END,
    CASE WHEN over THEN 0 ELSE reach END,
    total
  FROM (
    SELECT low, high, mid, k, pos, total, (k = 8 OR pos >= total) AS over, greatest(pos, coalesce(found, 0)) AS reach
    FROM (
      SELECT low, high, mid, k, pos, total, max(stop) FILTER (stop <= pos + mid) AS found
      FROM search, e WHERE low < high GROUP BY low, high, mid, k, pos, total))),
best AS (SELECT min(high) AS capacity, any_value(total) AS total FROM search),
fill AS (
  SELECT 0 AS k, 0::BIGINT AS pos, capacity, total FROM best
  UNION ALL
  SELECT f.k + 1, max(e.stop) FILTER (e.stop <= f.pos + f.capacity), f.capacity, f.total
  FROM fill f, e WHERE f.k < 8 AND f.pos < f.total GROUP BY f.k, f.pos, f.capacity, f.total),
placed AS (
  SELECT d.*, (SELECT count(*) FROM fill f WHERE f.k > 0 AND f.pos < e.stop)::INTEGER AS shard
  FROM d JOIN e USING (key)),
bits(i, v, n) AS (
  SELECT range::BIGINT, range::BIGINT, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, n + 1 FROM bits WHERE n < 8),
crc AS (SELECT list(v ORDER BY i) AS words FROM bits WHERE n = 8)
SELECT doc_id, size::BIGINT AS size,
  CASE WHEN coalesce(text, '') = '' THEN 0 ELSE xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(text))),
      lambda n: ('0x' || substr(hex(encode(text)), 2 * n + 1, 2))::BIGINT)),
    lambda x, y: xor(crc.words[(xor(x, y) & 255) + 1], x >> 8))) END::BIGINT AS text_crc32,
  'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY key, doc_id) - 1 AS slot,
  NULL::INTEGER AS grown_shard
FROM placed, crc
"""

LINES = rf"""
WITH docs AS (
  SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
spread AS (
  SELECT doc_id, unnest(range(len(lines))) AS line, unnest(lines) AS string FROM docs WHERE lines IS NOT NULL),
sets AS (
  SELECT doc_id, line,
    list_sort(list_distinct(list_filter(regexp_split_to_array(lower(string), '[\x20\x09-\x0D]+'), lambda w: w <> ''))) AS words
  FROM spread),
firsts AS (
  SELECT words, min(row(doc_id, line)) AS first, len(words) AS n FROM sets WHERE len(words) > 0 GROUP BY words),
named AS (SELECT row_number() OVER (ORDER BY first) AS id, * FROM firsts),
tokens AS (SELECT id, n, unnest(words) AS word FROM named),
rarity AS (SELECT word, count(*) AS df FROM tokens GROUP BY word),
placed AS (
  SELECT id, n, word, row_number() OVER (PARTITION BY id ORDER BY df, word) AS place FROM tokens JOIN rarity USING (word)),
prefix AS (SELECT * FROM placed WHERE place <= n - ({NUMERATOR} * n + {DENOMINATOR} - 1) // {DENOMINATOR} + 1),
pairs AS (
  SELECT DISTINCT b.id AS id, a.id AS other FROM prefix a JOIN prefix b ON a.word = b.word AND a.id < b.id
  WHERE {DENOMINATOR} * a.n >= {NUMERATOR} * b.n AND {DENOMINATOR} * b.n >= {NUMERATOR} * a.n),
common AS (
  SELECT p.id, len(list_intersect(a.words, b.words)) AS c, a.n + b.n AS n
  FROM pairs p JOIN named a ON a.id = p.other JOIN named b ON b.id = p.id),
gone AS (SELECT DISTINCT id FROM common WHERE {DENOMINATOR} * c >= {NUMERATOR} * (n - c)),
removed AS (
  SELECT s.doc_id, list_sort(list(DISTINCT s.line)) AS gone
  FROM sets s JOIN named ON named.words = s.words LEFT JOIN gone USING (id)
  WHERE gone.id IS NOT NULL OR row(s.doc_id, s.line) <> first
  GROUP BY s.doc_id)
SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed,
  coalesce(array_to_string(gone, ','), '') AS removed
FROM docs LEFT JOIN removed USING (doc_id)
"""

_BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    "ip": (
        r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        "len(list_filter(string_split(v, '.'), lambda x: len(ltrim(x, '0')) > 3 OR coalesce(try_cast(x AS HUGEINT), 256) > 255)) = 0",
    ),
    "card": (
        r"[0-9](?:[\x20-]?[0-9])+",
        "len(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(range(len(digits)), lambda i: "
        "CASE WHEN i % 2 = 0 THEN substr(reverse(digits), i + 1, 1)::INTEGER "
        "WHEN substr(reverse(digits), i + 1, 1)::INTEGER > 4 THEN 2 * substr(reverse(digits), i + 1, 1)::INTEGER - 9 "
        "ELSE 2 * substr(reverse(digits), i + 1, 1)::INTEGER END)) % 10 = 0",
    ),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "len(digits) BETWEEN 10 AND 15"),
}


def _places(pattern: str, valid: str = "true") -> str:
    """Matches of a pattern in whole texts with their code points, where v or its digits are valid."""
    return f"""
  SELECT doc_id, text_key, start, start + length(v) AS stop, v
  FROM (
    SELECT *, regexp_replace(v, '[^0-9]', '', 'g') AS digits,
      (sum(length(gap)) OVER w + coalesce(sum(length(v)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start
    FROM (
      SELECT doc_id, text_key, unnest(range(len(regexp_split_to_array(text, '{pattern}')))) AS i,
        unnest(regexp_split_to_array(text, '{pattern}')) AS gap, unnest(regexp_extract_all(text, '{pattern}')) AS v
      FROM d)
    WINDOW w AS (PARTITION BY doc_id, text_key ORDER BY i))
  WHERE v IS NOT NULL AND {valid}"""


def _kind(name: str) -> str:
    return f"SELECT *, {KINDS.index(name)} AS ord, '{name}' AS kind FROM ({_places(*_BASE[name])})"


_TERM = r"\p{L}[\p{L}\p{N}]*"


PERSONAL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) AS text_key, count(*) AS rows FROM documents GROUP BY ALL),
base AS ({' UNION ALL '.join(map(_kind, KINDS))}),
m AS (
  SELECT DISTINCT doc_id, text_key, rows, kind || ':' ||
    CASE kind WHEN 'email' THEN lower(v) WHEN 'ip' THEN v ELSE regexp_replace(v, '[^0-9]', '', 'g') END AS entity
  FROM base JOIN d USING (doc_id, text_key)),
t AS (
  SELECT doc_id, text_key, rows, unnest(list_distinct(list_transform(regexp_extract_all(text, '{_TERM}'), lambda x: lower(x)))) AS term
  FROM d),
n_e AS (SELECT entity, sum(rows) AS n_e FROM m GROUP BY entity HAVING count(*) >= {SUPPORT}),
n_t AS (SELECT term, sum(rows) AS n_t FROM t GROUP BY term),
n_et AS (
  SELECT entity, term, sum(m.rows) AS n_et FROM m JOIN n_e USING (entity) JOIN t USING (doc_id, text_key)
  GROUP BY entity, term HAVING count(*) >= {SUPPORT}),
n AS (SELECT count(*)::DOUBLE AS n FROM documents),
shares AS (
  SELECT entity, term, log2(n * n_et / (n_e * n_t)) / log2(n / n_e) AS share
  FROM n_et JOIN n_e USING (entity) JOIN n_t USING (term), n WHERE n_e < n),
found AS (
  SELECT doc_id, text_key, term, max(share) AS share
  FROM m JOIN shares USING (entity) JOIN t USING (doc_id, text_key, term) WHERE share >= {GENERALISE} GROUP BY ALL),
added AS (
  SELECT p.doc_id, p.text_key, {len(KINDS)} AS ord, CASE WHEN share >= {REMOVE} THEN 'removed' ELSE 'generalised' END AS kind, start, stop
  FROM ({_places(_TERM)}) p JOIN found f ON p.doc_id = f.doc_id AND p.text_key = f.text_key AND lower(v) = term
  WHERE NOT EXISTS (
    SELECT 1 FROM base b WHERE b.doc_id = p.doc_id AND b.text_key = p.text_key AND b.start < p.stop AND p.start < b.stop)),
marks AS (SELECT doc_id, text_key, ord, kind, start, stop FROM base UNION ALL SELECT doc_id, text_key, ord, kind, start, stop FROM added),
listed AS (
  SELECT doc_id, text_key,
    {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in KINDS)},
    coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (ord < {len(KINDS)}), '') AS own,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS spans
  FROM marks GROUP BY ALL)
SELECT o.doc_id, {', '.join(f"coalesce(n_{k}, 0) AS n_{k}" for k in KINDS)}, sha256(coalesce(own, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM documents o LEFT JOIN listed l ON o.doc_id = l.doc_id AND md5(coalesce(o.text, '')) = l.text_key
"""

NEAR = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 1),
      lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]))) END AS shingles
  FROM w),
classes AS (SELECT shingles, min(doc_id) AS id, len(shingles) AS n FROM s WHERE len(shingles) > 0 GROUP BY shingles),
flat AS (SELECT id, n, unnest(shingles) AS shingle FROM classes),
common AS (
  SELECT a.id AS a, b.id AS b, any_value(a.n) + any_value(b.n) AS n, count(*) AS c
  FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.id < b.id GROUP BY a.id, b.id),
links AS (SELECT a, b FROM common WHERE 100 * c >= 85 * (n - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, far) AS (
  SELECT id, id FROM classes
  UNION
  SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON reach.far = both_ways.a),
roots AS (SELECT id, min(far) AS root FROM reach GROUP BY id)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, coalesce(root, s.doc_id) AS component_id,
  s.doc_id = coalesce(root, s.doc_id) AS kept
FROM s LEFT JOIN classes c ON s.shingles = c.shingles LEFT JOIN roots USING (id)
"""

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS n
  FROM pages),
w AS (SELECT payload, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY payload)
SELECT p.page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(p.payload) AS payload_digest,
  CASE WHEN top IS NULL OR p.page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id <> top THEN top END AS refers_to,
  true AS intact
FROM p LEFT JOIN w ON n >= 1000 AND p.payload = w.payload
"""

_FITS = " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}'"
    for r in sorted(RULES, key=lambda r: (-len(r.name), r.name))
)
_BLOCKS = ", ".join(f"'{r.name}'" for r in RULES if r.verdict == "block")
_LINK = r"(?i)(?:href|src|action)\s*=\s*[\x22\x27]?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\x22\x27\s>]+)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _spread(seed: str, source: str, target: str) -> str:
    """Scores of each round, and what the round has added, until all hosts together gain next to nothing."""
    return f"""
  SELECT 0 AS n, host, {1 - DAMPING} * {seed} AS score, {1 - DAMPING} * {seed} AS added FROM hosts
  UNION ALL
  SELECT any_value(r.n) + 1, r.host, any_value(r.score) + {DAMPING} * coalesce(sum(e.part * s.added), 0),
    {DAMPING} * coalesce(sum(e.part * s.added), 0)
  FROM (SELECT *, sum(added) OVER () AS moving FROM {seed}_r) r
  LEFT JOIN (SELECT {target} AS dst, {source} AS src, links / sum(links) OVER (PARTITION BY {source}) AS part FROM links) e
    ON e.dst = r.host
  LEFT JOIN {seed}_r s ON s.host = e.src
  WHERE r.moving > {LEAST}
  GROUP BY r.host"""


URLS = rf"""
WITH RECURSIVE p AS (
  SELECT page_id, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), {_LOWER}) AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
judged AS (SELECT *, CASE {_FITS} END AS rule FROM p),
links AS (
  SELECT host AS src, dst, count(*) AS links FROM (
    SELECT host, translate(unnest(regexp_extract_all(coalesce(html, ''), '{_LINK}', 1)), {_LOWER}) AS dst FROM p)
  WHERE host <> '' AND host <> dst GROUP BY ALL),
hosts AS (
  SELECT host, max(allowed) AS allowed, max(blocked) AS blocked FROM (
    SELECT host, avg((rule IS NOT NULL AND rule NOT IN ({_BLOCKS}))::INTEGER) AS allowed,
      avg((rule IS NOT NULL AND rule IN ({_BLOCKS}))::INTEGER) AS blocked
    FROM judged WHERE host <> '' GROUP BY host
    UNION ALL SELECT DISTINCT dst, 0, 0 FROM links)
  GROUP BY host),
allowed_r AS ({_spread('allowed', 'src', 'dst')}),
blocked_r AS ({_spread('blocked', 'dst', 'src')}),
verdicts AS (
  SELECT host, CASE WHEN b.score - a.score > {THRESHOLD * (1 - DAMPING)} THEN 'block' ELSE 'allow' END AS of_host
  FROM (SELECT host, arg_max(score, n) AS score FROM allowed_r GROUP BY host) a
  JOIN (SELECT host, arg_max(score, n) AS score FROM blocked_r GROUP BY host) b USING (host))
SELECT page_id, j.host, path, rule,
  CASE WHEN rule IN ({_BLOCKS}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow' ELSE coalesce(of_host, 'allow') END AS verdict
FROM judged j LEFT JOIN verdicts USING (host)
"""

CRC_TABLE = """bits(i, v, n) AS (
  SELECT range::BIGINT, range::BIGINT, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, n + 1 FROM bits WHERE n < 8),
crc AS (SELECT list(v ORDER BY i) AS words FROM bits WHERE n = 8)"""


def _crc32(text: str) -> str:
    """CRC-32 of a non-empty text, next to the table ``crc``."""
    return f"""xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode({text}))),
        lambda n: ('0x' || substr(hex(encode({text})), 2 * n + 1, 2))::BIGINT)),
      lambda x, y: xor(crc.words[(xor(x, y) & 255) + 1], x >> 8)))"""


RESAMPLE = rf"""
WITH RECURSIVE {CRC_TABLE},
texts AS (
  SELECT 's' AS side, row_number() OVER () AS id, doc_id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark),
split AS (
  SELECT side, id, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM texts),
runs AS (
  SELECT side, id, doc_id, len(w) AS n,
    list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM split),
found AS (SELECT side, id, unnest(f) AS feature FROM runs),
hashed AS (
  SELECT feature, ({_crc32("feature")} % {BUCKETS})::BIGINT AS bucket
  FROM (SELECT DISTINCT feature FROM found), crc),
counted AS (SELECT side, id, bucket, count(*)::BIGINT AS n FROM found JOIN hashed USING (feature) GROUP BY ALL),
sides AS (SELECT side, bucket, sum(n) AS n FROM counted GROUP BY ALL),
totals AS (
  SELECT coalesce(sum(n) FILTER (side = 's'), 0) AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t FROM sides),
gains AS (
  SELECT b.bucket, floor({SCALE} * ln(
    (coalesce(t.n, 0) + 1)::DOUBLE * (totals.s + {BUCKETS})::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * (totals.t + {BUCKETS})::DOUBLE)))::BIGINT AS gain
  FROM (SELECT range AS bucket FROM range({BUCKETS})) b
  LEFT JOIN sides s ON s.side = 's' AND s.bucket = b.bucket
  LEFT JOIN sides t ON t.side = 't' AND t.bucket = b.bucket, totals),
sums AS (SELECT id, sum(n * gain)::BIGINT AS total FROM counted JOIN gains USING (bucket) WHERE side = 's' GROUP BY id),
weighed AS (
  SELECT id, doc_id, n, len(f)::BIGINT AS n_features,
    CASE WHEN len(f) = 0 THEN 0 ELSE (total - ((total % len(f)) + len(f)) % len(f)) // len(f) END::BIGINT AS weight
  FROM runs LEFT JOIN sums USING (id) WHERE side = 's'),
scored AS (
  SELECT *, weight + floor(-{SCALE} * ln(-ln(
    (('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
    / 4294967296)))::BIGINT AS score
  FROM weighed),
ranked AS (
  SELECT id, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, id) AS place, count(*) OVER () AS able
  FROM scored WHERE n >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= {PERCENT} * able // 100 THEN place END::BIGINT AS rank
FROM scored LEFT JOIN ranked USING (id)
"""

# States: 0 nothing yet, 1 after a system row, 2 after a user row, 3 after an assistant row.
# ``insert`` lists what insertions alone do, ``edit`` what one row may become.
REPAIR = rf"""
WITH RECURSIVE {CRC_TABLE},
planted AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM planted),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM damaged),
facts AS (
  SELECT *, left(role, 1) AS initial,
    bare = '' AS blank, bare <> '' AND again AS duplicate,
    bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated,
    lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS following
  FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
    count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal,
    max(pos) AS last
  FROM facts GROUP BY conv_id),
insertion(a, b, k) AS (VALUES (0, 0, 0), (0, 2, 1), (0, 3, 2), (1, 1, 0), (1, 2, 1), (1, 3, 2), (2, 2, 0), (2, 3, 1),
  (3, 3, 0), (3, 2, 1)),
edit(a, b, kept, cost, kind) AS (VALUES
  (0, 0, '', 3, 'D'), (1, 1, '', 3, 'D'), (2, 2, '', 3, 'D'), (3, 3, '', 3, 'D'),
  (0, 1, 's', 0, 'K'), (0, 2, 'u', 0, 'K'), (1, 2, 'u', 0, 'K'), (3, 2, 'u', 0, 'K'), (2, 3, 'a', 0, 'K'),
  (0, 2, '', 2, 'R'), (1, 2, '', 2, 'R'), (3, 2, '', 2, 'R'), (2, 3, '', 2, 'R')),
step AS (
  SELECT i.a, e.b, e.kept, 2 * i.k + e.cost AS cost, repeat('I', i.k) || e.kind AS audit, e.kind,
    CASE WHEN i.k = 0 THEN [] WHEN i.b = 3 AND i.k = 2 THEN ['user:', 'assistant:']
      WHEN i.b = 3 THEN ['assistant:'] ELSE ['user:'] END AS added,
    CASE e.b WHEN 2 THEN 'user' WHEN 3 THEN 'assistant' END AS name
  FROM insertion i JOIN edit e ON e.a = i.b),
walk AS (
  SELECT conv_id, 0::BIGINT AS pos, 0 AS state, {{'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}} AS best
  FROM counted
  UNION ALL
  SELECT w.conv_id, w.pos + 1, s.b, min({{
    'cost': w.best.cost + s.cost + CASE WHEN s.kind <> 'D' AND f.truncated THEN 1 ELSE 0 END,
    'audit': w.best.audit || s.audit,
    'lines': list_concat(w.best.lines, s.added, CASE s.kind WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text]
      ELSE [s.name || ':' || f.text] END)}})
  FROM walk w
  JOIN facts f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.pos + 1
  JOIN step s ON s.a = w.state AND (s.kind = 'D' OR NOT (f.blank OR f.duplicate))
    AND (s.kind <> 'K' OR s.kept = f.initial)
  GROUP BY w.conv_id, w.pos, s.b),
ended AS (
  SELECT w.conv_id, min({{'cost': w.best.cost + 2 * i.k, 'audit': w.best.audit || repeat('I', i.k),
    'lines': list_concat(w.best.lines, CASE WHEN i.k = 2 THEN ['user:', 'assistant:']
      WHEN i.k = 1 THEN ['assistant:'] ELSE [] END)}}) AS best
  FROM walk w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.last = w.pos
  JOIN (VALUES (0, 0), (1, 2), (2, 1), (3, 0)) i(state, k) ON i.state = w.state
  GROUP BY w.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""

SQL: dict[str, str] = {
    "op3_shard_documents": SHARDS,
    "op4_line_dedup": LINES,
    "op6_personal_data": PERSONAL,
    "op7_near_duplicates": NEAR,
    "op9_warc": WARC,
    "op10_url_verdicts": URLS,
    "op11_repair_conversations": REPAIR,
    "op13_resample": RESAMPLE,
}
