"""DuckDB SQL of the queries that SQL can express over whole tables.

The others have none: op3 walks an automaton over a vocabulary file, op7 writes files, op10 trains and fits. Tests hold those
against brute-force versions.
"""

from __future__ import annotations

from inuring.llm.licenses import LEAST_SHARE, PHRASES, SLACK, TEMPLATES
from inuring.llm.secrets import BASE_RULES, RULES

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWERED = f"translate(COALESCE(text, ''), '{UPPER}', '{UPPER.lower()}')"


def _crc_table() -> list[int]:
    """The byte table of crc32, from its polynomial."""
    out = []
    for b in range(256):
        for _ in range(8):
            b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
        out.append(b)
    return out


def _crc32(text: str) -> str:
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda c, b: xor(c >> 8, ({_crc_table()}::BIGINT[])[(xor(c, b) & 255) + 1])))"""


CRC32 = _crc32("COALESCE(text, '')")

OP1 = f"""WITH r AS (SELECT doc_id, source, CAST(octet_length(encode(COALESCE(text, ''))) + 8 AS BIGINT) AS size, {CRC32} AS text_crc32, md5('17:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS shuffle FROM documents),
    c AS (SELECT source, total, ROW_NUMBER() OVER (PARTITION BY total ORDER BY md5('17:' || COALESCE(source, '')), source NULLS FIRST) - 1 AS k, COUNT(*) OVER (PARTITION BY total) AS alike FROM (SELECT source, COUNT(*) AS total FROM r GROUP BY source)),
    h AS (SELECT source, total, (k + CAST(('0x' || substr(md5('17:' || total), 1, 8))::BIGINT AS DOUBLE) / 4294967296) / alike AS phase FROM c),
    f AS (SELECT r.*, (ROW_NUMBER() OVER (PARTITION BY r.source ORDER BY shuffle, doc_id NULLS FIRST, size, text_crc32) - 1 + phase) / total AS fraction, COUNT(*) OVER () AS n FROM r JOIN h ON h.source IS NOT DISTINCT FROM r.source),
    p AS (SELECT *, ROW_NUMBER() OVER (ORDER BY fraction, source NULLS FIRST, shuffle, doc_id NULLS FIRST, size, text_crc32) - 1 AS place FROM f)
    SELECT doc_id, source, size, text_crc32, 'rows' AS law, CAST(place * 24 // n AS INT) AS shard, CAST(place - (place * 24 // n * n + 23) // 24 AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard FROM p"""

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP2 = f"""WITH d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '{WORDS}') AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, w, LEAST(10, len(w)) AS n FROM (SELECT item_id, regexp_extract_all({LOWERED}, '{WORDS}') AS w FROM benchmark) WHERE len(w) > 0),
    k AS (SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
    dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM k) WHERE len(w) >= n)),
    m AS (SELECT doc_id, dw.n, i, item FROM dw JOIN k ON k.n = dw.n AND k.g = dw.g),
    h AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
    s AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items, sha256(COALESCE(items, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN s ON s.doc_id = d.doc_id"""

CONTEXT = 5
ADDRESS = f"""SELECT *, CASE WHEN strpos(u, '://') > 0 THEN translate(regexp_extract(substr(u, strpos(u, '://') + 3), '^[^/?#]*'), '{UPPER}', '{UPPER.lower()}') ELSE '' END AS host,
    CASE WHEN strpos(u, '://') > 0 THEN regexp_extract(regexp_replace(substr(u, strpos(u, '://') + 3), '^[^/?#]*', ''), '^[^?#]*') ELSE '' END AS path"""
RULED = """SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/' WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/' WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule"""


def _orders() -> str:
    """Tables g0, g1, ...: each gram's counts; p0, p1, ...: its probabilities, mixed with those of the shorter context."""
    out = []
    for k in range(CONTEXT - 1, -1, -1):
        out.append(f"g{k} AS MATERIALIZED (SELECT substr(gram, 2) AS gram, SUM(accepted) AS accepted, SUM(rejected) AS rejected FROM g{k + 1} GROUP BY 1)")
    out.append("p0 AS MATERIALIZED (SELECT gram, " + ", ".join(f"(({n} + 1) / (SUM({n}) OVER () + COUNT(*) OVER () + 1))::DOUBLE AS p_{n}" for n in ("accepted", "rejected")) + " FROM g0)")
    for k in range(1, CONTEXT + 1):
        blend = lambda n: f"CASE WHEN SUM(g.{n}) OVER w > 0 THEN (g.{n} + SUM(CASE WHEN g.{n} > 0 THEN 1 ELSE 0 END) OVER w * s.p_{n})::DOUBLE / (SUM(g.{n}) OVER w + SUM(CASE WHEN g.{n} > 0 THEN 1 ELSE 0 END) OVER w) ELSE s.p_{n} END AS p_{n}"  # noqa: B023, E731
        out.append(f"p{k} AS MATERIALIZED (SELECT g.gram, {blend('accepted')}, {blend('rejected')} FROM g{k} g JOIN p{k - 1} s ON s.gram = substr(g.gram, 2) WINDOW w AS (PARTITION BY substr(g.gram, 1, {k})))")
    return ",\n    ".join(out)


OP4 = rf"""WITH u AS (SELECT COALESCE(url, '') AS u, COUNT(*) AS weight FROM pages GROUP BY 1), r AS ({RULED} FROM ({ADDRESS} FROM u)),
    v AS (SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS given, ('0x' || substr(md5(u), 1, 8))::BIGINT % 5 = 0 AS held FROM r),
    s AS (SELECT *, repeat(chr(2), {CONTEXT}) || translate(u, '{UPPER}', '{UPPER.lower()}') || chr(3) AS t FROM v),
    g AS MATERIALIZED (SELECT u, weight, given, held, substr(t, i, {CONTEXT + 1}) AS gram FROM (SELECT *, unnest(range(1, length(t) - {CONTEXT} + 1)) AS i FROM s)),
    g{CONTEXT} AS MATERIALIZED (SELECT gram, CAST(SUM(CASE WHEN given = 'allow' AND NOT held THEN weight ELSE 0 END) AS DOUBLE) AS accepted, CAST(SUM(CASE WHEN given = 'block' AND NOT held THEN weight ELSE 0 END) AS DOUBLE) AS rejected FROM g GROUP BY gram),
    {_orders()},
    m AS (SELECT gram, CAST(round((ln(p_accepted) - ln(p_rejected)) * 1e6) AS BIGINT) AS ratio FROM p{CONTEXT}),
    sc AS (SELECT u, weight, given, held, CAST(SUM(ratio) AS BIGINT) / COUNT(*) AS score FROM g JOIN m ON m.gram = g.gram GROUP BY ALL),
    bins AS (SELECT CAST(floor(score / 10000) AS BIGINT) AS bin, SUM(CASE WHEN given = 'allow' THEN weight ELSE 0 END) AS good, SUM(CASE WHEN given = 'block' THEN weight ELSE 0 END) AS bad FROM sc WHERE held AND given IS NOT NULL GROUP BY 1),
    cuts AS (SELECT bin, COALESCE(LAG(bin) OVER (ORDER BY bin) + 1, bin) AS free, SUM(good) OVER () AS goods, SUM(bad) OVER () AS bads, COALESCE(SUM(good) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lost,
        COALESCE(SUM(bad) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caught FROM bins),
    th AS (SELECT COALESCE((SELECT (free + bin) * 10000 / 2 FROM cuts WHERE goods > 0 AND bads > 0 ORDER BY (goods - lost) * bads + caught * goods DESC, bin LIMIT 1), 0.0) AS least)
    SELECT p.page_id, v.host, v.path, v.rule, (sc.score - th.least) / 1e6 AS score, COALESCE(v.given, CASE WHEN (sc.score - th.least) / 1e6 >= 0 THEN 'allow' ELSE 'block' END) AS verdict
    FROM pages p JOIN v ON v.u = COALESCE(p.url, '') JOIN sc ON sc.u = v.u, th"""

BLACK = r"[^\x20\x09-\x0D]"
OP8 = rf"""WITH d AS (SELECT doc_id, COALESCE(text, '') AS t, regexp_extract_all(COALESCE(text, ''), '{BLACK}+') AS w FROM documents),
    g AS (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS times FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
    r AS (SELECT doc_id, COUNT(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE times >= 2) GROUP BY doc_id),
    m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{BLACK}')) AS lines, COALESCE(r.n, 0) AS n_repeat_words, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS n_letters
        FROM d LEFT JOIN r ON r.doc_id = d.doc_id),
    f AS (SELECT *, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > len(lines) OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 2 * n_upper > n_letters) AS kept FROM f"""

OP9 = rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '{BLACK}+') AS w FROM documents),
    s AS MATERIALIZED (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d)),
    n AS MATERIALIZED (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
    l AS MATERIALIZED (SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS c FROM s x JOIN s y ON y.g = x.g AND y.doc_id <> x.doc_id GROUP BY 1, 2) p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
    reach AS (SELECT a AS v, b AS w FROM l UNION SELECT r.v, l.b FROM reach r JOIN l ON l.a = r.w)
    SELECT d.doc_id, COALESCE(n.n, 0) AS n_shingles, LEAST(d.doc_id, COALESCE(MIN(reach.w), d.doc_id)) AS component_id, d.doc_id <= COALESCE(MIN(reach.w), d.doc_id) AS kept
    FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach ON reach.v = d.doc_id GROUP BY d.doc_id, n.n"""

def _spans(order: int, kind: str, pattern: str, least: int, group: int) -> str:
    """(doc_id, kind, ord, a, b) of the leftmost matches without overlap, in code points. Each match is put between two signs
    that no text has; what stands between two first signs is a match, its second sign and what follows."""
    length = f"length(regexp_extract(m, '{pattern}', {group}))"
    return rf"""SELECT doc_id, '{kind}' AS kind, {order} AS ord, a, a + length(m) AS b FROM (SELECT doc_id, i, split_part(p, chr(2), 1) AS m, SUM(length(p) - CASE WHEN i > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) - (length(p) - 1) AS a
        FROM (SELECT doc_id, unnest(parts) AS p, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, string_split(regexp_replace(COALESCE(text, ''), '({pattern})', chr(1) || '\1' || chr(2), 'g'), chr(1)) AS parts FROM documents))) WHERE i > 1 AND {length} >= {least}"""


OP5 = f"""WITH s AS ({" UNION ALL ".join(_spans(k, r.kind, r.pattern.decode().replace("'", "''"), r.least, r.group) for k, r in enumerate(RULES))}),
    j AS (SELECT doc_id, {", ".join(f"COUNT(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)}, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, ord) FILTER (ord < {len(BASE_RULES)}) AS base, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, ord) AS spans FROM s GROUP BY doc_id)
    SELECT d.doc_id, {", ".join(f"COALESCE(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)}, sha256(COALESCE(base, '')) AS base_sha256, COALESCE(spans, '') AS spans FROM documents d LEFT JOIN j ON j.doc_id = d.doc_id"""

_list = lambda text: "[" + ", ".join(f"'{w}'" for w in text.split()) + "]"
OP6 = f"""WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({LOWERED}, '{WORDS}') AS ws FROM documents),
    phrases(label, k) AS (VALUES {", ".join(f"('{label}', {_list(phrase)})" for phrase, label in PHRASES)}),
    templates(t, label, words) AS (VALUES {", ".join(f"({i}, '{x.label}', {_list(x.text)})" for i, x in enumerate(TEMPLATES))}),
    keys(t, k) AS (VALUES {", ".join(f"({i}, {_list(key)})" for i, x in enumerate(TEMPLATES) for key in x.key_phrases)}),
    found AS (SELECT doc_id, label, unnest(list_filter(range(len(ws)), lambda q: ws[q + 1 : q + len(k)] = k)) AS q FROM d, phrases),
    base AS (SELECT doc_id, COUNT(*) AS n_base, MIN(q) AS first_word, MAX(q) AS last_word FROM found GROUP BY doc_id),
    standing AS MATERIALIZED (SELECT w.doc_id, x.t, w.p - x.j AS a, COUNT(*) AS n FROM (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS p FROM d) w JOIN (SELECT t, unnest(words) AS w, unnest(range(len(words))) AS j FROM templates) x ON x.w = w.w GROUP BY ALL HAVING COUNT(*) >= 2),
    shares AS (SELECT s.doc_id, MAX(n / len(words)) AS share FROM standing s JOIN templates x ON x.t = s.t GROUP BY s.doc_id),
    good AS (SELECT s.doc_id, s.t, s.a, x.label, len(x.words) AS n, CAST(floor({SLACK} * len(x.words)) AS BIGINT) AS slack FROM standing s JOIN templates x ON x.t = s.t WHERE s.n / len(x.words) >= {LEAST_SHARE}),
    verified AS (SELECT g.doc_id, g.label FROM good g JOIN d ON d.doc_id = g.doc_id JOIN keys k ON k.t = g.t
        GROUP BY g.doc_id, g.t, g.a, g.label HAVING bool_and(len(list_filter(range(GREATEST(0, a - slack), LEAST(len(ws), a + n + slack - len(k) + 1)), lambda q: ws[q + 1 : q + len(k)] = k)) > 0)),
    labels AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) FILTER (is_base) AS base_labels, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label, bool_or(is_base) AS is_base FROM (SELECT doc_id, label, TRUE AS is_base FROM found UNION ALL SELECT doc_id, label, FALSE FROM verified) GROUP BY ALL) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, COALESCE(n_base, 0) AS n_base, first_word, last_word, COALESCE(base_labels, '') AS base_labels, COALESCE(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE COALESCE(share, 0.0)::DOUBLE END AS score
    FROM d LEFT JOIN base ON base.doc_id = d.doc_id LEFT JOIN labels ON labels.doc_id = d.doc_id LEFT JOIN shares ON shares.doc_id = d.doc_id"""

# every string of 400 bytes, two hexadecimal digits a byte
OP11 = """WITH d AS (SELECT ROW_NUMBER() OVER () AS row, doc_id, hex(encode(COALESCE(text, ''))) AS x FROM documents),
    g AS MATERIALIZED (SELECT row, unnest(range(length(x) // 2 - 399)) AS i, unnest(list_transform(range(length(x) // 2 - 399), lambda i: md5(substr(x, 2 * i + 1, 800)))) AS g FROM d WHERE length(x) >= 800),
    r AS (SELECT row, i FROM g SEMI JOIN (SELECT g FROM g GROUP BY g HAVING COUNT(*) > 1) USING (g)),
    e AS (SELECT *, CASE WHEN i - LAG(i) OVER (PARTITION BY row ORDER BY i) <= 400 THEN 0 ELSE 1 END AS new FROM r),
    s AS MATERIALIZED (SELECT row, MIN(i) AS a, MAX(i) + 400 AS b FROM (SELECT *, SUM(new) OVER (PARTITION BY row ORDER BY i) AS span FROM e) GROUP BY row, span),
    n AS (SELECT row, SUM(b - a) AS n_removed, COUNT(*) AS n_spans FROM s GROUP BY row),
    k AS (SELECT row, string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS kept FROM (SELECT s.row, x, s.b AS a, LEAD(s.a, 1, length(x) // 2) OVER (PARTITION BY s.row ORDER BY s.a) AS b FROM s JOIN d ON d.row = s.row
        UNION ALL SELECT d.row, x, 0, MIN(s.a) FROM s JOIN d ON d.row = s.row GROUP BY ALL) GROUP BY row)
    SELECT doc_id, length(x) // 2 AS n_bytes, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed, COALESCE(n_spans, 0) AS n_spans, sha256(unhex(COALESCE(kept, x))) AS kept_sha256
    FROM d LEFT JOIN n ON n.row = d.row LEFT JOIN k ON k.row = d.row"""

# every period of a text up to a third of its words, every pair of equal words that far apart
OP12 = rf"""WITH d AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '{BLACK}+') AS w, {_crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
    g AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, 3 + (h // 10) % 8 AS times FROM d),
    x AS MATERIALIZED (SELECT doc_id, n, CASE WHEN planted THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // times) + 1] END) ELSE w END AS w FROM g),
    o AS MATERIALIZED (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM x),
    e AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM o x JOIN o y ON y.doc_id = x.doc_id AND y.word = x.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
    t AS (SELECT doc_id, q, MIN(i) AS start, COUNT(*) + q AS length FROM (SELECT *, i - ROW_NUMBER() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e) GROUP BY doc_id, q, island HAVING COUNT(*) + q >= GREATEST(24, 3 * q)),
    r AS MATERIALIZED (SELECT doc_id, start, length, MIN(q) AS period FROM t GROUP BY ALL),
    s AS (SELECT doc_id, COUNT(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM r GROUP BY doc_id),
    b AS (SELECT * FROM r QUALIFY ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY length::DECIMAL(38, 16) / period DESC, start, period) = 1),
    k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM o WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = o.doc_id AND o.i >= r.start + r.period AND o.i < r.start + r.length) GROUP BY doc_id)
    SELECT d.doc_id, COALESCE(n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli, sha256(COALESCE(lines, '')) AS runs_sha256, sha256(COALESCE(kept, '')) AS collapsed_sha256
    FROM d LEFT JOIN s ON s.doc_id = d.doc_id LEFT JOIN b ON b.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id"""

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_share = lambda n, total: f"CAST(1 + 1000000000::HUGEINT * ({n} + 2) // ({total} + 2 * v) AS BIGINT)"
OP13 = rf"""WITH d AS (SELECT ROW_NUMBER() OVER () AS row, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source, regexp_extract_all({LOWERED}, '{TERM}') AS ts FROM documents),
    w AS MATERIALIZED (SELECT row, lang, source, unnest(ts) AS term FROM d),
    k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING COUNT(DISTINCT row) >= 10),
    c AS MATERIALIZED (SELECT w.lang, w.source, w.term, COUNT(*) AS n FROM w JOIN k ON k.lang = w.lang AND k.term = w.term GROUP BY ALL),
    l AS (SELECT g.lang, COALESCE(v, 0) AS v, COALESCE(total, 0) AS total FROM (SELECT DISTINCT lang FROM d) g LEFT JOIN (SELECT lang, COUNT(*) AS v FROM k GROUP BY lang) USING (lang) LEFT JOIN (SELECT lang, SUM(n) AS total FROM c GROUP BY lang) USING (lang)),
    g AS MATERIALIZED (SELECT g.lang, g.source, l.v, COALESCE(t.total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) g JOIN l ON l.lang = g.lang LEFT JOIN (SELECT lang, source, SUM(n) AS total FROM c GROUP BY lang, source) t ON t.lang = g.lang AND t.source = g.source),
    p AS MATERIALIZED (SELECT g.lang, g.source, k.term, COALESCE(c.n, 0) AS n, {_share("COALESCE(c.n, 0)", "g.total")} AS p FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    q AS (SELECT lang, term, {_share("n", "total")} AS q FROM (SELECT lang, term, SUM(n) AS n FROM c GROUP BY ALL) JOIN l USING (lang)),
    f AS (SELECT a.lang, a.source, b.source AS item, SUM((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
    u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, COALESCE(f.value, 0) AS value FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
        UNION ALL SELECT p.lang, p.source, 'term', p.term, (p.p - q.q) * (p.p - q.q) // (p.p + q.q) FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q),
    r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM u)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM r WHERE part = 'pair' OR rank <= 10"""

ORACLE_SQL = {"op11_suffix_array_dedup": OP11, "op12_periodic_runs": OP12, "op13_source_divergence": OP13, "op6_license_scans": OP6, "op5_secret_scans": OP5, "op1_sharding": OP1, "op2_decontamination": OP2, "op4_url_filters": OP4, "op8_quality_rules": OP8, "op9_minhash_near_dedup": OP9}
