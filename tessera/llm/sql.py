"""DuckDB SQL for the queries that SQL can express."""

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '')"

OP5 = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS ls
  FROM documents),
win AS MATERIALIZED (
  SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS k
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT rid, sum(least(5, coalesce(nxt - i, 5))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM twice) GROUP BY rid),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(ls) AS n_lines,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 30 * n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR (n_lines >= 4 AND 2 * n_dup_lines > n_lines)) AS kept
FROM b
"""

OP6 = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS MATERIALIZED (
  SELECT rid, doc_id, i, ls[i] AS line,
         translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT rid, doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
hot AS MATERIALIZED (
  SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT l.*, hot.k IS NOT NULL AND l.doc_id <> hot.keeper AS gone FROM l LEFT JOIN hot ON l.k = hot.k)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY rid
"""

_OP2_SIZED = r"""
d AS MATERIALIZED (
  SELECT doc_id, source, text,
         CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '')) AS BIGINT) AS size,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM {docs}),
s AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS z, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
        FROM d GROUP BY source)),
-- sources by size over weight (times 6): those before the first that its share doesn't fill are at their cap
o AS (
  SELECT *, row_number() OVER (ORDER BY z * 6 // w, source NULLS LAST) AS nth FROM s),
r AS (
  SELECT *, CAST(sum(z) OVER () AS HUGEINT) AS total,
         CAST(coalesce(sum(z) OVER (ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS HUGEINT) AS used,
         CAST(sum(w) OVER (ORDER BY nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS HUGEINT) AS rest
  FROM o),
f AS (
  SELECT *, coalesce(min(CASE WHEN NOT 4 * z * rest < (3 * total - 4 * used) * w THEN nth END) OVER (), 1000000000) AS open
  FROM r),
t AS (
  SELECT source, z,
         CASE WHEN nth < open THEN CAST(2 * z AS DOUBLE)
              ELSE CAST(3 * total - 4 * (SELECT max(used) FILTER (WHERE nth = open) FROM f) AS DOUBLE) * CAST(w AS DOUBLE)
                   / CAST(2 * (SELECT max(rest) FILTER (WHERE nth = open) FROM f) AS DOUBLE) END AS target
  FROM f),
c AS MATERIALIZED (
  SELECT d.*, t.z, t.target, CASE WHEN t.z > 0 THEN CAST(floor(t.target / CAST(t.z AS DOUBLE)) AS BIGINT) ELSE 0 END AS epochs,
         sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
m AS MATERIALIZED (
  SELECT *, CASE WHEN size > 0 THEN epochs + CASE WHEN CAST(2 * before + size AS DOUBLE)
         <= 2.0 * (target - CAST(epochs AS DOUBLE) * CAST(z AS DOUBLE)) THEN 1 ELSE 0 END ELSE 0 END AS copies
  FROM c)
"""

OP2 = (
    "WITH "
    + _OP2_SIZED.replace("{docs}", "documents")
    + "SELECT doc_id, size, z AS source_size, target, CAST(size * copies AS BIGINT) AS taken FROM m"
)

OP10 = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n
  FROM documents),
w AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS k
  FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM d WHERE n >= 100)),
again AS MATERIALIZED (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS nth FROM w) WHERE nth > 1),
islands AS (
  SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run
  FROM (SELECT doc_id, p, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 1 ELSE 0 END AS fresh FROM again)),
runs AS MATERIALIZED (SELECT doc_id, min(p) AS s, max(p) + 100 AS e FROM islands GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS from_ FROM runs),
cut AS (
  SELECT g.doc_id, sum(g.e - g.s) AS gone, count(*) AS n_spans, max(g.e) AS tail,
         string_agg(substr(d.h, 2 * g.from_ + 1, 2 * (g.s - g.from_)), '' ORDER BY g.s) AS kept
  FROM gaps g JOIN d ON g.doc_id = d.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(c.gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(c.n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN c.doc_id IS NULL THEN d.h ELSE c.kept || substr(d.h, 2 * c.tail + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut c ON d.doc_id = c.doc_id
"""


def _crc32(codes: str) -> str:
    """CRC-32 of a list of byte values, bit by bit."""
    step = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), lambda a, b: {step}), 4294967295)"


OP11 = rf"""
WITH t AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos
  FROM (SELECT conv_id, turn, octet_length(encode(coalesce(text, ''))) AS bytes,
               substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS digest
        FROM conversations WHERE conv_id IS NOT NULL)),
c AS MATERIALIZED (
  SELECT conv_id, conv_id - conv_id % 5 AS donor, {_crc32("list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))")} % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, t.pos, t.digest, t.bytes FROM c JOIN t ON t.conv_id = c.donor WHERE t.pos <= c.h
  UNION ALL SELECT c.conv_id, t.pos, t.digest, t.bytes FROM c JOIN t ON t.conv_id = c.conv_id WHERE t.pos > c.h),
p AS MATERIALIZED (
  SELECT conv_id, row_number() OVER w AS d, string_agg(digest, ',') OVER w AS k, bytes, count(*) OVER (PARTITION BY conv_id) AS len
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, '', 0, coalesce((SELECT count(*) FROM r WHERE r.conv_id = c.conv_id), 0) FROM c),
n AS MATERIALIZED (
  SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
         CASE WHEN d > 1 THEN substr(k, 1, 33 * (d - 1) - 1) WHEN d = 1 THEN '' END AS up,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len = d), '')) AS ends_sha256
  FROM p GROUP BY d, k),
kids AS MATERIALIZED (SELECT up, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY up, d),
m AS MATERIALIZED (SELECT n.*, coalesce(kids.n_children, 0) AS n_children FROM n LEFT JOIN kids ON kids.up = n.k AND kids.d = n.d),
s AS (
  SELECT p.d, p.k, count(*) FILTER (WHERE m.n_children = 0) AS n_leaves, sum((m.n_convs - 1) * m.bytes) AS saved
  FROM m JOIN p ON p.conv_id = m.conv_id AND p.d <= m.d GROUP BY p.d, p.k)
SELECT m.conv_id, CAST(m.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, m.n_convs, CAST(m.n_children AS BIGINT) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN s ON s.d = m.d AND s.k = m.k LEFT JOIN n u ON u.d = m.d - 1 AND u.k = m.up
"""


def _op12_words(table: str, key: str) -> str:
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    split = rf"list_filter(regexp_split_to_array({low}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    return f"SELECT {key} AS rid, {split} AS ws FROM {table}"


OP12 = rf"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
dw AS MATERIALIZED ({_op12_words("docs", "rid")}),
dl AS MATERIALIZED (SELECT rid, unnest(ws) AS w FROM dw),
tl AS MATERIALIZED (SELECT unnest(ws) AS w FROM ({_op12_words("benchmark", "item_id")})),
words AS MATERIALIZED (
  SELECT w, {_crc32("list_transform(range(0, CAST(length(h) / 2 AS BIGINT)), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))")} % 10000 AS b
  FROM (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dl UNION SELECT w FROM tl))),
s AS (SELECT b, count(*) AS s FROM dl JOIN words USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM tl JOIN words USING (w) GROUP BY b),
g AS MATERIALIZED (
  SELECT b, CAST(floor(1000 * ln(
           (CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST((SELECT count(*) FROM dl) + 10000 AS DOUBLE))
           / (CAST(s + 1 AS DOUBLE) * CAST((SELECT count(*) FROM tl) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (b)),
x AS (
  SELECT rid, count(*) AS n, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM dl JOIN words USING (w) JOIN g USING (b) GROUP BY rid),
f AS MATERIALIZED (
  SELECT docs.rid, doc_id, coalesce(n, 0) AS n, coalesce(weight, 0) AS weight,
         CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM docs LEFT JOIN x USING (rid)),
z AS MATERIALIZED (SELECT *, weight + CAST(floor(-1000.0 * ln(-ln((CAST(h AS DOUBLE) + 0.5) / 4294967296.0))) AS BIGINT) AS score FROM f),
o AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n, weight) AS nth,
         (count(*) OVER ()) * 10 // 100 AS draws
  FROM z WHERE n >= 20)
SELECT doc_id, n AS n_features, weight, score, CASE WHEN nth <= draws THEN nth END AS rank FROM z LEFT JOIN o USING (rid)
"""


def _op13_matches(kind: int, pattern: str, column: str, value: str, least: int, more: str = "") -> str:
    """The matches of one kind with their code point places."""
    quoted = pattern.replace("'", "''")
    place = "list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0)"
    return rf"""
  SELECT rid, {kind} AS kind, s, s + length(m) AS e, {value} AS v FROM (
    SELECT rid, text, CAST({place} AS BIGINT) AS s, ms[i] AS m, substr(text, CAST({place} AS BIGINT) + 1, length(ms[i])) AS own
    FROM (SELECT rid, text, ps, ms, unnest(range(1, len(ms) + 1)) AS i FROM (
      SELECT rid, text, regexp_split_to_array({column}, '{quoted}') AS ps, regexp_extract_all({column}, '{quoted}') AS ms FROM d)))
  WHERE length({value}) >= {least} {more}"""


def _op13() -> str:
    from tessera.llm import secretscan as sc

    # in the text with A-Z lower-cased, so that only ASCII letters are alike
    assign = sc.ASSIGN.replace("A-Za-z", "a-z").replace(r"\"", '"').replace("(password|", "(?:password|")
    second = f"regexp_extract(m, '{assign.replace(chr(39), chr(39) * 2)}', 1)"
    parts = [
        _op13_matches(0, assign, "low", f"right(own, length({second}))", sc.SHORTEST["assign"]),
        _op13_matches(1, sc.ACCESS, "text", "own", sc.SHORTEST["access"]),
        _op13_matches(2, sc.HEX, "text", "own", sc.SHORTEST["hex"]),
    ]
    for k, (kind, pattern) in enumerate(sc.FURTHER.items(), len(sc.BASE)):
        more = ""
        if kind == "mixed":
            more = f"AND len(list_distinct(string_split(own, ''))) >= {sc.MIXED_CHARS}" + "".join(f" AND regexp_matches(own, '[{c}]')" for c in ("a-z", "A-Z", "0-9"))
        parts.append(_op13_matches(k, pattern, "text", "own", sc.SHORTEST.get(kind, 0), more))
    made_up = " OR ".join(f"contains(lower(v), '{w}')" for w in sc.MADE_UP)
    names = "[" + ", ".join(f"'{k}'" for k in sc.KINDS) + "]"
    told = f"{names}[kind + 1] || ':' || s || ':' || e"
    return rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
m AS MATERIALIZED ({" UNION ALL ".join(parts)}),
f AS MATERIALIZED (
  SELECT m.*, source, doc_id FROM m JOIN d USING (rid)
  WHERE kind < 3 OR NOT EXISTS (SELECT 1 FROM m o WHERE o.rid = m.rid AND o.kind < m.kind AND o.s < m.e AND o.e > m.s)),
own AS (SELECT v, count(DISTINCT coalesce('=' || source, '')) AS owners FROM f GROUP BY v),
j AS MATERIALIZED (
  SELECT f.*, CASE WHEN owners >= {sc.COPIED_OWNERS} THEN 'copied' WHEN {made_up} THEN 'made_up' ELSE 'owned' END AS verdict
  FROM (SELECT f.*, owners FROM f JOIN own USING (v)) f),
a AS (
  SELECT rid, {", ".join(f"count(*) FILTER (WHERE kind = {k}) AS n_{kind}" for k, kind in enumerate(sc.BASE))},
         string_agg({told}, ',' ORDER BY s, kind) FILTER (WHERE kind < 3) AS base,
         string_agg({told}, ',' ORDER BY s, kind) FILTER (WHERE kind < 3 OR verdict = 'owned') AS spans,
         {", ".join(f"count(*) FILTER (WHERE verdict = '{v}') AS n_{v}" for v in sc.VERDICTS)}
  FROM j GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in (*sc.BASE, *sc.VERDICTS))},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (rid)
"""


OP13 = _op13()
