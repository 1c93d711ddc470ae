"""SQL twins of the registered queries, in DuckDB's dialect."""

from __future__ import annotations

from parcelgrid.llm.licences import TEMPLATES
from parcelgrid.llm.url_filter import RULES

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def folded(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{UPPER.lower()}')"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM s QUALIFY rank <= 5
"""

URL_FILTER = f"""
WITH r(verdict, rule) AS (VALUES {", ".join(f"({quoted(r.verdict)}, {quoted(r.text)})" for r in RULES)}),
rules AS (SELECT verdict, rule, split_part(rule, '/', 1) AS h, substr(rule, strpos(rule, '/')) AS p FROM r),
cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, {folded("regexp_extract(rest, '^[^/?#]*')")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), fits AS (
  SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN regexp_matches(host || path,
  '(?s)^(ads-track\\.|[^/]*\\.ads-track\\.|[^/]*/track.php|[^/]*/login/|.*\\.exe$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fits USING (page_id)
"""

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key FROM documents
), s AS (SELECT source, CAST(sum(size) AS BIGINT) AS ss FROM d GROUP BY source),
w AS (SELECT source, ss, 3 * ss AS cap, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
f AS (SELECT *, CAST(cap AS DOUBLE) / weight AS full_at FROM w),
r AS (
  SELECT *, row_number() OVER o AS place,
    CAST(sum(ss) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
  FROM f WINDOW o AS (ORDER BY full_at, source NULLS LAST)
), first_open AS (SELECT min(place) AS p FROM r WHERE lvl <= full_at),
t AS (
  SELECT source, ss, CASE WHEN place < p THEN CAST(cap AS DOUBLE) ELSE (SELECT lvl FROM r WHERE place = p) * weight END
    AS target FROM r, first_open
), u AS (SELECT *, CASE WHEN ss > 0 THEN CAST(floor(target / ss) AS BIGINT) ELSE 0 END AS repeats FROM t),
a AS (SELECT *, greatest(CAST(round(target) AS BIGINT) - repeats * ss, 0) AS rest FROM u),
k AS (
  SELECT source, key, held, n, sum(held) OVER (PARTITION BY source ORDER BY key) - held AS below
  FROM (SELECT source, key, CAST(sum(size) AS BIGINT) AS held, count(*) AS n FROM d GROUP BY source, key)
), b AS (
  SELECT k.source, k.key AS boundary, CAST(floor((rest - below) / n) AS BIGINT) AS share
  FROM k JOIN a ON k.source IS NOT DISTINCT FROM a.source WHERE below < rest AND rest <= below + held
)
SELECT d.doc_id, d.size, a.ss AS source_size, a.target,
  CAST(repeats * size + CASE WHEN key < boundary THEN size WHEN key = boundary THEN least(size, share) ELSE 0 END AS BIGINT)
    AS taken
FROM d JOIN a ON d.source IS NOT DISTINCT FROM a.source LEFT JOIN b ON d.source IS NOT DISTINCT FROM b.source
"""


def bigrams(words: str) -> str:
    return f"list_distinct(list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1]))"


LICENCES = f"""
WITH named(licence, body) AS (VALUES {", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in TEMPLATES.items())}),
tw AS (SELECT licence, regexp_extract_all({folded("body")}, '[a-z0-9]+') AS w FROM named),
t AS (SELECT licence, {bigrams("w")} AS g FROM tw),
d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
l AS (SELECT r, generate_subscripts(x, 1) AS line, unnest(x) AS unit FROM (SELECT r, string_split(text, chr(10)) AS x FROM d)),
p AS (
  SELECT r, generate_subscripts(x, 1) AS k, unnest(x) AS unit, len(x) AS n
  FROM (SELECT r, regexp_split_to_array(text, '\\n[ \\t\\r]*\\n') AS x FROM d)
), pl AS (
  SELECT r, k, n, unit, len(string_split(unit, chr(10))) AS rows_in,
    1 + coalesce(sum(len(string_split(unit, chr(10))) + 1)
      OVER (PARTITION BY r ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line FROM p
), units AS (
  SELECT r, line, unit FROM l
  UNION ALL SELECT r, 1, text FROM d WHERE contains(text, chr(10))
  UNION ALL SELECT r, line, unit FROM pl WHERE n > 1 AND rows_in > 1
), uw AS (SELECT r, line, regexp_extract_all({folded("unit")}, '[a-z0-9]+') AS w FROM units),
ug AS (SELECT r, line, {bigrams("w")} AS g FROM uw WHERE len(w) > 1),
c AS (
  SELECT r, line, licence, len(list_intersect(ug.g, t.g)) AS common, len(ug.g) + len(t.g) AS total
  FROM ug JOIN t ON 3 * len(ug.g) >= 2 * len(t.g) AND 3 * len(t.g) >= 2 * len(ug.g)
), m AS (SELECT *, 2.0::DOUBLE * common / total AS dice FROM c WHERE 10 * common >= 4 * total),
best AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY dice DESC, licence, line) AS k, count(*) OVER (PARTITION BY r) AS n FROM m)
SELECT doc_id, licence, dice, CAST(line AS BIGINT) AS line, coalesce(n, 0) AS n_matches
FROM d LEFT JOIN best ON d.r = best.r AND k = 1
"""

EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS c FROM documents
), g AS (
  SELECT doc_id, c, first_value(doc_id) OVER (PARTITION BY c ORDER BY length(t) DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY c) AS group_size FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(c) AS text_sha256 FROM g
"""

def hash_field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def manifest_sql(leaf_levels: int = 14, source_levels: int = 8) -> str:
    """Levels are written out: enough of them for 3 ** 14 rows of a source and 3 ** 8 sources."""
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    own = " || ".join(hash_field(c) for c in fields)
    cut = " || ".join(hash_field("replace(text, chr(10), '')" if c == "text" else c) for c in fields)
    # one step per bit: a byte is mixed in, then shifted out eight times
    steps = "flatten(list_transform(range(1, length(key) + 1), lambda i: [ord(key[i]), -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), "
        "lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"
    )
    parts = [
        f"""d AS MATERIALIZED (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE 'x' || source END AS tree, sha256({own}) AS leaf,
    sha256({cut}) AS cut, CAST(doc_id AS VARCHAR) AS key FROM documents
), e AS MATERIALIZED (
  SELECT doc_id, tree, leaf, CASE WHEN {crc} % 2 = 0 THEN cut ELSE leaf END AS again,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d
), a0 AS (SELECT tree, pos, n, leaf AS h FROM e)""",
    ]

    def levels(name: str, start: int, count: int) -> None:
        for k in range(start, start + count):
            parts.append(f"""{name}{k + 1} AS MATERIALIZED (
  SELECT tree, pos // 3 AS pos, (n + 2) // 3 AS n, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h
  FROM {name}{k} GROUP BY tree, pos // 3, n
), s{name}{k} AS MATERIALIZED (
  SELECT x.tree, x.pos, x.n, coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS l,
    coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS r
  FROM {name}{k} x JOIN {name}{k} y ON x.tree = y.tree AND x.pos // 3 = y.pos // 3 GROUP BY x.tree, x.pos, x.n
)""")

    levels("a", 0, leaf_levels)
    parts.append(f"b0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, h, tree AS of FROM a{leaf_levels})")
    levels("b", 0, source_levels)
    parts.append("f0 AS (SELECT doc_id, tree, leaf, pos, again AS acc, '' AS proof FROM e)")
    step = "CASE WHEN s.n > 1 THEN sha256(l || acc || r) ELSE acc END AS acc, CASE WHEN s.n > 1 THEN proof || l || r ELSE proof END AS proof"
    for k in range(leaf_levels):
        parts.append(f"f{k + 1} AS (SELECT doc_id, f.tree, leaf, f.pos // 3 AS pos, {step} FROM f{k} f JOIN sa{k} s ON f.tree = s.tree AND f.pos = s.pos)")
    parts.append(
        f"g0 AS (SELECT doc_id, leaf, b.h AS subroot, b.pos, acc, proof FROM f{leaf_levels} f JOIN b0 b ON f.tree = b.of)"
    )
    for k in range(source_levels):
        parts.append(f"g{k + 1} AS (SELECT doc_id, leaf, subroot, g.pos // 3 AS pos, {step} FROM g{k} g JOIN sb{k} s ON g.pos = s.pos)")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, b.h AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = b.h AS verified
FROM g{source_levels}, b{source_levels} b"""


ORACLES = {
    "op2_topk": TOPK,
    "op6_url_filter": URL_FILTER,
    "op7_mixing": MIXING,
    "op9_licences": LICENCES,
    "op12_manifest": manifest_sql(),
    "op13_exact_dedup": EXACT_DEDUP,
}
