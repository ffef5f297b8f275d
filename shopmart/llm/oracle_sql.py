"""SQL of the registered queries that SQL can express and that is too long to stand beside them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def licenses(
    phrases: Mapping[str, str], templates: Sequence[tuple[str, str]], containment: float, least_stride: int
) -> str:
    """Every block of every text against every template of its length."""
    notices = ", ".join(f"('{label}', '{text}')" for label, text in templates)
    given = ", ".join(f"('{label}', string_split('{phrase}', ' '))" for phrase, label in phrases.items())
    words = f"regexp_extract_all({_LOWERED.format('{}')}, '{_WORDS}')"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {words.format("coalesce(text, '')")} AS w FROM documents
), notices(label, txt) AS (VALUES {notices}
), t AS (
  SELECT label, list_distinct({words.format("txt")}) AS tokens,
         greatest({least_stride}, CAST(pow(2, ceil(log2(len({words.format("txt")})))) AS BIGINT)) AS s
  FROM notices
), phrases(label, p) AS (VALUES {given}
), starts AS (
  SELECT r, label, unnest(range(0, len(w) - len(p) + 1)) AS i, p, w FROM d, phrases
), base AS (
  SELECT r, label, i FROM starts WHERE w[i + 1:i + len(p)] = p
), blocks AS (
  SELECT r, s, w, unnest(range(0, len(w), s)) AS pos FROM d, (SELECT DISTINCT s FROM t)
), near AS (
  SELECT r, label, len(list_intersect(list_distinct(w[pos + 1:pos + 2 * t.s]), tokens)) / len(tokens) AS share
  FROM blocks JOIN t USING (s)
  WHERE len(list_intersect(list_distinct(w[pos + 1:pos + 2 * t.s]), tokens)) >= ceil({containment} * len(tokens) - 1e-9)
), b AS (
  SELECT r, count(*) AS n, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM base GROUP BY r
), m AS (SELECT r, max(share) AS share FROM near GROUP BY r
), l AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT r, label FROM near UNION SELECT r, label FROM base) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, first_word, last_word,
       coalesce(b.labels, '') AS base_labels, coalesce(l.labels, '') AS labels,
       CASE WHEN n > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN m USING (r) LEFT JOIN l USING (r)
"""


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _levels(name: str, leaves: str, n: int) -> str:
    """Tables of a tree's levels above ``leaves`` (g, i, cnt, h), for trees of up to 16^n leaves."""
    out = f"{name}0 AS ({leaves})"
    for k in range(1, n + 1):
        out += f""", {name}{k} AS (
  SELECT g, i // 16 AS i, max((cnt + 15) // 16) AS cnt, sha256(string_agg(h, '' ORDER BY i)) AS h
  FROM {name}{k - 1} WHERE cnt > 1 GROUP BY g, i // 16)"""
    return out


def _siblings(name: str, n: int) -> str:
    """Beside the levels, every node's siblings before it (l) and behind it (r)."""
    return "".join(
        f""", {name}{k}s AS (
  SELECT g, i,
         coalesce(string_agg(h, '') OVER (PARTITION BY g, i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (PARTITION BY g, i // 16 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k} WHERE cnt > 1)"""
        for k in range(n)
    )


def manifest(depth: int = 5, top_depth: int = 4) -> str:
    """Trees of up to 16^depth documents per source and 16^top_depth sources, level by level."""
    text = _LOWERED.format("text")
    fields = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    # The checksum of a decimal id: each byte, then eight shifts.
    steps = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = (
        f"xor(4294967295, list_reduce(list_prepend(4294967295, {steps}), lambda c, o: "
        "CASE WHEN o >= 0 THEN xor(c, o) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"
    )
    joins = "".join(
        f" LEFT JOIN s{k}s a{k} ON a{k}.g = d.g AND a{k}.i = d.i // {16**k}" for k in range(depth)
    ) + "".join(f" LEFT JOIN t{k}s b{k} ON b{k}.i = roots.i // {16**k}" for k in range(top_depth))
    sides = [f"a{k}" for k in range(depth)] + [f"b{k}" for k in range(top_depth)]
    proof = " || ".join(f"coalesce({x}.l || {x}.r, '')" for x in sides)
    folded = "f0 AS (SELECT *, start AS f FROM found)"
    for k, x in enumerate(sides):
        folded += f", f{k + 1} AS (SELECT * REPLACE (CASE WHEN {x}l IS NULL THEN f ELSE sha256({x}l || f || {x}r) END AS f) FROM f{k})"
    columns = ", ".join(f"{x}.l AS {x}l, {x}.r AS {x}r" for x in sides)
    subroots = " UNION ALL ".join(f"SELECT g, h FROM s{k} WHERE cnt = 1" for k in range(depth + 1))
    top = " UNION ALL ".join(f"SELECT h FROM t{k} WHERE cnt = 1" for k in range(top_depth + 1))
    return f"""
WITH x AS (
  SELECT doc_id, source, coalesce('s' || source, '') AS g,
         sha256({fields} || {_field("text")}) AS leaf,
         CASE WHEN {crc} % 5 = 0 THEN sha256({fields} || {_field(text)}) END AS later
  FROM documents
), d AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS cnt
  FROM x
), {_levels("s", "SELECT g, i, cnt, leaf AS h FROM d", depth)}
{_siblings("s", depth)}
, roots AS (
  SELECT g AS of, 0 AS g, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS cnt FROM ({subroots})
), {_levels("t", "SELECT g, i, cnt, h FROM roots", top_depth)}
{_siblings("t", top_depth)}
, top AS ({top}
), found AS (
  SELECT d.doc_id, d.leaf, roots.h AS subroot, (SELECT h FROM top) AS root, sha256({proof}) AS proof_sha256,
         coalesce(d.later, d.leaf) AS start, {columns}
  FROM d JOIN roots ON roots.of = d.g{joins}
), {folded}
SELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified FROM f{len(sides)}
"""
