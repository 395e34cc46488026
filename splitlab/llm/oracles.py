"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_LETTERS = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NO_WORD = r"[^\x20\x09-\x0D]+"
#: Levels of the trees; 16^5 leaves a source are more than the tables that the SQL is run on hold.
LEVELS = 5


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR END"


def _tree(name: str, first: str) -> str:
    """CTEs name0 .. of one tree per grp: (grp, idx, n, hash, l, r)."""
    def level(select: str) -> str:
        run = "PARTITION BY grp, idx // 16 ORDER BY idx ROWS BETWEEN"
        return f"""SELECT grp, idx, hash, count(*) OVER (PARTITION BY grp) AS n,
  coalesce(string_agg(hash, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(hash, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM ({select})"""

    out = [f"{name}0 AS MATERIALIZED ({level(first)})"]
    for k in range(1, LEVELS + 1):
        up = f"SELECT grp, idx // 16 AS idx, sha256(string_agg(hash, '' ORDER BY idx)) AS hash FROM {name}{k - 1} WHERE n > 1 GROUP BY ALL"
        out.append(f"{name}{k} AS MATERIALIZED ({level(up)})")
    return ",\n".join(out)


def _tops(name: str) -> str:
    return " UNION ALL ".join(f"SELECT grp, hash FROM {name}{k} WHERE n = 1" for k in range(LEVELS + 1))


def merkle() -> str:
    plain = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    lower = " || ".join(_field(_LETTERS if c == "text" else c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    climb = ""
    for tree, grp, idx in (("t", "d.grp", "d.idx"), ("u", "0", "v.idx")):
        for k in range(LEVELS + 1):
            climb += f"\nLEFT JOIN {tree}{k} AS {tree}j{k} ON {tree}j{k}.grp IS NOT DISTINCT FROM {grp} AND {tree}j{k}.idx = {idx} // {16**k} AND {tree}j{k}.n > 1"
        if tree == "t":
            climb += "\nJOIN subroots AS v ON v.name IS NOT DISTINCT FROM d.grp"
    joins = [f"{tree}j{k}" for tree in "tu" for k in range(LEVELS + 1)]
    lists = ", ".join(f"{{'l': {j}.l, 'r': {j}.r}}" for j in joins)
    return f"""WITH crc AS (SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b::BIGINT) ORDER BY b) AS tab FROM range(256) AS x(b)),
docs AS (SELECT *, xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
  lambda c, ch: xor(c >> 8, tab[(xor(c, ch) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) % 5 = 0 AS changed FROM documents, crc),
leaves AS (SELECT doc_id, source AS grp, sha256({plain}) AS hash, CASE WHEN changed THEN sha256({lower}) END AS tampered FROM docs),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, hash) - 1 AS idx FROM leaves),
{_tree("t", "SELECT grp, idx, hash FROM placed")},
subroots AS MATERIALIZED (SELECT grp AS name, hash, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS idx FROM ({_tops("t")})),
{_tree("u", "SELECT 0 AS grp, idx, hash FROM subroots")},
whole AS (SELECT hash AS root FROM ({_tops("u")})),
ways AS (SELECT d.doc_id, d.hash AS leaf, v.hash AS subroot, coalesce(d.tampered, d.hash) AS h,
  list_filter([{lists}], lambda s: s.l IS NOT NULL) AS way FROM placed AS d{climb}),
folded AS (SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_concat([''], list_transform(way, lambda s: s.l || s.r)), 'string_agg', '')) AS proof_sha256,
  list_reduce(list_transform(way, lambda s: s.l || '|' || s.r), lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2)), h) AS folded_root FROM ways, whole)
SELECT *, folded_root = root AS verified FROM folded"""


HARD_NEGATIVES = """
WITH rows AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows AS a JOIN rows AS b ON a.id <> b.id WHERE a.id % 50 = 0),
positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

MIXING = rf"""
WITH docs AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_NO_WORD}')), 0)::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(text, '')) AS h FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS w,
    row_number() OVER (ORDER BY source NULLS LAST) AS turn FROM sizes),
run AS (SELECT *, 3 * source_size AS most, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
    coalesce(sum(3 * source_size) OVER before, 0) AS low, coalesce(sum(w) OVER before, 0) AS low_w,
    row_number() OVER (ORDER BY 3 * source_size / w, turn) AS place FROM weighed
  WINDOW before AS (ORDER BY 3 * source_size / w, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
free AS (SELECT place AS since, (total - low)::DOUBLE AS remains, all_w - low_w AS weight FROM run
  WHERE (total - low)::DOUBLE / (all_w - low_w) * w <= most ORDER BY place LIMIT 1),
targets AS (SELECT source, source_size, CASE WHEN since IS NULL OR place < since THEN most::DOUBLE ELSE remains * w / weight END AS target
  FROM run LEFT JOIN free ON true),
planned AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets),
summed AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY h) AS upto
  FROM docs AS d JOIN planned AS p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN rest > 0 AND (upto <= rest OR (upto - size < rest AND 2 * (rest - (upto - size)) > size)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""
