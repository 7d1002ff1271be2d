"""SQL that DuckDB runs on the same tables, for the operators that SQL can state."""

from __future__ import annotations

_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""

_FIND = """
  SELECT k, doc_id, source, {rank} AS rank, '{kind}' AS kind, {least} AS least, t,
         regexp_extract_all(t, '{pattern}') AS ms, regexp_extract_all(t, '{pattern}', {group}) AS vs,
         string_split_regex(t, '{pattern}') AS ps
  FROM d WHERE regexp_matches(t, '{pattern}')"""

_PATTERNS = (
    ("assign", _ASSIGN, 2, 6),
    ("access", "AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
    ("opaque", "[A-Za-z0-9+/_-]{20,}", 0, 20),
)

SECRETS = f"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS k, doc_id, source, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(_FIND.format(rank=i, kind=k, pattern=p, group=g, least=n) for i, (k, p, g, n) in enumerate(_PATTERNS))}),
i AS (SELECT *, unnest(range(1, len(ms) + 1)) AS j FROM m),
s AS (
  SELECT k, doc_id, source, rank, kind, vs[j] AS v,
         list_sum(list_transform(ps[1:j], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:j - 1], lambda x: length(x))), 0) AS a,
         length(ms[j]) AS n
  FROM i WHERE length(vs[j]) >= least),
u AS (
  SELECT k, doc_id, source, rank, kind, v, CAST(a AS BIGINT) AS a, CAST(a + n AS BIGINT) AS z FROM s
  WHERE rank < 3 OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]'))),
c AS (
  SELECT * FROM u x WHERE rank < 3
  UNION ALL
  SELECT x.* FROM u x WHERE rank = 3 AND NOT EXISTS (SELECT 1 FROM u b WHERE b.k = x.k AND b.rank < 3 AND b.a < x.z AND x.a < b.z)),
o AS (SELECT v, count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) AS owners FROM c GROUP BY v),
j AS (SELECT c.*, owners, kind || ':' || a || ':' || z AS spelt FROM c JOIN o USING (v)),
g AS (
  SELECT k, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
         coalesce(string_agg(spelt, ',' ORDER BY a, rank) FILTER (rank < 3), '') AS base,
         coalesce(string_agg(spelt, ',' ORDER BY a, rank) FILTER (rank < 3 OR owners <= 2), '') AS spans,
         count(*) FILTER (owners <= 2) AS n_live, max(owners) FILTER (rank < 3) AS most_owners
  FROM j GROUP BY k)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(most_owners, 0) AS most_owners
FROM d LEFT JOIN g USING (k)"""

ORACLES: dict[str, str] = {
    "op9_secret_owners": SECRETS,
}
