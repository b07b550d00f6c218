"""DuckDB SQL for the vector queries: the rounds are written out one after another."""

from __future__ import annotations


def _floored(total: str, count: str) -> str:
    """Floor of an integer quotient; DuckDB's // goes towards zero."""
    return f"(({total}) - ((({total}) % ({count})) + ({count})) % ({count})) // ({count})"


def _kept(scale: int, fits: str) -> str:
    return f"""kept AS (
  SELECT vec_id, label, [floor({scale} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE {fits} AND len([1 FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
)"""


def drift_kmeans(clusters: int = 8, rounds: int = 10, scale: int = 1024, dim: int = 64) -> str:
    parts = [
        _kept(scale, f"len(embedding) = {dim}"),
        "numbered AS MATERIALIZED (SELECT row_number() OVER () AS no, * FROM kept)",
        "components AS MATERIALIZED (SELECT no, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM numbered)",
        f"""starts AS (
  SELECT v, row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c
  FROM numbered QUALIFY c < {clusters}
), at0 AS MATERIALIZED (SELECT c, generate_subscripts(v, 1) AS i, unnest(v) AS y FROM starts)""",
    ]
    for n in range(rounds + 1):
        parts.append(f"""own{n} AS MATERIALIZED (
  SELECT no, c, d FROM (
    SELECT no, c, sum((x - y) * (x - y))::BIGINT AS d FROM components JOIN at{n} USING (i) GROUP BY no, c
  ) QUALIFY row_number() OVER (PARTITION BY no ORDER BY d, c) = 1
)""")
        if n < rounds:
            parts.append(f"""at{n + 1} AS MATERIALIZED (
  SELECT at{n}.c, at{n}.i, coalesce(mean, y) AS y FROM at{n} LEFT JOIN (
    SELECT c, i, {_floored("sum(x)", "count(*)")} AS mean
    FROM own{n} JOIN components USING (no) GROUP BY c, i
  ) AS m ON at{n}.c = m.c AND at{n}.i = m.i
)""")
    return f"""WITH {", ".join(parts)}, hashes AS (
  SELECT c, sha256(string_agg(y::BIGINT::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM at{rounds} GROUP BY c
)
SELECT vec_id, c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM own{rounds} JOIN numbered USING (no) JOIN hashes USING (c)"""


def norm_codes(n_parts: int = 16, n_entries: int = 64, rounds: int = 2, scale: int = 256) -> str:
    parts = [
        _kept(scale, f"len(embedding) > 0 AND len(embedding) % {n_parts} = 0"),
        """numbered AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS no, *, len(v) AS dim FROM kept
  QUALIFY dim = first(len(v)) OVER (ORDER BY vec_id NULLS LAST, v)
)""",
        f"""components AS MATERIALIZED (
  SELECT no, (i - 1) // width AS p, (i - 1) % width AS i, x FROM (
    SELECT no, dim // {n_parts} AS width, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM numbered
  )
)""",
        f"""at0 AS MATERIALIZED (
  SELECT p, i, x AS y, rank - 1 AS e FROM components
  JOIN (SELECT no, row_number() OVER (ORDER BY no) AS rank FROM numbered) USING (no) WHERE rank <= {n_entries}
)""",
    ]
    for n in range(rounds + 1):
        parts.append(f"""own{n} AS MATERIALIZED (
  SELECT no, p, min((d, e)) AS best FROM (
    SELECT no, p, e, sum((x - y) * (x - y))::BIGINT AS d FROM components JOIN at{n} USING (p, i) GROUP BY no, p, e
  ) GROUP BY no, p
)""")
        if n < rounds:
            parts.append(f"""at{n + 1} AS MATERIALIZED (
  SELECT at{n}.p, at{n}.e, at{n}.i, coalesce(mean, y) AS y FROM at{n} LEFT JOIN (
    SELECT p, best[2] AS e, i, {_floored("sum(x)", "count(*)")} AS mean
    FROM own{n} JOIN components USING (no, p) GROUP BY p, best[2], i
  ) AS m ON at{n}.p = m.p AND at{n}.e = m.e AND at{n}.i = m.i
)""")
    return f"""WITH {", ".join(parts)}, coded AS (
  SELECT no, string_agg(lower(printf('%02x', best[2]::INT)), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error
  FROM own{rounds} GROUP BY no
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(y::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) FROM at{rounds}) AS codebooks_sha256
FROM coded JOIN numbered USING (no)"""


SQL: dict[str, str] = {"op11_drift_kmeans": drift_kmeans(), "op12_norm_codes": norm_codes()}
