"""The two vector queries in SQL: every round is one more pair of common table expressions over components as rows."""

from __future__ import annotations


def floored(total: str, count: str) -> str:
    """floor(total / count) in whole numbers."""
    return f"CAST(({total} - (({total} % {count}) + {count}) % {count}) // {count} AS BIGINT)"


def _component_rows(scale: int) -> str:
    return f"SELECT rn, unnest(generate_series(1, len(embedding))) - 1 AS ix, unnest(list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))) AS x FROM kept"


KEPT = """kept AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rn FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0{more})"""


def codes_sql(parts: int, entries: int, rounds: int, scale: int, dimensions: int) -> str:
    wide = dimensions // parts
    ctes = [
        KEPT.replace("{more}", f" AND len(embedding) = {dimensions}"),
        f"c AS MATERIALIZED (SELECT rn, ix // {wide} AS part, ix % {wide} AS pos, x FROM ({_component_rows(scale)}))",
        f"e0 AS MATERIALIZED (SELECT part, CAST(rn - 1 AS INTEGER) AS entry, pos, x FROM c WHERE rn <= {entries})",
    ]
    for k in range(rounds + 1):
        ctes.append(
            f"""a{k} AS MATERIALIZED (SELECT rn, part, min(struct_pack(d := d, entry := entry)) AS near FROM (
              SELECT c.rn, c.part, e.entry, CAST(sum((c.x - e.x) * (c.x - e.x)) AS BIGINT) AS d
              FROM c JOIN e{k} e ON c.part = e.part AND c.pos = e.pos GROUP BY ALL) GROUP BY rn, part)"""
        )
        if k < rounds:
            ctes.append(
                f"""e{k + 1} AS MATERIALIZED (SELECT e.part, e.entry, e.pos, coalesce(m.x, e.x) AS x FROM e{k} e LEFT JOIN (
                  SELECT c.part, a.near.entry AS entry, c.pos, {floored('sum(c.x)', 'count(*)')} AS x
                  FROM c JOIN a{k} a ON c.rn = a.rn AND c.part = a.part GROUP BY ALL) m
                  ON m.part = e.part AND m.entry = e.entry AND m.pos = e.pos)"""
            )
    return f"""WITH {', '.join(ctes)},
      coded AS (SELECT rn, string_agg(lower(printf('%02x', near.entry)), '' ORDER BY part) AS code, CAST(sum(near.d) AS BIGINT) AS error
                FROM a{rounds} GROUP BY rn)
      SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
        (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM e{rounds}) AS codebooks_sha256
      FROM coded JOIN kept USING (rn)"""


def clusters_sql(k: int, rounds: int, scale: int, dimensions: int, seed: int) -> str:
    ctes = [
        KEPT.replace("{more}", f" AND len(embedding) = {dimensions}"),
        f"c AS MATERIALIZED ({_component_rows(scale)})",
        f"""first AS (SELECT rn, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, embedding) - 1 AS no FROM kept
              QUALIFY no < {k})""",
        "m0 AS MATERIALIZED (SELECT CAST(no AS INTEGER) AS cluster, ix, x FROM first JOIN c USING (rn))",
    ]
    for r in range(rounds + 1):
        ctes.append(
            f"""a{r} AS MATERIALIZED (SELECT rn, min(struct_pack(d := d, cluster := cluster)) AS near FROM (
              SELECT c.rn, m.cluster, CAST(sum((c.x - m.x) * (c.x - m.x)) AS BIGINT) AS d
              FROM c JOIN m{r} m ON c.ix = m.ix GROUP BY ALL) GROUP BY rn)"""
        )
        if r < rounds:
            ctes.append(
                f"""m{r + 1} AS MATERIALIZED (SELECT m.cluster, m.ix, coalesce(n.x, m.x) AS x FROM m{r} m LEFT JOIN (
                  SELECT a.near.cluster AS cluster, c.ix, {floored('sum(c.x)', 'count(*)')} AS x
                  FROM c JOIN a{r} a ON c.rn = a.rn GROUP BY ALL) n ON n.cluster = m.cluster AND n.ix = m.ix)"""
            )
    return f"""WITH {', '.join(ctes)},
      digests AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY ix)) AS centroid_sha256 FROM m{rounds} GROUP BY cluster)
      SELECT vec_id, near.cluster AS cluster, near.d AS distance, CAST(sum(near.d) OVER (PARTITION BY near.cluster) AS BIGINT) AS cluster_inertia,
        CAST(sum(near.d) OVER () AS BIGINT) AS inertia, centroid_sha256
      FROM a{rounds} JOIN kept USING (rn) JOIN digests ON digests.cluster = near.cluster"""
