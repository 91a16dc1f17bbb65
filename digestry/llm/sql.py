"""SQL of the clustering and manifest queries, written out round by round."""

from __future__ import annotations


def clusters(rounds: int = 10, k: int = 8, dimensions: int = 64) -> str:
    """Every round: distances of all vectors to the numbered centroids, the least by (distance, number), floors of means."""
    square = f"list_sum([(v.x[i] - c.x[i]) * (v.x[i] - c.x[i]) for i in range(1, {dimensions + 1})])::BIGINT"
    parts = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [floor(1024 * e::DOUBLE)::BIGINT for e in embedding] AS x
  FROM embeddings
  WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dimensions})""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS cluster, x
  FROM (SELECT sha256('3:' || coalesce(vec_id::VARCHAR, '')) AS h, x FROM v ORDER BY h, x LIMIT {k}))""",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (
  SELECT r, (best).cluster AS cluster, (best).distance AS distance
  FROM (SELECT r, min({{'distance': {square}, 'cluster': c.cluster}}) AS best FROM v CROSS JOIN c{i} AS c GROUP BY r))"""
        )
        if i < rounds:
            parts.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.x, c.x) AS x
  FROM c{i} AS c LEFT JOIN (
    SELECT cluster, list(whole ORDER BY place) AS x
    FROM (SELECT cluster, place, ((s - ((s % n) + n) % n) // n)::BIGINT AS whole
      FROM (SELECT cluster, place, sum(part)::HUGEINT AS s, count(*)::HUGEINT AS n
        FROM (SELECT cluster, unnest(range(1, {dimensions + 1})) AS place, unnest(x) AS part FROM a{i} JOIN v USING (r)) GROUP BY cluster, place))
    GROUP BY cluster) AS m USING (cluster))"""
            )
    body = ",\n".join(parts)
    return f"""WITH {body}
SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} AS c USING (cluster)
"""


def manifest(levels: int = 7, source_levels: int = 4, fan: int = 16) -> str:
    """Levels of all sources, then levels over the sources, each run of 16 as a list of digests."""
    shift = "CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END"
    steps = f"[4294967295::BIGINT] || flatten([[ascii(substring(k, i, 1))::BIGINT] || {[-1] * 8}::BIGINT[] for i in range(1, len(k) + 1)])"
    fields = [f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars")]
    text = "coalesce(strlen({0})::VARCHAR || ':' || {0}, '-')"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    own, other = (f"sha256({' || '.join(fields)} || {text.format(t)})" for t in ("text", lowered))
    crc = f"xor(list_reduce({steps}, lambda c, e: {shift}), 4294967295)"
    parts = [
        f"""d AS MATERIALIZED (
  SELECT doc_id, source, leaf, tampered, CASE WHEN tampered THEN changed ELSE leaf END AS found
  FROM (SELECT doc_id, source, {own} AS leaf, {other} AS changed, coalesce({crc} % 5 = 0, false) AS tampered FROM (SELECT *, doc_id::VARCHAR AS k FROM documents)))""",
        "p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d)",
        "n0 AS MATERIALIZED (SELECT source AS g, pos, leaf AS h FROM p)",
    ]

    def climb(prefix: str, count: int) -> None:
        for i in range(count):
            parts.append(
                f"""{prefix}r{i} AS MATERIALIZED (
  SELECT g, pos // {fan} AS run, list(h ORDER BY pos) AS l, max(n) AS n
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {prefix}n{i}) GROUP BY g, pos // {fan})"""
            )
            parts.append(f"{prefix}n{i + 1} AS MATERIALIZED (SELECT g, run AS pos, CASE WHEN n = 1 THEN l[1] ELSE sha256(array_to_string(l, '')) END AS h FROM {prefix}r{i})")

    climb("", levels)
    parts.append(f"sn0 AS MATERIALIZED (SELECT 0 AS g, row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS pos, h, g AS source FROM n{levels})")
    climb("s", source_levels)
    # Down a path: a digest's place in its run, the siblings so far and the node folded so far.
    left, right = f"array_to_string(l[1:place % {fan}], '')", f"array_to_string(l[place % {fan} + 2:], '')"
    parts.append("w0 AS MATERIALIZED (SELECT doc_id, source, leaf, tampered, pos AS place, '' AS proof, found AS node FROM p)")

    def walk(prefix: str, runs: str, count: int, columns: str, same: str) -> None:
        for i in range(count):
            parts.append(
                f"""{prefix}{i + 1} AS MATERIALIZED (
  SELECT {columns}, place // {fan} AS place, CASE WHEN n = 1 THEN proof ELSE proof || {left} || {right} END AS proof,
    CASE WHEN n = 1 THEN node ELSE sha256({left} || node || {right}) END AS node
  FROM {prefix}{i} AS w JOIN {runs}{i} AS r ON {same} r.run = w.place // {fan})"""
            )

    walk("w", "r", levels, "doc_id, source, leaf, tampered", "r.g IS NOT DISTINCT FROM w.source AND")
    parts.append(f"x0 AS MATERIALIZED (SELECT doc_id, leaf, tampered, s.h AS subroot, s.pos AS place, proof, node FROM w{levels} AS w JOIN sn0 AS s ON s.source IS NOT DISTINCT FROM w.source)")
    walk("x", "sr", source_levels, "doc_id, leaf, tampered, subroot", "")
    body = ",\n".join(parts)
    return f"""WITH {body}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = h AS verified, tampered
FROM x{source_levels}, sn{source_levels}
"""
