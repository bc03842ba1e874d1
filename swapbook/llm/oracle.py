"""DuckDB SQL of the queries that SQL can express."""

from swapbook.llm import line_dedup, mixing

_WORD = r"[^\x20\x09-\x0D]"

_TEXT = (
    f"regexp_replace(regexp_replace(regexp_replace(html, '{line_dedup.UNSEEN}', chr(10), 'g'), "
    f"'{line_dedup.BREAKS}', chr(10), 'g'), '{line_dedup.TAGS}', '', 'g')"
)

LINE_DEDUP = f"""
WITH p AS (
  SELECT page_id,
    nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
    string_split({_TEXT}, chr(10)) AS all_lines
  FROM pages),
pages_of AS (SELECT host, count(*) AS n FROM p GROUP BY host),
line_of AS (
  SELECT host, unnest(list_distinct(list_filter(all_lines, lambda x: regexp_matches(x, '{_WORD}')))) AS line FROM p),
over_ratio AS (
  SELECT l.host, l.line FROM line_of l JOIN pages_of t ON l.host IS NOT DISTINCT FROM t.host
  GROUP BY l.host, l.line, t.n
  HAVING t.n >= {line_dedup.LEAST_PAGES} AND count(*) >= {line_dedup.LEAST_PAGES} AND count(*) > t.n * {line_dedup.RATIO}),
per_host AS (SELECT host, list(line) AS lines FROM over_ratio GROUP BY host),
cleaned AS (
  SELECT page_id, p.host, all_lines,
    CASE WHEN h.lines IS NULL THEN all_lines ELSE list_filter(all_lines, lambda x: NOT list_contains(h.lines, x)) END AS rest
  FROM p LEFT JOIN per_host h ON p.host IS NOT DISTINCT FROM h.host)
SELECT page_id, host, array_to_string(rest, chr(10)) AS text,
  CAST(coalesce(len(all_lines), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(len(all_lines) - len(rest), 0) AS BIGINT) AS n_dropped
FROM cleaned
"""

MIXING = f"""
WITH d AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('curriculum|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
ranked AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} AS r FROM totals),
weighed AS (
  SELECT *, CASE r WHEN 0 THEN {mixing.WEIGHTS[0]} WHEN 1 THEN {mixing.WEIGHTS[1]} ELSE {mixing.WEIGHTS[2]} END AS w,
    CASE r WHEN 0 THEN CAST({mixing.SLOPES[0]} AS DOUBLE) WHEN 1 THEN CAST({mixing.SLOPES[1]} AS DOUBLE)
      ELSE CAST({mixing.SLOPES[2]} AS DOUBLE) END AS slope
  FROM ranked),
units AS (
  SELECT *, row_number() OVER o AS pos,
    (CAST(sum(source_size) OVER () AS BIGINT) * CAST({mixing.SHARE} AS DOUBLE)
      - CAST(coalesce(sum(source_size) OVER b, 0) AS BIGINT) * {mixing.PASSES})
    / CAST(sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS DOUBLE) AS unit
  FROM weighed
  WINDOW o AS (ORDER BY source_size / CAST(w AS DOUBLE), source NULLS LAST),
    b AS (ORDER BY source_size / CAST(w AS DOUBLE), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT source, source_size, slope,
    least(coalesce((SELECT arg_min(unit, pos) FROM units WHERE unit * w <= source_size * {mixing.PASSES}) * w,
      CAST(source_size * {mixing.PASSES} AS DOUBLE)), CAST(source_size * {mixing.PASSES} AS DOUBLE)) AS target
  FROM units),
spots AS (
  SELECT doc_id, size, g.source_size, target, slope,
    CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place
  FROM d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source),
shares AS (
  SELECT *, size > 0 AND place + size / 2.0::DOUBLE < target AS one,
    size > 0 AND place + source_size + size / 2.0::DOUBLE < target AS two,
    least(greatest(place / target, 0.0::DOUBLE), 1.0::DOUBLE) AS share
  FROM spots)
SELECT doc_id, size, source_size, target,
  CAST((CASE WHEN one THEN size ELSE 0 END) + (CASE WHEN two THEN size ELSE 0 END) AS BIGINT) AS taken,
  CAST(floor((CASE WHEN NOT one THEN NULL WHEN slope = 0 THEN share
    ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * share) - (1 - slope)) / (2 * slope) END) * 1e9::DOUBLE) AS BIGINT) AS position
FROM shares
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS alike, b.vec_id, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.vec_id AS negative_id, positive_score,
  n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.alike
  AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 5
"""

SQL: dict[str, str] = {"op2_line_dedup": LINE_DEDUP, "op6_mixing": MIXING, "op11_hard_negatives": HARD_NEGATIVES}
