"""SQL that gives the same rows as the queries of this subpackage, where SQL can express them."""

from __future__ import annotations

_LINES = """
lines AS (
  SELECT item_no, source, generate_subscripts(parts, 1) AS line_no, unnest(parts) AS line
  FROM (SELECT item_no, source, string_split(content_text, chr(10)) AS parts FROM unified WHERE content_text IS NOT NULL)
),
keyed AS (
  SELECT item_no, source, line_no, regexp_replace(replace(lower(line), 'ß', 'ss'), '[^\\p{L}]+', '', 'g') AS k FROM lines
),
counted AS (
  SELECT source, k, count(DISTINCT item_no) AS n FROM keyed WHERE k <> '' GROUP BY source, k
),
sizes AS (SELECT source, count(*) AS total FROM unified GROUP BY source)
"""

ORACLES = {
    "p1_found": f"""
WITH {_LINES}
SELECT item_no, CAST(line_no AS BIGINT) AS line_no FROM keyed JOIN counted USING (source, k) JOIN sizes USING (source)
WHERE n >= 6 AND n * 10 >= total
""",
}
