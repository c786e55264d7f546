"""The mixing schedule in DuckDB SQL: one frame is played slot by slot, earliest deadline first."""

MIX_SQL = """
WITH RECURSIVE sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
weights AS (SELECT *, round(n::DOUBLE ** 0.5, 9) AS w, count(*) OVER () AS k FROM sizes),
exact AS (SELECT *, round((1000 - k) * w / sum(w) OVER (), 6) AS e FROM weights),
low AS (SELECT *, floor(e)::BIGINT AS f FROM exact),
shares AS (SELECT source, n, f + 1 + (row_number() OVER (ORDER BY f - e, source NULLS FIRST) <= 1000 - k - sum(f) OVER ())::BIGINT AS share FROM low),
start AS (SELECT 0::BIGINT AS slot, list({'name': coalesce(source, ''), 'share': share, 'done': 0::BIGINT, 'slot': -1::BIGINT}) AS q FROM shares),
play AS (
  SELECT * FROM start
  UNION ALL
  SELECT slot + 1, list_transform(q, lambda b: CASE WHEN b.name = best.name
      THEN {'name': b.name, 'share': b.share, 'done': b.done + 1, 'slot': slot} ELSE {'name': b.name, 'share': b.share, 'done': b.done, 'slot': -1::BIGINT} END)
  FROM (SELECT slot, q, list_min(list_transform(list_filter(q, lambda b: b.done < b.share AND (b.done * 1000) // b.share <= slot),
      lambda b: {'due': ((b.done + 1) * 1000 + b.share - 1) // b.share, 'name': b.name})) AS best FROM play WHERE slot < 1000)),
slots AS (SELECT u.name AS source, u.done - 1 AS j, u.slot AS own_slot FROM (SELECT unnest(q) AS u FROM play) WHERE u.slot >= 0),
ranked AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id) - 1 AS r FROM documents),
blocks AS (SELECT doc_id, r.source, share, r // 10 AS block, r % 10 AS place FROM ranked r JOIN shares s ON r.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, b.source, share, block, (block // share) * 1000 + ((block % share) * 1000) // share AS release,
  (block // share) * 1000 + ((block % share + 1) * 1000 + share - 1) // share AS deadline, (block // share) * 1000 + own_slot AS slot, place
FROM blocks b JOIN slots s ON coalesce(b.source, '') = s.source AND block % share = j
"""
