"""The mixing query in SQL."""

from __future__ import annotations

from millrace.llm.mixing import BUDGET, ROUNDS, TEMPERATURE

DIMENSIONS = ("source", "lang", "topic")


def mixing_sql(documents: str = "documents") -> str:
    """Unrolled rounds of raking over the cells, then the draw."""
    parts = [
        f"""docs AS MATERIALIZED (
  SELECT doc_id, source, lang, CASE WHEN t = '' THEN 0 ELSE length(t) - length(replace(t, ' ', '')) + 1 END AS n_tokens, t
  FROM (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM {documents}))""",
        """rows AS MATERIALIZED (
  SELECT doc_id, source, lang, n_tokens,
    CASE WHEN contains(t, ' | ') THEN 'table'
         WHEN contains(lower(t), 'license') OR contains(lower(t), 'copyright') THEN 'legal'
         WHEN contains(t, '@') OR contains(t, '://') THEN 'contact'
         WHEN n_tokens < 100 THEN 'note' ELSE 'prose' END AS topic
  FROM docs)""",
        "cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS mass FROM rows GROUP BY ALL)",
        "w0 AS MATERIALIZED (SELECT source, lang, topic, mass, mass / (SELECT sum(mass) FROM cells) AS weight FROM cells)",
    ]
    for d in DIMENSIONS:
        parts.append(f"r_{d} AS MATERIALIZED (SELECT {d}, pow(sum(mass), {TEMPERATURE}) AS s, sum(mass) AS m FROM cells GROUP BY {d})")
        parts.append(f"t_{d} AS MATERIALIZED (SELECT {d}, s / (SELECT sum(s) FROM r_{d}) AS share FROM r_{d} WHERE m > 0)")
    step = 0
    for _ in range(ROUNDS):
        for d in DIMENSIONS:
            parts.append(
                f"w{step + 1} AS MATERIALIZED (SELECT w.source, w.lang, w.topic, w.mass, "
                f"CASE WHEN h.have > 0 THEN w.weight * (coalesce(t.share, 0) / h.have) ELSE 0 END AS weight FROM w{step} w "
                f"JOIN (SELECT {d}, sum(weight) AS have FROM w{step} GROUP BY {d}) h ON w.{d} IS NOT DISTINCT FROM h.{d} "
                f"LEFT JOIN t_{d} t ON w.{d} IS NOT DISTINCT FROM t.{d})"
            )
            step += 1
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, r.source, r.lang, r.topic, n_tokens, round(least(1.0, rate), 6) AS probability,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0 < least(1.0, rate) AS sampled,
  round(CASE WHEN rate > 1 THEN rate ELSE 1.0 END, 6) AS weight
FROM rows r JOIN (
  SELECT source, lang, topic, CASE WHEN mass > 0 THEN {BUDGET} * weight / (mass / (SELECT sum(mass) FROM cells)) ELSE 0 END AS rate
  FROM w{step}) c
ON r.source IS NOT DISTINCT FROM c.source AND r.lang IS NOT DISTINCT FROM c.lang AND r.topic = c.topic"""
