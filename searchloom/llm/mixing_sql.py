"""The SQL twin of the mixing query: the same rounds, written out."""

from __future__ import annotations

from searchloom.llm import mixing

ROUNDS = 40


def twin() -> str:
    steps = [
        r"""f AS MATERIALIZED (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS t,
  CASE WHEN contains(t, '|') THEN 'table' WHEN contains(t, '@') THEN 'contact' WHEN contains(lower(t), 'licens') THEN 'notice'
       WHEN (length(t) - length(replace(t, chr(10), ''))) * 200 > length(t) THEN 'short lines' ELSE 'prose' END AS topic,
  CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens,
  CAST(CAST('0x' || substr(sha256('""" + mixing.SEED + r""":' || coalesce(CAST(doc_id AS VARCHAR), sha256(t))), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS chance
  FROM documents)""",
        "c AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM f GROUP BY ALL)",
    ]
    for d in mixing.DIMENSIONS:
        steps.append(f"g_{d} AS MATERIALIZED (SELECT {d}, pow(sum(tokens), {mixing.TEMPERATURE}) / sum(pow(sum(tokens), {mixing.TEMPERATURE})) OVER () AS goal FROM c GROUP BY {d} HAVING sum(tokens) > 0)")
    last = "(SELECT *, tokens AS w FROM c WHERE tokens > 0)"
    for i in range(ROUNDS):
        for d in mixing.DIMENSIONS:
            steps.append(f"r{i}_{d} AS MATERIALIZED (SELECT x.* EXCLUDE (w), w * goal / sum(w) OVER (PARTITION BY {d}) AS w FROM {last} AS x JOIN g_{d} USING ({d}))")
            last = f"r{i}_{d}"
    steps.append(f"p AS (SELECT source, lang, topic, CASE WHEN tokens > 0 THEN coalesce(w, 0) * ((SELECT sum(tokens) FROM c) * {mixing.FRACTION}) / tokens ELSE 1.0 END AS rate FROM c LEFT JOIN (SELECT source, lang, topic, w FROM {last}) USING (source, lang, topic))")
    return "WITH " + ",\n".join(steps) + "\nSELECT doc_id, source, lang, topic, n_tokens, round(least(rate, 1.0), 6) AS probability, round(greatest(rate, 1.0), 6) AS weight, chance < least(rate, 1.0) AS kept FROM f JOIN p USING (source, lang, topic)"
