"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_CLASSES = {
    "sentence": r"[.,;:!?''\"()\-]",
    "space": r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]",
    "lower": r"\p{Ll}",
    "upper": r"\p{Lu}",
    "letter": r"[\p{Lt}\p{Lm}\p{Lo}]",
    "mark": r"\p{M}",
    "digit": r"\p{N}",
    "punctuation": r"\p{P}",
    "symbol": r"\p{S}",
}


def _class_counts() -> str:
    """Characters of each class; a class gets what the ones before it left."""
    parts, seen = [], ""
    for name, pattern in _CLASSES.items():
        rest = f"regexp_replace(text, '{seen}', '', 'g')" if seen else "text"
        both = f"{seen}|{pattern}" if seen else pattern
        parts.append(f"length({rest}) - length(regexp_replace(text, '{both}', '', 'g')) AS c_{name}")
        seen = both
    parts.append(f"length(regexp_replace(text, '{seen}', '', 'g')) AS c_other")
    return ",\n    ".join(parts)


_NAMES = [*_CLASSES, "other"]

QUALITY = rf"""
WITH d AS (
  SELECT doc_id, lang, text, length(text) AS n_chars, regexp_extract_all(lower(text), '\p{{L}}+') AS ws FROM documents
), w AS (
  SELECT doc_id, lang, unnest(ws) AS w FROM d
), total AS (
  SELECT lang, count(*) AS n FROM w GROUP BY lang
), common AS (
  SELECT w.lang, w.w, count(*) / any_value(n)::DOUBLE AS q FROM w JOIN total USING (lang)
  GROUP BY w.lang, w.w HAVING count(*) >= 0.002::DOUBLE * any_value(n)
), other AS (
  SELECT lang, 1 - sum(q) AS q FROM common GROUP BY lang
), own AS (
  SELECT w.doc_id, w.lang, c.q, count(*)::DOUBLE AS k FROM w JOIN common c ON w.lang = c.lang AND w.w = c.w GROUP BY w.doc_id, w.lang, w.w, c.q
), hits AS (
  SELECT doc_id, sum(k) AS k FROM own GROUP BY doc_id
), bins AS (
  SELECT own.doc_id, own.q, own.k / len(d.ws) AS p FROM own JOIN d USING (doc_id)
  UNION ALL
  SELECT d.doc_id, o.q, (len(d.ws) - coalesce(h.k, 0)) / len(d.ws) FROM d JOIN other o USING (lang) LEFT JOIN hits h USING (doc_id)
  WHERE len(d.ws) > coalesce(h.k, 0)
), words AS (
  SELECT doc_id, sqrt(greatest(0, (sum(p * log2(p / ((p + q) / 2))) + sum(CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) + 1 - sum(q)) / 2)) AS js
  FROM bins GROUP BY doc_id
), ch AS (
  SELECT doc_id, lang, n_chars,
    {_class_counts()}
  FROM d
), long_ch AS (
  SELECT doc_id, lang, n_chars, unnest([{", ".join(f"'{n}'" for n in _NAMES)}]) AS cls, unnest([{", ".join(f"c_{n}" for n in _NAMES)}]) AS k FROM ch
), ref_ch AS (
  SELECT lang, cls, sum(k) / (sum(sum(k)) OVER (PARTITION BY lang))::DOUBLE AS q FROM long_ch GROUP BY lang, cls
), chars AS (
  SELECT doc_id, sqrt(greatest(0, sum(CASE WHEN k > 0 THEN k / n_chars::DOUBLE * log2(k / n_chars::DOUBLE / ((k / n_chars::DOUBLE + q) / 2)) ELSE 0 END
     + CASE WHEN q > 0 THEN q * log2(q / ((k / n_chars::DOUBLE + q) / 2)) ELSE 0 END) / 2)) AS js
  FROM long_ch JOIN ref_ch USING (lang, cls) WHERE n_chars > 0 GROUP BY doc_id
), m AS (
  SELECT d.doc_id, d.lang, d.n_chars, len(d.ws)::BIGINT AS n_words,
    CASE WHEN d.n_chars >= 100 AND t.n >= 1000 THEN c.js END AS jc, CASE WHEN len(d.ws) >= 50 AND t.n >= 1000 THEN x.js END AS jw
  FROM d LEFT JOIN total t USING (lang) LEFT JOIN chars c USING (doc_id) LEFT JOIN words x USING (doc_id)
)
SELECT doc_id, lang, n_chars, n_words, round(jc, 6) AS js_chars, round(jw, 6) AS js_words, true AS keep FROM m
WHERE NOT coalesce(jc > 0.17 + 1.2 / sqrt(n_chars), false) AND NOT coalesce(jw > 0.17 + 2.2 / sqrt(n_words), false)
"""

NGRAM_JOIN = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[^\x00-\x2f\x3a-\x60\x7b-\x7f]+') AS ws FROM documents WHERE doc_id IS NOT NULL
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) ELSE [array_to_string(ws, ' ')] END) AS gram
  FROM d WHERE len(ws) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), link AS MATERIALIZED (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE k >= 0.51 * (x.n + y.n - k) - 1e-9
), reach AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b
), root AS (
  SELECT a AS doc_id, min(b) AS least FROM reach GROUP BY a
), degree AS (
  SELECT a AS doc_id, count(*) AS n_links FROM link GROUP BY a
)
SELECT doc_id, least(doc_id, coalesce(least, doc_id)) AS class_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL) LEFT JOIN root USING (doc_id) LEFT JOIN degree USING (doc_id)
"""


def _substrings(base: int = 50, depth: int = 12) -> str:
    """Levels of windows of base, 2 base, ... words; a level without windows ends them."""
    levels, longest = [], []
    for k in range(1, depth):
        n = base << k
        levels.append(
            f""", c{k} AS MATERIALIZED (
  SELECT a.doc_id, a.p, md5(a.h || b.h) AS h FROM r{k - 1} a JOIN r{k - 1} b ON b.doc_id = a.doc_id AND b.p = a.p + {n // 2}
), r{k} AS MATERIALIZED (
  SELECT * FROM c{k} WHERE h IN (SELECT h FROM c{k} GROUP BY h HAVING count(DISTINCT doc_id) > 1)
)"""
        )
        longest.append(f"SELECT doc_id, p, {n} AS n FROM r{k}")
    return rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[^\x00-\x2f\x3a-\x60\x7b-\x7f]+') AS ws FROM documents WHERE doc_id IS NOT NULL
), c0 AS MATERIALIZED (
  SELECT doc_id, p, md5(array_to_string(ws[p + 1 : p + {base}], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - {base} + 1)) AS p FROM d WHERE len(ws) >= {base})
), r0 AS MATERIALIZED (
  SELECT * FROM c0 WHERE h IN (SELECT h FROM c0 GROUP BY h HAVING count(DISTINCT doc_id) > 1)
){"".join(levels)}, every AS (
  SELECT doc_id, p, {base} AS n FROM r0 UNION ALL {" UNION ALL ".join(longest)}
), hit AS (
  SELECT doc_id, p, max(n) AS n FROM every GROUP BY doc_id, p
), cut AS (
  SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {base} THEN 0 ELSE 1 END AS new FROM hit
), span AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM cut
)
SELECT doc_id, min(p) AS start_word, max(p) + {base} AS end_word, max(n)::INTEGER AS longest FROM span GROUP BY doc_id, k
"""


SUBSTRINGS = _substrings()


def _fill(name: str, parent: str, source: str) -> str:
    """CTEs that share ``budget`` of the rows of ``source`` among children; ``parent``: columns of the parent."""
    return f"""
{name}_w AS (
  SELECT *, CASE WHEN sum(weight) OVER (PARTITION BY {parent}) > 0 THEN weight ELSE 1.0 END AS w FROM {source}
), {name}_r AS (
  SELECT *, CASE WHEN w > 0 THEN capacity / w ELSE 'inf'::DOUBLE END AS ratio FROM {name}_w
), {name}_l AS (
  SELECT *, (budget - coalesce(sum(capacity) OVER (PARTITION BY {parent} ORDER BY ratio, name NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / nullif(sum(w) OVER (PARTITION BY {parent} ORDER BY ratio, name NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS lv FROM {name}_r
), {name}_m AS (
  SELECT *, max(CASE WHEN ratio > lv THEN lv END) OVER (PARTITION BY {parent}) AS level FROM {name}_l
), {name} AS (
  SELECT *, floor(CASE WHEN level IS NULL THEN CASE WHEN w > 0 THEN capacity ELSE 0 END ELSE least(capacity::DOUBLE, greatest(level, 0) * w) END)::BIGINT AS quota FROM {name}_m
)"""


MIXTURE = rf"""
WITH docs AS (
  SELECT doc_id, ['web', 'reference', 'forum', 'archive'][coalesce(try_cast(nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '') AS INTEGER), 0) % 4 + 1] AS domain, lang, source,
    len(regexp_extract_all(text, '[^\x09-\x0d\x20]+'))::BIGINT AS tokens FROM documents
), leaves AS (
  SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens, sum(tokens)::BIGINT * 3 AS capacity FROM docs GROUP BY domain, lang, source
), in_d AS (
  SELECT domain, domain AS name, sum(capacity)::BIGINT AS capacity, (SELECT floor(sum(tokens) * 0.6::DOUBLE)::BIGINT FROM leaves) AS budget, 1 AS top,
    CASE domain WHEN 'web' THEN 4.0 WHEN 'reference' THEN 3.0 WHEN 'forum' THEN 2.0 ELSE 1.0 END::DOUBLE AS weight FROM leaves GROUP BY domain
), {_fill("q_d", "top", "in_d")}, in_l AS (
  SELECT l.domain, l.lang, l.lang AS name, sum(l.capacity)::BIGINT AS capacity, any_value(q.quota) AS budget,
    CASE l.lang WHEN 'en' THEN 6.0 WHEN 'de' THEN 1.5 WHEN 'fr' THEN 1.5 ELSE 1.0 END::DOUBLE AS weight
  FROM leaves l JOIN q_d q ON l.domain IS NOT DISTINCT FROM q.domain GROUP BY l.domain, l.lang
), {_fill("q_l", "domain", "in_l")}, in_s AS (
  SELECT l.domain, l.lang, l.source, l.source AS name, l.tokens, l.capacity, q.quota AS budget, 1.0::DOUBLE AS weight
  FROM leaves l JOIN q_l q ON l.domain IS NOT DISTINCT FROM q.domain AND l.lang IS NOT DISTINCT FROM q.lang
), {_fill("q_s", "domain, lang", "in_s")}, leaf AS (
  SELECT domain, lang, source, quota // tokens AS whole, quota % tokens AS rest FROM q_s WHERE tokens > 0
), epochs AS (
  SELECT d.doc_id, d.domain, d.lang, d.source, d.tokens, l.whole, l.rest, unnest(range(0, l.whole + 1)) AS epoch
  FROM docs d JOIN leaf l ON d.domain IS NOT DISTINCT FROM l.domain AND d.lang IS NOT DISTINCT FROM l.lang AND d.source IS NOT DISTINCT FROM l.source WHERE d.tokens > 0
), run AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source, epoch ORDER BY md5(concat_ws(':', '17', epoch::VARCHAR, coalesce(doc_id::VARCHAR, '')))) AS upto FROM epochs
)
SELECT doc_id, epoch::INTEGER AS epoch, domain, lang, source, tokens AS n_tokens FROM run WHERE epoch < whole OR upto <= rest
"""


TOPK = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL
), d AS (
  SELECT a.vec_id, b.vec_id AS neighbour_id, round(list_distance(a.e, b.e), 9) AS d FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, neighbour_id) AS rank FROM d
)
SELECT vec_id, neighbour_id, rank::INTEGER AS rank, round(d, 6) AS distance FROM r WHERE rank <= 10
"""
