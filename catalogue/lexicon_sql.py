"""The lexicon score as relational SQL: words, their neighbours by window, and a sum per text."""

from __future__ import annotations

from revlens.functions.vocab import BOOSTERS, LEXICON, NEGATORS


def _values(table: dict[str, float]) -> str:
    return ", ".join(f"('{word}', CAST({value} AS DOUBLE))" for word, value in table.items())


def induced_ctes(source: str, text: str, least: int, rounds: int, damping: float, faintest: float) -> str:
    """CTEs ending in `induced(w, v)`, the lexicon grown from the rows of `source`."""
    steps = ", ".join(
        f"""round{k}(w, v) AS (SELECT w, v FROM seeds UNION ALL SELECT s.a, sum(s.share * r.v) * {damping}
      FROM shares s JOIN round{k - 1} r ON r.w = s.b GROUP BY s.a)"""
        for k in range(1, rounds + 1)
    )
    return rf"""seeds(w, v) AS (VALUES {_values(LEXICON)}),
    read AS (SELECT row_number() OVER () AS id, regexp_extract_all(lower(regexp_replace({text}, '[''’]', '', 'g')), '[\p{{L}}\p{{N}}_]{{2,}}') AS ts FROM {source}),
    side AS (SELECT id, unnest(ts) AS w, generate_subscripts(ts, 1) AS i FROM read),
    met AS (SELECT w AS a, lead(w) OVER (PARTITION BY id ORDER BY i) AS b FROM side),
    pairs AS (SELECT least(a, b) AS a, greatest(a, b) AS b, count(*) AS n FROM met WHERE a <> b GROUP BY 1, 2 HAVING count(*) >= {least}),
    edges AS (SELECT a, b, n FROM pairs UNION ALL SELECT b, a, n FROM pairs),
    shares AS (SELECT a, b, n / CAST(sum(n) OVER (PARTITION BY a) AS DOUBLE) AS share FROM edges WHERE a NOT IN (SELECT w FROM seeds)),
    round0(w, v) AS (SELECT w, v FROM seeds), {steps},
    induced(w, v) AS (SELECT w, v FROM round{rounds} WHERE round(abs(v), 6) >= {faintest})"""


def compound_ctes(source: str, row_id: str, text: str, lexicon: str = "") -> str:
    """CTEs ending in `compounds(id, compound)` for the rows of `source`; `lexicon` names a table (w, v) in place of the built-in words."""
    words = f"lexicon(w, v) AS (SELECT w, v FROM {lexicon})" if lexicon else f"lexicon(w, v) AS (VALUES {_values(LEXICON)})"
    boosts = " + ".join(
        f"coalesce((SELECT v FROM boosters b WHERE b.w = p{d}), 0) * {damping}" for d, damping in ((1, 1.0), (2, 0.95), (3, 0.9))
    )
    negators = ", ".join(f"'{w}'" for w in NEGATORS)
    return rf"""{words}, boosters(w, v) AS (VALUES {_values(BOOSTERS)}),
    token_lists AS (SELECT {row_id} AS id, regexp_extract_all(lower(regexp_replace({text}, '[''’]', '', 'g')), '[\p{{L}}\p{{N}}_]{{2,}}') AS ts FROM {source}),
    tokens AS (SELECT id, unnest(ts) AS w, generate_subscripts(ts, 1) AS i FROM token_lists),
    buts AS (SELECT id, min(i) AS at FROM tokens WHERE w = 'but' GROUP BY id),
    near AS (SELECT id, i, w, lag(w, 1) OVER t AS p1, lag(w, 2) OVER t AS p2, lag(w, 3) OVER t AS p3 FROM tokens WINDOW t AS (PARTITION BY id ORDER BY i)),
    hits AS (SELECT n.*, l.v FROM near n JOIN lexicon l ON l.w = n.w),
    valued AS (SELECT h.id, (v + sign(v) * ({boosts}))
        * CASE WHEN p1 IN ({negators}) OR p2 IN ({negators}) OR p3 IN ({negators}) THEN -0.74 ELSE 1 END
        * CASE WHEN b.at IS NULL THEN 1 WHEN h.i < b.at THEN 0.5 WHEN h.i > b.at THEN 1.5 ELSE 1 END AS v
      FROM hits h LEFT JOIN buts b ON b.id = h.id),
    sums AS (SELECT id, sum(v) AS v FROM valued GROUP BY id),
    marks AS (SELECT {row_id} AS id, least(length({text}) - length(replace({text}, '!', '')), 4) AS bangs,
        length({text}) - length(replace({text}, '?', '')) AS asks FROM {source}),
    totals AS (SELECT m.id, coalesce(s.v, 0) + sign(coalesce(s.v, 0)) * (bangs * 0.292
        + CASE WHEN asks <= 1 THEN 0 WHEN asks <= 3 THEN asks * 0.18 ELSE 0.96 END) AS v FROM marks m LEFT JOIN sums s ON s.id = m.id),
    compounds AS (SELECT id, CAST(v AS DOUBLE) / sqrt(v * v + 15) AS compound FROM totals)"""
