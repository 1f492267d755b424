"""SQL for DuckDB that gives the rows of registered queries by other means than the operators."""

from __future__ import annotations

from revlens.llm import collocations, license_scan, mixing
from revlens.llm.common import LOWER, UPPER

SPACED = r"[^\x20\x09-\x0D]+"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _license_scan() -> str:
    word = license_scan.WORD
    places, marks = [], []
    for phrase, label in license_scan.PHRASES:
        wanted = license_scan.words(phrase)
        places.append(f"list_transform(list_filter(range(1, len(ws) - {len(wanted)} + 2), lambda i: ws[i:i + {len(wanted) - 1}] = {_list(wanted)}), lambda i: {{'at': i - 1, 'label': '{label}'}})")
    for label, body in license_scan.TEMPLATES:
        wanted = sorted(set(license_scan.words(body)))
        need = -(-len(wanted) * round(license_scan.THRESHOLD * 1000) // 1000)
        marks.append(f"CASE WHEN len(list_intersect(s, {_list(wanted)})) >= {need} THEN {{'share': len(list_intersect(s, {_list(wanted)})) / {len(wanted)}, 'label': '{label}'}} END")
    return rf"""WITH d AS (SELECT doc_id, coalesce(translate(text, '{UPPER}', '{LOWER}'), '') AS t FROM documents),
    w AS (SELECT doc_id, regexp_extract_all(t, '{word}') AS ws FROM d),
    b AS (SELECT doc_id, len(ws) AS n_words, flatten([{", ".join(places)}]) AS hits FROM w),
    lines AS (SELECT doc_id, list_distinct(regexp_extract_all(unnest(string_split(t, chr(10))), '{word}')) AS s FROM d),
    m AS (SELECT doc_id, unnest([{", ".join(marks)}]) AS hit FROM lines),
    f AS (SELECT doc_id, list(DISTINCT hit.label) AS own, max(hit.share) AS score FROM m WHERE hit IS NOT NULL GROUP BY doc_id)
    SELECT b.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(hits) AS BIGINT) AS n_base,
      list_min(list_transform(hits, lambda h: h.at)) AS first_word, list_max(list_transform(hits, lambda h: h.at)) AS last_word,
      coalesce(array_to_string(list_sort(list_distinct(list_transform(hits, lambda h: h.label))), ','), '') AS base_labels,
      coalesce(array_to_string(list_sort(list_distinct(list_concat(list_transform(hits, lambda h: h.label), coalesce(f.own, [])))), ','), '') AS labels,
      coalesce(f.score, 0.0) AS score
    FROM b LEFT JOIN f ON f.doc_id = b.doc_id"""


def _license_windows() -> str:
    word = license_scan.WORD
    places, marks = [], []
    for phrase, label in license_scan.PHRASES:
        wanted = license_scan.words(phrase)
        places.append(f"list_transform(list_filter(range(1, len(ws) - {len(wanted)} + 2), lambda i: ws[i:i + {len(wanted) - 1}] = {_list(wanted)}), lambda i: {{'at': i - 1, 'label': '{label}'}})")
    for label, body in license_scan.TEMPLATES:
        notice = license_scan.words(body)
        wanted = sorted(set(notice))
        need = -(-len(wanted) * round(license_scan.THRESHOLD * 1000) // 1000)
        length = -(-len(notice) * 1000 // round(license_scan.THRESHOLD * 1000))
        starts = f"range(1, greatest(1, len(ws) - {length - 1}) + 1)"
        # no window has a template's words if the whole text has not
        best = f"list_max(list_transform({starts}, lambda i: len(list_intersect(ws[i:i + {length - 1}], {_list(wanted)}))))"
        marks.append(f"SELECT doc_id, '{label}' AS label, {need} AS need, {len(wanted)} AS size, {best} AS common FROM w WHERE len(list_intersect(ws, {_list(wanted)})) >= {need}")
    return rf"""WITH d AS (SELECT doc_id, coalesce(translate(text, '{UPPER}', '{LOWER}'), '') AS t FROM documents),
    w AS (SELECT doc_id, regexp_extract_all(t, '{word}') AS ws FROM d),
    b AS (SELECT doc_id, len(ws) AS n_words, flatten([{", ".join(places)}]) AS hits FROM w),
    m AS ({" UNION ALL ".join(marks)}),
    f AS (SELECT doc_id, list(DISTINCT label) AS own, max(common / size) AS score FROM m WHERE common >= need GROUP BY doc_id)
    SELECT b.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(hits) AS BIGINT) AS n_base,
      list_min(list_transform(hits, lambda h: h.at)) AS first_word, list_max(list_transform(hits, lambda h: h.at)) AS last_word,
      coalesce(array_to_string(list_sort(list_distinct(list_transform(hits, lambda h: h.label))), ','), '') AS base_labels,
      coalesce(array_to_string(list_sort(list_distinct(list_concat(list_transform(hits, lambda h: h.label), coalesce(f.own, [])))), ','), '') AS labels,
      coalesce(f.score, 0.0) AS score
    FROM b LEFT JOIN f ON f.doc_id = b.doc_id"""


def _jaccard() -> str:
    return rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(translate(text, '{UPPER}', '{LOWER}'), ''), '{SPACED}') AS ws FROM documents),
    sets AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
      ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS s FROM w),
    every AS (SELECT doc_id, unnest(s) AS x FROM sets),
    common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM every a JOIN every b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT c.a, c.b FROM common c JOIN sets x ON x.doc_id = c.a JOIN sets y ON y.doc_id = c.b WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)),
    either_way AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT DISTINCT a AS node, a AS other FROM either_way UNION SELECT r.node, e.b FROM reach r JOIN either_way e ON e.a = r.other),
    least AS (SELECT node, min(other) AS m FROM reach GROUP BY node)
    SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(l.m, s.doc_id) AS component_id FROM sets s LEFT JOIN least l ON l.node = s.doc_id"""


def _mix() -> str:
    block, repeats = mixing.BLOCK, mixing.REPEATS
    return rf"""WITH slim AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{SPACED}')) AS BIGINT) AS size, md5(CAST(doc_id AS VARCHAR)) AS mark FROM documents),
    found AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number FROM slim GROUP BY source),
    weighed AS (SELECT *, CAST([{", ".join(map(str, mixing.WEIGHTS))}][number % {len(mixing.WEIGHTS)} + 1] AS DOUBLE) AS weight, CAST(source_size * {repeats} AS DOUBLE) AS cap FROM found),
    levels AS (SELECT *, ((SELECT sum(source_size) FROM found) * CAST({mixing.SHARE} AS DOUBLE) - coalesce(sum(cap) OVER (ORDER BY cap / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY cap / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
    goals AS (SELECT source, source_size, number, least(cap, coalesce(weight * (SELECT max(level) FROM levels WHERE cap / weight >= level), cap)) AS target FROM levels),
    ends AS (SELECT *, CAST(round(sum(target) OVER (ORDER BY number) / (SELECT sum(target) FROM goals) * 4294967296) AS BIGINT) AS high FROM goals),
    ranges AS (SELECT *, coalesce(lag(high) OVER (ORDER BY number), 0) AS low FROM ends),
    drawn AS (SELECT slot, (slot % 2147483648) * {mixing.GOLDEN} % 4294967296 AS point FROM (SELECT unnest(range(CAST((SELECT round(sum(target) / {block}) FROM goals) AS BIGINT))) AS slot)),
    ranked AS (SELECT r.number, r.source_size, row_number() OVER (PARTITION BY r.number ORDER BY d.slot) - 1 AS rank FROM drawn d JOIN ranges r ON d.point >= r.low AND d.point < r.high),
    times AS (SELECT number, rank % ((source_size + {block - 1}) // {block}) AS block, count(*) AS n FROM ranked WHERE rank < (source_size + {block - 1}) // {block} * {repeats} GROUP BY ALL),
    placed AS (SELECT s.*, g.number, g.source_size, g.target,
      coalesce(sum(size) OVER (PARTITION BY g.number ORDER BY CAST('0x' || substr(mark, 1, 4) AS INT) % {mixing.CHUNKS}, mark, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
      FROM slim s JOIN goals g ON g.source IS NOT DISTINCT FROM s.source),
    cells AS (SELECT doc_id, number, first, size, unnest(range(CAST(first // {block} AS BIGINT), CAST((first + size - 1) // {block} AS BIGINT) + 1)) AS block FROM placed WHERE size > 0),
    words AS (SELECT c.doc_id, sum((least(c.first + c.size, (c.block + 1) * {block}) - greatest(c.first, c.block * {block})) * t.n) AS taken
      FROM cells c JOIN times t ON t.number = c.number AND t.block = c.block GROUP BY ALL)
    SELECT p.doc_id, p.source, p.size, p.source_size, p.target, CAST(coalesce(w.taken, 0) AS BIGINT) AS taken FROM placed p LEFT JOIN words w ON w.doc_id = p.doc_id"""


def _repair() -> str:
    def step(label: str, cost: str, edit: str, line: str = "''", when: str = "true") -> str:
        return f"CASE WHEN {label} IS NOT NULL AND {when} THEN {{'c': {label}.c + {cost}, 'a': {label}.a || '{edit}', 't': {label}.t || {line}}} END"

    def least(*labels: str) -> str:
        return f"list_min([{', '.join(labels)}])"

    bits = ", ".join(["CAST(0 AS BIGINT)"] * 8)
    kept = "chr(10) || x.role || ':' || x.text"
    user, assistant = "chr(10) || 'user:' || x.text", "chr(10) || 'assistant:' || x.text"
    empty_user, empty_assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    to_user = [y for state in ("l0", "l1", "l3") for y in (step(state, "x.extra", "K", kept, "x.free AND x.initial = 'u'"), step(state, "2 + x.extra", "R", user, "x.free"))]
    read = {
        "r0": step("l0", "3", "D"),
        "r1": least(step("l1", "3", "D"), step("l0", "x.extra", "K", kept, "x.free AND x.initial = 's'")),
        "r2": least(step("l2", "3", "D"), *to_user),
        "r3": least(step("l3", "3", "D"), step("l2", "x.extra", "K", kept, "x.free AND x.initial = 'a'"), step("l2", "2 + x.extra", "R", assistant, "x.free")),
    }
    inserted = least("r2", *(step(state, "2", "I", empty_user) for state in ("r0", "r1", "r3")))
    return rf"""WITH RECURSIVE keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
    marked AS (SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, CAST(i AS INT), 1)) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [{bits}]), lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 20 AS kind FROM keyed),
    rows AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
      unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM marked WHERE kind <> 0),
    placed AS (SELECT conv_id, turn, role, text, left(role, 1) AS initial, regexp_extract_all(text, '[^ 	-
]') AS inked, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM rows),
    judged AS (SELECT *, CASE WHEN len(inked) = 0 THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate' WHEN inked[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
      lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair FROM placed),
    x AS (SELECT conv_id, pos, role, text, initial, fault IN ('', 'truncated') AS free, CAST(fault = 'truncated' AS BIGINT) AS extra FROM judged),
    walk AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, {{'c': CAST(0 AS BIGINT), 'a': '', 't': ''}} AS l0, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS l1,
        {{'c': CAST(2 AS BIGINT), 'a': 'I', 't': {empty_user}}} AS l2, {{'c': CAST(4 AS BIGINT), 'a': 'II', 't': {empty_user} || {empty_assistant}}} AS l3 FROM conversations
      UNION ALL SELECT conv_id, pos, r0, r1, l2, {least("r3", step("l2", "2", "I", empty_assistant))} FROM (SELECT conv_id, pos, r0, r1, r3, {inserted} AS l2 FROM
        (SELECT w.conv_id, x.pos, {", ".join(f"{e} AS {n}" for n, e in read.items())} FROM walk w JOIN x ON x.conv_id IS NOT DISTINCT FROM w.conv_id AND x.pos = w.pos + 1))),
    ends AS (SELECT conv_id, arg_max(least_of, pos) AS found FROM (SELECT conv_id, pos, {least("l0", "l3")} AS least_of FROM walk) GROUP BY conv_id),
    stats AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
      count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
    SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
      found.c AS cost, found.a AS audit, sha256(substr(found.t, 2)) AS repaired_sha256 FROM ends e LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM e.conv_id"""


def _collocations() -> str:
    least, longest, top = collocations.LEAST, collocations.LONGEST, collocations.TOP
    return rf"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, coalesce(translate(text, '{UPPER}', '{LOWER}'), '') AS t FROM documents),
    p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS s FROM d),
    w AS (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS ws FROM p),
    totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
    runs AS (SELECT lang, unnest(flatten(list_transform(range(1, {longest + 1}), lambda k: list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])))) AS x FROM w),
    f AS (SELECT lang, x, len(x) AS k, count(*) AS a FROM runs GROUP BY lang, x HAVING count(*) >= {least}),
    c AS (SELECT * FROM f WHERE k >= 2),
    inner_runs AS (SELECT lang, a, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda i: x[i:i + m - 1])))) AS x FROM c),
    covered AS (SELECT DISTINCT c.lang, c.x FROM c JOIN inner_runs i ON i.lang = c.lang AND i.x = c.x WHERE 100 * i.a >= 100 * c.a),
    kept AS (SELECT c.* FROM c ANTI JOIN covered v ON v.lang = c.lang AND v.x = c.x),
    cuts AS (SELECT *, unnest(range(1, k)) AS j FROM kept),
    scored AS (SELECT u.lang, u.x, u.a, u.j, g.a AS l, h.a AS r, t.n, CAST(CAST(1000 AS HUGEINT) * u.a * t.n // (CAST(g.a AS HUGEINT) * h.a) AS BIGINT) AS score
      FROM cuts u JOIN f g ON g.lang = u.lang AND g.x = u.x[1:u.j] JOIN f h ON h.lang = u.lang AND h.x = u.x[u.j + 1:] JOIN totals t ON t.lang = u.lang),
    lowest AS (SELECT lang, array_to_string(x, ' ') AS phrase, a, l, r, n, score FROM scored QUALIFY row_number() OVER (PARTITION BY lang, x ORDER BY score, j) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM lowest QUALIFY rank <= {top}"""


ORACLES: dict[str, str] = {"op1_license_scan": _license_scan(), "op1_license_windows": _license_windows(), "op5_ngram_jaccard": _jaccard(), "op10_source_mix": _mix(), "op11_conversation_repair": _repair(), "op13_collocations": _collocations()}
