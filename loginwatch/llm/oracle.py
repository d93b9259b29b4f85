"""DuckDB SQL for the text queries that SQL can express.

Written from the contracts and methods, in another shape than the Spark plans.
"""

from __future__ import annotations

from loginwatch.llm import pii, quality_rules, url_filters
from loginwatch.llm.decontamination import WINDOW

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _folded(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


_CONTAMINATION_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_DECONTAMINATION = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_folded('text')}, {_CONTAMINATION_WORD}) AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all({_folded('text')}, {_CONTAMINATION_WORD}) AS w FROM benchmark),
    wins AS (SELECT DISTINCT item_id, m, w[i:i + m - 1] AS win
             FROM (SELECT item_id, w, least({WINDOW}, len(w)) AS m, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS i
                   FROM b WHERE len(w) > 0)),
    spots AS (SELECT r, m, i, w[i:i + m - 1] AS win
              FROM (SELECT r, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM wins))),
    hits AS (SELECT s.r, s.i, s.m, wins.item_id FROM spots s JOIN wins USING (m, win)),
    covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + m)) AS p FROM hits) GROUP BY r),
    named AS (SELECT r, count(DISTINCT item_id) AS n,
                     string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
              FROM hits WHERE item_id IS NOT NULL GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256,
           coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""

_TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
_LEXICAL = f"""
    WITH q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_folded('text')}, {_TERM})) AS t FROM benchmark),
    d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_folded('text')}, {_TERM}) AS w FROM documents),
    total AS (SELECT count(*) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM d WHERE len(w) > 0),
    held AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, t),
    weights AS (SELECT t, CAST(floor(1000 * ln((2 * max(big_n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
                FROM held, total GROUP BY t),
    parts AS (SELECT r, t, weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(w) * big_n) // big_l))) AS part
              FROM held JOIN weights USING (t) JOIN d USING (r), total),
    scored AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM q JOIN parts USING (t)
               JOIN d USING (r) GROUP BY item_id, r, doc_id)
    SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
    WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)
    QUALIFY row_number() OVER best <= 50"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_QUINTET = " || ".join(f"substr('{_BASE32}', ((v >> {s}) & 31) + 1, 1)" for s in (15, 10, 5, 0))
_WARC = f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
    placed AS (SELECT *, row_number() OVER same AS place, first_value(page_id) OVER same AS first
               FROM p WINDOW same AS (PARTITION BY html ORDER BY page_id NULLS LAST))
    SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
           array_to_string([{_QUINTET} FOR v IN [CAST('0x' || substr(hex, 5 * k + 1, 5) AS INTEGER) FOR k IN range(8)]], '') AS payload_digest,
           CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN place > 1 THEN first END AS refers_to
    FROM placed"""


def _quality() -> str:
    """The rules, the certification of their steps and the verdicts."""
    space = r"'[\x20\x09-\x0D]+'"
    rules = quality_rules.RULES
    ever = [f"[{', '.join(f'{r.sign} * ({r.measure}) > {c}' for c in r.cutoffs)}]" for r in rules]
    # The first cutoff, from lenient to strict, that rejects.
    step = "least(" + ", ".join(f"nullif(list_position({e}, true), 0)" for e in ever) + ")"
    last = max(len(r.cutoffs) for r in rules)
    share = quality_rules.MAX_FALSE_REJECTION
    tail = f"""CASE WHEN good >= {share} * n_good THEN 1 ELSE
                         list_sum([exp(lgamma(n_good + 1) - lgamma(j + 1) - lgamma(n_good - j + 1)
                         + j * ln({share}) + (n_good - j) * ln(1 - {share})) FOR j IN range(0, CAST(good AS BIGINT) + 1)]) END"""
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, list_filter(string_split_regex(text, {space}), lambda x: x <> '') AS words,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
    windows AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
                FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
    again AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
    repeated AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r),
    m AS (SELECT w.r, doc_id, stratum, CAST(len(words) AS BIGINT) AS n_words,
                 CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
                 CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                 CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
                 len(list_distinct(words)) AS n_distinct_words, len(lines) AS n_lines
          FROM w LEFT JOIN repeated USING (r)),
    f AS (SELECT *, {quality_rules.BASE_FAILED} AS base_failed, {step} AS step FROM m),
    marks AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
    held AS (SELECT stratum, quality, step FROM f JOIN marks USING (doc_id) WHERE NOT base_failed),
    tests AS (SELECT stratum, t, count(*) FILTER (quality = 1) AS n_good, count(*) FILTER (quality <> 1) AS n_bad,
                     count(*) FILTER (quality = 1 AND step <= t) AS good, count(*) FILTER (quality <> 1 AND step <= t) AS bad
              FROM held, range(1, {last} + 1) AS steps(t) GROUP BY stratum, t),
    passed AS (SELECT *, bool_and({tail} <= {quality_rules.ERROR} / (SELECT count(DISTINCT stratum) FROM held))
                         OVER (PARTITION BY stratum ORDER BY t) AS ok,
                      bad / greatest(n_bad, 1) - {quality_rules.HARM} * good / greatest(n_good, 1) AS gain FROM tests),
    chosen AS (SELECT stratum, max_by(t, (gain, -t)) AS t FROM passed WHERE ok AND bad > 0 AND gain > 0 GROUP BY stratum)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT coalesce(step <= t, false) AS kept
    FROM f LEFT JOIN chosen USING (stratum)"""


def _urls() -> str:
    """Rules, models of both classes by joins per order, scores and the threshold."""
    a, start, orders = url_filters.ALPHABET, url_filters.START, url_filters.ORDER
    known = _LOWER + "0" + url_filters.MARKS
    fits = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{{{k}}}'"
        for k, r in enumerate(sorted(url_filters.RULES, key=lambda r: -len(r.name)))
    )
    ordered = sorted(url_filters.RULES, key=lambda r: -len(r.name))
    rule = "CASE " + fits.format(*[r.name for r in ordered]) + " END"
    verdict = "CASE " + fits.format(*[r.verdict for r in ordered]) + " END"
    ctes = []
    for k in range(orders + 1):
        ctes.append(f"""n{k} AS (SELECT c // {a} % {a ** k} AS ctx, c % {a} AS sym, count(*) FILTER (accepted) AS good,
                                 count(*) FILTER (NOT accepted) AS bad FROM grams WHERE NOT held_out GROUP BY ALL),
        t{k} AS (SELECT ctx, sum(good) AS good, sum(bad) AS bad FROM n{k} GROUP BY ctx HAVING sum(good + bad) >= {url_filters.MIN_CONTEXT if k else 0})""")
    steps = [f"p_1 AS (SELECT DISTINCT c, 1.0::DOUBLE / {a} AS g, 1.0::DOUBLE / {a} AS b FROM every)"]
    for k in range(orders + 1):
        before = f"p_{k + 1}"
        one = f"(coalesce(n.{{0}}, 0) + {url_filters.BACKOFF} * p.{{1}}) / (t.{{0}} + {url_filters.BACKOFF})"
        absent = f"CASE WHEN t.ctx IS NULL THEN {{1}} ELSE {one} END"
        none = f"{url_filters.BACKOFF} * p.{{1}} / {url_filters.BACKOFF}" if k == 0 else "p.{1}"
        steps.append(f"""p_{k + 2} AS (SELECT p.c, {absent.format('good', 'p.g')} AS g, {absent.format('bad', 'p.b')} AS b
            FROM {before} p LEFT JOIN t{k} t ON t.ctx = p.c // {a} % {a ** k}
            LEFT JOIN n{k} n ON n.ctx = p.c // {a} % {a ** k} AND n.sym = p.c % {a})""".replace("p.p.", "p."))
    bins, reach = url_filters.BINS, url_filters.RANGE
    return f"""
    WITH u AS (SELECT row_number() OVER () AS r, page_id, url,
                      CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    h AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
    j AS (SELECT *, {rule} AS rule, {verdict} AS rule_verdict FROM h),
    chars AS (SELECT r, rule_verdict, url, [CASE WHEN strpos('{known}', x) > 0 THEN strpos('{known}', x) - 1 ELSE {url_filters.OTHER} END
                     FOR x IN string_split(regexp_replace(lower(url), '[0-9]', '0', 'g'), '')] AS s
              FROM j WHERE url <> ''),
    padded AS (SELECT *, list_concat([{', '.join([str(start)] * orders)}], s) AS q FROM chars),
    every AS (SELECT r, rule_verdict, url, {' + '.join(f'CAST(q[i + {k}] AS BIGINT) * {a ** (orders - k)}' for k in range(orders + 1))} AS c
              FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM padded)),
    grams AS (SELECT c, rule_verdict = 'allow' AS accepted, {_fifth('url')} AS held_out FROM every WHERE rule_verdict IS NOT NULL),
    {', '.join(ctes)},
    {', '.join(steps)},
    scores AS (SELECT e.r, sum(log2(p.g) - log2(p.b)) / count(*) AS score FROM every e JOIN p_{orders + 2} p USING (c) GROUP BY e.r),
    labelled AS (SELECT coalesce(score, 0) AS score, rule_verdict = 'allow' AS accepted
                 FROM j LEFT JOIN scores USING (r) WHERE rule_verdict IS NOT NULL AND {_fifth('url')}),
    bins AS (SELECT greatest(0, least({bins}, CAST(floor((score + {reach}) * {bins / (2 * reach)}) AS INTEGER))) AS bin,
                    count(*) FILTER (accepted) AS good, count(*) FILTER (NOT accepted) AS bad FROM labelled GROUP BY bin),
    sums AS (SELECT bin, bin * {2 * reach / bins} - {reach} AS edge,
                    1 - (sum(good) OVER below - good) / sum(good) OVER () + (sum(bad) OVER below - bad) / sum(bad) OVER () AS balance
             FROM bins WHERE (SELECT sum(good) > 0 AND sum(bad) > 0 FROM bins) WINDOW below AS (ORDER BY bin)),
    cut AS (SELECT coalesce((SELECT edge FROM sums ORDER BY balance DESC, abs(edge), edge DESC LIMIT 1), 0) AS cut)
    SELECT page_id, host, path, rule,
           coalesce(rule_verdict, CASE WHEN coalesce(score, 0) >= (SELECT cut FROM cut) THEN 'allow' ELSE 'block' END) AS verdict
    FROM j LEFT JOIN scores USING (r)"""


def _fifth(column: str) -> str:
    return f"CAST('0x' || substr(md5(coalesce({column}, '')), 1, 7) AS INTEGER) % 5 = 0"


def _placed(text: str, pattern: str, keep: str, more: str, source: str) -> str:
    """Matches of a pattern with their places, by adding up what lies before them."""
    return f"""
        SELECT {keep}, m[i] AS value,
               CAST(list_sum([length(x) FOR x IN g[1:i]]) + coalesce(list_sum([length(x) FOR x IN m[1:i - 1]]), 0) AS BIGINT) AS start
        FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i
              FROM (SELECT {keep}, regexp_extract_all({text}, '{pattern}') AS m, string_split_regex({text}, '{pattern}') AS g
                    FROM {source} {more}))"""


def _pii() -> str:
    patterns = (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        r"[0-9](?:[\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    )
    term = r"[\p{L}\p{N}]{3,}"
    found = " UNION ALL ".join(
        f"SELECT {k} AS kind, * FROM ({_placed('text', x, 'r', '', 'd')})" for k, x in enumerate(patterns)
    )
    digits = "regexp_replace(value, '[^0-9]', '', 'g')"
    luhn = f"""list_sum([CASE WHEN i % 2 = 0 THEN (CASE WHEN 2 * CAST(c AS INTEGER) > 9 THEN 2 * CAST(c AS INTEGER) - 9
                              ELSE 2 * CAST(c AS INTEGER) END) ELSE CAST(c AS INTEGER) END
                         FOR c, i IN string_split(reverse({digits}), '')]) % 10 = 0"""
    near = pii.NEAR
    names = "['" + "', '".join(pii.KINDS) + "']"
    listed = f"string_agg({names}[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind)"
    counts = ", ".join(f"count(*) FILTER (kind = {k}) AS n_{pii.KINDS[k]}" for k in pii.BASE)
    totals = ", ".join(f"coalesce(n_{pii.KINDS[k]}, 0) AS n_{pii.KINDS[k]}" for k in pii.BASE)
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    raw AS ({found}),
    base AS (SELECT r, kind, value, start, start + length(value) AS stop FROM raw
             WHERE CASE kind WHEN 1 THEN list_bool_and([length(ltrim(p, '0')) <= 3 AND coalesce(TRY_CAST(nullif(ltrim(p, '0'), '') AS INTEGER), 0) <= 255
                                                        FOR p IN string_split(value, '.')])
                             WHEN 2 THEN length({digits}) BETWEEN 14 AND 19 AND {luhn}
                             WHEN 3 THEN length({digits}) BETWEEN 10 AND 15 ELSE true END),
    edges AS (SELECT *, greatest(start - {pii.REACH}, coalesce(lag(stop) OVER o, 0), 0) AS left_end,
                     least(stop + {pii.REACH}, coalesce(lead(start) OVER o, stop + {pii.REACH})) AS right_end
              FROM base WINDOW o AS (PARTITION BY r ORDER BY start, kind)),
    sides AS (SELECT r, {names}[kind + 1] || ':' || value AS entity, kind, start AS spot, left_end, stop,
                     CASE WHEN start > left_end THEN substr(text, left_end + 1, start - left_end) ELSE '' END AS before,
                     CASE WHEN right_end > stop THEN substr(text, stop + 1, right_end - stop) ELSE '' END AS after,
                     CASE WHEN right_end > left_end THEN substr(text, left_end + 1, right_end - left_end) ELSE '' END AS around
              FROM edges JOIN d USING (r)),
    lefts AS (SELECT r, entity, kind, spot, around, lower(value) AS term, start + left_end AS start, start + left_end + length(value) AS stop
              FROM ({_placed('before', term, 'r, entity, kind, spot, around, left_end, before', '', 'sides')})
              WHERE start > 0 OR left_end = 0 OR length(before) < {pii.REACH}
              QUALIFY row_number() OVER (PARTITION BY r, kind, spot ORDER BY start DESC) <= {near}),
    rights AS (SELECT r, entity, kind, spot, around, lower(value) AS term, start + stop AS start, start + stop + length(value) AS stop
               FROM ({_placed('after', term, 'r, entity, kind, spot, around, stop', '', 'sides')})
               WHERE start + length(value) < {pii.REACH}
               QUALIFY row_number() OVER (PARTITION BY r, kind, spot ORDER BY start) <= {near}),
    mentions AS (SELECT * FROM lefts UNION ALL SELECT * FROM rights),
    words AS (SELECT lower(t) AS term, count(*) AS seen
              FROM (SELECT unnest(regexp_extract_all(text, '{term}')) AS t FROM d) GROUP BY lower(t)),
    total AS (SELECT sum(seen) AS n FROM words),
    inside AS (SELECT entity, count(*) AS n FROM mentions GROUP BY entity),
    told AS (SELECT entity, term, log2(together * total.n / (seen * inside.n)) / log2(total.n / inside.n) AS share
             FROM (SELECT entity, term, count(*) AS together FROM mentions GROUP BY ALL HAVING count(DISTINCT around) > 1)
             JOIN words USING (term) JOIN inside USING (entity), total WHERE total.n > inside.n),
    kinds AS (SELECT DISTINCT term, CASE WHEN share >= {pii.REMOVE} THEN {pii.REMOVED} ELSE {pii.GENERAL} END AS kind
              FROM told WHERE share >= {pii.GENERALISE}),
    marked AS (SELECT r, lower(value) AS term, start, start + length(value) AS stop FROM ({_placed('text', term, 'r', '', 'd')})),
    spans AS (SELECT r, start, kind, stop FROM base UNION ALL SELECT r, start, kind, stop FROM marked JOIN kinds USING (term)),
    listed AS (SELECT r, {listed} AS spans FROM spans GROUP BY r),
    based AS (SELECT r, {counts}, {listed} AS base FROM base GROUP BY r)
    SELECT doc_id, {totals}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN based USING (r) LEFT JOIN listed USING (r)"""


ORACLE_SQL = {
    "op9_pii": _pii(),
    "op2_quality_rules": _quality(),
    "op6_url_filters": _urls(),
    "op5_decontamination": _DECONTAMINATION,
    "op7_warc": _WARC,
    "op13_lexical_search": _LEXICAL,
}
