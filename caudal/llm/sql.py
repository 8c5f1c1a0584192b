"""SQL (DuckDB) of the operators' queries that SQL can express, written by their definitions."""

from __future__ import annotations

from caudal.llm.linedup import RUN_WORDS
from caudal.llm.settings import DOMAIN_WEIGHTS, LANG_WEIGHTS, MIX_EPOCHS, MIX_PERCENT, MIX_SEED

SPACE = r"[\x20\x09-\x0D]+"


def _weight(key: str, weights: dict[str, int]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {w}" for k, w in weights.items())
    return f"CAST(CASE {key} {cases} ELSE 1 END AS BIGINT)" if weights else "1::BIGINT"


def mixture() -> str:
    levels = [("k0", DOMAIN_WEIGHTS), ("k1", LANG_WEIGHTS), ("k2", {})]
    parts = [rf"""d AS (
        SELECT doc_id, lang, source, 'd' || CAST(coalesce(TRY_CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INTEGER), 0) // 7 AS VARCHAR) AS k0,
               coalesce(lang, '') AS k1, coalesce(source, '') AS k2, coalesce(CAST(doc_id AS VARCHAR), '') AS name,
               CAST(coalesce(len(list_filter(regexp_split_to_array(text, '{SPACE}'), lambda w: w <> '')), 0) AS BIGINT) AS tokens
        FROM documents),
    leaves AS (SELECT k0, k1, k2, CAST(sum(tokens) AS BIGINT) AS t FROM d GROUP BY ALL),
    b AS (SELECT least(sum(t) * {MIX_PERCENT} // 100, sum(t) * {MIX_EPOCHS}) AS b FROM leaves)"""]
    for i, (key, weights) in enumerate(levels):
        above = [k for k, _ in levels[:i]]
        keys = ", ".join([*above, key])
        inside = f"PARTITION BY {', '.join(above)}" if above else ""
        join = f"JOIN b{i - 1} USING ({', '.join(above)})" if above else ", b"
        parts.append(f"""n{i} AS (SELECT {keys}, CASE WHEN w > 0 THEN cap ELSE 0 END AS cap, w, b FROM (
            SELECT {keys}, sum(t) * {MIX_EPOCHS} AS cap, {_weight(key, weights)} AS w FROM leaves GROUP BY {keys}) {join}),
        o{i} AS (SELECT *, sum(cap) OVER ({inside} ORDER BY cap / greatest(w, 1), {key} ROWS UNBOUNDED PRECEDING) AS cap_to,
            sum(w) OVER ({inside}) - sum(w) OVER ({inside} ORDER BY cap / greatest(w, 1), {key} ROWS UNBOUNDED PRECEDING) + w AS w_from FROM n{i}),
        f{i} AS (SELECT *, cap * w_from <= (b - cap_to + cap) * w AS filled FROM o{i}),
        b{i} AS (SELECT {keys}, CASE WHEN filled THEN cap ELSE w * (b - sum(CASE WHEN filled THEN cap ELSE 0 END) OVER ({inside}))
            // greatest(sum(CASE WHEN filled THEN 0 ELSE w END) OVER ({inside}), 1) END AS b FROM f{i})""")
    return f"""WITH {', '.join(parts)},
    p AS (SELECT k0, k1, k2, CAST(CASE WHEN t > 0 THEN b // t ELSE 0 END AS BIGINT) AS epochs, CAST(CASE WHEN t > 0 THEN b % t ELSE 0 END AS BIGINT) AS rest FROM leaves JOIN b2 USING (k0, k1, k2)),
    placed AS (SELECT d.*, epochs, rest, md5(concat_ws(':', '{MIX_SEED}', CAST(epochs AS VARCHAR), name)) AS place FROM d JOIN p USING (k0, k1, k2))
    SELECT doc_id, lang, source, tokens, copies FROM (
        SELECT *, epochs + CASE WHEN rest > 0 AND sum(tokens) OVER (PARTITION BY k0, k1, k2 ORDER BY place RANGE UNBOUNDED PRECEDING) <= rest THEN 1 ELSE 0 END AS copies FROM placed)
    WHERE copies > 0"""


REVISITS = r"""WITH cut AS (
    SELECT page_id, '"' || md5(coalesce(html, '')) || '"' AS etag, CAST(length(coalesce(html, '')) AS VARCHAR) AS size, 'day ' || CAST(page_id % 28 AS VARCHAR) AS day,
           regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.\-]*://', '') AS rest FROM pages),
named AS (
    SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '')
           || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
           list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*\?(.*)$', 1), '&'), lambda a: a <> '' AND NOT regexp_matches(a, '(?i)^(utm_[^=]*|gclid|fbclid)(=.*)?$'))) AS args FROM cut),
keyed AS (SELECT *, place || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END AS url_key FROM named),
sent AS (SELECT page_id, url_key, page_id + 1000 AS time, CASE page_id % 4 WHEN 3 THEN NULL WHEN 2 THEN '"other"' ELSE 'W/' || etag END AS etag, day FROM keyed),
latest AS (
    SELECT s.page_id, s.url_key, s.etag, s.day, max(r.page_id) AS response_id FROM sent s LEFT JOIN keyed r ON s.url_key = r.url_key AND r.page_id < s.time GROUP BY ALL),
judged AS (
    SELECT l.*, k.etag AS old_etag, k.day AS old_day, k.size, CASE WHEN l.response_id IS NULL THEN 'missing'
           WHEN coalesce(regexp_replace(l.etag, '^W/', '') = k.etag, l.day = k.day) THEN 'resolved' ELSE 'mismatch' END AS outcome
    FROM latest l LEFT JOIN keyed k ON k.page_id = l.response_id)
SELECT page_id, url_key, outcome, CASE WHEN outcome = 'resolved' THEN response_id END AS response_id,
       CASE WHEN outcome = 'resolved' THEN coalesce(etag, old_etag) ELSE etag END AS etag, day AS last_modified,
       CASE WHEN outcome = 'resolved' THEN size ELSE '0' END AS content_length, 'max-age=3600' AS cache_control FROM judged"""


def line_dedup() -> str:
    """By the definition: a line goes if it lies in a run of lines, of RUN_WORDS words or more, whose lines stand earlier in the same
    order. Runs of up to RUN_WORDS lines say it all, as every line has a word: any line of a longer run lies in one of that many."""
    return rf"""WITH src AS (SELECT DISTINCT coalesce(doc_id, -9223372036854775808) AS doc, md5(text) AS kind, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
    cut AS (SELECT doc, kind, unnest(range(len(parts)))::INTEGER AS pos, unnest(parts) AS line FROM src),
    plain AS (SELECT doc, kind, pos, trim(regexp_replace(lower(line), '{SPACE}', ' ', 'g')) AS line FROM cut),
    lines AS (SELECT doc, kind, pos, line, length(line) - length(replace(line, ' ', '')) + 1 AS words FROM plain WHERE line <> ''),
    ahead AS (
        SELECT doc, kind, pos, list(line) OVER w AS texts, list(words) OVER w AS counts, list(pos) OVER w AS places FROM lines
        WINDOW w AS (PARTITION BY doc, kind ORDER BY pos ROWS BETWEEN CURRENT ROW AND {RUN_WORDS - 1} FOLLOWING)),
    sized AS (SELECT *, unnest(range(1, len(texts) + 1)) AS n FROM ahead),
    runs AS (
        SELECT struct_pack(doc := doc, kind := kind, pos := pos) AS place, array_to_string(texts[1:n], chr(10)) AS run, places[1:n] AS places
        FROM sized WHERE list_sum(counts[1:n]) >= {RUN_WORDS}),
    firsts AS (SELECT run, min(place) AS origin FROM runs GROUP BY run HAVING count(*) > 1),
    gone AS (SELECT DISTINCT place.doc AS doc, place.kind AS kind, unnest(places) AS pos FROM runs JOIN firsts USING (run) WHERE place <> origin),
    lists AS (SELECT doc, kind, list(pos ORDER BY pos) AS removed FROM gone GROUP BY ALL)
    SELECT doc_id, CASE WHEN text IS NOT NULL THEN len(string_split(text, chr(10)))::INTEGER END AS n_lines, coalesce(array_to_string(removed, ','), '') AS removed_lines,
           CASE WHEN removed IS NULL THEN text ELSE array_to_string(list_transform(list_filter(range(len(string_split(text, chr(10)))), lambda i: NOT list_contains(removed, i::INTEGER)), lambda i: string_split(text, chr(10))[i + 1]), chr(10)) END AS text
    FROM documents LEFT JOIN lists ON coalesce(doc_id, -9223372036854775808) = doc AND md5(text) = kind"""


SQL = {"op5_mixture": mixture(), "op8_revisits": REVISITS, "op9_line_dedup": line_dedup()}
