"""Shared SQL fragments for the DuckDB statements in ``castwright.plans.oracle``."""

from __future__ import annotations

from castwright.functions.text import LINE_BREAK_RX, WHITESPACE, WS_CLASS

# Python's whitespace set as a DuckDB string expression (chr() per character).
WS = "(" + " || ".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def lstrip(x: str) -> str:
    return f"ltrim({x}, {WS})"


def lines(x: str) -> str:
    """str.splitlines() as a DuckDB list expression."""
    parts = f"regexp_split_to_array({x}, '{LINE_BREAK_RX}')"
    return (
        f"(CASE WHEN {parts}[-1] = '' THEN {parts}[1:len({parts}) - 1] ELSE {parts} END)"
    )


def piece_lines(x: str) -> str:
    """Lines a piece contributes to a newline-joined script (see functions.text.piece_lines)."""
    return f"regexp_split_to_array(regexp_replace({x}, '\\r$', ''), '{LINE_BREAK_RX}')"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS_CLASS}+'), lambda w: w <> '')"


def collapse_ws(x: str) -> str:
    return f"regexp_replace({x}, '{WS_CLASS}+', ' ', 'g')"


def html_escape(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def ssml(x: str) -> str:
    body = html_escape(strip(x))
    body = f"replace(regexp_replace({body}, '\\n{{2,}}', '<break time=\"700ms\"/>', 'g'), chr(10), '<break time=\"350ms\"/>')"
    return (
        f"CASE WHEN {html_escape(strip(x))} <> '' THEN "
        f"'<speak><prosody rate=\"95%\">' || {body} || '</prosody></speak>' END"
    )


def chunks_cte(source: str, key: str, text: str, limit: int, name: str = "ck") -> str:
    """Recursive CTE giving (key..., chunk_no, chunk) for the greedy speech cut; ``key`` may
    be a comma-separated column list."""
    floor = int(limit * 0.6)
    brk = f"length(regexp_extract(substring(r, 1, {limit}), '(?s)^(.*)[\\n ]', 1))"
    return f"""{name}_rec({key}, i, r, c) AS (
    SELECT {key}, 0, {strip(text)}, NULL::VARCHAR FROM {source} WHERE {strip(text)} <> ''
    UNION ALL
    SELECT {key}, i + 1,
           CASE WHEN length(r) <= {limit} THEN '' ELSE {lstrip('substring(r, k + 1)')} END,
           CASE WHEN length(r) <= {limit} THEN r ELSE {strip('substring(r, 1, k)')} END
    FROM (SELECT *, CASE WHEN {brk} < {floor} THEN {limit} ELSE {brk} END AS k
          FROM {name}_rec WHERE r <> '') s
),
{name} AS (SELECT {key}, (i - 1)::BIGINT AS chunk_no, c AS chunk FROM {name}_rec WHERE i > 0)"""


def entity_decode(x: str) -> str:
    """The four entities present in the test pages; &amp; last so it is not decoded twice."""
    return (
        f"replace(replace(replace(replace({x}, '&copy;', '©'), '&middot;', '·'), "
        f"'&quot;', '\"'), '&amp;', '&')"
    )
