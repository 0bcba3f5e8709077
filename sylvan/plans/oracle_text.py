"""DuckDB SQL for the text queries, built from the same fixed values the Spark side uses."""

from __future__ import annotations

from sylvan.functions import text as tx


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


LINES = """lines AS (
  SELECT doc_id, lang, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL)
)"""


def stopword_values() -> str:
    rows = ", ".join(f"({q(lang)}, {q(w)})" for lang, w in tx.stopwords())
    return f"stop(lang, w) AS (VALUES {rows})"


def entity_steps_sql(expr: str) -> list[tuple[str, str, str]]:
    """(label, pattern, SQL of the line before) of each removal in order, and the final line."""
    out = []
    for label, pattern in tx.ENTITY_RULES:
        out.append((label, pattern, expr))
        rest = f" \\{tx.ENTITY_REST[label]}" if label in tx.ENTITY_REST else " "
        expr = f"regexp_replace({expr}, {q(pattern)}, '{rest}', 'g')"
    out.append(("", tx.gazetteer_pattern(), expr))
    out.append(("end", "", f"regexp_replace({expr}, {q(tx.gazetteer_pattern())}, ' ', 'g')"))
    return out


def remove_entities_sql(expr: str) -> str:
    return entity_steps_sql(expr)[-1][2]


def strip_dates_sql(expr: str) -> str:
    return f"regexp_replace({expr}, {q(tx.DATE_PATTERN)}, '', 'g')"


def clean_line_sql(expr: str) -> str:
    gated = f"CASE WHEN length({expr}) > {tx.ENTITY_MIN_LINE_LENGTH} THEN {remove_entities_sql(expr)} ELSE {expr} END"
    return strip_dates_sql(f"lower({gated})")


def tokens_sql(expr: str) -> str:
    return (f"list_filter(regexp_extract_all({expr}, {q(tx.TOKEN_PATTERN)}), "
            f"lambda t: length(t) >= {tx.MIN_TOKEN_LENGTH})")


def exploded(list_expr: str, pos: str, val: str, cols: str = "doc_id, line_no", src: str = "lines") -> str:
    return (f"SELECT {cols}, CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS {pos}, unnest(arr) AS {val} "
            f"FROM (SELECT {cols}, {list_expr} AS arr FROM {src})")


def clean_tokens_cte() -> str:
    toks = exploded(tokens_sql(clean_line_sql("line")), "pos", "token", cols="doc_id, lang, line_no")
    return f"""{LINES},
{stopword_values()},
toks AS ({toks}),
clean AS (
  SELECT doc_id, line_no, pos, token FROM toks
  WHERE NOT EXISTS (SELECT 1 FROM stop WHERE stop.lang = toks.lang AND stop.w = toks.token)
)"""


def plain_counts_cte() -> str:
    words = exploded("string_split(line, ' ')", "pos", "w")
    return f"""{LINES},
words AS ({words}),
counts AS (SELECT w, count(*) AS n FROM words GROUP BY w)"""


def ties_select(counts: str = "counts", k: int = 10) -> str:
    return f"SELECT w, n FROM {counts} QUALIFY rank() OVER (ORDER BY n DESC) <= {k}"


def entity_set_sql() -> str:
    """Step by step: each rule's matches on what the rules before it left."""
    parts = [f"l0 AS (SELECT line FROM lines WHERE length(line) > {tx.ENTITY_MIN_LINE_LENGTH})"]
    found = []
    for i, (label, pattern) in enumerate(tx.ENTITY_RULES):
        rest = f" \\{tx.ENTITY_REST[label]}" if label in tx.ENTITY_REST else " "
        parts.append(f"l{i + 1} AS (SELECT regexp_replace(line, {q(pattern)}, '{rest}', 'g') AS line FROM l{i})")
        found.append(f"SELECT {q(label)} AS label, unnest(regexp_extract_all(line, {q(pattern)}, 1)) AS entity FROM l{i}")
    last = len(tx.ENTITY_RULES)
    gaz = ", ".join(f"({q(p)}, {q(lab)})" for p, lab in tx.gazetteer_in_order())
    parts.append(f"named AS (SELECT unnest(regexp_extract_all(line, {q(tx.gazetteer_pattern())})) AS entity FROM l{last})")
    found.append(f"SELECT g.label, named.entity FROM named JOIN (VALUES {gaz}) AS g(phrase, label) ON g.phrase = named.entity")
    union = "\nUNION\n".join(found)
    return f"""WITH {LINES},
{", ".join(parts)}
SELECT DISTINCT label, entity FROM (
{union}
) AS e"""


def text_oracles() -> dict[str, str]:
    out = {
        "scan_lines": f"WITH {LINES} SELECT doc_id, lang, line_no, line FROM lines",
        "split_words": f"WITH {LINES} " + exploded("string_split(line, ' ')", "pos", "w"),
        "lower_text": f"WITH {LINES} SELECT doc_id, line_no, lower(line) AS line FROM lines",
        "strip_dates": f"WITH {LINES} SELECT doc_id, line_no, {strip_dates_sql('lower(line)')} AS line FROM lines",
        "tokenize": f"WITH {LINES} {exploded(tokens_sql(strip_dates_sql('lower(line)')), 'pos', 'token')}",
        "entity_removal": (
            f"WITH {LINES} SELECT doc_id, line_no, CASE WHEN length(line) > {tx.ENTITY_MIN_LINE_LENGTH} "
            f"THEN {remove_entities_sql('line')} ELSE line END AS line FROM lines"
        ),
        "entity_set": entity_set_sql(),
        "stopword_filter": f"""WITH {LINES},
{stopword_values()},
toks AS ({exploded(tokens_sql(strip_dates_sql('lower(line)')), 'pos', 'token', cols='doc_id, lang, line_no')})
SELECT doc_id, line_no, pos, token FROM toks
WHERE NOT EXISTS (SELECT 1 FROM stop WHERE stop.lang = toks.lang AND stop.w = toks.token)""",
        "clean_tokens": f"WITH {clean_tokens_cte()} SELECT doc_id, line_no, pos, token FROM clean",
        "word_count": f"WITH {plain_counts_cte()} SELECT w, n FROM counts",
        "topk_values": f"WITH {plain_counts_cte()} SELECT n FROM counts ORDER BY n DESC LIMIT 10",
        "topk_words_ties": f"WITH {plain_counts_cte()} {ties_select()}",
        "threshold_filter": (
            "SELECT doc_id, n_chars FROM documents "
            "WHERE n_chars >= (SELECT avg(n_chars) FROM documents)"
        ),
        "clean_topk": (
            f"WITH {clean_tokens_cte()}, counts AS (SELECT token AS w, count(*) AS n FROM clean GROUP BY token) "
            f"{ties_select()}"
        ),
    }
    out["topk_words_pruned"], out["clean_topk_pruned"] = out["topk_words_ties"], out["clean_topk"]
    return out
