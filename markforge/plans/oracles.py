"""DuckDB SQL oracles for the registered queries.

Each string runs on DuckDB with the driver's tables registered as views and
states the expected result independently of the Spark code: fixtures are
rebuilt from ``doc_id`` arithmetic, XML validity is stated by construction
(no parser), ranks come from a plain ``row_number()`` window.
"""

from __future__ import annotations

from markforge.config import FALLBACK_SVG, IM_END, IM_START
from markforge.plans import fixtures as fx
from markforge.plans import queries as q

# Stated here again, so that a wrong pattern in the library shows: Python's
# whitespace, the token proxy and the last-block pattern.
SPACES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
          0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
SPACE_CLASS = "[" + "".join(f"\\x{{{c:x}}}" for c in SPACES) + "]"
TOKEN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\t\n\x0B\f\r ]"
BLOCK = r"(?i)<{tag}\b[^>]*>[\s\S]*?</{tag}>"

WS = "||".join(f"chr({c})" for c in SPACES)
NL = "chr(10)"


def lit(s: str) -> str:
    """SQL string literal (quotes doubled; newlines via chr)."""
    parts = s.split("\n")
    return f" || {NL} || ".join("'" + p.replace("'", "''") + "'" for p in parts)


def strip(e: str) -> str:
    return f"trim({e}, {WS})"


def count_sub(e: str, sub: str) -> str:
    return f"CAST((length({e}) - length(replace({e}, {lit(sub)}, ''))) // {len(sub)} AS INTEGER)"


def within(e: str, budget) -> str:
    conds = [] if budget.max_len is None else [f"length({e}) <= {budget.max_len}"]
    conds += [f"{count_sub(e, s)} <= {k}" for s, k in budget.max_counts]
    return " AND ".join(conds)


def tokens(e: str) -> str:
    return f"CAST(len(regexp_extract_all({e}, {lit(TOKEN)})) AS INTEGER)"


def markup_body(m: str) -> str:
    return (f"repeat({lit(fx.PATH_EL)}, CAST(({m}) % 14 AS INTEGER)) || "
            f"repeat({lit(fx.CIRCLE_EL)}, CAST(({m}) % 11 AS INTEGER)) || "
            f"repeat({lit(fx.RECT_EL)}, CAST(({m}) % 10 AS INTEGER))")


def markup_doc(m: str, upper: str, trunc: str) -> str:
    tag = f"(CASE WHEN {upper} THEN 'SVG' ELSE 'svg' END)"
    return (f"('<' || {tag} || {lit(fx.XMLNS_VIEWBOX)} || {markup_body(m)} || "
            f"(CASE WHEN {trunc} THEN '' ELSE '</' || {tag} || '>' END))")


SVG_PAIRS = f"""
SELECT doc_id, lang, source,
  CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN {NL} || ' ' || chr(9)
       ELSE '  ' || text || {NL} END AS caption,
  CASE WHEN doc_id % 19 = 0 THEN NULL ELSE 'alt ' || lang || ' ' || source END AS name,
  (CASE WHEN doc_id % 7 = 0 THEN {lit(fx.PROLOG)} ELSE {NL} || ' ' END)
    || {markup_doc('doc_id', 'doc_id % 11 = 0', 'doc_id % 5 = 0')} || ' ' AS svg_code
FROM documents"""


def pairs_sql(source: str) -> str:
    return f"""
WITH sp AS ({source}),
n AS (SELECT doc_id,
        coalesce(nullif({strip('caption')}, ''), nullif({strip('name')}, ''), '') AS p,
        coalesce(nullif({strip('svg_code')}, ''), '') AS s FROM sp),
g AS (SELECT doc_id,
        CASE WHEN starts_with(lower(s), '<svg') THEN p ELSE '' END AS prompt,
        CASE WHEN starts_with(lower(s), '<svg') THEN s ELSE '' END AS svg FROM n)
SELECT doc_id, prompt, svg FROM g WHERE prompt <> '' AND svg <> ''"""


PAIRS = pairs_sql(SVG_PAIRS)

CANDIDATES = f"""
SELECT doc_id, CAST(r AS INTEGER) AS round,
  {lit(fx.PREAMBLE_SYSTEM)} || coalesce(text, '') || {lit(fx.PREAMBLE_ASSISTANT)}
    || {markup_doc('doc_id + r', 'false', '(doc_id + r) % 5 = 0 OR doc_id % 23 = 0')} AS raw
FROM documents, (VALUES (1), (2)) t(r)"""


def rank(key: str, salt: str) -> str:
    return f"row_number() OVER (ORDER BY md5({lit(salt)} || CAST({key} AS VARCHAR)), {key})"


def chat_prompt(p: str) -> str:
    head = f"{IM_START}system\n{q.SYSTEM}{IM_END}\n{IM_START}user\n"
    return f"({lit(head)} || coalesce({p}, '') || {lit(IM_END + chr(10) + IM_START + 'assistant' + chr(10))})"


def chat_text(p: str, m: str) -> str:
    return f"({chat_prompt(p)} || coalesce({m}, '') || {lit(IM_END)})"


def extract_last(e: str, tag: str) -> str:
    return f"coalesce({strip(f'list_extract(regexp_extract_all({e}, {lit(BLOCK.format(tag=tag))}), -1)')}, '')"


def split_sql(share: float) -> str:
    return f"""
SELECT doc_id, text, CASE WHEN rn <= ceil({share!r}::DOUBLE * n) THEN 'eval' ELSE 'train' END AS split
FROM (SELECT doc_id, text, {rank('doc_id', f'split:{q.SEED}:')} AS rn, count(*) OVER () AS n FROM documents)"""


# Round keys of the shuffle's permutation for seed 42: the first 12 hex digits of
# md5('42:<round>') modulo 2147483647.
KEYS = tuple(f"(CAST('0x' || substring(md5('{q.SEED}:{i}'), 1, 12) AS BIGINT) % 2147483647)" for i in range(6))


def permuted_sql() -> str:
    """The row's place in the file, sent through a six-round network over a x b cells, again while it falls beyond n."""
    x = "SELECT pos, step, a, b, y // b AS l, y % b AS r FROM walk, size WHERE step = 0 OR y >= n"
    for i, key in enumerate(KEYS):
        h = f"((r * 1103515245 + {key}) % 2147483647)"
        x = f"SELECT pos, step, a, b, r AS l, (l + ({h} * {h} + {key}) % 2147483647) % {'b' if i % 2 else 'a'} AS r FROM ({x})"
    return f"""
WITH RECURSIVE rows AS MATERIALIZED (SELECT doc_id, text, row_number() OVER () - 1 AS pos FROM documents),
size AS (SELECT n, a, (n + a - 1) // a AS b FROM (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM rows)),
walk AS (
  SELECT pos, pos AS y, 0 AS step FROM rows
  UNION ALL
  SELECT pos, l * b + r AS y, step + 1 AS step FROM ({x}))
SELECT doc_id, text, y + 1 AS shuffle_rank FROM rows JOIN walk USING (pos), size WHERE step > 0 AND y < n"""


CORPUS = f"""
WITH pairs AS ({PAIRS}),
fit AS (SELECT * FROM pairs WHERE {within('svg', q.FIXTURE_BUDGET)}),
ranked AS (SELECT *, {rank('doc_id', f'split:{q.SEED}:')} AS rn, count(*) OVER () AS n FROM fit),
sp AS (SELECT doc_id, CASE WHEN rn <= ceil(0.5::DOUBLE * n) THEN 'eval' ELSE 'train' END AS split,
              {chat_text('prompt', 'svg')} AS text FROM ranked),
tk AS (SELECT *, {tokens('text')} AS n_tokens FROM sp)
SELECT doc_id, split, text, n_tokens, n_tokens <= {q.CORPUS_CFG.max_tokens} AS kept FROM tk"""

LANGS = ", ".join(lit(lang) for lang, _ in q.LANG_SOURCES)

# Rows of sources without ids: equal rows are interchangeable, doc_id only makes the order total.
IDLESS = f"""
WITH ranked_source AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5({lit(f'cap:{q.SEED}:')} || md5(
    coalesce(caption, '') || chr(31) || coalesce(name, '') || chr(31) || coalesce(svg_code, ''))), doc_id) AS cap_rn
  FROM ({SVG_PAIRS}) WHERE lang IN ({LANGS})),
pairs AS ({pairs_sql(f"SELECT * FROM ranked_source WHERE cap_rn <= {q.SOURCE_CAP}")}),
fit AS (SELECT * FROM pairs WHERE {within('svg', q.FIXTURE_BUDGET)}),
ranked AS (SELECT *, row_number() OVER (ORDER BY md5({lit(f'split:{q.SEED}:')} || md5(prompt || chr(31) || svg)), doc_id) AS rn,
                  count(*) OVER () AS n FROM fit),
sp AS (SELECT CASE WHEN rn <= ceil({q.IDLESS_CFG.eval_share!r}::DOUBLE * n) THEN 'eval' ELSE 'train' END AS split,
              {chat_text('prompt', 'svg')} AS text FROM ranked),
tk AS (SELECT *, {tokens('text')} AS n_tokens FROM sp)
SELECT split, text, n_tokens FROM tk WHERE n_tokens <= {q.IDLESS_CFG.max_tokens}"""

CHOICE = f"""
WITH v AS (SELECT doc_id, r FROM documents, (VALUES (1), (2)) t(r)
           WHERE NOT ((doc_id + r) % 5 = 0 OR doc_id % 23 = 0)),
w AS (SELECT doc_id, min(r) AS won FROM v GROUP BY doc_id)
SELECT d.doc_id AS id,
  CASE WHEN w.won IS NULL THEN {lit(FALLBACK_SVG)} ELSE {markup_doc('d.doc_id + w.won', 'false', 'false')} END AS svg,
  w.won IS NULL AS used_fallback, CAST(w.won AS INTEGER) AS won_round
FROM documents d LEFT JOIN w ON d.doc_id = w.doc_id"""


ONE_ROUND_CHOICE = f"""
SELECT doc_id AS id,
  CASE WHEN lost THEN {lit(FALLBACK_SVG)} ELSE {markup_doc('doc_id + 1', 'false', 'false')} END AS svg,
  lost AS used_fallback, CASE WHEN lost THEN NULL ELSE 1::INTEGER END AS won_round
FROM (SELECT doc_id, (doc_id + 1) % 5 = 0 OR doc_id % 23 = 0 AS lost FROM documents)"""


def _csv_by_name() -> str:
    n = len(q.CSV_LAYOUTS)
    names = " ".join(f"WHEN {i} THEN {lit(name)}" for i, (name, _) in enumerate(q.CSV_LAYOUTS))
    hidden = " ".join(f"WHEN doc_id % {n} = {i} THEN NULL" for i, (_, cols) in enumerate(q.CSV_LAYOUTS) if "caption" not in cols)
    source = f"SELECT doc_id, CASE {hidden} ELSE caption END AS caption, name, svg_code FROM ({SVG_PAIRS})"
    return f"""
SELECT doc_id, prompt, svg, CASE doc_id % {n} {names} END AS source_name, false AS skipped FROM ({pairs_sql(source)})
UNION ALL SELECT -1, '', '', {lit(q.CSV_UNUSABLE)}, true"""


def _validity(mode: str) -> str:
    idx = 2 if mode == "strict" else 3
    cases = " ".join(f"WHEN {i} THEN {str(v[idx]).upper()}" for i, v in enumerate(fx.VALIDITY_VARIANTS))
    return f"""
SELECT doc_id, (CASE doc_id % {len(fx.VALIDITY_VARIANTS)} {cases} END)
  AND NOT regexp_matches(coalesce(text, ''), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x{{FFFE}}\\x{{FFFF}}]') AS valid
FROM documents"""


def _wide_union() -> str:
    names = " ".join(f"WHEN {lit(lang)} THEN {lit(name)}" for lang, name in q.LANG_SOURCES)
    langs = ", ".join(lit(lang) for lang, _ in q.LANG_SOURCES)
    return f"""
SELECT p.doc_id, p.prompt, p.svg, CASE d.lang {names} END AS source_name
FROM ({PAIRS}) p JOIN documents d ON p.doc_id = d.doc_id WHERE d.lang IN ({langs})"""


def _repair(e: str, old: str, new: str) -> str:
    pat = rf'(?i)\b{old}{SPACE_CLASS}*={SPACE_CLASS}*"([^"]*)"'
    replaced = f"regexp_replace({e}, {lit(pat)}, {lit(new + '=' + chr(34) + chr(92) + '1' + chr(34))}, 'g')"
    return f"coalesce({strip(replaced)}, '')"


ORACLES = {
    "first_non_empty": f"""
SELECT doc_id, coalesce(nullif({strip('caption')}, ''), nullif({strip('name')}, ''), '') AS prompt,
       coalesce(nullif({strip('svg_code')}, ''), '') AS svg_raw FROM ({SVG_PAIRS})""",
    "normalize_pairs": PAIRS,
    "structural_filter": f"SELECT doc_id, svg FROM ({PAIRS}) WHERE {within('svg', q.FIXTURE_BUDGET)}",
    "structural_filter_default": f"SELECT doc_id FROM ({PAIRS}) WHERE {within('svg', q.DEFAULT_BUDGET)}",
    "structural_filter_strict": f"SELECT doc_id FROM ({PAIRS}) WHERE {within('svg', q.STRICT_BUDGET)}",
    "structural_filter_pages": f"SELECT page_id, url FROM pages WHERE {within('html', q.PAGES_BUDGET)}",
    "union_sources": _wide_union(),
    "source_counts": f"SELECT source_name, count(*) AS n_rows FROM ({_wide_union()}) GROUP BY source_name",
    "capped_sample": f"""
SELECT doc_id, lang, text FROM (
  SELECT doc_id, lang, text, row_number() OVER (PARTITION BY lang ORDER BY md5({lit(f'cap:{q.SEED}:')} || CAST(doc_id AS VARCHAR)), doc_id) AS rn
  FROM documents WHERE lang IN ({", ".join(lit(lang) for lang, _ in q.LANG_SOURCES)}))
WHERE rn <= {q.SOURCE_CAP}""",
    "head_cap": f"SELECT doc_id, lang, text FROM documents ORDER BY doc_id LIMIT {q.HEAD_N}",
    "seeded_shuffle": f"SELECT doc_id, text, {rank('doc_id', f'shuffle:{q.SEED}:')} AS shuffle_rank FROM documents",
    "keyed_permutation": permuted_sql(),
    "ordered_shuffle": f"SELECT doc_id, text, {rank('doc_id', f'shuffle:{q.SEED}:')} AS shuffle_rank FROM documents",
    "position_file_order": """
SELECT doc_id, md5(text) AS text_md5, row_number() OVER (ORDER BY doc_id DESC) - 1 AS input_pos FROM documents""",
    "exact_split": split_sql(0.5),
    "split_2pct": split_sql(0.02),
    "sft_corpus": f"SELECT doc_id, split, text, n_tokens FROM ({CORPUS}) WHERE kept",
    "split_counts": f"""
SELECT split, count(*) AS n_entered, CAST(count(*) FILTER (WHERE kept) AS BIGINT) AS n_kept
FROM ({CORPUS}) GROUP BY split""",
    "sft_render": f"""
SELECT u.conv_id, u.turn, {chat_text('u.text', 'a.text')} AS text
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'""",
    "gen_prompt_budget": f"""
SELECT conv_id, turn, n_input,
  CAST(greatest(128, least(640, 1984 - n_input)) AS INTEGER) AS budget_r1,
  CAST(greatest(128, least(2000, 1984 - n_input)) AS INTEGER) AS budget_r2
FROM (SELECT conv_id, turn, {tokens(chat_prompt('text'))} AS n_input FROM conversations WHERE role = 'user')""",
    "token_count": f"SELECT doc_id, {tokens('text')} AS n_tokens FROM documents",
    "token_filter": f"SELECT doc_id, n_tokens FROM (SELECT doc_id, {tokens('text')} AS n_tokens FROM documents) WHERE n_tokens <= 1700",
    "token_truncate": f"""
SELECT doc_id, n_tokens, CAST(least(n_tokens, 2048) AS INTEGER) AS n_kept, n_tokens > 2048 AS truncated
FROM (SELECT doc_id, {tokens('text')} AS n_tokens FROM documents)""",
    "extract_last_block": f"SELECT doc_id, round, {extract_last('raw', 'svg')} AS svg FROM ({CANDIDATES})",
    "extract_last_block_pages": f"""
SELECT page_id, {extract_last('html', 'article')} AS article, {extract_last('html', 'li')} AS li FROM pages""",
    "attribute_repair": f"SELECT page_id, {_repair('html', 'href', 'data-href')} AS html FROM pages",
    "validity_strict": _validity("strict"),
    "validity_loose": _validity("suffix"),
    "first_valid_round": CHOICE,
    "fallback_report": f"""
SELECT count(*) AS n_rows, CAST(count(*) FILTER (WHERE used_fallback) AS BIGINT) AS n_fallback FROM ({CHOICE})""",
    "output_quality": f"""
SELECT id, true AS valid, CAST(length(svg) AS INTEGER) AS n_chars, ends_with({strip('svg')}, '</svg>') AS ends_with_close,
  substring(svg, 1, 500) AS head, right(svg, 200) AS tail FROM ({CHOICE})""",
    "cascade_generate": CHOICE,
    "runtime_estimate": f"""
SELECT count(*) AS n_rows, round({q.RUNTIME_SAMPLE[0]!r}::DOUBLE / {q.RUNTIME_SAMPLE[1]}::DOUBLE * count(*), 2) AS est_minutes
FROM documents""",
    "csv_round_trip": PAIRS,
    "csv_by_name": _csv_by_name(),
    "load_with_bad_source": f"""
SELECT 'documents' AS source_name, count(*) AS n_rows, false AS skipped FROM ({PAIRS})
UNION ALL SELECT 'corrupt', 0, true""",
    "capped_sample_repeated_key": f"""
SELECT lang, CAST(least(c, {q.REPEATED_KEY_CAP} - (upto - c)) AS BIGINT) AS n_kept
FROM (SELECT lang, c, sum(c) OVER (ORDER BY md5({lit(f'cap:{q.SEED}:')} || coalesce(lang, ''))) AS upto
      FROM (SELECT lang, count(*) AS c FROM documents GROUP BY lang))
WHERE upto - c < {q.REPEATED_KEY_CAP}""",
    "head_cap_file_order": f"SELECT doc_id, lang, text FROM documents ORDER BY doc_id DESC LIMIT {q.HEAD_N}",
    "corpus_idless": IDLESS,
    "cascade_one_round": ONE_ROUND_CHOICE,
    "cascade_resumed": CHOICE,
    "salvaged_sources": f"""
SELECT CASE WHEN doc_id % 5 = 4 THEN 'lines' ELSE 'files' END AS source_name, doc_id, prompt, svg, NULL AS lost
FROM ({PAIRS}) WHERE doc_id % 10 <> 4
UNION ALL SELECT 'files', NULL, NULL, NULL, 'no row could be read'
UNION ALL SELECT 'lines', NULL, NULL, NULL, concat('{{"doc_id": ', doc_id) FROM documents WHERE doc_id % 10 = 4""",
    "submission_csv": f"SELECT id, svg FROM ({CHOICE})",
    "attribute_repair_default": f"""
SELECT doc_id, {strip("replace(svg_code, '<path d', '<path fill-rule=" + '"evenodd"' + " d')")} AS svg FROM ({SVG_PAIRS})""",
    "preview": "SELECT doc_id, lang, substring(text, 1, 400) AS text FROM documents ORDER BY doc_id LIMIT 5",
}
