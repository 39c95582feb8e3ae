"""Plain SQL for the checking engine, one text per query, written apart from the operators."""

from __future__ import annotations

from postfeed.catalog.views import INSTRUCTION, view_sql

_RUN_TS = "TIMESTAMP '2024-01-08 11:34:23'"
_ORACLES: dict[str, str] = {}


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)


def _with(*views: str, more: str = "") -> str:
    ctes = [f"{name} AS ({view_sql(name)})" for name in views]
    return "WITH " + ",\n".join(ctes + ([more] if more else [])) + "\n"


def _q(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("'", "''") + "'"


def _rx(expr: str, pattern: str, new: str = "") -> str:
    return f"regexp_replace({expr}, {_q(pattern)}, {_q(new)}, 'g')"


_PUB = _with("published")
_STG = _with("staging")
_BOTH = _with("staging", "published")

# ---- scans, keys, schema ----

_ORACLES["published_keys"] = _PUB + (
    "SELECT DISTINCT partner_job_id FROM published WHERE partner_job_id IS NOT NULL AND partner_job_id <> ''"
)
_ORACLES["usable_keys"] = _PUB + (
    "SELECT id, CASE WHEN partner_job_id = '' THEN NULL ELSE partner_job_id END AS usable_key FROM published"
)
_ORACLES["feed_key"] = _PUB + (
    "SELECT id, CASE WHEN partner_job_id IS NULL OR partner_job_id = '' THEN CAST(id AS VARCHAR)"
    " ELSE partner_job_id END AS feed_key FROM published"
)
_ORACLES["sample_rows"] = _STG + (
    "SELECT id, position, job_description, company, partner_job_id FROM staging ORDER BY id LIMIT 10"
)
_ORACLES["available_postings"] = _PUB + "SELECT id, partner_job_id, position FROM published"

_PUBLISHED_COLUMNS = [
    "id", "position", "description", "company", "apply_url", "company_id", "location", "workplace_types",
    "experience_level", "jobtype", "partner_job_id", "last_build_date", "created_at", "updated_at",
]
_SINCE = {"description": 2, "partner_job_id": 4, "last_build_date": 4} | {
    c: 3 for c in ("company", "apply_url", "company_id", "location", "workplace_types", "experience_level", "jobtype")
}
_ORACLES["schema_conform"] = _PUB + "SELECT {} FROM published".format(
    ", ".join(
        f"CASE WHEN CAST(left(position, 1) AS INT) >= {_SINCE[c]} THEN {c} END AS {c}" if c in _SINCE else c
        for c in _PUBLISHED_COLUMNS
    )
)

_WIDTHS = {
    "position": 255, "company": 255, "company_id": 255, "location": 255, "partner_job_id": 255,
    "workplace_types": 50, "experience_level": 50, "jobtype": 50,
}
_BYTES = ["job_description", "apply_url"]
_VIOLATIONS = "SELECT id, 'position: missing' AS problem FROM staging WHERE position IS NULL" + "".join(
    f" UNION ALL SELECT id, '{c}: longer than {w}' FROM staging WHERE length({c}) > {w}" for c, w in _WIDTHS.items()
) + "".join(f" UNION ALL SELECT id, '{c}: longer than 65535 bytes' FROM staging WHERE strlen({c}) > 65535" for c in _BYTES)
_OK = "(position IS NOT NULL" + "".join(
    f" AND coalesce(length({c}) <= {w}, TRUE)" for c, w in _WIDTHS.items()
) + "".join(f" AND coalesce(strlen({c}) <= 65535, TRUE)" for c in _BYTES) + ")"
_ORACLES["schema_violations"] = _STG + _VIOLATIONS
_ORACLES["staging_mapped"] = _STG + "SELECT {} FROM staging".format(
    ", ".join("job_description AS description" if c == "description" else c for c in _PUBLISHED_COLUMNS[1:])
)
_ORACLES["load_timestamps"] = _STG + (
    f"SELECT id, coalesce(created_at, {_RUN_TS}) AS created_at, coalesce(updated_at, {_RUN_TS}) AS updated_at FROM staging"
)
_ORACLES["assigned_ids"] = _STG + (
    "SELECT id, CAST(999999 + row_number() OVER (ORDER BY id) AS BIGINT) AS new_id FROM staging"
)
_BATCH = "CAST((row_number() OVER (ORDER BY id) - 1) // 20 + 1 AS BIGINT) AS batch_no"
_ORACLES["batches"] = _STG + f"SELECT id, {_BATCH} FROM staging"
_ORACLES["batch_outcomes"] = _with("staging", more=f"numbered AS (SELECT {_BATCH}, {_OK} AS ok FROM staging)") + (
    "SELECT batch_no, count(*) AS rows, count(*) FILTER (ok) AS inserted,"
    " CAST(sum(count(*) FILTER (ok)) OVER (ORDER BY batch_no) AS BIGINT) AS total_inserted,"
    " CAST((SELECT ceil(count(*) / 20) FROM staging) AS BIGINT) AS batches"
    " FROM numbered GROUP BY batch_no"
)

# ---- sync ----

_HAS = "({0}.partner_job_id IS NOT NULL AND {0}.partner_job_id <> '')"
_IN_PUB = "EXISTS (SELECT 1 FROM published p WHERE p.partner_job_id = s.partner_job_id AND s.partner_job_id <> '')"
_IN_STG = "EXISTS (SELECT 1 FROM staging s WHERE s.partner_job_id = p.partner_job_id)"
_EXPIRED = f"{_HAS.format('p')} AND NOT {_IN_STG} AND (SELECT count(*) FROM staging) > 0"

_ORACLES["new_postings"] = _BOTH + (
    f"SELECT id, partner_job_id, position, job_description FROM staging s WHERE NOT {_IN_PUB}"
)
_ORACLES["already_published"] = _BOTH + f"SELECT id, partner_job_id FROM staging s WHERE {_IN_PUB}"
_ORACLES["expired_postings"] = _BOTH + f"SELECT id, partner_job_id FROM published p WHERE {_EXPIRED}"
_ORACLES["expired_report"] = _BOTH + (
    "SELECT id, partner_job_id,"
    " CASE WHEN length(position) > 40 THEN left(position, 38) || '..' WHEN coalesce(position, '') = '' THEN 'N/A' ELSE position END AS position,"
    " CASE WHEN length(company) > 20 THEN left(company, 18) || '..' WHEN coalesce(company, '') = '' THEN 'N/A' ELSE company END AS company"
    f" FROM published p WHERE {_EXPIRED}"
)
_NA = "CASE WHEN coalesce({0}, '') = '' THEN 'N/A' ELSE {0} END AS {0}"
_ORACLES["expired_examples"] = _BOTH + (
    f"SELECT id, partner_job_id, {_NA.format('position')}, {_NA.format('company')}, {_NA.format('location')},"
    " coalesce(CAST(created_at AS VARCHAR), 'N/A') AS created_at,"
    f" greatest((SELECT count(*) FROM published p WHERE {_EXPIRED}) - 5, 0) AS more"
    f" FROM published p WHERE {_EXPIRED} ORDER BY id LIMIT 5"
)
_ORACLES["published_after_expiry"] = _BOTH + (
    f"SELECT id, partner_job_id, description FROM published p WHERE NOT coalesce({_EXPIRED}, FALSE)"
)
_MISSING = (
    "missing AS (SELECT DISTINCT partner_job_id FROM staging WHERE partner_job_id <> ''"
    " EXCEPT SELECT partner_job_id FROM published)"
)
_ORACLES["missing_keys"] = _with("staging", "published", more=_MISSING) + "SELECT partner_job_id FROM missing"
_ORACLES["missing_examples"] = _with("staging", "published", more=_MISSING) + (
    "SELECT partner_job_id, greatest((SELECT count(*) FROM missing) - 10, 0) AS more"
    " FROM missing ORDER BY partner_job_id LIMIT 10"
)
_ORACLES["published_flag"] = _BOTH + f"SELECT id, partner_job_id, {_IN_PUB} AS is_published FROM staging s"
_ORACLES["reconcile"] = _with("staging", "published", more=_MISSING) + (
    "SELECT (SELECT count(*) FROM staging) AS staging_rows, (SELECT count(*) FROM published) AS published_rows,"
    " (SELECT count(DISTINCT nullif(partner_job_id, '')) FROM staging) AS staging_keys,"
    " (SELECT count(DISTINCT nullif(partner_job_id, '')) FROM published) AS published_keys,"
    " (SELECT count(*) FROM missing) AS missing_keys, (SELECT count(*) FROM missing) = 0 AS all_published"
)
_ORACLES["sync_counts"] = _BOTH + (
    f"SELECT count(*) AS total, count(*) FILTER ({_IN_PUB}) AS skipped, count(*) FILTER (NOT {_IN_PUB}) AS \"new\" FROM staging s"
)
_ORACLES["run_summary"] = _BOTH + (
    f"SELECT (SELECT count(*) FROM published p WHERE {_EXPIRED}) AS expired,"
    f" (SELECT count(*) FROM staging s WHERE NOT {_IN_PUB}) AS new_found,"
    f" (SELECT count(*) FROM staging s WHERE NOT {_IN_PUB} AND {_OK}) AS processed"
)
_ORACLES["progress"] = _BOTH + (
    "SELECT processed, total, CASE WHEN total > 0 THEN CAST(printf('%.1f', processed / total * 100) AS DOUBLE) ELSE 0 END AS percentage,"
    " processed >= total AND total > 0 AS complete"
    " FROM (SELECT (SELECT count(*) FROM published) AS processed, (SELECT count(*) FROM staging) AS total) c"
)
_ORACLES["progress_delta"] = _with("samples") + (
    "SELECT run_id, sampled_at, processed,"
    " CAST(processed - lag(processed, 1, 0) OVER (PARTITION BY run_id ORDER BY sampled_at) AS BIGINT) AS new_records FROM samples"
)

# ---- posting texts ----

_TAGS = "b|strong|u|i|br|p|ul|li|em"
_LABELS = r"(\[#J-REMOTE\]|\[#J-INTERNAL\]|\[#J-MCITY\]|\[#J-ENTERPRISE\]|\[#J-ONE\]|\[#J-MIN\])"
_S = r"[ \t\r\n\f]"
_END_OF_TAG = r"([ \t\r\n\f/][^<>]*)?>"


def _allow(expr: str) -> str:
    marked = _rx(_rx(expr, "[\x01\x02]"), f"(?i)<(/?)({_TAGS}){_END_OF_TAG}", "\x01\\1\\2\x02")
    return f"replace(replace({_rx(marked, '<[a-zA-Z/!?][^<>]*>')}, chr(1), '<'), chr(2), '>')"


def _visible(expr: str) -> str:
    return _rx(expr, f"(?is)<!--.*?-->|<script{_END_OF_TAG}.*?</script{_S}*>|<style{_END_OF_TAG}.*?</style{_S}*>")


def _mapped(expr: str) -> str:
    expr = _rx(_rx(expr, f"(?i)<h[1-6]{_END_OF_TAG}", "<p><strong>"), f"(?i)</h[1-6]{_S}*>", "</strong></p>")
    expr = _rx(expr, f"(?i)<(/?)ol{_END_OF_TAG}", "<\\1ul>")
    return _allow(_rx(expr, f"(?i)<(/?)(div|section|article){_END_OF_TAG}", "<\\1p>"))


_ADDRESS = r'(?i)https?://[^ \t\r\n\f<>"]*[^ \t\r\n\f<>"-]'


def _no_links(expr: str) -> str:
    return _rx(_rx(expr, _ADDRESS), f"(?i)</?a({_S}[^<>]*)?>")


def _breaks(expr: str) -> str:
    br = f"<br{_S}*/?>"
    expr = _rx(expr, f"(?i){br}{_S}*{br}{_S}*{br}({_S}*{br})*", "<br><br>")
    expr = _rx(expr, f"(?i)</p{_S}*>({_S}|{br})*<p({_S}[^<>]*)?>", "</p><br><br><p\\2>")
    expr = _rx(expr, f"(?i)(</p{_S}*>{_S}*){br}({_S}*{br})*", "\\1<br><br>")
    return _rx(expr, f"(?i){br}(?:{_S}*{br})*({_S}*<p(?:{_S}[^<>]*)?>)", "<br><br>\\1")


# The rule told from what breaks it, not from the function above: paragraphs without a break between them,
# three breaks in a row, one break alone behind or before a paragraph. Every break becomes one control character.
def _breaks_ok(expr: str) -> str:
    flat = _rx(_rx(_rx(expr, "[\x01\x02\x03]"), f"(?i)<br{_S}*/?>", "\x01"), f"(?i)</p{_S}*>", "\x02")
    flat = _rx(_rx(flat, f"(?i)<p({_S}[^<>]*)?>", "\x03"), f"({_S}*)(\x01|\x02|\x03){_S}*", "\\2")
    return f"NOT regexp_matches({flat}, {_q('\x02\x03|\x01\x01\x01|\x02\x01($|[^\x01])|(^|[^\x01])\x01\x03')})"


def _labels_last(expr: str) -> str:
    labels = f"array_to_string(regexp_extract_all({expr}, {_q(_LABELS)}), ' ')"
    body = _rx(_rx(expr, _LABELS), f"{_S}+$")
    return (
        f"CASE WHEN regexp_matches({expr}, {_q(_LABELS)})"
        f" THEN CASE WHEN {body} = '' THEN '' ELSE {body} || ' ' END || {labels} ELSE {expr} END"
    )


_PLACES = "Questa opportunità è disponibile su "
_CLOSING = "Il processo di selezione sarà interamente gestito da "
_SUMMARY = "Riassunto dell'opportunità da parte della <i>[^<]*</i>:</strong>"


def _head(expr: str) -> str:
    return (
        f"coalesce(nullif(regexp_extract({expr}, {_q(f'(?s)^(.*?{_PLACES}.*?</em></p>)')}, 1), ''),"
        f" nullif(regexp_extract({expr}, {_q(f'(?s)^(.*?{_CLOSING}.*?</em></p>)')}, 1), ''),"
        f" regexp_extract({expr}, {_q(f'(?s)^(.*?{_SUMMARY}.*?</p>(?:<br>)*)')}, 1))"
    )


def _plain(expr: str) -> str:
    text = _rx(_rx(_rx(_visible(expr), _ADDRESS), "<[a-zA-Z/!?][^<>]*>"), _LABELS)
    return f"trim({_rx(text, _S + '+', ' ')})"


def _stripped(expr: str) -> str:
    return _rx(expr, r"^[\s\x0b]+|[\s\x0b]+$")


# The steps of the default rewriter over a relation with id and text: head, body, formatted, result.
def _rewrite_steps(source: str, text: str) -> str:
    return (
        f"split1 AS (SELECT *, {_head(text)} AS head FROM {source}),\n"
        f"split2 AS (SELECT *, substr({text}, length(head) + 1) AS body FROM split1),\n"
        f"seen AS (SELECT *, {_no_links(_visible('body'))} AS shown FROM split2),\n"
        f"formatted AS (SELECT *, head || {_breaks(_mapped('shown'))} AS whole FROM seen),\n"
        f"rewritten AS (SELECT *, CASE WHEN {text} <> '' THEN {_stripped(_labels_last('whole'))} END AS improved FROM formatted)"
    )


_PAGES = _with("page_postings")
for _name, _step in {
    "allow_tags": _allow("html"),
    "map_tags": _mapped(_visible("html")),
    "remove_links": _no_links("html"),
    "paragraph_breaks": _breaks("html"),
    "end_labels": _labels_last("html"),
}.items():
    _ORACLES[_name] = _PAGES + f"SELECT id, {_step} AS html FROM page_postings"

# The stack of open tags, innermost first, then chr(1), then the text so far.
_STEP = """
CASE WHEN NOT regexp_matches(x, '(?i)^</?(?:b|strong|u|i|p|ul|li|em)>$') THEN a || x
WHEN starts_with(x, '</') THEN CASE WHEN {own} > 0 THEN substr({st}, {own} + length({t})) || chr(1) || {out} || replace(left({st}, {own} + length({t}) - 1), '<', '</') ELSE a END
WHEN {t} = '<p>' AND {own} > 0 THEN '<p>' || substr({st}, {own} + 3) || chr(1) || {out} || replace(left({st}, {own} + 2), '<', '</') || '<p>'
WHEN {t} = '<li>' AND {own} > 0 AND (instr({st}, '<ul>') = 0 OR {own} < instr({st}, '<ul>'))
  THEN '<li>' || substr({st}, {own} + 4) || chr(1) || {out} || replace(left({st}, {own} + 3), '<', '</') || '<li>'
WHEN {t} = '<li>' AND instr({st}, '<ul>') = 0 THEN '<li><ul>' || {st} || chr(1) || {out} || '<ul><li>'
ELSE {t} || {st} || chr(1) || {out} || {t} END""".format(
    st="split_part(a, chr(1), 1)", out="substr(a, instr(a, chr(1)) + 1)", t="lower(replace(x, '/', ''))",
    own="instr(split_part(a, chr(1), 1), lower(replace(x, '/', '')))",
)
_ORACLES["balanced_tags"] = _with(
    "page_postings",
    more=f"allowed AS (SELECT id, {_allow('html')} AS html FROM page_postings), folded AS (SELECT id, html, list_reduce(list_concat([chr(1)],"
    f" regexp_extract_all(html, '(?i)</?(?:b|strong|u|i|br|p|ul|li|em)>|[^<]+|<')), lambda a, x: {_STEP}) AS a FROM allowed),"
    " closed AS (SELECT id, html, substr(a, instr(a, chr(1)) + 1) || replace(split_part(a, chr(1), 1), '<', '</') AS done FROM folded)",
) + "SELECT id, done AS html, done = html AS was_balanced FROM closed"
_ORACLES["strip_text"] = _STG + f"SELECT id, {_stripped('job_description')} AS stripped FROM staging"
_ORACLES["label_counts"] = _with(
    "page_postings",
    more=f"found AS (SELECT id, unnest(regexp_extract_all(html, {_q(_LABELS)})) AS label FROM page_postings)",
) + "SELECT label, count(DISTINCT id) AS postings, count(*) AS occurrences FROM found GROUP BY label"


def _part(pattern: str) -> str:
    return f"nullif(regexp_extract(html, {_q('(?s)' + pattern)}, 1), '')"


_ORACLES["posting_parts"] = _with(
    "page_postings", more=f"split1 AS (SELECT *, {_head('html')} AS head FROM page_postings)"
) + (
    f"SELECT id, {_part('Questa posizione è in (.*?)</strong>')} AS company,"
    f" {_stripped(_part(_SUMMARY + '(.*?)</p>'))} AS summary,"
    f" {_part(_CLOSING + r'(.*?)\.</em></p>')} AS closing_company,"
    f" {_part(_PLACES + '(.*?)</em>')} AS places,"
    f" {_rx('substr(html, length(head) + 1)', _LABELS)} AS body,"
    f" array_to_string(regexp_extract_all(html, {_q(_LABELS)}), ' ') AS labels FROM split1"
)
_ORACLES["intro_wrap"] = _PAGES + (
    "SELECT id, '<p><strong>Questa posizione è in ' || company || '</strong><p><br>'"
    " || '<p><strong>Riassunto dell''opportunità da parte della <i>Feed AI</i>:</strong>' || 'Per ' || company"
    " || '</p><br><br><br><p><em>Il processo di selezione sarà interamente gestito da ' || company || '.</em></p>'"
    " || '<br><br><p><em>Questa opportunità è disponibile su ' || url || '</em></p>' || html AS html FROM page_postings"
)
_REWRITTEN_PAGES = _with("page_postings", more=_rewrite_steps("page_postings", "html"))
_ORACLES["rewrite_default"] = _REWRITTEN_PAGES + "SELECT id, improved AS html FROM rewritten"
_ORACLES["rewrite_requests"] = _PAGES + (
    f"SELECT id, CASE WHEN html <> '' THEN {_q(INSTRUCTION)} || repeat(chr(10), 2) || 'Job description originale:'"
    " || repeat(chr(10), 2) || html END AS request FROM page_postings"
)
_ORACLES["rewrite_plugged"] = _PAGES + (
    "SELECT id, CASE WHEN html = '' THEN NULL WHEN contains(html, '[#J-ONE]') THEN html"
    f" ELSE {_stripped("'  <p>' || length(html) || '</p>' || html || chr(10)")} END AS html FROM page_postings"
)
_CUT = "CASE WHEN coalesce({0}, '') = '' THEN '(vuoto)' WHEN length({0}) > {1} THEN left({0}, {1}) || '... [troncato]' ELSE {0} END"
_FIRST = "id = (SELECT min(id) FROM staging)"
_ORACLES["text_preview"] = _with(
    "staging",
    more="ten AS (SELECT * FROM staging ORDER BY id LIMIT 10),\n" + _rewrite_steps("ten", "job_description"),
) + (
    f"SELECT id, position, {_NA.format('company')}, {_NA.format('location')},"
    f" CASE WHEN {_FIRST} THEN {_CUT.format('job_description', 10**9)} ELSE {_CUT.format('job_description', 800)} END AS original,"
    f" CASE WHEN {_FIRST} THEN {_CUT.format('improved', 10**9)} ELSE {_CUT.format('improved', 800)} END AS improved FROM rewritten"
)
_ORACLES["text_truncated"] = _with("doc_postings") + (
    f"SELECT id, {_CUT.format('description', 500)} AS description FROM doc_postings"
)

_RULES = ["tags_ok", "links_ok", "breaks_ok", "labels_ok", "labels_last", "head_ok", "text_ok", "summary_ok"]
_CHECKED = _with(
    "page_postings",
    more=_rewrite_steps("page_postings", "html").replace("rewritten AS", "rewritten0 AS").replace("formatted AS", "formatted0 AS").replace("FROM formatted)", "FROM formatted0)")
    + f""",
pairs AS (SELECT id, html, CASE WHEN contains(html, '[#J-REMOTE]') THEN html ELSE {_labels_last('whole')} END AS after, body AS old_body FROM rewritten0),
heads AS (SELECT *, {_head('after')} AS new_head, {_head('html')} AS old_head FROM pairs),
bodies AS (SELECT *, substr(after, length(new_head) + 1) AS new_body,
  nullif(regexp_extract(after, {_q('(?s)Questa posizione è in (.*?)</strong>')}, 1), '') AS company,
  nullif(regexp_extract(after, {_q('(?s)' + _CLOSING + r'(.*?)\.</em></p>')}, 1), '') AS closing,
  nullif(regexp_extract(after, {_q('(?s)' + _PLACES + '(.*?)</em>')}, 1), '') AS places,
  nullif(regexp_extract(after, {_q('(?s)' + _SUMMARY + '(.*?)</p>')}, 1), '') AS summary FROM heads),
rules AS (SELECT id,
  NOT regexp_matches({_rx('after', f'(?i)</?({_TAGS})>')}, '<[a-zA-Z/!?][^<>]*>') AS tags_ok,
  NOT (regexp_matches(new_body, '(?i)<a[ \\t\\r\\n\\f>]') OR regexp_matches(new_body, {_q(r'(?i)https?://[^ \t\r\n\f<>"]')})) AS links_ok,
  {_breaks_ok('new_body')} AS breaks_ok,
  list_sort(regexp_extract_all(html, {_q(_LABELS)})) = list_sort(regexp_extract_all(after, {_q(_LABELS)})) AS labels_ok,
  after = {_labels_last('after')} AS labels_last,
  coalesce(new_head = old_head OR (new_head <> '' AND company = closing AND places IS NOT NULL), FALSE) AS head_ok,
  {_plain('old_body')} = {_plain('new_body')} AS text_ok,
  coalesce(length({_plain('summary')}) <= 450, TRUE) AS summary_ok FROM bodies)
""",
)
_ALL_RULES = " AND ".join(_RULES)
_ORACLES["conformance"] = _CHECKED + f"SELECT *, {_ALL_RULES} AS conforms FROM rules"
_ORACLES["conformance_report"] = _CHECKED + "SELECT count(*) AS postings, {}, count(*) FILTER ({}) AS conforms FROM rules".format(
    ", ".join(f"count(*) FILTER ({r}) AS {r}" for r in _RULES), _ALL_RULES
)

# ---- loading: the new rows with their ids, rewritten ----

_NEXT_ID = "(SELECT max(id) FROM published)"
_FRESH = f"fresh AS (SELECT * FROM staging s WHERE NOT {_IN_PUB} AND {_OK})"
_LOADED = _with("staging", "published", more=f"{_FRESH},\n" + _rewrite_steps("fresh", "job_description"))
_LOADED_COLUMNS = ", ".join(
    {
        "id": f"CAST({_NEXT_ID} + row_number() OVER (ORDER BY id) AS BIGINT) AS id",
        "description": "improved AS description",
        "created_at": f"coalesce(created_at, {_RUN_TS}) AS created_at",
        "updated_at": f"coalesce(updated_at, {_RUN_TS}) AS updated_at",
    }.get(c, c)
    for c in _PUBLISHED_COLUMNS
)
_ORACLES["loaded_new"] = _LOADED + f"SELECT {_LOADED_COLUMNS} FROM rewritten"
_ORACLES["stream_new_postings"] = _ORACLES["loaded_new"]
_ORACLES["rejected_new"] = _with("staging", "published", more=f"violations AS ({_VIOLATIONS})") + (
    f"SELECT s.id, string_agg(v.problem, '; ' ORDER BY CASE {' '.join(f"WHEN v.problem LIKE '{c}:%' THEN {i}" for i, c in enumerate([*_WIDTHS, *_BYTES]))} END) AS reasons"
    f" FROM staging s JOIN violations v ON v.id = s.id WHERE NOT {_IN_PUB} GROUP BY s.id"
)
_ORACLES["sync_result"] = _LOADED + (
    f"SELECT {', '.join(_PUBLISHED_COLUMNS)} FROM published p WHERE NOT coalesce({_EXPIRED}, FALSE)"
    f" UNION ALL SELECT {_LOADED_COLUMNS} FROM rewritten"
)

# ---- deduplication ----

_RANKED = """ranked AS (SELECT *, CASE WHEN partner_job_id IS NULL OR partner_job_id = '' THEN 1 ELSE
  row_number() OVER (PARTITION BY partner_job_id ORDER BY coalesce(updated_at, created_at) DESC NULLS LAST,
                     CASE WHEN coalesce(updated_at, created_at) IS NULL THEN -id ELSE id END) END AS rn FROM published)"""
_DEDUP = _with("published", more=_RANKED)
_ORACLES["keep_latest"] = _DEDUP + "SELECT id, partner_job_id, position, description FROM ranked WHERE rn = 1"
_ORACLES["duplicates_to_remove"] = _DEDUP + "SELECT id, partner_job_id FROM ranked WHERE rn > 1"
_ORACLES["duplicate_examples"] = _DEDUP + (
    "SELECT id, partner_job_id, CAST(updated_at AS VARCHAR) AS updated_at FROM ranked WHERE rn > 1 ORDER BY id LIMIT 5"
)
_ORACLES["duplicate_groups"] = _PUB + (
    "SELECT partner_job_id, count(*) AS n FROM published WHERE partner_job_id <> '' GROUP BY partner_job_id HAVING count(*) > 1"
)
_ORACLES["dedup_counts"] = _DEDUP + (
    "SELECT count(*) AS total, count(*) FILTER (rn = 1) AS kept, count(*) FILTER (rn > 1) AS to_remove FROM ranked"
)
_ORACLES["incremental_latest"] = _DEDUP + (
    "SELECT partner_job_id, max(id) FILTER (rn = 1) AS id, count(*) AS n FROM ranked WHERE partner_job_id <> '' GROUP BY partner_job_id"
)
_ORACLES["stream_latest"] = _ORACLES["incremental_latest"]
# A row goes in the delta in which a better row of its key is there for the first time, and not before its own.
_ORACLES["incremental_removed"] = _with(
    "published",
    more=_RANKED + ", dealt AS (SELECT *, CASE id % 3 WHEN 1 THEN 0 WHEN 0 THEN 1 ELSE 2 END AS delta FROM ranked WHERE partner_job_id <> ''),"
    " firsts AS (SELECT partner_job_id, delta, min(rn) AS best FROM dealt GROUP BY ALL)",
) + (
    "SELECT d.id, d.partner_job_id, CAST(min(greatest(d.delta, f.delta)) AS INTEGER) AS delta FROM dealt d"
    " JOIN firsts f ON f.partner_job_id = d.partner_job_id AND f.best < d.rn GROUP BY d.id, d.partner_job_id"
)

# ---- versions of a table ----

_ORACLES["sync_actions"] = _BOTH + (
    f"SELECT 'staging' AS side, id, CASE WHEN {_IN_PUB} THEN 'skip' ELSE 'new' END AS action FROM staging s UNION ALL"
    f" SELECT 'published', id, CASE WHEN coalesce({_EXPIRED}, FALSE) THEN 'expire' ELSE 'keep' END FROM published p"
)
_ORACLES["indexed_keys"] = _BOTH + f"SELECT DISTINCT partner_job_id FROM staging s WHERE {_IN_PUB}"
_ORACLES["versioned_sync"] = _ORACLES["sync_result"]
_ORACLES["versioned_dedup"] = _ORACLES["keep_latest"]
_ORACLES["version_history"] = _with(
    "published", more=_RANKED.replace("ranked AS", "low AS (SELECT * FROM published WHERE id * 4 <= (SELECT max(id) FROM published) * 3), ranked AS").replace("FROM published)", "FROM low)")
    .replace("SELECT max(id) FROM low", "SELECT max(id) FROM published")
) + (
    "SELECT 1 AS version, 'load' AS commit, (SELECT count(*) FROM published) AS rows UNION ALL SELECT 2, 'range', (SELECT count(*) FROM low)"
    " UNION ALL SELECT 3, 'duplicates', (SELECT count(*) FROM ranked WHERE rn = 1) UNION ALL SELECT 4, 'anew', (SELECT count(*) FROM published)"
)
_ORACLES["snapshot_differences"] = _PUB + (
    "SELECT id, CAST(CASE WHEN id % 499 = 0 OR id % 487 = 0 THEN 1 ELSE 0 END AS BIGINT) AS missing,"
    " CAST(CASE WHEN id % 499 = 0 THEN 0 ELSE (CASE WHEN id % 487 = 0 THEN 1 ELSE 0 END) + (CASE WHEN id % 509 = 0 THEN 1 ELSE 0 END) END AS BIGINT) AS surplus"
    " FROM published WHERE id % 499 = 0 OR id % 487 = 0 OR id % 509 = 0"
)

# ---- feed ----

_DOCS = _with("doc_postings")
_DATE = "strftime({0}, '%a, %d %b %Y %H:%M:%S') || ' -0000'"
_BUILD_DATE = f"(SELECT {_DATE.format('max(last_build_date)')} FROM doc_postings)"


def _clean(expr: str) -> str:
    return _rx(f"coalesce({expr}, '')", r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]")


def _cdata(expr: str) -> str:
    return f"replace({_clean(expr)}, ']]>', ']]]]><![CDATA[>')"


_KEY_TEXT = "coalesce(nullif(partner_job_id, ''), CAST(id AS VARCHAR))"
_CHILDREN = {
    "partnerJobId": _KEY_TEXT, "company": "company", "title": "position", "description": "description",
    "applyUrl": "apply_url", "companyId": "company_id", "location": "location", "workplaceTypes": "workplace_types",
    "experienceLevel": "experience_level", "jobtype": "jobtype",
}
_JOB = "' <job>' || chr(10) || " + " || ".join(
    f"'  <{tag}>{' ' if tag == 'companyId' else ''}<![CDATA[' || {_cdata(value)} || ']]></{tag}>' || chr(10)"
    for tag, value in _CHILDREN.items()
) + " || ' </job>'"
_ORACLES["feed_build_date"] = _DOCS + f"SELECT {_BUILD_DATE} AS build_date"
_ORACLES["feed_rows"] = _DOCS + f"SELECT id, {_JOB} AS xml FROM doc_postings"
_ORACLES["feed_order"] = _DOCS + "SELECT row_number() OVER (ORDER BY id) AS place, id FROM doc_postings"
_ORACLES["feed_lines"] = _DOCS + (
    "SELECT 0 AS section, NULL AS id, '<?xml version=\"1.0\" encoding=\"UTF-8\"?>' || chr(10) || '<source>' || chr(10)"
    f" || ' <lastBuildDate> ' || {_BUILD_DATE} || ' </lastBuildDate>' AS xml"
    f" UNION ALL SELECT 1, id, {_JOB} FROM doc_postings UNION ALL SELECT 2, NULL, '</source>'"
)
_ORACLES["feed_round_trip"] = _DOCS + "SELECT {} FROM doc_postings".format(
    ", ".join(f"{_clean(value)} AS {tag}" for tag, value in _CHILDREN.items())
)
_ORACLES["feed_refreshed"] = _ORACLES["feed_round_trip"]
_ORACLES["feed_document"] = _DOCS + "SELECT {}, id % 37 = 0 AS malformed FROM doc_postings".format(
    ", ".join(
        f"{_clean(value)} AS {tag}" if tag == "partnerJobId" else f"CASE WHEN id % 37 <> 0 THEN {_clean(value)} END AS {tag}"
        for tag, value in _CHILDREN.items()
    )
)
_ORACLES["utf8_repair"] = (
    "SELECT doc_id, text || CASE doc_id % 3 WHEN 0 THEN chr(65533) || chr(65533) WHEN 1 THEN chr(65533) ELSE '' END AS text"
    " FROM documents"
)
_ORACLES["cdata_escape"] = _DOCS + f"SELECT id, {_cdata('description')} AS description FROM doc_postings"
_ORACLES["rfc_dates"] = f"SELECT event_id, {_DATE.format('ts')} AS rfc_date FROM events"

# ---- request log ----

_IP = """CASE WHEN x_forwarded_for <> '' THEN trim(split_part(x_forwarded_for, ',', 1))
  ELSE coalesce(nullif(x_real_ip, ''), peer_ip) END"""
_PRIVATE = """(ip IS NULL OR ip = '' OR ip = '::1' OR ip LIKE '127.%' OR ip LIKE '10.%' OR ip LIKE '192.168.%'
  OR (ip LIKE '172.%' AND coalesce(TRY_CAST(split_part(ip, '.', 2) AS INT) BETWEEN 16 AND 31, FALSE)))"""
_ADDRESSED = f"addressed AS (SELECT *, {_IP} AS ip FROM requests)"
_CHROME = "(contains(user_agent, 'Chrome/') AND contains(user_agent, 'Safari/'))"
_AGENT = f"""agents AS (SELECT *, nullif(user_agent, '') AS ua_original,
  CASE WHEN coalesce(user_agent, '') = '' THEN NULL WHEN {_CHROME} THEN 'Chrome'
       WHEN contains(user_agent, 'Safari/') THEN 'Safari' WHEN contains(user_agent, 'Firefox/') THEN 'Firefox' ELSE 'Unknown' END AS ua_name,
  nullif(CASE WHEN {_CHROME} THEN split_part(split_part(user_agent, 'Chrome/', 2), ' ', 1)
       WHEN contains(user_agent, 'Safari/') THEN NULL WHEN contains(user_agent, 'Firefox/') THEN split_part(user_agent, 'Firefox/', 2) END, '') AS ua_version,
  CASE WHEN contains(user_agent, 'Mac OS X') THEN 'Mac OS X' WHEN contains(user_agent, 'Windows') THEN 'Windows'
       WHEN contains(user_agent, 'Linux') THEN 'Linux' END AS ua_os,
  CASE WHEN contains(user_agent, 'Macintosh') THEN 'Mac' WHEN contains(user_agent, 'Windows') THEN 'PC' END AS ua_device
  FROM addressed)"""
_LOCATED = f"""located AS (SELECT a.*, g.ip IS NOT NULL AS has_geo, g.region_code, g.continent, g.city, g.country_code, g.country, g.region,
  CASE WHEN g.latitude IS NOT NULL THEN g.longitude END AS lon, CASE WHEN g.longitude IS NOT NULL THEN g.latitude END AS lat
  FROM agents a LEFT JOIN geo_dim g ON g.ip = a.ip AND NOT {_PRIVATE.replace('ip ', 'a.ip ').replace('(ip,', '(a.ip,')} AND coalesce(g.success, TRUE))"""
_LOG = _with("requests", "geo_dim", more=",\n".join([_ADDRESSED, _AGENT, _LOCATED]))
_GEO_COLUMNS = (
    "region_code AS region_iso_code, continent AS continent_name, city AS city_name, country_code AS country_iso_code,"
    " country AS country_name, region AS region_name, lon, lat"
)
_ORACLES["client_ip"] = _with("requests") + f"SELECT event_id, {_IP} AS client_ip FROM requests"
_ORACLES["private_ip"] = _with("requests", more=_ADDRESSED) + f"SELECT event_id, {_PRIVATE} AS is_private FROM addressed"
_ORACLES["user_agents"] = _with("requests", more=f"{_ADDRESSED},\n{_AGENT}") + (
    "SELECT event_id, ua_original AS original, ua_name AS name, ua_version AS version, ua_os AS os, ua_device AS device FROM agents"
)
_CORS = {
    "access-control-allow-origin": "origin",
    "access-control-allow-credentials": "CASE WHEN method = 'POST' THEN 'true' END",
    "access-control-allow-headers": "CAST(NULL AS VARCHAR)",
    "access-control-allow-methods": "method || ', OPTIONS'",
}
_ORACLES["cors_headers"] = _with("requests") + "SELECT event_id, {} FROM requests".format(
    ", ".join(f"{value} AS {name.replace('-', '_')}" for name, value in _CORS.items())
)
_ORACLES["log_geo"] = _LOG + f"SELECT event_id, ip AS client_ip, has_geo, {_GEO_COLUMNS} FROM located"
_AUTH = "CASE WHEN authorization <> '' THEN sha256(authorization) END".replace("authorization", '"authorization"')
_MS = "ended_ns // 1000000"
_DURATION = "(ended_ns - started_ns) // 1000000"
_ORACLES["log_payload"] = _LOG + (
    f"SELECT event_id, {_MS} AS time, {_AUTH} AS \"authorization\", method, origin, url_path, url_path AS url_original, url_scheme,"
    f" url_domain, ua_name, status_code, {_DURATION} AS duration_ms, origin AS access_control_allow_origin, ip, {_GEO_COLUMNS} FROM located"
)


def _json(expr: str) -> str:
    return f"coalesce(CAST(to_json({expr}) AS VARCHAR), 'null')"


def _member(name: str, text: str) -> str:
    return f"'\"{name}\":' || {text}"


def _object(*members: tuple[str, str, bool]) -> str:
    """Members are name, value text and whether a NULL value text leaves the member out."""
    parts = [_member(n, t) if must else f"CASE WHEN ({t}) IS NOT NULL THEN {_member(n, t)} END" for n, t, must in members]
    return f"'{{' || concat_ws(',', {', '.join(parts)}) || '}}'"


def _maybe(expr: str) -> str:
    return f"CAST(to_json({expr}) AS VARCHAR)"


_GEO_JSON = _object(
    *[(n, _json(c), True) for n, c in (
        ("region_iso_code", "region_code"), ("continent_name", "continent"), ("city_name", "city"),
        ("country_iso_code", "country_code"), ("country_name", "country"), ("region_name", "region"))],
    ("location", f"CASE WHEN lon IS NOT NULL THEN {_object(('lon', _json('lon'), True), ('lat', _json('lat'), True))} END", False),
)
_LINE = _object(
    ("level", "'\"INFO\"'", True),
    ("logger", "'\"postfeed\"'", True),
    ("time", f"CAST({_MS} AS VARCHAR)", True),
    ("request", _object(
        ("authorization", _maybe(_AUTH), False),
        ("method", _json("method"), True),
        ("origin", _json("origin"), True),
        ("url", _object(("path", _json("url_path"), True), ("original", _json("url_path"), True),
                        ("scheme", _json("url_scheme"), True), ("domain", _json("url_domain"), True)), True),
        ("user_agent", _object(
            ("original", _maybe("ua_original"), False), ("name", _maybe("ua_name"), False), ("version", _maybe("ua_version"), False),
            ("os", "CASE WHEN ua_os IS NOT NULL THEN '{\"name\":' || to_json(ua_os)::VARCHAR || '}' END", False),
            ("device", "CASE WHEN ua_device IS NOT NULL THEN '{\"name\":' || to_json(ua_device)::VARCHAR || '}' END", False)), True)), True),
    ("response", _object(("status_code", "CAST(status_code AS VARCHAR)", True), ("time", f"CAST({_DURATION} AS VARCHAR)", True),
                         *[(h, _maybe(v), False) for h, v in _CORS.items()]), True),
    ("destination", _object(("ip", _json("ip"), True), ("geo", f"CASE WHEN has_geo THEN {_GEO_JSON} END", False)), True),
)
_ORACLES["access_log_json"] = _LOG + f"SELECT event_id, {_LINE} AS line FROM located"
_ORACLES["stream_access_log"] = _LOG + f"SELECT {_LINE} AS line FROM located"
_ORACLES["log_compacted"] = _ORACLES["stream_access_log"]
_ORACLES["stream_progress"] = _BOTH + (
    "SELECT 'run-1' AS run_id, processed, total, CASE WHEN total > 0 THEN CAST(printf('%.1f', processed / total * 100) AS DOUBLE) ELSE 0 END AS percentage,"
    " processed >= total AND total > 0 AS complete, CASE WHEN sample = 1 THEN processed ELSE 0 END AS new_records"
    " FROM range(1, 4) samples(sample), (SELECT (SELECT count(*) FROM published) AS processed, (SELECT count(*) FROM staging) AS total) c"
)
