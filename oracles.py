"""The registered queries in DuckDB SQL, written from the rules, not from the
Spark plans.

The SQL engine's regular expressions have no look-around and an ASCII word
boundary.  Whether a pattern matches is therefore asked with a boundary that
takes up a character; for counts and places of matches, letters and digits
beyond ASCII are first replaced by an underscore each, which is a word
character to the ASCII boundary too.
"""

from __future__ import annotations

import re

from promptsieve.functions import catalogue as C
from promptsieve.functions.redaction import REDACTIONS
from workloads import LINES_PER_FILE_KEY, SENTENCES

N = r"[^\p{L}\p{N}_]"
SPACES = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]+"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def unicode_bounds(pattern: str) -> str:
    """A pattern for yes-or-no questions, with Unicode word boundaries."""
    out = re.sub(
        r"\\b\.\{0,(\d+)\}\\b(?!\[)",
        lambda m: f"(?:{N}|{N}.{{0,{int(m.group(1)) - 2}}}{N})",
        pattern,
    )
    if out.startswith(r"\b") and not out.startswith(r"\b(?:\+"):
        out = f"(?:^|{N})" + out[2:]
    if out.endswith(r"\b") and not out.endswith(r"]{8,}\b"):
        out = out[:-2] + f"(?:$|{N})"
    return "(?is)" + out


def ascii_words(text: str) -> str:
    return rf"regexp_replace({text}, '[^\x00-\x7F\P{{L}}]|[^\x00-\x7F\P{{N}}]', '_', 'g')"


def term_bounds(*terms: str) -> str:
    return f"(?i)(?:^|{N})(?:{'|'.join(map(re.escape, terms))})(?:$|{N})"


def luhn(number: str) -> str:
    digits = f"regexp_replace({number}, '\\D', '', 'g')"
    digit = f"CAST(substr({digits}, length({digits}) - k, 1) AS INT)"
    doubled = f"CASE WHEN k % 2 = 0 THEN {digit} WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END"
    return f"list_sum(list_transform(range(0, length({digits})), lambda k: {doubled})) % 10 = 0"


def match_rows(source: str, keys: str, text: str, pattern: str) -> str:
    """One row per match: keys, i, start_at, end_at, found, evidence."""
    sp, pat = q(SPACES), q(pattern)
    real = "lambda x: x <> ''"
    return f"""SELECT {keys}, i, start_at, end_at, m[i] AS found,
      array_to_string(list_slice(w, greatest(fw - 8, 0) + 1, lw + 9), ' ') AS evidence
    FROM (SELECT *, len(list_filter(string_split_regex(substr(t, 1, start_at + 1), {sp}), {real})) - 1 AS fw,
        len(list_filter(string_split_regex(substr(t, 1, end_at), {sp}), {real})) - 1 AS lw
      FROM (SELECT *, start_at + length(m[i]) AS end_at
        FROM (SELECT *, CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS INT) AS start_at
          FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i
            FROM (SELECT {keys}, {text} AS t, string_split_regex({ascii_words(text)}, {pat}) AS g,
                regexp_extract_all({ascii_words(text)}, {pat}) AS m,
                list_filter(string_split_regex({text}, {sp}), {real}) AS w
              FROM {source}) WHERE len(m) > 0))))"""


PLANT = f"text || ' ' || ([{', '.join(map(q, SENTENCES))}])[(conv_id * 7 + turn) % {len(SENTENCES)} + 1]"
PROMPTS = f"""prompts AS (SELECT conv_id, turn, {PLANT} AS prompt, 'user_' || (conv_id % 10) AS user_id,
  CASE WHEN conv_id % 10 = 0 THEN NULL WHEN conv_id % 10 = 1 THEN ''
    ELSE 'user' || (conv_id % 10) || '@example.test' END AS user_email
  FROM conversations WHERE role = 'user')"""

RULES = {r.category: r for r in C.PERSONAL_DATA_RULES + C.INTERNAL_POLICY_RULES + C.USAGE_POLICY_RULES}
CARD = RULES["pii_credit_card"].patterns[0].regex
CONTACT_RULES = [r for r in RULES.values() if r.kind == "contact"]


def _contact_rows(source: str, keys: str, text: str) -> str:
    parts = []
    for rule in CONTACT_RULES:
        rows = match_rows(source, keys, text, "(?i)" + rule.patterns[0].regex)
        parts.append(
            f"SELECT {keys}, {q(rule.category)} AS category, start_at, end_at, evidence FROM ({rows}) "
            f"WHERE regexp_matches(evidence, {q(term_bounds(*C.CONTACT_CONTEXT_TERMS))})"
        )
    return " UNION ALL ".join(parts)


def _has(text: str, terms) -> str:
    return f"regexp_matches({text}, {q(term_bounds(*terms))})"


def _phi_terms(text: str) -> str:
    cases = ", ".join(f"CASE WHEN {_has(text, (t,))} THEN {q(t)} END" for t in C.PHI_TERMS)
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


def _phi_strong(terms: str) -> str:
    strong = ", ".join(map(q, C.PHI_STRONG_TERMS))
    return f"(len({terms}) >= 2 OR list_has_any({terms}, [{strong}]))"


def _client(text: str) -> tuple[str, str]:
    """(strong, weak) conditions."""
    client = _has(text, C.CLIENT_TERMS)
    sensitive = f"({_has(text, C.SENSITIVE_DOCUMENT_TERMS)} OR {_has(text, C.SENSITIVE_DATA_TERMS)})"
    return f"({client} AND {sensitive})", f"({client} AND NOT {sensitive} AND {_has(text, C.ANALYSIS_TERMS)})"


def _matches(rule: C.Rule, text: str) -> str:
    if rule.kind == "card":
        return f"len(list_filter(regexp_extract_all({text}, {q(CARD)}), lambda c: {luhn('c')})) > 0"
    if rule.kind == "contact":
        return f"list_contains(coalesce(contacts, []), {q(rule.category)})"
    tests = (f"regexp_matches({text}, {q(unicode_bounds(p.regex))})" for p in rule.patterns)
    return "(" + " OR ".join(tests) + ")"


def classified(source: str, keys: str) -> str:
    """CTEs ending in `classified`: `source` rows (keys, prompt, ...) with verdicts."""
    text = "prompt"
    strong, weak = _client(text)

    def found(test: str, category: str, score: int, confidence: str, reason: str) -> str:
        entry = (
            f"{{'category': {q(category)}, 'score': {score}, 'confidence': {q(confidence)}, "
            f"'reason': {q(reason)}}}"
        )
        return f"CASE WHEN {test} THEN {entry} END"

    def of(rules) -> list[str]:
        return [found(_matches(r, text), r.category, r.score, r.confidence, r.reason) for r in rules]

    phi_strong = _phi_strong("phi")
    entries = of(C.PERSONAL_DATA_RULES)
    entries.append(found(f"len(phi) > 0 AND {phi_strong}", C.PHI_CATEGORY, *C.PHI_STRONG, C.PHI_REASON))
    entries.append(found(f"len(phi) > 0 AND NOT {phi_strong}", C.PHI_CATEGORY, *C.PHI_WEAK, C.PHI_REASON))
    entries += of(C.INTERNAL_POLICY_RULES)
    entries.append(found(strong, *C.CLIENT_STRONG))
    entries.append(found(weak, *C.CLIENT_WEAK))
    entries += of(C.USAGE_POLICY_RULES)
    names = "list_transform(f, lambda x: x.category)"
    levels = " ".join(f"WHEN risk_score >= {floor} THEN {q(name)}" for name, floor in C.LEVEL_FLOORS)
    best = " ".join(
        f"WHEN list_contains(list_transform(f, lambda x: x.confidence), {q(c)}) THEN {q(c)}"
        for c in C.CONFIDENCES
    )
    return f"""contact_rows AS ({_contact_rows(source, keys, text)}),
    contact_lists AS (SELECT {keys}, list(DISTINCT category) AS contacts FROM contact_rows GROUP BY {keys}),
    found AS (SELECT *, list_filter([{', '.join(entries)}], lambda x: x IS NOT NULL) AS f
      FROM (SELECT s.*, contacts, {_phi_terms('s.prompt')} AS phi
        FROM {source} s LEFT JOIN contact_lists USING ({keys}))),
    scored AS (SELECT *, CAST(CASE WHEN len(f) = 0 THEN 0 ELSE least(100,
        list_max(list_transform(f, lambda x: x.score)) + least(10, 2 * (len(f) - 1))) END AS INT) AS risk_score
      FROM found),
    classified AS (SELECT *, CASE {levels} ELSE 'none' END AS risk_level,
        CASE {best} ELSE 'none' END AS confidence, len(f) > 0 AS needs_human_review,
        array_to_string(list_sort({names}), '; ') AS categories,
        array_to_string(list_transform(f, lambda x: x.reason), ' | ') AS reasons
      FROM scored)"""


def pattern_counts(source: str, keys: str, text: str, rules) -> str:
    """Matches per row and category of plain rules."""
    parts = []
    for rule in rules:
        counts = " + ".join(
            f"len(regexp_extract_all(t, {q('(?is)' + p.regex)}))" for p in rule.patterns
        )
        parts.append(f"{{'category': {q(rule.category)}, 'matches': CAST({counts} AS BIGINT)}}")
    return f"""SELECT {keys}, c.category AS category, c.matches AS matches
      FROM (SELECT {keys}, unnest([{', '.join(parts)}]) AS c
        FROM (SELECT {keys}, {ascii_words(text)} AS t FROM {source})) WHERE c.matches > 0"""


SHAPE = "(conv_id + turn) % 5"
MESSAGE = "'msg_' || conv_id || '_' || turn"
EVENT = "'evt_' || conv_id || '_' || turn"
CONV = "'conv_' || conv_id"
USER = "'user_' || (conv_id % 10)"
EMAIL = f"{USER} || '@example.test'"
STAMP = "printf('2026-05-01T%02d:{:02d}:00Z', turn)"


def envelope(content: str) -> str:
    item = f"json_object('message_id', {MESSAGE}, 'role', role, 'content', {content}, 'email', {EMAIL})"
    other = f"json_object('message_id', {MESSAGE}, 'role', role, 'content', {content} || ' (edited)', 'email', {EMAIL})"
    return f"""CAST(CASE {SHAPE}
      WHEN 0 THEN json_object('id', {EVENT}, 'conversation_id', {CONV}, 'user_id', {USER}, 'created_at', {STAMP.format(0)},
        'message', json_object('id', {MESSAGE}, 'role', role, 'content', {content}))
      WHEN 1 THEN json_object('event_id', {EVENT}, 'conversation', json_object('id', {CONV}),
        'message', json_object('id', {MESSAGE}, 'author', json_object('role', role, 'id', {USER}),
          'content', json_object('content_type', 'text', 'parts', json_array({content})), 'create_time', 1770000000 + turn))
      WHEN 2 THEN json_object('event_id', {EVENT}, 'type', 'CONVERSATION_MESSAGE',
        'actor', json_object('type', role, 'user_id', {USER}, 'user_email', {EMAIL}), 'timestamp', {STAMP.format(1)},
        'conversation', json_object('id', {CONV}, 'title', 'q'),
        'message', json_object('id', {MESSAGE}, 'author', json_object('type', role),
          'content', json_object('type', 'text', 'value', {content}), 'created_at', {STAMP.format(0)}))
      WHEN 3 THEN json_array({item}, {item}, {other})
      ELSE json_object('log_id', {EVENT}, 'conversation', {CONV}, 'sender', json_object('type', upper(role), 'email', {EMAIL}),
        'time', {STAMP.format(2)}, 'text', {content},
        'children', json_array(json_object('senderRole', role, 'prompt', 'nested', 'messageId', {MESSAGE}))) END AS VARCHAR)"""


RECORDS = f"""records AS (SELECT conv_id, turn, role, text, {SHAPE} AS shape, {envelope('text')} AS record_json FROM conversations)"""
IS_RESPONSE = """lower(coalesce(json_extract_string(record_json, '$.message.role'),
    json_extract_string(record_json, '$.message.author.role'), json_extract_string(record_json, '$.message.author.type'),
    CASE WHEN shape = 4 THEN json_extract_string(record_json, '$.sender.type') END, '')) IN ('assistant', 'model')"""

# Prompts of a record, by the shape of its envelope.
EXTRACTED = f"""extracted AS (
  SELECT conv_id, turn, 0 AS prompt_no, json_extract_string(j, '$.event_id') AS event_id,
    coalesce(json_extract_string(j, '$.conversation_id'), json_extract_string(j, '$.conversation.id')) AS conversation_id,
    json_extract_string(j, '$.message.id') AS message_id,
    coalesce(json_extract_string(j, '$.message.author.id'), json_extract_string(j, '$.user_id'),
      json_extract_string(j, '$.actor.user_id')) AS user_id,
    json_extract_string(j, '$.actor.user_email') AS user_email,
    coalesce(json_extract_string(j, '$.message.created_at'), json_extract_string(j, '$.message.create_time'),
      json_extract_string(j, '$.created_at')) AS created_at,
    coalesce(json_extract_string(j, '$.message.content.parts[0]'), json_extract_string(j, '$.message.content.value'),
      json_extract_string(j, '$.message.content')) AS content
  FROM (SELECT *, record_json AS j FROM walked) WHERE role = 'user' AND shape < 3
  UNION ALL
  SELECT conv_id, turn, k, NULL, NULL, json_extract_string(j, '$.message_id'), NULL, json_extract_string(j, '$.email'),
    NULL, json_extract_string(j, '$.content')
  FROM (SELECT conv_id, turn, unnest([0, 1]) AS k, json_extract(record_json, '$[' || (2 * unnest([0, 1])) || ']') AS j
    FROM walked WHERE role = 'user' AND shape = 3)
  UNION ALL
  SELECT conv_id, turn, k, NULL, json_extract_string(record_json, '$.conversation'),
    CASE WHEN k = 1 THEN json_extract_string(record_json, '$.children[0].messageId') END,
    json_extract_string(record_json, '$.sender.email'), json_extract_string(record_json, '$.sender.email'),
    json_extract_string(record_json, '$.time'),
    json_extract_string(record_json, CASE WHEN k = 0 THEN '$.text' ELSE '$.children[0].prompt' END)
  FROM (SELECT *, unnest([0, 1]) AS k FROM walked WHERE role = 'user' AND shape = 4))"""

PAGE = "conv_id * 100 + turn"
LOG = "'log_' || conv_id || '_' || turn"
UNPARSED = f"""CAST(json_object('_unparsed_log_line', line, 'source_log_id', {LOG}, 'line_number', line_number) AS VARCHAR)"""
NO_UNIT = "{'record_no': CAST(NULL AS BIGINT), 'line_number': CAST(NULL AS BIGINT), 'parse_ok': CAST(NULL AS BOOLEAN), 'item': false, 'line': CAST(NULL AS VARCHAR)}"


def unit(no: int, line: str, line_number: str = "NULL", ok: str = "true", item: str = "false") -> str:
    return f"{{'record_no': {no}, 'line_number': {line_number}, 'parse_ok': {ok}, 'item': {item}, 'line': {line}}}"


# A body that is a list is taken apart: each message is a record of its own.
ITEMS = ", ".join(unit(i, f"CAST(json_extract(record_json, '$[{i}]') AS VARCHAR)", item="true") for i in range(3))
UNITS = f"""units AS (SELECT *, {PAGE} AS page_no, CASE WHEN conv_id % 4 = 1 THEN 1 ELSE 0 END AS entry_no, {LOG} AS log_id,
    u.record_no AS record_no, u.line_number AS line_number, u.parse_ok AS parse_ok, u.line AS line,
    CASE WHEN u.item THEN role = 'assistant' ELSE u.parse_ok AND u.record_no = 0 AND {IS_RESPONSE} END AS is_response,
    CASE WHEN role <> 'user' THEN 0 WHEN u.item THEN 1 WHEN u.record_no = 0 AND shape >= 3 THEN 2
      WHEN u.record_no = 0 THEN 1 ELSE 0 END AS n_prompts
  FROM (SELECT *, unnest(CASE
      WHEN (conv_id * 3 + turn) % 7 = 0 THEN [{NO_UNIT}]
      WHEN (conv_id * 3 + turn) % 7 = 1 THEN [{unit(0, 'record_json')}, {unit(1, "'1'")}]
      WHEN (conv_id * 3 + turn) % 7 = 2 THEN [{unit(0, 'record_json', '1')},
        {unit(1, """'{"broken":'""", '3', 'false')}, {unit(2, "record_json || ' x'", '4', 'false')}]
      WHEN shape = 3 THEN [{ITEMS}]
      ELSE [{unit(0, 'record_json')}] END) AS u FROM records))"""

LINES = f"""line_records AS (SELECT conv_id, turn, role, {SHAPE} AS shape, conv_id // {LINES_PER_FILE_KEY} AS part,
    {envelope(PLANT)} AS record_json FROM conversations),
  all_lines AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY conv_id, turn, pos) AS line_number FROM (
    SELECT *, unnest(ls) AS line, unnest(range(0, len(ls))) AS pos FROM (
      SELECT *, CASE conv_id % 17 WHEN 0 THEN [record_json, '{{"broken": "' || turn]
        WHEN 1 THEN [record_json, '', '{{}}x'] WHEN 2 THEN [record_json, ''] ELSE [record_json] END AS ls FROM line_records))),
  lines AS (SELECT part, line_number, line, pos = 0 AS is_json, conv_id, turn, role, shape, record_json
    FROM all_lines WHERE line <> ''),
  walked AS (SELECT * FROM lines WHERE is_json)"""


def redacted(text: str) -> str:
    for pattern, label, ignore_case in REDACTIONS:
        text = f"regexp_replace({text}, {q(('(?i)' if ignore_case else '') + pattern)}, {q(label)}, 'g')"
    return f"trim(regexp_replace({text}, {q(SPACES)}, ' ', 'g'))"


def build() -> dict[str, str]:
    verdicts = f"WITH {PROMPTS}, {classified('prompts', 'conv_id, turn')}"
    plain = [r for r in RULES.values() if r.kind == "regex"]
    personal = [r for r in C.PERSONAL_DATA_RULES if r.kind == "regex"]
    policies = list(C.INTERNAL_POLICY_RULES + C.USAGE_POLICY_RULES)
    user = "coalesce(nullif(user_email, ''), nullif(user_id, ''), '<unknown>')"
    strong, weak = _client("prompt")
    client_rows = match_rows("prompts", "conv_id, turn", "prompt", r"(?i)\bclient\b")
    email = RULES["pii_email_with_sensitive_context"].patterns[0].regex
    phone = RULES["pii_phone_with_sensitive_context"].patterns[0].regex
    secret = RULES["credentials_or_secrets"].patterns[0].regex
    by_level = ", ".join(f"count(*) FILTER (risk_level = {q(v)}) AS \"{v}\"" for v in C.LEVELS)
    pages = """pages AS (SELECT event_id // 100 AS page_no, strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS last_end_time
      FROM events WHERE event_type = 'purchase' AND ts > TIMESTAMP '2024-01-10 00:00:00' GROUP BY 1)"""
    warnings = f"""SELECT page_no, entry_no, 0 AS phase, CAST(NULL AS BIGINT) AS record_no, 'empty_body' AS kind,
        'Downloaded log id ' || log_id || ' was empty' AS warning FROM units WHERE record_no IS NULL
      UNION ALL SELECT page_no, entry_no, 0, record_no, 'unparsed_line',
        'Could not parse line ' || line_number || ' from log id ' || log_id || '; stored as raw text' FROM units WHERE NOT parse_ok
      UNION ALL SELECT page_no, entry_no, 1, record_no, 'no_prompt', 'No user prompt extracted from log id ' || log_id
        FROM units WHERE record_no IS NOT NULL AND NOT is_response AND n_prompts = 0
      UNION ALL SELECT {PAGE}, 1, 0, NULL, 'bad_entry', 'Skipped log listing entry without an id' FROM conversations WHERE conv_id % 4 = 0
      UNION ALL SELECT {PAGE}, 0, 0, NULL, 'bad_entry', 'Skipped non-object log listing entry' FROM conversations WHERE conv_id % 4 = 1"""
    kept_phi = "len(phi) > 0"
    line_verdicts = f"""WITH {LINES}, {EXTRACTED},
      scanned AS (SELECT conv_id, turn, prompt_no, user_email, user_id, content AS prompt FROM extracted),
      {classified('scanned', 'conv_id, turn, prompt_no')}"""
    queries = {
        "role_filter": f"WITH {RECORDS} SELECT conv_id, turn, {IS_RESPONSE} AS is_response FROM records",
        "log_cursor": f"""WITH {pages} SELECT '2024-01-10T00:00:00Z' AS "after",
            max_by(last_end_time, page_no) AS completed_through, count(*) AS pages_fetched,
            strftime(TIMESTAMP '2024-02-09 00:00:00' - INTERVAL 30 DAY, '%Y-%m-%dT%H:%M:%SZ') AS window_start FROM pages""",
        "decode_payload": f"""WITH {RECORDS}, {UNITS} SELECT log_id, record_no, line_number, parse_ok,
            CASE WHEN parse_ok THEN line ELSE {UNPARSED} END AS record_json FROM units WHERE record_no IS NOT NULL""",
        "export_warnings": f"WITH {RECORDS}, {UNITS} {warnings}",
        "manifest": f"""WITH {RECORDS}, {UNITS}, warned AS ({warnings}),
            listed AS (SELECT count(*) AS n, max_by({STAMP.format(0)} || printf('.%05d', conv_id), {PAGE}) AS reached FROM conversations)
          SELECT '2026-05-07T00:00:00Z' AS generated_at, 'org-1' AS principal_id, 'organization' AS scope_type,
            'CONVERSATION_MESSAGE' AS event_type, '2026-04-07T00:00:00Z' AS "after",
            (SELECT reached FROM listed) AS completed_through, 30 AS days, 100 AS "limit",
            (SELECT n FROM listed) AS pages_fetched, (SELECT n FROM listed) AS log_files_listed,
            (SELECT n FROM listed) AS log_files_downloaded, count(record_no) AS raw_records_downloaded,
            count(*) FILTER (is_response) AS gpt_response_records_filtered,
            count(*) FILTER (record_no IS NOT NULL AND NOT is_response) AS raw_records_written,
            CAST(sum(CASE WHEN record_no IS NOT NULL AND NOT is_response THEN n_prompts ELSE 0 END) AS BIGINT) AS prompt_records_written,
            (SELECT count(*) FROM warned) AS warning_count FROM units""",
        # A log's prompts are in its first record, but a list has a record per item:
        # the first prompt is in the first two, the second in the third.
        "export_review": f"""WITH {RECORDS}, {UNITS}, walked AS (SELECT * FROM records), {EXTRACTED},
            numbered AS (SELECT *, row_number() OVER (ORDER BY page_no, entry_no, record_no) AS raw_line
              FROM units WHERE record_no IS NOT NULL AND NOT is_response),
            scanned AS (SELECT raw_line, CASE WHEN n.item THEN 0 ELSE e.prompt_no END AS prompt_no, e.conversation_id,
                e.message_id, e.user_email, e.content AS prompt
              FROM (SELECT *, u.item AS item FROM numbered) n JOIN extracted e ON n.conv_id = e.conv_id AND n.turn = e.turn
                AND CASE WHEN n.item THEN e.prompt_no = n.record_no // 2 ELSE n.record_no = 0 END),
            {classified('scanned', 'raw_line, prompt_no')}
          SELECT raw_line AS line_number, prompt_no, conversation_id, message_id, user_email, risk_level, risk_score,
            categories, prompt FROM classified""",
        "scan_lines": f"WITH {LINES} SELECT part, line_number, is_json, line FROM lines",
        "invalid_lines": f"""WITH {LINES} SELECT part, line_number, 'high' AS risk_level, 70 AS risk_score, 'high' AS confidence,
            true AS needs_human_review, 'input_quality' AS categories, substr(line, 1, 260) AS matched_evidence, line AS prompt
          FROM lines WHERE NOT is_json""",
        "scan_counters": f"""WITH {LINES}, {EXTRACTED}, scanned AS (SELECT conv_id, turn, prompt_no, content AS prompt FROM extracted),
            {classified('scanned', 'conv_id, turn, prompt_no')}
          SELECT (SELECT count(*) FROM lines) AS records_seen,
            (SELECT count(*) FROM walked WHERE {IS_RESPONSE}) AS assistant_records_skipped,
            count(*) AS prompt_records_seen,
            count(*) FILTER (risk_level <> 'none') + (SELECT count(*) FROM lines WHERE NOT is_json) AS flagged_prompts FROM classified""",
        "extract_prompts": f"""WITH {RECORDS}, walked AS (SELECT * FROM records), {EXTRACTED}
          SELECT e.*, CASE WHEN {SHAPE} IN (0, 4) THEN {EVENT} END AS source_log_id FROM extracted e""",
        # Only a prompt without a message id, the first of the last shape, comes twice.
        "dedup_prompts": f"""WITH {RECORDS}, walked AS (SELECT * FROM records), {EXTRACTED},
            listed AS (SELECT conv_id, turn, prompt_no, message_id, content FROM extracted
              UNION ALL SELECT conv_id, turn, 2, message_id, content FROM extracted WHERE {SHAPE} = 4 AND prompt_no = 0)
          SELECT * FROM listed
          UNION ALL SELECT conv_id, turn, CASE WHEN {SHAPE} < 3 THEN 1 WHEN {SHAPE} = 3 THEN 2 ELSE 3 END + unnest([0, 1]),
            CAST(turn + 1 AS VARCHAR), 'x' FROM conversations WHERE role = 'user'""",
        "prompt_text": """SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN text || chr(10) || role || chr(10)
            WHEN 1 THEN text WHEN 2 THEN '{"kind": "image", "parts_of": {"a": 1, "b": [true, null]}}'
            WHEN 3 THEN text || chr(10) || 'tail' || chr(10) || '{"n": 2}'
            ELSE CASE WHEN conv_id % 2 = 0 THEN text || repeat(chr(10), 20) ELSE '17' END END AS prompt FROM conversations""",
        "rule_hits": f"WITH {PROMPTS} {pattern_counts('prompts', 'conv_id, turn', 'prompt', plain)}",
        "pii_hits": pattern_counts("documents", "doc_id", "text", personal),
        "card_hits": f"""SELECT doc_id, start_at, end_at, evidence FROM ({match_rows('documents', 'doc_id', 'text', CARD)})
          WHERE {luhn('found')}""",
        "contact_hits": f"""WITH {PROMPTS} {_contact_rows('prompts', 'conv_id, turn', 'prompt')}""",
        "phi_hits": f"""WITH {PROMPTS} SELECT conv_id, turn, CASE WHEN {_phi_strong('phi')} THEN 94 ELSE 68 END AS score,
            CASE WHEN {_phi_strong('phi')} THEN 'high' ELSE 'medium' END AS confidence,
            'acceptable_use_policy' AS source
          FROM (SELECT *, {_phi_terms('prompt')} AS phi FROM prompts) WHERE {kept_phi}""",
        "client_hits": f"""WITH {PROMPTS}, windows AS ({client_rows})
          SELECT p.conv_id, p.turn, CASE WHEN {strong} THEN '{C.CLIENT_STRONG[0]}' ELSE '{C.CLIENT_WEAK[0]}' END AS category,
            CASE WHEN {strong} THEN {C.CLIENT_STRONG[1]} ELSE {C.CLIENT_WEAK[1]} END AS score,
            coalesce(w.evidence, substr(prompt, 1, 260)) AS evidence
          FROM prompts p LEFT JOIN windows w ON p.conv_id = w.conv_id AND p.turn = w.turn AND w.i = 1
          WHERE {strong} OR {weak}""",
        "policy_hits": f"""WITH {PROMPTS} SELECT *, CASE WHEN category IN ({', '.join(q(r.category) for r in C.INTERNAL_POLICY_RULES)})
            THEN 'acceptable_use_policy' ELSE 'usage_policy' END AS source
          FROM ({pattern_counts('prompts', 'conv_id, turn', 'prompt', policies)})""",
        "evidence_windows": " UNION ALL ".join(
            f"SELECT doc_id, {q(name)} AS category, start_at, end_at, evidence FROM ({match_rows('documents', 'doc_id', 'text', flags + pattern)})"
            for name, flags, pattern in (("email", "(?is)", email), ("phone", "(?is)", phone), ("secret", "(?is)", secret))
        ),
        "classify": f"""{verdicts} SELECT conv_id, turn, risk_level, risk_score, confidence, needs_human_review,
            categories, reasons, prompt FROM classified""",
        "flagged": f"""{verdicts} SELECT conv_id, turn, risk_level, risk_score, categories FROM classified WHERE risk_level <> 'none'""",
        "redact": f"""SELECT doc_id, CASE WHEN length(t) <= 260 THEN t ELSE rtrim(substr(t, 1, 257)) || '...' END AS excerpt
          FROM (SELECT doc_id, {redacted('text')} AS t FROM documents)""",
        "by_user": f"""{verdicts} SELECT {user} AS user_email, count(*) AS total_prompts,
            count(*) FILTER (risk_level <> 'none') AS flagged_prompts, max(risk_score) AS max_risk_score, {by_level}
          FROM classified GROUP BY {user}""",
        "by_category": f"""{verdicts} SELECT category, count(*) AS "count", max(risk_score) AS max_risk_score,
            count(DISTINCT u) AS users_affected
          FROM (SELECT unnest(list_transform(f, lambda x: x.category)) AS category, risk_score, {user} AS u FROM classified)
          GROUP BY category""",
        "by_risk_level": f"""{verdicts} SELECT l.risk_level, count(c.conv_id) AS "count"
          FROM (SELECT unnest([{', '.join(map(q, C.LEVELS))}]) AS risk_level) l
          LEFT JOIN classified c ON c.risk_level = l.risk_level GROUP BY l.risk_level""",
        "clean_cells": """SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(CASE WHEN doc_id % 3 > 0 THEN text || lang END, '') AS cell,
            coalesce(CASE WHEN doc_id % 5 > 0 THEN '{"a": {"sizes": [' || coalesce(CAST(n_chars AS VARCHAR), 'null') || ', null], "text": '
              || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || '}, "b": true}' END, '') AS object,
            '[{"z": ' || coalesce(CAST(to_json(source) AS VARCHAR), 'null') || ', "é": ' || coalesce(CAST(to_json(lang) AS VARCHAR), 'null')
              || '}, {"a\\"b": ' || coalesce(CAST(to_json(lang) AS VARCHAR), 'null') || '}]' AS list
          FROM documents""",
        "stream_classify": f"""{line_verdicts} SELECT part, line_number, prompt_no, risk_level, risk_score, categories
          FROM classified JOIN (SELECT conv_id, turn, part, line_number FROM walked) USING (conv_id, turn)
          UNION ALL SELECT part, line_number, 0, 'high', 70, 'input_quality' FROM lines WHERE NOT is_json""",
        "stream_by_user": f"""{line_verdicts} SELECT {user} AS user_email, count(*) AS total_prompts,
            count(*) FILTER (risk_level <> 'none') AS flagged_prompts, max(risk_score) AS max_risk_score, {by_level}
          FROM (SELECT user_email, user_id, risk_level, risk_score FROM classified
            UNION ALL SELECT NULL, NULL, 'high', 70 FROM lines WHERE NOT is_json)
          GROUP BY {user}""",
    }
    return queries
