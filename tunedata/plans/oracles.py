"""The registered queries as SQL for the checking database.

Written from the rules, not from the Spark expressions: plain lazy patterns, joins and windows.
"""

from __future__ import annotations

from tunedata.constants import (
    ASSISTANT_START,
    FENCE_SYSTEM_PROMPT,
    INFERENCE_SYSTEM_PROMPT,
    METRIC_REPORT,
    PREP_REPORT,
    REWARD_TEXT,
    SYSTEM_START,
    TAG_SYSTEM_PROMPT,
    TURN_END,
    USER_START,
)
from tunedata.plans.fixture import DOCUMENT_SQL, EVENT_EPOCH, KINDS, PAIR_SQL, RESPONSE_SQL

# Patterns, in the checking database's syntax.
_TAG_PAIR = "(?is)<{tag}>(.*?)</{tag}>"
_FENCE_PAIR = "(?is)```{language}{space}(.*?)```"
_OPENING_TAG = "<[a-zA-Z][^>]*>"

# No text of the given tables holds whitespace beyond ASCII.
_SPACES = "concat(chr(9), chr(10), chr(11), chr(12), chr(13), chr(28), chr(29), chr(30), chr(31), ' ')"
_SPACE_CLASS = r"[\s\x0b\x1c-\x1f]"

# By construction: the code blocks of the decorated texts that do not parse open a bracket.
_PARSES = "NOT contains(block, '= (')"


def _text(value: str) -> str:
    """A SQL expression for a text that may hold line ends."""
    return "concat('" + value.replace("'", "''").replace("\n", "', chr(10), '") + "')"


def _strip(column: str) -> str:
    return f"trim({column}, {_SPACES})"


def _chat(prompt: str, system: str) -> str:
    head = _text(f"{SYSTEM_START}{system}{TURN_END}\n{USER_START}")
    return f"concat({head}, {prompt}, {_text(f'{TURN_END}' + chr(10) + ASSISTANT_START)})"


def _tag(tag: str) -> str:
    return _TAG_PAIR.format(tag=tag)


def _fence(language: str) -> str:
    return _FENCE_PAIR.format(language=language, space=_SPACE_CLASS)


def _hash(key: str, salt: str) -> str:
    return f"cast('0x' || substr(md5('{salt}:' || {key}), 1, 8) AS bigint)"


_RESPONSES = f"""responses AS (
  SELECT conv_id, turn, {RESPONSE_SQL} AS response FROM conversations WHERE role = 'assistant')"""
_DOCUMENTS = f"""responses AS (SELECT doc_id, source, {DOCUMENT_SQL} AS response FROM documents)"""

_CHECKS = f"""found AS (
  SELECT *, regexp_matches(response, '{_tag("python")}') AS has_code,
         regexp_extract_all(response, '{_tag("info")}', 1) AS infos FROM responses),
checks AS (
  SELECT *, len(infos) > 0 AS has_info,
         len(infos) > 0 AND len(list_filter(regexp_split_to_array(array_to_string(infos, ' '),
           '{_SPACE_CLASS}+'), lambda x: x <> '')) BETWEEN 10 AND 500 AS info_len FROM found),
scored AS (
  SELECT *, cast(2 * has_code::int + 2 * has_info::int + info_len::int AS double) AS reward,
         cast(has_code::int + has_info::int + info_len::int AS double) AS reward_total FROM checks)"""

_TAG_BLOCKS = f"""blocks AS (
  SELECT *, unnest(regexp_extract_all(response, '{_tag("python")}', 1)) AS block
  FROM responses)"""


def _fences(language: str) -> str:
    return f"regexp_extract_all(response, '{_fence(language)}', 1)"


def _metrics(source: str, compliant: str = "reward = 3", keys: str = "") -> str:
    """The evaluation record; ``keys`` is a column name or empty."""
    key_list, group = (f"{keys}, ", f"GROUP BY {keys}") if keys else ("", "")
    join = f"LEFT JOIN syntax USING ({keys})" if keys else "CROSS JOIN syntax"
    return f"""WITH {source}, {_CHECKS}, {_TAG_BLOCKS},
syntax AS (SELECT {key_list}avg(({_PARSES})::int) AS rate FROM blocks {group}),
means AS (SELECT {key_list}count(*) AS n_samples, avg(({compliant})::int) AS compliance,
  avg(reward_total) AS total, avg(has_code::int) AS code, avg(has_info::int) AS info,
  avg(info_len::int) AS length FROM scored {group})
SELECT {key_list}n_samples, round(compliance, 6) AS format_compliance,
  round(coalesce(rate, 0), 6) AS python_syntax_rate, round(total, 6) AS avg_reward,
  round(code, 6) AS avg_code_score, round(info, 6) AS avg_info_score,
  round(length, 6) AS avg_len_score FROM means {join}"""


def _syntax_rate(source: str, keys: str = "") -> str:
    key_list, group = (f"{keys}, ", f"GROUP BY {keys}") if keys else ("", "")
    return f"""WITH {source}, {_TAG_BLOCKS}
SELECT {key_list}count(*) AS blocks, count(*) FILTER ({_PARSES}) AS parsed,
  round(coalesce(avg(({_PARSES})::int), 0), 6) AS python_syntax_rate FROM blocks {group}"""


def _html_rule(blocks: str) -> str:
    return (
        f"len({blocks}) > 0 AND len(list_filter({blocks}, "
        f"lambda b: NOT regexp_matches(b, '{_OPENING_TAG}'))) = 0"
    )


_HTML_VALID = _html_rule(_fences("html"))

_PYTHON_VALID = f"""WITH {_RESPONSES}, blocks AS (
  SELECT conv_id, turn, unnest({_fences('python')}) AS block FROM responses),
verdicts AS (SELECT conv_id, turn, bool_and({_PARSES}) AS ok FROM blocks GROUP BY ALL)
SELECT conv_id, turn, coalesce(ok, false) AS python_valid
FROM responses LEFT JOIN verdicts USING (conv_id, turn)"""

_PAIRS = f"""pairs AS (
  SELECT conv_id,
    {_strip("coalesce(arg_min(text, turn) FILTER (role = 'user'), '')")} AS prompt,
    {_strip("coalesce(arg_max(text, turn) FILTER (role = 'assistant'), '')")} AS response
  FROM conversations GROUP BY conv_id)"""

_MARKED_UP = f"""{_PAIRS}, marked_up AS (
  SELECT conv_id, prompt, CASE WHEN response = '' THEN '' ELSE {_strip(PAIR_SQL)} END AS response
  FROM pairs)"""

_IN_SAMPLE = f"{_hash('conv_id', '42')} < 2147483648"


def _unclosed(column: str) -> str:
    """First closing fence at a line end removed. RE2 has no look-ahead: mask the exceptions."""
    fence = "'```' || chr(10)"
    masked = (
        f"replace(replace({column}, {fence} || 'python', chr(1)), {fence} || 'html', chr(2))"
    )
    cut = f"regexp_replace({masked}, {fence}, chr(10))"
    return f"replace(replace({cut}, chr(1), {fence} || 'python'), chr(2), {fence} || 'html')"


_VARIANTS = (
    f"replace(replace(replace({_strip('response')}, '```python', ''), '```html', ''), '```', '')",
    "replace(response, '```python', '```js')",
    "replace(response, '```html', '```xml')",
    _unclosed("response"),
)


def _choice(key: str) -> str:
    number = f"{_hash(key, '42:pick')} % 4"
    cases = " ".join(f"WHEN {i} THEN {variant}" for i, variant in enumerate(_VARIANTS))
    return f"CASE {number} {cases} END"


def _training(source: str, key: str) -> str:
    """CTEs that end in ``training`` (text, prompt, chosen, rejected) of the kept rows."""
    chat = _chat("prompt", FENCE_SYSTEM_PROMPT)
    return f"""{source}, training AS (
  SELECT {chat} || response || '{TURN_END}' AS text, {chat} AS prompt, response AS chosen,
    CASE WHEN {_hash(key, '42')} < 2147483648 THEN {_choice(key)} END AS rejected
  FROM marked_up WHERE prompt <> '' AND response <> '')"""


_TRAINING = _training(_MARKED_UP, "conv_id")
_PREFERENCES = f"{_TRAINING}, preferences AS (SELECT prompt, chosen, rejected FROM training WHERE rejected IS NOT NULL)"


def _prep_counts(accepted: str) -> str:
    """``accepted`` is a condition on ``response``."""
    return f"""{_MARKED_UP}, statused AS (
  SELECT *, prompt = '' OR response = '' AS empty, ({accepted}) AS accepted FROM marked_up),
counts AS (SELECT count(*) FILTER (NOT empty AND accepted) AS sft,
  count(*) FILTER (NOT empty AND accepted AND {_IN_SAMPLE}) AS dpo,
  count(*) FILTER (empty OR NOT accepted) AS skipped, 0::bigint AS malformed,
  count(*) FILTER (empty) AS empty, count(*) FILTER (NOT empty AND NOT accepted) AS noncompliant
  FROM statused)"""


_PYTHON_FENCE = f"regexp_matches(response, '{_fence('python')}')"
_PYTHON_FENCES_PARSE = (
    f"len({_fences('python')}) > 0 AND "
    f"len(list_filter({_fences('python')}, lambda block: NOT ({_PARSES}))) = 0"
)

_RECORDS = f"""records AS (
  SELECT doc_id, cast(doc_id AS varchar) AS id, str_split(text, chr(10)) AS lines,
    CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN '  ' ELSE ' own prompt ' || text END AS own_prompt,
    CASE WHEN doc_id % 12 = 0 THEN '' ELSE 'own response' || chr(10) || text END AS own_response FROM documents),
said AS (
  SELECT *, own_prompt = '' AND doc_id % 10 <> 9 AS talk,
    list_filter(lines, lambda x, i: i % 3 = 1) AS asked,
    list_filter(lines, lambda x, i: i % 3 = 2) AS answered FROM records),
marked_up AS (
  SELECT id, {_strip("CASE WHEN talk AND len(asked) > 0 THEN asked[1] ELSE own_prompt END")} AS prompt,
    {_strip("CASE WHEN talk AND len(answered) > 0 THEN answered[-1] ELSE own_response END")} AS response
  FROM said)"""

_BARE = (
    f"CASE WHEN contains(source, {_text(USER_START)}) THEN "
    + _strip(f"str_split(str_split(source, {_text(USER_START)})[-1], '{TURN_END}')[1]")
    + " ELSE source END"
)


def _report(labels: tuple[tuple[str, str], ...], shown: dict[str, str], first: str = "") -> str:
    lines = [f"'{label}' || {shown[name]}" for label, name in labels]
    return " || chr(10) || ".join([f"'{first}'", *lines] if first else lines)


_METRIC_TEXT = _report(
    METRIC_REPORT,
    {
        "n_samples": "n_samples",
        "format_compliance": "printf('%.1f%%', format_compliance * 100)",
        "python_syntax_rate": "printf('%.1f%%', python_syntax_rate * 100)",
        **{
            name: f"printf('%.3f', {name})"
            for name in ("avg_reward", "avg_code_score", "avg_info_score", "avg_len_score")
        },
    },
)
_REWARD_TEXT = "concat('" + REWARD_TEXT.format("', t[1], '", "', t[2], '", "', t[3], '", "', printf('%.1f', reward_total), '") + "')"
_KIND_TEXT = "CASE kind " + " ".join(f"WHEN {i} THEN '{kind.strip(chr(34))}'" for i, kind in enumerate(KINDS)) + " END"
_PREP_TEXT = _report(PREP_REPORT, {n: n for n in ("sft", "dpo", "skipped")}, "Dataset stats:")


def _relative(source: str, group: str, member: str) -> str:
    return f"""WITH {source}, {_CHECKS}, stats AS (
  SELECT {group}, {member}, reward, reward - avg(reward) OVER w AS gap,
    coalesce(stddev_samp(reward) OVER w, 0) AS deviation
  FROM scored WINDOW w AS (PARTITION BY {group}))
SELECT {group}, {member}, reward, round(gap / (deviation + 1e-4), 6) AS advantage FROM stats"""


def _windows() -> str:
    return f"""WITH {_RESPONSES}, {_CHECKS},
timed AS (SELECT *, {EVENT_EPOCH} + conv_id * 60 + turn AS seconds FROM scored),
windows AS (SELECT (seconds // 300) * 300 AS window_start, (seconds // 300) * 300 + 300 AS window_end,
  count(*) AS n, round(avg(reward), 6) AS avg_reward, round(avg(reward_total), 6) AS avg_reward_total,
  round(avg(has_code::int), 6) AS avg_code_score, round(avg(has_info::int), 6) AS avg_info_score,
  round(avg(info_len::int), 6) AS avg_len_score, round(avg((reward = 3)::int), 6) AS format_compliance
FROM timed GROUP BY ALL)
SELECT * FROM windows"""


def _corrupt(variant: str) -> str:
    return f"WITH {_RESPONSES} SELECT conv_id, turn, {variant} AS rejected FROM responses"


def _positions(items: str) -> str:
    """Items of a list with their positions from 0."""
    return f"unnest(list_transform({items}, lambda x, i: {{'pos': i - 1, 'block': x}}))"


def all_oracles() -> dict[str, str]:
    return {
        "eval_metrics": _metrics(_RESPONSES),
        "eval_metrics_all_checks": _metrics(_RESPONSES, "reward_total = 3"),
        "eval_by_source": _metrics(_DOCUMENTS, keys="source"),
        "metrics_report": f"SELECT {_METRIC_TEXT} AS report FROM ({_metrics(_RESPONSES)})",
        "metrics_sink": _metrics(_DOCUMENTS),
        "reward_breakdown": f"""WITH {_RESPONSES}, {_CHECKS}
SELECT conv_id, turn, has_code, has_info, info_len, reward_total AS total FROM scored""",
        "reward_breakdown_documents": f"""WITH {_DOCUMENTS}, {_CHECKS}
SELECT doc_id, has_code, has_info, info_len, reward_total, reward, reward = 3 AS compliant FROM scored""",
        "reward_text": f"""WITH {_RESPONSES}, {_CHECKS},
shown AS (SELECT *, list_transform([has_code, has_info, info_len], lambda x: CASE WHEN x THEN 'True' ELSE 'False' END) AS t
  FROM scored)
SELECT conv_id, turn, {_REWARD_TEXT} AS breakdown FROM shown""",
        "reward_functions": f"""WITH {_DOCUMENTS}, {_CHECKS}
SELECT doc_id, source, reward AS reward_format, reward_total AS reward_checks,
  cast((reward_total = 3)::int AS double) AS reward_all_checks,
  reward + 0.5::double * reward_total + 2 * (reward_total = 3)::int AS reward FROM scored""",
        "reward_weighted": f"""WITH {_RESPONSES}, {_CHECKS}
SELECT conv_id, turn, response, reward FROM scored""",
        "compliant_modes": f"""WITH {_RESPONSES}, {_CHECKS}
SELECT conv_id, turn, reward = 3 AS literal, reward_total = 3 AS all_checks FROM scored""",
        "info_length": f"WITH {_RESPONSES}, {_CHECKS} SELECT conv_id, turn, info_len FROM scored",
        "tag_blocks": f"""WITH {_RESPONSES}, items AS (
  SELECT conv_id, turn,
    {_positions(f"regexp_extract_all(response, '{_tag('python')}', 1)")} AS item
  FROM responses)
SELECT conv_id, turn, item.pos AS pos, item.block AS block FROM items""",
        "fence_flags": f"""WITH {_RESPONSES} SELECT conv_id, turn, {_PYTHON_FENCE} AS has_python,
  regexp_matches(response, '{_fence('html')}') AS has_html FROM responses""",
        "fence_blocks": f"""WITH {_RESPONSES}, items AS (
  SELECT conv_id, turn, 'python' AS language, {_positions(_fences('python'))} AS item FROM responses
  UNION ALL
  SELECT conv_id, turn, 'html', {_positions(_fences('html'))} FROM responses)
SELECT conv_id, turn, language, item.pos AS pos, item.block AS block FROM items""",
        "html_valid": f"WITH {_RESPONSES} SELECT conv_id, turn, {_HTML_VALID} AS html_valid FROM responses",
        "html_valid_pages": f"""WITH responses AS (
  SELECT page_id, concat('```HTML', chr(10), html, chr(10), '```', CASE WHEN page_id % 4 = 0
    THEN concat(chr(10), '```html', chr(10), 'no tag < here >', chr(10), '```') ELSE '' END) AS response
  FROM pages)
SELECT page_id, {_HTML_VALID} AS html_valid FROM responses""",
        "html_valid_rate": f"""WITH {_RESPONSES} SELECT count(*) AS n_samples,
  round(avg(({_HTML_VALID})::int), 6) AS html_valid_rate FROM responses""",
        "html_valid_rate_by_source": f"""WITH {_DOCUMENTS} SELECT source, count(*) AS n_samples,
  round(avg(({_HTML_VALID})::int), 6) AS html_valid_rate FROM responses GROUP BY source""",
        "syntax_rate": _syntax_rate(_RESPONSES),
        "syntax_rate_by_source": _syntax_rate(_DOCUMENTS, "source"),
        "python_valid": _PYTHON_VALID,
        "python_valid_column": _PYTHON_VALID,
        "strip_text": f"""SELECT conv_id, turn,
  {_strip(f"concat({_SPACES}, text, {_SPACES})")} AS stripped FROM conversations""",
        "conv_to_pair_flat": f"WITH {_PAIRS} SELECT * FROM pairs",
        "conv_to_pair_nested": f"WITH {_RECORDS} SELECT * FROM marked_up",
        "chat_template": f"""WITH {_PAIRS} SELECT conv_id,
  {_chat("prompt", FENCE_SYSTEM_PROMPT)} AS fence_prompt,
  {_chat("prompt", TAG_SYSTEM_PROMPT)} AS tag_prompt FROM pairs""",
        "prompt_recover": f"""WITH chats AS (
  SELECT *, {_chat("text", FENCE_SYSTEM_PROMPT)} AS chat FROM conversations),
sources AS (SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN chat WHEN 1 THEN chat || chat
  ELSE text || chr(10) END AS source FROM chats)
SELECT conv_id, turn, {_BARE} AS prompt FROM sources""",
        "messages_array": f"""SELECT conv_id, turn, 0::bigint AS pos, 'system' AS role,
  {_text(INFERENCE_SYSTEM_PROMPT)} AS content FROM conversations WHERE role = 'user'
UNION ALL SELECT conv_id, turn, 1, 'user', text FROM conversations WHERE role = 'user'""",
        "jsonl_scan_status": f"""WITH {_PAIRS}, tagged AS (
  SELECT *, CASE WHEN conv_id % 5 = 0 OR conv_id % 7 = 0 THEN 'malformed'
    WHEN prompt = '' OR response = '' THEN 'empty' ELSE 'kept' END AS status
  FROM pairs WHERE conv_id % 11 <> 0)
SELECT conv_id, status, CASE status WHEN 'malformed' THEN '' ELSE prompt END AS prompt,
  CASE status WHEN 'malformed' THEN '' ELSE response END AS response FROM tagged""",
        "jsonl_value_kinds": f"""WITH kinds AS (
  SELECT doc_id, text, doc_id % {len(KINDS)} AS kind FROM documents),
chosen AS (SELECT doc_id, CASE WHEN kind < 7 THEN {_strip("text")} ELSE {_KIND_TEXT} END AS prompt,
    CASE WHEN kind < 7 THEN {_strip("'re: ' || text")} ELSE 'own' END AS response FROM kinds)
SELECT doc_id, CASE WHEN prompt = '' OR response = '' THEN 'empty' ELSE 'kept' END AS status, prompt, response
FROM chosen""",
        "jsonl_quarantine": f"""WITH {_PAIRS}, lines AS (
  SELECT conv_id, prompt, response, cast(json_object('prompt', prompt, 'response', response) AS varchar) AS line
  FROM pairs WHERE conv_id % 11 <> 0),
damaged AS (SELECT *, conv_id % 5 = 0 OR conv_id % 7 = 0 AS bad, CASE WHEN conv_id % 5 = 0 THEN substr(line, 1, 20)
    ELSE line || ' junk' END AS raw FROM lines)
SELECT CASE WHEN bad THEN 'malformed' ELSE 'empty' END AS status, CASE WHEN bad THEN raw ELSE '' END AS raw,
  true AS found FROM damaged WHERE bad OR prompt = '' OR response = ''""",
        "jsonl_conversations": f"WITH {_training(_RECORDS, 'id')} SELECT * FROM training",
        "sft_rows": f"WITH {_TRAINING} SELECT text, prompt, chosen FROM training",
        "text_only": f"WITH {_TRAINING} SELECT text FROM training",
        "prep_report": f"WITH {_prep_counts('true')} SELECT * FROM counts",
        "prep_report_text": f"WITH {_prep_counts('true')} SELECT {_PREP_TEXT} AS report FROM counts",
        "prep_report_gated": f"WITH {_prep_counts(_PYTHON_FENCE)} SELECT * FROM counts",
        "prep_report_syntax_gate": f"WITH {_prep_counts(_PYTHON_FENCES_PARSE)} SELECT * FROM counts",
        "first_n": "SELECT * FROM conversations ORDER BY conv_id, turn LIMIT 200",
        "training_sets": f"""WITH {_TRAINING}
SELECT text, prompt, chosen, NULL::varchar AS rejected, 'sft' AS kind FROM training
UNION ALL SELECT NULL, prompt, chosen, rejected, 'dpo' FROM training WHERE rejected IS NOT NULL""",
        "jsonl_roundtrip": f"WITH {_TRAINING} SELECT text, prompt, chosen FROM training",
        "hash_sample": f"""SELECT conv_id, turn FROM conversations
WHERE {_hash("conv_id || ':' || turn", '42')} < 2147483648""",
        "corrupt_strip": _corrupt(_VARIANTS[0]),
        "corrupt_js": _corrupt(_VARIANTS[1]),
        "corrupt_xml": _corrupt(_VARIANTS[2]),
        "corrupt_unclosed": _corrupt(_VARIANTS[3]),
        "corrupt_choice": _corrupt(_choice("conv_id || ':' || turn")),
        "pref_pairs": f"WITH {_PREFERENCES} SELECT * FROM preferences",
        "pref_filter": f"WITH {_PREFERENCES} SELECT * FROM preferences WHERE chosen <> rejected",
        "pref_filter_report": f"""WITH {_PREFERENCES} SELECT count(*) AS before,
  count(*) FILTER (chosen <> rejected) AS after, count(*) FILTER (chosen = rejected) AS identical
FROM preferences""",
        "pref_load": f"WITH {_PREFERENCES} SELECT * FROM preferences WHERE chosen <> rejected",
        "prompt_fallback": "SELECT conv_id, turn, text AS prompt FROM conversations",
        "eval_requests": f"""WITH {_TRAINING}, chosen_rows AS (
  SELECT prompt AS source FROM training ORDER BY md5(text) LIMIT 50),
bare AS (SELECT {_BARE} AS prompt FROM chosen_rows)
SELECT prompt, {_chat("prompt", TAG_SYSTEM_PROMPT)} AS request FROM bare""",
        "rollout_requests": """SELECT conv_id, turn, text AS prompt, g.gen
FROM conversations CROSS JOIN range(4) AS g(gen) WHERE role = 'user'""",
        "group_relative_reward": _relative(_RESPONSES, "conv_id", "turn"),
        "group_relative_by_source": _relative(_DOCUMENTS, "source", "doc_id"),
        "reward_window_table": _windows(),
        "reward_stream": _windows(),
    }
