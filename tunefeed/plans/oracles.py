"""DuckDB SQL over the driver tables with the rows each query must give."""

from __future__ import annotations

from tunefeed.functions.text import INPUT_LABEL, PY_WS
from tunefeed.operators.epochs import MODULUS, round_keys

_WS = "'" + PY_WS + "'"
_LABEL = "'" + INPUT_LABEL + "'"
_TOKEN = r"'[ \t\n\r\f]*[^ \t\n\r\f]+'"

_CONV = """
v_conv AS (
  SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS conversations
  FROM conversations GROUP BY conv_id)"""

_TRIPLE = """
v_triple AS (
  SELECT conv_id,
         chr(12288) || min(text) FILTER (turn = fu) || ' ' || chr(10) AS instruction,
         CASE WHEN count(*) FILTER (role = 'system') > 0
                THEN chr(9) || min(text) FILTER (turn = fs) || chr(160)
              WHEN conv_id % 3 = 0 THEN ' ' || chr(12288) END AS input,
         min(text) FILTER (turn = fa) AS output
  FROM (SELECT *, min(turn) FILTER (role = 'user')      OVER w AS fu,
                  min(turn) FILTER (role = 'system')    OVER w AS fs,
                  min(turn) FILTER (role = 'assistant') OVER w AS fa
        FROM conversations WINDOW w AS (PARTITION BY conv_id))
  GROUP BY conv_id)"""

_MIXED = (
    _CONV
    + ","
    + _TRIPLE
    + """,
v_mixed AS (
  SELECT conv_id,
         CASE WHEN conv_id % 4 <> 2 THEN instruction END AS instruction,
         CASE WHEN conv_id % 4 <> 2 THEN input END AS input,
         CASE WHEN conv_id % 4 <> 2 THEN output END AS output,
         CASE WHEN conv_id % 2 = 0 THEN conversations
              WHEN conv_id % 4 = 1 THEN conversations[1:0] END AS conversations
  FROM v_conv JOIN v_triple USING (conv_id))"""
)

_CLEAN = {
    c: f"trim(coalesce({c}, ''), {_WS})" for c in ("instruction", "input", "output")
}
_USER = (
    f"{_CLEAN['instruction']} || CASE WHEN {_CLEAN['input']} <> '' "
    f"THEN {_LABEL} || {_CLEAN['input']} ELSE '' END"
)
_TRIPLE_LIST = (
    "[{'role': 'system', 'content': '/no_think'}, "
    f"{{'role': 'user', 'content': {_USER}}}, "
    f"{{'role': 'assistant', 'content': {_CLEAN['output']}}}]"
)
_CONV_LIST = (
    "CASE WHEN conversations[1].role IS NOT DISTINCT FROM 'system' THEN conversations "
    "ELSE list_concat([{'role': 'system', 'content': '/no_think'}], conversations) END"
)
_MESSAGES = (
    f"CASE WHEN coalesce(len(conversations), 0) > 0 THEN {_CONV_LIST} ELSE {_TRIPLE_LIST} END"
)


def _rendered(messages: str) -> str:
    return (
        f"array_to_string(list_transform({messages}, "
        "lambda m: '<|' || m.role || '|>' || m.content || '<|end|>'), chr(10))"
    )


def _turn_rows(views: str, source: str, messages: str) -> str:
    return f"""WITH {views}, listed AS (SELECT conv_id, {messages} AS ms FROM {source}),
placed AS (SELECT conv_id, unnest(range(len(ms))) AS pos, unnest(ms) AS m FROM listed)
SELECT conv_id, CAST(pos AS BIGINT) AS pos, m.role AS role, m.content AS content FROM placed"""


_TURN_LINES = (
    "array_to_string(list_transform({m}, lambda m: '<|im_start|>' || m.role || chr(10) || m.content "
    "|| '<|im_end|>' || chr(10)), '')"
)
_BRACKETS = f"""array_to_string(list_transform(turns, lambda m, i:
       CASE WHEN m.role = 'user' THEN '<s>[INST] ' || trim(CASE WHEN i = 1 AND system IS NOT NULL
              THEN '<<SYS>>' || chr(10) || system || chr(10) || '<</SYS>>' || chr(10) || chr(10) ELSE '' END
              || m.content, {_WS}) || ' [/INST]'
            WHEN m.role = 'assistant' THEN ' ' || trim(CASE WHEN i = 1 AND system IS NOT NULL
              THEN '<<SYS>>' || chr(10) || system || chr(10) || '<</SYS>>' || chr(10) || chr(10) ELSE '' END
              || m.content, {_WS}) || ' </s>' ELSE '' END), '')"""
_NUMBERED = f"""'<s>' || array_to_string(list_transform(others, lambda m, i: '<' ||
       CASE WHEN m.role = 'assistant' THEN 'model' ELSE upper(m.role) END || ' ' || i || '/' || len(others)
       || '>' || trim(m.content, {_WS})), chr(10))"""


_LOGS = """
v_logs AS (
  SELECT event_id, user_id AS run_id, ts AS logged_at,
         10 * row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step,
         event_id % 8 AS global_rank,
         CASE WHEN event_type = 'signup' THEN 'eval' ELSE 'train' END AS kind,
         value AS loss, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events)"""


def _metric_rows(where: str = "true", prefix: str = "", views: str = _LOGS) -> str:
    parts = [
        f"SELECT event_id, run_id, CAST(step AS BIGINT) AS step, '{prefix}{key}' AS key, "
        f"CAST({value} AS DOUBLE) AS value FROM v_logs WHERE {value} IS NOT NULL AND {where}"
        for key, value in (("loss", "loss"), ("k", "k"), ("ok", "1"))
    ]
    return f"WITH {views} " + " UNION ALL ".join(parts)


_TURNS = """
numbered AS (
  SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS p FROM conversations)"""

_STEP = "CAST(p // 32 + 1 AS BIGINT) AS step, CAST((p % 32) // 4 AS BIGINT) AS micro"

_DOCS = f"""
docs AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS p,
         CAST(least(len(regexp_extract_all(text, {_TOKEN})), 2048) AS BIGINT) AS n_tok
  FROM documents),
planned AS (SELECT *, p % 4 AS rank, p // 32 + 1 AS step FROM docs)"""



def _epoch_walk(name: str, epoch: int, seed: int = 7) -> str:
    """(p, q): each position's place in an epoch, rounds gone through until it is a position."""

    def mixed(digit: str, key: tuple[int, int]) -> str:
        u = f"(({digit} + {key[0]}) % {MODULUS})"
        return f"(({u} * {u} + {key[1]} * {u}) % {MODULUS})"

    keys = round_keys(seed, epoch)
    digits = f"SELECT p, q // b AS l, q % b AS r, a, b, n FROM {name}_walk, side WHERE q >= n OR NOT begun"
    for first, second in zip(keys[::2], keys[1::2]):
        digits = f"SELECT p, (l + {mixed('r', first)}) % a AS l, r, a, b, n FROM ({digits})"
        digits = f"SELECT p, l, (r + {mixed('l', second)}) % b AS r, a, b, n FROM ({digits})"
    return f"""{name}_walk(p, q, begun) AS (
  SELECT CAST(p AS BIGINT), CAST(p AS BIGINT), false FROM numbered
  UNION ALL SELECT p, l * b + r, true FROM ({digits})),
{name} AS (SELECT p, q FROM {name}_walk, side WHERE begun AND q < n)"""


_PROMPT = (
    "'<|system|>/no_think<|end|>' || chr(10) || '<|user|>' || text || '<|end|>' || chr(10) "
    "|| '<|assistant|>'"
)

ORACLES: dict[str, str] = {
    "load_split": "SELECT conv_id, turn, role, text FROM conversations",
    "load_split_pruned": "SELECT doc_id, text FROM documents WHERE doc_id % 10 <> 0",
    "jsonl_roundtrip": f"WITH {_TRIPLE} SELECT conv_id, instruction, input, output FROM v_triple",
    "feed_by_rank": f"""WITH {_MIXED}, fed AS (
  SELECT row_number() OVER (ORDER BY conv_id) - 1 AS p, {_rendered(_MESSAGES)} AS text FROM v_mixed)
SELECT CAST(p % 4 AS BIGINT) AS rank, count(*) AS n_rows, CAST(min(p) AS BIGINT) AS min_p,
       CAST(max(p) AS BIGINT) AS max_p, CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM fed GROUP BY p % 4""",
    "feed_without_key": f"""WITH {_TRIPLE}, fed AS (
  SELECT row_number() OVER () - 1 AS p, length({_rendered(_TRIPLE_LIST)}) AS n FROM v_triple)
SELECT CAST(step AS BIGINT) AS step, count(*) AS n_rows, count(*) AS n_dealt,
       CAST(min(p) AS BIGINT) AS min_p,
       CASE WHEN grouping(step) = 1 THEN CAST(sum(n) AS BIGINT) END AS n_chars
FROM (SELECT *, p // 32 + 1 AS step FROM fed) GROUP BY ROLLUP (step)""",
    "feed_from_step": f"""WITH {_TURNS} SELECT conv_id, turn, CAST(p AS BIGINT) AS p,
       CAST(p % 4 AS BIGINT) AS rank, {_STEP} FROM numbered WHERE p // 32 + 1 > 2""",
    "artifact_diff": """WITH files AS (
  SELECT doc_id % 7 AS k, lang || '/' || source || '/' || doc_id AS name, lang || '/moved/' || doc_id AS moved
  FROM documents)
SELECT name, CASE k WHEN 1 THEN 'changed' ELSE 'removed' END AS change FROM files WHERE k IN (0, 1, 2)
UNION ALL SELECT moved, 'added' FROM files WHERE k = 2""",
    "artifact_manifest": """SELECT lang, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS n_bytes,
       true AS hashed FROM documents GROUP BY lang""",
    "metric_stream": _metric_rows(),
    "stream_rejects": f"""WITH {_LOGS} SELECT CASE event_id % 50 WHEN 0 THEN 'not JSON'
       WHEN 1 THEN 'not a JSON object' ELSE 'broken line' END AS reason, count(*) AS n,
       CASE WHEN event_id % 50 = 7 THEN 0 ELSE count(*) END AS n_steps
FROM v_logs WHERE event_id % 50 IN (0, 1, 7) GROUP BY event_id % 50""",
    "clean_text": f"""WITH {_TRIPLE} SELECT conv_id, {_CLEAN['instruction']} AS instruction,
       {_CLEAN['input']} AS input, {_CLEAN['output']} AS output FROM v_triple""",
    "build_user_text": f"WITH {_TRIPLE} SELECT conv_id, {_USER} AS user_text FROM v_triple",
    "detect_shape": f"""WITH {_MIXED} SELECT conv_id, CASE WHEN coalesce(len(conversations), 0) > 0
       THEN 'conversation' ELSE 'triple' END AS shape FROM v_mixed""",
    "triple_messages": _turn_rows(_TRIPLE, "v_triple", _TRIPLE_LIST),
    "ensure_system": _turn_rows(_CONV, "v_conv", _CONV_LIST),
    "to_messages": _turn_rows(_MIXED, "v_mixed", _MESSAGES),
    "render_chat": f"WITH {_MIXED} SELECT conv_id, {_rendered(_MESSAGES)} AS text FROM v_mixed",
    "render_prompt": f"SELECT item_id, {_PROMPT} AS prompt FROM benchmark",
    "render_template": f"""WITH {_MIXED}, listed AS (SELECT conv_id, {_MESSAGES} AS ms FROM v_mixed),
split AS (SELECT conv_id, ms, CASE WHEN ms[1].role = 'system' THEN ms[1].content END AS system,
          CASE WHEN ms[1].role = 'system' THEN ms[2:] ELSE ms END AS turns,
          list_filter(ms, lambda m: m.role <> 'system') AS others FROM listed)
SELECT conv_id, {_TURN_LINES.format(m="ms")} AS lines, {_BRACKETS} AS brackets, {_NUMBERED} AS numbered,
       {_NUMBERED} || CASE WHEN len(others) > 0 THEN chr(10) ELSE '' END || '<model>' AS prompt FROM split""",
    "sft_text": f"WITH {_CONV} SELECT conv_id, {_rendered(_CONV_LIST)} AS text FROM v_conv",
    "sft_text_keep": f"""WITH {_TRIPLE} SELECT conv_id, instruction, input, output,
       {_rendered(_TRIPLE_LIST)} AS text FROM v_triple""",
    "cap_tokens": f"""WITH cut AS (
  SELECT doc_id, text, regexp_extract_all(text, {_TOKEN}) AS tokens FROM documents)
SELECT doc_id, CASE WHEN len(tokens) > 2048 THEN array_to_string(tokens[1:2048], '') ELSE text END
       AS text, CAST(len(tokens) AS BIGINT) AS n_tokens FROM cut""",
    "user_path": """SELECT c_name AS name, '/Workspace/Users' AS root, true AS is_user,
       c_name AS leaf FROM customer""",
    "number_rows": f"WITH {_TURNS} SELECT conv_id, turn, CAST(p AS BIGINT) AS p FROM numbered",
    "number_rows_by_text": """SELECT lang, source, doc_id,
       row_number() OVER (ORDER BY lang, source, doc_id) - 1 AS p FROM documents""",
    "number_file_rows": f"WITH {_TURNS} SELECT conv_id, turn, CAST(p AS BIGINT) AS p FROM numbered",
    "epoch_order": f"""WITH RECURSIVE {_TURNS},
total AS (SELECT count(*) AS n FROM conversations),
side_a AS (SELECT n, CAST(ceil(sqrt(n)) AS BIGINT) AS a FROM total),
side AS (SELECT n, a, (n + a - 1) // a AS b FROM side_a),
{_epoch_walk("zero", 0)}, {_epoch_walk("one", 1)}
SELECT conv_id, turn, t.p, zero.q AS p_0, one.q AS p_1, t.p AS p_back
FROM numbered t JOIN zero ON zero.p = t.p JOIN one ON one.p = t.p""",
    "assign_rank": f"""WITH {_TURNS} SELECT conv_id, turn, CAST(p AS BIGINT) AS p,
       CAST(p % 4 AS BIGINT) AS rank FROM numbered""",
    "assign_step": f"""WITH {_TURNS} SELECT conv_id, turn, CAST(p AS BIGINT) AS p, {_STEP}
FROM numbered""",
    "step_cap": f"""WITH {_TURNS} SELECT conv_id, turn, CAST(p AS BIGINT) AS p,
       CAST(p % 4 AS BIGINT) AS rank, {_STEP} FROM numbered WHERE p // 32 + 1 <= 5""",
    "batch_summary": f"""WITH {_DOCS} SELECT CAST(step AS BIGINT) AS step, CAST(rank AS BIGINT) AS rank,
       count(*) AS n_rows, CAST(sum(n_tok) AS BIGINT) AS sum_tokens,
       CAST(max(n_tok) AS BIGINT) AS max_tokens FROM planned GROUP BY ALL""",
    "pack_blocks": f"""WITH {_DOCS}, placed AS (
  SELECT doc_id, rank, n_tok, coalesce(sum(n_tok) OVER (PARTITION BY rank ORDER BY p
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM planned),
pieces AS (
  SELECT *, CAST(unnest(range(CAST(s // 2048 AS BIGINT),
         CAST((s + greatest(n_tok, 1) - 1) // 2048 + 1 AS BIGINT))) AS BIGINT) AS block FROM placed)
SELECT doc_id, CAST(rank AS BIGINT) AS rank, block,
       CAST(greatest(s - block * 2048, 0) AS BIGINT) AS block_pos,
       CAST(greatest(block * 2048 - s, 0) AS BIGINT) AS token_from,
       CAST(least((block + 1) * 2048 - s, n_tok) - greatest(block * 2048 - s, 0) AS BIGINT)
         AS piece_tokens FROM pieces""",
    "pack_whole": f"""WITH {_DOCS} SELECT CAST(rank AS BIGINT) AS rank, count(*) AS n_rows,
       CAST(sum(n_tok) AS BIGINT) AS sum_tokens, CAST(0 AS BIGINT) AS n_astray,
       CAST(0 AS BIGINT) AS n_too_full, true AS near_bound FROM planned GROUP BY rank""",
    "explode_metrics": _metric_rows(),
    "time_per_step": f"""WITH {_LOGS} SELECT event_id, run_id, CAST(step AS BIGINT) AS step,
       date_diff('microsecond', lag(logged_at) OVER (PARTITION BY run_id ORDER BY logged_at, event_id),
                 logged_at) / 1e6 / 10 AS time_per_step
FROM v_logs WHERE global_rank = 0""",
    "time_per_step_stream": f"""WITH {_LOGS} SELECT event_id, run_id, CAST(step AS BIGINT) AS step,
       date_diff('microsecond', lag(logged_at) OVER (PARTITION BY run_id ORDER BY logged_at, event_id),
                 logged_at) / 1e6 / 10 AS time_per_step
FROM v_logs WHERE global_rank = 0""",
    "rank0_metrics": _metric_rows("global_rank = 0"),
    "eval_metrics": _metric_rows("kind = 'eval'", prefix="eval_"),
    "final_metrics": f"""WITH {_LOGS}, last AS (
  SELECT * FROM v_logs QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY step DESC) = 1)
SELECT run_id, 'loss' AS key, loss AS value, CAST(NULL AS BIGINT) AS step FROM last
UNION ALL SELECT run_id, 'k', CAST(k AS DOUBLE), NULL FROM last
UNION ALL SELECT run_id, 'ok', 1.0::DOUBLE, NULL FROM last""",
    "cadence": f"""WITH {_LOGS} SELECT event_id, run_id, CAST(step AS BIGINT) AS step,
       step % 10 = 0 AS log_due, step % 200 = 0 AS save_due, step % 100 = 0 AS upload_due
FROM v_logs""",
    "metric_rejects": f"""WITH {_LOGS} SELECT event_id, run_id, CAST(step AS BIGINT) AS step,
       CASE event_id % 50 WHEN 0 THEN 'not JSON' ELSE 'not a JSON object' END AS reason
FROM v_logs WHERE event_id % 50 < 2""",
    "metric_key_rejects": f"""WITH {_LOGS}, twice AS (
  SELECT *, 'k' AS key, 'duplicate key' AS reason FROM v_logs, range(2)
  WHERE event_id % 40 = 3 AND k IS NOT NULL
  UNION ALL SELECT *, 0, 'big', 'out of range' FROM v_logs WHERE event_id % 40 = 4)
SELECT event_id, run_id, CAST(step AS BIGINT) AS step, key, reason FROM twice""",
    "metrics_past_rejects": _metric_rows("event_id % 50 > 4")
    + """ UNION ALL SELECT event_id, run_id, CAST(step AS BIGINT), 'loss', CAST(-1 AS DOUBLE)
FROM v_logs WHERE event_id % 50 = 2""",
    "ckpt_retention": f"""WITH {_LOGS} SELECT run_id, CAST(step AS BIGINT) AS step,
       'out/checkpoint-' || step AS path FROM v_logs WHERE step % 200 = 0
QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY step DESC) <= 2""",
    "experiment_missing": """SELECT DISTINCT 'run-' || user_id AS name FROM events
WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)""",
    "run_tags": """SELECT user_id AS run_id, event_type AS key, arg_max(props, event_id) AS value
FROM events GROUP BY ALL""",
    "tags_in_batches": """SELECT user_id AS run_id, event_type AS key, arg_max(props, event_id) AS value
FROM events GROUP BY ALL""",
    "experiments_in_batches": """SELECT 'run-' || s_suppkey AS name FROM supplier
UNION SELECT 'run-' || user_id FROM events""",
    "run_params": """WITH runs AS (
  SELECT user_id AS run_id, count(*) AS n_logs, max(value) AS max_value, min(event_type) AS first_kind,
         bool_or(value > 250) AS spiked FROM events GROUP BY user_id)
SELECT run_id, 'n_logs' AS key, CAST(n_logs AS VARCHAR) AS value FROM runs
UNION ALL SELECT run_id, 'max_value', CAST(max_value AS VARCHAR) FROM runs
UNION ALL SELECT run_id, 'first_kind', first_kind FROM runs
UNION ALL SELECT run_id, 'spiked', CASE WHEN spiked THEN 'True' ELSE 'False' END FROM runs
UNION ALL SELECT run_id, 'lr', CAST(max_value / 1e7 AS VARCHAR) FROM runs
UNION ALL SELECT run_id, 'tokens', CAST(max_value * 1e6 AS VARCHAR) FROM runs""",
    "generate_by_length": f"""SELECT item_id, {_PROMPT} AS prompt, {_PROMPT} || array_to_string(
       list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')[1:20], ' ')
       AS completion FROM benchmark""",
    "generate_batch": f"""SELECT item_id, {_PROMPT} AS prompt, {_PROMPT} || array_to_string(
       list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')[1:20], ' ')
       AS completion FROM benchmark""",
}
