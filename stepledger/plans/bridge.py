"""Outputs and records made from the event table, by expressions that Spark and DuckDB read alike.

Each event becomes a model output: its number picks the method, the state it
is called in, what the record expects, and one of nine kinds of damage or
none. All texts follow from the number, so both engines make the same ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepledger.domain import DEFAULT

METHODS = DEFAULT.methods
#: The state that a method's first trigger starts from; query methods work anywhere.
NATURAL = {"ticket_open": "NEW", "ticket_reopen": "RESOLVED", "resolution_confirm": "REOPENED", "admin_escalate": "ESCALATED", "admin_lifecycle_apply": "RESOLVED"}
PARAMS = {
    "ticket_open": """'{"requester_id":"user:' || who || '","body_text":"' || body || '","lifecycle_profile":"std"}'""",
    "ticket_get": """'{"ticket_id":"' || ticket || '"}'""",
    "ticket_status": """'{"ticket_id":"' || ticket || '"}'""",
    "ticket_reopen": """'{"ticket_id":"' || ticket || '","reopen_reason":"again"}'""",
    "resolution_confirm": """'{"review_id":"' || ticket || '","resolution_notes":{"by":' || who || '}}'""",
    "ticket_history": """'{"ticket_id":"' || ticket || '","window":{"from_utc":"2024-01-01T00:00:00Z"}}'""",
    "admin_agent_add": """'{"agent_profile":{"name":"' || body || '"}}'""",
    "admin_escalate": """'{"agent_id":"a-' || who || '","ticket_id":"' || ticket || '"}'""",
    "admin_lifecycle_apply": """'{"lifecycle_profile":"' || body || '"}'""",
}


def pick(expression: str, values) -> str:
    """CASE over whole numbers from 0."""
    return f"CASE {expression} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def quoted(value: str | None) -> str:
    return "CAST(NULL AS STRING)" if value is None else f"'{value}'"


def stages(sid: str, keep: tuple[str, ...]) -> list[list[tuple[str, str]]]:
    """Projections one after another: (expression, name) of each."""
    kept = [(k, k) for k in keep]
    triggers = [DEFAULT.triggers[m] for m in METHODS]
    first = [quoted(t[0] if t else None) for t in triggers]
    last = [quoted(t[-1] if t else None) for t in triggers]
    return [
        [*kept, (f"CAST({sid} AS BIGINT)", "sid")],
        [*kept, ("sid", "sid"), ("sid % 9", "m"), ("sid % 23", "damage"), ("CAST(floor(sid / 9) AS BIGINT)", "d9"), ("CAST(floor(sid / 90) AS BIGINT)", "d90"), ("CAST(sid % 97 AS STRING)", "who"), ("CASE WHEN sid % 23 = 5 THEN '' ELSE 'T-' || CAST(sid % 97 AS STRING) END", "ticket"), ("CASE WHEN sid % 23 = 6 THEN 'łł' ELSE 'text ' || CAST(sid % 97 AS STRING) END", "body")],
        [
            *kept,
            ("sid", "sid"),
            ("damage", "damage"),
            (pick("m", map(quoted, METHODS)), "method"),
            ("CASE WHEN d9 % 3 = 0 THEN " + pick("d90 % 10", map(quoted, DEFAULT.states)) + " ELSE " + pick("m", [quoted(NATURAL.get(m, "TRIAGED")) for m in METHODS]) + " END", "prior_state"),
            ("CASE d90 % 4 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN " + pick("m", last) + " ELSE " + pick("m", first) + " END", "expected_trigger"),
            ("CASE WHEN d9 % 7 = 6 THEN 'RESOLVED' ELSE CAST(NULL AS STRING) END", "expected_state_after"),
            (pick("m", [PARAMS[m] for m in METHODS]), "params"),
        ],
        [
            *kept,
            *[(c, c) for c in ("sid", "damage", "prior_state", "expected_trigger", "expected_state_after")],
            (
                "CASE damage WHEN 1 THEN '<think>plan</think>{not json' "
                """WHEN 7 THEN '<think>plan</think>{"jsonrpc":"2.0","method":"' || method || '","id":1}' """
                """WHEN 8 THEN '<think>plan</think>{"jsonrpc":"2.0","method":"' || method || '","params":[1],"id":1}' """
                """WHEN 2 THEN '<think>plan</think>{"jsonrpc":"1.0","method":"' || method || '","params":' || params || ',"id":1}' """
                """WHEN 3 THEN '<think>plan</think>{"jsonrpc":"2.0","method":"none_' || method || '","params":' || params || ',"id":1}' """
                """WHEN 4 THEN '<think>plan</think>{"jsonrpc":"2.0","method":"' || method || '","params":{"extra":1,' || substr(params, 2) || ',"id":1}' """
                """WHEN 0 THEN '{"jsonrpc":"2.0","method":"' || method || '","params":' || params || ',"id":1}' """
                """ELSE '<think>plan ' || prior_state || '</think> {"jsonrpc":"2.0","method":"' || method || '","params":' || params || ',"id":1}' END""",
                "output",
            ),
        ],
    ]


def outputs(events: DataFrame, sid: str = "event_id", keep: tuple[str, ...] = ("event_id", "user_id", "ts")) -> DataFrame:
    """The outputs in Spark."""
    for stage in stages(sid, keep):
        events = events.selectExpr(*[f"{e} AS {a}" for e, a in stage])
    return events


def outputs_sql(sid: str = "event_id", keep: tuple[str, ...] = ("event_id", "user_id", "ts")) -> str:
    """The outputs as a DuckDB query."""
    source = "events"
    for stage in stages(sid, keep):
        source = "(SELECT " + ", ".join(f"{e} AS {a}" for e, a in stage) + f" FROM {source})"
    return source


#: Five events are one record of one step: the greedy output and four samples, of which some are equal.
SAMPLE_SID = "CAST(floor(event_id / 5) AS BIGINT) * 3 + (event_id % 5) % 2"


def records(events: DataFrame) -> DataFrame:
    """Records of all outputs of a user on a day, in order, that begin where their first call would."""
    out = outputs(events).withColumn("day", F.to_date("ts"))
    step = F.struct("ts", "event_id", "expected_trigger", "expected_state_after", "output", "prior_state")
    grouped = out.groupBy("user_id", "day").agg(F.array_sort(F.collect_list(step)).alias("all"))
    return grouped.select(
        F.concat(F.col("user_id").cast("string"), F.lit("/"), F.col("day").cast("string")).alias("trajectory_id"),
        F.col("all")[0]["event_id"].alias("row_idx"),
        F.col("all")[0]["prior_state"].alias("initial_state"),
        F.when(F.col("user_id") % 5 == 0, F.lit("RESOLVED")).alias("final_state"),
        F.transform("all", lambda s: F.struct(s["expected_trigger"].alias("expected_trigger"), s["expected_state_after"].alias("expected_state_after"))).alias("steps"),
        F.transform("all", lambda s: s["output"]).alias("outputs"),
    )


WRAP = r"^\s*<think>(.*?)</think>\s*(.*)$"


def _schema_sql(method: str) -> str:
    """A method's parameter rules in DuckDB's JSON functions."""
    schema = DEFAULT.params[method]
    keys = "[" + ", ".join(f"'{k}'" for k in schema["properties"]) + "]"
    out = ["json_type(js, '$.params') = 'OBJECT'", f"list_has_all({keys}, json_keys(js, '$.params'))"]
    for k in schema["required"]:
        out.append(f"json_exists(js, '$.params.{k}')")
    for k, s in schema["properties"].items():
        at = f"'$.params.{k}'"
        out.append(f"json_type(js, {at}) = '{'VARCHAR' if s['type'] == 'string' else 'OBJECT'}'")
        if "minLength" in s:
            out.append(f"length(json_extract_string(js, {at})) >= {s['minLength']}")
        if "pattern" in s:
            out.append(f"regexp_matches(json_extract_string(js, {at}), '{s['pattern']}')")
        if "properties" in s:
            inner = "[" + ", ".join(f"'{x}'" for x in s["properties"]) + "]"
            out.append(f"list_has_all({inner}, json_keys(js, {at}))")
            out += [f"coalesce(json_type(js, '$.params.{k}.{x}'), 'VARCHAR') = 'VARCHAR'" for x in s["properties"]]
    return "coalesce(" + " AND ".join(out) + ", false)"


def facts_sql(source: str) -> str:
    """Outputs with what can be said of them without a state."""
    methods = ", ".join(f"'{m}'" for m in METHODS)
    schema = "CASE method " + " ".join(f"WHEN '{m}' THEN {_schema_sql(m)}" for m in METHODS) + " ELSE false END"
    triggers = "CASE method " + " ".join(f"WHEN '{m}' THEN [{', '.join(map(quoted, DEFAULT.triggers[m]))}]::VARCHAR[]" for m in METHODS) + " END"
    return f"""(
SELECT *, {schema} AS schema_ok, {triggers} AS triggers
FROM (
  SELECT *, coalesce(js_ok AND json_type(js) = 'OBJECT' AND json_exists(js, '$.jsonrpc') AND json_exists(js, '$.method')
           AND json_exists(js, '$.params') AND json_exists(js, '$.id') AND json_extract_string(js, '$.jsonrpc') = '2.0', false) AS parsed,
         CASE WHEN json_type(js, '$.method') = 'VARCHAR' AND json_extract_string(js, '$.method') IN ({methods})
              THEN json_extract_string(js, '$.method') END AS method
  FROM (
    SELECT *, coalesce(json_valid(tail), false) AND wrapped AS js_ok, CASE WHEN wrapped AND json_valid(tail) THEN tail ELSE '{{}}' END AS js
    FROM (
      SELECT *, regexp_matches(output, '{WRAP}', 's') AS wrapped, regexp_extract(output, '{WRAP}', 1, 's') AS thinking,
             trim(regexp_extract(output, '{WRAP}', 2, 's')) AS tail
      FROM {source}
    )
  )
)
)"""


ARCS = "(VALUES " + ", ".join(f"('{a}', '{t}', '{b}')" for (a, t), b in DEFAULT.arcs.items()) + ") AS arcs(origin, trigger, leads)"


def judged_sql(source: str, state: str = "prior_state", infer: bool = False) -> str:
    """Outputs with their subscores in a state; with ``infer`` whatever trigger was expected."""

    def leads(trigger: str) -> str:
        return f"CASE WHEN list_contains(f.triggers, {trigger}) THEN a.ends[list_position(a.fires, {trigger})] END"

    target = leads("f.expected_trigger")
    if infer:
        one, two = leads("f.triggers[1]"), leads("f.triggers[2]")
        target = f"CASE WHEN f.expected_state_after = {two} AND f.expected_state_after IS DISTINCT FROM {one} THEN {two} ELSE coalesce({one}, {two}) END"
    return f"""(
SELECT *, CAST(parsed AS DOUBLE) AS parse, CAST(known AND schema_ok AS DOUBLE) AS "schema", CAST(known AS DOUBLE) AS method_known,
       CAST(known AND can AS DOUBLE) AS precondition_met, CAST(known AND moved AS DOUBLE) AS transition_valid,
       CAST(known AND moved AS DOUBLE) AS sequence_optimal, known AND schema_ok AND can AND moved AS passed,
       CASE WHEN known AND query THEN {state} WHEN known AND moved THEN target END AS new_state
FROM (
  SELECT *, query OR has_arc AS can, query OR coalesce(target IS NOT NULL AND (expected_state_after IS NULL OR target = expected_state_after), false) AS moved
  FROM (
    SELECT f.*, f.parsed AND f.method IS NOT NULL AS known, coalesce(len(f.triggers) = 0, false) AS query,
           coalesce(list_has_any(f.triggers, a.fires), false) AS has_arc, {target} AS target
    FROM {facts_sql(source)} f
    LEFT JOIN (SELECT origin, list(trigger ORDER BY trigger) AS fires, list(leads ORDER BY trigger) AS ends FROM {ARCS} GROUP BY origin) a
      ON a.origin = f.{state}
  )
)
)"""


def folded_sql() -> str:
    """Steps of records with the state that is threaded through them, by recursion over their places."""
    arcs = f"(SELECT * FROM {ARCS})"
    return f"""
WITH RECURSIVE steps AS MATERIALIZED (
  SELECT CAST(user_id AS VARCHAR) || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS trajectory_id, user_id,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS pos, *
         EXCLUDE (user_id)
  FROM {facts_sql(outputs_sql())}
), heads AS (
  SELECT trajectory_id, prior_state AS initial_state, event_id AS row_idx,
         CASE WHEN user_id % 5 = 0 THEN 'RESOLVED' END AS final_wanted
  FROM steps WHERE pos = 1
), judged AS (
  SELECT trajectory_id, CAST(0 AS BIGINT) AS pos, initial_state AS state, NULL::BOOLEAN AS passed, NULL::DOUBLE AS parse, NULL::DOUBLE AS "schema",
         NULL::DOUBLE AS method_known, NULL::DOUBLE AS precondition_met, NULL::DOUBLE AS transition_valid
  FROM heads
  UNION ALL
  SELECT trajectory_id, pos, CASE WHEN ok AND moved_to IS NOT NULL THEN moved_to ELSE state END, ok, CAST(parsed AS DOUBLE),
         CAST(known AND schema_ok AS DOUBLE), CAST(known AS DOUBLE), CAST(known AND (query OR can) AS DOUBLE), CAST(known AND (query OR moved_to IS NOT NULL) AS DOUBLE)
  FROM (
    SELECT *, known AND schema_ok AND (query OR (can AND moved_to IS NOT NULL)) AS ok
    FROM (
      SELECT *, CASE WHEN query THEN state WHEN target IS NOT NULL AND (expected_state_after IS NULL OR target = expected_state_after) THEN target END AS moved_to
      FROM (
        SELECT s.trajectory_id, s.pos, j.state, s.parsed, s.schema_ok, s.expected_state_after, s.parsed AND s.method IS NOT NULL AS known,
               coalesce(len(s.triggers) = 0, false) AS query, coalesce(c.can, false) AS can,
               CASE WHEN list_contains(s.triggers, a.trigger) THEN a.leads END AS target
        FROM judged j JOIN steps s ON s.trajectory_id = j.trajectory_id AND s.pos = j.pos + 1
        LEFT JOIN {arcs} a ON a.origin = j.state AND a.trigger = s.expected_trigger
        LEFT JOIN (SELECT m.method, r.origin, true AS can FROM (SELECT DISTINCT method, unnest(triggers) AS trigger FROM steps WHERE method IS NOT NULL) m
                   JOIN {arcs} r ON r.trigger = m.trigger GROUP BY ALL) c ON c.method = s.method AND c.origin = j.state
      )
    )
  )
), results AS (
  SELECT *, transition_valid AS sequence_optimal FROM judged WHERE pos > 0
), ends AS (
  SELECT trajectory_id, arg_max(state, pos) AS final_state, bool_and(passed) AS all_passed, count(*) AS n_steps,
         min(pos) FILTER (NOT passed) AS first_failed
  FROM results GROUP BY trajectory_id
), graded AS (
  SELECT h.*, e.final_state, e.n_steps, e.first_failed, e.all_passed AND (h.final_wanted IS NULL OR h.final_wanted = e.final_state) AS passed
  FROM heads h JOIN ends e USING (trajectory_id)
)
"""
