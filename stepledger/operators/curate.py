"""From completions to a data set: gate, ids, splits, provenance, chat samples."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepledger import __version__
from stepledger.domain import DEFAULT, Domain
from stepledger.functions.jsontext import loads
from stepledger.functions.text import render, thought, without_fences
from stepledger.operators.rejects import classify
from stepledger.operators.score import places
from stepledger.operators.verify import verify_records

STEP = "struct<prior_state:string,situation:string,prior_calls:string,thinking:string,tool_call:string,expected_trigger:string,expected_state_after:string>"
RECORD = f"struct<ok:boolean,shaped:boolean,trajectory_id:string,initial_state:string,final_state:string,source:string,seed_trajectory_id:string,lineage_seed:string,situation:string,steps:array<{STEP}>>"
STEP_ARROW = pa.struct([(n, pa.string()) for n in ("prior_state", "situation", "prior_calls", "thinking", "tool_call", "expected_trigger", "expected_state_after")])
RECORD_ARROW = pa.struct([("ok", pa.bool_()), ("shaped", pa.bool_()), *[(n, pa.string()) for n in ("trajectory_id", "initial_state", "final_state", "source", "seed_trajectory_id", "lineage_seed", "situation")], ("steps", pa.list_(STEP_ARROW))])

#: What a chat sample tells the model first.
SYSTEM = "Think inside <think> tags about the state you are given, then write one JSON-RPC request whose parameters fit the method."


def _text(value) -> str | None:
    return value.encode("utf-8", "replace").decode() if isinstance(value, str) else None


def read_record(text: str | None) -> dict:
    """The parts of one record's text; ok tells strict JSON, shaped that it can be rendered."""
    from json import dumps

    ok, value = loads(text)
    out = dict.fromkeys(("trajectory_id", "initial_state", "final_state", "source", "seed_trajectory_id", "lineage_seed", "situation")) | {"ok": ok, "shaped": False, "steps": None}
    if not isinstance(value, dict):
        return out
    out |= {k: _text(value.get(k)) for k in ("trajectory_id", "initial_state", "final_state", "source", "seed_trajectory_id")}
    origin = value.get("provenance")
    out["lineage_seed"] = _text(origin.get("seed_trajectory_id")) if isinstance(origin, dict) else None
    steps = value.get("steps")
    if not isinstance(steps, list) or not all(isinstance(s, dict) for s in steps):
        return out
    rows = []
    for s in steps:
        context = s.get("prompt_context") if isinstance(s.get("prompt_context"), dict) else {}
        rows.append(
            {k: _text(s.get(k)) for k in ("thinking", "expected_trigger", "expected_state_after")}
            | {"prior_state": _text(context.get("prior_state")), "situation": _text(context.get("situation")), "prior_calls": dumps(context["prior_calls"]) if context.get("prior_calls") else None, "tool_call": dumps(s["tool_call"]) if "tool_call" in s else None}
        )
    out["steps"], out["situation"] = rows, rows[0]["situation"] if rows else None
    out["shaped"] = all(r["thinking"] is not None and r["tool_call"] is not None for r in rows) and "initial_state" in value
    return out


def read_records(text: Column) -> Column:
    """Records from their texts, parsed in Arrow batches."""

    @F.arrow_udf(RECORD)
    def read(values: pa.Array) -> pa.Array:
        return pa.array([read_record(v) for v in values.to_pylist()], RECORD_ARROW)

    return read(text)


def verify_gold(lines: DataFrame, domain: Domain = DEFAULT, text: str = "value", stop_at_failure: bool = False) -> DataFrame:
    """Lines with the record read from each and the result of its own rendered outputs; what cannot be read fails."""
    rows = lines.withColumn("record", read_records(F.col(text)))
    outputs = F.transform(F.col("record.steps"), lambda s: render(s["thinking"], s["tool_call"]))
    flat = rows.select("*", F.col("record.steps").alias("steps"), outputs.alias("outputs"), F.col("record.initial_state").alias("initial_state"), F.col("record.final_state").alias("final_state"))
    judged = verify_records(flat, domain, stop_at_failure=stop_at_failure).drop("steps", "outputs", "initial_state", "final_state")
    passed = F.col("record.ok") & F.col("record.shaped") & F.col("result.passed")
    return judged.withColumn("passed", F.coalesce(passed, F.lit(False)))


def totals(judged: DataFrame, by: str = "split") -> DataFrame:
    """total, ok and failed for each split."""
    return judged.groupBy(by).agg(F.count("*").alias("total"), F.count_if("passed").alias("ok"), F.count_if(~F.col("passed")).alias("failed"))


def gate(completions: DataFrame, domain: Domain = DEFAULT, raw: str = "raw") -> DataFrame:
    """Completions with the record in each, its result and its verdict."""
    judged = verify_gold(completions.withColumn("value", without_fences(F.col(raw))), domain)
    return judged.withColumn("verdict", classify(F.col(raw), F.col("record.ok"), F.col("record.shaped"), F.col("result.passed")))


def unique_ids(rows: DataFrame, key: str = "trajectory_id", order: str = "row_idx") -> DataFrame:
    """Rows whose repeated ids get a suffix that no id has.

    The first row of an id, in the order, keeps it. Suffixes are the row's
    place among those of its id, put after one more underscore than any id
    that could meet them has, so they are the same on every run.
    """
    longest = rows.agg(F.max(F.length(F.regexp_extract(F.col(key), r"(_+)\d+$", 1))).alias("n"))
    marked = places(rows, [key], [order], F.shiftright(order, 20), "nth").crossJoin(F.broadcast(longest))  # one row
    suffix = F.concat(F.repeat(F.lit("_"), F.coalesce(F.col("n"), F.lit(0)) + 1), F.col("nth").cast("string"))
    return marked.withColumn(key, F.when(F.col("nth") > 0, F.concat(F.col(key), suffix)).otherwise(F.col(key))).drop("nth", "n")


def split(rows: DataFrame, key: str, seed: int = 0, train: float = 0.8, dev: float = 0.1) -> DataFrame:
    """Rows with train, dev or rest by their place in an order that key and seed fix.

    Sizes are whole parts of the total, as with a shuffled list; what remains
    is in neither. Places come from counts by the leading digits of a digest,
    so no task orders all rows.
    """
    if train + dev > 1 + 1e-9 or min(train, dev) < 0:
        raise ValueError("train and dev are shares of at most 1 together")
    marked = rows.withColumn("mark", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))).withColumn("bin", F.left("mark", F.lit(4)))
    bins = marked.groupBy("bin").agg(F.count("*").alias("here"))
    upto = F.sum("here").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    bins = bins.select("bin", F.coalesce(upto, F.lit(0)).alias("before"), F.sum("here").over(Window.partitionBy()).alias("n"))  # at most 65,536 rows
    placed = marked.withColumn("place", F.row_number().over(Window.partitionBy("bin").orderBy("mark", key))).join(F.broadcast(bins), "bin")
    at, n = F.col("before") + F.col("place") - 1, F.col("n")
    n_train, n_dev = F.floor(n * train + 1e-9), F.floor(n * dev + 1e-9)
    return placed.withColumn("split", F.when(at < n_train, "train").when(at < n_train + n_dev, "dev").otherwise("rest")).drop("mark", "bin", "before", "n", "place")


def prior_calls(steps: Column) -> Column:
    """Steps with the calls before each as a JSON list, where they have none of their own."""
    calls = F.transform(steps, lambda s: s["tool_call"])

    def fill(s: Column, i: Column) -> Column:
        before = F.filter(F.slice(calls, F.lit(1), i), lambda c: c.isNotNull())
        listed = F.concat(F.lit("["), F.array_join(before, ", "), F.lit("]"))
        return s.withField("prior_calls", F.coalesce(s["prior_calls"], F.when(i > 0, listed)))

    return F.transform(steps, fill)


def chat_messages(step: Column, system: str = SYSTEM) -> Column:
    """system, user and assistant messages of a step."""
    user = F.concat_ws(
        "\n",
        F.concat(F.lit("Prior state: "), step["prior_state"]),
        F.concat(F.lit("Situation: "), F.nullif(step["situation"], F.lit(""))),
        F.concat(F.lit("Prior calls: "), F.nullif(step["prior_calls"], F.lit(""))),
    )

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(message("system", F.lit(system)), message("user", user), message("assistant", render(step["thinking"], step["tool_call"])))


def step_samples(records: DataFrame, steps: str = "steps") -> DataFrame:
    """A row for each step of each record with its messages."""
    rows = records.select("trajectory_id", F.posexplode(steps).alias("step_idx", "step"))
    return rows.select("trajectory_id", "step_idx", chat_messages(F.col("step")).alias("messages"))


def provenance(rows: DataFrame, prompt: Column, timestamp: str, **fields) -> DataFrame:
    """Rows with a provenance struct: given fields, the digest of the prompt and a time."""
    parts = [F.lit(v).alias(k) if not isinstance(v, Column) else v.alias(k) for k, v in fields.items()]
    return rows.withColumn("provenance", F.struct(*parts, F.sha2(prompt, 256).alias("system_prompt_sha256"), stamp(timestamp).alias("expansion_timestamp_utc")))


def stamp(timestamp: str | None) -> Column:
    """A time, or the time of the query, as text with microseconds."""
    return F.date_format(F.lit(timestamp).cast("timestamp") if timestamp else F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


# The fields of a row's origin, in their order, with their types.
TEACHER_FIELDS = {"teacher_provider": "string", "teacher_model": "string", "teacher_model_version": "string", "system_prompt_sha256": "string", "expansion_seed": "bigint", "expansion_temperature": "double", "response_format": "string", "grammar_path": "string", "expansion_timestamp_utc": "string", "engine_version": "string", "seed_trajectory_id": "string"}
SEED_FIELDS = {k: t for k, t in TEACHER_FIELDS.items() if k not in ("response_format", "grammar_path")}


def _origin(fields: dict[str, str], given: dict[str, object]) -> Column:
    if unknown := sorted(set(given) - set(fields)):
        raise ValueError(f"no such field of provenance: {unknown}")
    return F.struct(*[(v if isinstance(v := given.get(k), Column) else F.lit(v)).cast(t).alias(k) for k, t in fields.items()])


def teacher_provenance(prompt: Column, timestamp: str | None = None, **given) -> Column:
    """The eleven fields of an expanded row; those that are not given are null."""
    return _origin(TEACHER_FIELDS, {"system_prompt_sha256": F.sha2(prompt, 256), "expansion_timestamp_utc": stamp(timestamp), "engine_version": __version__, **given})


def seed_provenance(timestamp: str | None = None, **given) -> Column:
    """The nine fields of a seed that was written by hand."""
    return _origin(SEED_FIELDS, {"teacher_provider": "hand_seed", "expansion_timestamp_utc": stamp(timestamp), "engine_version": __version__, **given})


def accepted(rows: DataFrame, origin: Column, source: str = "teacher_expansion", order: str = "row_idx") -> DataFrame:
    """Rows that the gate has accepted, with ids of their own, their source and their origin; other columns stay."""
    return unique_ids(rows.withColumn("source", F.lit(source)).withColumn("provenance", origin), order=order)


def existing_by_seed(done: DataFrame, seed: str = "provenance.seed_trajectory_id") -> DataFrame:
    """How many rows of an interrupted run each seed has already."""
    return done.groupBy(F.col(seed).alias("seed_id")).agg(F.count("*").alias("n"))


def expansion_counts(judged: DataFrame, verdict: str = "verdict", split: str = "split") -> DataFrame:
    """One row: accepted and rejected completions, and the accepted ones of each split."""
    good = F.col(verdict) == "accept"
    return judged.agg(F.count_if(good).alias("accepted"), F.count_if(~good).alias("rejected"), *[F.count_if(good & (F.col(split) == s)).alias(s) for s in ("train", "dev", "test")])


def same_in_all(rows: DataFrame, names: tuple[str, ...] = ("train", "dev", "test")) -> DataFrame:
    """Every row in every split, for smoke runs."""
    return rows.withColumn("split", F.explode(F.array(*map(F.lit, names))))


# What the last message asks for: the thought first, the call then.
ASKS = ("Write the thought only.", "Write the JSON-RPC request only.")


def requests(samples: DataFrame, model: str, grammar: str, max_tokens: tuple[int, int] = (256, 256), temperature: float = 0.0) -> DataFrame:
    """Samples with the JSON of their two requests, for the thought and for the call after it, and its digests.

    The call's request holds the thought as the model's turn and is bound to a
    grammar.
    """
    m = F.col("messages")
    turn = "struct<role:string,content:string>"

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content")).cast(turn)

    def payload(messages: Column, tokens: int, *more: Column) -> Column:
        return F.to_json(F.struct(F.lit(model).alias("model"), messages.alias("messages"), F.lit(tokens).alias("max_tokens"), F.lit(temperature).alias("temperature"), *more))

    asked = [F.slice(m, 1, 2), F.array(message("user", F.lit(ASKS[0])))]
    think = payload(F.concat(*[x.cast(f"array<{turn}>") for x in asked]), max_tokens[0])
    thought_ = F.concat(F.lit("<think>"), thought(m[2]["content"]), F.lit("</think>"))
    then = F.array(message("assistant", F.coalesce(thought_, F.lit(""))), message("user", F.lit(ASKS[1])))
    call = payload(F.concat(F.slice(m, 1, 2).cast(f"array<{turn}>"), then), max_tokens[1], F.lit(grammar).alias("grammar"))
    out = samples.withColumns({"think_request": think, "call_request": call})
    return out.withColumns({"think_sha256": F.sha2("think_request", 256), "call_sha256": F.sha2("call_request", 256)})


def remaining(rows: DataFrame, done: DataFrame, key: str = "trajectory_id") -> DataFrame:
    """Rows that an interrupted run has not done yet."""
    return rows.join(done.select(key).distinct(), key, "left_anti")
