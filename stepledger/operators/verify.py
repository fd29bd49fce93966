"""The checks of one step and the ordered fold over a record's steps.

All that does not depend on the state (thought, JSON, method, parameters) is
found first, for all steps of a record at once; the fold then only looks up
arcs. Both are expressions over one row, so grading needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepledger.domain import DEFAULT, SUBSCORES, Domain
from stepledger.functions import schema as S
from stepledger.functions.jsontext import read_calls
from stepledger.functions.text import call_text, thought

RESULT = "struct<passed:boolean,parse:double,schema:double,method_known:double,precondition_met:double,transition_valid:double,sequence_optimal:double,thinking:string,call:string,method:string,new_state:string,error_class:string,error_message:string>"
STATELESS = ("problem", "thinking", "call", "method", "triggers", "schema_ok")


def strings(values) -> Column:
    """An array literal of strings, empty or not."""
    return F.array(*map(F.lit, values)).cast("array<string>")


def arc_map(domain: Domain) -> Column:
    """The arcs as a map literal from state and trigger to state."""
    return F.create_map(*[F.lit(x) for (at, trigger), to in domain.arcs.items() for x in (f"{at}\n{trigger}", to)])


def arc(arcs: Column, state: Column, trigger: Column) -> Column:
    """The state that an arc leads to; null where there is none."""
    return F.try_element_at(arcs, F.concat(state, F.lit("\n"), trigger))


def let(value: Column, body) -> Column:
    """body(value) with the value computed once and standing once in the expression.

    Without it an expression that is used in ten places is ten copies for the
    optimizer, and those of nested ones multiply.
    """
    return F.get(F.transform(F.array(value), body), 0)


def stateless(outputs: Column, domain: Domain = DEFAULT) -> Column:
    """For each output of an array what can be said without its state."""
    calls = F.transform(outputs, call_text)
    other = {m: s for m, s in domain.params.items() if not S.is_native(s)}
    parts = [outputs.alias("output"), calls.alias("text"), read_calls(calls).alias("read")]
    if other:  # schemas beyond native columns run in the validator, for all steps in one call
        parts.append(S.validate_params(calls, other, domain.defs).alias("checked"))
    pairs = F.arrays_zip(*parts)
    by_method = F.create_map(*[x for m in domain.methods for x in (F.lit(m), strings(domain.triggers.get(m, ())))])

    def one(p: Column) -> Column:
        output, text, read = p["output"], p["text"], p["read"]
        method = read["method"]
        good = F.lit(False)
        for m, s in domain.params.items():
            fits = F.coalesce(p["checked"], F.lit(False)) if m in other else S.native(s, read["facts"])
            good = F.when(method == m, fits).otherwise(good)
        problem = (
            F.when(output.isNull() | text.isNull(), "no_think")
            .when(~read["ok"], "bad_json")
            .when(~read["is_object"], "not_an_object")
            .when(read["missing"].isNotNull(), "missing_keys")
            .when(~read["version_ok"], "bad_version")
            .when(read["method_kind"] == "z", "null_method")
            .when((read["method_kind"] != "s") | ~method.isin(list(domain.methods)), "unknown_method")
        )

        def known(problem: Column) -> Column:
            parsed = problem.isNull() | problem.isin("null_method", "unknown_method")
            return F.struct(
                problem.alias("problem"),
                F.when(parsed, thought(output)).alias("thinking"),
                F.when(parsed, text).alias("call"),
                F.when(parsed, method).alias("method"),
                F.try_element_at(by_method, method).alias("triggers"),
                F.when(problem.isNull(), good).otherwise(F.lit(False)).alias("schema_ok"),
            )

        return let(problem, known)

    return F.transform(pairs, one)


def judge(step: Column, state: Column, expected_trigger: Column, expected_after: Column, domain: Domain = DEFAULT, infer: bool = False) -> Column:
    """The result of a step whose stateless part is known, from a state.

    An empty expected trigger counts as none. With ``infer`` a step without
    an expected trigger takes the first of its method's triggers that has an
    arc from the state, one that leads to the expected state before others.
    """
    arcs = arc_map(domain)
    given = F.struct(step.alias("step"), state.alias("state"), F.nullif(expected_trigger, F.lit("")).alias("claimed"), expected_after.alias("after"))

    def with_arcs(g: Column) -> Column:
        open_ = F.filter(g["step"]["triggers"], lambda t: F.map_contains_key(arcs, F.concat(g["state"], F.lit("\n"), t)))
        return let(F.struct(g.alias("g"), open_.alias("open")), with_target)

    def with_target(x: Column) -> Column:
        g = x["g"]
        to = F.when(F.array_contains(g["step"]["triggers"], g["claimed"]), arc(arcs, g["state"], g["claimed"]))
        if infer:
            wanted = F.filter(x["open"], lambda t: arc(arcs, g["state"], t) == g["after"])
            first = F.coalesce(F.when(F.nullif(g["after"], F.lit("")).isNotNull(), F.get(wanted, 0)), F.get(x["open"], 0))
            to = F.when(g["claimed"].isNull(), arc(arcs, g["state"], first)).otherwise(to)
        return let(F.struct(g.alias("g"), x["open"].alias("open"), to.alias("to")), with_marks)

    def with_marks(x: Column) -> Column:
        g = x["g"]
        query = F.coalesce(F.size(g["step"]["triggers"]) == 0, F.lit(False))
        fits = F.coalesce(x["to"].isNotNull() & (g["after"].isNull() | (x["to"] == g["after"])), F.lit(False))
        known = g["step"]["problem"].isNull() & g["state"].isNotNull()
        marks = F.struct(
            g.alias("g"),
            known.alias("known"),
            F.coalesce(known & g["step"]["schema_ok"], F.lit(False)).alias("schema"),
            (known & (query | F.coalesce(F.size(x["open"]) > 0, F.lit(False)))).alias("can"),
            x["open"].alias("open"),
            (known & (query | fits)).alias("moved"),
            F.when(known, F.when(query, g["state"]).when(fits, x["to"])).alias("new_state"),
        )
        return let(marks, with_error)

    def with_error(m: Column) -> Column:
        problem = m["g"]["step"]["problem"]
        error = F.when(problem.isNotNull(), problem).when(m["g"]["state"].isNull(), "no_prior_state").when(~m["schema"], "schema").when(~m["moved"], "transition")
        # a missing state undoes what was parsed; an unknown method comes first
        parsed = F.coalesce(m["known"] | problem.isin("null_method", "unknown_method"), F.lit(False))
        return let(F.struct(m.alias("m"), error.alias("error"), parsed.alias("parsed")), finished)

    def finished(x: Column) -> Column:
        m, error, parsed = x["m"], x["error"], x["parsed"]
        step, state = m["g"]["step"], m["g"]["state"]
        claimed, after = m["g"]["claimed"], m["g"]["after"]
        detail = (
            F.when(error == "no_think", F.lit("no thought in its tags before the call"))
            .when(error == "bad_json", F.lit("the call is not strict JSON"))
            .when(error == "not_an_object", F.lit("the call is not a JSON object"))
            .when(error == "missing_keys", F.lit("the call lacks one of its four keys"))
            .when(error == "bad_version", F.lit("jsonrpc is not '2.0'"))
            .when(error == "null_method", F.lit("method is null in the call"))
            .when(error == "unknown_method", F.concat(F.lit("unknown method: "), F.coalesce(step["method"], F.lit("not a string"))))
            .when(error == "no_prior_state", F.lit("the context has no 'prior_state'"))
            .when(error == "schema", F.concat(F.lit("parameters of "), step["method"], F.lit(" break their schema")))
            .when((error == "transition") & F.lit(infer) & claimed.isNull() & (F.size(m["open"]) == 0), F.concat(F.lit("transition_valid=0: no trigger of "), step["method"], F.lit(" has an arc from "), state))
            .when((error == "transition") & F.lit(infer) & claimed.isNull(), F.concat(F.lit("transition_valid=0: "), step["method"], F.lit(" from "), state, F.lit(" leads to "), F.array_join(F.transform(m["open"], lambda t: arc(arcs, state, t)), ", "), F.lit(" and not to "), after))
            .when(error == "transition", F.concat(F.lit("transition_valid=0: "), step["method"], F.lit(" from "), state, F.lit(" with trigger "), F.coalesce(claimed, F.lit("none")), F.lit(" and expected state "), F.coalesce(after, F.lit("any"))))
        )

        def mark(condition: Column) -> Column:
            return F.when(condition, 1.0).otherwise(0.0)

        return F.struct(
            (m["known"] & m["schema"] & m["can"] & m["moved"]).alias("passed"),
            mark(parsed).alias("parse"),
            mark(m["schema"]).alias("schema"),
            mark(m["known"]).alias("method_known"),
            mark(m["can"]).alias("precondition_met"),
            mark(m["moved"]).alias("transition_valid"),
            mark(m["moved"]).alias("sequence_optimal"),
            F.when(parsed, step["thinking"]).alias("thinking"),
            F.when(parsed, step["call"]).alias("call"),
            F.when(parsed, step["method"]).alias("method"),
            m["new_state"].alias("new_state"),
            error.alias("error_class"),
            detail.alias("error_message"),
        ).cast(RESULT)

    return let(given, with_arcs)


def verify_steps(steps: DataFrame, domain: Domain = DEFAULT, infer: bool = False, output: str = "output", state: str = "prior_state", trigger: str = "expected_trigger", after: str = "expected_state_after", result: str = "result") -> DataFrame:
    """Rows of single steps with the result of each."""
    name = result
    while f"{name}_facts" in steps.columns:
        name += "_"
    found = steps.withColumn(f"{name}_facts", F.get(stateless(F.array(F.col(output)), domain), 0))
    judged = judge(F.col(f"{name}_facts"), F.col(state), F.col(trigger) if trigger else F.lit(None).cast("string"), F.col(after), domain, infer)
    return found.withColumn(result, judged).drop(f"{name}_facts")


def fold(steps: Column, facts: Column, initial: Column, domain: Domain = DEFAULT, infer: bool = False, stop_at_failure: bool = False) -> Column:
    """state and results of a record, its steps judged in order.

    The state moves on only by steps that pass; later steps are judged from
    where it stayed. ``stop_at_failure`` ends with the first failed step.
    """
    pairs = F.arrays_zip(steps.alias("step"), facts.alias("facts"))
    start = F.struct(initial.cast("string").alias("state"), F.array().cast(f"array<{RESULT}>").alias("results"))

    def merge(acc: Column, p: Column) -> Column:
        r = judge(p["facts"], acc["state"], p["step"]["expected_trigger"], p["step"]["expected_state_after"], domain, infer)

        def add(r: Column) -> Column:
            return F.struct(
                F.when(r["passed"] & r["new_state"].isNotNull(), r["new_state"]).otherwise(acc["state"]).alias("state"),
                F.concat(acc["results"], F.array(r)).alias("results"),
            )

        after = let(r, add)
        if stop_at_failure:
            return F.when(F.exists(acc["results"], lambda x: ~x["passed"]), acc).otherwise(after)
        return after

    return F.aggregate(pairs, start, merge)


def verify_records(records: DataFrame, domain: Domain = DEFAULT, infer: bool = False, stop_at_failure: bool = False, result: str = "result") -> DataFrame:
    """Records with steps, outputs, initial_state and final_state, and the result of each.

    ``steps`` are structs with expected_trigger and expected_state_after,
    ``outputs`` the texts in the same order.
    """
    held = "held"
    while held in records.columns:
        held += "_"
    steps, outputs = F.coalesce(F.col("steps"), F.array().cast(records.schema["steps"].dataType)), F.coalesce(F.col("outputs"), F.array().cast("array<string>"))
    rows = records.withColumn(held, stateless(outputs, domain))
    rows = rows.withColumn(held, fold(steps, F.col(held), F.col("initial_state"), domain, infer, stop_at_failure))
    n, m = F.size(outputs), F.size(steps)
    results, state = F.col(held)["results"], F.col(held)["state"]
    all_passed = F.forall(results, lambda r: r["passed"])
    wrong_end = all_passed & F.col("final_state").isNotNull() & ~state.eqNullSafe(F.col("final_state"))
    failed = F.filter(F.transform(results, lambda r, i: F.when(~r["passed"], F.struct(i.alias("i"), r["error_message"].alias("e")))), lambda x: x.isNotNull())
    first = F.get(failed, 0)
    error = (
        F.when(n != m, F.concat(F.lit("length mismatch: "), n.cast("string"), F.lit(" outputs vs "), m.cast("string"), F.lit(" expected steps")))
        .when(m == 0, F.lit("empty trajectory (no steps)"))
        .when(wrong_end, F.concat(F.lit("final state "), F.coalesce(state, F.lit("none")), F.lit(" does not match expected "), F.col("final_state")))
        .when(first.isNotNull(), F.concat(F.lit("step "), first["i"].cast("string"), F.lit(" failed: "), F.coalesce(first["e"], F.lit("?"))))
    )
    out = F.struct(
        (error.isNull()).alias("passed"),
        F.when(n == m, results).otherwise(F.array().cast(f"array<{RESULT}>")).alias("steps"),
        F.when(n == m, state).alias("final_state"),
        error.alias("error_message"),
    )
    return rows.withColumn(result, out).drop(held)


def first_failing(result: Column) -> Column:
    """The first subscore below 1, in their fixed order; null where all are 1."""
    return F.coalesce(*[F.when(result[s] < 1.0, s) for s in SUBSCORES])
