"""Scores of a run over graded records.

Input is one row for each record and sample: trajectory_id, sample_idx (0 is
the greedy one), initial_state, result (of verify_records) and final_call, the
text of the last step's output. ``row_idx`` is the order of the records in
their file and settles what was seen first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepledger.domain import DEFAULT, Domain
from stepledger.functions.text import without_thought
from stepledger.operators.verify import first_failing, verify_records, verify_steps

#: k of the score card of an empty run.
DEFAULT_K = 8


def majority(samples: DataFrame) -> DataFrame:
    """trajectory_id and maj: whether a sample with the most frequent final call passed.

    Of calls that are as frequent the one that was sampled first counts.
    """
    votes = (
        samples.where(F.col("final_call").isNotNull())
        .groupBy("trajectory_id", without_thought(F.col("final_call")).alias("vote"))
        .agg(F.count("*").alias("n"), F.min("sample_idx").alias("first"), F.bool_or(F.col("result.passed")).alias("won"))
    )
    best = F.max_by("won", F.struct("n", -F.col("first")))
    return votes.groupBy("trajectory_id").agg(best.alias("maj"))


def run_scores(graded: DataFrame) -> DataFrame:
    """One row: n_examples, pass_at_1, pass_at_k, pass_at_maj and k."""
    greedy = graded.where("sample_idx = 0").select("trajectory_id", F.col("result.passed").alias("p1"))
    samples = graded.where("sample_idx > 0")
    any_ = samples.groupBy("trajectory_id").agg(F.bool_or("result.passed").alias("pk"), F.count("*").alias("k"))
    rows = greedy.join(any_, "trajectory_id", "left").join(majority(samples), "trajectory_id", "left")

    def share(c: str) -> Column:
        return F.coalesce(F.avg(F.coalesce(F.col(c), F.lit(False)).cast("double")), F.lit(0.0))

    return rows.agg(
        F.count("*").alias("n_examples"),
        share("p1").alias("pass_at_1"),
        share("pk").alias("pass_at_k"),
        share("maj").alias("pass_at_maj"),
        F.when(F.count("*") == 0, F.lit(DEFAULT_K)).otherwise(F.coalesce(F.max("k"), F.lit(0))).cast("long").alias("k"),
    )


def first_failure(result: Column) -> Column:
    """step, subscore and error of the first step of a record with a subscore below 1; null for passed records."""
    found = F.filter(
        F.transform(result["steps"], lambda r, i: F.struct(i.alias("step"), first_failing(r).alias("subscore"), r["error_message"].alias("error"))),
        lambda x: x["subscore"].isNotNull(),
    )
    return F.when(~result["passed"], F.get(found, 0))


def failure_modes(greedy: DataFrame) -> DataFrame:
    """subscore, n and first_row (the order in which modes were seen); a record that only ends in the wrong state has none."""
    mode = first_failure(F.col("result"))["subscore"]
    return greedy.select(mode.alias("subscore"), "row_idx").where("subscore IS NOT NULL").groupBy("subscore").agg(F.count("*").alias("n"), F.min("row_idx").alias("first_row"))


def diagnostics(greedy: DataFrame) -> DataFrame:
    """For each record whether it passed and what failed first."""
    f = first_failure(F.col("result"))
    return greedy.select(
        "row_idx",
        "trajectory_id",
        "initial_state",
        F.col("result.passed").alias("passed"),
        f["step"].alias("first_failing_step"),
        f["subscore"].alias("first_failing_subscore"),
        f["error"].alias("error_message"),
    )


def failed_by_state(diagnosed: DataFrame) -> DataFrame:
    """Failed records counted by initial state, those without one under a common name."""
    state = F.coalesce(F.nullif(F.col("initial_state"), F.lit("")), F.lit("(unknown)"))
    return diagnosed.where(~F.col("passed")).groupBy(state.alias("initial_state")).agg(F.count("*").alias("n"), F.min("row_idx").alias("first_row"))


def scorecard(graded: DataFrame, run_name: str) -> DataFrame:
    """One row of a run's scores with failure modes in the order seen and diagnostics of each record.

    The diagnostics are an array on one row, as reports store them; for runs
    beyond what a row holds use diagnostics() itself.
    """
    greedy = graded.where("sample_idx = 0")
    modes = failure_modes(greedy).agg(F.map_from_entries(F.transform(F.sort_array(F.collect_list(F.struct("first_row", "subscore", "n"))), lambda x: F.struct(x["subscore"], x["n"]))).alias("failure_modes"))
    each = diagnostics(greedy).agg(F.sort_array(F.collect_list(F.struct("row_idx", "trajectory_id", "initial_state", "passed", "first_failing_step", "first_failing_subscore", "error_message"))).alias("per_trajectory"))
    return run_scores(graded).crossJoin(modes).crossJoin(each).withColumn("run_name", F.lit(run_name))


def places(rows: DataFrame, by: list[str], order: list[str], bins: Column, name: str = "place") -> DataFrame:
    """Rows with their place, from 0, among those of a group, in an order.

    ``bins`` grows with the order. Rows are numbered within a bin, and bins by
    the counts before them, so that no task orders a large group as a whole.
    """
    rows = rows.withColumn("_bin", bins)
    counts = rows.groupBy(*by, "_bin").agg(F.count("*").alias("_here"))
    upto = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_here").over(upto), F.lit(0))).drop("_here")
    numbered = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*by, "_bin").orderBy(*order)))
    keys = [numbered[k].eqNullSafe(counts[k]) for k in (*by, "_bin")]
    joined = numbered.join(counts, keys).select(*[numbered[c] for c in numbered.columns], "_before")
    return joined.withColumn(name, F.col("_before") + F.col("_nth") - 1).drop("_bin", "_nth", "_before")


def rolling_means(rows: DataFrame, columns: list[str], order: list[str], bins: Column, by: list[str] | None = None, window: int = 100, block: int = 1 << 16) -> DataFrame:
    """Means over the last rows up to each row, in an order; ``by`` deals the rows into runs of their own.

    A run is cut into blocks of rows; each also gets the rows before it that
    its first windows reach back to.
    """
    by, block = by or [], max(block, window)
    placed = places(rows, by, order, bins, "_place").withColumn("_block", F.floor(F.col("_place") / block))
    back = placed.where(F.col("_place") % block >= block - (window - 1)).withColumn("_block", F.col("_block") + 1).withColumn("_own", F.lit(False))
    over = Window.partitionBy(*by, "_block").orderBy("_place").rowsBetween(-(window - 1), 0)
    out = placed.withColumn("_own", F.lit(True)).unionByName(back).withColumns({f"mean_{c}": F.avg(c).over(over) for c in columns})
    return out.where("_own").drop("_place", "_block", "_own")


def saved_outputs(records: DataFrame, responses: DataFrame) -> DataFrame:
    """Records with the outputs that saved responses give their steps, and how many files they lack.

    ``responses`` has trajectory_id, step_idx, think and call. A step with a
    missing file has no output and fails to parse. Records and responses meet
    by step, so that a record's files may lie anywhere.
    """
    steps = records.select("trajectory_id", F.posexplode("steps").alias("step_idx", "step")).drop("step")
    joined = steps.join(responses.select("trajectory_id", "step_idx", "think", "call"), ["trajectory_id", "step_idx"], "left")
    output = F.concat(F.lit("<think>"), F.col("think"), F.lit("</think>"), F.col("call"))
    missing = F.col("think").isNull().cast("int") + F.col("call").isNull().cast("int")
    each = joined.select("trajectory_id", F.struct("step_idx", output.alias("output")).alias("o"), missing.alias("missing"))
    held = each.groupBy("trajectory_id").agg(F.array_sort(F.collect_list("o")).alias("o"), F.sum("missing").alias("missing"))
    outputs = F.transform("o", lambda x: x["output"])
    return records.join(held.select("trajectory_id", outputs.alias("outputs"), "missing"), "trajectory_id", "left")


def saved_scores(records: DataFrame, responses: DataFrame, domain: Domain = DEFAULT) -> DataFrame:
    """Records graded by their saved responses, up to the first step that fails."""
    return verify_records(saved_outputs(records, responses), domain, stop_at_failure=True)


def saved_step(records: DataFrame, responses: DataFrame, step_idx: int, domain: Domain = DEFAULT) -> DataFrame:
    """One step of each record, in the state that its context declares, graded by its saved pair of responses."""
    steps = records.select("trajectory_id", F.get("steps", F.lit(step_idx)).alias("step")).where(F.col("step").isNotNull())
    pair = responses.where(F.col("step_idx") == step_idx).select("trajectory_id", F.concat(F.lit("<think>"), F.col("think"), F.lit("</think>"), F.col("call")).alias("output"))
    rows = steps.join(pair, "trajectory_id", "left").select("trajectory_id", "output", F.col("step.prior_state").alias("prior_state"), F.col("step.expected_trigger").alias("expected_trigger"), F.col("step.expected_state_after").alias("expected_state_after"))
    return verify_steps(rows, domain)
