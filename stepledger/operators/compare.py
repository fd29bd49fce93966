"""Comparison of runs: table, arms and failure chart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepledger.domain import SUBSCORES
from stepledger.functions.text import run_family

METRICS = ("pass_at_1", "pass_at_k", "pass_at_maj")
BAR = 20


def run_table(runs: DataFrame, baseline: str | None = None) -> DataFrame:
    """Runs with the difference of pass_at_1 to a named run, the first of that name by file.

    ``delta`` is null for the base itself and where a value is missing;
    ``delta_kind`` tells these apart, ``worse`` marks what a report prints bold.
    """
    if baseline is None:
        return runs.withColumns({"delta": F.lit(None).cast("double"), "delta_kind": F.lit(""), "worse": F.lit(False)})
    base = runs.where(F.col("run_name") == baseline).agg(F.min_by("pass_at_1", "file").alias("base_pass"))
    delta = F.col("pass_at_1") - F.col("base_pass")
    rows = runs.crossJoin(F.broadcast(base))  # one row
    own = F.coalesce(F.col("run_name") == baseline, F.lit(False))
    return rows.withColumns(
        {
            "delta": F.when(~own, delta),
            "delta_kind": F.when(own, "(base)").when(delta.isNull(), "?").otherwise("number"),
            "worse": ~own & F.coalesce(delta < 0, F.lit(False)),
        }
    ).drop("base_pass")


def top_failures(modes: Column, n: int = 3) -> Column:
    """The most frequent modes as text, those as frequent in their order in the map."""
    entries = F.transform(F.map_entries(modes), lambda e, i: F.struct((-e["value"]).alias("less"), i.alias("i"), e["key"].alias("key"), e["value"].alias("n")))
    listed = F.transform(F.slice(F.array_sort(entries), 1, n), lambda e: F.concat(e["key"], F.lit("("), e["n"].cast("string"), F.lit(")")))
    return F.when(F.coalesce(F.size(modes), F.lit(0)) <= 0, "-").otherwise(F.array_join(listed, ", "))


def exclusive_quartile(sorted_values: Column, quarter: int) -> Column:
    """Quartile at place quarter * (n + 1) / 4 of sorted values, between neighbours in proportion."""
    n = F.size(sorted_values)
    place = F.lit(quarter) * (n + 1)
    j = F.greatest(F.lit(1), F.least(F.floor(place / 4).cast("int"), n - 1))
    part = place - j * 4
    return (F.get(sorted_values, j - 1) * (4 - part) + F.get(sorted_values, j) * part) / 4


def arm_summary(runs: DataFrame) -> DataFrame:
    """For each family of runs that differ by seed the median of each metric, and half the quartile range for four values or more."""
    named = runs.withColumn("family", run_family(F.col("run_name"))["family"])
    lists = named.groupBy("family").agg(F.count("*").alias("n_seeds"), *[F.sort_array(F.collect_list(m)).alias(m) for m in METRICS])
    out = []
    for m in METRICS:
        v, n = F.col(m), F.size(m)
        middle = (F.get(v, F.floor((n - 1) / 2).cast("int")) + F.get(v, F.floor(n / 2).cast("int"))) / 2
        half = (exclusive_quartile(v, 3) - exclusive_quartile(v, 1)) / 2
        out += [F.when(n > 0, middle).otherwise(0.0).alias(f"{m}_median"), F.when(n >= 4, half).otherwise(0.0).alias(f"{m}_half_iqr"), n.cast("long").alias(f"{m}_n")]
    return lists.select("family", "n_seeds", *out)


def has_arms(runs: DataFrame) -> bool:
    """Whether a family has more than one run, which is when a report shows arms."""
    return not runs.groupBy(run_family(F.col("run_name"))["family"]).count().where("count > 1").isEmpty()


def failure_chart(modes: DataFrame) -> DataFrame:
    """subscore, n and bar length of modes (subscore, n) summed over runs; the largest of any name sets the scale."""
    total = modes.groupBy("subscore").agg(F.sum("n").alias("n"))
    largest = total.agg(F.max("n").alias("largest"))
    names = modes.sparkSession.createDataFrame([(i, s) for i, s in enumerate(SUBSCORES)], "place int, subscore string")
    n = F.coalesce(F.col("n"), F.lit(0))
    bar = F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), F.bround(BAR * n / F.col("largest")).cast("int")))
    rows = F.broadcast(names).join(total, "subscore", "left").crossJoin(F.broadcast(largest))  # six rows and one
    return rows.select("place", "subscore", n.cast("long").alias("n"), bar.cast("int").alias("bar"))
