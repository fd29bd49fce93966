"""Overlap of two sets of records: equal content, shared origins, similar beginnings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepledger.functions.jsontext import canonical
from stepledger.functions.text import token_set

THRESHOLD, EXAMPLES = 0.8, 3
#: Tokens that occur once in so many characters, or more often, are ordered by their counts.
FREQUENT = 1 << 24
#: Parts of a record that say where it is from.
ORIGIN = ("provenance", "source")


def content_digest(raw: Column) -> Column:
    """Digest of a record's content, whatever the order of its keys."""
    return F.sha2(canonical(raw, ORIGIN), 256)


def exact_overlap(left: DataFrame, right: DataFrame, digest: str = "digest") -> DataFrame:
    """Digests that both sides have."""
    return left.select(digest).intersect(right.select(digest)).where(F.col(digest).isNotNull())


def shared_origins(left: DataFrame, right: DataFrame, nested: bool = False) -> DataFrame:
    """Origins that both sides have: seed_trajectory_id or else trajectory_id.

    The plain audit reads the top level of a record; ``nested`` reads the
    lineage that records carry in their provenance.
    """

    def of(rows: DataFrame) -> DataFrame:
        seed = F.col("provenance.seed_trajectory_id") if nested else F.col("seed_trajectory_id") if "seed_trajectory_id" in rows.columns else F.lit(None)
        return rows.select(F.coalesce(F.nullif(seed.cast("string"), F.lit("")), F.col("trajectory_id")).alias("origin"))

    return of(left).intersect(of(right)).where(F.col("origin").isNotNull())


def ordered_prefix(tokens: Column, threshold: float, counts: dict[int, int]) -> Column:
    """The first n - ceil(t * n) + 1 of a set's tokens, rarest first, with the one before each, n and its place.

    ``tokens`` are hashes. Those whose low halves are in ``counts`` come in
    the order of their counts, after all others; a token is told by its place
    there and by the other half, so that all sets have one order. Tokens that
    fall together there only make sets meet that need not.
    """
    hashes = np.array(sorted(counts), np.int64)
    rank = np.empty(len(hashes), np.uint64)
    rank[np.lexsort((hashes, [counts[h] for h in hashes.tolist()]))] = np.arange(1, len(hashes) + 1, dtype=np.uint64)

    @F.arrow_udf("array<struct<token:bigint,previous:bigint,n:int,place:int>>")
    def prefix(lists: pa.Array) -> pa.Array:
        values, n = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        told = values.view(np.uint64) >> np.uint64(32)
        if len(hashes):
            low = values & np.int64(0xFFFFFFFF)
            at = np.minimum(np.searchsorted(hashes, low), len(hashes) - 1)
            told |= np.where(hashes[at] == low, rank[at], np.uint64(0)) << np.uint64(32)
        start, own = np.concatenate([[0], np.cumsum(n)]), np.repeat(np.arange(len(n)), n)
        token = told[np.lexsort((told, own))].view(np.int64)
        place = np.arange(len(token)) - start[own]
        take = n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1
        kept = place < take[own]
        before = np.concatenate([[0], token[:-1]]) if len(token) else token
        parts = [pa.array(token[kept]), pa.array(before[kept], mask=place[kept] == 0), pa.array(n[own][kept].astype(np.int32)), pa.array(place[kept].astype(np.int32))]
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.minimum(take, n))]).astype(np.int32)), pa.StructArray.from_arrays(parts, ["token", "previous", "n", "place"]))

    return prefix(tokens)


def parities(tokens: Column) -> Column:
    """A bit for each remainder of the tokens' hashes: whether an odd number has it; at least as many bits as tokens."""

    @F.arrow_udf("binary")
    def of(lists: pa.Array) -> pa.Array:
        out = []
        for one in lists:
            values = one.values.to_numpy(zero_copy_only=False).view(np.uint64)
            bits = max(64, 1 << (len(values) - 1).bit_length())
            odd = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
            out.append(np.packbits(odd.astype(bool)).tobytes())
        return pa.array(out, pa.binary())

    return of(tokens)


def differing(left: Column, right: Column) -> Column:
    """At least so many tokens are in one of two sets only, by their parities; the longer ones are folded."""

    @F.arrow_udf("int")
    def count(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for short, long in zip(a.to_pylist(), b.to_pylist(), strict=True):
            short, long = sorted((np.frombuffer(short, np.uint8), np.frombuffer(long, np.uint8)), key=len)
            while len(long) > len(short):
                long = np.bitwise_xor(*np.split(long, 2))
            out.append(int(np.bitwise_count(short ^ long).sum()))
        return pa.array(out, pa.int32())

    return count(left, right)


def shared_words(left: Column, right: Column) -> Column:
    """How many words two texts of distinct words share."""

    @F.arrow_udf("int")
    def count(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([len(set(x.split(" ")).intersection(y.split(" "))) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.int32())

    return count(left, right)


def _side(sides: int) -> Column:
    return F.lit(1 << sides).cast("int")


def _similar_texts(rows: DataFrame, threshold: float) -> DataFrame:
    """x, y, x_sides, y_sides and similarity of pairs of texts whose rows are on two sides.

    ``rows`` has text_key, text and sides, a bit for each side. A pair comes
    once, with x at most y; x is y for a text of two sides.

    Texts meet in the rarest tokens of each: two sets that are similar enough
    share one of the first n - ceil(t * n) + 1 tokens of each, in any one
    order. Frequent tokens come last and by their counts; frequent is a share of
    all characters, so their number is bounded. Pairs that meet, and whose sizes and places allow the similarity,
    are compared by parities first and then in full.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is above 0 and at most 1")
    t, e = F.lit(threshold), F.lit(1e-9)
    characters = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    low = rows.select(F.explode(token_set(F.col("text"))).alias("w")).select(F.xxhash64("w").bitwiseAND(F.lit(0xFFFFFFFF)).alias("h")).groupBy("h").agg(F.count("*").alias("c"))
    counts = {r["h"]: r["c"] for r in low.where(F.col("c") > max(1, characters // FREQUENT)).collect()}
    # a short key for what is dealt out by token; texts are dealt out by it once, and those that share one are told apart
    texts = rows.select(F.xxhash64("text_key").alias("k"), F.struct("text_key", F.array_join(token_set(F.col("text")), " ").alias("words"), "sides").alias("one")).where("one.words <> ''")
    texts = texts.groupBy("k").agg(F.collect_set("one").alias("all")).select("k", F.explode("all").alias("one")).select("k", "one.*")
    texts = texts.groupBy("k", "text_key").agg(F.first("words").alias("words"), F.bit_or("sides").alias("sides"))
    tokens = F.transform(F.split("words", " "), lambda w: F.xxhash64(w))

    p = texts.select("k", "sides", F.explode(ordered_prefix(tokens, threshold, counts)).alias("p")).select("k", "sides", "p.*")
    x, y = p.select(*[F.col(c).alias(f"x_{c}") for c in p.columns]), p.select(*[F.col(c).alias(f"y_{c}") for c in p.columns])
    xn, yn = F.col("x_n"), F.col("y_n")
    least = F.ceil((xn + yn) * (t / (t + 1)) - e)  # tokens that both have
    two = F.bit_count(F.col("x_sides").bitwiseOR(F.col("y_sides"))) > 1

    def early(n: Column, place: str) -> Column:
        """The smaller set meets the larger one among fewer tokens."""
        return F.col(place) <= n - F.ceil(n * (t * 2 / (t + 1)) - e)

    met = x.join(
        y,
        (F.col("x_token") == F.col("y_token"))
        & (F.col("x_k") <= F.col("y_k"))
        & two
        & (F.least(xn, yn) >= t * F.greatest(xn, yn) - e)
        & F.when(xn <= yn, early(xn, "x_place")).otherwise(early(yn, "y_place"))
        & (F.least(xn - F.col("x_place"), yn - F.col("y_place")) >= least)
        # those that share the token before as well have met there
        & ~F.coalesce(F.col("x_previous") == F.col("y_previous"), F.lit(False)),
    ).select("x_k", "y_k").distinct()

    marks = texts.select("k", parities(tokens).alias("bits"), F.size(tokens).alias("n"))
    close = met.join(marks.select(F.col("k").alias("x_k"), F.col("bits").alias("x_bits"), F.col("n").alias("x_n")), "x_k").join(marks.select(F.col("k").alias("y_k"), F.col("bits").alias("y_bits"), F.col("n").alias("y_n")), "y_k")
    close = close.where(differing(F.col("x_bits"), F.col("y_bits")) <= xn + yn - 2 * least).select("x_k", "y_k").distinct()

    full = [texts.select(F.col("k").alias(f"{s}_k"), F.col("text_key").alias(s), F.col("words").alias(f"{s}_words"), F.col("sides").alias(f"{s}_sides")) for s in "xy"]
    both = close.join(full[0], "x_k").join(full[1], "y_k").where(two & ((F.col("x_k") != F.col("y_k")) | (F.col("x") <= F.col("y"))))
    words = [F.size(F.split(f"{s}_words", " ")).alias(f"{s}_n") for s in "xy"]
    both = both.select("x", "y", "x_sides", "y_sides", *words, shared_words(F.col("x_words"), F.col("y_words")).alias("shared"))
    return both.withColumn("similarity", F.col("shared") / (xn + yn - F.col("shared"))).where(F.col("similarity") >= threshold).select("x", "y", "x_sides", "y_sides", "similarity")


def _key(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def _texts(rows: DataFrame, text: str, sides: Column) -> DataFrame:
    return rows.select(_key(text).alias("text_key"), F.col(text).alias("text"), sides.alias("sides"))


def _both_ways(pairs: DataFrame, left: int, right: int) -> DataFrame:
    """left, right and similarity of pairs of texts, of which the left one is on one side and the right one on the other."""
    ways = F.array(F.struct(F.col("x").alias("left"), F.col("y").alias("right"), F.col("x_sides").alias("l"), F.col("y_sides").alias("r")), F.struct(F.col("y").alias("left"), F.col("x").alias("right"), F.col("y_sides").alias("l"), F.col("x_sides").alias("r")))
    ways = F.when(F.col("x") == F.col("y"), F.slice(ways, 1, 1)).otherwise(ways)
    rows = pairs.select(F.explode(ways).alias("w"), "similarity").select("w.*", "similarity")
    return rows.where((F.col("l").bitwiseAND(_side(left)) > 0) & (F.col("r").bitwiseAND(_side(right)) > 0)).select("left", "right", "similarity")


def similar_pairs(left: DataFrame, right: DataFrame, threshold: float = THRESHOLD, key: str = "id", text: str = "text") -> DataFrame:
    """left_id, right_id and similarity of pairs with other ids and a Jaccard similarity of at least the threshold.

    The search is between distinct texts; rows with equal ones share what is found.
    """
    pairs = _both_ways(_similar_texts(_texts(left, text, _side(0)).unionByName(_texts(right, text, _side(1))), threshold), 0, 1)
    a, b = (rows.select(_key(text).alias(side), F.col(key).alias(f"{side}_id")) for rows, side in ((left, "left"), (right, "right")))
    rows = pairs.join(a, "left").join(b, "right")
    return rows.where(~F.col("left_id").eqNullSafe(F.col("right_id"))).select("left_id", "right_id", "similarity")


def _similar_rows(rows: DataFrame, threshold: float, held: list[tuple[int, int]]) -> DataFrame:
    """pair, similar_pairs and the first examples for each two sides of ``held``, by their place there, that have any.

    ``rows`` has side, id and text. Pairs of rows are counted from pairs of
    texts and the rows of each, and never laid out; of each text as many of
    the first ids count as the examples can need.
    """
    texts = rows.select(_key("text").alias("text_key"), "text", "side", "id")
    similar = _similar_texts(texts.select("text_key", "text", F.expr("CAST(shiftleft(1, side) AS INT)").alias("sides")), threshold)

    def way(n: int, x: str, y: str, a: int, b: int) -> Column:
        there = (F.col(f"{x}_sides").bitwiseAND(1 << a) > 0) & (F.col(f"{y}_sides").bitwiseAND(1 << b) > 0)
        there = there if x < y else there & (F.col("x") != F.col("y"))
        return F.when(there, F.struct(F.lit(n).alias("pair"), F.col(x).alias("left"), F.lit(a).alias("left_side"), F.col(y).alias("right"), F.lit(b).alias("right_side")))

    ways = F.array_compact(F.array(*[way(n, x, y, a, b) for n, (a, b) in enumerate(held) for x, y in ("xy", "yx")]))
    met = similar.select(F.explode(ways).alias("w")).select("w.*")

    ids = texts.groupBy("text_key", "side", "id").agg(F.count("*").alias("n"))
    some = ids.withColumn("nth", F.row_number().over(Window.partitionBy("text_key", "side").orderBy("id"))).where(F.col("nth") <= EXAMPLES + 1)
    first = some.groupBy("text_key", "side").agg(F.sort_array(F.collect_list(F.struct("id", F.least("n", F.lit(EXAMPLES)).alias("n")))).alias("ids"))
    each = ids.groupBy("text_key", "side").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless")).join(first, ["text_key", "side"])

    def of(side: str) -> DataFrame:
        return each.select(F.col("text_key").alias(side), F.col("side").alias(f"{side}_side"), F.col("n").alias(f"{side}_n"), F.col("nameless").alias(f"{side}_nameless"), F.col("ids").alias(f"{side}_ids"))

    # rows of one id are no pair
    a, b = (ids.select(F.col("text_key").alias(s), F.col("side").alias(f"{s}_side"), "id", F.col("n").alias(f"{s}_n")) for s in ("left", "right"))
    keys = ["left", "left_side", "right", "right_side"]
    one = a.join(b, "id").where("left_side <> right_side").groupBy(*keys).agg(F.sum(F.col("left_n") * F.col("right_n")).alias("one"))
    full = met.join(of("left"), ["left", "left_side"]).join(of("right"), ["right", "right_side"]).join(one, keys, "left")
    n = F.col("left_n") * F.col("right_n") - F.col("left_nameless") * F.col("right_nameless") - F.coalesce("one", F.lit(0))

    def named(a: Column) -> Column:
        other = F.filter("right_ids", lambda b: ~b["id"].eqNullSafe(a["id"]))
        return F.flatten(F.transform(other, lambda b: F.array_repeat(F.struct(a["id"].alias("left_id"), b["id"].alias("right_id")), (a["n"] * b["n"]).cast("int"))))

    def least(found: Column) -> Column:
        return F.slice(F.sort_array(F.flatten(found)), 1, EXAMPLES)

    shown = F.slice(F.sort_array(F.flatten(F.transform("left_ids", named))), 1, EXAMPLES)
    part = full.select("pair", F.xxhash64("left", "right").bitwiseAND(F.lit(0xFFFF)).alias("part"), n.alias("n"), shown.alias("shown"))
    part = part.groupBy("pair", "part").agg(F.sum("n").alias("n"), least(F.collect_list("shown")).alias("shown"))
    return part.groupBy("pair").agg(F.sum("n").alias("similar_pairs"), least(F.collect_list("shown")).alias("examples"))


def _reports(sides: list[DataFrame], threshold: float, held: list[tuple[int, int]]) -> DataFrame:
    """A report for each two sides of ``held``, told by their place there, which is in pair; similar texts are sought once."""

    def digests(rows: DataFrame) -> DataFrame:
        return rows.select(content_digest(F.col("raw")).alias("digest"), "trajectory_id").where(F.col("digest").isNotNull())

    out = rows = None
    for n, (left, right) in enumerate((sides[a], sides[b]) for a, b in held):
        shared = digests(left).groupBy("digest").agg(F.min("trajectory_id").alias("first")).join(digests(right).select("digest").distinct(), "digest", "left_semi")
        exact = shared.agg(F.count("*").alias("exact_overlap"))
        exact_examples = shared.orderBy("first").limit(EXAMPLES).agg(F.array_sort(F.collect_list("first")).alias("exact_examples"))
        origins = shared_origins(left, right).agg(F.array_sort(F.collect_list("origin")).alias("shared_seed_ids"))
        # one row each
        report = exact.crossJoin(exact_examples).crossJoin(origins).withColumn("pair", F.lit(n))
        out = report if out is None else out.unionByName(report)
    for n, side in enumerate(sides):
        one = side.select(F.lit(n).alias("side"), F.col("trajectory_id").alias("id"), F.col("situation").alias("text"))
        rows = one if rows is None else rows.unionByName(one)
    found = out.join(_similar_rows(rows, threshold, held), "pair", "left")
    none = F.array().cast(found.schema["examples"].dataType)
    return found.withColumns({"similar_pairs": F.coalesce("similar_pairs", F.lit(0).cast("long")), "examples": F.coalesce("examples", none)})


def overlap_report(left: DataFrame, right: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of counts, sorted shared origins and the first examples of equal content and of similar pairs.

    Both sides have raw (the record's text), trajectory_id and situation. An
    example of equal content is the smallest left id that has it.
    """
    return _reports([left, right], threshold, [(0, 1)]).drop("pair")


def audit_splits(rows: DataFrame, threshold: float = THRESHOLD, names: tuple[str, ...] = ("train", "dev", "test")) -> DataFrame:
    """An overlap report for each two of the splits, which are one table with a column split."""
    held = [(a, b) for a in range(len(names)) for b in range(a + 1, len(names))]
    told = F.array(*[F.lit(f"{names[a]}/{names[b]}") for a, b in held])
    reports = _reports([rows.where(F.col("split") == name) for name in names], threshold, held)
    return reports.withColumn("pair", F.get(told, "pair"))
