"""Best-fit packing of tokenised documents by bin completion.

The sizes to pack are whole numbers up to the capacity, so the problem is
solved on their histogram, which has at most ``capacity`` rows however many
documents there are. The solution is a list of patterns with multiplicities;
a piece finds its place in it from its rank among the pieces of its size.

The search is exact where it ends within its nodes, and without an end where
none are named (``nodes=None``); ``solve`` tells the number of sequences, a
lower bound and whether the optimum is proved.

Defined results: a null text is an empty one and gives a single piece of one
token; rows that repeat a doc_id are packed each on its own; an empty table
gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepledger.llm._shared import materialise, slices

CAPACITY = 2048
#: Pieces that one rank window holds together.
RANK_ROWS = 4_000
#: Nodes of a whole search, some seconds, and states that it remembers.
SEARCH_NODES, SEEN_STATES = 400_000, 100_000
#: Completions that the first round takes of a size, and nodes to find them in.
FEW, FEW_NODES = 3, 500

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_ENCODERS: dict = {}


def vocabulary(name: str = "byte_bpe_50k") -> tuple[str, str]:
    """The places of a byte-level vocabulary: as tokenizers and as ranks."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken")


def encoder(json_path: str, ranks_path: str | None):
    """A function from a text to its ids, as the tokenizers library gives them.

    Where ranks of the same vocabulary are given, texts of Latin script go
    through them (the ids are the same, several times faster); other scripts
    and very long runs of white space take the tokenizers library itself.
    """
    key = (json_path, ranks_path)
    if key in _ENCODERS:
        return _ENCODERS[key]
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(json_path)
    exact.encode_special_tokens = True

    def slow(text: str) -> list[int]:
        return exact.encode(text, add_special_tokens=False).ids

    if ranks_path is None:
        _ENCODERS[key] = slow
        return slow
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    foreign = re.compile(r"[^\x00-ɏ‐-‧]|\s{4096}|\S{65536}").search

    def encode(text: str) -> list[int]:
        return slow(text) if foreign(text) else fast.encode_ordinary(text)

    _ENCODERS[key] = encode
    return encode


def pieces(docs: DataFrame, json_path: str, ranks_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document: ids and a closing 0, cut only where they exceed the capacity.

    All pieces of a longer document but the first are full.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        encode = encoder(json_path, ranks_path)
        for batch in slices(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array(encode(text) + [0] if text else [0], dtype="<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity), len(ids)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing on a histogram: (filling, number of bins) pairs."""
    room: dict[int, list[tuple[dict[int, int], int]]] = {}
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = min((r for r in room if r >= size), default=None)
            if at is None:
                per = capacity // size
                for times, bins in ((per, left // per), (left % per, 1)):
                    if times and bins:
                        room.setdefault(capacity - times * size, []).append(({size: times}, bins))
                break
            filling, bins = room[at].pop()
            used = min(bins, left)
            if bins > used:
                room[at].append((filling, bins - used))
            if not room[at]:
                del room[at]
            room.setdefault(at - size, []).append((filling | {size: filling.get(size, 0) + 1}, used))
            left -= used
    return [x for group in room.values() for x in group]


def least_bins(counts: dict[int, int], capacity: int) -> int:
    """A lower bound: for each small size a, what stands above capacity - a is alone in its bin, what is above
    half the capacity has a bin of its own, and the rest from a on needs the space that these leave."""
    n = np.zeros(capacity + 2, dtype=np.int64)
    n[list(counts)] = list(counts.values())
    return bound_of(n, capacity)


def bound_of(n: np.ndarray, capacity: int) -> int:
    """The bound of least_bins() for counts by size."""
    total = np.cumsum(n * np.arange(len(n)))
    n = np.cumsum(n)
    half = capacity // 2
    a = np.arange(half + 1)
    alone, big = n[-1] - n[capacity - a], n[capacity - a] - n[half]
    big_total = total[capacity - a] - total[half]
    rest = total[half] - np.where(a > 0, total[a - 1], 0)
    spread = np.maximum(0, -(-(rest - (big * capacity - big_total)) // capacity))
    return int(max(-(-int(total[-1]) // capacity), (alone + big + spread).max(initial=0)))


class Budget:
    """Search nodes that are left; without an end if none are named."""

    def __init__(self, nodes: int | None):
        self.left = nodes

    def spend(self) -> bool:
        """Take a node; whether there was one."""
        if self.left is None:
            return True
        self.left -= 1
        return self.left >= 0


def completions(space: int, counts: dict[int, int], sizes: list[int], waste: int, budget: Budget, few: int | None = None) -> list[tuple[int, dict[int, int]]]:
    """All undominated fillings of a space that waste no more, or the best of the first that are met, least waste first.

    ``sizes`` ascend. A filling is dominated where one unused document could
    replace a document of it, or be added, without exceeding the space; one
    document that fills the space exactly dominates all else.
    """
    if counts.get(space):
        return [(0, {space: 1})]
    found: list[tuple[int, dict[int, int]]] = []
    used: dict[int, int] = {}
    # (space left, place of the next size to try, whether one has fitted); what is used goes along with the stack
    stack: list[list[int]] = [[space, bisect_right(sizes, space), 0]]
    tries = FEW_NODES if few else None
    chosen: list[int] = []
    while stack:
        left, at, fits = stack[-1]
        at -= 1
        while at >= 0 and counts[sizes[at]] <= used.get(sizes[at], 0):
            at -= 1
        stack[-1][1] = at
        if tries is not None:
            tries -= 1
        if at >= 0 and (tries is None or tries > 0) and budget.spend():
            size = sizes[at]
            stack[-1][2] = 1
            used[size] = used.get(size, 0) + 1
            chosen.append(size)
            stack.append([left - size, min(at + 1, bisect_right(sizes, left - size)), 0])
            continue
        if not fits and left <= waste:
            for size in used:
                i = bisect_right(sizes, size + left) - 1
                while i >= 0 and sizes[i] > size and counts[sizes[i]] <= used.get(sizes[i], 0):
                    i -= 1
                if i >= 0 and sizes[i] > size:
                    break
            else:
                found.append((left, dict(used)))
        stack.pop()
        if chosen:
            size = chosen.pop()
            used[size] -= 1
            if not used[size]:
                del used[size]
    found.sort(key=lambda x: (x[0], -max(x[1], default=0)))
    return found[:few] if few else found


class Packing:
    """Fillings and their numbers, how many bins they are, the least that any solution has, and whether that was reached or proved."""

    def __init__(self, plan: list[tuple[dict[int, int], int]], bound: int, proved: bool):
        self.plan, self.bound, self.proved = plan, bound, proved
        self.bins = sum(n for _, n in plan)


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int | None = SEARCH_NODES) -> Packing:
    """Fillings and their numbers that together hold every counted size once.

    Best-fit decreasing gives the incumbent. Each step takes the largest size
    left, enumerates its undominated completions and uses each of them for as
    many bins as the counts allow, then for one bin only, so that every number
    of uses is reached. A first round takes few completions of each size for a
better incumbent, the second one all of them. A branch ends where its waste, or the lower bound of
    what is left, allows no solution better than the incumbent, or where the
    same sizes were left before after no more bins. The search is complete;
    after ``nodes`` nodes (None: never) it gives up with the best found so far
    and does not call it proved.
    """
    counts = {s: n for s, n in counts.items() if n}
    total = sum(s * n for s, n in counts.items())
    best, least = best_fit(counts, capacity), least_bins(counts, capacity)
    upper, proved = sum(n for _, n in best), False
    whole = np.zeros(capacity + 2, dtype=np.int64)
    whole[list(counts)] = list(counts.values())
    for few in (FEW, None):
        budget = Budget(None if nodes is None and not few else (SEARCH_NODES if nodes is None else nodes) // 2)
        seen: dict[bytes, int] = {}
        # what was left before a filling, the filling and its uses, the steps before it, bins and waste with it
        stack: list[tuple] = [(whole, (), 0, None, 0, 0)]
        while stack and upper > least and budget.spend():
            before, filling, times, way, bins, waste = stack.pop()
            left = before.copy()
            for size, c in filling:
                left[size] -= c * times
            steps = (way, filling, times) if times else None
            if not left.any():
                if bins < upper:
                    best, upper = steps_of(steps), bins
                continue
            spare = (upper - 1) * capacity - total - waste
            if spare < 0 or bins + bound_of(left, capacity) >= upper:
                continue
            state = hashlib.blake2b(left.tobytes(), digest_size=16).digest()
            if seen.get(state, bins + 1) <= bins:
                continue
            if len(seen) < SEEN_STATES:
                seen[state] = bins
            sizes = np.flatnonzero(left).tolist()
            top = sizes[-1]
            rest = dict(zip(sizes, left[sizes].tolist(), strict=True))
            rest[top] -= 1
            options = []
            for wasted, found in completions(capacity - top, rest, sizes, spare, budget, few):
                found[top] = found.get(top, 0) + 1
                most = min(int(left[s]) // c for s, c in found.items())
                pairs = tuple(found.items())
                options += [(left, pairs, t, steps, bins + t, waste + wasted * t) for t in ((most, 1) if most > 1 else (1,)) if wasted * t <= spare]
            stack.extend(reversed(options))
        proved = upper <= least or (not few and not stack and (budget.left is None or budget.left >= 0))
    return Packing(best, upper if proved else least, proved)


def steps_of(steps: tuple | None) -> list[tuple[dict[int, int], int]]:
    """The fillings of linked steps and their uses."""
    out = []
    while steps:
        steps, filling, times = steps
        out.append((dict(filling), times))
    return out[::-1]


def placement(plan: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """For each size, which ranks stand where: rows ordered by (size, low)."""
    rows, seen, base = [], {}, 0
    for filling, times in plan:
        offset = 0
        for size in sorted(filling, reverse=True):
            low = seen.get(size, 0)
            seen[size] = low + filling[size] * times
            rows.append((size, low, base, times, offset))
            offset += size * filling[size]
        base += times
    rows.sort()
    names = ("size", "low", "base", "times", "offset")
    return {k: np.array([r[i] for r in rows], dtype=np.int64) for i, k in enumerate(names)}


def assign(places: dict[str, np.ndarray], size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces that have these ranks in their sizes."""
    top = int(max(places["low"].max(initial=0), rank.max(initial=0))) + 1
    at = np.searchsorted(places["size"] * top + places["low"], size * top + rank, side="right") - 1
    slot, turn = np.divmod(rank - places["low"][at], places["times"][at])
    return places["base"][at] + turn, places["offset"][at] + slot * size


def solve(cut: DataFrame, capacity: int = CAPACITY, nodes: int | None = SEARCH_NODES) -> Packing:
    """The packing of written pieces; its bins, bound and proof tell how good it is."""
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    return bin_completion(counts, capacity, nodes)


def pack(docs: DataFrame, json_path: str, ranks_path: str | None = None, capacity: int = CAPACITY, nodes: int | None = SEARCH_NODES) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    Only the histogram of sizes, at most ``capacity`` rows, comes to the
    driver, and only the plan, as bounded, goes back.
    """
    cut = materialise(pieces(docs, json_path, ranks_path, capacity), "pieces")
    return placed(cut, solve(cut, capacity, nodes).plan)


def placed(cut: DataFrame, plan: list[tuple[dict[int, int], int]]) -> DataFrame:
    """Written pieces with their places in a plan."""
    places = placement(plan)
    counts = cut.count()
    parts = max(1, counts // RANK_ROWS)
    keyed = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    before = (
        keyed.groupBy("part", "length")
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
        .select("part", "length", F.coalesce("before", F.lit(0)).alias("before"))
    )
    ranked = keyed.withColumn("nth", F.row_number().over(Window.partitionBy("part", "length").orderBy("doc_id", "piece"))).join(before, ["part", "length"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth") - 1).alias("nth"))

    def run(batches):
        for batch in batches:
            size, nth = (batch.column(i).to_numpy() for i in (3, 5))
            sequence, offset = assign(places, size, nth)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(run, PIECES + ", sequence_id long, offset long")
