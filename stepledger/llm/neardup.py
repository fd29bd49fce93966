"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints of all documents are made distinct and dealt out by the
pigeonhole principle: of ``b`` blocks of bits two fingerprints that differ in
at most ``d`` bits share ``b - d`` whole ones, so every link is inside a group
of fingerprints with equal shared blocks. In each task the groups are sorted
by Gray rank and indexed: an upper node holds the bits that all fingerprints
below it share, each bit at the highest node that has it. A search adds up
the differences down the tree and leaves a whole subtree once they exceed the
distance. Links are reduced to a spanning forest where they are found, so
their number never exceeds that of the fingerprints dealt out; components then
follow from rounds of contraction over forest edges, written to the shared
folder after each round.

Defined results: a null text is an empty one, its fingerprint is zero, which
links like any other; a null doc_id gets a fingerprint and the component's
smallest doc_id; rows that repeat a doc_id are kept one by one; an empty table
gives an empty result; columns other than doc_id and text are not read.

``keep_similar`` is for pipelines: documents link if their sets of five-word
shingles have a similarity of 0.8 or more. Of a total order of shingles such
sets share one of their first fifth, so fingerprints of the sets are dealt out
by these shingles and each group is searched with the same index in a radius
that leaves out about one such link in 100,000 at worst (where fingerprint
bits are independent). The order is by hash, with frequent shingles last; any
order finds the same links. How many leading shingles two sets share bounds
their similarity, and what that leaves is compared exactly. In large groups
all are compared with the group's middle first; pairs that this links already
are not compared, so a group of n near copies costs n pairs and not n squared.
"""

from __future__ import annotations

from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepledger.llm._shared import discard, hash_share, materialise, slices, unused

BITS, DISTANCE, SHINGLE = 64, 3, 3
#: Words of a pipeline's shingles, least similarity of their sets (a fraction), and bits in which linked ones may differ.
WORDS, SIMILAR, RADIUS = 5, (4, 5), 26
#: Documents in which frequent shingles are looked for, how many have one, and how many are taken at most.
SEEN_DOCS, SEEN_IN, FREQUENT = 8_000, 8, 50_000
#: Children of an index node, and candidates that a search holds at once.
FANOUT, FRONTIER = 16, 1 << 20
#: Fingerprints of one group, on average over a random table, and rows of one task.
GROUP_ROWS, TASK_ROWS = 256, 1_000_000
#: Sets with one leading shingle from which on their middle is compared first.
STAR = 64
#: Fingerprints of one group at most; larger groups are dealt out by more bits.
GROUP_MOST = 1 << 16
#: Shingles hashed at once.
CHUNK = 1 << 16


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's word shingles, unsigned."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    last = ends[size - 1 :] or ends[-1:]
    counts, n = np.zeros(BITS, dtype=np.int64), len(last)
    for at in range(0, n, CHUNK):
        parts = [joined[a : b - 1] for a, b in zip(starts[at : at + CHUNK], last[at : at + CHUNK])]
        digests = b"".join(map(xxhash.xxh64_digest, parts, repeat(42)))
        bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every document."""

    def run(batches):
        for batch in slices(batches):
            found = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def block_masks(n: int, distance: int = DISTANCE) -> list[int]:
    """For each choice of distance + x blocks to share, the bits of these; fewest blocks whose groups stay small.

    Every such family finds all links; the number of fingerprints only decides
    how finely they are dealt out.
    """
    blocks = distance + 1
    while blocks < 2 * distance + 2 and n / 2 ** (BITS * (blocks - distance) // blocks) > GROUP_ROWS:
        blocks += 1
    cuts = [BITS * k // blocks for k in range(blocks + 1)]
    bits = [sum(1 << i for i in range(a, b)) for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(bits, blocks - distance)]


class GrayIndex:
    """A forest over fingerprints that are sorted by (group, Gray rank), a tree for each group."""

    def __init__(self, codes: np.ndarray, group: np.ndarray):
        everything = np.uint64(2**BITS - 1)
        self.codes, self.levels = codes, []
        pattern, mask, own = codes, np.full(len(codes), everything), group
        while True:
            new = np.r_[True, own[1:] != own[:-1]]
            first = np.flatnonzero(new)
            place = np.arange(len(own)) - np.repeat(first, np.diff(np.r_[first, len(own)]))
            starts = np.flatnonzero(place % FANOUT == 0)
            parent = np.cumsum(place % FANOUT == 0) - 1
            differs = (pattern ^ pattern[starts][parent]) | ~mask
            shared = ~np.bitwise_or.reduceat(differs, starts)
            up = pattern[starts] & shared
            # a node keeps the bits that its parent does not have
            self.levels.append((pattern, mask & ~shared[parent], np.r_[starts, len(own)]))
            if len(starts) == len(first):
                self.levels.append((up, shared, None))
                break
            pattern, mask, own = up, shared, own[starts]
        self.root = np.repeat(np.arange(len(first)), np.diff(np.r_[np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), len(group)]))
        leaf_last = np.arange(len(codes))
        self.last = [leaf_last]  # the last leaf below each node
        for _, _, starts in self.levels[:-1]:
            self.last.append(self.last[-1][starts[1:] - 1])

    def links(self, distance: int = DISTANCE, ask: np.ndarray | None = None):
        """Pairs (i, j), i < j, of leaves of one tree within the distance, some at a time; with ``ask`` those that have one of these leaves."""
        top = len(self.levels) - 1
        queries = np.arange(len(self.codes)) if ask is None else np.flatnonzero(ask)
        stack = [(top, queries[a : a + FRONTIER // 16], self.root[queries[a : a + FRONTIER // 16]], None) for a in range(0, len(queries), FRONTIER // 16)]
        while stack:
            level, q, node, so_far = stack.pop()
            pattern, mask, _ = self.levels[level]
            differ = np.bitwise_count((self.codes[q] ^ pattern[node]) & mask[node]).astype(np.int16)
            if so_far is not None:
                differ += so_far
            good = differ <= distance
            if ask is None:
                good &= self.last[level][node] > q
            q, node, differ = q[good], node[good], differ[good]
            if not len(q):
                continue
            if level == 0:
                if ask is not None:  # of two that are asked for the smaller one counts
                    once = (node != q) & (~ask[node] | (node > q))
                    q, node = np.minimum(q, node)[once], np.maximum(q, node)[once]
                yield q, node
                continue
            starts = self.levels[level - 1][2]
            size = starts[node + 1] - starts[node]
            for a in range(0, len(q), FRONTIER // FANOUT):
                part = slice(a, a + FRONTIER // FANOUT)
                n = size[part]
                ends = np.cumsum(n)
                child = np.arange(ends[-1]) - np.repeat(ends - n, n) + np.repeat(starts[node[part]], n)
                stack.append((level - 1, np.repeat(q[part], n), child, np.repeat(differ[part], n)))


def forest(n: int, pairs) -> np.ndarray:
    """The smallest index that each of n leaves is linked with."""
    label = np.arange(n)
    for a, b in pairs:
        while True:
            x, y = label[a], label[b]
            open_ = x != y
            if not open_.any():
                break
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (jump := label[label]).tobytes() != label.tobytes():
                label = jump
    return label


def group_edges(group: np.ndarray, codes: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links inside groups: (fingerprint, its root)."""
    order = np.lexsort((gray_rank(codes), group))
    group, codes = group[order], codes[order]
    label = forest(len(codes), GrayIndex(codes, group).links(distance))
    child = np.flatnonzero(label != np.arange(len(label)))
    return codes[child], codes[label[child]]


def finer(mask: int, distance: int = DISTANCE) -> list[int]:
    """This mask with one of distance + 1 blocks of its free bits each: of two fingerprints that agree in it one of these blocks is equal."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    cuts = [len(free) * k // (distance + 1) for k in range(distance + 2)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def signed(mask: int) -> int:
    return mask - 2**BITS if mask >= 2 ** (BITS - 1) else mask


def dealt(distinct: DataFrame, n: int, distance: int = DISTANCE, most: int = GROUP_MOST) -> tuple[DataFrame, list[int]]:
    """fp, i (its mask's place) and bits of every group that a fingerprint is in; the masks.

    A group of more than ``most`` fingerprints is dealt out again by blocks of
    its free bits, until groups are small or have too few free bits to be large.
    """
    masks = block_masks(n, distance)
    keys = F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("bits")) for i, m in enumerate(masks)])
    rows = distinct.select("fp", F.explode(keys).alias("k")).select("fp", "k.i", "k.bits")
    done, new = [], range(len(masks))
    while new := [i for i in new if 2 ** (BITS - masks[i].bit_count()) > most]:
        large = rows.where(F.col("i").isin(list(new))).groupBy("i", "bits").agg(F.count("*").alias("size")).where(F.col("size") > most).select("i", "bits")
        large = materialise(large, "large")
        held = sorted(r["i"] for r in large.select("i").distinct().collect())
        if not held:
            discard(large)
            break
        done.append(rows.join(large, ["i", "bits"], "left_anti").select("fp", "i", "bits"))
        steps = []
        for i in held:
            for m in finer(masks[i], distance):
                steps.append((i, len(masks), m))
                masks.append(m)
        choice = F.filter(F.array(*[F.struct(F.lit(of).alias("of"), F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("bits")) for of, i, m in steps]), lambda x: x["of"] == F.col("i"))
        rows = rows.join(large, ["i", "bits"], "left_semi").select("fp", F.explode(choice).alias("k")).select("fp", "k.i", "k.bits")
        new = [i for _, i, _ in steps]
    for more in done:
        rows = rows.unionByName(more)
    return rows, masks


def edges(distinct: DataFrame, n: int, distance: int = DISTANCE, most: int = GROUP_MOST) -> DataFrame:
    """Forest edges u, v between fingerprints (signed) within the distance."""
    rows, masks = dealt(distinct, n, distance, most)
    tasks = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), n * len(masks) // TASK_ROWS)

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        codes = table.column("fp").to_numpy().view(np.uint64)
        which = table.column("i").to_numpy()
        same = codes & np.array(masks, dtype=np.uint64)[which]
        order = np.lexsort((same, which))
        new = np.r_[True, (np.diff(which[order]) != 0) | (same[order][1:] != same[order][:-1])]
        group = np.empty(len(codes), dtype=np.int64)
        group[order] = np.cumsum(new)
        u, v = group_edges(group, codes, distance)
        yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return rows.repartition(tasks, "i", "bits").mapInArrow(run, "u long, v long").distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """node and label (the smallest node of its component) of every node of u-v edges.

    Each round hooks every node to its smallest smaller neighbour, follows the
    hooks to their roots by doubling and contracts the edges. Only local minima
    stay, at most half of the nodes, so rounds and doublings grow with the
    logarithm of the largest component.
    """
    links = materialise(links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v").distinct(), name)
    both = links.select(F.col("u").alias("node")).union(links.select("v")).distinct()
    labels = materialise(both.select("node", F.col("node").alias("label")), name)
    while not links.isEmpty():
        hook = links.groupBy(F.col("v").alias("root")).agg(F.min("u").alias("to"), F.lit(True).alias("moved"))
        hook = materialise(hook, name)
        while not hook.where("moved").isEmpty():
            onward = hook.select(F.col("root").alias("to"), F.col("to").alias("next"))
            before, hook = hook, materialise(hook.join(onward, "to", "left").select("root", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), name)
            discard(before)
        before, labels = labels, materialise(labels.join(hook, labels["label"] == hook["root"], "left").select("node", F.coalesce("to", "label").alias("label")), name)
        discard(before)
        ends = hook.select(F.col("root").alias("u"), F.col("to").alias("u_to"))
        old, links = links, links.join(ends, "u", "left").select(F.coalesce("u_to", "u").alias("u"), "v")
        ends = hook.select(F.col("root").alias("v"), F.col("to").alias("v_to"))
        links = links.join(ends, "v", "left").select("u", F.coalesce("v_to", "v").alias("v"))
        links = materialise(links.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), name)
        discard(old, hook)
    discard(links)
    return labels


def near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    marks = materialise(fingerprints(docs), "fingerprints")
    distinct = materialise(marks.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    labels = components(edges(distinct, distinct.count(), distance), "simhash")
    of = distinct.join(labels, distinct["fp"] == labels["node"], "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    smallest = of.groupBy("label").agg(F.min("first").alias("component_id"))
    named = of.join(smallest, "label").select("fp", "component_id")
    return marks.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """The distinct word shingles of a text by their hashes, sorted; all words are one where they are fewer."""
    words = (text or "").encode().lower().split()
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    last = ends[size - 1 :] or ends[-1:]
    digests = b"".join(xxhash.xxh64_digest(joined[a : b - 1], 42) for a, b in zip([0, *ends], last))
    return np.unique(np.frombuffer(digests, dtype=">u8").astype(np.uint64))


def set_fingerprint(found: np.ndarray) -> int:
    """The 64-bit SimHash of a set of shingles, unsigned."""
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(found), CHUNK):
        counts += np.unpackbits(found[at : at + CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > len(found)).tobytes(), "big")


def leading(found: np.ndarray, late: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The shingles of which every similar set has one: the first fifth, the late ones (sorted, with places) coming last."""
    low, high = SIMILAR
    n = len(found) - -(-low * len(found) // high) + 1 if len(found) else 0
    if n and len(late):
        at = np.minimum(np.searchsorted(late, found), len(late) - 1)
        found = found[np.argsort(np.where(late[at] == found, place[at], -1), kind="stable")]
    return found[:n]


def frequent(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many documents have, by a hash share of them, sorted; and their places by frequency."""
    some = docs.where(hash_share(F.col("doc_id"), SEEN_DOCS, docs.count())).dropDuplicates(["text"])
    counts = shingle_sets(some, whole=True).select(F.explode("held").alias("h")).groupBy("h").count().where(F.col("count") >= SEEN_IN)
    rows = counts.orderBy(F.desc("count"), "h").limit(FREQUENT).collect()
    found = np.array([r["h"] for r in rows], dtype=np.int64).view(np.uint64)
    order = np.argsort(found)
    return found[order], (len(rows) - order).astype(np.int64)


def shingle_sets(docs: DataFrame, whole: bool = False, late: tuple[np.ndarray, np.ndarray] | None = None, digest: str | None = None) -> DataFrame:
    """doc_id, digest, key of the set, fingerprint, size n and shingles of every document: all or the leading ones."""
    late = late or (np.empty(0, np.uint64), np.empty(0, np.int64))

    def run(batches):
        for part in slices(batches, 64):
            sets = [shingles(t) for t in part.column(1).to_pylist()]
            n = [len(s) for s in sets]
            keys = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], dtype=np.uint64)
            marks = np.array([set_fingerprint(s) for s in sets], dtype=np.uint64)
            held = sets if whole else [leading(s, *late) for s in sets]
            offsets = np.cumsum([0, *map(len, held)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(held).view(np.int64)))
            columns = [part.column(0), part.column(2), pa.array(keys.view(np.int64)), pa.array(marks.view(np.int64)), pa.array(n, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "digest", "key", "fp", "n", "held"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col(digest) if digest else F.lit(""))
    return rows.mapInArrow(run, "doc_id long, digest string, key long, fp long, n long, held array<long>")


def close_enough(codes: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether fingerprints and sizes of sets allow them to be similar."""
    low, high = SIMILAR
    return (np.bitwise_count(codes[i] ^ codes[j]) <= RADIUS) & (high * n[i] >= low * n[j]) & (high * n[j] >= low * n[i])


def grouped_rows(batches, columns: tuple[str, ...]) -> list[np.ndarray] | None:
    """The rows of shingles that several sets have, by shingle and Gray rank: these columns, codes and groups from 0."""
    kept = [b for b in batches if b.num_rows]
    if not kept:
        return None
    table = pa.Table.from_batches(kept)
    codes = table.column("fp").to_numpy().view(np.uint64)
    _, group, size = np.unique(table.column("h").to_numpy(), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(size[group] > 1)
    order = shared[np.lexsort((gray_rank(codes[shared]), group[shared]))]
    if not len(order):
        return None
    return [*[table.column(c).to_numpy()[order] for c in columns], codes[order], np.unique(group[order], return_inverse=True)[1]]


def spread(distinct: DataFrame) -> DataFrame:
    """A row for each leading shingle of each set, dealt out by shingle."""
    rows = distinct.agg(F.sum(F.size("held"))).first()[0] or 0
    tasks = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // TASK_ROWS)
    return distinct.select(*[c for c in distinct.columns if c not in ("held", "first")], F.explode("held").alias("h")).repartition(tasks, "h")


def stars(distinct: DataFrame) -> DataFrame:
    """Pairs a, b of keys: in each large group its middle, the fingerprint next to the majority of bits, with all others that may be similar."""

    def run(batches):
        got = grouped_rows(batches, ("key", "n"))
        if got is None:
            return
        key, n, codes, group = got
        starts = np.flatnonzero(np.r_[True, np.diff(group) > 0])
        size = np.diff(np.r_[starts, len(group)])
        for start, many in zip(starts[size > STAR], size[size > STAR], strict=True):
            own = np.arange(start, start + many)
            bits = np.zeros(BITS, dtype=np.int64)
            for at in range(0, many, CHUNK):
                bits += np.unpackbits(codes[own[at : at + CHUNK]].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            centre = np.uint64(int.from_bytes(np.packbits(2 * bits > many).tobytes(), "big"))
            middle = own[np.lexsort((key[own], np.bitwise_count(codes[own] ^ centre)))[0]]
            near = own[close_enough(codes, n, own, np.full(many, middle)) & (own != middle)]
            columns = [np.minimum(key[near], key[middle]), np.maximum(key[near], key[middle])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b"])

    return spread(distinct).mapInArrow(run, "a long, b long").distinct()


def candidates(distinct: DataFrame) -> DataFrame:
    """Pairs a, b of keys with other labels that share enough leading shingles, differ in few bits and are of similar size.

    Of two sets the one whose leading shingles end first has all that it
    shares in the other's, so at most its remaining ones are shared besides.
    Sets with one label are linked already. In each group only those outside
    its most frequent label search, so a group of copies costs no pairs.
    """
    low, high = SIMILAR

    def run(batches):
        got = grouped_rows(batches, ("key", "n", "label"))
        if got is None:
            return
        key, n, label, codes, group = got
        order = np.lexsort((label, group))
        first = np.flatnonzero(np.r_[True, (np.diff(group[order]) > 0) | (np.diff(label[order]) != 0)])
        size = np.diff(np.r_[first, len(order)])
        most = np.zeros(group[-1] + 1, dtype=np.int64)
        rank = np.lexsort((size, group[order[first]]))
        most[group[order[first]][rank]] = label[order[first]][rank]  # the largest of a group comes last
        for i, j in GrayIndex(codes, group).links(RADIUS, label != most[group]):
            near = (label[i] != label[j]) & close_enough(codes, n, i, j)
            i, j = i[near], j[near]
            # the shared leading shingles that a similar pair has at least
            rest = np.maximum(low * n[i] + high - 1, low * n[j] + high - 1) // high - 1
            need = -(-low * (n[i] + n[j]) // (low + high)) - rest
            columns = [np.minimum(key[i], key[j]), np.maximum(key[i], key[j]), need]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "need"])

    found = spread(distinct).mapInArrow(run, "a long, b long, need long").groupBy("a", "b")
    return found.agg(F.count("*").alias("n"), F.first("need").alias("need")).where("n >= need").select("a", "b")


def similar_edges(docs: DataFrame, distinct: DataFrame, digest: str, pairs: DataFrame) -> DataFrame:
    """The pairs u, v of keys whose shingle sets are similar enough, compared whole."""
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    first = distinct.join(keys, "key", "left_semi").select(F.col("first.doc_id").alias("doc_id"), F.col("first.digest").alias("of"))
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(digest).alias("of")).join(first, ["doc_id", "of"], "left_semi")
    sets = shingle_sets(some, whole=True)
    sets = materialise(sets.join(keys, "key", "left_semi").groupBy("key").agg(F.first("held").alias("held")), "sets")
    left = sets.select(F.col("key").alias("a"), F.col("held").alias("s"))
    right = sets.select(F.col("key").alias("b"), F.col("held").alias("t"))
    both = F.size(F.array_intersect("s", "t"))
    low, high = SIMILAR
    found = pairs.join(left, "a").join(right, "b").where(high * both >= low * (F.size("s") + F.size("t") - both))
    out = materialise(found.select(F.col("a").alias("u"), F.col("b").alias("v")), "similar")
    discard(sets)
    return out


def linked(docs: DataFrame, distinct: DataFrame, digest: str) -> DataFrame:
    """Edges u, v that connect all keys of similar sets: those to the middles of large groups, then those between what these leave apart."""
    middles = materialise(stars(distinct), "stars")
    own = F.col("key")
    if middles.isEmpty():
        found, labelled = None, distinct.withColumn("label", own)
    else:
        found = similar_edges(docs, distinct, digest, middles)
        label = components(found, "stars").select(F.col("node").alias("key"), "label")
        labelled = materialise(distinct.join(label, "key", "left").withColumn("label", F.coalesce("label", own)), "labelled")
    pairs = materialise(candidates(labelled), "candidates")
    more = similar_edges(docs, distinct, digest, pairs)
    return more if found is None else found.unionByName(more)


def keep_similar(docs: DataFrame) -> DataFrame:
    """Of each component of similar documents the one with the smallest doc_id, with all its columns.

    Documents without words are one component. Rows that repeat a doc_id and
    its text are one document, rows that repeat a doc_id with another text are
    documents of their own; a row without doc_id stays and links no others.
    """
    digest = unused(docs, "digest")[0]
    rows = docs.withColumn(digest, F.coalesce(F.md5(F.col("text").cast("string")), F.lit("")))
    named = rows.where(F.col("doc_id").isNotNull())
    marks = shingle_sets(named, late=frequent(named), digest=digest)
    firsts = F.min(F.struct("doc_id", "digest")).alias("first")
    distinct = materialise(marks.groupBy("key").agg(firsts, F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("held").alias("held")), "distinct")
    labels = components(linked(named, distinct, digest), "similar")
    of = distinct.join(labels, distinct["key"] == labels["node"], "left").select("first", F.coalesce("label", "key").alias("label"))
    kept = of.groupBy("label").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("_kept"), F.col("first.digest").alias("_digest"))
    found = named.join(kept, (named["doc_id"].cast("long") == kept["_kept"]) & (named[digest] == kept["_digest"]), "left_semi")
    # of rows with one doc_id and text the first by their other columns
    order = F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in docs.columns if c != "text"])))
    place = unused(found, "place")[0]
    single = found.withColumn(place, F.row_number().over(Window.partitionBy("doc_id", digest).orderBy(order))).where(F.col(place) == 1).drop(place, digest)
    return single.unionByName(docs.where(F.col("doc_id").isNull()))
