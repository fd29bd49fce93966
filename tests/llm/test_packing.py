import random
import zlib

import numpy as np
import pytest

from stepledger.llm import packing

PATHS = packing.vocabulary()


def bins_of(plan):
    return sum(n for _, n in plan)


def held(plan):
    out = {}
    for filling, times in plan:
        for size, c in filling.items():
            out[size] = out.get(size, 0) + c * times
    return out


def optimum(sizes, capacity):
    """Fewest bins by exhaustive search."""
    sizes = sorted(sizes, reverse=True)
    best = [len(sizes)]

    def put(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity and bins[k] not in bins[:k]:
                put(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1 :]])
        put(i + 1, [*bins, sizes[i]])

    put(0, [])
    return best[0]


def test_bin_completion_matches_exhaustive_search():
    rng = random.Random(5)
    for _ in range(60):
        capacity = rng.choice([10, 20, 31])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        counts = {s: sizes.count(s) for s in sizes}
        found = packing.bin_completion(counts, capacity)
        plan = found.plan
        assert found.proved and found.bins == found.bound == bins_of(plan)
        assert held(plan) == counts
        assert all(sum(s * c for s, c in f.items()) <= capacity for f, _ in plan)
        assert bins_of(plan) == optimum(sizes, capacity), (capacity, sizes)


def test_search_beats_best_fit_at_the_production_capacity_and_proves_it():
    rng = random.Random(0)
    better = 0
    for _ in range(25):
        cuts = [sorted(rng.sample(range(300, 1750), 2)) for _ in range(4)]  # four full sequences in three pieces each
        sizes = [n for a, b in cuts for n in (a, b - a, packing.CAPACITY - b)]
        counts = {s: sizes.count(s) for s in sizes}
        found = packing.bin_completion(counts, packing.CAPACITY, None)
        best = 4
        assert found.proved and found.bins == found.bound == best and held(found.plan) == counts
        better += best < bins_of(packing.best_fit(counts, packing.CAPACITY))
    assert better >= 2


def test_sizes_that_are_used_fewer_times_than_they_could_be():
    """The optimum needs a filling less often than the counts allow."""
    rng = random.Random(3)
    better = 0
    for _ in range(150):
        capacity = rng.choice([17, 23, 30])
        sizes = [s for s in rng.sample(range(3, capacity // 2 + 2), 4) for _ in range(rng.randint(2, 3))][:10]
        counts = {s: sizes.count(s) for s in sizes}
        found = packing.bin_completion(counts, capacity, None)
        assert found.proved and found.bins == optimum(sizes, capacity)
        better += found.bins < bins_of(packing.best_fit(counts, capacity))
    assert better


def test_a_search_that_ends_early_says_so():
    rng = random.Random(1)
    sizes = [rng.randint(300, 1000) for _ in range(300)]
    counts = {s: sizes.count(s) for s in sizes}
    short, longer = (packing.bin_completion(counts, packing.CAPACITY, n) for n in (0, 200_000))
    assert not short.proved and short.bins == bins_of(packing.best_fit(counts, packing.CAPACITY)) > short.bound
    assert longer.bins < short.bins and held(longer.plan) == counts and longer.bound <= longer.bins


def test_best_fit_holds_everything():
    counts = {7: 5, 3: 11, 2: 1, 10: 4, 1: 3}
    plan = packing.best_fit(counts, 10)
    assert held(plan) == counts
    assert all(sum(s * c for s, c in f.items()) <= 10 for f, _ in plan)


def test_ranks_and_library_give_the_same_ids():
    both, alone = packing.encoder(*PATHS), packing.encoder(PATHS[0], None)
    for text in ["", " ", "Élan vital's  \n\n x", "<|endoftext|> a", "日本 русский", "a" * 5000, "\t   12345 ½ ²", "été “q” — don't WE'LL", "á ‍", "\x00\x01 \x85 x"]:
        assert both(text) == alone(text), text


@pytest.fixture(scope="module")
def packed(spark):
    rng = random.Random(1)
    texts = {i: " ".join(rng.choice(["alpha", "be", "gamma,", "d"]) for _ in range(rng.randint(0, 60))) for i in range(40)}
    texts |= {100: None, 101: "", 102: "word " * 500, 103: " " * 10}
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in texts.items()] + [(7, texts[7], 1, "x"), (None, "no id", 1, "x")], "doc_id long, text string, piece int, `offset` string")
    return texts, packing.pack(docs, *PATHS, capacity=64).toPandas()


def test_every_token_is_packed_once_and_gapless(packed):
    texts, out = packed
    assert len(out[out.doc_id == 7].query("piece == 0")) == 2
    assert out.doc_id.isna().sum() == 1
    encode = packing.encoder(PATHS[0], None)
    for doc_id, text in texts.items():
        if doc_id == 7:
            continue
        ids = np.array([*encode(text or ""), 0], dtype="<u4")
        got = out[out.doc_id == doc_id].sort_values("piece")
        assert list(got.piece) == list(range(len(got)))
        assert list(got.start) == [0, *got.length.cumsum()[:-1]]
        assert got.length.sum() == len(ids)
        assert (got.length[1:] == 64).all() and len(got) == -(-len(ids) // 64)
        assert list(got.ids_crc32) == [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(got.start, got.length)]
    for _, group in out.sort_values("offset").groupby("sequence_id"):
        assert list(group.offset) == [0, *group.length.cumsum()[:-1]]
        assert group.length.sum() <= 64
    assert out.sequence_id.nunique() <= -(-out.length.sum() // 64) + 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs, *PATHS).count() == 0
