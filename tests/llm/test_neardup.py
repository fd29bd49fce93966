import random

import numpy as np
import pytest
import xxhash

from stepledger.llm import neardup


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(codes, distance=3):
    label = list(range(len(codes)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= distance:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(codes))]


def test_fingerprint_matches_the_definition():
    for text in [None, "", "  \n", "One", "one TWO", "a b c", "Ä b c d a b c d É", "x y z \x0b\x0c q", "w " * 500, "tie tie tie tie"]:
        assert neardup.fingerprint(text) == plain_fingerprint(text), text


def test_gray_rank_inverts_the_code():
    x = np.arange(1000, dtype=np.uint64)
    assert (neardup.gray_rank(x ^ (x >> np.uint64(1))) == x).all()


@pytest.mark.parametrize("n", [0, 10**6, 10**8, 10**11])
def test_every_link_shares_a_mask(n):
    rng, masks = random.Random(n), neardup.block_masks(n)
    for _ in range(3000):
        flips = sum(1 << i for i in rng.sample(range(64), 3))
        assert any(flips & m == 0 for m in masks)


def crowd(rng, n):
    """Fingerprints of which many are near each other."""
    base = [rng.getrandbits(64) for _ in range(max(1, n // 12))]
    return sorted({b ^ sum(1 << i for i in rng.sample(range(64), rng.choice([0, 1, 2, 3, 4, 6]))) for b in base for _ in range(12)})


def test_index_finds_all_links_of_a_group():
    rng = random.Random(3)
    for n in (1, 5, 60, 600):
        codes = crowd(rng, n)
        group = np.array([rng.choice([1, 1, 1, 2]) for _ in codes])
        arr = np.array(codes, dtype=np.uint64)
        order = np.lexsort((neardup.gray_rank(arr), group))
        arr, group = arr[order], group[order]
        found = {(int(a), int(b)) for x, y in neardup.GrayIndex(arr, group).links() for a, b in zip(x, y)}
        want = {(i, j) for i in range(len(arr)) for j in range(i + 1, len(arr)) if group[i] == group[j] and int(arr[i] ^ arr[j]).bit_count() <= 3}
        assert found == want


def test_components_of_fingerprints(spark):
    codes = crowd(random.Random(9), 400)
    frame = spark.createDataFrame([(c - 2**64 if c >> 63 else c,) for c in codes], "fp long")
    rows = neardup.components(neardup.edges(frame, len(codes))).collect()
    label = {r["node"] % 2**64: r["label"] for r in rows}
    want = plain_components(codes)
    groups = {}
    for c, w in zip(codes, want):
        groups.setdefault(w, set()).add(label.get(c, ("alone", c)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_long_chain(spark):
    frame = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "u long, v long")
    assert {(r["node"], r["label"]) for r in neardup.components(frame).collect()} == {(i, 0) for i in range(301)} | {(1000, 1000), (1001, 1000)}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(400)) for _ in range(20)]
    rows = [(10 + i, texts[i % 20] + (" extra" if i >= 40 else "")) for i in range(60)]
    rows += [(1, None), (2, ""), (3, " \n"), (4, "two words"), (5, "TWO words"), (None, texts[0]), (11, texts[1])]
    return spark.createDataFrame([(i, t, "c", 7) for i, t in rows], "doc_id long, text string, label string, fp int")


def test_near_duplicates_match_brute_force(docs):
    rows = docs.collect()
    codes = [plain_fingerprint(r["text"]) for r in rows]
    label = plain_components(codes)
    smallest = {}
    for r, k in zip(rows, label):
        if r["doc_id"] is not None:
            smallest[k] = min(smallest.get(k, r["doc_id"]), r["doc_id"])
    want = sorted((str(r["doc_id"]), f"{c:016x}", smallest[k]) for r, c, k in zip(rows, codes, label))
    got = sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in neardup.near_duplicates(docs).collect())
    assert got == want


@pytest.mark.parametrize("most", [1 << 16, 40])
def test_hot_groups_are_dealt_out_and_lose_no_link(spark, most):
    """Fingerprints within a few bits of each other, far more than a group may have."""
    rng = random.Random(6)
    centre = rng.getrandbits(64)
    codes = {centre}
    while len(codes) < 900:
        code = centre
        for bit in rng.sample(range(64), rng.randint(1, 9)):
            code ^= 1 << bit
        codes.add(code)
    codes = sorted(codes)
    frame = spark.createDataFrame([(c - 2**64 if c >= 2**63 else c,) for c in codes], "fp long")
    rows, masks = neardup.dealt(frame, len(codes), most=most)
    sizes = {}
    for r in rows.collect():
        assert (r["fp"] & neardup.signed(masks[r["i"]])) == r["bits"]
        sizes[r["i"], r["bits"]] = sizes.get((r["i"], r["bits"]), 0) + 1
    assert most > 40 or max(n for (i, _), n in sizes.items() if 64 - masks[i].bit_count() > 16) <= max(most, 200)
    label = dict(zip(codes, plain_components(codes)))
    want = {}
    for c, k in label.items():
        want.setdefault(k, set()).add(c)
    found = {c: {c} for c in codes}
    for r in neardup.edges(frame, len(codes), most=most).collect():
        a, b = r["u"] % 2**64, r["v"] % 2**64
        both = found[a] | found[b]
        for c in both:
            found[c] = both
    assert {frozenset(x) for x in want.values()} == {frozenset(x) for x in found.values()}


def test_texts_under_one_id_are_documents_of_their_own(spark):
    rows = [(1, "one two three four five six seven", "b"), (1, "quite another text without any likeness to it", "c"), (1, "one two three four five six seven", "a"), (2, "one two three four five six seven", "d"), (None, "one two three four five six seven", "e")]
    kept = neardup.keep_similar(spark.createDataFrame(rows, "doc_id long, text string, place string"))
    got = sorted((str(r["doc_id"]), r["text"]) for r in kept.collect())
    assert kept.columns == ["doc_id", "text", "place"]
    assert got == [("1", rows[0][1]), ("1", rows[1][1]), ("None", rows[0][1])]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(none).count() == 0
