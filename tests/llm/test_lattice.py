import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from stepledger.llm import lattice

PATH = lattice.vocabulary()


def segmentations(text, pieces, spelled):
    """Probabilities of all segmentations, one by one."""
    if not text:
        return [1.0]
    out = []
    for j in range(1, len(text) + 1):
        p = pieces.get(text[:j])
        for edge in ([math.exp(p)] if p is not None else []) + ([math.exp(spelled(text[0]))] if j == 1 else []):
            out += [edge * x for x in segmentations(text[j:], pieces, spelled)]
    return out


@pytest.fixture(scope="module")
def model():
    counts = np.random.default_rng(1).integers(0, 50, 32000).astype(float)
    return lattice.Lattice(PATH, counts, 20)


def test_marginal_is_the_sum_over_all_segmentations(model):
    def spelled(ch):
        return model.bytes[list(ch.encode())].sum()

    for word in ["a", "the", "hello", "été", "𝛼x", "zzqj", "日本"]:
        want = math.log(sum(segmentations("▁" + word, model.pieces, spelled)))
        assert model.alone(word) == pytest.approx(want, abs=1e-9)


def test_blocks_equal_single_words(model):
    rng = random.Random(6)
    words = ["".join(rng.choice("abetionéß日\x80") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    got = model.log_probabilities(words)
    assert np.allclose(got, [model.alone(w) for w in words], atol=1e-9)


def test_packed_indices():
    for ids in ([], [0], [5, 3, 3, 9], [0, 70000, 70000, 1]):
        raw = lattice.pack_ids(np.array(ids, dtype=np.int64))
        assert list(lattice.unpack_ids(raw, len(ids))) == sorted(ids)


def rows_of(spark):
    rng = random.Random(8)
    words = ["the", "THE", "river", "stone", "été", "Ä", "x" * 70] + [f"w{i}" for i in range(40)]
    rows = [(i, " \n".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    rows += [(70, None), (71, ""), (3, "the the"), (None, "lonely the")]
    return rows


def test_scores_match_the_definitions(spark, monkeypatch):
    monkeypatch.setattr(lattice, "CHUNK_ROWS", 7)
    rows = rows_of(spark)
    docs = spark.createDataFrame([(i, t, 1, "w") for i, t in rows], "doc_id long, text string, n int, word string")
    got = lattice.score(docs, PATH).collect()
    assert len(got) == len(rows)

    def lower(s):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")

    split = [(i, lower(t).split(), i is not None and zlib.crc32(str(i).encode()) % 5 == 1) for i, t in rows]
    counts = Counter(w for _, ws, held in split if not held for w in ws)
    ends = sum(not held for _, _, held in split)
    n, v = sum(counts.values()) + ends, len(counts) + 1
    want = Counter()
    for i, ws, held in split:
        base = sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in [*[counts[w] for w in ws], ends])
        want[(i, held, len(ws) + 1, sum(counts[w] > 0 for w in ws) + 1, n, round(base, 6))] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    pieces = np.zeros(32000)
    for w, c in counts.items():
        for p in lattice.processor(PATH).encode(w):
            pieces[p] += c
    model = lattice.Lattice(PATH, pieces, ends)
    for r, (i, ws, held) in zip(sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"], r["n_tokens"])), sorted(split, key=lambda x: (x[0] is None, x[0], len(x[1])))):
        assert r["score"] == pytest.approx((model.end + sum(model.alone(w) for w in ws)) / math.log(10), abs=1e-6)
    # a whole text, all its segmentations one by one
    whole = next(r for r in got if r["doc_id"] == 3 and r["n_tokens"] == 3)
    every = segmentations("▁the▁the", model.pieces, lambda ch: model.bytes[list(ch.encode())].sum())
    assert whole["score"] == pytest.approx(math.log10(sum(every)) + model.end / math.log(10), abs=1e-9) and len(every) > 50


def test_weights_are_a_distribution():
    logs, end = lattice.weights(PATH, np.random.default_rng(2).integers(0, 9, 32000).astype(float), 7)
    assert sum(map(math.exp, logs.values())) + math.exp(end) == pytest.approx(1)


def test_long_texts_and_words_are_scored_whole(spark):
    docs = spark.createDataFrame([(2, "word " * 300_000), (3, "x" * 200_000), (4, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lattice.score(docs, PATH).collect()}
    assert got[2]["n_tokens"] == 300_001 and got[3]["n_tokens"] == 2 and got[4]["n_tokens"] == 1
    assert got[2]["score"] < -300_000 * 0.01 and got[3]["score"] < -200_000 * 0.01 and math.isfinite(got[3]["score"])


def test_without_training_rows(spark):
    docs = spark.createDataFrame([(i, "some text") for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1], "doc_id long, text string")
    rows = lattice.score(docs, PATH).collect()
    assert rows and all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in rows)
    assert lattice.score(docs.limit(0), PATH).count() == 0
