import random
import zlib

import pytest

from stepledger.llm import quality

WORDS = "the river moved slowly past old stones and quiet fields while people walked home under grey skies".split()


def prose(rng):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(20, 80)))


def junk(rng):
    return rng.choice([lambda: prose(rng).upper().replace(" ", "!! "), lambda: " ".join([rng.choice(WORDS)] * 40), lambda: prose(rng).replace(" ", " | ")])()


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    rows = [(i, (prose if i % 3 else junk)(rng)) for i in range(400)]
    docs = spark.createDataFrame([(i, t, "en", 1.0) for i, t in rows] + [(None, "x y", "en", 1.0), (900, None, "en", 1.0), (901, "", "en", 1.0)], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(400)] + [(5, None, 0), (None, 1, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_held_out_accuracy(tables):
    docs, labels = tables
    rows = quality.score(docs, *quality.fit(docs, labels)).collect()
    assert len(rows) == 403
    test = [r for r in rows if r["held_out"] and r["doc_id"] < 400]
    assert len(test) > 50 and all(r["held_out"] == held(r["doc_id"]) for r in rows if r["doc_id"] is not None)
    right = sum(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in test)
    assert right / len(test) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert not next(r for r in rows if r["doc_id"] is None)["held_out"]


def test_held_out_labels_do_not_matter(spark, tables):
    docs, labels = tables
    rows = [(r[0], 1 - r[1] if r[0] is not None and r[1] is not None and held(r[0]) else r[1], 0) for r in labels.collect()]
    turned = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    a, b = quality.fit(docs, labels), quality.fit(docs, turned)
    assert (a[0] == b[0]).all() and a[1] == b[1]


def test_keep_and_missing_labels(spark, tables):
    docs, labels = tables
    model = quality.fit(docs, labels)
    kept = quality.keep(docs, *model)
    assert kept.schema == docs.schema
    want = {r["doc_id"] for r in quality.score(docs, *model).collect() if r["predicted"]}
    assert {r["doc_id"] for r in kept.collect()} == want
    weights, bias = quality.fit(docs, labels.limit(0))
    assert not weights.any() and bias == 0
    assert {r["score"] for r in quality.score(docs, weights, bias).collect()} == {0.5}
    assert quality.score(docs.limit(0), weights, bias).count() == 0


def test_word_sums_equal_the_document_vector():
    model = quality.train([(y, *quality.document_vector(t)) for y, t in [(0, "A!! B!!"), (1, "calm sea"), (0, "go go go go"), (1, "a b go")]])
    text = "go go calm sea A!!"
    ids, shares = quality.document_vector(text)
    z = float((model[0][ids] * shares).sum() + model[1])
    assert quality.scorer(*model)(text) == pytest.approx(1 / (1 + 2.718281828459045**-z), rel=1e-5)
