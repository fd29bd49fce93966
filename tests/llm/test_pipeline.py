import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402
from stepledger.llm import decontam, neardup, packing  # noqa: E402

WORDS = [f"{a}{b}" for a in "river stone old walked home quiet light under grey moved".split() for b in ("", "s", "er", "ly")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    path = tmp_path_factory.mktemp("tables")

    def prose(n):
        return "\n".join(" ".join(rng.choice(WORDS) for _ in range(12)) for _ in range(n))

    docs = [(i, "Home | About\n" + prose(rng.randint(2, 12)), "en", f"s{i % 3}", 1) for i in range(150)]
    docs += [(200 + i, (prose(4).upper().replace(" ", "!! ")), "en", "s0", 1) for i in range(60)]
    docs += [(300 + i, docs[i][1], "en", docs[i][3], 1) for i in range(10)]
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(14))) for i in range(4)]
    docs += [(400 + i, prose(3) + "\n" + items[i][1] + "\n" + prose(3), "en", "s1", 1) for i in range(4)]
    docs += [(500, prose(300), "en", "s2", 1), (501, None, None, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(d[0], int(not 200 <= d[0] < 300), 0) for d in docs[:210]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_act_on_what_came_before(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, folder), name)
        seen[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    kept = {r["doc_id"]: r["text"] for r in seen["quality_classifier"].collect()}
    assert set(range(150)) <= set(kept) and not any(200 <= i < 260 for i in kept)
    lines = {r["doc_id"]: r for r in seen["line_dedup"].collect()}
    assert set(lines) == set(kept) and all("Home" not in (r["text"] or "") for r in lines.values())
    assert all(r["n_chars"] == len(r["text"]) for r in lines.values() if r["text"] is not None)
    single = {r["doc_id"] for r in seen["simhash_neardup"].collect()}
    codes = {}
    for i, r in sorted(lines.items()):
        code = neardup.fingerprint(r["text"])
        if all((code ^ c).bit_count() > 3 for c in codes.values()):
            codes[i] = code
    assert not any(300 <= i < 310 for i in single) and single <= set(lines) and set(range(150)) & set(codes) <= single
    clean = {r["doc_id"]: r["text"] for r in seen["benchmark_decontamination"].collect()}
    assert single - set(clean) == {i for i in single if 400 <= i < 404}
    out = seen["best_fit_packing"].toPandas()
    encode = packing.encoder(packing.vocabulary()[0], None)
    assert out.groupby("doc_id").length.sum().to_dict() == {i: len(encode(t or "")) + 1 for i, t in clean.items()}
    assert out.groupby("sequence_id").length.sum().max() <= 2048


def test_run_returns_the_last_stage(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns[:2] == ["doc_id", "piece"] and out.count() > 100
    assert decontam.RATE > 0


@pytest.mark.parametrize("seen, star", [(3, 1), (neardup.SEEN_IN, 4), (neardup.SEEN_IN, neardup.STAR)])
def test_near_duplicates_are_those_of_similar_shingle_sets(spark, monkeypatch, seen, star):
    monkeypatch.setattr(neardup, "SEEN_IN", seen)
    monkeypatch.setattr(neardup, "STAR", star)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for n in [4, 5, 6, 9, 30, 120, 250, 250, 400]:
        base = [rng.choice(words) for _ in range(n)]
        texts.append(base)
        for edits in (0, 1, 1, 2, 4, 8):
            copy = base + [rng.choice(words)] * (edits == 1)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy)
    texts += [["w0"] * 50 + t for t in texts[:3]] + [[], []]
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} or {tuple(t)} for t in texts]
    label, wide = list(range(len(texts))), 0
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                wide += (neardup.fingerprint(" ".join(texts[i])) ^ neardup.fingerprint(" ".join(texts[j]))).bit_count() > 3
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    rows = [(i, " ".join(t), "keep") for i, t in enumerate(texts)] + [(None, " ".join(texts[0]), "keep")]
    out = corpus_pipeline.simhash_neardup(spark, spark.createDataFrame(rows, "doc_id long, text string, other string"), "")
    assert wide and out.columns == ["doc_id", "text", "other"]
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in out.collect()) == [-1, *sorted(set(label))]


def test_large_groups_of_copies_leave_one_whole_document_each(spark):
    rng = random.Random(5)
    body = ["\n".join(" ".join(rng.choice(WORDS) for _ in range(12)) for _ in range(4)) for _ in range(102)]
    rows = [(i, "Home | About\n" + body[i], "s") for i in range(100)]
    rows += [(100 + i, "Home | About\n" + body[100] + "\n" * (i % 2), "s") for i in range(50)] + [(200 + i, body[101], "s") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    lines = corpus_pipeline.materialise(corpus_pipeline.line_dedup(spark, docs, ""), "lines")
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.simhash_neardup(spark, lines, "").collect()}
    assert kept == {**{i: body[i] for i in range(101)}, 200: body[101]}


def test_large_groups_of_near_copies_cost_few_pairs(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(500)}" for _ in range(200)]
    texts = []
    for i in range(150):
        copy = list(base)
        for _ in range(2):
            copy[rng.randrange(200)] = f"x{i}"
        texts.append(" ".join(copy))
    texts += [" ".join(f"w{rng.randrange(500)}" for _ in range(80)) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("d", neardup.F.md5("text"))
    marks = neardup.shingle_sets(docs, digest="d")
    distinct = corpus_pipeline.materialise(marks.groupBy("key").agg(neardup.F.min(neardup.F.struct("doc_id", "digest")).alias("first"), neardup.F.first("fp").alias("fp"), neardup.F.first("n").alias("n"), neardup.F.first("held").alias("held")), "distinct")
    assert neardup.linked(docs, distinct, "d").count() < 10 * len(texts)
    kept = {r["doc_id"] for r in neardup.keep_similar(docs.drop("d")).collect()}
    assert kept == {0, *range(150, 170)}
