import random

import pytest

from stepledger.llm import decontam


def nearest(item, text):
    """Least edit distance of the item to any part of the text, by dynamic programming."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def altered(rng, text, edits):
    out = list(text)
    for _ in range(edits if out else 0):
        out = out or ["a"]
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abcxyz")
        elif kind == 1:
            out.insert(at, rng.choice("abcxyz"))
        else:
            del out[at]
    return "".join(out)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_distance_matches_dynamic_programming():
    rng = random.Random(2)
    for _ in range(300):
        item = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 70)))
        text = "".join(rng.choice("ab c") for _ in range(rng.randint(0, 90)))
        if rng.random() < 0.5:
            text += altered(rng, item, 3) + text
        budget = rng.randint(0, 12)
        want = nearest(item, text)
        got = decontam.myers(item, text, budget)
        assert (got[0] if got else None) == (want if want <= budget and text else None)


def test_pieces_cover_the_item():
    for item, budget in (("abcdefghij", 2), ("abc", 2), ("x" * 100, 7)):
        pieces = decontam.cut(item, budget)
        assert len(pieces) == budget + 1 and "".join(p for _, p in pieces) == item and all(item[a:].startswith(p) for a, p in pieces)


def test_matcher_finds_all_that_brute_force_finds():
    rng = random.Random(7)
    items = [(i, words(rng, 9)) for i in range(6)]
    matcher = decontam.Matcher(items, rate=0.1, min_chars=20)
    hits = 0
    for _ in range(120):
        item = rng.choice(items)[1]
        text = words(rng, rng.randint(0, 8)) + " " + altered(rng, item, rng.randint(0, 9)) + " " + words(rng, rng.randint(0, 8))
        text = decontam.plain(text)
        want = {i: d for i, t in items if (d := nearest(t, text)) <= int(len(t) * 0.1)}
        got = matcher.matches(text)
        assert {i: d for i, d, _, _ in got} == want
        for i, d, a, b in got:
            assert nearest(dict(items)[i], text[a:b]) == d
        hits += len(want)
    assert hits > 40


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)
    items = [(i, words(rng, 12)) for i in range(8)]
    clean = [(i, words(rng, 60)) for i in range(30)]
    dirty = [(100 + i, f"{words(rng, 20)}\n{altered(rng, items[i % 8][1], i % 4).upper()}  {words(rng, 20)}") for i in range(16)]
    docs = clean + dirty + [(200, None), (201, ""), (None, items[0][1]), (100, dirty[0][1]), (202, items[1][1] + " " + items[2][1])]
    docs = spark.createDataFrame([(*d, "x", 2) for d in docs], "doc_id long, text string, item_id string, distance int")
    bench = spark.createDataFrame([(*x, "q") for x in [*items, (50, None), (51, ""), (52, "short"), (3, items[3][1]), (None, words(rng, 12))]], "item_id long, text string, doc_id string")
    return docs, bench


@pytest.mark.parametrize("block_chars", [decontam.BLOCK_CHARS, 150])
def test_find_matches_brute_force(tables, block_chars):
    docs, bench = tables
    items = {(r["item_id"], decontam.plain(r["text"])) for r in bench.where("item_id IS NULL OR item_id <> 52").collect()}
    want = sorted(str((d["doc_id"], i, nearest(t, decontam.plain(d["text"])))) for d in docs.collect() for i, t in items if len(t) >= 32 and nearest(t, decontam.plain(d["text"])) <= int(len(t) * decontam.RATE))
    got = decontam.find(docs, bench, block_chars=block_chars).collect()
    assert len(want) >= 19
    assert sorted({str((r["doc_id"], r["item_id"], r["distance"])) for r in got}) == sorted(set(want))


def test_short_items_match_as_they_are_between_other_characters(spark):
    docs = spark.createDataFrame([(1, "It is a  Short text."), (2, "shorter and longer"), (3, "ashort"), (4, "x" * 500_000 + " ten chars! " + "y" * 500_000), (5, "(short)"), (6, "shor t")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "short"), (2, "TEN chars"), (3, "")], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["distance"], r["match_start"], r["match_end"]) for r in decontam.find(docs, bench).collect())
    assert got == [(1, 1, 0, 8, 13), (4, 2, 0, 500_001, 500_010), (5, 1, 0, 1, 6)]
    assert sorted(r["doc_id"] for r in decontam.clean(docs, bench).collect()) == [2, 3, 6]


def test_places_are_those_of_the_plain_text(spark):
    item = "the quick brown fox jumps over the lazy dog"
    docs = spark.createDataFrame([(1, f"\n  A\t\tb {item.upper().replace(' ', '   ')} end")], "doc_id long, text string")
    row = decontam.find(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).first()
    assert decontam.plain(docs.first()["text"])[row["match_start"] : row["match_end"]] == item


def test_clean_drops_exactly_the_matched_rows(tables):
    docs, bench = tables
    kept = decontam.clean(docs, bench)
    assert kept.schema == docs.schema
    bad = {r["doc_id"] for r in decontam.find(docs, bench).collect()}
    want = sorted(str(r["doc_id"]) for r in docs.collect() if r["doc_id"] not in bad)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want


def test_empty_tables(tables):
    docs, bench = tables
    assert decontam.find(docs.limit(0), bench).count() == 0
    assert decontam.find(docs, bench.limit(0)).count() == 0
    assert decontam.clean(docs, bench.limit(0)).count() == docs.count()
