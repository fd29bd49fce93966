import random

import duckdb
import pytest

from stepledger.llm import linededup


def plain(rows, ratio=linededup.RATIO):
    """(doc_id, text, n_lines, n_dropped) by counting in a loop; equal pages of a host are one."""
    pages = {(host, tuple(x.strip(" ") for x in (text or "").split("\n") if x.strip(" "))) for _, text, host in rows}
    total, on = {}, {}
    for host, lines in pages:
        total[host] = total.get(host, 0) + 1
        for line in set(lines):
            on[host, line] = on.get((host, line), 0) + 1
    out = []
    for i, text, host in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        lines = text.split("\n")
        good = [x for x in lines if not (x.strip(" ") and on[host, x.strip(" ")] >= 2 and on[host, x.strip(" ")] > ratio * total[host])]
        out.append((i, "\n".join(good), len(lines), len(lines) - len(good)))
    return sorted(map(str, out))


def rows_of(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        host = rng.choice(["a", "a", "a", "b", "c", None])
        lines = [f"own {i} {k}" for k in range(rng.randint(0, 4))]
        lines += ["Menu"] * rng.randint(0, 2) + [" Menu  "] * (rng.random() < 0.2) + ["Rights"] * (rng.random() < 0.05) + [""] * rng.randint(0, 3)
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), host))
    return rows + [(900, None, "a"), (901, "", "b"), (902, "Menu", "z"), (None, "Menu\nx", "a"), rows[3], (903, "Menu\n" * 5000, "a")]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_counting_in_a_loop_and_sql(spark, seed):
    rows = rows_of(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(str(tuple(r)) for r in linededup.by_site(docs).collect())
    assert got == plain(rows)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    assert sorted(map(str, con.sql(linededup.ORACLE_SQL).fetchall())) == got


def test_other_columns_and_clashing_names_stay(spark):
    rows = [(i, "Menu\nbody %d" % i, "h", "keep", i, 7) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lines string, n_dropped int, bad int")
    out = linededup.drop_boilerplate(docs, ratio=0.5)
    assert out.schema.names == docs.schema.names
    assert sorted(map(tuple, out.collect())) == sorted((i, "body %d" % i, h, k, n, b) for i, _, h, k, n, b in rows)


def test_small_hosts_have_no_floor_and_copies_stay_whole(spark):
    rows = [(i, f"Menu\nbody of {i}", "seven") for i in range(7)]
    rows += [(10 + i, "Same\ntext", "copies") for i in range(9)] + [(30, "alone\nalone", "one")]
    rows += [(40, "x " * 300_000 + "\nMenu", "seven")]
    got = {r["doc_id"]: r["text"] for r in linededup.by_site(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i] == f"body of {i}" for i in range(7)) and got[40] == "x " * 300_000
    assert all(got[10 + i] == "Same\ntext" for i in range(9)) and got[30] == "alone\nalone"


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame(rows_of(1), "doc_id long, text string, source string")
    plan = linededup.by_site(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "MapPartitions"))


def test_empty_table(spark):
    assert linededup.by_site(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
