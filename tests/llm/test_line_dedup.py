"""Chunks of lines against a plain reading of the rules."""

import collections
import hashlib
import random

import pytest

from orderlake.llm import line_dedup
from orderlake.llm.queries import ORACLE_SQL, QUERIES


def solid(text):
    """The text as units: a solid line with the blank ones behind it; the first has those before it too."""
    units, blank = [], []
    for s in text.split("\n"):
        if s.strip(" \t\r"):
            units.append((s, blank + [s]))
            blank = []
        elif units:
            units[-1][1].append(s)
        else:
            blank.append(s)
    return units


def chunks(text):
    """(first, lines) of all chunks."""
    lines = [s for s, _ in solid(text)]
    h = [int(hashlib.md5(s.encode()).hexdigest()[:7], 16) for s in lines]
    r = {i: (h[i] + 1_000_003 * h[i - 1]) % 2_147_483_647 for i in range(1, len(h))}
    out = set()
    for i, x in r.items():
        near = [r[j] for j in (i - 1, i + 1) if j in r]
        if not near or any(x <= y for y in near):
            out |= {(a, tuple(lines[a:b])) for a, b in ((i - 1, i + 1), (i - 2, i + 1), (i - 1, i + 2)) if a >= 0 and b <= len(lines)}
    return out


def brute(rows):
    first = {}
    for k, t in {r for r in rows if r[1] is not None}:
        for a, c in chunks(t):
            first[c] = min(first.get(c, (k, a)), (k, a))
    out = collections.Counter()
    for k, t in rows:
        if t is None:
            out[k, None, 1, 0, 0] += 1
            continue
        units = solid(t)
        gone = {u for a, c in chunks(t) if first[c] != (k, a) for u in range(a, a + len(c))}
        kept = "\n".join(s for u, (_, held) in enumerate(units) if u not in gone for s in held) if gone else t
        out[k, kept, len(t.split("\n")), sum(len(units[u][1]) for u in gone), sum(u - 1 not in gone for u in gone)] += 1
    return out


def test_against_the_rules(spark):
    rng = random.Random(7)
    passages = [[f"line {rng.randrange(10**6)} é" for _ in range(n)] for n in (3, 6, 12, 30)]
    rows = [(0, None), (1, ""), (2, "one line"), (3, "\n\n\n"), (4, "\n\n\n"), (5, "a\nb\n"), (7, "\n \na\n\t\r\nb\n\n"), (8, "x\n" * 9), (9, "q\r\n\r\nx\n x\nx\nx\ny"), (6, "long " * 20000 + "\nend")]
    for k in range(10, 60):
        parts = [[f"own {k} {i} {rng.random()}" for i in range(rng.randrange(5))] + rng.choice(passages) for _ in range(2)]
        rows.append((k, "\n".join(s for p in parts for s in p)))
        if k % 5 == 0:
            rows[-1] = (k, "\n" + rows[-1][1].replace("\n", "\n\n"))
    rows += [(100, rows[20][1]), rows[20], rows[20]]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_lines int, body string")
    out = line_dedup.remove_repeated_chunks(docs)
    assert out.columns == ["doc_id", "text", "body", "n_lines", "n_removed", "n_chunks_removed"]
    got = collections.Counter((r.doc_id, r.text, r.n_lines, r.n_removed, r.n_chunks_removed) for r in out.collect())
    assert got == brute(rows)
    assert any(removed for _, _, _, removed, _ in got)


def test_an_inserted_line_moves_borders_only_near_it():
    lines = [f"line {i}" for i in range(200)]
    before = {c for _, c in chunks("\n".join(lines))}
    after = {c for _, c in chunks("\n".join(lines[:50] + ["new"] + lines[50:]))}
    assert len(before - after) <= 6


@pytest.mark.parametrize("blank", [False, True])
def test_repeated_passages_are_removed_from_three_lines_on(spark, blank):
    """A passage of n lines, planted in two texts of other lines: the share of its lines that the second text loses."""
    rng = random.Random(3)
    trials, rows, between = 40, [], "\n\n" if blank else "\n"
    sizes = (1, 2, 3, 4, 6, 10, 20)
    for n in sizes:
        for t in range(trials):
            passage = [f"passage {n} {t} {i} {rng.random()}" for i in range(n)]
            for place in (0, 1):
                own = [f"own {n} {t} {place} {i} {rng.random()}" for i in range(12)]
                at = rng.randrange(13)
                rows.append((len(rows), n, place, between.join(own[:at] + passage + own[at:])))
    docs = spark.createDataFrame(rows, "doc_id long, n int, place int, text string")
    lost, left = collections.Counter(), collections.Counter()
    for r in line_dedup.remove_repeated_chunks(docs).collect():
        assert sum(s.startswith("own ") for s in r.text.split("\n")) == 12
        (lost if r.place else left)[r.n] += r.n - sum(s.startswith("passage ") for s in r.text.split("\n"))
    shares = {n: lost[n] / n / trials for n in sizes}
    assert not any(left.values()) and shares[1] == 0 and 0.2 < shares[2] < 0.8, shares
    assert all(shares[n] == 1 for n in sizes if n > 2), shares


def test_a_second_copy_loses_all_its_lines(spark):
    text = "\n\n".join(f"paragraph {i}" for i in range(9))
    docs = spark.createDataFrame([(1, text), (2, text), (3, text.replace("\n\n", "\n"))], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_removed, r.n_chunks_removed) for r in line_dedup.remove_repeated_chunks(docs).collect()}
    assert got == {1: (text, 0, 0), 2: ("", 17, 1), 3: ("", 9, 1)}


def test_a_long_text_of_many_lines(spark):
    lines = [f"line {i % 30_000}" for i in range(60_000)]
    docs = spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")
    row = line_dedup.remove_repeated_chunks(docs).first()
    assert (row.n_removed, row.text) == (30_000, "\n".join(lines[:30_000]))


def test_empty_table_and_null_keys(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.remove_repeated_chunks(empty).count() == 0
    text = "\n".join(f"line {i}" for i in range(40))
    docs = spark.createDataFrame([(None, text), (3, text)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in line_dedup.remove_repeated_chunks(docs).collect()}
    assert got[3] == 0 and got[None] > 30


def test_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    plan = line_dedup.remove_repeated_chunks(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_query_equals_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.execute(ORACLE_SQL["op2_line_dedup"]).fetchall())
    assert sorted(tuple(r) for r in QUERIES["op2_line_dedup"](spark, sf).collect()) == want
