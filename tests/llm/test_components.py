"""Components against union-find, and the table of pieces when it forgets."""

import random
from array import array

import pytest

from orderlake.llm import components
from orderlake.llm.components import connected_components
from orderlake.llm.pieces import PieceTable


def brute(links):
    parent = {n: n for pair in links for n in pair}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {n: find(n) for n in parent}


def graphs():
    rng = random.Random(9)
    yield [(i, i + 1) for i in range(60)] + [(100, 101), (5, 5), (101, 100)]
    yield [(0, i) for i in range(1, 300)] + [(i, 1000) for i in range(300, 400)] + [(299, 300)]
    yield [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]


@pytest.mark.parametrize("links", list(graphs()))
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    # A node that only links to itself has no neighbour and is left to the caller.
    want = {n: r for n, r in brute(links).items() if any(n in p and p[0] != p[1] for p in links)}
    assert {r.k: r.root for r in connected_components(df, "test").collect()} == want


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a binary, b binary"), "none").count() == 0


def tables_of(monkeypatch, links):
    """Names and sizes of the tables that the components of ``links`` are made through."""
    made = []

    def written(df, name):
        out = write(df, name)
        made.append((name, out.count()))
        return out

    write = components.written
    monkeypatch.setattr(components, "written", written)
    connected_components(links, "t")
    return made


def test_stars_need_no_round_and_no_table_beside_their_roots(spark, monkeypatch):
    stars = [(0, i) for i in range(1, 30)] + [(40, 41), (41, 40), (0, 5)]
    made = tables_of(monkeypatch, spark.createDataFrame(stars, "a long, b long"))
    assert made == [("t_links", 30), ("t_least", 32)]


def test_links_never_become_more(spark, monkeypatch):
    zigzag = [(i + 30, i) for i in range(30)] + [(i + 30, i + 1) for i in range(29)]
    made = tables_of(monkeypatch, spark.createDataFrame(zigzag + zigzag, "a long, b long"))
    links = [n for name, n in made if name in ("t_links", "t_stars")]
    assert len(links) > 4 and max(links) == len(zigzag)
    # Four tables a round, and two more at the end.
    assert len(made) % 4 == 2


def test_a_full_table_keeps_what_is_seen_often():
    asked = []

    def encode(pieces):
        asked.extend(pieces)
        return [array("i", [len(p), ord(p[0])]).tobytes() for p in pieces]

    table = PieceTable(encode, flag=lambda p: p.endswith("."), max_pieces=20)
    rng = random.Random(1)
    for n in range(60):
        texts = [["often", "often."] + [f"x{n}_{i}" for i in range(3)], [], [rng.choice("abc")]]
        ids, lengths, flagged = table.ids_of(texts)
        want = [v for t in texts for p in t for v in (len(p), ord(p[0]))]
        assert ids.tolist() == want and lengths.tolist() == [10, 0, 2] and flagged.tolist() == [4]
        assert len(table.numbers) <= 30
    assert asked.count("often") < 5


def test_a_table_is_bounded_by_bytes():
    table = PieceTable(lambda pieces: [array("i", [len(p)]).tobytes() for p in pieces], max_bytes=200_000)
    for n in range(200):
        texts = [["often", *(f"{n}-{i}" + "x" * (i % 50) for i in range(300))]]
        ids, lengths, _ = table.ids_of(texts)
        assert ids.tolist() == [len(p) for p in texts[0]] and lengths.tolist() == [301]
        assert table.held + 150 * len(table.numbers) < 200_000 + 301 * 250
