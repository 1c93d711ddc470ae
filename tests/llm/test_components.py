import random

from brute import components

from parcelgrid.llm import components as C


def test_against_a_plain_search(spark, monkeypatch):
    """Chains, stars, cycles, repeated links, loops and null ends, with and without broadcast."""
    rng = random.Random(4)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(230)]
    links += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2001 + i) for i in range(30)] + links[:5] + [(7, 7)]
    met = {frozenset(x) for x in links}
    root = components(sorted({x for pair in links for x in pair}), lambda a, b: frozenset((a, b)) in met)
    table = spark.createDataFrame([*links, (None, 3), (5, None)], "a long, b long").repartition(3)
    want = {(node, r) for node, r in root.items() if node != r}
    for rows in (C.hot.BROADCAST_ROWS, 0):
        monkeypatch.setattr(C.hot, "BROADCAST_ROWS", rows)
        got = [tuple(r) for r in C.connected(table, "a", "b").collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert C.connected(table.filter("a = 7 AND b = 7"), "a", "b").count() == 0


def test_stars_take_no_further_round(spark, monkeypatch):
    """Pairs and stars are done after one round; no round is run to see that nothing changes."""
    rounds = []
    large_star = C.large_star
    monkeypatch.setattr(C, "large_star", lambda *a: (rounds.append(1), large_star(*a))[1])
    stars = spark.createDataFrame([(1, 2), (3, 4), (3, 5), (6, 3), (9, 8)], "a long, b long")
    assert {tuple(r) for r in C.connected(stars, "a", "b").collect()} == {(2, 1), (4, 3), (5, 3), (6, 3), (9, 8)}
    assert len(rounds) == 1
