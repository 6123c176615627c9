"""fuzzy_lookup: the likest known name of each, without scoring all pairs."""

import random
import time

import pytest
from pyspark.sql import functions as F

from lakesieve.functions import nearest
from lakesieve.functions.similarity import name_score
from lakesieve.operators import joins

WORDS = ["sa", "de", "acme", "medica", "salud", "norte", "lab", "laboratorios", "s", "y", "dos", "unido", "ñandú", "b"]


def a_name(r):
    return r.choice([
        lambda: " ".join(r.choice(WORDS) for _ in range(r.randint(1, 5))), lambda: f"supplier {r.randint(0, 400):09d}", lambda: "".join(r.choice("abc ") for _ in range(r.randint(1, 30))).strip() or "x",
        lambda: " ".join(r.choice(WORDS) for _ in range(r.randint(12, 60))), lambda: "".join(chr(r.randint(0x4E00, 0x4E60)) for _ in range(r.randint(1, 12))),
    ])()


def misspelt(r, name):
    for _ in range(r.randint(0, 4)):
        k = r.randint(0, len(name))
        name = name[:k] + r.choice("abc lo01 ") + name[k + r.randint(0, 1) :]
    return name.strip() or "z"


def brute(asked, known, least, stop):
    tops = [max((name_score(a, b, stop), -j) for j, b in enumerate(known)) for a in asked]
    return [(i, -j, s) for i, (s, j) in enumerate(tops) if s >= least]


@pytest.mark.parametrize("least", [0.1, 0.3, 0.5, 0.75, 0.9, 1.0])
def test_likest_is_that_of_all_pairs(least):
    r = random.Random(int(least * 100))
    for stop in ((), ("sa", "de"), joins.STOP):
        known = list(dict.fromkeys(a_name(r) for _ in range(80)))
        asked = list(dict.fromkeys([misspelt(r, r.choice(known)) for _ in range(30)] + [a_name(r) for _ in range(10)] + [known[0].replace("0", "o") + " sa"]))
        assert list(zip(*nearest.likest(asked, known, least, stop), strict=True)) == brute(asked, known, least, stop)
    assert nearest.likest([], known, least) == nearest.likest(asked, [], least) == ([], [], [])


def test_few_of_the_pairs_are_scored(monkeypatch):
    known = [f"supplier {i:09d}" for i in range(3000)]
    asked = [f"{x} sa".replace("1", "l") for x in known[::60]]
    want, calls = brute(asked, known, 0.75, ("sa", "de")), []
    monkeypatch.setattr(nearest, "name_score", lambda *x: calls.append(x) or name_score(*x))
    assert list(zip(*nearest.likest(asked, known, 0.75, ("sa", "de")), strict=True)) == want
    assert len(calls) < 10 * len(asked)


def test_fuzzy_lookup_over_parts_and_lots(spark, monkeypatch):
    monkeypatch.setattr(joins, "KNOWN", 20)
    monkeypatch.setattr(joins, "FEW", 10)
    r = random.Random(3)
    rows = [(r.choice(["1", "2", None]), r.choice([a_name(r), "acme medica", "", None]), r.choice([None, (1, 2), (1, 1), (0, 5)])) for _ in range(200)]
    known = spark.createDataFrame(rows, "c string, n string, s struct<x: int, y: int>")
    asks = [(r.choice(["1", "2", "3", None]), r.choice([misspelt(r, n or ""), a_name(r), "", None])) for _, n, _ in rows]
    asked = spark.createDataFrame(asks, "c string, p string")

    def want(by, seq):
        first = {}
        for c, n, s in rows:
            if n and (c or not by):
                # the least seq that isn't null, nulls before all others
                key = (c if by else 0, n)
                first[key] = min(first.get(key, (9, 9)), s if seq and s else (9, 9))
        out = set()
        for c, p in {(c if by else 0, p) for c, p in asks if p and (c or not by)}:
            names = sorted((n for k, n in first if k == c), key=lambda n: ((-1, -1) if first[c, n] == (9, 9) else first[c, n], n.encode()))
            out |= {(c, p, names[j], s) for _, j, s in (brute([p], names, 0.5, ("sa",)) if names else [])}
        return out

    got = joins.fuzzy_lookup(asked, known, "p", "n", 0.5, ("sa",), ("c",), "s").collect()
    assert len(got) == len(want(True, True)) and {tuple(x) for x in got} == want(True, True)
    got = joins.fuzzy_lookup(asked, known, "p", "n", 0.5, ("sa",)).collect()
    assert len(got) == len(want(False, False)) and {(0, *x) for x in got} == want(False, False)


def test_fuzzy_lookup_of_thousands_ends_soon(spark):
    # all names have a word and their length in common: nine million pairs
    known = spark.range(3000).select(F.concat(F.lit("supplier "), F.lpad(F.col("id").cast("string"), 9, "0")).alias("n"))
    began = time.time()
    got = joins.fuzzy_lookup(known.select(F.concat(F.translate("n", "1", "l"), F.lit(" sa")).alias("p")), known, "p", "n", 0.75, ("sa", "de")).collect()
    assert time.time() - began < 100
    # without a one in it, a name is found as a part of what was asked; that of 1111 has 14 of 21 characters in common with any
    assert all(x.n == x.p[:-3] and x.score == 1 for x in got if "l" not in x.p[8:])
    assert sorted(x.p for x in got) == sorted(f"supplier {i:09d} sa".replace("1", "l") for i in range(3000) if i != 1111)
