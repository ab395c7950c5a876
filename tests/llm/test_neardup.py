import itertools
import random
import re

import pytest

from quire.llm import neardup as N

SCHEMA = "block_uid bigint, clean_text string, id bigint, runs string, set_id string"


def brute(rows, n, threshold, least):
    sets = {}
    for u, t in rows:
        if u is not None and t:
            w = re.findall(r"[^\W_]+", t.lower())
            if len(w) >= max(least, n):
                sets[u] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) * 10 >= threshold * 10 * len(sets[a] | sets[b])}


@pytest.mark.parametrize(("n", "least", "threshold", "big", "heavy"), [(3, 25, 0.8, 4000, 1e-4), (5, 0, 0.8, 4000, 1.0), (3, 5, 0.8, 4, 1.0), (1, 0, 0.8, 3, 1e-3), (1, 0, 0.3, 4000, 1e-3)])
def test_against_brute_force(spark, monkeypatch, n, least, threshold, big, heavy):
    monkeypatch.setattr(N, "BIG", big)
    monkeypatch.setattr(N, "HEAVY", heavy)
    monkeypatch.setattr(N, "MOST_WORDS", 40)
    monkeypatch.setattr(N, "KEPT", 300)
    monkeypatch.setattr(N, "SHARE", 1e-2)
    rnd = random.Random(n * 100 + least)
    vocab = [f"w{i}" for i in range(60)]
    rows, u = [], 0
    for _ in range(25):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(3, 60))]
        for _ in range(rnd.randint(1, 6)):
            t = list(base)
            for _ in range(rnd.randint(0, 2)):
                i = rnd.randrange(len(t))
                rnd.choice([lambda: t.__setitem__(i, rnd.choice(vocab)), lambda: t.insert(i, "new"), lambda: t.pop(i) if len(t) > 2 else None])()
            rows.append((u, " ".join(t)))
            u += 1
    if n == 1:
        rows += [(u + 10, "same"), (u + 11, "same other more")]  # one run in common
    rows += [(u, rows[0][1].upper()), (u + 1, None), (u + 2, ""), (None, rows[0][1]), (0, rows[0][1])]
    df = spark.createDataFrame([(a, b, a, "x", "y") for a, b in rows], SCHEMA)
    got = {(r.a, r.b) for r in N.pairs(df, "block_uid", "clean_text", threshold, n, least).collect()}
    want = brute(rows, n, threshold, least)
    assert got == want and (want or least > 20)
    groups = {r.id: r.group_id for r in N.groups(df, "block_uid", "clean_text", threshold, n, least).collect()}
    assert set(groups) == {x for p in want for x in p} and all(groups[a] == groups[b] for a, b in want)


def test_many_copies_of_one_text_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(N, "COPIES", 7)
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(i, text, i, "", "") for i in range(60)] + [(99, "one " * 100_000, 1, "", "")], SCHEMA)
    assert N.pairs(df, "block_uid", "clean_text", 0.8, 3, 25).count() == 60 * 59 // 2
    assert {r.links for r in N.groups(df, "block_uid", "clean_text", 0.8, 3, 25).collect()} == {0}
    assert N.pairs(df.limit(0), "block_uid", "clean_text").count() == 0
