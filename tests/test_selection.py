"""Selections against plain loops that follow the rules one row after the other."""

import random

import pytest
from pyspark.sql import functions as F

from gazette.functions import text
from gazette.operators import select, similar


def near(a, b):
    return len({*a} & {*b}) / max(1, len({*a} | {*b})) >= 0.45


def alike(a, b):
    return text.jaccard(a, b) >= 0.45


def walk(rows, chosen, used, target):
    """A plain walk: rows are (chapter, key, score, source, tokens), best first; what is passed over, and why."""
    reasons = {}
    for r in sorted(rows, key=lambda r: (-r[2], r[1])):
        if len(chosen) >= target:
            break
        if r in chosen:
            continue
        why = "global_url" if r[1] in used else "domain_cap" if sum(c[3] == r[3] for c in chosen) >= 2 else "same_event" if any(near(c[4], r[4]) for c in chosen) else None
        if why:
            reasons[why] = reasons.get(why, 0) + 1
            continue
        chosen.append(r)
        used.add(r[1])
    return reasons


@pytest.mark.parametrize("seed", [1, 2])
def test_refill_equals_a_plain_walk(spark, seed):
    draw = random.Random(seed)
    chapters = ["a", "b", "c"]
    rows = [(c, draw.randint(0, 60), draw.randint(0, 9), draw.choice("pqr" if c == "c" else "pqrstu"), draw.sample("ABCDEFGHI", 4)) for c in chapters for _ in range(25)]
    rows = list({(r[0], r[1]): r for r in rows}.values())
    kept = [min((r for r in rows if r[0] == c), key=lambda r: (-r[2], r[1])) for c in chapters]
    keys = set()
    kept = [r for r in kept if not (r[1] in keys or keys.add(r[1]))]
    used, final, why = {r[1] for r in kept}, {}, {}
    for c in chapters:
        pool, chosen = [r for r in rows if r[0] == c], [r for r in kept if r[0] == c]
        first = walk(pool, chosen, used, 5)
        for k, n in first.items():
            why[c, k] = n
        if len(chosen) < 5:
            used -= {r[1] for r in chosen}
            chosen = []
            for k, n in walk(pool, chosen, used, 5).items():
                why[c, f"resolve_{k}"] = n
        final[c] = {r[1] for r in chosen}
    kind = "chapter string, key int, score int, source string, tokens array<string>"
    turn = lambda df: df.withColumn("turn", -F.col("key"))
    got, reasons = select.refill(turn(spark.createDataFrame(kept, kind)), turn(spark.createDataFrame(rows, kind)), "chapter", "key", ["score", "turn"], 5, {"source": 2}, alike, chapters)
    found = {c: set() for c in chapters}
    for r in got.collect():
        found[r.chapter].add(r.key)
    assert found == final
    assert {(r.chapter, r.reason): r.n for r in reasons.collect()} == why


def test_refill_of_two_editions_in_one_call_equals_two_calls(spark):
    draw = random.Random(11)
    kind = "ed int, chapter string, key int, score int, source string, tokens array<string>, turn int"
    rows = [(e, c, k, draw.randint(0, 9), draw.choice("pqrstu"), draw.sample("ABCDEFGHI", 4), -k) for e in (1, 2) for c in "ab" for k in draw.sample(range(40), 16 if (e, c) != (2, "b") else 3)]
    kept = [r for r in rows if r[2] % 9 == e0(r)]
    args = ("chapter", "key", ["score", "turn"], 5, {"source": 2}, alike, ["a", "b", "c"])
    mine = lambda rows, e: spark.createDataFrame([r for r in rows if e in (None, r[0])], kind)
    got, why = select.refill(mine(kept, None), mine(rows, None), *args, edition="ed")
    found = {(r.ed, r.chapter, r.key, r.mode) for r in got.collect()}
    reasons = {(r.ed, r.chapter, r.reason, r.n) for r in why.collect()}
    apart, told = set(), set()
    for e in (1, 2):
        one, two = select.refill(mine(kept, e), mine(rows, e), *args)
        apart |= {(e, r.chapter, r.key, r.mode) for r in one.collect()}
        told |= {(e, r.chapter, r.reason, r.n) for r in two.collect()}
    assert found == apart and reasons == told and {f[0] for f in found} == {1, 2}


def e0(row):
    """Of each edition and chapter other rows are kept."""
    return row[0] * 2 + (row[1] == "b")


def test_the_fold_goes_on_in_rounds_where_its_rows_do_not_fill_a_group(spark, monkeypatch):
    draw = random.Random(5)
    rows = [(g, k, draw.randint(0, 9), draw.choice("ab" if k < 12 else "abcdef"), draw.sample("ABCDEFGH", 3)) for g in range(4) for k in range(40)]
    df = spark.createDataFrame(rows, "g int, k int, score int, source string, tokens array<string>").withColumn("turn", -F.col("k"))
    monkeypatch.setattr(select, "PREFIX", 6)
    got = {(r.g, r.pick, r.k) for r in select.greedy_select(df, ["g"], ["score", "turn"], 6, {"source": 2}, likeness=alike).collect()}
    wanted = set()
    for g in range(4):
        chosen = []
        for r in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1])):
            if len(chosen) < 6 and sum(c[3] == r[3] for c in chosen) < 2 and not any(near(c[4], r[4]) for c in chosen):
                chosen.append(r)
                wanted.add((g, len(chosen), r[1]))
    assert got == wanted


def test_allocation_of_any_number_of_chapters(spark):
    rows = [(1, f"c{c}", f"t{k}", 10 - k, f"s{k % 5}", [f"w{c}{k}"]) for c in range(7) for k in range(c + 1)]
    df = spark.createDataFrame(rows, "edition int, chapter string, key string, score int, source string, tokens array<string>").withColumn("turn", F.xxhash64("chapter", "key"))
    got = {}
    for r in select.allocate(df, "edition", "chapter", "key", ["score", "turn"], 3, {"source": 2}, alike).collect():
        got.setdefault(r.chapter, set()).add(r.key)
    assert got == {f"c{c}": {f"t{c}"} for c in range(7)}


def test_arbitration_ladder(spark):
    rows = [
        ("k1", "economy", "rates rise", 1), ("k1", "company", "shares fall", 2), ("k1", "company", "again", 3), ("k2", "international", "talks on trade", 4), ("k2", "economy", "no term", 5), ("k3", "international", "talks", 6), ("k3", "economy", "none", 7),
        ("k4", "science", "x", 8), ("k4", "economy", "y", 9), ("k5", "science", "x", 10), ("k5", "science", "z", 11),
    ]
    df = spark.createDataFrame(rows, "key string, chapter string, title string, seq int")
    got = {r.seq: (r.winner, r.kept) for r in select.arbitrate(df, "key", "chapter", "title", "seq", {"company": ["shares"], "economy": ["trade", "rates"]}).collect()}
    assert got == {1: ("company", False), 2: ("company", True), 3: ("company", False), 4: ("economy", False), 5: ("economy", True), 6: ("international", True), 7: ("international", False), 8: ("science", True), 9: ("science", False), 10: (None, True), 11: (None, True)}


def test_corroboration_leaves_out_own_links_and_publishers(spark):
    draw = random.Random(7)
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    sides = []
    for side in range(2):
        sides.append([(side * 1000 + k, f"l{draw.randint(0, 9)}", draw.choice(["", "p", "q"]), draw.sample(words, draw.randint(0, 6))) for k in range(40)])
    left, right = (spark.createDataFrame(s, "id int, link string, source string, tokens array<string>") for s in sides)
    got = {(r.l, r.r, r.rank) for r in similar.corroborating(left, right).collect()}
    wanted = set()
    for a in sides[0]:
        met = []
        for b in sides[1]:
            k, u, m = len({*a[3]} & {*b[3]}), len({*a[3]} | {*b[3]}), min(len(a[3]), len(b[3]))
            if k >= 2 and (k / u >= 0.25 or k / m >= 0.5) and a[1] != b[1] and not (a[2] and a[2] == b[2]):
                met.append((-round(2 * round(k / u, 3) + round(k / m, 3) + 0.05 * k, 4), b[0]))
        wanted |= {(a[0], b, n + 1) for n, (_, b) in enumerate(sorted(met)[:3])}
    assert got == wanted
