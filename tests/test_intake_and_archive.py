"""Late rows of a stream, editions on disk, redirects, assertions, tiers of queries and widening windows, each against a plain walk."""

import datetime
import json
import os
import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gazette.functions import checks
from gazette.operators import gather, redirects, select
from gazette.sources import archive, snapshots
from gazette.streaming import intake

DAY = 86_400
START = datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC)
EVENTS = "id long, chapter string, url string, published timestamp, arrived timestamp"


def _events(draw, n, first, day):
    out = []
    for k in range(n):
        arrived = START + datetime.timedelta(seconds=day * DAY + draw.randint(0, 2 * DAY))
        published = None if draw.random() < 0.05 else arrived - datetime.timedelta(seconds=draw.choice((-DAY, 60, 3_600, 2 * DAY, 4 * DAY, 6 * DAY, 9 * DAY)))
        out.append((first + k, draw.choice(("news", "science")), f"u{draw.randint(0, 9)}", published, arrived))
    return out


def _plain_admission(events):
    until, out = {}, {}
    for i, chapter, url, published, arrived in sorted(events, key=lambda e: (e[4], e[0])):
        most = 7 if chapter == "science" else 3
        age = None if published is None else (arrived - published).total_seconds() / DAY
        if age is None or age < -0.25 or age > most:
            out[i] = "missing_date" if age is None else "future" if age < -0.25 else "stale"
            continue
        free = (chapter, url) not in until or arrived >= until[chapter, url]
        out[i] = "kept" if free else "duplicate"
        if free:
            until[chapter, url] = published + datetime.timedelta(days=most)
    return out


def test_three_batches_keep_and_refuse_what_a_plain_loop_does_and_state_is_dropped(spark, tmp_path):
    draw = random.Random(1)
    batches = [_events(draw, 120, 0, 0), _events(draw, 120, 1_000, 3), _events(draw, 120, 2_000, 6), [(9_000, "news", "last", START + datetime.timedelta(days=60), START + datetime.timedelta(days=60))]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for f in (tmp_path / "in").glob("*.parquet"):
            if f.stat().st_mtime > 2e9 or not f.name.startswith("b"):
                f.rename(tmp_path / "in" / f"b{k}.parquet")
                os.utime(tmp_path / "in" / f"b{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    told = intake.admitted(stream, ["chapter", "url"], "published", "arrived", F.when(F.col("chapter") == "science", 7).otherwise(3), skew="1 day")
    writer = told.writeStream.format("parquet").partitionBy("outcome").option("checkpointLocation", str(tmp_path / "state")).option("path", str(tmp_path / "out"))
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    got = {r.id: r.outcome for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    wanted = _plain_admission([e for b in batches for e in b])
    assert got == wanted and {"kept", "duplicate", "stale", "future", "missing_date"} == set(got.values())
    assert (tmp_path / "out" / "outcome=stale").is_dir()
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(sizes) > 5 and sizes[-1] <= 1  # sixty days later only the last key can have state


def test_keys_share_groups_so_that_calls_do_not_grow_with_keys(spark, tmp_path):
    day = lambda n: START + datetime.timedelta(days=n)
    rows = [(k, "news", f"u{k % 1500}" if k % 1500 else None, day(0), day(1 if k < 1500 else 2)) for k in range(3_000)]
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(str(tmp_path / "in"))
    told = intake.admitted(spark.readStream.schema(EVENTS).parquet(str(tmp_path / "in")), ["chapter", "url"], "published", "arrived", F.lit(3))
    query = told.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert {r.id: r.outcome for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {k: "kept" if k < 1500 else "duplicate" for k in range(3_000)}
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 1_024


EDITION = "chapters array<struct<chapter:string,count:long,articles:array<struct<place:int,seq:long>>>>, articles long"


def test_one_edition_is_rewritten_and_the_other_is_not_touched(spark, tmp_path):
    folder = str(tmp_path / "archive")
    rows = [(e, c, p, 100 * p + n) for n, e in enumerate(("2024-01-08", "2024-01-09")) for c in ("b", "a") for p in (2, 1, 3)]
    df = spark.createDataFrame(rows, "edition string, chapter string, place int, seq long")
    archive.store(archive.fold(df), folder)
    listed = lambda e: {f.name: (f.stat().st_mtime_ns, f.read_bytes()) for f in (tmp_path / "archive" / f"edition={e}").glob("part-*")}
    before = listed("2024-01-09")
    again = archive.fold(df.filter("edition = '2024-01-08' AND place < 3"))
    for _ in range(2):  # a rerun gives the same
        archive.store(again, folder)
        assert listed("2024-01-09") == before
        first = archive.load(spark, folder, EDITION, "2024-01-08").first()
        assert [(c.chapter, c["count"], [a.place for a in c.articles]) for c in first.chapters] == [("a", 2, [1, 2]), ("b", 2, [1, 2])] and first.articles == 4
    assert set(archive.editions(spark, folder)) == {"2024-01-08", "2024-01-09"}
    last = archive.latest(spark, folder, EDITION)
    assert [(r.edition, r.articles) for r in last.collect()] == [("2024-01-09", 6)]
    assert all("edition=2024-01-09" in f for f in last.inputFiles())
    assert archive.load(spark, folder, EDITION).count() == 2
    with pytest.raises(ValueError):
        archive.latest(spark, str(tmp_path / "none"), EDITION)


def _walk(moves, url):
    seen = [url]
    while seen[-1] in moves:
        nxt = moves[seen[-1]]
        if nxt in seen:
            return None, None, min(seen[seen.index(nxt) :])
        seen.append(nxt)
    return seen[-1], len(seen) - 1, None


def test_redirects_equal_a_plain_walk_and_rounds_grow_with_the_logarithm(spark, monkeypatch):
    moves = {"a0": "a1", "b0": "b1", "b1": "b2", "l0": "l1", "l1": "l2", "l2": "l0", "t0": "t1", "t1": "l1", "m5": "m6", "m6": "m5"}
    moves |= {f"c{k}": f"c{k + 1}" for k in range(50)} | {f"d{k}": f"d{k + 1}" for k in range(300)} | {f"h{k}": "c10" for k in range(40)} | {f"z{k}": f"z{(k + 1) % 37}" for k in range(37)}
    rows = [*moves.items(), ("a0", "zz"), ("x", "x"), (None, "y"), ("y", None)]
    df = spark.createDataFrame(rows, "url string, target string").repartition(5)
    turns, plain = [], redirects.settle
    monkeypatch.setattr(redirects, "settle", lambda x: turns.append(1) or plain(x))
    got = {r.url: (r.final_url, r.hops, r.cycle) for r in redirects.resolve(df).collect()}
    assert got == {u: _walk(moves, u) for u in moves}
    assert len(turns) <= 12  # 300 hops
    assert redirects.resolve(df.limit(0)).count() == 0


def test_best_sources_follow_identifiers_only_through_resolvers(spark):
    items = spark.createDataFrame([(1, "10/a", "https://pubmed.example/1"), (2, "10/b", "https://pubmed.example/2"), (3, None, "https://pubmed.example/3"), (4, "10/c", None), (5, "10/d", "https://login.example/5"), (6, " ", "")], "k int, doi string, url string")
    moved = spark.createDataFrame([("https://doi.example/10/a", "https://press.example/a"), ("https://doi.example/10/b", "https://login.example/b"), ("https://pubmed.example/3", "https://other.example/3")], "url string, final_url string")
    got = {r.k: (r.best_url, r.state) for r in redirects.best_source(items, moved, ["doi.example"], ["login"], "https://doi.example/").collect()}
    assert got == {
        1: ("https://press.example/a", "publisher"), 2: ("https://pubmed.example/2", "scholarly"), 3: ("https://pubmed.example/3", "publisher"),
        4: ("https://doi.example/10/c", "unresolved"), 5: ("https://doi.example/10/d", "unresolved"), 6: ("", "unresolved"),
    }


def test_strict_links_stop_at_the_one_that_is_not_found(spark):
    found = spark.createDataFrame([("https://n.example/a/", "https://p.example/1"), ("https://n.example/b", None)], "url string, final_url string")
    rows = spark.createDataFrame([(1, "https://n.example/a?x=1#f"), (2, "https://n.example/a")], "k int, link string")
    assert {r.exact_url for r in redirects.exact(rows, found, strict=True).collect()} == {"https://p.example/1"}
    more = rows.union(spark.createDataFrame([(3, "https://n.example/b")], "k int, link string"))
    assert {r.k: r.exact_url for r in redirects.exact(more, found).collect()}[3] is None
    with pytest.raises(PySparkException, match="no exact address for https://n.example/b"):
        redirects.exact(more, found, strict=True).collect()


def test_assertions_name_the_row(spark):
    df = spark.createDataFrame([(1, 2), (2, None)], "k int, v int")
    with pytest.raises(PySparkException, match="bad 2"):
        checks.must(df, F.col("v") > 0, F.concat(F.lit("bad "), F.col("k").cast("string"))).select("k").collect()
    assert checks.must(df, F.col("k") > 0, "bad").count() == 2
    other = spark.createDataFrame([(1, "a"), (3, "b")], "k int, w string")
    with pytest.raises(PySparkException, match="differ"):
        checks.must_match(df, other, ["k"], "differ").collect()
    assert [tuple(r) for r in checks.must_match(df.filter("k = 1"), other.filter("k = 1"), ["k"], "differ").collect()] == [(1, 2, "a")]


def test_gold_rows_stop_at_broken_and_half_ones(spark, tmp_path):
    good = tmp_path / "good.jsonl"
    good.write_text('{"id": "a", "kind": "label", "expected": "keep"}\n\n  \n{"id": "b", "kind": "pair", "expected": "same", "a": "x"}\n')
    assert {(r.id, r.expected, r.a) for r in snapshots.gold(spark, str(good), "a string").collect()} == {("a", "keep", None), ("b", "same", "x")}
    for name, line, said in (("half", '{"id": "c", "kind": "label"}', "gold row without"), ("broken", '{"id": "c", ', "(?i)malformed|json")):
        (tmp_path / name).write_text(good.read_text() + line)
        with pytest.raises(Exception, match=said):  # the reader's own error is no PySparkException
            snapshots.gold(spark, str(tmp_path / name)).collect()


@pytest.fixture
def frozen(spark, tmp_path):
    rows = [("2024-01-09", c, p, (10 * p,)) for c in ("b", "a", "c") for p in (3, 1, 2)]
    folder = str(tmp_path / "snapshot")
    snapshots.freeze(spark.createDataFrame(rows, "edition string, chapter string, place int, row struct<seq:long>").coalesce(1), folder)
    return folder


def _changed(folder, part, change):
    for path in [os.path.join(d, f) for d, _, names in os.walk(os.path.join(folder, part)) for f in names if f.endswith(".json")]:
        with open(path) as file:
            lines = [change(json.loads(x)) for x in file]
        with open(path, "w") as file:
            file.writelines(json.dumps(x) + "\n" for x in lines)
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)


def test_snapshots_come_back_in_order_and_stop_where_they_differ(spark, frozen):
    kind = "struct<seq:long>"
    assert [(r.chapter, r.pos, r.row.seq) for r in snapshots.materialise(spark, frozen, kind).orderBy("pos").collect()] == [(c, 3 * k + p, 10 * p) for k, c in enumerate("abc") for p in (1, 2, 3)]
    for part, change, said in (
        ("chunks/chapter=b", lambda x: x | {"selected": x["selected"][:2]}, "wrong count of chunk b"), ("chunks/chapter=b", lambda x: x | {"edition": "2024-01-08", "selected": [{"seq": 1}] * 3}, "wrong edition of chunk b"),
        ("chunks/chapter=b", lambda x: x | {"edition": "2024-01-09", "of": "a"}, "wrong chapter of chunk b"),
    ):
        _changed(frozen, part, change)
        with pytest.raises(PySparkException, match=said):
            snapshots.materialise(spark, frozen, kind).collect()
    _changed(frozen, "chunks/chapter=b", lambda x: x | {"of": "b"})
    _changed(frozen, "manifest", lambda x: x | {"selected_count": 8})
    with pytest.raises(PySparkException, match="sum is not 9"):
        snapshots.materialise(spark, frozen, kind).collect()
    _changed(frozen, "manifest", lambda x: x | {"selected_count": 6, "files": x["files"][:2]})
    with pytest.raises(PySparkException, match="differ at"):
        snapshots.materialise(spark, frozen, kind).collect()


def _plain_gather(rows):
    out = set()
    for grp in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == grp and r[1] is not None), key=lambda r: (r[3], r[4]))
        held, seen = [], set()

        def take(part):
            for r in part:
                if r[1] not in seen:
                    seen.add(r[1])
                    held.append(r)

        of = lambda tier, step=None: [r for r in mine if r[2] == tier and step in (None, r[3])]  # noqa: B023, E731
        take(sorted(of("topic"), key=lambda r: r[4]))
        for step in range(8):
            take(of("query", step))
            if len(held) >= 12:
                break
        if len(held) < 6:
            for step in range(4):
                take(of("fallback", step))
                if len(held) >= 8:
                    break
        out.update((r[0], r[1], r[2], r[4]) for r in held)
        if sum(r[5] for r in held) < 5:
            first = {}
            for r in of("rescue"):
                first.setdefault(r[1], r)
            out.update((r[0], r[1], r[2], r[4]) for r in first.values())
    return out


def test_tiers_equal_a_plain_loop(spark):
    draw = random.Random(4)
    rows = []
    for g in range(30):
        for _ in range(draw.choice((0, 2, 8, 30, 60))):
            tier = draw.choice(("topic", "query", "query", "query", "fallback", "rescue"))
            step = draw.randint(0, {"topic": 1, "query": 7, "fallback": 3, "rescue": 2}[tier])
            rows.append((f"g{g}", draw.choice([None, *(f"l{k}" for k in range(25))]), tier, step, len(rows), draw.random() < 0.5))
    df = spark.createDataFrame(rows, "grp string, link string, tier string, step int, seq long, fresh boolean").repartition(5)
    got = gather.gathered(df, "grp", "link", 12, 6, 8, 5).collect()
    assert Counter((r.grp, r.link, r.tier, r.seq) for r in got) == Counter(_plain_gather(rows))
    assert gather.gathered(df.limit(0), "grp", "link").count() == 0


def _plain_diverse(rows, target, least, cap):
    ranked = sorted(rows, key=lambda r: (-r[2], r[1]))
    chosen, topics, domains = [], Counter(), set()
    for phase in range(3):
        for r in ranked:
            if len(chosen) >= target or (phase == 0 and len(domains) >= least):
                break
            if r in chosen or topics[r[3]] >= cap or (phase == 0 and r[4] in domains) or (phase == 1 and topics[r[3]]):
                continue
            chosen.append(r)
            topics[r[3]] += 1
            domains.add(r[4])
        if phase == 0 and len(domains) < least:
            return []
    return chosen if len(chosen) == target and len(domains) >= least else []


def test_widening_windows_equal_a_plain_walk_over_one_scan(spark):
    draw = random.Random(5)
    rows = [(f"g{g}", k, draw.randint(0, 9), f"t{draw.randint(0, 4)}", f"d{draw.randint(0, 5)}", draw.choice((1, 5, 6, 9, 13, 20, 40, None))) for g in range(8) for k in range(draw.choice((4, 10, 25, 60)))]
    df = spark.createDataFrame(rows, "grp string, seq long, score int, topic string, domain string, age int").withColumn("turn", -F.col("seq"))
    choose = lambda x, by: select.domain_diverse(x, by, "domain", "topic", ["score", "turn"], 6, 3, 2)
    got = {(r.grp, r.window_days, r.pick, r.seq) for r in gather.widening(df, ["grp"], "age", (7, 14, 30), choose, 6).collect()}
    wanted = set()
    for g in {r[0] for r in rows}:
        for days in (7, 14, 30):
            chosen = _plain_diverse([r for r in rows if r[0] == g and r[5] is not None and r[5] <= days], 6, 3, 2)
            if chosen:
                wanted.update((g, days, k + 1, r[1]) for k, r in enumerate(chosen))
                break
    assert got == wanted and len({w[1] for w in wanted}) > 1
