"""Pictures, cached videos and trending words against plain rules."""

import datetime
import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gazette.operators import trends
from gazette.sources import pictures, videos

PNG, JPEG, GIF, WEBP = bytes.fromhex("89504E470D0A1A0A"), bytes.fromhex("FFD8FFE0"), b"GIF89a", b"RIFF\x10\x20\x30\x40WEBP"
SVG = b'<?xml version="1.0"?>\n<!-- drawn -->\n<svg xmlns="http://www.w3.org/2000/svg">'


def test_kinds_and_hashes_of_stored_pictures(spark, tmp_path):
    fill = bytes(random.Random(1).randrange(256) for _ in range(2_000))
    stored = {"a.png": PNG + fill, "b.jpg": JPEG + fill, "c.gif": GIF + fill, "d.webp": WEBP + fill, "e.svg": SVG + fill, "f.png": PNG + fill[:100], "g.png": b"no picture" + fill, "big.png": PNG + fill * 60}
    (tmp_path / "sub").mkdir()
    for name, content in stored.items():
        (tmp_path / ("sub" if name < "c" else "") / name).write_bytes(content)
    heads = {r.path.rsplit("/", 1)[1]: r for r in pictures.read(spark, str(tmp_path)).collect()}
    assert set(heads) == set(stored) and len(heads["big.png"].head) == 96_000 and heads["big.png"].size == len(stored["big.png"])
    log = [(n, n, 200, "image/png", None, bytes(heads[n].head)) for n in stored] + [
        ("partial", "x", 206, "IMAGE/JPEG; charset=x", None, stored["b.jpg"]), ("gone", "x", 404, "image/png", None, stored["a.png"]), ("slow", None, None, None, "TIMEOUT", None), ("none", None, None, None, None, None),
        ("page", "x", 200, "text/html", None, stored["a.png"]), ("icon", "x", 200, "image/x-icon", None, stored["a.png"]), ("untyped", "x", 200, None, None, stored["a.png"]), ("empty", "x", 200, "image/png", None, None),
    ]
    df = spark.createDataFrame(log, "url string, final_url string, http_status int, content_type string, error_class string, head binary")
    got = {r.url: (r.image_status, r.image_type, r.image_hash) for r in pictures.verified(df).collect()}
    digest = lambda name: hashlib.sha256(stored[name][:96_000]).hexdigest()
    assert got == {
        "a.png": ("VERIFIED", "image/png", digest("a.png")), "b.jpg": ("VERIFIED", "image/jpeg", digest("b.jpg")), "c.gif": ("VERIFIED", "image/gif", digest("c.gif")), "d.webp": ("VERIFIED", "image/webp", digest("d.webp")),
        "e.svg": ("NON_RASTER_IMAGE", None, None), "f.png": ("TOO_SMALL", None, None), "g.png": ("TYPE_MISMATCH", None, None), "big.png": ("VERIFIED", "image/png", digest("big.png")),
        "partial": ("VERIFIED", "image/jpeg", digest("b.jpg")), "gone": ("HTTP_404", None, None), "slow": ("TIMEOUT", None, None), "none": ("UNAVAILABLE", None, None), "page": ("NON_RASTER_IMAGE", None, None),
        "icon": ("NON_RASTER_IMAGE", None, None), "untyped": ("NON_RASTER_IMAGE", None, None), "empty": ("TOO_SMALL", None, None),
    }


def test_cached_videos_under_todays_policy_read_its_folders_only(spark, tmp_path):
    day = datetime.datetime(2024, 1, 25, tzinfo=datetime.UTC)
    said = lambda days: (day - datetime.timedelta(days=days)).strftime("%Y-%m-%dT%H:%M:%SZ")
    ok = lambda n: videos.WATCH % n
    rows = [
        ("c1", "One", "aaaaaa", ok("aaaaaa"), said(1), 9), ("c1", "Uno", "bbbbbb", ok("bbbbbb"), said(1), 9), ("c1", "One", "ccccc", ok("ccccc"), said(1), 9), ("c1", "One", "dddddd", ok("xxxxxx"), said(1), 9), ("c1", "One", "eeeeee", ok("eeeeee"), said(3.1), 9),
        ("c1", "One", "ffffff", ok("ffffff"), said(-0.2), 9), ("c1", "One", "gggggg", ok("gggggg"), said(-0.3), 9), ("c1", "One", "hhhhhh", ok("hhhhhh"), "", 9), ("c1", "One", "iiiiii", ok("iiiiii"), "2024-01-24 or so", 9), ("c1", "One", "jjjjjj", ok("jjjjjj"), None, 9),
        ("c2", "Two", "kkkkkk", ok("kkkkkk"), said(2), 9), ("c3", "Three", "llllll", ok("llllll"), said(1), 9),
    ]
    spark.createDataFrame(rows, "source_id string, channel string, id string, video_url string, published_at string, source_tier int").write.partitionBy("source_id").parquet(str(tmp_path / "v"))
    spark.createDataFrame([("c1", "One", 1, True), ("c2", "Two", 2, True), ("c3", "Three", 3, False), (None, "N", 1, True)], "id string, name string, tier int, live boolean").write.parquet(str(tmp_path / "p"))
    earlier, policy = spark.read.parquet(str(tmp_path / "v")), spark.read.parquet(str(tmp_path / "p")).filter("tier < 3")
    got = videos.cached(earlier, policy, F.lit("2024-01-25 00:00:00 UTC").cast("timestamp"), 3)
    assert {(r.id, r.source_tier, r.retrieval_mode) for r in got.collect()} == {(i, t, "cached_verified") for i, t in (("aaaaaa", 1), ("ffffff", 1), ("iiiiii", 1), ("kkkkkk", 2))}
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString().lower()


def _plain_trending(words, target):
    count, first, category = Counter(), {}, {}
    for seq, pos, word, of in sorted(words, key=lambda w: w[:2]):
        if len(word) >= 2:
            count[word] += 1
            first.setdefault(word, (seq, pos))
            category[word] = of
    best = sorted(count, key=lambda w: (-count[w], first[w]))[:target]
    return [(w, count[w], category[w], k + 1) for k, w in enumerate(best)]


@pytest.mark.parametrize("n, kinds, tracked", [(4_000, 60, 4_096), (4_000, 3_000, 64), (300, 8, 64)])
def test_trending_words_equal_a_plain_count(spark, monkeypatch, n, kinds, tracked):
    """Where the sketch tracks all, where it loses most and all are counted, and where the pool fills up."""
    monkeypatch.setattr(trends, "TRACKED", tracked)
    monkeypatch.setattr(trends, "LOST", 7.0 / (2 * tracked))
    draw = random.Random(n + kinds)
    words = [(k // 5, k % 5, draw.choice(("w", "v")) * (draw.random() < 0.02) or f"w{int(kinds * draw.random() ** 2)}", draw.choice("abc")) for k in range(n)]
    df = spark.createDataFrame(words, "seq long, pos int, word string, category string").repartition(6)
    pool = [("w1", "p"), ("more", "p"), ("more", "q"), ("extra", "q")]
    got = [tuple(r) for r in trends.trending(df, 10, pool).orderBy("rank").collect()]
    wanted = _plain_trending(words, 10)
    extra = [p for p in (("more", "p"), ("extra", "q"))][: 10 - len(wanted)]
    assert got == wanted + [(w, None, c, len(wanted) + k + 1) for k, (w, c) in enumerate(extra)]
    assert trends.trending(df.limit(0), 3, pool[1:]).count() == 2


def test_sketches_of_two_days_merge_to_that_of_both(spark):
    draw = random.Random(3)
    df = spark.createDataFrame([(d, f"w{int(40 * draw.random() ** 2)}") for d in (1, 2) for _ in range(2_000)], "day int, word string")
    parts = trends.sketches(df, ["day"])
    both = trends.sketches(df.withColumn("day", F.lit(0)), ["day"])
    found = lambda p: {(r.word, r.n) for r in trends.candidates(p).collect()}
    assert found(parts) == found(both) and len(found(parts)) == df.select("word").distinct().count()
