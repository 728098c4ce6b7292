"""Constrained top-k: greedy selection under caps and conflicts, and its forms that plain windows express."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.functions import text
from gazette.functions.lineage import settle


#: Chapters of all editions, up to which their turns are broadcast as one small table.
BROADCAST_CHAPTERS = 100_000
#: Rows of a group that one fold walks through; groups that it does not fill go on in rounds.
PREFIX = 256


def greedy_select(
    df: DataFrame, group: list[str], order: list[str], target: int, caps: dict[str, int] | None = None, conflict: Callable[[str, str], Column] | None = None, columns: list[str] | None = None,
    seed: DataFrame | None = None, likeness: Callable[[Column, Column], Column] | None = None, on: str = "tokens", hashed: bool = False,
) -> DataFrame:
    """Of each group the first ``target`` rows by ``order`` (descending) that fit those chosen before; ``pick`` is their turn, from 1.

    A row fits if its value of each column in ``caps`` was chosen less often than the cap, and if ``conflict(a, b)``
    (of aliases of a chosen row and the row) or ``likeness(x, y)`` (of their columns ``on``) is not true. ``order`` must
    end with a column that tells rows apart.

    Greedy picks come in the order of the rows, so that a group that the first PREFIX rows fill needs no more of them:
    with ``likeness``, these rows (a bounded number, cut by a rank in each partition before they are brought together)
    are walked through by one fold. Groups that are not full then, and selections by ``conflict``, go on in rounds: the
    i-th pick is the best row that fits picks 1..i-1, so at most ``target`` rounds do. Each takes the best row of each
    group by a partial aggregate and drops what no longer fits. ``df`` is read again for those rounds alone.

    With ``hashed`` the fold compares 64-bit hashes of the elements of ``on``; ``likeness`` must not name elements then.

    Rows of ``seed`` (columns of ``df``, at most ``target`` a group) count as chosen before: they fill places, caps and
    conflicts, and come first in the result.
    """
    columns = columns or df.columns
    if likeness is not None:
        by_alias = lambda a, b: likeness(F.col(f"{a}.{on}"), F.col(f"{b}.{on}"))
        chosen, rest = _folded(df, group, order, target, caps, likeness, on, seed, hashed)
        if rest.isEmpty():
            return chosen.select(*columns, "pick")
        open_groups = rest.select(*group).distinct()
        done = chosen.join(open_groups, group, "left_anti")
        more = _rounds(rest, group, order, target, caps, by_alias, chosen.join(open_groups, group, "left_semi"))
        return done.select(*columns, "pick").unionByName(more.select(*columns, "pick"))
    if seed is not None:
        kept = Window.partitionBy(*group).orderBy(*[F.desc(o) for o in order])
        seed = seed.select(*df.columns).withColumn("pick", F.row_number().over(kept))
    return _rounds(df, group, order, target, caps, conflict, seed).select(*columns, "pick")


def _folded(
    df: DataFrame, group: list[str], order: list[str], target: int, caps: dict[str, int] | None, likeness: Callable[[Column, Column], Column], on: str, seed: DataFrame | None, hashed: bool,
) -> tuple[DataFrame, DataFrame]:
    """The picks among the first PREFIX rows of each group, with those of ``seed``; and the further rows of groups that are not full.

    The limit stands on the rank, so that partitions cut groups to it before they are shuffled; only these rows are
    written. The fold walks over places, capped columns and ``on`` (or hashes of its elements); the rows of its
    picks are joined back. Rows beyond are those below a group's last row walked through: a filter, no second rank.
    """
    best = [F.desc(o) for o in order]
    if seed is not None:
        df = df.join(seed.select(*group, *order), [*group, *order], "left_anti").select(df.columns)
    hashes = F.transform(on, lambda t: F.xxhash64(t)) if hashed else F.col(on)
    placed = df.withColumn("__place", F.row_number().over(Window.partitionBy(*group).orderBy(*best))).filter(F.col("__place") <= PREFIX)
    few = settle(placed.withColumn("__hashes", hashes))
    slim = F.struct("__place", *[F.col(f"`{c}`") for c in caps or {}], "__hashes")
    walk = few.groupBy(*group).agg(F.sort_array(F.collect_list(slim)).alias("rows"), F.min_by(F.struct(*order), F.struct(*order)).alias("__last"))
    kind = f"array<{few.select(slim.alias('x')).schema['x'].dataType.simpleString()}>"
    start = F.array().cast(kind)
    first = None
    if seed is not None:
        kept = Window.partitionBy(*group).orderBy(*best)
        first = settle(seed.select(*df.columns).withColumns({"__place": -F.row_number().over(kept), "__hashes": hashes}))  # places below 0, the best the highest
        held = first.groupBy(*group).agg(F.reverse(F.sort_array(F.collect_list(slim))).alias("held"))
        walk = walk.join(held, group, "full").withColumn("rows", F.coalesce("rows", F.array().cast(kind)))
        start = F.coalesce(F.col("held").cast(kind), start)

    def step(chosen: Column, x: Column) -> Column:
        fits = (F.size(chosen) < target) & ~F.exists(chosen, lambda c: F.coalesce(likeness(c["__hashes"], x["__hashes"]), F.lit(False)))
        for column, cap in (caps or {}).items():
            fits = fits & (F.size(F.filter(chosen, lambda c: c[column].eqNullSafe(x[column]))) < cap)  # noqa: B023
        return F.when(fits, F.concat(chosen, F.array(x))).otherwise(chosen)

    got = settle(walk.select(*group, F.transform(F.aggregate("rows", start, step), lambda x: x["__place"]).alias("chosen"), F.size("rows").alias("__seen"), "__last"))
    turns = got.select(*group, F.posexplode("chosen").alias("__at", "__place"))
    known = few if first is None else few.unionByName(first)
    picks = known.join(turns, [*group, "__place"]).select(*df.columns, (F.col("__at") + 1).alias("pick"))
    short = got.filter((F.size("chosen") < target) & (F.col("__seen") == PREFIX)).select(*group, "__last")
    if short.isEmpty():
        return picks, df.limit(0)
    rest = df.join(short, group).filter(F.struct(*order) < F.col("__last")).select(df.columns)
    return picks, settle(rest)


def _rounds(df: DataFrame, group: list[str], order: list[str], target: int, caps: dict[str, int] | None, conflict: Callable[[str, str], Column] | None, seed: DataFrame | None) -> DataFrame:
    """The picks of each group, round by round, after those of ``seed``, which has their ``pick``."""
    left = settle(df)
    chosen: DataFrame | None = None
    if seed is not None:
        chosen = settle(seed.select(*df.columns, "pick"))
        left = settle(_fitting(left, chosen, chosen, group, order, caps, conflict, target))
    for turn in range(1, target + 1):
        best = left.groupBy(*group).agg(F.max_by(F.struct(*left.columns), F.struct(*order)).alias("best"))
        place = F.lit(turn)
        if seed is not None:
            held = chosen.groupBy(*group).agg(F.max("pick").alias("__held"))
            best, place = best.join(held, group, "left"), F.coalesce("__held", F.lit(0)) + 1
        best = settle(best.select("best.*", place.alias("pick")))
        if best.isEmpty():
            break
        chosen = best if chosen is None else chosen.unionByName(best)
        if turn == target:
            break
        left = settle(_fitting(left, best, chosen, group, order, caps, conflict, target if seed is not None else None))
    return chosen if chosen is not None else settle(df.limit(0).withColumn("pick", F.lit(0)))


def _fitting(
    left: DataFrame, new: DataFrame, chosen: DataFrame, group: list[str], order: list[str], caps: dict[str, int] | None, conflict: Callable[[str, str], Column] | None, target: int | None,
) -> DataFrame:
    """Rows of ``left`` that are not among ``new``, clash with none of them, and stay within the caps and, if given, the target."""
    same_group = [F.col(f"b.{g}").eqNullSafe(F.col(f"r.{g}")) for g in group]
    same_row = F.lit(True)
    for o in order:
        same_row = same_row & F.col(f"b.{o}").eqNullSafe(F.col(f"r.{o}"))
    bad = same_row | F.coalesce(conflict("b", "r"), F.lit(False)) if conflict else same_row
    clash = bad
    for same in same_group:
        clash = clash & same
    rest = left.alias("r").join(new.alias("b"), clash, "left_anti")
    for column, cap in (caps or {}).items():
        full = chosen.groupBy(*group, column).count().filter(F.col("count") >= cap).drop("count")
        rest = rest.join(full, [*group, column], "left_anti").select(left.columns)
    if target is not None:
        full = chosen.groupBy(*group).count().filter(F.col("count") >= target).drop("count")
        rest = rest.join(full, group, "left_anti").select(left.columns)
    return rest


def domain_diverse(df: DataFrame, group: list[str], domain: str, topic: str, order: list[str], target: int, least: int, cap: int) -> DataFrame:
    """``target`` rows of each group in three passes, none of a topic more than ``cap`` times; ``pick`` is their turn.

    First rows of new domains until there are ``least``, then the best row of each topic not yet met, then the best of
    the rest. Groups with fewer rows or domains are empty. Only the first pass takes rounds; the others are windows.
    """
    best = [F.desc(o) for o in order]
    first = settle(greedy_select(df, group, order, least, {domain: 1, topic: cap}))
    met = first.groupBy(*group, topic).count().withColumnRenamed("count", "__met")
    rest = df.join(first.select(*group, *order), [*group, *order], "left_anti").join(met, [*group, topic], "left")
    rest = rest.withColumn("__place", F.row_number().over(Window.partitionBy(*group, topic).orderBy(*best)) + F.coalesce("__met", F.lit(0))).filter(F.col("__place") <= cap)
    turn = Window.partitionBy(*group).orderBy(F.when(F.col("__met").isNull() & (F.col("__place") == 1), 0).otherwise(1), *best)
    held = first.groupBy(*group).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= least)
    more = rest.join(held, group).withColumn("pick", (F.row_number().over(turn) + F.col("__n")).cast("int"))
    both = first.unionByName(more.filter(F.col("pick") <= target).select(first.columns))
    full = both.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"), F.count_distinct(domain).alias("__d")).filter((F.col("__n") == target) & (F.col("__d") >= least)).select(*group)
    return both.join(full, group, "left_semi")


def allocate(
    df: DataFrame, edition: str, chapter: str, key: str, order: list[str], target: int, caps: dict[str, int], likeness: Callable[[Column, Column], Column], least: tuple[str, int] | None = None, place: Column | None = None,
) -> DataFrame:
    """Greedy picks of each chapter of an edition, chapters with the fewest different ``key`` values first, then by ``place``; a key goes to one chapter.

    All editions take their turn together, so that there are as many passes as the edition with most chapters has. A
    chapter that ends with fewer than ``least`` (column, number) different values is empty and reserves nothing.
    """
    scarce = df.groupBy(edition, chapter).agg(F.count_distinct(key).alias("__n"), F.min(place if place is not None else F.col(chapter)).alias("__at"))
    scarce = settle(scarce.withColumn("__turn", F.row_number().over(Window.partitionBy(edition).orderBy("__n", "__at"))).drop("__n", "__at"))
    turns = scarce.agg(F.max("__turn")).first()[0] or 0
    small = scarce.count() <= BROADCAST_CHAPTERS
    placed = settle(df.join(F.broadcast(scarce) if small else scarce, [edition, chapter]))
    got = settle(df.limit(0).withColumn("pick", F.lit(0)))
    for turn in range(1, turns + 1):
        pool = placed.filter(F.col("__turn") == turn).select(df.columns)
        pool = pool.join(got.select(edition, key).distinct(), [edition, key], "left_anti").select(df.columns)
        new = greedy_select(pool, [edition, chapter], order, target, caps, likeness=likeness)
        if least is not None:
            new = at_least(new, [edition, chapter], *least).select(*df.columns, "pick")
        got = settle(got.unionByName(new))
    return got


def arbitrate(df: DataFrame, key: str, chapter: str, title: str, seq: str, terms: dict[str, list[str]], company: str = "company", economy: str = "economy", international: str = "international") -> DataFrame:
    """``df`` with chapters (of its key), winner (null without a conflict) and kept.

    A key that several chapters have goes to one: to ``company`` if that is among them and a title has one of its terms;
    else, where both are among them, to ``economy`` if a title has one of its terms, to ``international`` if not; else to
    the chapter of the first row by ``seq``. The winner keeps its first row. Keys of one chapter keep all rows.
    """
    norm = text.norm_title(F.col(title))
    has = lambda name: F.size(text.term_hits(norm, terms.get(name, []))) > 0 if terms.get(name) else F.lit(False)
    g = df.groupBy(key).agg(
        F.count_distinct(chapter).alias("chapters"), F.bool_or(F.col(chapter) == company).alias("__co"), F.bool_or(F.col(chapter) == economy).alias("__ec"), F.bool_or(F.col(chapter) == international).alias("__in"),
        F.bool_or(has(company)).alias("__coterm"), F.bool_or(has(economy)).alias("__ecterm"), F.min_by(chapter, seq).alias("__first"),
    )
    winner = F.when(F.col("__co") & F.col("__coterm"), company).when(F.col("__in") & F.col("__ec"), F.when(F.col("__ecterm"), economy).otherwise(international)).otherwise(F.col("__first"))
    g = g.select(key, "chapters", winner.alias("winner"))
    keeper = df.groupBy(key, chapter).agg(F.min(seq).alias("__keeper"))
    g = g.join(keeper.select(F.col(key).alias("__k"), F.col(chapter).alias("__c"), "__keeper"), F.col(key).eqNullSafe(F.col("__k")) & (F.col("winner") == F.col("__c")))
    g = g.select(F.col(key).alias("__k"), "chapters", "winner", "__keeper")
    met = df.join(g, F.col(key).eqNullSafe(F.col("__k")))
    return met.select(*df.columns, "chapters", F.when(F.col("chapters") > 1, F.col("winner")).alias("winner"), ((F.col("chapters") == 1) | (F.col(seq) == F.col("__keeper"))).alias("kept"))


def refill(
    kept: DataFrame, ranked: DataFrame, chapter: str, key: str, order: list[str], target: int, caps: dict[str, int], likeness: Callable[[Column, Column], Column], chapters: list[str], edition: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Chapters filled up after an arbitration: the rows with mode (kept, backfill, rebuilt) and pick; and (edition,) chapter, reason, n of what was passed over.

    ``kept`` has columns of ``ranked``. Chapters take their turn in the order of ``chapters`` (a short list), those of all
    editions together: there are as many passes as chapters, however many editions. A row is passed over if its ``key`` is
    used anywhere in its edition (global_url), its caps are full (domain_cap), or it is like a chosen row (same_event). A
    chapter that cannot be filled beside what it kept is built anew from its whole pool; reasons of this second walk
    begin with resolve_. Without ``edition`` all rows are one.
    """
    of = edition or "__edition"
    columns = ranked.columns
    if edition is None:
        kept, ranked = kept.withColumn(of, F.lit(0)), ranked.withColumn(of, F.lit(0))
    whole, group = [*columns, *([of] if edition is None else [])], [of, chapter]
    kept, ranked = settle(kept.select(whole)), settle(ranked.select(whole))
    used = kept.select(of, chapter, key)
    outs: list[DataFrame] = []
    reasons: list[DataFrame] = []
    sizes = lambda df: df.groupBy(of).agg(F.count(F.lit(1)).alias("__n"))
    for name in chapters:
        mine, pool = kept.filter(F.col(chapter) == name), ranked.filter(F.col(chapter) == name)
        # Editions whose chapter is not full: those that have kept fewer, or nothing though there is a pool.
        open_ = settle(pool.select(of).union(mine.select(of)).distinct().join(sizes(mine), of, "left").filter(F.coalesce("__n", F.lit(0)) < target).select(of))
        full = mine.join(open_, of, "left_anti").select(*whole, F.lit(0).alias("pick"), F.lit("kept").alias("mode"))
        mine, pool = mine.join(open_, of, "left_semi"), pool.join(open_, of, "left_semi")
        free = pool.join(used.select(of, key).distinct(), [of, key], "left_anti").select(whole)
        got = greedy_select(free, group, order, target, {**caps, key: 1}, likeness=likeness, seed=mine.select(whole))
        got = settle(got.join(mine.select(of, key, F.lit("kept").alias("mode")), [of, key], "left").select(*whole, "pick", F.coalesce("mode", F.lit("backfill")).alias("mode")))
        reasons.append(passed_over(pool, got, used, chapter, key, order, caps, likeness, target, "", of))
        short = settle(open_.join(sizes(got), of, "left").filter(F.coalesce("__n", F.lit(0)) < target).select(of))
        again = pool.join(short, of, "left_semi").select(whole)
        others = used.filter(F.col(chapter) != name).join(short, of, "left_semi").select(used.columns)
        free = again.join(others.select(of, key).distinct(), [of, key], "left_anti").select(whole)
        new = settle(greedy_select(free, group, order, target, {**caps, key: 1}, likeness=likeness).select(*whole, "pick", F.lit("rebuilt").alias("mode")))
        reasons.append(passed_over(again, new, others, chapter, key, order, caps, likeness, target, "resolve_", of))
        got = got.join(short, of, "left_anti").select(new.columns).unionByName(new)
        dropped = used.filter(F.col(chapter) == name).join(short, of, "left_semi").select(used.columns)
        kept_on = used.join(dropped, used.columns, "left_anti").select(used.columns)
        used = settle(kept_on.unionByName(got.filter("mode <> 'kept'").select(used.columns)))
        outs += [full, got]
    out, told = reduce(DataFrame.unionByName, outs), reduce(DataFrame.unionByName, reasons)
    return out.select(*columns, "pick", "mode"), told if edition else told.drop(of)


def passed_over(
    pool: DataFrame, got: DataFrame, used: DataFrame, chapter: str, key: str, order: list[str], caps: dict[str, int], likeness: Callable[[Column, Column], Column], target: int, prefix: str, edition: str | None = None,
) -> DataFrame:
    """(edition,) chapter, reason, n: rows of ``pool`` that a walk in ``order`` passed over until it was full, and the first test that each failed.

    Each row is compared with the chosen rows of its edition (``target`` a chapter at most) that were chosen before it.
    """
    if edition is None:
        one = lambda df: df.withColumn("__edition", F.lit(0))
        return passed_over(one(pool), one(got), one(used), chapter, key, order, caps, likeness, target, prefix, "__edition").drop("__edition")
    rank = F.struct(*order)
    held = got.select("mode", F.col(edition).alias("__e"), F.col(chapter).alias("__c"), F.col(key).alias("__key"), rank.alias("__rank"), *[F.col(c).alias(f"__{c}") for c in caps], F.col("tokens").alias("__tokens"))
    full = got.groupBy(edition, chapter).agg(F.count(F.lit(1)).alias("__n"), F.min(F.when(F.col("mode") != "kept", rank)).alias("__last"))
    rows = pool.join(got.select(edition, *order), [edition, *order], "left_anti").join(full, [edition, chapter], "left").filter((F.coalesce("__n", F.lit(0)) < target) | F.col("__last").isNull() | (rank > F.col("__last")))
    rows = rows.join(used.select(F.col(edition).alias("__u"), F.col(key).alias("__used")).distinct(), (F.col(edition) == F.col("__u")) & (F.col(key) == F.col("__used")), "left")
    before = (F.col("mode") == "kept") | (F.col("__rank") > rank)
    met = rows.join(held, (F.col(edition) == F.col("__e")) & (F.col(chapter) == F.col("__c")) & before, "left")
    taken = F.max(F.coalesce(F.col("__key") == F.col(key), F.lit(False)) | F.col("__used").isNotNull())
    capped = F.lit(False)
    for c, cap in caps.items():
        capped = capped | (F.count_if(F.col(f"__{c}") == F.col(c)) >= cap)
    near = F.max(F.coalesce(likeness(F.col("__tokens"), F.col("tokens")), F.lit(False)))
    told = met.groupBy(edition, chapter, *order).agg(F.when(taken, "global_url").when(capped, "domain_cap").when(near, "same_event").alias("reason"))
    return told.filter("reason IS NOT NULL").groupBy(edition, chapter, F.concat(F.lit(prefix), "reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def at_least(df: DataFrame, group: list[str], column: str, least: int) -> DataFrame:
    """Rows of the groups that have ``least`` different values of ``column``; other groups are empty."""
    good = df.groupBy(*group).agg(F.count_distinct(column).alias("__n")).filter(F.col("__n") >= least).drop("__n")
    return df.join(good, group, "left_semi")


def capped_top(df: DataFrame, group: list[str], capped: str, cap: int, target: int, order: list[Column]) -> DataFrame:
    """Caps alone need no rounds: rank within (group, capped) up to ``cap``, then within the group up to ``target``."""
    inner = Window.partitionBy(*group, capped).orderBy(*order)
    kept = df.withColumn("__r", F.row_number().over(inner)).filter(F.col("__r") <= cap).drop("__r")
    return kept.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("rank") <= target)


def one_each_then_fill(df: DataFrame, group: list[str], part: str, target: int, order: list[Column]) -> DataFrame:
    """The best of each part first, then the best of the rest, ``target`` in all."""
    ranked = df.withColumn("__r", F.row_number().over(Window.partitionBy(*group, part).orderBy(*order)))
    first = [(F.col("__r") > 1).asc(), *order]
    top = Window.partitionBy(*group).orderBy(*first) if group else Window.orderBy(*first)
    few = ranked.filter(F.col("__r") <= target)
    if not group:  # without groups the final order is over target rows of each part, not over all
        return few.orderBy(*first).limit(target).withColumn("rank", F.row_number().over(top)).drop("__r")
    return few.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= target).drop("__r")


def keep_first(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter(F.col("__r") == 1).drop("__r")


def keep_first_either(df: DataFrame, group: str, left: str, right: str, seq: str) -> DataFrame:
    """Rows in order of ``seq`` that share neither ``left`` nor ``right`` with a row kept before them in their group.

    Only kept rows count, so that two ``dropDuplicates`` would drop too much. Round by round, a row whose earlier rows
    with its keys are all settled is settled too: it is kept unless one of those was kept. Rows that are first in both
    keys are settled at once, so that a few rounds do.
    """
    open_ = settle(df)
    kept: DataFrame | None = None
    while True:
        # Least numbers are aggregated before they are shuffled: one key may have most of the rows.
        first = lambda c: open_.groupBy(group, c).agg(F.min(seq).alias(seq)).select(group, seq)  # noqa: B023, E731
        new = settle(first(left).join(first(right), [group, seq]).join(open_, [group, seq]).select(df.columns))
        if new.isEmpty():
            return kept if kept is not None else new
        kept = new if kept is None else kept.unionByName(new)
        rest = open_.join(new.select(group, left), [group, left], "left_anti").join(new.select(group, right), [group, right], "left_anti")
        open_ = settle(rest.select(df.columns))
