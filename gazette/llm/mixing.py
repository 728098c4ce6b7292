"""Mixing sources to target weights by pivotal dependent rounding. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.llm.common import WORD, cut, global_rank, read, unit

#: Sources with this many rows at most are broadcast as one small table (under 10 MB); more are joined by a shuffle.
BROADCAST_SOURCES = 100_000
#: Rows that one node of the reduction tree folds, about.
FAN_IN = 256


def targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """For each source: source, source_size, docs, target.

    Sources in order of their code points, null last, weigh ``weights`` in turn and share ``share`` times the sum of all
    sizes. No target is above ``cap`` times the source's size; what is over goes to the others by weight, until none is
    above. Sums are of whole numbers, so that reruns agree to the last bit.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    ranked = global_rank(per, [F.col("source").isNull().asc(), F.col("source").asc()], "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    per = cut(ranked.select("source", "source_size", "docs", weight.alias("weight")))
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level, above = 0.0, -1
    while True:  # each step caps more sources; a few steps do
        full = F.col("source_size") * cap <= F.col("weight") * F.lit(level)
        n, taken, free = per.agg(F.count_if(full), F.sum(F.when(full, F.col("source_size")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        if n == above or not free:
            break
        level, above = (share * total - cap * taken) / free, n
    target = F.least(F.col("source_size") * cap, F.col("weight") * F.lit(level))
    return per.select("source", "source_size", "docs", target.cast("double").alias("target"))


def _pair(a: Column, b: Column, seed: int) -> Column:
    """One step: mass goes from ``a`` to ``b`` or back until the probability of one is 0 or 1; expected masses stay.

    Returns struct(done, rest). A document's mass is its size times its probability, so that the sum of the words kept.
    """
    give, take = (1 - a.p) * a.w, b.p * b.w  # a rises by at most `give`, b falls by at most `take`
    back, room = a.p * a.w, (1 - b.p) * b.w
    rise, fall = F.least(give, take), F.least(back, room)
    draw = unit(F.lit(seed), a.id, b.id, a.w, b.w)
    a_rises = F.when(rise + fall > 0, draw * (rise + fall) < fall).otherwise(False)
    made = lambda x, p: F.struct(x.id.alias("id"), x.w.alias("w"), p.cast("double").alias("p"))
    bound = lambda p: F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))
    step = lambda done, rest: F.struct(done.alias("done"), rest.alias("rest"))
    return F.when(
        a_rises,
        F.when(give <= take, step(made(a, F.lit(1.0)), made(b, bound(b.p - give / b.w)))).otherwise(step(made(b, F.lit(0.0)), made(a, bound(a.p + take / a.w)))),
    ).otherwise(
        F.when(back <= room, step(made(a, F.lit(0.0)), made(b, bound(b.p + back / b.w)))).otherwise(step(made(b, F.lit(1.0)), made(a, bound(a.p - room / a.w)))),
    )


def _fold(items: Column, seed: int) -> Column:
    """struct(done, rest): all but one of ``items`` with probability 0 or 1, and that one."""
    first = F.element_at(items, 1)
    made = "struct<done:array<struct<id:bigint,w:bigint,p:double>>,rest:struct<id:bigint,w:bigint,p:double>>"

    def step(state: Column, item: Column) -> Column:
        pair = _pair(state.rest, item, seed)
        return F.transform(F.array(pair), lambda x: F.struct(F.concat(state.done, F.array(x.done)).alias("done"), x.rest.alias("rest")))[0].cast(made)

    start = F.struct(F.array().cast("array<struct<id:bigint,w:bigint,p:double>>").alias("done"), first.alias("rest")).cast(made)
    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), start, step)


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 5) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: how often the mix takes each document.

    size counts the words of the text (null: 0). A document of a source with target t and size s gets floor(t/s) copies,
    and one more with the fractional rest as its probability. Pivotal rounding settles the rests: within nodes of about
    ``FAN_IN`` documents, larger ones first, pairs transfer mass until one is settled; each node hands its one open
    document on to the next level of the tree, until each source has a single one, which is drawn by itself. Draws
    depend on ids and sizes alone. A source's words thus miss the target by one document at most, of the small ones.

    A null source is a source of its own. Documents without words take part with 0 words. Repeated rows are rows of
    their own. Without documents there are no rows.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = cut(docs.select(F.col("doc_id").cast("long").alias("id"), "source", size.alias("size")))
    per = cut(targets(sized, weights, share, cap).select("*", F.monotonically_increasing_id().alias("sid")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    per = per.withColumn("base", F.floor(rate)).withColumn("rest", rate - F.col("base"))
    sources, largest = per.agg(F.count(F.lit(1)), F.max("docs")).first()
    near = F.broadcast if sources <= BROADCAST_SOURCES else (lambda x: x)
    joined = sized.join(near(per.select(F.col("source").alias("s"), "sid", "docs", "rest")), F.col("source").eqNullSafe(F.col("s")))
    nodes = -(-(largest or 1) // FAN_IN)
    spread = F.pmod(F.xxhash64(F.lit(seed), "id", "size"), F.greatest(F.lit(1), F.ceil(F.col("docs") / FAN_IN)))
    item = F.struct("id", F.col("size").alias("w"), F.col("rest").alias("p"))
    open_ = joined.filter("size > 0").select("sid", spread.alias("node"), item.alias("x"))
    settled = [joined.filter("size = 0").select("sid", F.struct("id", F.col("size").alias("w"), F.lit(0.0).alias("p")).alias("x"))]
    level = 0
    while True:
        in_turn = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("x.w")).alias("k"), F.xxhash64(F.lit(seed), "x.id").alias("h"), "x"))), lambda y: y.x)
        folded = cut(open_.groupBy("sid", "node").agg(in_turn.alias("xs")).select("sid", "node", _fold(F.col("xs"), seed + level).alias("y")))
        settled.append(folded.select("sid", F.explode("y.done").alias("x")))
        if nodes == 1:
            drawn = F.when(unit(F.lit(seed), F.lit("last"), "y.rest.id", "y.rest.w") < F.col("y.rest.p"), 1.0).otherwise(0.0)
            settled.append(folded.select("sid", F.struct("y.rest.id", "y.rest.w", drawn.alias("p")).alias("x")))
            break
        open_ = folded.select("sid", F.floor(F.col("node") / FAN_IN).alias("node"), F.col("y.rest").alias("x"))
        nodes, level = -(-nodes // FAN_IN), level + 1
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    out = out.join(near(per.drop("docs", "rest")), "sid")
    copies = (F.col("base") + F.col("x.p")).cast("long")
    return out.select(
        F.col("x.id").alias("doc_id"), "source", F.col("x.w").alias("size"), "source_size", "target", copies.alias("copies"), (copies * F.col("x.w")).alias("taken"),
    )


def mix_documents(docs: DataFrame, **settings: object) -> DataFrame:
    """The rows of ``docs``, each as often as :func:`mix` takes it, with their own columns."""
    decided = mix(docs, **settings).select(F.col("doc_id").alias("__id"), F.col("source").alias("__s"), F.col("size").alias("__w"), F.col("copies").alias("__c"))
    nth = lambda order: F.row_number().over(Window.partitionBy("__id", "__s", "__w").orderBy(order))  # noqa: E731  repeated rows share the decisions for them
    decided = decided.withColumn("__n", nth("__c"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__s": F.col("source"), "__w": size})
    keyed = keyed.withColumn("__n", nth("__w"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("__id", "__s", "__w", "__n")]
    joined = keyed.alias("a").join(decided.filter("__c > 0").alias("b"), same)
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("b.__c").cast("int")))).select(*[F.col(f"a.`{c}`") for c in docs.columns])


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
