"""Near-duplicate groups: MinHash with tensored banding, links confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.common import cut, read

#: Bands of each of the two collections, and minhashes of a band. Two sets at similarity 0.8 meet in one of the
#: BANDS^2 tables with probability (1 - (1 - 0.8^WIDTH)^BANDS)^2 = 0.99993, for 2 * BANDS * WIDTH minhashes;
#: as many tables of 2 * WIDTH minhashes each would take BANDS times as many.
BANDS, WIDTH = 10, 2
#: Ids of documents to verify are broadcast up to this many (16 MB), beyond it joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Rows of one part of a key of very many nodes, of a zone of very many, and bytes of the sets in it, at most about; every part meets every other.
PART, ZONE_PART, PART_BYTES = 4_000, 1_000, 4 << 20
#: Of the 2 * BANDS * WIDTH minhashes so many less than expected at the threshold still count as likely: at 0.8 that is
#: 22 of 40, which 0.99991 of all pairs of similarity 0.8 have.
SLACK = 10
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


_SEEDS = _mix((np.arange(2 * BANDS * WIDTH, dtype=np.uint64) + np.uint64(1)) * _A)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted hashes (64 bits) of the distinct ``words``-word shingles of a text; of all its words, if it has fewer.

    A-Z are lower-cased, words are apart by white space of ASCII. No words: no shingles.
    """
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in (text or "").encode("utf-8", "surrogatepass").lower().split()], np.uint64)
    n = len(hashes)
    if not n:
        return hashes
    k = min(words, n)
    out = np.zeros(n - k + 1, np.uint64)
    for place in range(k):
        out = _mix(out * _A + hashes[place : n - k + 1 + place] + np.uint64(place))
    return np.unique(out)


def minhashes(shingles: np.ndarray) -> np.ndarray:
    """The least of the set under each of the 2 * BANDS * WIDTH hash functions."""
    out = np.empty(len(_SEEDS), np.uint64)
    for start in range(0, len(_SEEDS), 8):  # a few at once: whole texts stay in bounded memory
        out[start : start + 8] = _mix(shingles[None, :] ^ _SEEDS[start : start + 8, None]).min(1)
    return out


def _orders() -> np.ndarray:
    """For each table the bands, but for its own two, that order the nodes under one key; others in each table."""
    draw = np.random.default_rng(6)
    tables = [(i, BANDS + j) for i in range(BANDS) for j in range(BANDS)]
    return np.array([draw.permutation([x for x in range(2 * BANDS) if x not in own])[:4] for own in tables])


_ORDERS = _orders()


def table_keys(signatures: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BANDS^2 keys for each row of minhashes: every band of the first collection with every one of the second.

    With each key comes an order: 16 bits of each of four other bands. Under one key alike sets stand side by side in it.
    """
    bands = signatures.reshape(len(signatures), 2 * BANDS, WIDTH)
    half = bands[:, :, 0].copy()
    for k in range(1, WIDTH):
        half = _mix(half * _A + bands[:, :, k])
    table = np.arange(BANDS * BANDS, dtype=np.uint64).reshape(1, BANDS, BANDS)
    keys = _mix(_mix(half[:, :BANDS, None] * _A + half[:, None, BANDS:]) + table * _B)
    keys = (keys & ~np.uint64(127) | table).reshape(len(signatures), -1)  # the last 7 bits tell the table
    short = half >> np.uint64(48)
    order = np.zeros_like(keys)
    for k in range(_ORDERS.shape[1]):
        order = order << np.uint64(16) | short[:, _ORDERS[:, k]]
    return keys, order


def _settled(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df``, written, and read again in partitions of about ``rows`` rows, so that small tables of an iteration are few small files."""
    out = cut(df)
    return out.coalesce(max(4, -(-out.count() // rows)))


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, node, sketch, text_hash: ``node`` is a hash of the whole set (null if empty), ``sketch`` the minhashes."""
    out = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("sketch", pa.binary()), ("text_hash", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, sketches = [], [], []
            for text in batch.column(1):
                found = shingle_set(text.as_py(), words)
                sizes.append(len(found))
                nodes.append(int(np.array(xxhash.xxh3_64_intdigest(found.tobytes()), np.uint64).astype(np.int64)) if len(found) else None)
                sketches.append(minhashes(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sketches, pa.binary()), batch.column(2)], schema=out)

    rows = docs.select(F.col("doc_id").cast("long"), "text", text_hash(F.col("text")).alias("text_hash"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, node long, sketch binary, text_hash long")


def _tables(nodes: DataFrame) -> DataFrame:
    """key, place, node: the table rows of ``nodes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                keys, places = table_keys(np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint64).reshape(part.num_rows, -1))
                at = pa.array(np.repeat(np.arange(part.num_rows), keys.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(places.reshape(-1).view(np.int64)), part.column(0).take(at)], names=["key", "place", "node"])

    return nodes.select("node", "sketch").mapInArrow(run, "key long, place long, node long")


def _shared(nodes: DataFrame) -> DataFrame:
    """key, node, size, beside: the table rows whose key another node has too, how many rows have it, about, and the next node under it.

    Rows are dealt out by ranges of key and order, so that a key that very many nodes share is cut into several
    partitions. Most keys are of one node alone and go no further.
    """
    rows = _tables(nodes)
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, "key", "place", "node").sortWithinPartitions("key", "place", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.empty(0, np.int64)] * 3  # the last key's rows may go on in the next batch

        def shown(columns: list[np.ndarray], goes_on_before: bool, goes_on_after: bool) -> pa.RecordBatch:
            key, _, node = columns
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
            runs = np.diff(np.append(starts, len(key)))
            size = np.repeat(runs, runs)
            keep = size > 1
            if len(key):  # a key may have more rows elsewhere
                keep |= (key == key[0]) & goes_on_before | (key == key[-1]) & goes_on_after
            beside, last = np.append(node[1:], 0), np.append(key[1:] != key[:-1], True)[: len(key)]
            return pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(node[keep]), pa.array(size[keep].astype(np.int64)), pa.array(beside[: len(key)][keep], mask=last[keep])], names=["key", "node", "size", "beside"])

        before = True  # of a partition's first key, rows may be in the one before
        for batch in batches:
            columns = [np.concatenate([h, batch.column(k).to_numpy()]) for k, h in enumerate(held)]
            if not len(columns[0]):
                continue
            # A run that fills a whole batch is handed on in parts, so that memory stays bounded.
            last = int(np.searchsorted(columns[0], columns[0][-1]))
            cut_at = last or len(columns[0])
            yield shown([c[:cut_at] for c in columns], before, not last)
            before = not last
            held = [c[cut_at:] for c in columns]
        yield shown(held, before, True)

    return rows.mapInArrow(run, "key long, node long, size long, beside long")


def _hubs(rows: DataFrame) -> DataFrame:
    """key, hub: of the nodes under each key the most central one, aggregated before the shuffle."""
    return rows.groupBy("key").agg(F.max(F.struct("central", "node")).alias("x"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", F.col("x.node").alias("hub"))


def _ordered(pairs: DataFrame) -> DataFrame:
    """Pairs with the larger node first, each once, and in how many tables."""
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), "n").filter("a <> b")
    return pairs.groupBy("a", "b").agg(F.sum("n").alias("n"))


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """node, comp for every end of the links (a, b): comp is the least node that can be reached.

    Large and small stars in turn: each node links its larger neighbours, then its smaller ones, to the least it knows.
    Least neighbours are aggregated before they are shuffled; links of one node with very many are a skewed join,
    which Spark splits.
    """
    links = _settled(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    parts = max(1, links.rdd.getNumPartitions())
    seen = None
    for _ in range(rounds):
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(parts)
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct().coalesce(parts)
        least = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts)
        near = large.join(least, "u")
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(near.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        links = cut(small.coalesce(parts))
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components are not settled after {rounds} rounds")
    least = links.groupBy("u").agg(F.min("v").alias("comp"))
    roots = links.select(F.col("v").alias("node")).distinct().join(least.select(F.col("u").alias("node")), "node", "left_anti")
    return least.select(F.col("u").alias("node"), "comp").union(roots.select("node", F.col("node").alias("comp")))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, comp, text_hash: groups of documents linked at ``percent`` similarity or more.

    1. Equal sets are one node. Under each table key, nodes that stand side by side and each node with the most central
       one are candidates. Central is a node that has many keys of many nodes: among copies of one text, the text
       that they were made from. Candidates are thus as many as table rows, not as the squares of groups.
    2. Each node is verified against the candidate it meets in most tables; groups of linked nodes are components.
    3. Under keys that hold several components, all pairs across them are looked at in blocks: by size and minhashes.
       Components with a likely pair make a zone; no link leaves a zone. The sets of the nodes of likely pairs are
       brought together once, by zone, and all pairs across components are compared exactly, in blocks again.
       No link depends on which node was central or stood beside, and no key or zone is cut short.

    What can be lost are links that the method itself does not see: two sets at similarity 0.8 share a table with
    probability 0.99993, and pass the minhash test of step 3 with 0.99991. Above 0.8 both come nearer to 1.

    A document without words or with a null text is linked with nothing and is kept. Repeated rows are equal documents:
    they have one component id, and all rows with the doc_id kept. A null doc_id has no part in the least one.
    An empty table gives no rows. Two unequal sets with one 64-bit hash would count as equal.
    """
    docs = docs.select("doc_id", "text")
    base = cut(signatures(docs, words))
    raw = docs.select(F.col("doc_id").cast("long"), "text")
    nodes = _settled(base.filter("node IS NOT NULL").groupBy("node").agg(F.first("sketch").alias("sketch"), F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n")), 10_000)

    met = _settled(_shared(nodes))
    central = _settled(met.groupBy("node").agg(F.sum(F.log2("size")).alias("central")))
    shared = met.select("key", "node").join(central, "node")
    hubs = _settled(_hubs(shared))
    one = F.lit(1).cast("long").alias("n")
    star = lambda rows, hubs: rows.join(hubs, "key").select(F.col("node").alias("a"), F.col("hub").alias("b"), one)
    pairs = met.filter("beside IS NOT NULL").select(F.col("node").alias("a"), F.col("beside").alias("b"), one).unionByName(star(met.select("key", "node"), hubs))
    counted = _ordered(pairs)
    ends = counted.union(counted.select(F.col("b").alias("a"), F.col("a").alias("b"), "n"))
    best = ends.groupBy("a").agg(F.max(F.struct("n", "b")).alias("x")).select("a", F.col("x.b").alias("b"), one)
    best = _settled(_ordered(best).select("a", "b"))
    links = _verified(best, raw, nodes, words, percent)
    comps = _settled(components(links))

    new = _across(met.select("key", "node"), comps, raw, nodes, words, percent)
    if not new.isEmpty():
        comps = _settled(components(links.union(new)))

    groups = base.select("doc_id", "node").filter("node IS NOT NULL").join(comps, "node", "left").select("node", "doc_id", F.coalesce("comp", "node").alias("comp"))
    first = _settled(groups.groupBy("comp").agg(F.min("doc_id").alias("component_id")))
    owner = nodes.select("node").join(comps, "node", "left").select("node", F.coalesce("comp", "node").alias("comp")).join(first, "comp").select("node", "comp", "component_id")
    out = base.select("doc_id", "n_shingles", "node", "text_hash").join(owner, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "comp", "text_hash")


def representatives(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the row with the least doc_id (null: last) and text hash.

    Repeated rows of one document leave once, also of documents without words, which are linked with nothing. A doc_id
    that stands on several texts is told apart by the text.
    """
    found = near_duplicates(docs, words, percent)
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    alone = found.filter("comp IS NULL").select("doc_id", "text_hash").distinct()
    chosen = found.filter("comp IS NOT NULL").groupBy("comp").agg(F.min(rank).alias("x")).select("x.doc_id", "x.text_hash").union(alone)
    times = found.groupBy("doc_id", "text_hash").count()
    same = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & F.col(f"{a}.text_hash").eqNullSafe(F.col(f"{b}.text_hash"))
    chosen = chosen.alias("c").join(times.alias("t"), same("c", "t")).select(F.col("c.doc_id").alias("__id"), F.col("c.text_hash").alias("__hash"), F.col("count").alias("__times"))
    chosen = _settled(chosen)
    keyed = docs.withColumn("__text", text_hash(F.col("text")))
    kept = keyed.join(chosen, keyed["doc_id"].cast("long").eqNullSafe(chosen["__id"]) & (keyed["__text"] == chosen["__hash"]))
    once = kept.filter("__times = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
    again = kept.filter("__times > 1")
    if again.isEmpty():
        return once
    first = again.groupBy("__id", "__hash").agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("x")).select("x.*")
    return once.union(first)


def text_hash(text: Column) -> Column:
    """64 bits that tell texts apart; a null text has one of its own."""
    return F.xxhash64(text, text.isNull())


def _blocks(rows: DataFrame, key: str, parts: Column) -> DataFrame:
    """``rows`` with part and block: the rows of each ``key`` are cut into as many parts as the aggregate ``parts`` tells, and each two parts make a block."""
    many = rows.groupBy(key).agg(F.greatest(F.lit(1), F.ceil(parts)).cast("int").alias("parts"))
    rows = rows.join(many, key).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.least("part", k).cast("long") * (1 << 31) + F.greatest("part", k))
    return rows.withColumn("block", F.explode(others)).drop("parts")


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by key and block (the first two columns), handed on in tables of whole blocks."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        key, block = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        other = np.flatnonzero((key != key[-1]) | (block != block[-1]))
        cut_at = int(other[-1]) + 1 if len(other) else 0
        if cut_at:
            yield rows.slice(0, cut_at)
        held = rows.slice(cut_at)
    if held is not None:
        yield held


def _alike(rows: pa.Table, least: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of two rows of one block and of two components that can be ``percent`` alike by size and have ``least`` equal minhashes.

    The columns are key, block, part, node, comp, n, and short: the last 8 bits of each minhash.
    """
    key, block, part, _, comp, size = (rows.column(k).to_numpy() for k in range(6))
    short = np.frombuffer(b"".join(rows.column(6).to_pylist()), np.uint8).reshape(len(key), -1)
    starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])))
    ends = np.append(starts[1:], len(key))
    end = np.repeat(ends, ends - starts)
    within = (block >> 31) == (block & ((1 << 31) - 1))
    at, step = np.arange(len(key)), 0
    while True:
        step += 1
        at = at[at + step < end[at]]
        if not len(at):
            return
        a, b = size[at], size[at + step]
        p = at[(comp[at] != comp[at + step]) & (within[at] | (part[at] != part[at + step])) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))]
        if not len(p):
            continue
        eights = (short[p] == short[p + step]).view(np.uint64)
        count = (sum(eights[:, k] for k in range(1, eights.shape[1])) + eights[:, 0]) * np.uint64(0x0101010101010101) >> np.uint64(56)
        p = p[count >= least]
        if len(p):
            yield p, p + step


def _root(over: dict[int, int], x: int) -> int:
    """The least number that ``over`` leads to from ``x``; the way is shortened."""
    while x in over:
        over[x] = x = over.get(over[x], over[x])
    return x


def _joined(over: dict[int, int], a: int, b: int) -> bool:
    """Joins the groups of ``a`` and ``b``; whether they were two."""
    a, b = _root(over, a), _root(over, b)
    if a != b:
        over[max(a, b)] = min(a, b)
    return a != b


def linked_rows(items: list[np.ndarray], comp: np.ndarray, side: np.ndarray | None, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of rows of two components whose sets are ``percent`` alike, but for pairs that earlier ones have joined already.

    All pairs across components are compared by the exact size of their intersection: of each set's items, the other rows
    that have them are counted. With ``side``, only rows of two sides are compared.
    """
    size = np.array([len(x) for x in items])
    code = np.unique(np.concatenate(items), return_inverse=True)[1].astype(np.int32)  # half the bytes: a block has some million items at most
    row = np.repeat(np.arange(len(items), dtype=np.int32), size)
    have = row[np.argsort(code, kind="stable")]  # rows by item
    first = np.append(0, np.cumsum(np.bincount(code)))
    edge = np.append(0, np.cumsum(size))
    over: dict[int, int] = {}
    group = comp.copy()
    for p in range(len(items) - 1):
        other = group != group[p]
        other[: p + 1] = False
        if side is not None:
            other &= side != side[p]
        other &= (100 * np.minimum(size, size[p]) >= percent * np.maximum(size, size[p]))
        if not other.any():
            continue
        own = code[edge[p] : edge[p + 1]]
        many = first[own + 1] - first[own]
        place = np.repeat(first[own] - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())
        same = np.bincount(have[place], minlength=len(items))
        changed = False
        for q in np.flatnonzero(other & (100 * same >= percent * (size + size[p] - same))).tolist():
            if _joined(over, int(comp[p]), int(comp[q])):
                changed = True
                yield p, q
        if changed:
            names, at = np.unique(comp, return_inverse=True)
            group = np.array([_root(over, int(x)) for x in names])[at]


def _across(met: DataFrame, comps: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) that join all components which a pair of nodes under one key links: step 3 of :func:`near_duplicates`.

    Blocks of keys give each node of a likely pair with the components that it is likely to be joined to, as one row;
    blocks of zones give links that join components, so that neither grows with the number of pairs.
    """
    rows = met.join(comps.select("node", "comp"), "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    mixed = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key")
    rows = cut(rows.join(mixed, "key"))
    least = int(2 * BANDS * WIDTH * percent / 100) - SLACK

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            short = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint64).astype(np.uint8).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in short], pa.binary())], names=["node", "n", "short"])

    def dealt(rows: DataFrame, key: str) -> DataFrame:
        return rows.repartition(key, "block").sortWithinPartitions(key, "block", "node")

    shorts = nodes.join(rows.select("node").distinct(), "node", "left_semi").select("node", "n", "sketch").mapInArrow(shorten, "node long, n long, short binary")

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_blocks(batches):
            node, comp = rows.column(3).to_numpy(), rows.column(4).to_numpy()
            keep, over = np.zeros(rows.num_rows, bool), {}
            for left, right in _alike(rows, least, percent):
                keep[left] = keep[right] = True
                for a, b in np.unique(np.column_stack([comp[left], comp[right]]), axis=0).tolist():
                    _joined(over, a, b)
            at = np.flatnonzero(keep)
            joined = np.array([_root(over, x) for x in comp[at].tolist()], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(comp[at]), pa.array(joined)], names=["node", "comp", "joined"])

    blocks = _blocks(rows, "key", F.count(F.lit(1)) / PART).join(shorts, "node").select("key", "block", "part", "node", "comp", "n", "short")
    found = _settled(dealt(blocks, "key").mapInArrow(likely, "node long, comp long, joined long").distinct())
    zones = components(found.filter("comp <> joined").select(F.col("comp").alias("a"), F.col("joined").alias("b")))
    zones = zones.select(F.col("node").alias("comp"), F.col("comp").alias("zone"))
    members = _settled(found.select("node", "comp").distinct().join(zones, "comp").join(nodes.select("node", "n"), "node"))
    sets = _sets(members.select("node"), docs, nodes, words)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_blocks(batches):
            zone, block, part, node, comp = (rows.column(k).to_numpy() for k in range(5))
            starts = np.flatnonzero(np.append(True, (zone[1:] != zone[:-1]) | (block[1:] != block[:-1])))
            links = []
            for lo, hi in zip(starts, np.append(starts[1:], len(zone)), strict=True):
                items = [np.frombuffer(x.as_py(), np.uint64) for x in rows.column(5)[lo:hi]]
                side = part[lo:hi] if block[lo] >> 31 != block[lo] & ((1 << 31) - 1) else None
                links += [(node[lo + p], node[lo + q]) for p, q in linked_rows(items, comp[lo:hi], side, percent)]
            yield pa.RecordBatch.from_arrays([pa.array([int(x[k]) for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    blocks = _blocks(members, "zone", F.greatest(F.count(F.lit(1)) / ZONE_PART, F.sum("n") * 8 / PART_BYTES)).join(sets, "node")
    blocks = blocks.select("zone", "block", "part", "node", "comp", "items")
    return _settled(dealt(blocks, "zone").mapInArrow(compare, "a long, b long").distinct())


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
        return False
    same = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * same >= percent * (len(x) + len(y) - same)


def _sets(ends: DataFrame, docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node, items: the set of each of the nodes ``ends``, of its whole text.

    A node's text is that of its least doc_id; a row whose text has another set is told by its hash and left out.
    """
    wanted = _settled(ends.join(nodes.select("node", "doc_id"), "node").select("node", F.col("doc_id").alias("d")))
    near = F.broadcast if wanted.count() <= BROADCAST_IDS else (lambda x: x)
    texts = docs.join(near(wanted), docs["doc_id"].eqNullSafe(wanted["d"])).select("node", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(x.as_py(), words).tobytes() for x in batch.column(1)]
            sound = [k for k, (x, node) in enumerate(zip(found, batch.column(0).to_pylist(), strict=True)) if int(np.array(xxhash.xxh3_64_intdigest(x), np.uint64).astype(np.int64)) == node]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(sound, pa.int64())), pa.array([found[k] for k in sound], pa.binary())], names=["node", "items"])

    return texts.mapInArrow(sets, "node long, items binary")


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the ``pairs`` (a, b) of nodes with 100 * intersection >= percent * union, on the sets of their whole texts."""
    asked = _settled(pairs.select("a", "b").distinct())
    known = _sets(asked.select(F.explode(F.array("a", "b")).alias("node")).distinct(), docs, nodes, words)
    left = asked.join(known.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
    both = left.join(known.select(F.col("node").alias("b"), F.col("items").alias("y")), "b").select("a", "b", "x", "y")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [[np.frombuffer(batch.column(c)[k].as_py(), np.uint64) for c in (2, 3)] for k in range(batch.num_rows)]
            at = pa.array([k for k, (x, y) in enumerate(sets) if _similar(x, y, percent)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    return _settled(both.mapInArrow(compare, "a long, b long").distinct())


def op6_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), words=2).select("doc_id", "n_shingles", "component_id", "kept")
