"""Personal data: patterns first, then a skip-chain conditional random field whose repeated or similar tokens share potentials."""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.common import cut, read, small_batches, unit

KINDS = ("email", "ip", "card", "phone")
#: Labels of tokens: none, the four kinds, and the further tokens of the kinds that have blanks inside.
LABELS = ("none", "email", "ip", "card", "phone", "+card", "+phone")
#: The kind of each label, 0 for none.
KIND_OF = np.array([0, 1, 2, 3, 4, 3, 4])
#: Documents to learn from, patterns of segments that the regression sees, and segments that one document gives, at most about.
TRAIN_DOCS, TRAIN_PATTERNS, TRAIN_SEGMENTS = 20_000, 5_000, 50
#: Rounds of messages, and the least probability of each token of an added span.
ROUNDS, LEAST = 24, 0.9

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9]+(?:[ -][0-9]+)*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_CLUE = re.compile(r"[0-9@]")
_RIGHT = re.compile(r"[A-Za-z0-9._%+@-]*")
_GAP = re.compile(r"[ ().-]{1,3}")
_NUMBERS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of those before it."""
    values = [int(c) for c in digits[::-1]]
    return (sum(values[::2]) + sum(2 * v - 9 * (v > 4) for v in values[1::2])) % 10 == 0


def _small(part: str) -> bool:
    """Whether a number of any length is 255 at most."""
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _digits(text: str) -> str:
    return "".join(_NUMBERS.findall(text))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind from 1, start, end) of the patterns' matches that hold, by kind and start. Time is linear in the text."""
    out = []
    if "@" in text:
        done = 0
        for match in _AT.finditer(text):
            start = match.start()
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < match.start():
                out.append((1, start, match.end()))
                done = match.end()
    if not _NUMBERS.search(text):
        return out
    out.extend((2, m.start(), m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split("."))))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((3, m.start(), m.end()))
    out.extend((4, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15)
    return out


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k - 1]}:{a}:{b}" for k, a, b in sorted(spans))


@dataclass
class Tokens:
    """Tokens with a digit or an at sign, whatever stands between: places, segments, what is known and seen of them. Some bytes a token."""

    starts: array = field(default_factory=lambda: array("q"))
    ends: array = field(default_factory=lambda: array("q"))
    segment: array = field(default_factory=lambda: array("q"))  # tokens parted by a few blanks, dots, dashes or parentheses alone are one segment
    label: array = field(default_factory=lambda: array("b"))  # that of the pattern's span over it, -1 where it is open
    features: list[tuple[int, ...]] = field(default_factory=list)
    pairs: array = field(default_factory=lambda: array("q"))  # tokens next in turn to be alike: first, second, first, second, ..

    def __len__(self) -> int:
        return len(self.starts)


def _shape(token: str, before: str, after: str) -> tuple[int, ...]:
    """Numbers of the binary features that hold for a token."""
    digits = _digits(token)
    parts = token.split(".")
    numeric = all(p.isascii() and p.isdigit() for p in parts)
    alone = len(parts) == 1 and numeric
    size = min(len(digits), 20)
    mail = token.partition("@")
    tests = (
        True, "@" in token, "." in mail[2] and mail[0] != "", token.count("@") > 1,
        numeric and len(parts) == 4, numeric and len(parts) == 4 and all(map(_small, parts)), numeric and 1 < len(parts) < 4, numeric and len(parts) > 4,
        alone, alone and luhn(digits), alone and len(digits) >= 12 and luhn(digits), token[0] == "+" and token[1:].isdigit(), token[0] == "+",
        "-" in token, _DASHED.fullmatch(token) is not None, any(c.isalpha() for c in token), "_" in token or "%" in token,
        before == "(" and after == ")", before == "(", before in "\"'", before.isalnum(), after.isalnum(), before in "$#=:", before == "" or before.isspace(),
    )
    return (*(k for k, x in enumerate(tests) if x), len(tests) + size, len(tests) + 21 + min(len(token), 24))


_DASHED = re.compile(r"[0-9]{2,4}(?:-[0-9]{2,4})+")
#: How many features there are.
WIDTH = len(_shape("0", "", "")) and 24 + 21 + 25


_SAME: dict[tuple[int, ...], tuple[int, ...]] = {}


def tokens(text: str, spans: list[tuple[int, int, int]]) -> Tokens:
    """The tokens of a text, which matches of the patterns label, and pairs of them that are alike.

    Alike are equal addresses and numbers of 6 or more digits, addresses of one host, numbers with the same last seven
    digits, and such of 8 or more with one first half and length, however they are written. Each is paired with the one
    before it, so that pairs grow with tokens, not with their square.
    """
    out, done = Tokens(), 0
    known = sorted((a, b, k) for k, a, b in spans)
    last: dict[tuple, int] = {}
    at = 0
    for clue in _CLUE.finditer(text):
        if clue.start() < done:
            continue
        start = clue.start()
        while start > done and (text[start - 1] in _LOCAL or text[start - 1] == "@"):
            start -= 1
        end = done = _RIGHT.match(text, clue.start()).end()
        token = text[start:end]
        bare = token.rstrip(".%+@-_")
        end -= len(token) - len(bare)
        start += len(bare) - len(bare.lstrip(".%@-_"))
        token = text[start:end]
        if not _CLUE.search(token):
            continue
        n = len(out)
        before = out.ends[-1] if n else 0
        out.segment.append((out.segment[-1] + (_GAP.fullmatch(text, before, start) is None)) if n else 0)
        out.starts.append(start)
        out.ends.append(end)
        while at < len(known) and known[at][1] <= start:  # matches of different kinds may overlap; those that ended are passed
            at += 1
        covering = [(k, a) for a, b, k in _until(known, at, end) if b > start]
        if covering:
            kind, a = min(covering)
            first = a >= start or kind < 3 or not n or before <= a
            out.label.append(kind if first else kind + 2)
        else:
            out.label.append(-1)
        shape = _shape(token, text[start - 1] if start else "", text[end : end + 1])
        if len(_SAME) > 100_000:
            _SAME.clear()
        out.features.append(_SAME.setdefault(shape, shape))
        mail, digits = token.lower().partition("@"), _digits(token)
        if mail[1]:
            keys = [(0, token.lower()), (1, mail[2])]
        elif len(digits) >= 6 and not any(map(str.isalpha, token)):
            keys = [(2, digits)] + [(3, digits[-7:])] * (len(digits) >= 7) + [(4, digits[: len(digits) // 2], len(digits))] * (len(digits) >= 8)
        else:
            keys = []
        for one in sorted({last[k] for k in keys if k in last}):
            out.pairs.extend((one, n))
        last.update(dict.fromkeys(keys, n))
    return out


def _until(known: list[tuple[int, int, int]], at: int, end: int) -> Iterator[tuple[int, int, int]]:
    while at < len(known) and known[at][0] < end:
        yield known[at]
        at += 1


#: The log potential of what cannot be.
BARRED = -1e3


def allowed() -> np.ndarray:
    """0 where a label may follow one within a segment, else BARRED: a further token needs one of its kind before it."""
    out = np.zeros((len(LABELS), len(LABELS)))
    for further, begun in ((5, 3), (6, 4)):
        out[:, further] = BARRED
        out[[begun, further], further] = 0
    return out


_START = np.array([0, 0, 0, 0, 0, BARRED, BARRED])


def _total(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def marginals(node: np.ndarray, edges: np.ndarray, kind: np.ndarray, potentials: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Each token's probabilities of the labels, by loopy sum-product messages along both kinds of edges.

    ``node`` has the log potentials of each token, ``edges`` pairs of tokens, ``kind`` which of the log ``potentials``
    (first token's label, second token's label) an edge has. All messages of a round are made from the last round's; on
    trees that are no deeper than ``rounds`` the probabilities are exact. What is no neighbour of a token has no part in
    its result, so that documents can be put together.
    """
    m, labels = len(edges), node.shape[1]
    there, back = np.zeros((m, labels)), np.zeros((m, labels))  # to the second token, to the first
    a, b = (edges[:, 0], edges[:, 1]) if m else (np.zeros(0, int), np.zeros(0, int))
    for step in range(rounds + 1):
        belief = node.copy()
        for label in range(labels):
            belief[:, label] += np.bincount(b, there[:, label], len(node)) + np.bincount(a, back[:, label], len(node)) if m else 0
        if step == rounds or not m:
            break
        out_a, out_b = belief[a] - back, belief[b] - there
        new_there, new_back = np.empty_like(there), np.empty_like(back)
        for k, potential in enumerate(potentials):
            rows = np.flatnonzero(kind == k)
            for label in range(labels):
                new_there[rows, label] = _total(out_a[rows] + potential[:, label], 1)
                new_back[rows, label] = _total(out_b[rows] + potential[label], 1)
        # A message keeps its meaning if a number is added.
        there, back = (x - x.max(axis=1, keepdims=True) for x in (new_there, new_back))
    belief = belief - belief.max(axis=1, keepdims=True)
    p = np.exp(belief)
    return p / p.sum(axis=1, keepdims=True)


@dataclass
class Model:
    """Log potentials: of features by label, of label pairs in turn, and of kinds of alike tokens."""

    weights: np.ndarray
    follows: np.ndarray
    alike: np.ndarray


def fit_chain(patterns: list[tuple[tuple[tuple[int, ...], ...], tuple[int, ...], int]], rounds: int = 200, rate: float = 0.3, decay: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights of features and transitions that make the labels of segments likeliest: exact sums over each chain, by its length.

    A pattern is (features of each token, its labels, how often it occurs).
    """
    barred = allowed()
    groups: dict[int, list] = {}
    for features, labels, n in patterns:
        groups.setdefault(len(labels), []).append((features, labels, n))
    sets = []
    for length, rows in sorted(groups.items()):
        x = np.zeros((len(rows), length, WIDTH))
        for r, (features, _, _) in enumerate(rows):
            for t, held in enumerate(features):
                x[r, t, list(held)] = 1
        sets.append((x, np.array([r[1] for r in rows]), np.log1p([float(r[2]) for r in rows])))  # frequent patterns count more, not all the more
    weights, follows = np.zeros((WIDTH, len(LABELS))), np.zeros((len(LABELS), len(LABELS)))
    speed_w, speed_f = np.full_like(weights, 1e-9), np.full_like(follows, 1e-9)
    total = max(1e-9, sum(float(s[2].sum()) for s in sets))
    one = np.eye(len(LABELS))
    for _ in range(rounds):
        slope_w, slope_f = decay * weights, decay * follows
        for x, y, n in sets:
            node = x @ weights
            node[:, 0] += _START
            length = node.shape[1]
            forward, backward = [node[:, 0]], [np.zeros_like(node[:, 0])]
            between = follows + barred
            for t in range(1, length):
                forward.append(node[:, t] + _total(forward[-1][:, :, None] + between, 1))
            for t in range(length - 1, 0, -1):
                backward.append(_total(between + (node[:, t] + backward[-1])[:, None, :], 2))
            backward.reverse()
            full = _total(forward[-1], 1)
            with np.errstate(invalid="ignore"):
                for t in range(length):
                    p = np.exp(forward[t] + backward[t] - full[:, None])
                    slope_w = slope_w + np.einsum("rf,rl,r->fl", x[:, t], p - one[y[:, t]], n) / total
                    if t:
                        pair = np.exp(forward[t - 1][:, :, None] + between + (node[:, t] + backward[t])[:, None, :] - full[:, None, None])
                        slope_f = slope_f + np.einsum("rab,r->ab", pair - one[y[:, t - 1]][:, :, None] * one[y[:, t]][:, None, :], n) / total
        speed_w, speed_f = speed_w + slope_w**2, speed_f + slope_f**2
        weights, follows = weights - rate * slope_w / np.sqrt(speed_w), follows - rate * slope_f / np.sqrt(speed_f)
    return weights, follows


def fit_alike(pairs: dict[tuple[int, int], float], agreed: float = 5.0, differed: float = 0.1) -> np.ndarray:
    """Log potential of the kinds of two alike tokens: how much more often both stand together than by chance.

    A prior has ``agreed`` pairs of each kind with itself and ``differed`` of each other two.
    """
    k = len(KINDS) + 1
    held = np.full((k, k), differed) + np.eye(k) * (agreed - differed)
    for (a, b), n in pairs.items():
        held[a, b] += n / 2
        held[b, a] += n / 2
    p = held / held.sum()
    return np.log(p / np.outer(p.sum(1), p.sum(0)))


def learn(docs: DataFrame, bound: int = TRAIN_DOCS, patterns: int = TRAIN_PATTERNS) -> Model:
    """The field's potentials from about ``bound`` documents, chosen by a hash of their texts.

    The patterns' own matches are the labels. Segments of eight or more digits in which a pattern's match failed say
    nothing (two numbers side by side), so they are left out; other open tokens are none. Segments are counted by their
    features and labels on Spark; the ``patterns`` most frequent go to the driver.
    """
    n = docs.count()
    sample = docs.filter(unit(F.lit(13), F.col("text")) < F.lit(min(1.0, bound / max(1, n)))).select(F.coalesce("text", F.lit("")).alias("text"))
    kind = "pair boolean, features array<array<int>>, labels array<int>"

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                found = tokens(text, base_spans(text))
                kinds = [int(KIND_OF[max(0, x)]) for x in found.label]
                pairs = zip(found.pairs[::2], found.pairs[1::2], strict=True)
                rows.extend({"pair": True, "features": None, "labels": sorted((kinds[a], kinds[b]))} for _, (a, b) in zip(range(TRAIN_SEGMENTS), pairs, strict=False))
                given = 0
                for start, end in _runs(found.segment):
                    labels = found.label[start:end]
                    unsure = -1 in labels and end - start > 1 and len(_digits(text[found.starts[start] : found.ends[end - 1]])) >= 8
                    if not unsure and end - start <= 16 and given < TRAIN_SEGMENTS:
                        rows.append({"pair": False, "features": [list(f) for f in found.features[start:end]], "labels": [max(0, x) for x in labels]})
                        given += 1
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("pair", pa.bool_()), ("features", pa.list_(pa.list_(pa.int32()))), ("labels", pa.list_(pa.int32()))]))

    counted = cut(sample.mapInArrow(look, kind).groupBy("pair", "features", "labels").count())
    pairs = {tuple(r.labels): float(r["count"]) for r in counted.filter("pair").collect()}  # 15 rows at most
    most = counted.filter("not pair").orderBy(F.desc("count"), F.col("features"), F.col("labels")).limit(patterns).collect()
    weights, follows = fit_chain([(tuple(map(tuple, r.features)), tuple(r.labels), r["count"]) for r in most])
    return Model(weights, follows, fit_alike(pairs))


def _runs(segment: array) -> Iterator[tuple[int, int]]:
    """First and last + 1 of each run of equal numbers."""
    start = 0
    for end in range(1, len(segment) + 1):
        if end == len(segment) or segment[end] != segment[start]:
            yield start, end
            start = end


def added_spans(texts: list[str], found: list[Tokens], model: Model, least: float = LEAST) -> list[list[tuple[int, int, int]]]:
    """Spans of open tokens for each text: the field's likeliest labels, each of ``least`` probability, that a check confirms.

    The check: an address has an at sign and a dotted host, an ip four numbers up to 255, a card 16 to 19 digits, a
    phone 8 to 15. Texts are put together until they have some thousand tokens; a text is never parted.
    """
    out: list[list[tuple[int, int, int]]] = []
    held: list[int] = []
    for k in range(len(texts)):
        out.append([])
        if -1 in found[k].label:
            held.append(k)
        if held and (k == len(texts) - 1 or sum(len(found[h]) for h in held) > 20_000):
            for h, spans in zip(held, _decided([texts[h] for h in held], [found[h] for h in held], model, least), strict=True):
                out[h] = spans
            held = []
    return out


def _decided(texts: list[str], found: list[Tokens], model: Model, least: float) -> list[list[tuple[int, int, int]]]:
    table = {f: model.weights[list(f)].sum(0) for x in found for f in set(x.features)}
    label = np.concatenate([np.frombuffer(x.label, np.int8) for x in found])
    bases = np.cumsum([0, *map(len, found)])
    segment = np.concatenate([np.frombuffer(x.segment, np.int64) + (k << 32) for k, x in enumerate(found)])
    node = np.array([table[f] for x in found for f in x.features])
    clamped = np.where(np.arange(len(LABELS)) == label[:, None], 0.0, BARRED)
    first = np.append(True, segment[1:] != segment[:-1])
    node = np.where(label[:, None] >= 0, clamped, node + np.where(first[:, None], _START, 0.0))
    inner = np.flatnonzero(~first)
    alike = np.concatenate([np.frombuffer(x.pairs, np.int64).reshape(-1, 2) + base for x, base in zip(found, bases, strict=False)])
    edges = np.concatenate([np.stack([inner - 1, inner], 1), alike])
    kinds = np.repeat([0, 1], [len(inner), len(alike)])
    p = marginals(node, edges, kinds, np.stack([model.follows + allowed(), model.alike[np.ix_(KIND_OF, KIND_OF)]]))
    best, sure = p.argmax(1), p.max(1) >= least
    out: list[list[tuple[int, int, int]]] = [[] for _ in found]
    for k in range(len(found)):
        base, stop = bases[k], bases[k + 1]
        begun = np.flatnonzero((label[base:stop] < 0) & (best[base:stop] > 0) & (best[base:stop] < 5)) + base
        for t in begun.tolist():
            kind, end = int(best[t]), t + 1
            while end < stop and kind > 2 and not first[end] and label[end] < 0 and best[end] == kind + 2:
                end += 1
            a, b = found[k].starts[t - base], found[k].ends[end - 1 - base]
            if sure[t:end].all() and _holds(kind, texts[k][a:b]):
                out[k].append((kind, a, b))
    return out


def _holds(kind: int, text: str) -> bool:
    digits = len(_digits(text))
    if kind == 1:
        return _AT.search(text) is not None and text[0] != "@"
    if kind == 2:
        return len(text.split(".")) == 4 and all(x.isdigit() and _small(x) for x in text.split("."))
    return 16 <= digits <= 19 if kind == 3 else 8 <= digits <= 15


def personal_data(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added: one row for each row of ``docs``.

    The counts and the digest are of the patterns' matches; spans has those and what the field adds to them. A null text
    is an empty one, with no spans and the digest of nothing. A null doc_id and repeated rows stay. Documents without a
    digit or an at sign have no tokens. Without documents there are no rows; other columns are not looked at.
    """
    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = learn(rows)
    names = [f"n_{k}" for k in KINDS]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            base = [base_spans(x) for x in texts]
            found = [tokens(x, spans) for x, spans in zip(texts, base, strict=True)]
            more = added_spans(texts, found, model, least)
            counts = [pa.array([sum(s[0] == k for s in spans) for spans in base], pa.int64()) for k in range(1, 5)]
            digests = [hashlib.sha256(written(spans).encode()).hexdigest() for spans in base]
            every = [written(a + b) for a, b in zip(base, more, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(digests, pa.string()), pa.array(every, pa.string()), pa.array(map(len, more), pa.int64())], ["doc_id", *names, "base_sha256", "spans", "n_added"])

    return rows.mapInArrow(scan, "doc_id long, " + ", ".join(f"{x} long" for x in names) + ", base_sha256 string, spans string, n_added long")


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read(spark, sf_dir, "documents"))
