"""Toxicity: a noisy-channel restoration of disguised words, then a score of the restored text."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.common import bounded_sample, cut, held_out, one_label, read

#: Labelled rows of each class to learn from, at most about.
TRAIN_ROWS = 10_000
#: Symbols of the character model: 0 is a word's edge, 1 to 26 are a to z; other characters share the rest by their code points.
SYMBOLS = 128
#: Letters that a written character may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "{": "c", "<": "c", "€": "e", "£": "l", "¥": "y", "#": "h", "%": "", "*": "aeiou", "^": "a", "&": "", "_": "", "-": "", ".": "", "~": "", "'": "", "/": "", "=": "", "?": "", ",": "", ")": ""}
#: Costs of the channel (negative logarithms): a letter that stands for another, a lost mark, a letter for a mark
#: that stands for several, a repeated letter that was single.
SUBSTITUTED, DROPPED, REPEATED = 1.2, 2.5, 0.7
#: Costs of a word's edge at the narrowest gap of spaced letters, and of none at a wider one.
NARROW, WIDE = 0.7, 3.0

_WORD = re.compile(r"[^\W\d_]+")
_MARKS = "!?.,;:*#$%&|+()\"'-_~^=/"
_SPACED = re.compile(r"(?<!\S)(?:\S[ \t]+){2,}\S(?!\S)")
_INNER = re.compile(r"\w[.\-_/,=~&]+\S")
_RUN = re.compile(r"([^\W\d_])\1\1")
_PLAIN = re.compile(r"(?!.*([^\W\d_])\1\1)[^\W\d_]+(?:['’-][^\W\d_]{2,}|['’][^\W\d_])*")


#: Cyrillic and Greek letters that look like a Latin one.
LOOKS = str.maketrans({"а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x"})
_ACCENTS = re.compile("[\u0300-\u036f]+")
_ALPHABETS = re.compile("[\u0370-\u052f]")


def folded(text: str) -> str:
    """A text in lower case without accents and wide forms, and with Latin letters for those that look like them."""
    text = _ACCENTS.sub("", unicodedata.normalize("NFKD", text))
    return text.translate(LOOKS) if _ALPHABETS.search(text) else text


def symbol(char: str) -> int:
    """A small number for a character: a to z have their own, others share by code point."""
    code = ord(char)
    return code - 96 if 97 <= code <= 122 else 27 + code % (SYMBOLS - 27)


_SYMBOLS_OF = np.array([symbol(chr(c)) if chr(c).isalpha() else 0 for c in range(0x3000)], np.int64)


def trigram_codes(text: str) -> np.ndarray:
    """Codes of the letter trigrams of a text's words, with two edges before and one after each word."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    marks = np.where(codes < 0x3000, _SYMBOLS_OF[np.minimum(codes, 0x2FFF)], 401 + codes % (SYMBOLS - 401))
    edge = np.concatenate([[0, 0], marks, [0]])
    a, b, c = edge[:-2], edge[1:-1], edge[2:]
    a = np.where(b == 0, 0, a)
    keep = (b != 0) | (c != 0)
    return ((a * SYMBOLS + b) * SYMBOLS + c)[keep]


def character_counts(docs: DataFrame) -> np.ndarray:
    """How often each letter trigram occurs in all of ``docs``: counted by batch, summed on Spark. There are SYMBOLS^3, however many documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total: dict[int, int] = {}
            held, size = [], 0
            for text in [*filter(None, batch.text), None]:
                for start in range(0, len(text or ""), 1 << 18):  # a trigram at the seam counts as a word's edge
                    held.append(trigram_codes(text[start : start + (1 << 18)]))
                    size += len(held[-1])
                if held and (text is None or size > 1 << 19):
                    found, n = np.unique(np.concatenate(held), return_counts=True)
                    for code, k in zip(found.tolist(), n.tolist(), strict=True):
                        total[code] = total.get(code, 0) + k
                    held, size = [], 0
            yield pd.DataFrame({"code": list(total.keys()), "n": list(total.values())}, dtype="int64")

    rows = docs.select("text").mapInPandas(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SYMBOLS**3, np.int64)
    out[rows.column("code").to_numpy()] = rows.column("n").to_numpy()
    return out


class Channel:
    """Viterbi search for the likeliest word behind a disguised one, under a trigram model of characters."""

    def __init__(self, counts: np.ndarray | dict[int, int]) -> None:
        if isinstance(counts, dict):
            counts = np.bincount(np.array(list(counts), np.int64), np.array(list(counts.values()), float), SYMBOLS**3)
        three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
        two = three.sum(0)  # how often c comes after b
        likely = 0.7 * three / np.maximum(1, three.sum(2, keepdims=True)) + (0.25 * two / np.maximum(1, two.sum(1, keepdims=True)) + 0.05 / 60)
        #: -log P(c | a, b) of each trigram: mixed with the pair's and a floor.
        self.costs = -np.log(likely).astype(np.float32).reshape(-1)
        self.known: dict[tuple[str, bool], str] = {}
        self.view: memoryview | None = None

    def __getstate__(self) -> dict:
        return {"costs": self.costs, "known": {}, "view": None}

    @staticmethod
    def lattice(token: str, edges: bool = False) -> list[list[tuple[str, float]]]:
        """For each run of one character what it may stand for, with the channel's cost; a blank stands for a word's edge.

        Gaps between spaced letters are edges or nothing. With ``edges``, marks that are lost may be edges too.
        """
        out = []
        least = min((len(x) for x in re.findall(r"\s+", token)), default=0)
        for run in re.finditer(r"\s+|(\S)\1*", token):
            char, n = run[1], len(run[0])
            if char is None:
                options = [("", 0.0), (" ", NARROW)] if n == least else [("", WIDE), (" ", 0.0)]
            elif char.isalpha():
                options = [(char, REPEATED * min(n - 1, 1)), (char * 2, 0.3 if n == 2 else REPEATED)] if n > 1 else [(char, 0.0)]
            else:
                letters = LEET.get(char, "")
                more = 0.0 if n < 3 else 2.0  # three marks in turn are rather marks
                options = [(x, SUBSTITUTED + more + math.log(len(letters))) for x in letters] + [(x * 2, SUBSTITUTED + more + 0.5) for x in letters if n > 1]
                lost = DROPPED * 4 if char.isdigit() else DROPPED if n < 3 else DROPPED / 4
                options.append(("", lost))
                if edges and not char.isdigit():
                    options.append((" ", lost))
            out.append(options)
        return out

    def decode(self, token: str, edges: bool = False) -> str:
        """The likeliest word for a token in lower case, or words with blanks between; tokens that were met before come from a small store.

        Time and memory grow with the token's length, whatever it is.
        """
        if (token, edges) in self.known:
            return self.known[token, edges]
        if self.view is None:
            self.view = memoryview(self.costs)
        cost = self.view
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for options in self.lattice(token, edges):
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (spent, word) in states.items():
                for letters, price in options:
                    x, y, total = a, b, spent + price
                    for letter in letters:
                        if letter == " ":
                            total += cost[(x * SYMBOLS + y) * SYMBOLS] if y else 0.0
                            x, y = 0, 0
                            continue
                        z = symbol(letter)
                        total += cost[(x * SYMBOLS + y) * SYMBOLS + z]
                        x, y = y, z
                    if (x, y) not in after or total < after[x, y][0]:
                        after[x, y] = (total, (word, letters) if letters else word)
            states = after
        last = min(((spent + cost[(a * SYMBOLS + b) * SYMBOLS], word) for (a, b), (spent, word) in states.items()), key=lambda x: x[0])[1]
        parts = []
        while last is not None:
            last, letters = last
            parts.append(letters)
        best = "".join(reversed(parts))
        if len(token) <= 100:
            if len(self.known) > 50_000:
                self.known.clear()
            self.known[token, edges] = best
        return best

    def words(self, text: str | None) -> set[str]:
        """The distinct words of a text in lower case, disguised ones restored.

        Disguised are tokens with a digit or mark among letters, with a letter three times in turn, and letters that
        stand alone in turn with spaces between. Such tokens also keep their plain words, as marks may be just marks.
        Letters with accents, wide ones and those of other alphabets that look like a to z count as those, too.
        """
        text = (text or "").lower()
        found: set[str] = set()
        tokens = set(text.split())
        if not text.isascii() and (bare := folded(text)) != text:
            tokens.update(bare.split())
            text = bare
        repeats = _RUN.search(text) is not None
        for token in tokens:
            bare = token.strip(_MARKS)
            if bare.isalpha():
                found.add(bare)
                if not (repeats and _RUN.search(bare)):
                    continue
            else:
                found.update(_WORD.findall(token))
            if len(token) >= 2 and not _PLAIN.fullmatch(bare) and _lettered(token):
                found.update(_WORD.findall(self.decode(token)))
                if bare != token and len(bare) > 1:
                    found.update(_WORD.findall(self.decode(bare)))
                if _INNER.search(bare):
                    found.update(_WORD.findall(self.decode(bare, True)))
        for run in _SPACED.finditer(text):
            found.update(_WORD.findall(self.decode(run[0])))
            gap = min(map(len, re.findall(r"\s+", run[0])))
            for part in re.split(rf"\s{{{gap + 1},}}", run[0]):  # also as one word between wider gaps
                joined = re.sub(r"\s+", "", part)
                if len(joined) >= 2:
                    found.update(_WORD.findall(self.decode(joined)))
        return found


def _lettered(token: str) -> bool:
    """Whether a token has a letter, or a mark that LEET gives a letter for; digits alone are numbers."""
    return any(c.isalpha() or (not c.isdigit() and LEET.get(c)) for c in token)


def features(words: set[str]) -> set[str]:
    """What the classifier may look at: whole words, and beginnings of 4 to 6 letters of longer ones."""
    out = {f"={w}" for w in words if len(w) > 1}
    for w in words:
        out.update(w[:k] for k in (4, 5, 6) if len(w) > k)
    return out


def _fit(rows: list[tuple[list[int], int]], width: int, rounds: int = 300, rate: float = 0.5, decay: float = 1e-4) -> np.ndarray:
    """Weights of a logistic regression on sets of features, the last one for the intercept."""
    weights = np.zeros(width + 1)
    if not rows:
        return weights
    at = np.concatenate([np.full(len(f), k) for k, (f, _) in enumerate(rows)]).astype(int)
    which = np.concatenate([np.array(f, int) for f, _ in rows]).astype(int)
    truth = np.array([y for _, y in rows], float)
    speed = np.zeros_like(weights)
    for _ in range(rounds):
        score = 1 / (1 + np.exp(-(np.bincount(at, weights[which], len(rows)) + weights[-1])))
        miss = score - truth
        step = np.append(np.bincount(which, miss[at], width), miss.sum()) + decay * len(rows) * np.append(weights[:-1], 0)
        speed += step**2
        weights -= rate * step / np.sqrt(speed + 1e-9)
    return weights


def learn(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS) -> tuple[np.ndarray, dict[str, float], float]:
    """Character counts of all documents; weights of the classifier's features, and its intercept.

    Features are those that at least three toxic documents of the sample have, and clearly more often than others; their
    counts are made on Spark. The regression is fitted on the driver, on about ``bound`` rows a class at most, each with
    the few chosen features that it has. Of several labels of a document the smallest counts.
    """
    counts = character_counts(docs)
    known = one_label(labels, "toxic")
    known = bounded_sample(known.filter(~held_out(F.col("doc_id"), 3, 1)), "y", ["doc_id"], bound)
    # The sample of labels is bounded, so it is broadcast; the texts it finds are written once.
    rows = cut(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("y", "text"))
    model = Channel(counts)

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"y": batch.y, "found": [sorted(features(model.words(x))) for x in batch.text]})

    seen = rows.select("y", "text").mapInPandas(look, "y int, found array<string>")
    sizes = {r[0]: r[1] for r in rows.groupBy("y").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    tally = seen.select("y", F.explode("found").alias("f")).groupBy("f").agg(F.count_if(F.col("y") == 1).alias("bad"), F.count_if(F.col("y") == 0).alias("good"))
    lift = F.log((F.col("bad") + 0.5) / F.lit(bad + 1.0)) - F.log((F.col("good") + 0.5) / F.lit(good + 1.0))
    chosen = tally.filter("bad >= 3").withColumn("lift", lift).filter(F.col("lift") > 1.5)
    index = {f: k for k, f in enumerate(sorted(r[0] for r in chosen.select("f").collect()))}  # of a bounded sample

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sorted(index[f] for f in features(model.words(x)) if f in index) for x in batch.text]
            yield pd.DataFrame({"y": batch.y, "found": found})

    picked = [(list(r[1]), r[0]) for r in rows.select("y", "text").mapInPandas(pick, "y int, found array<int>").collect()]
    picked.sort()
    weights = _fit(picked, len(index))
    return counts, {f: float(weights[k]) for f, k in index.items()}, float(weights[-1])


def scored(text: Column, model: tuple[np.ndarray, dict[str, float], float]) -> Column:
    """A score of 0 to 1 for a text. A null text is an empty one; where nothing was learned all have one score."""
    counts, weights, base = model
    channel = Channel(counts)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, tuple[str, ...]] = {}  # the features with a weight of words that were met before

        def hits(word: str) -> tuple[str, ...]:
            found = known.get(word)
            if found is None:
                if len(known) > 200_000:
                    known.clear()
                found = known[word] = tuple(f for f in features({word}) if f in weights)
            return found

        for texts in batches:
            sums = [base + sum(weights[f] for f in {f for w in channel.words(x) for f in hits(w)}) for x in texts]
            yield pd.Series([1 / (1 + math.exp(-max(-500.0, min(500.0, s)))) for s in sums], dtype=float)

    return run(text)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of ``docs``, repeated rows included.

    A null doc_id is not held out. No rows give no rows; columns other than doc_id and text are not looked at.
    """
    model = learn(docs, labels)
    rows = docs.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), scored(F.col("text"), model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
