"""Language identification by rank-order n-gram profiles and their out-of-place distance."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from gazette.llm.common import bounded_sample, held_out, read

_APART = re.compile(r"[\W\d_]+")
#: Rows of each language from which its profile is drawn, at most about.
TRAIN_ROWS = 20_000
#: n-grams of a profile.
TOP = 300
#: Characters of a text, and n-grams, that are looked at together.
PIECE, AT_ONCE = 1 << 18, 1 << 19


def grams(text: str) -> np.ndarray:
    """The 1-, 2- and 3-grams of the words of a text, in lower case, as numbers; a word begins and ends with a blank.

    A gram is its code points in base 2^21, which is exact; n-grams never join two words.
    """
    words = _APART.sub(" ", text.lower()).strip()
    if not words:
        return np.empty(0, np.uint64)
    codes = np.frombuffer(f" {words} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    gap = codes == 32
    pairs = codes[:-1] << np.uint64(21) | codes[1:]
    triples = pairs[:-1] << np.uint64(21) | codes[2:]
    return np.concatenate([codes[~gap], pairs, triples[~gap[1:-1]]])


def in_pieces(text: str) -> Iterator[str]:
    """A text in pieces of about PIECE characters that end between words; n-grams never join two, so none is lost or made."""
    start = 0
    while len(text) - start > PIECE:
        gap = _APART.search(text, start + PIECE)
        if not gap:
            break
        yield text[start : gap.end()]
        start = gap.end()
    yield text[start:] if start else text


def counted(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of all texts and how often each occurs. Memory follows the distinct grams, not the texts."""
    found, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    held: list[np.ndarray] = []
    size = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        new, n = np.unique(np.concatenate(held), return_counts=True)
        if not len(found):
            return new, n
        both, at = np.unique(np.concatenate([found, new]), return_inverse=True)
        return both, np.bincount(at, np.concatenate([counts, n]), len(both)).astype(np.int64)

    for text in texts:
        for piece in in_pieces(text):
            held.append(grams(piece))
            size += len(held[-1])
            if size >= AT_ONCE:
                found, counts = merged()
                held, size = [], 0
    return merged() if held else (found, counts)


def ranked(text: str, top: int = TOP) -> np.ndarray:
    """The most frequent grams of a text, most frequent first, ties by number."""
    found, counts = counted([text])
    return found[np.lexsort((found, -counts))[:top]]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def profiles(labelled: DataFrame, top: int = TOP, bound: int = TRAIN_ROWS) -> dict[str, list[int]]:
    """The ``top`` grams of each value of ``lang``, from rows with text and lang, about ``bound`` rows a language at most.

    Grams are counted in each batch and summed on Spark; what is collected has ``top`` rows a language.
    """
    sample = bounded_sample(labelled.select("doc_id", "text", "lang").dropna(subset=["text", "lang"]), "lang", ["doc_id", "text"], bound)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, rows in batch.groupby("lang"):
                found, n = counted(rows.text)
                yield pd.DataFrame({"lang": lang, "gram": found.astype(np.int64), "n": n})

    summed = sample.select("lang", "text").mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = summed.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select("lang", "rank", "gram").collect()
    out: dict[str, list[int]] = {}
    for lang, _, gram in sorted(rows):
        out.setdefault(lang, []).append(gram)
    return out


class Identifier:
    """Profiles as one table of ranks, to measure a document against all languages at once."""

    def __init__(self, made: dict[str, list[int]], top: int = TOP, sharpness: float = 30.0) -> None:
        self.langs, self.top, self.sharpness = sorted(made), top, sharpness
        self.known = np.unique(np.array([g for gs in made.values() for g in gs], np.uint64))
        self.ranks = np.full((len(self.known) + 1, len(self.langs)), -1, np.int64)
        for k, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.known, np.array(made[lang], np.uint64)), k] = np.arange(len(made[lang]))

    def distances(self, text: str) -> np.ndarray:
        """Out-of-place distance to each language as a share of the largest possible one: a gram that the profile lacks is ``top`` places out."""
        own = ranked(text, self.top)
        at = np.searchsorted(self.known, own)
        at[at == len(self.known)] = 0
        at = np.where(self.known[at] == own, at, len(self.known))  # the last row: in no profile
        there = self.ranks[at]
        out = np.where(there < 0, self.top, np.abs(there - np.arange(len(own))[:, None]))
        return out.sum(0) / (self.top * len(own))

    def identify(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not has_letter(text):
            return "und", 0.0
        far = self.distances(text)
        weight = np.exp(-self.sharpness * (far - far.min()))
        best = int(far.argmin())
        return self.langs[best], float(weight[best] / weight.sum())


def predicted(text: Column, made: dict[str, list[int]]) -> Column:
    """struct(lang_pred, score) of a text. Null texts, texts without a letter, and all texts where nothing was learned are ``und`` with score 0.

    score compares the nearest language with the others: 1 / (number of languages) if all are as near.
    """
    model = Identifier(made)

    @F.pandas_udf("lang_pred string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.identify(x) for x in texts], columns=["lang_pred", "score"])

    return run(text)


def learn(docs: DataFrame, bound: int = TRAIN_ROWS) -> dict[str, list[int]]:
    """Profiles from the documents outside the held-out third."""
    return profiles(docs.filter(~held_out(F.col("doc_id"), 3, 1)), bound=bound)


def identify(docs: DataFrame, made: dict[str, list[int]]) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row for each row of ``docs``, repeated rows included.

    A null doc_id is not held out. Ties between languages go to the first by name. No rows give no rows; columns other
    than doc_id and text are not looked at.
    """
    rows = docs.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), predicted(F.col("text"), made).alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return identify(docs, learn(docs))
