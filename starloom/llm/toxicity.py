"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding undoes disguises: letters that look alike, accents, invisible signs, and digits or signs set
in place of letters. The lexicon holds word beginnings and whole words that are far more frequent in
toxic than in clean training texts, weighted by their log odds. Two-word phrases that show a lexicon
word mostly in clean texts are exceptions: a match within one does not count. The sum of the weights
and the same sum per word of text are turned into a probability by a logistic fit.
"""

from __future__ import annotations

import functools
import math
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import portions, text_batches

#: The lexicon and the fit learn from at most so many labelled rows, the first by a hash of the id.
MOST_LABELLED = 50_000

#: A lexicon entry stands in at least this many toxic training texts and this share of them, and the
#: lower bound of its precision (95 %) is at least this.
LEAST_TEXTS, LEAST_SHARE, LEAST_PRECISION = 4, 0.0005, 0.5

#: Before the exceptions are known this bound is enough, for words that also have a mild use.
CANDIDATE_PRECISION = 0.2

#: Word beginnings that are looked at, in letters.
STEMS = range(4, 13)

#: A phrase is an exception if it stands in at least so many clean texts and at most this share of
#: the texts with it are toxic.
EXCEPTION_TEXTS, EXCEPTION_PRECISION = 4, 0.1

#: Letters of other scripts that look like Latin ones, digits and signs used for
#: letters. Small L and I are one letter, because the digit 1 stands for both.
LOOKALIKES = {
    "a": "аαɑ", "b": "вьβ", "c": "сϲ", "d": "ԁɗ", "e": "еєε", "f": "ƒ", "g": "ɡց", "h": "һн",
    "i": "іιıӏl", "j": "јʝ", "k": "кκ", "m": "м", "n": "пηո", "o": "оοσօ", "p": "рρ", "q": "ԛգ",
    "r": "гɾ", "s": "ѕʂ", "t": "тτ", "u": "υսц", "v": "νѵ", "w": "ԝωш", "x": "хχ", "y": "уγү",
    "z": "ʐ",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i", "+": "t", "€": "e"}

_OTHER, _LETTER, _DIGIT, _SIGN, _NOTHING = range(5)


@functools.lru_cache(maxsize=1)
def folding() -> tuple[np.ndarray, np.ndarray]:
    """For every code point what it becomes, and its kind."""
    look = {c: to for to, cs in LOOKALIKES.items() for c in cs}
    to = np.full(0x110000, 32, np.uint32)
    kind = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        c = chr(point)
        category = unicodedata.category(c)
        if category in ("Mn", "Cf"):  # accents on their own, invisible signs
            kind[point] = _NOTHING
        elif category[0] == "L":
            base = unicodedata.normalize("NFKD", c)[:1].lower()[:1] or c
            kind[point], to[point] = _LETTER, ord(look.get(base, base))
    for table, k in ((DIGITS, _DIGIT), (SIGNS, _SIGN)):
        for c, letter in table.items():
            kind[ord(c)], to[ord(c)] = k, ord(letter)
    return to, kind


def fold(texts: Sequence[str]) -> list[str]:
    """Folded texts: words of letters, one blank before each and one at the end.

    A digit is a letter if it touches one, a sign if a letter follows it.
    """
    return [folded for part in portions(texts) for folded in _fold(texts[part])]


def _fold(texts: Sequence[str]) -> list[str]:
    to, kinds = folding()
    points = np.frombuffer(
        "\n".join(t.replace("\n", " ") for t in texts).encode("utf-32-le", "surrogatepass"),
        np.uint32)
    kind = kinds[points]
    keep = kind != _NOTHING
    points, kind = points[keep], kind[keep]
    letter = kind == _LETTER
    for _ in range(2):  # twice, for two digits side by side
        before = np.concatenate([[False], letter[:-1]])
        after = np.concatenate([letter[1:], [False]])
        letter = letter | ((kind == _DIGIT) & (before | after)) | ((kind == _SIGN) & after)
    out = np.where(letter, to[points], 32).astype(np.uint32)
    out[points == 10] = 10
    line = out.tobytes().decode("utf-32-le", "surrogatepass")
    return [f" {' '.join(t.split())} " for t in line.split("\n")]


# -- lexicon -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Lexicon:
    """entries: patterns with weights (" stem" or " word "); exceptions: phrases " a b "."""

    entries: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...] = ()
    coefficients: tuple[float, ...] = field(default=(0.0, 0.0, 0.0))

    def matches(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the matches in a folded text that no exception covers."""
        machine = _machine(self.entries, self.exceptions)
        if not len(machine):
            return []
        found, covered = [], []
        for last, (length, weight) in machine.iter(text):
            (covered if weight is None else found).append((last + 1 - length, last + 1, weight))
        if not covered:
            return found
        # of the exceptions that start at a match or before it, the one that reaches furthest
        covered.sort(key=lambda c: c[0])
        starts = [c[0] for c in covered]
        reach = list(accumulate((c[1] for c in covered), max))
        return [m for m in found
                if not (k := bisect_right(starts, m[0])) or reach[k - 1] < m[1]]

    def features(self, text: str) -> tuple[float, float]:
        """Logarithms of the weight sum and of the weight per 100 words; one weight per place."""
        best: dict[int, float] = {}
        for start, _, weight in self.matches(text):
            best[start] = max(best.get(start, 0.0), weight)
        total = sum(best.values())
        words = text.count(" ") - 1
        return math.log1p(total), math.log1p(100.0 * total / max(1, words))

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        x = np.array([self.features(t) for t in fold(texts)], float).reshape(len(texts), 2)
        return _probability(x, np.array(self.coefficients))


@functools.lru_cache(maxsize=4)
def _machine(entries: tuple, exceptions: tuple):
    machine = ahocorasick.Automaton()
    for pattern, weight in entries:
        machine.add_word(pattern, (len(pattern), weight))
    for phrase in exceptions:
        machine.add_word(phrase, (len(phrase), None))
    if len(machine):
        machine.make_automaton()
    return machine


def _probability(x: np.ndarray, coefficients: np.ndarray) -> np.ndarray:
    z = coefficients[0] + x @ coefficients[1:]
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps, penalised but for the constant."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    if not len(x):
        return w
    ridge = np.diag([1e-6] + [penalty] * x.shape[1])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(a @ w, -35, 35)))
        slope = a.T @ (p - y) + ridge @ w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def precision_bound(toxic: int, clean: int) -> float:
    """Lower end of the 95 % Wilson interval of the share of toxic texts."""
    n, z = toxic + clean, 1.96
    p = toxic / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (
        1 + z * z / n)


def choose_entries(
    rows: Sequence[tuple[str, int, int]], toxic: int, clean: int, least: float = LEAST_PRECISION,
) -> tuple:
    """Entries among the patterns (text, toxic texts, clean texts) whose precision is ``least`` or
    more; a longer one is left out if a shorter beginning tells as much."""
    weights = {}
    for pattern, t, c in sorted(rows, key=lambda r: (len(r[0]), r[0])):
        if precision_bound(t, c) < least:
            continue
        weight = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
        shorter = [weights[pattern[:k]] for k in range(2, len(pattern)) if pattern[:k] in weights]
        if not shorter or weight > max(shorter) + math.log(2):
            weights[pattern] = weight
    return tuple(weights.items())


def labelled_sample(labels: DataFrame, id_col: str, label: str, most: int) -> DataFrame:
    """At most ``most`` labelled ids, the first by a hash; an id labelled twice counts as toxic if
    one label says so."""
    return labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(
        F.col(id_col).alias("__id")).agg(F.max(label).cast("int").alias("__label")).orderBy(
        F.xxhash64("__id"), "__id").limit(most)


def learn(
    docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id",
    label: str = "toxic", most: int = MOST_LABELLED,
) -> Lexicon:
    """A lexicon from at most ``most`` labelled rows.

    Counts are made in the tasks and summed by Spark. What reaches the driver is bounded: patterns
    stand in a fixed share of the toxic texts, and the fit reads two numbers for each of at most
    ``most`` rows. Without toxic or without clean rows nothing is learned and every score is the
    share of toxic rows (0.5 without any).
    """
    text_batches(docs.sparkSession)
    sample = labelled_sample(labels, id_col, label, most)
    # the sample is no larger than ``most`` pairs of numbers, so it may be broadcast
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("text")).join(
        F.broadcast(sample), "__id").select("text", F.col("__label").alias("label"))

    def patterns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = (Counter(), Counter())
        n = [0, 0]
        for batch in batches:
            for words, y in zip(map(_words, fold(batch["text"].fillna("").tolist())),
                                batch["label"].tolist()):
                y = int(y > 0)
                n[y] += 1
                counts[y].update(words)
            if len(counts[0]) + len(counts[1]) > 400_000:
                yield _counted(counts)
                counts = (Counter(), Counter())
        yield _counted(counts)
        yield pd.DataFrame({"word": [""], "toxic": [n[1]], "clean": [n[0]]})

    words = rows.mapInPandas(patterns, "word string, toxic long, clean long").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    stem = F.transform(
        F.sequence(F.lit(min(STEMS)), F.least(F.length("word"), F.lit(max(STEMS)))),
        lambda k: F.concat(F.lit(" "), F.substring("word", F.lit(1), k)))
    whole = F.array(F.concat(F.lit(" "), "word", F.lit(" ")))
    stems = F.when(F.length("word") >= min(STEMS), F.concat(stem, whole)).otherwise(whole)
    grouped = words.select(F.explode(stems).alias("pattern"), "toxic", "clean").groupBy(
        "pattern").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    sizes = rows.agg(F.sum((F.col("label") > 0).cast("long")).alias("t"),
                     F.count(F.lit(1)).alias("n")).first()
    toxic, clean = sizes["t"] or 0, sizes["n"] - (sizes["t"] or 0)
    if not toxic or not clean:
        share = (toxic + 0.5) / (toxic + clean + 1)
        return Lexicon((), (), (math.log(share / (1 - share)), 0.0, 0.0))
    least = max(LEAST_TEXTS, LEAST_SHARE * toxic)
    found = grouped.filter(F.col("pattern") != "  ").filter(
        (F.col("toxic") >= least)
        & (F.col("toxic") >= (F.col("toxic") + F.col("clean")) * CANDIDATE_PRECISION)).collect()
    lexicon = Lexicon(choose_entries(
        [tuple(r) for r in found], toxic, clean, CANDIDATE_PRECISION))

    def phrases(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = (Counter(), Counter())
        for batch in batches:
            for t, y in zip(fold(batch["text"].fillna("").tolist()), batch["label"].tolist()):
                counts[int(y > 0)].update({
                    p for s, e, _ in lexicon.matches(t) for p in _phrases(t, s, e)})
        yield _counted(counts)

    seen = rows.mapInPandas(phrases, "word string, toxic long, clean long").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    mild = seen.filter((F.col("clean") >= max(EXCEPTION_TEXTS, LEAST_SHARE * clean)) & (
        F.col("toxic") <= EXCEPTION_PRECISION * (F.col("toxic") + F.col("clean")))).collect()
    candidates = Lexicon(lexicon.entries, tuple(sorted(r["word"] for r in mild)))

    def uncovered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = (Counter(), Counter())
        for batch in batches:
            for t, y in zip(fold(batch["text"].fillna("").tolist()), batch["label"].tolist()):
                counts[int(y > 0)].update({t[s:e] for s, e, _ in candidates.matches(t)})
        yield _counted(counts)

    # no more rows than there are candidates
    counted = rows.mapInPandas(uncovered, "word string, toxic long, clean long").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter(
        F.col("toxic") >= least).collect()
    chosen = Lexicon(choose_entries([tuple(r) for r in counted], toxic, clean))
    lexicon = Lexicon(chosen.entries, tuple(
        p for p in candidates.exceptions if chosen.matches(p)))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = [lexicon.features(t) for t in fold(batch["text"].fillna("").tolist())]
            yield pd.DataFrame({
                "a": [a for a, _ in x], "b": [b for _, b in x],
                "y": (batch["label"] > 0).astype("int32")})

    table = rows.mapInPandas(features, "a double, b double, y int").toPandas()
    table = table.sort_values(["a", "b", "y"])  # sums in one order
    coefficients = fit(table[["a", "b"]].to_numpy(float), table["y"].to_numpy(float))
    return Lexicon(lexicon.entries, lexicon.exceptions, tuple(coefficients.tolist()))


def _words(folded: str) -> set[str]:
    return set(folded.split())


def _phrases(text: str, start: int, end: int) -> Iterator[str]:
    """The word of a match with the word before it and with the word after it."""
    stop = text.index(" ", max(start + 1, end - 1))
    word = text[start + 1:stop]
    before = text[text.rfind(" ", 0, start) + 1:start] if start else ""
    following = text.find(" ", stop + 1)
    after = text[stop + 1:following if following >= 0 else len(text)]
    if before:
        yield f" {before} {word} "
    if after:
        yield f" {word} {after} "


def _counted(counts: tuple[Counter, Counter]) -> pd.DataFrame:
    clean, toxic = counts
    words = list(clean.keys() | toxic.keys())
    return pd.DataFrame({
        "word": words, "toxic": np.array([toxic[w] for w in words], np.int64),
        "clean": np.array([clean[w] for w in words], np.int64)})


def score(
    docs: DataFrame, lexicon: Lexicon, text: str = "text", into: str = "toxicity",
) -> DataFrame:
    """``docs`` with the probability that the whole text is toxic in column ``into``.

    A missing text counts as empty and gets the score of a text without matches. Equal texts get
    equal scores; a column named like ``into`` is replaced; an empty table gives no rows.
    """
    text_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(lexicon.scores(texts.fillna("").tolist()))

    return docs.withColumn(into, run(text))
