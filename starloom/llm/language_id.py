"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram vector binds (multiplies) its three letter
vectors, permuted (rolled) by their place; a text is the bundle (sum) of its trigram vectors. The
prototype of a language is the bundle of all its training texts; a text gets the language whose
prototype has the largest cosine.

Bundling is linear, so each text is counted by trigram first, and one matrix product per batch turns
counts into bundles.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import portions, text_batches

DIMENSIONS = 1024
SEED = 20240611

#: Letter classes: 0 for anything that is no letter, 1-26 a to z, 27-59 the small Latin-1 letters
#: U+00DF to U+00FF, the rest shared by all other letters by code point.
CLASSES = 128
_OWN = 60

#: Texts bundled by one matrix product, kinds of trigrams in it, and letters read at once.
PRODUCT_TEXTS = 128
PRODUCT_TRIGRAMS = 8192
PIECE_LETTERS = 1 << 20

UNDETERMINED = "und"

#: A text whose best cosine is below this many standard deviations of the cosine of unrelated
#: vectors resembles no learned language.
UNRELATED_DEVIATIONS = 3.0

#: Texts of fewer trigrams are too short to tell that.
LEAST_TRIGRAMS = 32


@functools.lru_cache(maxsize=1)
def letter_classes() -> np.ndarray:
    """Class of every code point; capital letters have that of their small ones."""
    out = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        c = chr(point)
        if not c.isalpha():
            continue
        low = c.lower()
        p = ord(low) if len(low) == 1 else point
        if 97 <= p <= 122:
            out[point] = p - 96
        elif 0xDF <= p <= 0xFF:
            out[point] = 27 + p - 0xDF
        else:
            out[point] = _OWN + p * 2654435761 % (1 << 32) % (CLASSES - _OWN)
    return out


@functools.lru_cache(maxsize=4)
def letter_vectors(dimensions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of the classes, rolled for the first, second and third place of a trigram."""
    plain = np.random.default_rng(SEED).integers(0, 2, (CLASSES, dimensions), np.int8) * 2 - 1
    return np.roll(plain, 2, 1), np.roll(plain, 1, 1), plain


def trigram_vectors(codes: np.ndarray, dimensions: int) -> np.ndarray:
    a, b, c = letter_vectors(dimensions)
    bound = a[codes // (CLASSES * CLASSES)] * b[codes // CLASSES % CLASSES]
    return (bound * c[codes % CLASSES]).astype(np.float32)


def trigrams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all trigrams and the text of each. Words are padded; runs of other signs are one.

    Trigrams with no letter in the middle are left out: they tell only where words end.
    """
    classes = letter_classes()
    joined = " ".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    own = classes[points].astype(np.int32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)[:len(own)]
    middle = np.flatnonzero(own)
    before = np.concatenate([[0], own])[middle]
    after = np.concatenate([own[1:], [0]])[middle] if len(own) else own
    return (before * CLASSES + own[middle]) * CLASSES + after, owner[middle]


def pieces(text: str) -> Iterator[np.ndarray]:
    """The trigram codes of a long text, piece by piece; each is in exactly one piece."""
    for start in range(0, len(text), PIECE_LETTERS):
        end = min(len(text), start + PIECE_LETTERS)
        codes, _ = trigrams([text[start:end]])
        classes = letter_classes()
        # the outer neighbours of the first and the last letter belong to other pieces
        if len(codes) and start and classes[ord(text[start])]:
            codes[0] += int(classes[ord(text[start - 1])]) * CLASSES * CLASSES
        if len(codes) and end < len(text) and classes[ord(text[end - 1])]:
            codes[-1] += int(classes[ord(text[end])])
        yield codes


def _bundle(codes: np.ndarray, owner: np.ndarray, n: int, dimensions: int) -> np.ndarray:
    """Sums of the trigram vectors per owner (float64, exact), some kinds of trigrams at a time."""
    total = np.zeros((n, dimensions))
    used = np.zeros(CLASSES ** 3, bool)
    used[codes] = True
    distinct = np.flatnonzero(used)
    place = np.zeros(CLASSES ** 3, np.int32)
    place[distinct] = np.arange(len(distinct))
    places = place[codes]
    if len(distinct) > PRODUCT_TRIGRAMS:
        order = np.argsort(places, kind="stable")
        places, owner = places[order], owner[order]
    for at in range(0, len(distinct), PRODUCT_TRIGRAMS):
        some = distinct[at:at + PRODUCT_TRIGRAMS]
        here = slice(None)
        if len(distinct) > PRODUCT_TRIGRAMS:
            here = slice(*np.searchsorted(places, [at, at + PRODUCT_TRIGRAMS]))
        counts = np.bincount(
            owner[here].astype(np.int64) * len(some) + places[here] - at, minlength=n * len(some))
        total += counts.reshape(n, -1).astype(np.float32) @ trigram_vectors(some, dimensions)
    return total


def bundles(texts: Sequence[str], dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """The bundle of each text (float64, exact whole numbers) and its number of trigrams.

    Texts longer than a piece are bundled piece by piece, so memory is bounded for any script.
    """
    short = [t if len(t) <= PIECE_LETTERS else "" for t in texts]
    codes, owner = trigrams(short)
    sums = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    vectors = _bundle(codes, owner, len(texts), dimensions)
    for i, text in enumerate(texts):
        if len(text) > PIECE_LETTERS:
            for codes in pieces(text):
                vectors[i] += _bundle(codes, np.zeros(len(codes), np.int32), 1, dimensions)[0]
                sums[i] += len(codes)
    return vectors, sums


@dataclass(frozen=True)
class Profiles:
    """Languages in order and their prototypes as unit vectors (rows)."""

    languages: list[str]
    prototypes: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, largest cosine and number of trigrams of each text."""
        n = len(texts)
        best, cosine, sums = np.zeros(n, int), np.zeros(n), np.zeros(n, np.int64)
        for part in portions(texts, PRODUCT_TEXTS):
            vectors, sums[part] = bundles(texts[part], self.prototypes.shape[1])
            if self.languages:
                norms = np.maximum(np.sqrt((vectors * vectors).sum(1)), 1e-12)
                cosines = vectors @ self.prototypes.T / norms[:, None]
                best[part] = cosines.argmax(1)
                cosine[part] = cosines.max(1)
        found = [self.languages[b] if s and self.languages else UNDETERMINED
                 for b, s in zip(best, sums)]
        return found, cosine, sums


def learn(
    docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS,
) -> Profiles:
    """Prototypes from all rows of ``docs`` with a text and a language.

    Each task bundles its rows and hands on one vector per language and slice of its rows; sums per
    language and dimension meet in a small aggregation. The driver receives one vector per language.
    Languages that differ in nothing but name share ties by alphabet. No rows: no languages.
    """
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter(
        "lang IS NOT NULL AND text IS NOT NULL")

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}

        def flush() -> pd.DataFrame:
            out = pd.DataFrame({
                "lang": np.repeat(list(total), dimensions),
                "at": np.tile(np.arange(dimensions, dtype=np.int32), len(total)),
                "value": np.concatenate(list(total.values()))})
            total.clear()
            return out

        for batch in batches:
            for language, group in batch.groupby("lang", sort=True):
                sums = _bundle_of_all(group["text"].tolist(), dimensions)
                total[language] = total.get(language, 0) + sums
            if len(total) > 256:  # labels without bound do not pile up in a task
                yield flush()
        if total:
            yield flush()

    sums = rows.mapInPandas(partial, "lang string, at int, value double").groupBy("lang", "at").agg(
        F.sum("value").alias("value")).groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("at", "value"))).alias("v")).select(
        "lang", F.col("v.value").alias("v")).collect()
    sums = sorted((r for r in sums if any(r["v"])), key=lambda r: r["lang"])
    vectors = np.array([r["v"] for r in sums], float).reshape(len(sums), dimensions)
    return Profiles([r["lang"] for r in sums],
                    vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12))


def _bundle_of_all(texts: list[str], dimensions: int) -> np.ndarray:
    total = np.zeros(dimensions)
    for part in portions(texts, PRODUCT_TEXTS):
        short = [t for t in texts[part] if len(t) <= PIECE_LETTERS]
        for codes in chain([trigrams(short)[0]] if short else [], *[
                pieces(t) for t in texts[part] if len(t) > PIECE_LETTERS]):
            total += _bundle(codes, np.zeros(len(codes), np.int32), 1, dimensions)[0]
    return total


def predict(
    docs: DataFrame, profiles: Profiles, text: str = "text", into: str = "language",
) -> DataFrame:
    """``docs`` with the column ``into`` struct(lang, score, known), replaced if it exists.

    lang is `und` if the text is missing or has no letter (or nothing was learned). score is the
    cosine cut to 0 to 1. known is false if there is no letter, or if a text of some length has a
    cosine no larger than that of unrelated vectors, so it resembles no learned language. The whole
    text counts, however long; equal texts get equal results; ties go to the first language by alphabet.
    """
    text_batches(docs.sparkSession)
    least = UNRELATED_DEVIATIONS / np.sqrt(profiles.prototypes.shape[1] or 1)

    @F.pandas_udf("lang string, score double, known boolean")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang, cosine, sums = profiles.predict(texts.fillna("").tolist())
            yield pd.DataFrame({
                "lang": lang, "score": np.where(sums > 0, np.clip(cosine, 0.0, 1.0), 0.0),
                "known": (sums > 0) & ((cosine >= least) | (sums < LEAST_TRIGRAMS))})

    return docs.withColumn(into, found(text))


def id_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a missing id counts as empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")) % modulus
