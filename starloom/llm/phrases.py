"""Phrase collocations mined with mergeable Misra-Gries summaries.

How often every run of one to five words occurs cannot be counted whole: most runs occur once. So the
first pass only finds candidates. Tasks hash all runs of words and hand on summaries, each for one
hash partition; where a partition is merged, a Misra-Gries summary keeps as many counters as the
mass of the partition divided by the threshold, with room to spare. When counters run out, all are
lowered by the same amount, which is added up as the error of the summary. A run whose counter plus
error stays below the threshold cannot be frequent. A summary grows rather than let its error reach
half the threshold, so every frequent run survives for certain, whatever its partition holds.

The survivors become a bit map of fixed size. The second pass counts exactly, as texts and not as
hashes, all runs that meet a set bit; a run of words that only shares a bit is counted too, exactly,
and falls below the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import portions, text_batches, whole_text
from starloom.llm.words import distinct, hashes, mixed
from starloom.session import materialise

MOST_WORDS = 5

#: Runs of words of one hash partition, about, and the counters its summary has for them: so many
#: times the mass over the threshold.
PARTITION_MASS, SPARE = 1 << 27, 2

#: Hashes that a task gathers before it hands them on as summaries.
GATHERED = 1 << 21

#: Summaries keep the upper 48 bits of a hash; sorted, their steps fit into 32. Runs that share them
#: are counted together in the first pass, which only lets more of them survive.
_SHORT = np.uint64(16)

#: Keys in one row of a summary, since rows travel to Python many at once.
IN_ROW = 4096

#: Bits of the map of survivors. With more survivors than bits, more runs are counted in the second
#: pass than needed; the result is the same.
MAP_BITS = 26

_LOWER = bytes(range(256)).lower()
_TABLE = bytearray(_LOWER)
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = 10
_TABLE[9] = 32
_TABLE = bytes(_TABLE)


@dataclass
class Runs:
    """The words of some texts, flat, and the runs that begin at each of them."""

    raw: bytes
    starts: np.ndarray
    stops: np.ndarray
    doc: np.ndarray
    hashed: np.ndarray
    piece: np.ndarray
    lang: np.ndarray

    def of(self, n: int, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Where runs of n words begin, and the state of their hashes for the next length."""
        m = len(self.starts) - n + 1
        if n == 1:
            return np.arange(len(self.starts)), mixed(self.hashed + self.lang)
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        state = mixed(before[:m] * np.uint64(3) + self.hashed[n - 1:])
        return np.flatnonzero(self.piece[:m] == self.piece[n - 1:]), state


def _runs(texts: list[str], langs: np.ndarray) -> Runs:
    """Words of texts; ``langs`` are hashes of the languages."""
    cells = [t.encode("utf-8", "replace").translate(_TABLE) for t in texts]
    raw = b"\n" + b"\n".join(cells) + b"\n"
    flat = np.frombuffer(raw, np.uint8)
    gap = (flat == 32) | (flat == 10)
    starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    stops = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    piece = np.cumsum(flat == 10, dtype=np.int64)[starts]
    borders = np.cumsum([1] + [len(c) + 1 for c in cells])
    doc = np.searchsorted(borders, starts, "right") - 1
    return Runs(raw, starts, stops, doc, hashes(flat, starts, stops), piece, langs[doc])


def _lang_hashes(langs: list[str]) -> np.ndarray:
    cells = [x.encode("utf-8", "replace") for x in langs]
    flat = np.frombuffer(b"".join(cells) + b"\n", np.uint8)
    stops = np.cumsum([len(c) for c in cells])
    starts = stops - np.array([len(c) for c in cells])
    return mixed(hashes(flat, starts, stops))


def _tables(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list[str], Runs]]:
    for batch in batches:
        texts, langs = batch["text"].tolist(), batch["lang"].tolist()
        for cells in portions(texts, rows=4096):
            yield langs[cells], _runs(texts[cells], _lang_hashes(langs[cells]))


def _summaries(batches: Iterator[pd.DataFrame], partitions: int) -> Iterator[pd.DataFrame]:
    """Hashes of all runs with their numbers, as rows for each hash partition and flush."""
    held: list[np.ndarray] = []

    def flush() -> pd.DataFrame:
        every = np.concatenate(held)
        held.clear()
        every.sort()
        heads = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        keys, counts = every[heads], np.diff(np.r_[heads, len(every)]).astype(np.uint32)
        part = ((keys >> np.uint64(16)) * np.uint64(partitions)) >> np.uint64(32)
        steps = np.diff(keys)
        # a row ends with its partition, after so many keys, and before a step of more than 32 bits
        cuts = np.unique(np.r_[
            0, np.arange(0, len(keys), IN_ROW), len(keys),
            np.flatnonzero((part[1:] != part[:-1]) | (steps >> np.uint64(32) > 0)) + 1])
        steps = steps.astype(np.uint32)
        return pd.DataFrame([
            (p, first, steps[i:j - 1].tobytes(), counts[i:j].tobytes())
            for p, first, i, j in zip(part[cuts[:-1]].tolist(), keys[cuts[:-1]].tolist(),
                                      cuts[:-1].tolist(), cuts[1:].tolist())],
            columns=["p", "first", "steps", "counts"])

    for _, runs in _tables(batches):
        state = None
        for n in range(1, MOST_WORDS + 1):
            at, state = runs.of(n, state)
            held.append(state[at] >> _SHORT)
        if sum(map(len, held)) >= GATHERED:
            yield flush()
    if any(map(len, held)):
        yield flush()


@dataclass
class Summary:
    """A Misra-Gries summary: counters, the amount they were lowered by, and what is still to add."""

    threshold: int
    capacity: int
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    error: int = 0
    mass: int = 0
    waiting: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.mass += int(counts.sum())
        if sum(len(k) for k, _ in self.waiting) >= max(len(self.keys), self.capacity):
            self.merge()

    def merge(self) -> None:
        if not self.waiting:
            return
        every = np.concatenate([self.keys, *[k for k, _ in self.waiting]])
        counts = np.concatenate([self.counts, *[c for _, c in self.waiting]])
        self.waiting = []
        order = np.argsort(every)
        every = every[order]
        heads = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        self.keys, self.counts = every[heads], np.add.reduceat(counts[order], heads)
        while len(self.keys) > self.capacity:
            # lowering by the largest count that finds no place leaves at most ``capacity`` counters
            place = len(self.counts) - self.capacity - 1
            lower = int(np.partition(self.counts, place)[place])
            if self.error + lower >= (self.threshold + 1) // 2:
                self.capacity *= 2
                continue
            self.error += lower
            stay = self.counts > lower
            self.keys, self.counts = self.keys[stay], self.counts[stay] - lower

    def survivors(self) -> np.ndarray:
        """Every key that may have occurred ``threshold`` times, and few others."""
        self.merge()
        return self.keys[self.counts + self.error >= self.threshold]


def _merged(batches: Iterator[pd.DataFrame], threshold: int, capacity: int
            ) -> Iterator[pd.DataFrame]:
    """Survivors of each hash partition; rows of a partition follow each other."""
    now, summary = None, Summary(threshold, capacity)
    for batch in batches:
        for p, first, steps, counts in batch.itertuples(index=False):
            if p != now:
                yield pd.DataFrame({"key": summary.survivors().view(np.int64)})
                now, summary = p, Summary(threshold, capacity)
            keys = np.cumsum(np.r_[np.uint64(first), np.frombuffer(steps, np.uint32)], dtype=np.uint64)
            summary.add(keys, np.frombuffer(counts, np.uint32).astype(np.int64))
    yield pd.DataFrame({"key": summary.survivors().view(np.int64)})


def survivors(docs: DataFrame, threshold: int) -> DataFrame:
    """Hashes (key long) of runs of one to five words, among them all that occur so often.

    ``docs`` has text and lang, none of them missing.
    """
    spark = docs.sparkSession
    # a run of words has two bytes a word at least
    mass = MOST_WORDS * ((docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 2 + 1)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                     math.ceil(mass / PARTITION_MASS))
    capacity = SPARE * (mass // partitions // threshold + 1)
    parts = docs.mapInPandas(
        lambda b: _summaries(b, partitions), "p long, first long, steps binary, counts binary")
    return parts.repartition(partitions, "p").sortWithinPartitions("p").mapInPandas(
        lambda b: _merged(b, threshold, capacity), "key long")


def bit_map(keys: DataFrame, bits: int = MAP_BITS) -> np.ndarray:
    """The keys as set bits of 2^bits, gathered in Spark; its size does not depend on the keys."""
    place = F.col("key").bitwiseAND((1 << bits) - 1)
    words = keys.select(F.shiftright(place, 6).alias("w"), F.expr(
        f"shiftleft(1L, cast(key & 63 as int))").alias("b")).groupBy("w").agg(
        F.bit_or("b").alias("b")).toArrow()
    found = np.zeros((1 << bits) // 64, np.int64)
    found[words["w"].to_numpy()] = words["b"].to_numpy()
    return found


def _counted(batches: Iterator[pd.DataFrame], bits: np.ndarray) -> Iterator[pd.DataFrame]:
    """Runs that meet a set bit, as texts with their numbers; the words of a language under n 0."""
    places = np.uint64(len(bits) * 64 - 1)
    for langs, runs in _tables(batches):
        kinds = {x: i for i, x in enumerate(dict.fromkeys(langs))}
        names = list(kinds)
        lang = np.array([kinds[x] for x in langs], np.int64)[runs.doc]
        words = np.bincount(lang, minlength=len(names))
        yield pd.DataFrame({"lang": names, "n": 0, "phrase": "", "f": words})
        kind, _ = distinct(np.frombuffer(runs.raw, np.uint8), runs.starts, runs.stops, runs.hashed)
        starts, stops = runs.starts.tolist(), runs.stops.tolist()
        state = None
        for n in range(1, MOST_WORDS + 1):
            at, state = runs.of(n, state)
            place = (state[at] >> _SHORT) & places
            at = at[(bits[(place >> np.uint64(6)).astype(np.int64)].view(np.uint64)
                     >> (place & np.uint64(63))) & np.uint64(1) == 1]
            if not len(at):
                continue
            # equal runs are those of equal words and language, whatever their hashes
            _, first, same, f = np.unique(
                state[at], return_index=True, return_inverse=True, return_counts=True)
            head = at[first][same]
            if not (np.array_equal(lang[at], lang[head]) and all(
                    np.array_equal(kind[at + k], kind[head + k]) for k in range(n))):
                columns = np.stack([lang[at], *[kind[at + k] for k in range(n)]])
                _, first, f = np.unique(columns, axis=1, return_index=True, return_counts=True)
            heads = at[first].tolist()
            texts = [b" ".join([runs.raw[starts[j]:stops[j]] for j in range(i, i + n)]).decode(
                "utf-8", "replace") for i in heads]
            yield pd.DataFrame({"lang": [names[x] for x in lang[at[first]].tolist()], "n": n,
                                "phrase": texts, "f": f})


def frequent(docs: DataFrame, threshold: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """Runs of one to five words with their exact numbers, of ``threshold`` or more.

    Rows lang, n (words of the run), phrase (joined by blanks), f long; with n 0 and an empty phrase
    the number of all words of each language.
    """
    spark = docs.sparkSession
    text_batches(spark)
    rows = docs.select(whole_text(text).alias("text"),
                       F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    bits = spark.sparkContext.broadcast(bit_map(survivors(rows, threshold)))
    counted = rows.mapInPandas(
        lambda b: _counted(b, bits.value), "lang string, n int, phrase string, f long")
    return materialise(counted.groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f")).filter(
        (F.col("n") == 0) | (F.col("f") >= threshold)), "phrases")


def _exact_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (left right)) in whole numbers of up to 38 digits."""
    big = T.DecimalType(19, 0)
    upper = (a.cast(big) * n.cast(big)).cast("decimal(35,0)") * F.lit(1000).cast("decimal(4,0)")
    return F.call_function("div", upper.cast("decimal(38,0)"),
                           (left.cast(big) * right.cast(big)).cast("decimal(38,0)"))


def collocations(docs: DataFrame, threshold: int = 100, most: int = 2000, text: str = "text",
                 lang: str = "lang") -> DataFrame:
    """The phrases of two to five words that stand out in each language.

    Rows lang, rank, phrase, a (its number), l, r (of the two parts of its lowest-scoring cut), n
    (words of the language), score = floor(1000 a n / (l r)). A phrase that one more word always
    goes with is left out, since the longer one stands for it. Of each language the ``most`` best by
    score, number and phrase are returned.

    A missing text is empty, a missing language ``und``; other columns, whatever their names, and
    repeated rows play no part but in the numbers; an empty table or texts without words give no
    rows. Texts are read in portions of about a million letters, a longer one alone. ``a n`` may
    reach 10^35.
    """
    found = frequent(docs, threshold, text, lang)
    words = found.filter("n = 0").select("lang", F.col("f").alias("n"))
    parts = found.filter("n > 0").select("lang", "phrase", "f")
    phrases = found.filter("n > 1").select("lang", "phrase", F.col("f").alias("a"), "n")
    w = F.split("phrase", " ", -1)

    def joined(start: Column | int, size: Column) -> Column:
        return F.array_join(F.slice(w, start, size), " ")

    # one word more is enough: a run between the two would occur as often
    inside = phrases.filter("n > 2").select("lang", F.explode(F.array(
        joined(1, F.col("n") - 1), joined(2, F.col("n") - 1))).alias("phrase"), "a").groupBy(
        "lang", "phrase").agg(F.max("a").alias("longer"))
    kept = phrases.join(inside, ["lang", "phrase"], "left").filter(
        "longer IS NULL OR longer < a").drop("longer")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1))).select(
        "lang", "phrase", "a", "k", joined(1, F.col("k")).alias("left"),
        joined(F.col("k") + 1, F.col("n") - F.col("k")).alias("right"))
    cuts = cuts.join(
        parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")),
        ["lang", "left"]).join(
        parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")),
        ["lang", "right"]).join(words, "lang")
    scored = cuts.withColumn("score", _exact_score(
        F.col("a"), F.col("n"), F.col("l"), F.col("r")).cast("long"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score").withColumn(
        "rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= most).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
