"""Packing token sequences by cutting-stock column generation.

Every document becomes ids and is cut into pieces: whole sequences first, then one rest. Only the
rests need care. How many there are of each length is a small histogram (fewer lengths than a
sequence has tokens, however many documents there are), and how to fill sequences from it is a
cutting-stock problem: a linear program over patterns of lengths. Its columns are generated: the
duals of the present patterns price every length, a knapsack by dynamic programming finds the
pattern of most value, and this pattern enters the basis until a bound shows that little is left to
gain. The patterns are rounded down, and the few rests left over are packed from the longest on.

A pattern says which lengths share a sequence, not which documents. Documents get ranks among those
of their length, and every place of every pattern takes a run of ranks, so that each piece finds its
sequence and offset by itself from a plan whose size does not depend on the number of documents.
"""

from __future__ import annotations

import functools
import itertools
import json
import math
import re
import string
import zlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import portions, text_batches
from starloom.llm.words import distinct
from starloom.session import materialise

#: Column generation ends when this share of the sequences, at most, could still be saved.
GAP = 0.0005

#: Column generation also ends when so many columns in a row entered without saving anything.
STALLED = 200

#: Patterns that one knapsack hands on: the best ones, each around another length.
COLUMNS_AT_ONCE = 64

_EPS = 1e-9

Pattern = tuple[int, ...]


def greedy(counts: Mapping[int, float], capacity: int, whole: bool = True
           ) -> list[tuple[Pattern, float]]:
    """Patterns with copies that use up ``counts``: the longest first, then what still fits.

    Each pattern is repeated as often as its lengths last. Without ``whole``, copies are fractions
    and every pattern uses up a length, so there are no more patterns than lengths.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = np.array(sorted(left), np.int64)
    found = []
    while len(lengths):
        room, pattern, at = capacity, {}, len(lengths)
        while at and room:
            at = min(at, int(np.searchsorted(lengths, room, "right")))
            if at:
                n = int(lengths[at - 1])
                times = room // n if not whole else min(room // n, left[n])
                pattern[n] = times
                room -= n * times
                at -= 1
        copies = min(left[n] // t if whole else left[n] / t for n, t in pattern.items())
        for n, t in pattern.items():
            left[n] -= copies * t
            if left[n] <= _EPS * counts[n]:
                left[n] = 0
        lengths = lengths[[left[n] > 0 for n in lengths.tolist()]]
        found.append((tuple(n for n, t in pattern.items() for _ in range(t)), copies))
    return found


class Knapsack:
    """Patterns of most value for given prices of the lengths."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.lengths, self.capacity = lengths, capacity

    def price(self, prices: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Value of the best pattern, and the best patterns as counts of each length."""
        lengths, capacity = self.lengths, self.capacity
        best = np.zeros(capacity + 1)
        took = np.full(capacity + 1, -1)
        upto = np.searchsorted(lengths, np.arange(capacity + 1), "right")
        for c in range(1, capacity + 1):
            best[c], took[c] = best[c - 1], -1
            n = upto[c]
            if n:
                value = prices[:n] + best[c - lengths[:n]]
                i = value.argmax()
                if value[i] > best[c] + _EPS:
                    best[c], took[c] = value[i], i
        around = prices + best[capacity - lengths]
        first = np.argsort(-around, kind="stable")[:COLUMNS_AT_ONCE]
        columns = []
        for i in first:
            column = np.zeros(len(lengths))
            column[i] += 1
            room = capacity - lengths[i]
            while room > 0:
                j = took[room]
                if j < 0:
                    room -= 1
                else:
                    column[j] += 1
                    room -= lengths[j]
            columns.append(column)
        return best[capacity], columns


def generate(counts: Mapping[int, int], capacity: int, gap: float = GAP
             ) -> tuple[list[tuple[Pattern, float]], float]:
    """Patterns with fractional copies that use up ``counts``, and a lower bound of their number.

    A revised simplex method that begins with the greedy patterns: each uses up one length that no
    later one has, so they are a basis. Ends within ``gap`` of the bound, or half a sequence.
    """
    lengths = np.array(sorted(n for n, c in counts.items() if c > 0), np.int64)
    m = len(lengths)
    if not m:
        return [], 0.0
    place = {n: i for i, n in enumerate(lengths.tolist())}
    demand = np.array([counts[n] for n in lengths.tolist()], float)
    columns, started = [], np.zeros(m, bool)
    left = demand.copy()
    for pattern, copies in greedy(counts, capacity, whole=False):
        column = np.zeros(m)
        for n in pattern:
            column[place[n]] += 1
        left -= copies * column
        columns.append(column)
        ended = np.flatnonzero((left <= 2 * _EPS * demand) & ~started)
        started[ended] = True
        for i in ended[1:]:  # used up together: a pattern of its own, not used so far
            column = np.zeros(m)
            column[i] = capacity // lengths[i]
            columns.append(column)
    basis = np.array(columns).T
    inverse = np.linalg.inv(basis)
    x = inverse @ demand
    knapsack = Knapsack(lengths, capacity)
    bound = demand @ lengths / capacity
    pool: list[np.ndarray] = []
    stalled, least = 0, math.inf
    while stalled < STALLED:
        prices = inverse.sum(0)
        if pool:
            values = np.array(pool) @ prices
            i = int(values.argmax())
        if not pool or values[i] <= 1 + 1e-7:
            best, pool = knapsack.price(prices)
            bound = max(bound, float(prices @ demand) / max(best, 1.0))
            if x.sum() - bound <= max(gap * x.sum(), 0.5) or best <= 1 + 1e-7:
                break
            i = int(np.argmax(np.array(pool) @ prices))
        column = pool.pop(i)
        way = inverse @ column
        able = np.flatnonzero(way > 1e-7)
        out = able[np.argmin(np.maximum(x[able], 0) / way[able])]
        step = max(x[out], 0) / way[out]
        x -= step * way
        x[out] = step
        row = inverse[out] / way[out]
        inverse -= np.outer(way, row)
        inverse[out] = row
        basis[:, out] = column
        number = x.sum()
        stalled = 0 if number < least - _EPS * number else stalled + 1
        least = min(least, number)
    x = np.maximum(x, 0)
    return [(tuple(np.repeat(lengths, basis[:, k].astype(int)).tolist()[::-1]), float(x[k]))
            for k in range(m)], bound


def plan(counts: Mapping[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns with whole copies that use up ``counts`` exactly.

    The generated patterns are rounded down; what is left is packed from the longest on.
    """
    left = {n: int(c) for n, c in counts.items() if c > 0}
    found = []
    for pattern, copies in generate(left, capacity)[0]:
        need = {n: pattern.count(n) for n in set(pattern)}
        copies = min([int(copies + _EPS), *(left[n] // t for n, t in need.items())])
        if copies:
            found.append((pattern, copies))
            for n, t in need.items():
                left[n] -= copies * t
    return found + [(p, int(c)) for p, c in greedy(left, capacity)]


def runs(patterns: Sequence[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, copies, offset) for each length of a pattern.

    Rank r of a length lies in sequence ``first sequence + (r - first) % copies`` at ``offset +
    length * ((r - first) // copies)``.
    """
    ranks: dict[int, int] = {}
    found, sequence = [], 0
    for pattern, copies in patterns:
        offset = 0
        for n in sorted(set(pattern), reverse=True):
            times, first = pattern.count(n), ranks.get(n, 0)
            ranks[n] = first + copies * times
            found.append((n, first, ranks[n], sequence, copies, offset))
            offset += n * times
        sequence += copies
    return found


#: White space to the tokenizer, beyond the six characters of ASCII.
_SPACES = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _letter_tables(codes: range) -> tuple[np.ndarray, np.ndarray]:
    """By the last byte of each letter: whether it is one, and the last byte of its lower case."""
    letter, lower = np.zeros(256, bool), np.arange(256, dtype=np.uint8)
    for c in map(chr, codes):
        letter[c.encode()[-1]] = c.isalpha()
        lower[c.encode()[-1]] = c.lower().encode()[-1]
    return letter, lower


# below U+0130 lower case is one letter for one with the same first byte, whatever stands beside it
_LETTER, _LOWER = _letter_tables(range(0x80))
_TWO_BYTES = {0xC3: _letter_tables(range(0xC0, 0x100)), 0xC4: _letter_tables(range(0x100, 0x130))}

#: Stands between words that are coded together and may fall into several pieces of text.
_FENCE = "\ue000"

#: Distinct words whose ids a Python worker remembers before it starts afresh, and letters of them.
CACHE_WORDS, CACHED_LETTERS = 400_000, 64


def stretches(joined: bytes, is_mark: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of words coded apart: all bytes, starts, stops, which ones are letters alone.

    A word of letters from U+0041 to U+012F with marks behind them or none is a stretch of letters,
    now in lower case, and one of marks. Any other word is one stretch as it stands. ``joined``
    begins and ends with a blank; ``is_mark`` tells for each byte whether it is a mark.
    """
    flat = np.frombuffer(joined, np.uint8)
    blank = _BLANK[flat]
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    stops = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    letter, lower = _LETTER[flat], _LOWER[flat]
    for lead, (is_last, lower_last) in _TWO_BYTES.items():
        at = np.flatnonzero(flat == lead)
        last = flat[at + 1]
        letter[at] = letter[at + 1] = is_last[last]
        lower[at + 1] = lower_last[last]

    # marks at the end of a word are its last run of marks, if that reaches the end
    mark = is_mark[flat]
    begins = np.flatnonzero(mark[1:] & ~mark[:-1]) + 1
    ends = stops.copy()
    marked = np.flatnonzero(mark[stops - 1])
    ends[marked] = begins[np.searchsorted(begins, stops[marked] - 1, "right") - 1]
    letters_upto = np.zeros(len(flat) + 1, np.uint32)  # of a word fewer, so they may wrap
    np.cumsum(letter, dtype=np.uint32, out=letters_upto[1:])
    plain = (ends > starts) & (letters_upto[ends] - letters_upto[starts] == ends - starts)
    ends = np.where(plain, ends, stops)
    if not plain.all():
        inside = np.zeros(len(flat), np.int8)
        inside[starts[~plain]] = 1
        inside[stops[~plain]] = -1
        np.copyto(lower, flat, where=np.cumsum(inside, dtype=np.int8).view(bool))

    tailed = ends < stops
    at = np.arange(len(starts)) + np.cumsum(tailed) - tailed
    behind = at[tailed] + 1
    found = np.empty((2, len(starts) + len(behind)), np.int64)
    found[:, at] = starts, ends
    found[:, behind] = ends[tailed], stops[tailed]
    letters = np.zeros(found.shape[1], bool)
    letters[at] = plain
    return lower, found[0], found[1], letters


class WordCoder:
    """Ids of whole texts, as the tokenizer gives them, with each distinct word coded once.

    For tokenizers that drop white space and end every run of letters with a marked piece: no id
    depends on what lies behind a blank. Letters are coded apart from the marks behind them and in
    lower case, so that a word is coded once for all its spellings. Distinct words of a batch are
    found by hashes over its flat bytes, which are then compared. New words are coded together,
    since a call costs more than a word: words of letters are cut apart at the marked ends, and
    other words are cut apart at a fence that no word holds.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        mark = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        # letters in lower case need neither the normalizer nor the search for runs of letters
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        marks = [m for m in string.punctuation if all(
            self.whole(f"{w}{m} cd") == self.whole(w) + self.whole(m) + self.whole("\n cd")
            for w in ("ab", "Ça"))]
        if not mark or "," not in marks or any(
                self.whole(w) != self._ids(self.letters, w.lower()).tobytes()
                for w in ("ab", "Ça")):
            raise ValueError("only tokenizers that drop white space and mark word ends are read")
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith(mark)
                              for i in range(self.tokenizer.get_vocab_size())])
        self.fence = self.whole(_FENCE)
        self.is_mark = np.isin(np.arange(256), list("".join(marks).encode()))
        self._forget()

    def _forget(self) -> None:
        # ids of the word with number k: flat[upto[k]:upto[k + 1]]
        self.known: dict[bytes, int] = {}
        self.flat, self.upto = np.zeros(1 << 16, "<u4"), np.zeros(1 << 14, np.int64)

    @staticmethod
    def _ids(tokenizer, text: str) -> np.ndarray:
        return np.array(
            tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def whole(self, text: str) -> bytes:
        return self._ids(self.tokenizer, text).tobytes()

    def _one_by_one(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = [self._ids(self.tokenizer, w.decode("utf-8", "replace")) for w in words]
        return np.concatenate(ids), np.array([len(i) for i in ids])

    def _letters(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, in lower case, end to end, and how many each has."""
        ids = self._ids(self.letters, b" ".join(words).decode())
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words):
            return self._one_by_one(words)
        return ids, np.diff(ends, prepend=0)

    def _others(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of any words, end to end, and how many each has."""
        ids = self._ids(self.tokenizer, f" {_FENCE} ".join(
            [w.decode("utf-8", "replace") for w in words]))
        fence = np.frombuffer(self.fence, "<u4")
        k = len(fence)
        hits = np.flatnonzero(np.all([
            ids[j:len(ids) - k + 1 + j] == fence[j] for j in range(k)], axis=0)) if len(
                ids) >= k else np.zeros(0, int)
        if len(hits) != len(words) - 1:
            return self._one_by_one(words)
        keep = np.ones(len(ids), bool)
        keep[(hits[:, None] + np.arange(k)).ravel()] = False
        return ids[keep], np.append(hits, len(ids)) - np.append(0, hits + k)

    def _coded(self, words: list[bytes], letters: np.ndarray, places: np.ndarray
               ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The words at some places, many at once: their places, ids end to end, numbers of ids."""
        alone = letters[places]
        for code, chosen, step in ((self._letters, places[alone], 4096),
                                   (self._others, places[~alone], 1024)):
            for i in range(0, len(chosen), step):
                some = chosen[i:i + step]
                yield some, *code([words[k] for k in some.tolist()])

    def _learn(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Remembers words that are new; returns their numbers."""
        first = len(self.known)
        end = first + len(words)
        at = self.upto[first]
        if at + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 3 * (at + len(ids)) // 2)
        if end >= len(self.upto):
            self.upto = np.resize(self.upto, 3 * end // 2)
        self.flat[at:at + len(ids)] = ids
        self.upto[first + 1:end + 1] = at + np.cumsum(sizes)
        self.known.update(zip(words, range(first, end)))
        return np.arange(first, end)

    def _found(self, words: list[bytes], letters: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words: an array of ids, where a word's begin in it and how many it has.

        Short words are remembered from now on.
        """
        if len(self.known) > CACHE_WORDS:
            self._forget()
        numbers = np.fromiter(
            map(self.known.get, words, itertools.repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(numbers < 0)
        short = np.fromiter((len(words[i]) <= 2 * CACHED_LETTERS for i in new.tolist()), bool)
        for some, ids, sizes in self._coded(words, letters, new[short]):
            numbers[some] = self._learn([words[k] for k in some.tolist()], ids, sizes)
        begins = self.upto[numbers]
        counts = self.upto[numbers + 1] - begins
        at = self.upto[len(self.known)]
        parts = [self.flat[:at]]
        for some, ids, sizes in self._coded(words, letters, new[~short]):
            begins[some] = at + np.cumsum(sizes) - sizes
            counts[some] = sizes
            at += len(ids)
            parts.append(ids)
        return np.concatenate(parts) if len(parts) > 1 else self.flat, begins, counts

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        raw = [(t if t.isascii() else _SPACES.sub(" ", t)).encode("utf-8", "replace")
               for t in texts]
        flat, starts, stops, letters = stretches(b" " + b" ".join(raw) + b" ", self.is_mark)
        if not len(starts):
            return [b""] * len(texts)
        kind, first = distinct(flat, starts, stops)
        joined = flat.tobytes()
        ids, begins, counts = self._found(
            [joined[a:b] for a, b in zip(starts[first].tolist(), stops[first].tolist())],
            letters[first])
        n = counts[kind]
        upto = np.cumsum(n)
        out = ids[np.repeat(begins[kind] - (upto - n), n) + np.arange(upto[-1])]
        borders = np.cumsum([1] + [len(r) + 1 for r in raw])
        at = np.concatenate([[0], upto])[np.searchsorted(starts, borders)].tolist()
        return [out[a:b].tobytes() for a, b in zip(at, at[1:])]


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordCoder:
    """One coder per Python worker."""
    return WordCoder(path)


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int, text: str = "text",
           id_col: str = "doc_id", ids: bool = True) -> DataFrame:
    """Every document's ids and ``end_id``, cut into whole sequences and one rest.

    Rows of id, start, length, ids (array<int>, left out on request), ids_crc32, doc_tokens, and the
    place of a piece among those of its length: its number in the task (``local``) and the task
    (``part``). Such places only hold for one run, so the result must be written before use.
    """
    text_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, start long, length int, {'ids array<int>, ' if ids else ''}"
              "ids_crc32 long, doc_tokens long, part int, local long")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = load(path)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        seen = [0] * (capacity + 1)
        for batch in batches:
            texts = batch["text"].fillna("").tolist()
            for cells in portions(texts):
                rows = []
                for key, coded in zip(batch["id"].iloc[cells], coder.encode(texts[cells])):
                    coded += end
                    for at in range(0, len(coded), 4 * capacity):
                        own = coded[at:at + 4 * capacity]
                        n = len(own) // 4
                        rows.append((
                            key, at // 4, n, *([np.frombuffer(own, "<i4")] if ids else []),
                            zlib.crc32(own), len(coded) // 4, part, seen[n]))
                        seen[n] += 1
                yield pd.DataFrame(rows, columns=names)

    names = [id_col, "start", "length", *(["ids"] if ids else []), "ids_crc32", "doc_tokens",
             "part", "local"]
    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInPandas(
        cut, schema)


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 1, text: str = "text",
         id_col: str = "doc_id", ids: bool = True) -> DataFrame:
    """All documents as pieces in sequences of at most ``capacity`` tokens.

    One row per piece: ``id_col``, start, length, ids, ids_crc32, doc_tokens, sequence_id (gapless
    from 0) and offset (gapless from 0 within the sequence); other columns of ``docs`` are left out,
    whatever their names. A document is cut only where it exceeds a sequence, however long it is. A
    missing or empty text is the end id alone; equal or repeated rows, also those without id, are
    documents like any other; an empty table gives no rows.

    Texts are tokenized once and the pieces written to the shared folder; to the driver comes the
    histogram of lengths, and what is broadcast is the plan, at most a few rows for each pair of a
    pattern and a length in it, both bounded by ``capacity``.
    """
    spark = docs.sparkSession
    laid = materialise(pieces(docs, path, capacity, end_id, text, id_col, ids), "pieces")
    counts = laid.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(
        F.sum("n").alias("n")).collect()}
    whole = histogram.pop(capacity, 0)
    patterns = [((capacity,), whole)] if whole else []
    rows = runs(patterns + plan(histogram, capacity))
    layout = spark.createDataFrame(
        rows, "length int, __first long, __end long, __sequence long, __copies long, __offset long")
    before = counts.select("part", "length", (F.sum("n").over(
        Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("__before"))
    ranked = laid.join(before, ["part", "length"]).withColumn(
        "__rank", F.col("local") + F.col("__before"))
    at = F.col("__rank") - F.col("__first")
    turn = F.floor(at / F.col("__copies"))
    return ranked.join(F.broadcast(layout), (ranked["length"] == layout["length"]) & (
        F.col("__rank") >= F.col("__first")) & (F.col("__rank") < F.col("__end"))).select(
        id_col, "start", ranked["length"].cast("long").alias("length"),
        *(["ids"] if ids else []), "ids_crc32", "doc_tokens",
        (F.col("__sequence") + at % F.col("__copies")).alias("sequence_id"),
        (F.col("__offset") + turn * ranked["length"]).alias("offset"))


def sequences(packed: DataFrame, capacity: int = 2048, pad_id: int = 0) -> DataFrame:
    """One row per sequence: sequence_id, its ids (array<int>) and the lengths of its pieces.

    Ids are padded to ``capacity`` unless their number is a power of two. A group is one sequence,
    so it is bounded.
    """
    found = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(
        F.struct("offset", "length", "ids"))).alias("p"))
    ids = F.flatten(F.col("p.ids"))
    n = F.size(ids)
    full = (F.bit_count(n) == 1) | (n >= capacity)
    return found.select("sequence_id", F.when(full, ids).otherwise(F.concat(
        ids, F.array_repeat(F.lit(pad_id), F.lit(capacity) - n))).alias("ids"),
        F.col("p.length").alias("lengths"))
