"""SentencePiece BPE encoding and decoding with vectorised merge rounds.

Texts are cut where no piece of the vocabulary can reach across (before blanks, and between letters
that stand together in no piece). Each distinct word of a batch is then encoded once: the letters of
all words lie in one flat symbol array; a round finds the pair of the best rank in every segment by
a segmented minimum, merges all its occurrences from left to right at the same time, drops the
symbols merged away and those of finished words, and goes on until no pair is left.

Merging all occurrences at once equals merging one by one as long as no piece that begins or ends
with the new one has an equal or better rank; for the few pieces where that fails, a round merges
only the leftmost occurrence.

Models must be of the BPE kind with byte fallback and without normalisation rules; others are
refused. Only the vocabulary is read through the sentencepiece library.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import portions, text_batches

BLANK = "▁"

#: Distinct words whose ids a Python worker remembers before it starts afresh.
CACHE_WORDS = 200_000

#: A segment of more symbols (a long run without blanks) is merged through a priority queue with the
#: same result, because a round over it for every rank would cost its length squared.
QUEUE_SYMBOLS = 4096

_NO_PAIR = np.int32(2**31 - 1)
_SEGMENT = re.compile(f"{BLANK}+[^{BLANK}]*")


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("starloom_each_byte", _each_byte)


class Model:
    """Vocabulary tables and the merge rounds."""

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = n = library.get_piece_size()
        pieces = [library.id_to_piece(i) for i in range(n)]
        byte = [library.is_byte(i) for i in range(n)]
        plain = [not (byte[i] or library.is_control(i) or library.is_unknown(i)) for i in range(n)]
        if sum(byte) != 256 or any(library.is_unused(i) for i in range(n)):
            raise ValueError("only models with byte fallback and without unused pieces are read")
        probe = "ﬁ Ａ é  x "
        if library.normalize(probe) != BLANK + probe.replace(" ", BLANK):
            raise ValueError("only models without normalisation rules are read")
        ids = {p: i for i, p in enumerate(pieces) if plain[i]}
        self.byte_ids = np.zeros(256, np.int32)
        for i in range(n):
            if byte[i]:
                self.byte_ids[int(pieces[i], 16) if not pieces[i].startswith("<") else int(
                    pieces[i][1:-1], 16)] = i

        # symbols: the pieces, then every code point that is no piece
        self.symbols = n + 0x110000
        self.of_char = np.arange(n, self.symbols, dtype=np.int64)
        for p, i in ids.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i

        def symbol(s: str) -> int | None:
            return int(self.of_char[ord(s)]) if len(s) == 1 else ids.get(s)

        merges: dict[int, int] = {}
        beside: set[int] = set()
        scores = np.array([library.get_score(i) for i in range(n)])
        _, rank = np.unique(-scores, return_inverse=True)
        self.rank = rank.astype(np.int32)
        group = np.bincount(self.rank[[i for i in range(n) if plain[i]]], minlength=n + 1)
        self.alone = np.zeros(n, bool)  # merging all occurrences at once is exact
        self.alone[list(ids.values())] = [group[self.rank[i]] == 1 for i in ids.values()]
        for p, i in ids.items():
            for k in range(1, len(p)):
                left, right = symbol(p[:k]), symbol(p[k:])
                if left is not None and right is not None:
                    merges[left * self.symbols + right] = i
                beside.add(symbol(p[k - 1]) * self.symbols + symbol(p[k]))
                for part in (p[:k], p[k:]):
                    j = ids.get(part)
                    if j is not None and self.rank[i] <= self.rank[j]:
                        self.alone[j] = False
        self.pairs = merges
        self._hash_pairs()
        self.beside = np.array(sorted(beside), np.int64)
        self.cache: dict[str, bytes] = {}

        self.surface: list[bytes] = [
            bytes([int(p[1:-1], 16)]) if byte[i] else p.replace(BLANK, " ").encode()
            if plain[i] else " ⁇ ".encode() if library.is_unknown(i) else b""
            for i, p in enumerate(pieces)]
        self.starts_blank = [plain[i] and p.startswith(BLANK) for i, p in enumerate(pieces)]
        self.control = {i for i in range(n) if library.is_control(i)}

    # -- encoding ----------------------------------------------------------------------

    def _hash_pairs(self) -> None:
        """An open hash table of the pairs, at most a quarter full, empty slots -1."""
        self.bits = max(4, (4 * len(self.pairs)).bit_length())
        self.slot_key = np.full(1 << self.bits, -1, np.int64)
        self.slot_to = np.full(1 << self.bits, -1, np.int32)
        keys = np.array(list(self.pairs), np.int64)
        for key, slot in zip(keys.tolist(), self._slot(keys).tolist()):
            while self.slot_key[slot] >= 0:
                slot = (slot + 1) % len(self.slot_key)
            self.slot_key[slot], self.slot_to[slot] = key, self.pairs[key]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                >> np.uint64(64 - self.bits)).astype(np.int64)

    def _merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, -1 where there is none."""
        keys = left * self.symbols + right
        slot = self._slot(keys)
        found = self.slot_key[slot]
        out = np.where(found == keys, self.slot_to[slot], np.int32(-1))
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) % len(self.slot_key)
            found = self.slot_key[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.slot_to[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def encode_segments(self, segments: Sequence[str]) -> list[bytes]:
        """Piece ids (int32 as bytes) of each segment, a text with its blanks already replaced."""
        if not segments:
            return []
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        points = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)
        sym = self.of_char[points]
        word = np.repeat(np.arange(len(segments)), lengths)
        # cut where two letters stand together in no piece
        keys = sym[:-1] * self.symbols + sym[1:]
        at = np.minimum(np.searchsorted(self.beside, keys), len(self.beside) - 1)
        joined = (self.beside[at] == keys) & (word[:-1] == word[1:])
        part = np.concatenate([[0], np.cumsum(~joined)])
        sizes = np.bincount(part)
        done_sym, done_at = [], []
        place = np.arange(len(sym))
        long = sizes > QUEUE_SYMBOLS
        if long.any():
            for p in np.flatnonzero(long).tolist():
                found = self._by_queue(sym[part == p].tolist())
                done_sym.append(np.array(found, np.int64))
                done_at.append(np.full(len(found), place[part == p][0]))
            rest = ~long[part]
            sym, part, place = sym[rest], part[rest], place[rest]
        for s, a in self._rounds(sym, part, place):
            done_sym.append(s)
            done_at.append(a)
        sym, place = np.concatenate(done_sym), np.concatenate(done_at)
        order = np.argsort(place, kind="stable")
        sym, owner = sym[order], word[place[order]]
        sym, owner = self._bytes_for_unknown(sym, owner)
        flat = sym.astype(np.int32).tobytes()
        ends = (4 * np.cumsum(np.bincount(owner, minlength=len(segments)))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _rounds(self, sym, part, place) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Merge rounds; yields symbols and places as their segments get done."""
        if not len(sym):
            return
        to = np.full(len(sym), -1, np.int32)
        same = part[:-1] == part[1:]
        at = np.flatnonzero(same)
        to[at] = self._merged(sym[at], sym[at + 1])
        while len(sym):
            rank = np.where(to >= 0, self.rank[to], _NO_PAIR)
            starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            sizes = np.diff(np.append(starts, len(sym)))
            best = np.minimum.reduceat(rank, starts)
            open_ = np.repeat(best < _NO_PAIR, sizes)
            if not open_.all():
                yield sym[~open_], place[~open_]
                best = np.repeat(best, sizes)[open_]
                sym, part, place, to, rank = (x[open_] for x in (sym, part, place, to, rank))
                if not len(sym):
                    return
            else:
                best = np.repeat(best, sizes)
            hit = np.flatnonzero(rank == best)
            # of touching occurrences (a a a) every second one, from the left
            fresh = np.concatenate([[True], hit[1:] != hit[:-1] + 1])
            run = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            first = np.concatenate([[True], part[hit[1:]] != part[hit[:-1]]])
            hit = hit[np.where(self.alone[to[hit]], (np.arange(len(hit)) - run) % 2 == 0, first)]
            sym[hit] = to[hit]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            stale = np.zeros(len(sym), bool)  # pairs whose left or right symbol is new
            stale[hit] = True
            sym, part, place, to, stale = (x[keep] for x in (sym, part, place, to, stale))
            stale[:-1] |= stale[1:]
            at = np.flatnonzero(stale)
            inner = at[at < len(sym) - 1]
            inner = inner[part[inner] == part[inner + 1]]
            to[at] = -1
            to[inner] = self._merged(sym[inner], sym[inner + 1])

    def _by_queue(self, sym: list[int]) -> list[int]:
        """The same merges one by one, best rank first, then leftmost."""
        n = len(sym)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        queue: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0:
                to = self.pairs.get(sym[i] * self.symbols + sym[j])
                if to is not None:
                    heapq.heappush(queue, (int(self.rank[to]), i, sym[i], sym[j], to))

        for i in range(n - 1):
            offer(i, i + 1)
        while queue:
            _, i, a, b, to = heapq.heappop(queue)
            j = right[i] if sym[i] == a else -1
            if j < 0 or sym[j] != b:
                continue
            sym[i], sym[j] = to, -1
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [s for s in sym if s >= 0]

    def _bytes_for_unknown(self, sym, owner) -> tuple[np.ndarray, np.ndarray]:
        unknown = np.flatnonzero(sym >= self.size)
        if not len(unknown):
            return sym, owner
        coded = [chr(c).encode("utf-8", "surrogatepass") for c in (sym[unknown] - self.size).tolist()]
        width = np.ones(len(sym), np.int64)
        width[unknown] = [len(c) for c in coded]
        out = np.repeat(sym, width)
        out[np.repeat(sym >= self.size, width)] = self.byte_ids[
            np.frombuffer(b"".join(coded), np.uint8)]
        return out, np.repeat(owner, width)

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids (int32) of each text, without begin and end."""
        return [ids for part in portions(texts) for ids in self._encode(texts[part])]

    def _encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        words = []
        for text in texts:
            if not text:
                words.append([])
            elif "  " in text or text[0] == " " or text[-1] == " " or BLANK in text:
                words.append(_SEGMENT.findall(BLANK + text.replace(" ", BLANK)))
            else:
                words.append(text.split(" "))  # no word is empty or holds a blank
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        known = self.cache
        new = [w for w in set().union(*words) if w not in known]
        coded = self.encode_segments([w if w[0] == BLANK else BLANK + w for w in new])
        known.update(zip(new, coded))
        return [np.frombuffer(b"".join([known[w] for w in ws]), np.int32) for ws in words]

    # -- decoding ----------------------------------------------------------------------

    def decode(self, ids: Sequence[int]) -> str:
        """The text of the ids; the blank put before the first word is taken away.

        Bytes that form no letter become one replacement character each, ids outside the
        vocabulary raise an IndexError.
        """
        ids = ids.tolist() if isinstance(ids, np.ndarray) else list(ids)
        if ids and min(ids) < 0:
            raise IndexError("negative id")
        surface = self.surface
        first = next((i for i in ids if i not in self.control), -1)
        if self.control.isdisjoint(ids):
            found = b"".join([surface[i] for i in ids])
            skip = first >= 0 and self.starts_blank[first]
            return found[skip:].decode("utf-8", "starloom_each_byte")
        # bytes on two sides of a begin or end id do not form one letter
        runs = [self.decode_run(run) for run in _runs(ids, self.control)]
        return "".join(runs)[first >= 0 and self.starts_blank[first]:]

    def decode_run(self, ids: Sequence[int]) -> str:
        return b"".join([self.surface[i] for i in ids]).decode("utf-8", "starloom_each_byte")


def _runs(ids: Sequence[int], breaks: set[int]) -> Iterator[list[int]]:
    run: list[int] = []
    for i in ids:
        if i in breaks:
            yield run
            run = []
        else:
            run.append(i)
    yield run


@functools.lru_cache(maxsize=2)
def load(path: str) -> Model:
    """One model per Python worker."""
    return Model(path)


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text as array<int> in column ``into``.

    A missing or empty text has no ids. Equal rows give equal ids; an empty table gives no rows; a
    column named like ``into`` is replaced.
    """
    text_batches(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load(path)
        for texts in batches:
            yield pd.Series(model.encode(texts.fillna("").tolist()), dtype=object)

    return docs.withColumn(into, ids(text))


def decode(rows: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``rows`` with the text of each id array in column ``into``; a missing array gives ''."""
    text_batches(rows.sparkSession)

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load(path)
        for arrays in batches:
            yield pd.Series(["" if a is None else model.decode(a) for a in arrays], dtype=object)

    return rows.withColumn(into, texts(ids))


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with the column ``tokens`` struct(n_tokens, ids_sha256, decoded_sha256).

    Encodes each whole text and decodes its ids again in one pass, and hands back digests in place
    of the ids (as decimals joined by commas) and of the decoded text (UTF-8), which would be
    several times the size of the texts.
    """
    text_batches(docs.sparkSession)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load(path)
        for texts in batches:
            ids = model.encode(texts.fillna("").tolist())
            yield pd.DataFrame({
                "n_tokens": np.array([len(i) for i in ids], np.int64),
                "ids_sha256": [_sha256(",".join(map(str, i.tolist()))) for i in ids],
                "decoded_sha256": [_sha256(model.decode(i)) for i in ids]})

    return docs.withColumn("tokens", digests(text))


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
