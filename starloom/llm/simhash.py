"""SimHash near-duplicates with the generalised pigeonhole principle.

The 64 bits are grouped into partitions, correlated bits together. If two fingerprints differ in at
most R bits and the thresholds t_i (-1 or more) satisfy sum(t_i + 1) = R + 1, some partition differs
in at most t_i bits. Dynamic programming picks the thresholds with the least estimated cost, from
the bit statistics of all fingerprints. A fingerprint emits, for every choice of t_i bits of a
partition, the other bits of that partition as a signature; fingerprints that share a signature are
candidates, and their distance is checked.

Links inside a bucket are not listed as pairs: a bucket hands on a spanning forest of its links,
which keeps all connections with fewer edges than members. Where links must also pass a check of the
texts, a second search lists every link between groups that the checked forest left apart.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import LOCATOR, id_order, slim_batches, text_batches, with_locator
from starloom.llm.components import connected_components
from starloom.session import materialise

BITS = 64
SEED = 42

#: Cost of a signature that is shuffled and sorted, and of a distance checked within a bucket.
SIGNATURE_COST, PAIR_COST = 1.0, 0.01

#: A partition gives a fingerprint at most so many signatures; thresholds beyond are not considered.
MOST_SIGNATURES = 512

#: Members of a bucket that are compared in one go; larger buckets are cut and their parts compared
#: two by two in tasks of their own.
BUCKET_ROWS = 4096

#: Buckets up to this size list all their links, larger ones a spanning forest.
LISTED_ROWS = 32


# -- fingerprints --------------------------------------------------------------------------


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of ``words`` words, repeats included.

    A to Z are lower-cased; words are split at ASCII white space and joined by one blank. A text of
    fewer words is one shingle, a text without words has none.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    starts = [0, *itertools.accumulate([len(w) + 1 for w in found])]
    digest = xxhash.xxh64_intdigest
    return np.array([
        digest(joined[a:b - 1], SEED) for a, b in zip(starts, starts[words:])], np.uint64)


def fingerprints(texts: Sequence[str], words: int) -> np.ndarray:
    """SimHash of each text as uint64: bits set in over half of its shingle hashes."""
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        hashes = shingle_hashes(text, words)
        ones = np.zeros(BITS, np.int64)
        for at in range(0, len(hashes), 1 << 16):
            part = hashes[at:at + (1 << 16)]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(0, dtype=np.int64)
        if len(hashes):
            out[i] = np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0]
    return out


def with_fingerprint(docs: DataFrame, words: int, text: str = "text") -> DataFrame:
    """``docs`` with the column ``fp`` (long): the fingerprint of the whole text, 0 if missing."""
    text_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(fingerprints(texts.fillna("").tolist(), words).view(np.int64))

    return docs.withColumn("fp", fp(text))


# -- partitions and thresholds -------------------------------------------------------------


@dataclass(frozen=True)
class Plan:
    """Bits of each partition and its threshold (-1: not probed)."""

    partitions: list[list[int]]
    thresholds: list[int]

    def signatures(self) -> list[int]:
        """Masks of the bits that stay, one per signature that a fingerprint emits."""
        return [
            sum(1 << b for b in bits if b not in gone)
            for bits, t in zip(self.partitions, self.thresholds) if t >= 0
            for gone in map(set, itertools.combinations(bits, t))]


def group_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """``parts`` groups of nearly equal size; each grows by the bit most correlated with it."""
    strength = np.abs(correlation)
    left = np.ones(len(strength), bool)
    groups = []
    for i in range(parts):
        size = int(left.sum()) // (parts - i)
        pull = strength[:, left].sum(1)  # the first bit is the one most correlated with the rest
        group: list[int] = []
        while len(group) < size:
            bit = int(np.where(left, pull, -1.0).argmax())
            pull = strength[:, bit] + (pull if group else 0.0)
            group.append(bit)
            left[bit] = False
        groups.append(sorted(group))
    return groups


def distance_chances(differ: Sequence[float], most: int) -> list[float]:
    """Chances that two fingerprints differ in 0 to ``most`` of the bits, bit by bit."""
    chances = [1.0] + [0.0] * most
    for q in differ:
        chances = [c * (1 - q) + (chances[d - 1] * q if d else 0.0) for d, c in enumerate(chances)]
    return chances


def make_plan(n: int, ones: np.ndarray, together: np.ndarray, radius: int) -> Plan:
    """The cheapest partitions and thresholds for ``n`` fingerprints.

    ones[i]: fingerprints with bit i; together[i, j]: with both. Candidates are estimated from the
    chance that a bit differs between two fingerprints.
    """
    p = ones / max(1, n)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    correlation = (together / max(1, n) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(correlation, 0.0)
    differ = np.clip(2 * p * (1 - p), 1e-6, 1.0)
    pairs = n * (n - 1) / 2

    def cost(bits: list[int], t: int) -> float:
        if t < 0:
            return 0.0
        chances = distance_chances(differ[bits], t)
        shared = sum(c * math.comb(len(bits) - d, t - d) for d, c in enumerate(chances))
        return SIGNATURE_COST * n * math.comb(len(bits), t) + PAIR_COST * pairs * shared

    best: tuple[float, Plan] | None = None
    for parts in range(1, min(BITS, 2 * radius + 2) + 1):
        groups = group_bits(correlation, parts)
        # table[s]: least cost and thresholds of the groups so far with sum(t + 1) = s
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for bits in groups:
            new: dict[int, tuple[float, list[int]]] = {}
            prices = {t: cost(bits, t) for t in range(-1, min(radius, len(bits)) + 1)
                      if t < 1 or math.comb(len(bits), t) <= MOST_SIGNATURES}
            for s, (c, ts) in table.items():
                for t, price in prices.items():
                    if s + t + 1 <= radius + 1 and (
                            s + t + 1 not in new or c + price < new[s + t + 1][0]):
                        new[s + t + 1] = (c + price, [*ts, t])
            table = new
        if radius + 1 in table and (best is None or table[radius + 1][0] < best[0]):
            best = table[radius + 1][0], Plan(groups, table[radius + 1][1])
    return best[1]


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of fingerprints, of each bit and of each pair of bits, over all rows."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((BITS, BITS))
        n = 0
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64)
            for at in range(0, len(fps), 1 << 16):
                part = fps[at:at + (1 << 16)]
                bits = np.unpackbits(
                    part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
                n += len(part)
        if n:
            i, j = np.triu_indices(BITS)
            yield pd.DataFrame({"i": i, "j": j, "n": total[i, j].astype(np.int64)})
            yield pd.DataFrame({"i": [-1], "j": [-1], "n": [n]})

    with slim_batches(nodes.sparkSession):
        rows = nodes.select("fp").mapInPandas(partial, "i int, j int, n long").groupBy("i", "j").agg(
            F.sum("n").alias("n")).collect()
    n, together = 0, np.zeros((BITS, BITS))
    for r in rows:
        if r["i"] < 0:
            n = r["n"]
        else:
            together[r["i"], r["j"]] = together[r["j"], r["i"]] = r["n"]
    return n, np.diag(together).copy(), together


# -- links ---------------------------------------------------------------------------------


def forest(values: np.ndarray, radius: int) -> np.ndarray:
    """Edges (m, 2) that connect the values as all links within ``radius`` would.

    Every value is compared with those not reached yet, so a dense group costs little and gives one
    edge per member.
    """
    left = values.copy()
    edges = []
    while len(left):
        reach, left = [left[0]], left[1:]
        while reach and len(left):
            x = reach.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                found, left = left[near], left[~near]
                edges.append(np.column_stack([np.full(len(found), x), found]))
                reach.extend(found)
    return np.concatenate(edges) if edges else np.zeros((0, 2), values.dtype)


def listed(keys: np.ndarray, values: np.ndarray, radius: int) -> np.ndarray:
    """All links between rows of equal key, rows sorted by key."""
    edges = []
    here = np.arange(len(keys))
    step = 1
    while len(here):
        here = here[here + step < len(keys)]
        here = here[keys[here] == keys[here + step]]
        near = here[np.bitwise_count(values[here] ^ values[here + step]) <= radius]
        edges.append(np.column_stack([values[near], values[near + step]]))
        step += 1
    return np.concatenate(edges) if edges else np.zeros((0, 2), values.dtype)


#: Words of a sketch, and the columns of a member of the search for links that are left.
SKETCH = 4
MEMBER = ["fp", "n", "group", "size", *[f"s{i}" for i in range(SKETCH)]]


class _Buckets:
    """Reads rows sorted by key and hands on edges, and the parts of buckets that may go on elsewhere."""

    def __init__(self, radius: int, most_listed: int = 0):
        self.radius, self.most_listed = radius, most_listed
        self.edges: list[np.ndarray] = []
        self.parts: list[tuple[int, bytes]] = []

    def read(self, batch: pd.DataFrame) -> np.ndarray:
        return batch["fp"].to_numpy(np.int64).view(np.uint64)

    def unpack(self, part: bytes) -> np.ndarray:
        return np.frombuffer(part, np.uint64)

    def closed(self, keys: np.ndarray, values: np.ndarray) -> Iterator[pd.DataFrame]:
        """Whole buckets."""
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(keys)))
        small = np.repeat((sizes > 1) & (sizes <= self.most_listed), sizes)
        self.edges.append(listed(keys[small], values[small], self.radius))
        large = sizes > max(1, self.most_listed)
        for s, n in zip(starts[large], sizes[large]):
            self.edges.append(forest(values[s:s + n], self.radius))
        yield from self.full()

    def part(self, key: int, values: np.ndarray) -> Iterator[pd.DataFrame]:
        """A part of a bucket that may have others."""
        self.edges.append(forest(values, self.radius))
        self.parts.append((int(key), values.tobytes()))
        yield from self.full()

    def across(self, x: np.ndarray, y: np.ndarray) -> Iterator[pd.DataFrame]:
        """Two parts of one bucket."""
        self.edges.append(forest(np.concatenate([x, y]), self.radius))
        yield from self.full()

    def full(self) -> Iterator[pd.DataFrame]:
        if sum(map(len, self.edges)) > 1 << 18:
            yield from self.flush()

    def flush(self) -> Iterator[pd.DataFrame]:
        found = np.concatenate([e for e in self.edges if len(e)] or [np.zeros((0, 2), np.uint64)])
        found = np.unique(np.column_stack([found.min(1), found.max(1)]), axis=0).view(np.int64)
        if len(found):
            yield pd.DataFrame({
                "a": found[:, 0], "b": found[:, 1], "key": None, "part": None}).astype(
                {"key": "Int64", "part": object})
        if self.parts:
            yield pd.DataFrame({
                "a": None, "b": None, "key": [k for k, _ in self.parts],
                "part": [v for _, v in self.parts]}).astype({"a": "Int64", "b": "Int64"})
        self.edges, self.parts = [], []


class _Left(_Buckets):
    """Lists every link between members of different groups that the sketches do not rule out.

    Sets of a and b shingles reach a similarity of ``least`` only if at most
    (a + b) (1 - least) / (1 + least) shingles are in one of them alone. Each such shingle flips one
    bit of a sketch, so sketches that differ in more bits rule a link out for certain.
    """

    def __init__(self, radius: int, least: float):
        super().__init__(radius)
        self.share = (1 - least) / (1 + least)

    def read(self, batch: pd.DataFrame) -> np.ndarray:
        return np.ascontiguousarray(batch[MEMBER].to_numpy(np.int64)).view(np.uint64)

    def unpack(self, part: bytes) -> np.ndarray:
        return np.frombuffer(part, np.uint64).reshape(-1, len(MEMBER))

    def pairs(self, x: np.ndarray, y: np.ndarray) -> None:
        """Row by row of ``x`` and ``y``."""
        at = np.flatnonzero(
            (x[:, 2] != y[:, 2]) & (np.bitwise_count(x[:, 0] ^ y[:, 0]) <= self.radius))
        if len(at):
            x, y = x[at], y[at]
            alone = np.maximum(
                np.bitwise_count(x[:, 4:] ^ y[:, 4:]).sum(1, dtype=np.int64),
                np.abs(x[:, 3].astype(np.int64) - y[:, 3].astype(np.int64)))
            able = alone <= (x[:, 3] + y[:, 3]) * self.share + 1e-6
            self.edges.append(np.column_stack([x[able, 1], y[able, 1]]))

    def closed(self, keys: np.ndarray, values: np.ndarray) -> Iterator[pd.DataFrame]:
        here = np.arange(len(keys))
        step = 1
        while len(here):
            here = here[here + step < len(keys)]
            here = here[keys[here] == keys[here + step]]
            self.pairs(values[here], values[here + step])
            yield from self.full()
            step += 1

    def part(self, key: int, values: np.ndarray) -> Iterator[pd.DataFrame]:
        yield from self.closed(np.full(len(values), key), values)
        self.parts.append((int(key), values.tobytes()))

    def across(self, x: np.ndarray, y: np.ndarray) -> Iterator[pd.DataFrame]:
        for row in x:
            self.pairs(np.broadcast_to(row, y.shape), y)
            yield from self.full()


def _bucket_links(search: Callable[[], _Buckets]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = search()
        keys, values = np.zeros(0, np.int64), out.unpack(b"")
        first = True  # the first bucket of a task may have begun in another one
        for batch in batches:
            keys = np.concatenate([keys, batch["key"].to_numpy(np.int64)])
            values = np.concatenate([values, out.read(batch)])
            if first and len(keys) and keys[0] != keys[-1]:
                n = int(np.searchsorted(keys != keys[0], True))
                yield from out.part(keys[0], values[:n])
                keys, values, first = keys[n:], values[n:], False
            if len(keys):
                n = int(np.flatnonzero(keys == keys[-1])[0])  # the last bucket may go on
                if n:
                    yield from out.closed(keys[:n], values[:n])
                    keys, values = keys[n:], values[n:]
                while len(keys) >= BUCKET_ROWS:
                    yield from out.part(keys[0], values[:BUCKET_ROWS])
                    keys, values = keys[BUCKET_ROWS:], values[BUCKET_ROWS:]
                    first = True  # what follows belongs to a bucket that was cut
        if len(keys):
            yield from out.part(keys[0], values)
        yield from out.flush()

    return run


def _part_links(search: Callable[[], _Buckets]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = search()
        for batch in batches:
            for a, b in zip(batch["part"], batch["part_2"]):
                for found in out.across(out.unpack(a), out.unpack(b)):
                    yield found[["a", "b"]]
        for found in out.flush():
            yield found[["a", "b"]]

    return run


def links(nodes: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) that connect distinct fingerprints ``fp`` as all links within ``radius`` would.

    An empty table gives no edges.
    """
    most_listed = LISTED_ROWS
    return _search(nodes, radius, lambda: _Buckets(radius, most_listed), ["fp"], "fp")


def links_left(members: DataFrame, radius: int, least: float) -> DataFrame:
    """Edges (a, b): every two ``n`` of different ``group`` within ``radius`` that may be alike.

    ``members`` has the columns ``MEMBER``. None that reaches the similarity ``least`` is left out.
    """
    return _search(members, radius, lambda: _Left(radius, least), MEMBER, "n")


def _search(
    nodes: DataFrame, radius: int, search: Callable[[], _Buckets], columns: list[str], order: str,
) -> DataFrame:
    """Deals buckets out by ranges of (signature, order), so a large bucket spans several tasks; its
    parts then meet two by two.
    """
    spark = nodes.sparkSession
    n, ones, together = bit_statistics(nodes)
    masks = make_plan(n, ones, together, radius).signatures()
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(signed)])
    rows = nodes.select(F.explode(keys).alias("key"), *columns)
    # about one signature of a task's sort buffer for every 16 bytes
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                n * len(masks) * (1 + len(columns)) // (1 << 23))
    dealt = rows.repartitionByRange(tasks, "key", order).sortWithinPartitions("key", order)
    with slim_batches(spark):
        found = materialise(dealt.mapInPandas(
            _bucket_links(search), "a long, b long, key long, part binary"), "links")
    parts = found.filter("part IS NOT NULL").select(
        "key", "part", F.xxhash64("part").alias("number"))
    again = parts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    parts = parts.join(again, "key")
    met = parts.join(parts.select(
        "key", F.col("part").alias("part_2"), F.col("number").alias("number_2")), "key").filter(
        "number < number_2").select("part", "part_2").repartition(tasks)
    across = met.mapInPandas(_part_links(search), "a long, b long")
    return found.filter("a IS NOT NULL").select("a", "b").unionByName(across).distinct()


def hex_of(fp: str | Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_components(
    docs: DataFrame, radius: int = 3, words: int = 3, text: str = "text", id_col: str = "doc_id",
) -> DataFrame:
    """One row per row of ``docs``: id, fp and component_id, the least id reachable over links.

    Fingerprints link at ``radius`` or fewer differing bits. Rows with equal fingerprints are one
    node, however many they are. Texts that are missing or without words have fingerprint 0 and link
    like any other. Rows without id count as members but never name a component (a component of such
    rows alone has none). Other columns are not read; an empty table gives no rows.
    """
    rows = materialise(with_fingerprint(
        docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), words).select(
        "id", "fp"), "fingerprints")
    nodes = materialise(rows.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    found = connected_components(links(nodes, radius))
    named = nodes.join(found, F.col("fp") == F.col("node"), "left")
    linked = named.filter("component IS NOT NULL")
    # written, so that the join below can split a large component
    names = materialise(linked.groupBy("component").agg(F.min("least").alias("name")), "names")
    result = linked.join(names, "component").select("fp", "name").unionByName(
        named.filter("component IS NULL").select("fp", F.col("least").alias("name")))
    return rows.join(result, "fp").select(
        F.col("id").alias(id_col), "fp", F.col("name").alias("component_id"))


def one_of_each(
    docs: DataFrame, radius: int = 3, words: int = 3, text: str = "text", id_col: str = "doc_id",
) -> DataFrame:
    """``docs`` with one row of each component of near-duplicates, all columns as they were.

    Components are those of ``near_components``: fingerprints of ``words``-word shingles link at
    ``radius`` or fewer differing bits. The row with the least id stays (rows without id last, equal
    ids by place). Missing texts and texts without words have fingerprint 0 and link like any other;
    texts are read whole, however long. An empty table gives no rows; other columns, whatever their
    names, are kept.
    """
    located = with_locator(docs)
    rows = materialise(with_fingerprint(located.select(
        F.col(id_col).alias("id"), F.col(text).alias("text"), LOCATOR), words).select(
        id_order("id").alias("row"), "fp"), "fingerprints")
    nodes = materialise(rows.groupBy("fp").agg(
        F.min("row").alias("least"), F.count(F.lit(1)).alias("copies")), "nodes")
    found = connected_components(links(nodes.select("fp"), radius))
    grouped = materialise(nodes.join(found, F.col("fp") == F.col("node"), "left").filter(
        "component IS NOT NULL OR copies > 1").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")), "grouped")
    # written, so that the joins below can split a large component
    stays = materialise(grouped.groupBy("component").agg(F.min("least").alias("stays")), "stays")
    named = materialise(grouped.join(stays, "component").select("fp", "stays"), "named")
    goes = rows.join(named, "fp").filter("row <> stays").select(F.col("row.at").alias(LOCATOR))
    return located.join(goes, LOCATOR, "left_anti").select(*docs.columns)


# -- near-duplicates with a check of the texts ----------------------------------------------


def with_same(docs: DataFrame, words: int, text: str = "text") -> DataFrame:
    """``docs`` with the column ``same`` (binary): XXH128 of the sorted distinct shingle hashes."""
    @F.pandas_udf("binary")
    def same(texts: pd.Series) -> pd.Series:
        return pd.Series([
            xxhash.xxh128_digest(np.unique(shingle_hashes(t, words)).tobytes())
            for t in texts.fillna("")], dtype=object)

    return docs.withColumn("same", same(text))


def shingle_set(words: int):
    """UDF: distinct shingle hashes of a text, sorted, as bytes."""
    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([
            np.unique(shingle_hashes(t, words)).tobytes() for t in texts.fillna("")], dtype=object)

    return run


def similarity():
    """UDF: Jaccard similarity of two shingle sets; two empty sets are equal."""
    def one(x: bytes, y: bytes) -> float:
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        return both / (len(x) + len(y) - both) if len(x) + len(y) else 1.0

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([one(x, y) for x, y in zip(a, b)], dtype=float)

    return run


def sketch():
    """UDF: a shingle set folded to ``SKETCH`` words; every shingle flips one bit."""
    @F.pandas_udf("array<long>")
    def run(sets: pd.Series) -> pd.Series:
        bits = 64 * SKETCH
        return pd.Series([
            np.packbits(np.bincount(
                (np.frombuffer(s, np.uint64) % bits).astype(np.int64), minlength=bits) % 2 > 0)
            .view(np.int64) for s in sets], dtype=object)

    return run


def _alike(proposed: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The proposed links (n, n_2) whose shingle sets reach the similarity ``least``, as (a, b)."""
    return proposed.join(sets, "n").join(
        sets.select(F.col("n").alias("n_2"), F.col("shingles").alias("shingles_2")), "n_2").filter(
        similarity()("shingles", "shingles_2") >= least).select(
        F.col("n").alias("a"), F.col("n_2").alias("b"))


def _groups(
    proposed: DataFrame, fps: DataFrame, sets: DataFrame, radius: int, least: float,
) -> DataFrame:
    """(node, component) of every ``n`` in ``proposed``, over all links that reach ``least``.

    ``proposed`` connects the nodes as all links within ``radius`` would. A group of the links in it
    that pass is complete if no other link leads out of it. What lies in the other groups is searched
    again, for every link from group to group.
    """
    found = connected_components(_alike(proposed, sets, least))
    named = materialise(sets.select("n").join(found, F.col("n") == F.col("node"), "left").select(
        "n", F.coalesce("component", "n").alias("group")), "groups")
    crossing = proposed.join(named, "n").join(named.select(
        F.col("n").alias("n_2"), F.col("group").alias("group_2")), "n_2").filter("group <> group_2")
    open_ = materialise(crossing.select(F.explode(F.array("group", "group_2")).alias("group"))
                        .distinct(), "open-groups")
    members = named.join(open_, "group").join(fps, "n").join(sets, "n").select(
        "n", "group", "fp", (F.length("shingles") / 8).cast("long").alias("size"),
        sketch()("shingles").alias("s"))
    members = materialise(members.select(
        "n", "group", "fp", "size", *[F.col("s")[i].alias(f"s{i}") for i in range(SKETCH)]),
        "left-members")
    left = materialise(links_left(members, radius, least).select(
        F.col("a").alias("n"), F.col("b").alias("n_2")), "left")
    group_of = named.select(F.col("n").alias("__n"), "group")
    passed = _alike(left, sets, least)
    for end in ("a", "b"):
        passed = passed.join(group_of, F.col(end) == F.col("__n")).withColumn(
            end, F.col("group")).drop("__n", "group")
    joined = connected_components(passed)
    return named.join(joined, F.col("group") == F.col("node"), "left").select(
        F.col("n").alias("node"), F.coalesce("component", "group").alias("component"))


def without_near_duplicates(
    docs: DataFrame, radius: int, words: int, least: float, check_words: int,
    text: str = "text", id_col: str = "doc_id",
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, all columns as they were.

    Fingerprints of ``words``-word shingles propose links up to ``radius`` bits; a link counts if
    the sets of ``check_words``-word shingles have a Jaccard similarity of ``least`` or more. Rows
    connected by such links are a group; that with the least id stays (rows without id last, equal
    ids by place). Every row that goes is thus linked, step by step, to one that stays. Texts
    without words are equal. An empty table gives no rows.
    """
    spark = docs.sparkSession
    located = with_locator(docs)
    rows = materialise(with_same(with_fingerprint(
        located.select(F.col(id_col).alias("id"), F.col(text).alias("text"), LOCATOR), words),
        check_words).select(
        id_order("id").alias("row"), "fp", "same", F.monotonically_increasing_id().alias("n")),
        "fingerprints")
    # rows of one fingerprint and one shingle set are one node, named by one of them
    nodes = materialise(rows.groupBy("fp", "same").agg(
        F.min("n").alias("node"), F.count(F.lit(1)).alias("copies")), "nodes")
    heads = materialise(nodes.groupBy("fp").agg(F.min("node").alias("head")), "heads")
    a, b = heads.select(F.col("fp").alias("a"), F.col("head").alias("n")), heads.select(
        F.col("fp").alias("b"), F.col("head").alias("n_2"))
    proposed = links(heads, radius).join(a, "a").join(b, "b").select("n", "n_2")
    alike = nodes.join(heads, "fp").filter("node <> head").select(
        F.col("head").alias("n"), F.col("node").alias("n_2"))
    proposed = materialise(proposed.unionByName(alike), "proposed")

    concerned = proposed.select("n").unionByName(
        proposed.select(F.col("n_2").alias("n"))).distinct()
    places = rows.join(concerned, "n").select("n", F.col("row.at").alias(LOCATOR))
    sets = materialise(
        located.select(LOCATOR, F.col(text).alias("text")).join(places.hint("shuffle_hash"), LOCATOR)
        .select("n", shingle_set(check_words)("text").alias("shingles")), "shingle-sets")
    found = _groups(proposed, nodes.select(F.col("node").alias("n"), "fp"), sets, radius, least)
    grouped = materialise(nodes.join(found, "node", "left").filter(
        "component IS NOT NULL OR copies > 1").select(
        "fp", "same", F.coalesce("component", "node").alias("component")), "grouped")
    members = materialise(rows.join(grouped, ["fp", "same"]).select("row", "component"), "members")
    # written, so that the join below can split a large group
    stays = materialise(
        members.groupBy("component").agg(F.min("row").alias("stays")), "stays")
    goes = members.join(stays, "component").filter("row <> stays").select(
        F.col("row.at").alias("__gone"))
    return located.join(goes, F.col(LOCATOR) == F.col("__gone"), "left_anti").drop(LOCATOR)
