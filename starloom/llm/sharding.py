"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points (virtual nodes) of a ring. A key belongs to the first point clockwise
of its own hash; if that shard is full, it continues clockwise to the next shard with room. The
capacities add up to the number of rows, so counts differ by at most one, while most rows stay with
their first shard when the number of shards changes.

Keys of one arc (between two points) meet the shards in the same order. So rows are only counted per
arc; which shard takes how many rows of which arc follows from that small table, and each row finds
its place from its running number in the arc.
"""

from __future__ import annotations

import bisect
import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm.common import whole_text
from starloom.session import materialise

VIRTUAL_NODES = 128

#: Rows of an arc that are numbered in one task, about; longer arcs are cut by a second hash.
ROWS_PER_BLOCK = 1 << 18

_SPACE = 1 << 32


@dataclass(frozen=True)
class Ring:
    """points[i] ends arc i; order[i] lists all shards as met clockwise from arc i."""

    points: list[int]
    order: list[list[int]]


def make_ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> Ring:
    owners: dict[int, int] = {}
    for shard in range(shards):
        for node in range(virtual_nodes):
            name = f"shard-{shard}/node-{node}".encode()
            point = int.from_bytes(hashlib.sha256(name).digest()[:4], "big")
            owners.setdefault(point, shard)
    points = sorted(owners)
    order = []
    for i in range(len(points)):
        seen: dict[int, None] = {}
        for j in range(len(points)):
            seen.setdefault(owners[points[(i + j) % len(points)]])
            if len(seen) == shards:
                break
        order.append(list(seen))
    return Ring(points, order)


def capacities(rows: int, shards: int) -> list[int]:
    """Rows per shard, adding up to ``rows`` and at most one apart."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def bounded_loads(ring: Ring, arc_rows: dict[int, int], capacity: list[int]) -> list[tuple]:
    """(arc, shard, first number, end number, first slot) for every part of an arc.

    Round by round every arc offers the rows it still has to the next shard clockwise, which takes
    them in ring order up to its capacity. A row has met every shard after as many rounds as there
    are shards, and a shard that refuses a row is full, so all rows find a place.
    """
    room = list(capacity)
    left = {a: arc_rows[a] for a in sorted(arc_rows)}
    taken: list[tuple[int, int, int]] = []
    for step in range(len(capacity)):
        for arc in left:
            shard = ring.order[arc][step] if step < len(ring.order[arc]) else None
            n = min(left[arc], room[shard]) if shard is not None else 0
            if n:
                taken.append((arc, shard, n))
                left[arc] -= n
                room[shard] -= n
    if any(left.values()):
        raise ValueError("the capacities do not hold all rows")
    at_arc: dict[int, int] = {}
    at_shard: dict[int, int] = {}
    parts = []
    for arc, shard, n in taken:
        first, slot = at_arc.get(arc, 0), at_shard.get(shard, 0)
        parts.append((arc, shard, first, first + n, slot))
        at_arc[arc], at_shard[shard] = first + n, slot + n
    return parts


def arc_of(ring: Ring, point: Column) -> Column:
    """The arc of a hash point: the first ring point at or above it, else the first of the ring.

    The points are one array; the position is found through equal cells of the ring, each with the
    few points that lie in it.
    """
    cells = 1
    while cells < 2 * len(ring.points):
        cells *= 2
    width = _SPACE // cells
    n = len(ring.points)
    firsts = [bisect.bisect_left(ring.points, c * width) for c in range(cells)]
    most = max((bisect.bisect_left(ring.points, (c + 1) * width) - f) for c, f in enumerate(firsts))
    cell_first = F.element_at(F.array(*map(F.lit, firsts)), (point / width).cast("int") + 1)
    points = F.array(*map(F.lit, [*ring.points, *[_SPACE] * (most + 1)]))
    arc = cell_first
    for k in range(most):
        arc = arc + F.when(F.element_at(points, cell_first + k + 1) < point, 1).otherwise(0)
    return F.pmod(arc, F.lit(n))


def shard_rows(
    rows: DataFrame, key: str, shards: int, virtual_nodes: int = VIRTUAL_NODES,
) -> DataFrame:
    """``rows`` with shard (int) and slot (long, gapless from 0 in each shard).

    Columns named shard or slot are replaced. The key is hashed as text, a missing one like any
    other value. Rows of a frequent key share an arc; the arc is numbered in blocks cut by a hash of
    the whole row, so no task holds them all. Equal rows are interchangeable. An empty table gives
    no rows. ``rows`` should hold no long texts: it is written to the shared folder once and
    shuffled once.
    """
    spark = rows.sparkSession
    ring = make_ring(shards, virtual_nodes)
    rows = rows.drop("shard", "slot")
    columns = rows.columns
    hashed = F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("\x00none")))
    spread = F.xxhash64(*[F.col(c) for c in columns])
    placed = materialise(
        rows.withColumn("__point", F.shiftrightunsigned(hashed, 32))
        .withColumn("__spread", spread), "ring-points")
    placed = placed.withColumn("__arc", arc_of(ring, F.col("__point")).cast("int"))

    # One row per arc: at most shards * virtual_nodes, whatever the number of rows.
    sizes = {r["__arc"]: r["n"] for r in placed.groupBy("__arc").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    parts = bounded_loads(ring, sizes, capacities(total, shards))
    blocks = 1 + max(sizes.values(), default=0) // ROWS_PER_BLOCK
    numbered = placed.withColumn("__block", F.pmod("__spread", F.lit(blocks)).cast("int"))

    counts = numbered.groupBy("__arc", "__block").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select(
        "__arc", "__block", (F.sum("__n").over(
            Window.partitionBy("__arc").orderBy("__block")) - F.col("__n")).alias("__before"))
    number = F.row_number().over(Window.partitionBy("__arc", "__block").orderBy(
        "__point", "__spread", *[F.col(c) for c in columns if c == key])) - 1
    numbered = numbered.withColumn("__number", number)
    if blocks > 1:
        numbered = numbered.join(before, ["__arc", "__block"]).withColumn(
            "__number", F.col("__number") + F.col("__before"))
    # At most shards * shards * virtual_nodes parts: a proven bound, so it may be broadcast.
    plan = spark.createDataFrame(
        parts, "__arc int, shard int, __first long, __end long, __slot long")
    hit = numbered.join(F.broadcast(plan), "__arc").filter(
        (F.col("__number") >= F.col("__first")) & (F.col("__number") < F.col("__end")))
    return hit.select(*columns, "shard", (
        F.col("__slot") + F.col("__number") - F.col("__first")).alias("slot"))


def text_sizes(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Id, size (UTF-8 bytes plus 1) and CRC-32 of each text; a missing text counts as empty."""
    clean = whole_text(text)
    return docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(clean).cast("long") + 1).alias("size"),
        F.crc32(F.encode(clean, "UTF-8")).alias("text_crc32"))


def moved_rows(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Counts of rows per (shard before, shard after) of two shardings of the same unique keys."""
    return before.select(key, F.col("shard").alias("shard_before")).join(
        after.select(key, F.col("shard").alias("shard_after")), key).groupBy(
        "shard_before", "shard_after").agg(F.count(F.lit(1)).alias("rows"))
