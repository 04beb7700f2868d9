"""Mixing sources to target weights by temperature, as budgeted block permutations.

The token shares p of the sources are raised to a power a between 0 (uniform) and 1 (as they are)
and normalised. The power is bisected to meet a target entropy or a limit on how often a source is
repeated. A source's weight times the budget is its quota: whole permutations of its blocks, then
the blocks and rows of one more permutation up to the last token that fits.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm.common import LOCATOR, whole_text, with_locator
from starloom.session import materialise

#: Halvings of the interval of the power; four of them are one job when entropies are asked for.
STEPS = 40

#: A block holds about this many tokens, and no more rows of texts that have none; a source has at
#: most so many blocks, larger beyond.
BLOCK_TOKENS, MOST_BLOCKS = 1 << 17, 1 << 16


def words(text: str | Column) -> Column:
    """Words of a text, separated by blanks and control characters 9 to 13; none if missing."""
    return F.regexp_count(whole_text(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


@dataclass(frozen=True)
class Temperature:
    """The power and what it gives: budget in tokens over all sources."""

    power: float
    budget: float


def source_totals(rows: DataFrame) -> DataFrame:
    """Tokens per source; combined before the shuffle, so a hot source costs one row per task."""
    return rows.groupBy("source").agg(
        F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("rows"))


def entropies(totals: DataFrame, total: int, powers: list[float]) -> list[float]:
    """Entropy of the weights for each power, in one job over the sources."""
    p = F.col("total") / F.lit(float(total))
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(a).alias("a"))
                             for i, a in enumerate(powers)])).alias("at")
    z = F.pow("p", F.col("at.a"))
    rows = totals.filter("total > 0").select(p.alias("p"), at).groupBy("at").agg(
        F.sum(z).alias("z"), F.sum(z * F.log("p")).alias("zl")).collect()
    found = {r["at"]["i"]: math.log(r["z"]) - r["at"]["a"] * r["zl"] / r["z"] for r in rows}
    return [found[i] for i in range(len(powers))]


def find_power(
    totals: DataFrame, max_epochs: float | None = None, target_entropy: float | None = None,
) -> Temperature:
    """Bisects the power on [0, 1].

    max_epochs: the smallest power for which no source is repeated more often than this while the
    least repeated one is read once. target_entropy: the largest power whose entropy, as a share of
    that of equal weights, is at least this. The budget lets every source be read at least once.
    """
    if (max_epochs is None) == (target_entropy is None):
        raise ValueError("give either max_epochs or target_entropy")
    if max_epochs is not None and max_epochs < 1:
        raise ValueError("max_epochs must be 1 or more")
    has = totals.filter("total > 0")
    s = has.agg(F.sum("total").alias("t"), F.min("total").alias("lo"), F.max("total").alias("hi"),
                F.count(F.lit(1)).alias("k")).first()
    if not s["k"] or s["k"] == 1 or s["lo"] == s["hi"]:
        return Temperature(1.0, float(s["t"] or 0))
    low, high = 0.0, 1.0
    if max_epochs is not None:
        for _ in range(STEPS):
            middle = (low + high) / 2
            if (s["lo"] / s["hi"]) ** (middle - 1.0) <= max_epochs:
                high = middle
            else:
                low = middle
        power = high
    else:
        least = target_entropy * math.log(s["k"])
        for _ in range(STEPS // 4):
            # the middles of the next four halvings, whichever way they go
            points = [low + (high - low) * i / 16 for i in range(1, 16)]
            values = dict(zip(range(1, 16), entropies(has, s["t"], points)))
            a, b = 0, 16
            while b - a > 1:
                m = (a + b) // 2
                a, b = (m, b) if values[m] >= least else (a, m)
            low, high = low + (high - low) * a / 16, low + (high - low) * b / 16
        power = low
    z = has.agg(F.sum(F.pow(F.col("total") / s["t"], F.lit(power))).alias("z")).first()["z"]
    # the largest source has the smallest ratio of weight to share
    return Temperature(power, s["t"] * (s["hi"] / s["t"]) ** (1.0 - power) * z)


def quotas(totals: DataFrame, temperature: Temperature) -> DataFrame:
    """Per source: total, weight, quota (tokens), rounds (whole permutations), rest and blocks.

    A source without tokens has weight 0 and is read once.
    """
    all_ = totals.agg(F.sum("total").alias("t")).first()["t"] or 0
    p = F.pow(F.col("total") / F.lit(float(max(1, all_))), F.lit(temperature.power))
    z = totals.filter("total > 0").agg(F.sum(p).alias("z")).first()["z"] or 1.0
    weight = F.when(F.col("total") > 0, p / F.lit(z)).otherwise(0.0)
    quota = F.round(weight * F.lit(temperature.budget)).cast("long")
    return totals.withColumn("weight", weight).withColumn("quota", quota).withColumns({
        "rounds": F.when(F.col("total") > 0, F.floor(F.col("quota") / F.col("total")))
        .otherwise(1).cast("int"),
        "blocks": F.least(F.lit(MOST_BLOCKS), F.greatest(
            F.lit(1), F.ceil(F.greatest("total", "rows") / BLOCK_TOKENS))).cast("int"),
    }).withColumn("rest", F.when(
        F.col("total") > 0, F.col("quota") - F.col("rounds") * F.col("total")).otherwise(0))


def _mark(seed: int, *parts: Column) -> Column:
    """A text to order or deal by; any engine with MD5 gives the same."""
    return F.md5(F.concat_ws("/", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def permuted(rows: DataFrame, plan: DataFrame, seed: int = 0) -> DataFrame:
    """The rows (id, source, tokens, ...) as drawn: with epoch, block and position.

    position is the share of the source's quota that comes before the row, so sorting by it mixes
    the sources evenly. Windows cover one block, or the blocks of one source and epoch.
    """
    by = F.col("id").cast("string")
    if LOCATOR in rows.columns:  # rows without id are dealt by their places
        by = F.coalesce(by, F.concat_ws("/", f"{LOCATOR}.file", F.col(f"{LOCATOR}.row").cast("string")))
    dealt = F.conv(F.substring(_mark(seed, F.lit("block"), by), 1, 8), 16, 10).cast("long")
    joined = rows.join(
        plan.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
    joined = joined.withColumn("block", F.pmod(dealt, F.col("blocks")).cast("int"))
    sizes = joined.groupBy("source", "block").agg(
        F.sum("tokens").alias("size"), F.max("rounds").alias("rounds"), F.max("rest").alias("rest"))
    epochs = F.explode(F.sequence(
        F.lit(0), F.col("rounds") - F.when(F.col("rest") > 0, 0).otherwise(1))).alias("epoch")
    order = Window.partitionBy("source", "epoch").orderBy(
        _mark(seed, F.lit("order"), F.col("epoch"), F.col("block")), "block")
    blocks = sizes.select("source", "block", "size", epochs).select(
        F.col("source").alias("__s"), F.col("block").alias("__b"), F.col("epoch").alias("__e"),
        (F.sum("size").over(order) - F.col("size")).alias("block_start"))
    spread = joined.select("*", epochs)
    inner = Window.partitionBy("source", "epoch", "block").orderBy(
        _mark(seed, F.lit("row"), F.col("epoch"), F.col("id")), "id", *[
            c for c in rows.columns if c == LOCATOR])
    spread = spread.withColumn("row_start", F.sum("tokens").over(inner) - F.col("tokens"))
    drawn = spread.join(
        blocks, F.col("source").eqNullSafe(F.col("__s")) & (F.col("block") == F.col("__b"))
        & (F.col("epoch") == F.col("__e")))
    before = F.col("block_start") + F.col("row_start")
    return drawn.filter(
        (F.col("epoch") < F.col("rounds")) | (before + F.col("tokens") <= F.col("rest"))
    ).withColumn("position", F.when(F.col("quota") > 0, (
        F.col("epoch") * F.col("total") + before) / F.col("quota")).otherwise(0.0)).select(
        *rows.columns, F.col("epoch").cast("int"), "block", "position")


def draws(
    docs: DataFrame, max_epochs: float | None = None, target_entropy: float | None = None,
    seed: int = 0, text: str = "text", id_col: str = "doc_id", source: str = "source",
) -> DataFrame:
    """The mix as rows (id, source, tokens, locator, epoch, block, position).

    Every row of ``docs`` is drawn at least once; rows of sources whose weight exceeds their share
    are drawn again, up to the quota. A missing source is a source of its own; a missing text has no
    tokens. Rows of equal id fall into one block and follow each other by place, rows without id
    are spread over all blocks of their source. Other columns are not read. An empty table gives no rows.
    """
    located = with_locator(docs)
    rows = materialise(located.select(
        F.col(id_col).alias("id"), F.col(source).alias("source"), words(text).alias("tokens"),
        LOCATOR), "mix-rows")
    totals = materialise(source_totals(rows), "mix-totals")
    plan = quotas(totals, find_power(totals, max_epochs, target_entropy))
    return permuted(rows, plan, seed)


def mix(
    docs: DataFrame, max_epochs: float | None = None, target_entropy: float | None = None,
    seed: int = 0, text: str = "text", id_col: str = "doc_id", source: str = "source",
) -> DataFrame:
    """``docs`` as drawn, all columns as they were, each file in the order of the mix.

    Rows meet their draws by a hash of their place, so a file is an even part of the whole mix.
    """
    located = with_locator(docs)
    drawn = draws(located, max_epochs, target_entropy, seed, text, id_col, source).select(
        F.col(LOCATOR).alias("__at"), F.col("position").alias("__position"))
    return located.join(drawn, F.col(LOCATOR) == F.col("__at")).sortWithinPartitions(
        "__position", "__at").drop(LOCATOR, "__at", "__position")
