"""The prefix trie of conversations whose heads come from a base conversation.

A rebuilt conversation is never built. A turn becomes its digest and its length in bytes; a run of
turns becomes an element of a monoid, the hash product ``sum of digest * base^place`` modulo a prime
with the number of its turns. Elements of neighbouring runs combine by shifting the right one to its
place, so the fingerprint of a rebuilt prefix is the prefix product of the base conversation for the
head, and that product combined with a difference of two own prefix products beyond it.

Rows of (conversation, depth, fingerprint, reference to the last turn) are then grouped by depth and
fingerprint; each group is a node. Equality is verified by induction: all members of a node must
share the parent node and, through the references, the last turn, digests of different turns being
told apart by the texts themselves. Should a fingerprint fail, all is done again with another base.

Sums over subtrees need no walk through the trie. Each node is owned by its least member; who owns a
node owns all below it on its path. So a subtree sum is a sum over the members of what each owns at
this depth or below.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.blocks import range_blocks
from starloom.session import materialise

#: A conversation's head is shorter than this, and its base is the least id of so many.
HEADS, FAMILY = 9, 5

_PRIME = (1 << 31) - 1
_LANES = 3

#: Members whose ids are joined in one task: those of one node within so many neighbouring ids.
ENDS_SPAN = 1 << 16


def _bases(seed: int) -> list[int]:
    digest = hashlib.sha256(f"trie-{seed}".encode()).digest()
    return [2 + int.from_bytes(digest[8 * k:8 * k + 8], "big") % (_PRIME - 3)
            for k in range(_LANES)]


def _power(base: int, exponent: Column) -> Column:
    """base^exponent modulo the prime, for exponents from 0 to 2^32 - 1, from four small tables."""
    found = None
    for k in range(4):
        step = pow(base, 1 << (8 * k), _PRIME)
        table = [1]
        for _ in range(255):
            table.append(table[-1] * step % _PRIME)
        digit = F.shiftright(exponent, 8 * k).bitwiseAND(255).cast("int")
        part = F.get(F.lit(table).cast("array<bigint>"), digit)
        found = part if found is None else found * part % _PRIME
    return found


def turn_rows(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv long, digest binary, bytes long, i (its place, from 1), block.

    Places follow turn (missing first), then role and the digest of the text. Rows are cut into
    blocks of about equal length, so a conversation of any length has many tasks.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # the length of the role tells ("a", "b") from ("ab", "")
    digest = F.unhex(F.sha2(F.encode(F.concat(
        F.octet_length(role).cast("string"), F.lit(":"), role, text), "UTF-8"), 256))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    order = ["conv", "turn", "role", "digest"]
    cut = range_blocks(rows, order, "turns")
    sizes = cut.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("conv", "block", (F.sum("n").over(
        Window.partitionBy("conv").orderBy("block")) - F.col("n")).alias("before"))
    local = F.row_number().over(Window.partitionBy("conv", "block").orderBy(
        "turn", "role", "digest"))
    return cut.withColumn("local", local).join(before, ["conv", "block"]).select(
        "conv", "block", "digest", "bytes", (F.col("local") + F.col("before")).alias("i"))


def _different_turns(conversations: DataFrame) -> bool:
    """Whether two different turns have one digest."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    both = F.struct(role, text)
    return not conversations.groupBy(F.sha2(F.encode(F.concat(
        F.octet_length(role).cast("string"), F.lit(":"), role, text), "UTF-8"), 256).alias(
        "digest")).agg(F.min(both).alias("a"), F.max(both).alias("b")).filter("a <> b").isEmpty()


def _products(turns: DataFrame, seed: int) -> DataFrame:
    """Prefix products of every conversation: one fingerprint lane f0, f1, ... per base."""
    lanes = range(_LANES)
    values = turns.select("*", *[
        (F.conv(F.hex(F.substring("digest", 1 + 7 * k, 7)), 16, 10).cast("long") % _PRIME
         * _power(b, F.col("i")) % _PRIME).alias(f"v{k}") for k, b in enumerate(_bases(seed))])
    sums = values.groupBy("conv", "block").agg(*[F.sum(f"v{k}").alias(f"s{k}") for k in lanes])
    upto = Window.partitionBy("conv").orderBy("block")
    before = sums.select("conv", "block", *[
        ((F.sum(F.col(f"s{k}") % _PRIME).over(upto) - F.col(f"s{k}") % _PRIME) % _PRIME).alias(
            f"b{k}") for k in lanes])
    within = Window.partitionBy("conv", "block").orderBy("i").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return values.select("*", *[F.sum(f"v{k}").over(within).alias(f"w{k}") for k in lanes]).join(
        before, ["conv", "block"]).select("conv", "i", "digest", "bytes", *[
            ((F.col(f"b{k}") + F.col(f"w{k}")) % _PRIME).alias(f"f{k}") for k in lanes])


def _rebuilt(products: DataFrame, seed: int) -> DataFrame:
    """Rows (conv, d, fingerprint of the first d rebuilt turns, last turn, ends) from d 0 on."""
    lanes = range(_LANES)
    f = [f"f{k}" for k in lanes]
    head = F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")) % HEADS
    own = products.groupBy("conv").agg(F.max("i").alias("n")).withColumn("h", head).withColumn(
        "base", F.col("conv") - F.col("conv") % FAMILY)
    # a base has FAMILY conversations at most and lends HEADS - 1 turns, so these joins stay small
    lent = products.filter(F.col("i") < HEADS).select(F.col("conv").alias("base"), "i", "digest",
                                                      "bytes", *f)
    firsts = lent.groupBy("base").agg(F.sort_array(F.collect_list(F.struct("i", *f))).alias("heads"))
    skipped = firsts.select(F.col("base").alias("conv"), F.col("heads").alias("own_heads"))
    facts = own.join(firsts, "base", "left").join(skipped, "conv").select(
        "conv", "n", "h", "base", F.least("h", F.coalesce(F.size("heads"), F.lit(0))).alias("k"),
        "heads", "own_heads")

    def lane(heads: str, at: str, j: int) -> Column:
        return F.coalesce(F.get(F.col(f"{heads}.f{j}"), (F.col(at) - 1).cast("int")), F.lit(0))

    facts = materialise(facts.select(
        "conv", "n", "h", "base", "k",
        (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("depth"),
        *[lane("heads", "k", j).alias(f"base{j}") for j in lanes],
        *[lane("own_heads", "h", j).alias(f"skip{j}") for j in lanes]), "rebuilt-heads")

    roots = facts.select(
        "conv", F.lit(0).cast("long").alias("d"), *[F.lit(0).cast("long").alias(x) for x in f],
        F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("bytes"), "depth")
    heads = facts.select("conv", "k", "base", "depth").join(lent, "base").filter("i <= k").select(
        "conv", F.col("i").alias("d"), *f, "digest", "bytes", "depth")
    # own turns behind the head: base product, and the own product beyond the head moved to its place
    tails = products.join(facts, "conv").filter("i > h").withColumn("shift", F.col("h") - F.col("k"))
    moved = []
    for j, b in enumerate(_bases(seed)):
        inverse = pow(b, -1, _PRIME)
        back = F.get(F.lit([pow(inverse, e, _PRIME) for e in range(HEADS)]).cast("array<bigint>"),
                     F.col("shift").cast("int"))
        beyond = F.pmod(F.col(f"f{j}") - F.col(f"skip{j}"), F.lit(_PRIME))
        moved.append(((F.col(f"base{j}") + beyond * back % _PRIME) % _PRIME).alias(f"f{j}"))
    tails = tails.select("conv", (F.col("i") - F.col("shift")).alias("d"), *moved, "digest",
                         "bytes", "depth")
    return roots.unionByName(heads).unionByName(tails)


def _with_parents(rows: DataFrame, seed: int) -> DataFrame:
    """Adds the parent's fingerprint p0, p1, ...: the own one without its last turn."""
    values = [F.conv(F.hex(F.substring("digest", 1 + 7 * k, 7)), 16, 10).cast("long") % _PRIME
              * _power(b, F.col("d")) % _PRIME for k, b in enumerate(_bases(seed))]
    return rows.select("*", *[F.pmod(F.col(f"f{k}") - v, F.lit(_PRIME)).alias(f"p{k}")
                              for k, v in enumerate(values)])


def _ends(ids: DataFrame, key: list[str]) -> DataFrame:
    """SHA-256 of the ids (conv) of each key, ascending and joined by commas.

    Ids are joined within spans of neighbouring ids, which are bounded; a key's spans then flow
    through one hash, since SHA-256 cannot be put together from parts, without being held.
    """
    spans = ids.groupBy(*key, F.floor(F.col("conv") / ENDS_SPAN).alias("span")).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv")),
                                     lambda c: c.cast("string"))).alias("ids"))
    names = [f"k{i}" for i in range(len(key))]

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, digest = None, None
        for batch in batches:
            rows = []
            for *at, part in batch.itertuples(index=False):
                if at == now:
                    digest.update(b"," + part.encode())
                    continue
                if now is not None:
                    rows.append((*now, digest.hexdigest()))
                now, digest = at, hashlib.sha256(part.encode())
            yield pd.DataFrame(rows, columns=[*names, "ends"])
        if now is not None:
            yield pd.DataFrame([(*now, digest.hexdigest())], columns=[*names, "ends"])

    found = spans.repartition(*key).sortWithinPartitions(*key, "span").select(*[
        F.col(k).alias(n) for k, n in zip(key, names)], "ids").mapInPandas(
        hashed, ", ".join(f"{n} long" for n in names) + ", ends string")
    return found.select(*[F.col(n).alias(k) for k, n in zip(key, names)], "ends")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie over all rebuilt conversations.

    ``conversations`` has conv_id, turn, role and text. Conversation c is rebuilt from the first h =
    crc32(c) % 9 turns of conversation c - c % 5 and its own turns after the first h. Rows: conv_id
    (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows without conv_id belong to no conversation and are left out; a missing turn comes first, a
    missing role or text is empty. Turns of one number are ordered by role and text digest; repeated
    rows are turns of their own. Very long texts are only hashed. Other columns play no part. An
    empty table has no nodes, not even a root.
    """
    table = conversations.select("conv_id", "turn", "role", "text")
    if _different_turns(table):
        raise ValueError("two different turns have one SHA-256 digest")
    turns = materialise(turn_rows(table), "turn-places")
    for seed in count():
        rows = materialise(_with_parents(_rebuilt(_products(turns, seed), seed), seed),
                           "rebuilt-prefixes")
        f, p = [f"f{k}" for k in range(_LANES)], [f"p{k}" for k in range(_LANES)]
        key = ["d", *f]
        last, parent = F.col("digest"), F.struct(*p)
        nodes = rows.groupBy(*key).agg(
            F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n_convs"),
            F.max("bytes").alias("bytes"), F.min(last).alias("last"), F.max(last).alias("last2"),
            F.min(parent).alias("parent"), F.max(parent).alias("parent2"))
        nodes = materialise(nodes, "trie-nodes")
        # a node is verified when its members share the last turn and the (verified) parent
        if nodes.filter("d > 0 AND (last <> last2 OR parent <> parent2)").isEmpty():
            break

    nodes = nodes.select("*", *[F.col(f"parent.p{k}").alias(f"p{k}") for k in range(_LANES)])
    children = nodes.filter("d > 0").groupBy(
        (F.col("d") - 1).alias("d"), *[F.col(a).alias(b) for a, b in zip(p, f)]).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = materialise(nodes.join(children, key, "left").fillna(0, ["n_children"]).select(
        *key, *p, "owner", "n_convs", "n_children",
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        (F.col("n_children") == 0).cast("long").alias("leaf")), "trie-children")

    # what each conversation owns at a depth or below: running sums over its nodes, cut into blocks
    owned = range_blocks(nodes.select("owner", "d", *f, "saved", "leaf"),
                         ["owner", F.desc("d")], "owned")
    sums = owned.groupBy("owner", "block").agg(
        F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    upto = Window.partitionBy("owner").orderBy("block")
    before = sums.select("owner", "block", *[
        (F.sum(c).over(upto) - F.col(c)).alias(f"before_{c}") for c in ("saved", "leaf")])
    within = Window.partitionBy("owner", "block").orderBy(F.desc("d")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    below = owned.select("owner", "block", *key, *[
        F.sum(c).over(within).alias(f"within_{c}") for c in ("saved", "leaf")]).join(
        before, ["owner", "block"]).select("owner", *key, *[
            (F.col(f"within_{c}") + F.col(f"before_{c}")).alias(f"below_{c}")
            for c in ("saved", "leaf")])
    totals = sums.groupBy("owner").agg(
        F.sum("saved").alias("all_saved"), F.sum("leaf").alias("all_leaf"))
    # members that do not own a node add all they own, since that lies deeper
    members = rows.join(totals.withColumnRenamed("owner", "conv"), "conv").groupBy(*key).agg(
        F.sum("all_saved").alias("sum_saved"), F.sum("all_leaf").alias("sum_leaf"))

    ends = _ends(rows.filter("d = depth").select(*key, "conv"), key)
    parents = nodes.select((F.col("d") + 1).alias("d"), *[
        F.col(a).alias(b) for a, b in zip(f, p)], F.col("owner").alias("parent_conv_id"))
    every = nodes.select(*key, *p, "owner", "n_convs", "n_children").join(
        below, [*key, "owner"]).join(members, key).join(
        totals, "owner").join(ends, key, "left").join(parents, ["d", *p], "left")
    return every.select(
        F.col("owner").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", "n_convs",
        "n_children",
        (F.col("below_leaf") + F.col("sum_leaf") - F.col("all_leaf")).alias("n_leaves"),
        (F.col("below_saved") + F.col("sum_saved") - F.col("all_saved")).alias("saved_tokens"),
        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
