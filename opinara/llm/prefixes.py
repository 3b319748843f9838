"""Prefix trie of conversations by block hashing.

Conversations are cut into blocks of a fixed number of turns.  A block's digest, with that of all blocks before, groups conversations that begin
alike, a whole block at a time.  Where one block alone follows a beginning, its turns are nodes with the same members, and nothing is
left to do; only where blocks part are their turns looked at one by one, and by then each distinct block is a single row.

Texts are met once, to be hashed.  Afterwards a turn is 128 bits of hash and a length; a beginning is the exclusive or of the
hashes of its turns with their places.  Equal hashes of unequal beginnings are possible in principle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opinara.llm.durable import stored

#: Turns of a block; turns, and ids of equal conversations, that one task takes together (powers of two, as exponents).
BLOCK, SPAN_BITS, IDS_BITS = 4, 10, 9
NODE = ("depth", "p1", "p2")
FIRST_SPAN = -(1 << 62)


def _xor(x: Column, y: Column) -> Column:
    return x.bitwiseXOR(y)


def _earlier(rows: DataFrame, order: list[Column], sums: dict[str, tuple[Column, Callable, Callable]]) -> DataFrame:
    """Adds running figures over the earlier rows of a conversation: ``sums`` has column, aggregate and how two results add up.

    A long conversation is dealt by its ``span`` and no task takes it as a whole; what stands before a span comes from the spans' totals.
    """
    inside = W.partitionBy("conv_id", "span").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    across = W.partitionBy("conv_id").orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "span").agg(*[f(c).alias(n) for n, (c, f, _) in sums.items()])
    starts = totals.select("conv_id", "span", *[f(n).over(across).alias(f"{n}_start") for n, (_, f, _) in sums.items()]).where(F.coalesce(*[f"{n}_start" for n in sums]).isNotNull())
    local = rows.withColumns({n: F.coalesce(f(c).over(inside), F.lit(0)) for n, (c, f, _) in sums.items()})
    both = local.join(starts, ["conv_id", "span"], "left")
    return both.withColumns({n: add(F.col(n), F.coalesce(f"{n}_start", F.lit(0))) for n, (_, _, add) in sums.items()}).drop(*[f"{n}_start" for n in sums])


def numbered_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``pos`` from 1, hashes ``d1``, ``d2`` of role and text, ``chars`` of the text.

    Turns stand by number, null first, equal numbers by role and text; a null role or text is empty, rows without a conversation are left out.
    """
    said = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
        F.coalesce(F.shiftright(F.col(turn).cast("long"), SPAN_BITS), F.lit(FIRST_SPAN)).alias("span"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    placed = _earlier(said, order, {"pos": (F.lit(1), F.sum, Column.__add__)})
    digests = [F.xxhash64(F.lit(k), "role", "text").alias(f"d{k}") for k in (1, 2)]
    return placed.select("conv_id", (F.col("pos") + 1).alias("pos"), *digests, F.char_length("text").cast("long").alias("chars"))


def rebuilt_turns(numbered: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations with the first h turns of their group's first one in place of their own, h being crc32(id) % ``most``; and all ids.

    ``group`` neighbouring ids are one group, and the first one is that whose id it divides; h turns at most are known of it.
    """
    sizes = numbered.groupBy("conv_id").agg(F.count("*").alias("n"))
    first = (F.col("conv_id") % group) == 0
    bases = sizes.where(first).select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    own = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"))
    plan = stored(own.join(bases, "base", "left").withColumn("take", F.least("h", F.coalesce("base_n", F.lit(0)))).drop("base_n"))
    heads = numbered.where(first & (F.col("pos") < most)).withColumnRenamed("conv_id", "base").join(plan.where("take > 0"), "base").where("pos <= take")
    tails = numbered.join(plan, "conv_id").where("pos > h").withColumn("pos", F.col("pos") - F.col("h") + F.col("take"))
    columns = ("conv_id", "pos", "d1", "d2", "chars")
    return heads.select(*columns).unionByName(tails.select(*columns)), plan.select("conv_id")


def _blocks(turns: DataFrame) -> DataFrame:
    """``block`` k of each conversation: its ``turns``, beginning before (``a1``, ``a2``) and after it (``e1``, ``e2``), characters before."""
    spans = turns.withColumns({"span": F.shiftright(F.col("pos") - 1, SPAN_BITS), "block": F.floor((F.col("pos") - 1) / BLOCK)})
    cut = spans.groupBy("conv_id", "span", "block").agg(
        F.sort_array(F.collect_list(F.struct("pos", "x1", "x2", "chars"))).alias("turns"), F.bit_xor("x1").alias("y1"), F.bit_xor("x2").alias("y2"), F.sum("chars").alias("y")
    )
    chain = {"a1": (F.col("y1"), F.bit_xor, _xor), "a2": (F.col("y2"), F.bit_xor, _xor), "before": (F.col("y"), F.sum, Column.__add__)}
    found = _earlier(cut, [F.col("block").asc()], chain)
    return found.select("conv_id", "block", "turns", "a1", "a2", _xor(F.col("a1"), F.col("y1")).alias("e1"), _xor(F.col("a2"), F.col("y2")).alias("e2"), "before")


def _turn_nodes(rows: DataFrame, *keep: str) -> DataFrame:
    """A row for each turn of a block: depth, beginning up to it (``p1``, ``p2``) and up to the turn before (``q1``, ``q2``)."""
    steps, p1, p2, before = [], F.col("a1"), F.col("a2"), F.col("before")
    for i in range(BLOCK):
        t = F.get("turns", F.lit(i))
        q1, q2, p1, p2 = p1, p2, _xor(p1, t["x1"]), _xor(p2, t["x2"])
        node = F.struct(t["pos"].alias("depth"), p1.alias("p1"), p2.alias("p2"), q1.alias("q1"), q2.alias("q2"), t["chars"].alias("chars"), before.alias("before"))
        steps.append(F.when(t.isNotNull(), node))
        before = before + t["chars"]
    return rows.select(*keep, F.explode(F.array_compact(F.array(*steps))).alias("node")).select(*keep, "node.*")


def _by_beginning(blocks: DataFrame, *sums: str) -> DataFrame:
    """A row for each distinct beginning of the conversations: smallest ``conv_id`` and the columns ``sums`` added up.

    First by whole blocks; the turns of blocks that follow a beginning alone are its chain as they are, and
    those of blocks that part are grouped once more, from one row for each distinct block.
    """
    adding = [F.sum(name).alias(name) for name in sums]
    distinct = stored(
        blocks.groupBy("block", "a1", "a2", "e1", "e2").agg(F.min("conv_id").alias("conv_id"), F.min("before").alias("before"), F.first("turns").alias("turns"), *adding)
    )
    alone = distinct.groupBy("block", "a1", "a2").agg(F.count("*").alias("n"), F.min("e1").alias("e1"), F.min("e2").alias("e2")).where("n = 1")
    marked = distinct.join(alone.select("block", "e1", "e2", F.lit(True).alias("alone")), ["block", "e1", "e2"], "left")
    keep = ("conv_id", *sums)
    chains = _turn_nodes(marked.where("alone"), *keep)
    same = [F.min(c).alias(c) for c in ("q1", "q2", "chars", "before", "conv_id")]
    parting = _turn_nodes(marked.where("alone is null"), *keep).groupBy(*NODE).agg(*same, *adding)
    return chains.unionByName(parting)


def _ends_digest(ends: DataFrame) -> DataFrame:
    """For each end of conversations the SHA-256 of their ids, ascending, comma-joined.

    Ids that lie close together are joined first, so what a task reads in order of a large group is a row for some hundred of them.
    """
    near = ends.groupBy(*NODE, F.shiftright("conv_id", IDS_BITS).alias("part")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    laid = near.repartition(*NODE).sortWithinPartitions(*NODE, "part")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, hashlib.sha256()
        for batch in batches:
            done = []
            for *key, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
                if key != node:
                    if node is not None:
                        done.append((*node, running.hexdigest()))
                    node, running = key, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(ids.encode())
            if done:
                yield _rows(done)
        if node is not None:
            yield _rows([(*node, running.hexdigest())])

    return laid.mapInArrow(digest, "depth long, p1 long, p2 long, ends_sha256 string")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(dict(zip((*NODE, "ends_sha256"), map(list, zip(*rows, strict=True)), strict=True)))


def conversation_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """The trie's nodes, a row each, for conversations given by ``conv_id, pos, d1, d2, chars``; ``ids`` has each ``conv_id`` once, also those without turns.

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    Without conversations there is no node, not even the root.

    Sums over a subtree take no walk through levels.  Its characters, copies included, are those of its members from the node on.
    The distinct ones are owned: each node by its smallest member, so that they, and leaves, add up over owners like members do.
    """
    hashed = [F.xxhash64(F.lit(k), "pos", f"d{k}").alias(f"x{k}") for k in (1, 2)]
    placed = stored(turns.select("conv_id", "pos", *hashed, "chars"))
    whole = placed.groupBy("conv_id").agg(F.max("pos").alias("depth"), F.bit_xor("x1").alias("p1"), F.bit_xor("x2").alias("p2"), F.sum("chars").alias("total"))
    ends = stored(ids.join(whole, "conv_id", "left").select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in (*NODE, "total")]))

    # conversations that are equal as a whole count as one, by the smallest id
    unlike = ends.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum("total").alias("all_chars"), F.min("total").alias("total"))
    unlike = stored(unlike.drop(*NODE))
    blocks = stored(_blocks(placed.join(unlike.select("conv_id"), "conv_id", "left_semi")))

    zero = [F.lit(0).cast("long").alias(c) for c in NODE]
    none = [F.lit(None).cast("long").alias(c) for c in ("q1", "q2")]
    root = unlike.agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("all_chars").alias("all_chars")).where("n_convs > 0")
    root = root.select("*", *zero, *none, F.lit(0).cast("long").alias("chars"), F.lit(0).cast("long").alias("before"))
    below = _by_beginning(blocks.join(unlike.select("conv_id", "n_convs", "all_chars"), "conv_id"), "n_convs", "all_chars")
    nodes = stored(below.unionByName(root))

    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(children, list(NODE), "left").fillna(0, ["n_children"]))
    owned = nodes.groupBy("conv_id").agg(F.sum("chars").alias("own_chars"), F.max((F.col("n_children") == 0).cast("long")).alias("n_leaves"))
    owners = stored(owned.join(unlike.select("conv_id", "total"), "conv_id"))
    sums = ("own_chars", "n_leaves")
    over_owners = _by_beginning(blocks.join(owners.drop("total"), "conv_id"), *sums).select(*NODE, *sums)
    over_owners = over_owners.unionByName(owners.agg(*[F.sum(c).alias(c) for c in sums]).select(*zero, *sums))

    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    first = owners.select("conv_id", F.col("own_chars").alias("first_own"), F.col("total").alias("first_total"))
    copies = F.col("all_chars") - F.col("n_convs") * F.col("before")
    distinct = F.col("own_chars") - F.col("first_own") + F.col("first_total") - F.col("before")
    return (
        nodes.join(over_owners, list(NODE))
        .join(_ends_digest(ends), list(NODE), "left")
        .join(parents, ["depth", "q1", "q2"], "left")
        .join(first, "conv_id")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (copies - distinct).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )


def rebuilt_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of a table of turns whose conversations are rebuilt by groups of a hundred ids (``rebuilt_turns``).

    Turns stand by number, null first, equal ones by role and text; repeated rows are turns of their own.  Null roles and texts are empty, rows without
    an id are left out, other columns play no part, and an empty table has no node.
    """
    numbered = stored(numbered_turns(turns, conv, turn, role, text))
    return conversation_trie(*rebuilt_turns(numbered))
