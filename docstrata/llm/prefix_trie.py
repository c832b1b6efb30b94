"""The prefix trie of conversations, by hashes of blocks of turns first and of single turns only where siblings part.

A turn is the MD5 of its role and text, and a prefix the exclusive or of its turns, each scrambled with its depth: two running 64-bit
numbers that need no order of work. Conversations are cut into blocks of ``BLOCK`` turns; the prefix at a block's start and the one at its
end name it, so equal blocks after equal prefixes are counted at once. Where all that goes on from a prefix goes on with the same
block, the turns inside have the block's members, and one conversation's turns give all nodes. Only where blocks differ are their turns
compared, of one conversation for each block.

A node belongs to its smallest member, and a member keeps what it owns from some depth down. So sums over a subtree are sums over a
node's members, less what its owner owns above it, and no node is paired with its ancestors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from docstrata.llm.common import settle
from docstrata.llm.scans import scanned

#: Turns of a block.
BLOCK = 4
#: Ids of conversations in a row of those that end at a node: at most so many, as they lie in a range of so many numbers.
IDS = 4096
#: Turns of another conversation that one may start with, and how many conversations share one to start with.
MOST_BORROWED, FAMILY = 8, 5


def digested(conversations: DataFrame) -> DataFrame:
    """A row per turn: ``conv``, ``turn``, the MD5 of role and text, and the text's bytes. Texts go no further."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.where("conv_id IS NOT NULL")
    return rows.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))


def borrowed(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return (F.crc32(conv.cast("string").cast("binary")) % (MOST_BORROWED + 1)).cast("long")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations ``conv, depth, digest, bytes`` (depth from 1), and the ids of all, turnless ones included."""
    ordered = settle(scanned(turns.withColumn("at", F.lit(1).cast("long")), "conv", ["turn", "digest"], sums=("at",)), "numbered-turns")
    lengths = settle(ordered.groupBy("conv").agg(F.max("at_run").alias("length")), "conversations")
    own = lengths.select("conv", borrowed(F.col("conv")).alias("taken"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    base = lengths.select(F.col("conv").alias("base"), F.col("length").alias("base_length"))
    plan = settle(own.join(base, "base", "left").select("conv", "base", "taken", F.least("taken", F.coalesce("base_length", F.lit(0))).alias("got")), "plan")
    kept = ordered.join(plan, "conv").where("at_run > taken").select("conv", (F.col("at_run") - F.col("taken") + F.col("got")).alias("depth"), "digest", "bytes")
    starts = ordered.where(F.col("at_run") <= MOST_BORROWED).select(F.col("conv").alias("base"), "at_run", "digest", "bytes")
    given = starts.join(plan, "base").where("at_run <= taken").select("conv", F.col("at_run").alias("depth"), "digest", "bytes")
    return kept.unionByName(given), plan.select("conv")


NODE = ["depth", "a", "b"]


def _blocks(prefixes: DataFrame) -> DataFrame:
    """Blocks of every conversation: the prefix before it (``pa, pb``) and its own end (``depth, a, b``)."""
    own = prefixes.groupBy("conv", "block").agg(F.max(F.struct("depth", "a", "b")).alias("end"), F.bit_xor("za").alias("xa"), F.bit_xor("zb").alias("xb"))
    return own.select("conv", "block", F.col("end.a").bitwiseXOR(F.col("xa")).alias("pa"), F.col("end.b").bitwiseXOR(F.col("xb")).alias("pb"), F.col("end.depth").alias("end"), F.col("end.a").alias("ea"), F.col("end.b").alias("eb"))


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The SHA-256 of each node's lists of ids, comma-joined, rows in order. Only the state of one hash is held."""
    key, state = None, None
    for batch in batches:
        done = []
        for depth, a, b, ids in batch[["depth", "a", "b", "ids"]].itertuples(index=False):
            if (depth, a, b) == key:
                state.update(b",")
            else:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (depth, a, b), hashlib.sha256()
            state.update(ids.encode())
        yield pd.DataFrame(done, columns=[*NODE, "ends_sha256"])
    if key is not None:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=[*NODE, "ends_sha256"])


def _end_hashes(ends: DataFrame) -> DataFrame:
    """Per node the hash of the conversations ``conv`` that end there, in numeric order."""
    some = ends.groupBy(*NODE, F.floor(F.col("conv") / F.lit(IDS)).alias("range")).agg(F.array_sort(F.collect_list("conv")).alias("convs"))
    texts = some.select(*NODE, "range", F.array_join(F.col("convs").cast("array<string>"), ",").alias("ids"))
    return texts.repartition(*NODE).sortWithinPartitions(*NODE, "range").mapInPandas(_hashed, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row per node of the trie of rebuilt conversations: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    Turns are ordered by turn, null first, then by the MD5 of role and text; repeated rows are turns of their own. Null role or text is
    empty. Rows without ``conv_id`` belong to no conversation; other columns are passed over. No conversation, no node.
    """
    turns, convs = rebuilt(digested(conversations))
    marked = turns.select("conv", "depth", "bytes", F.xxhash64("digest", "depth").alias("za"), F.xxhash64("depth", "digest", F.lit("b")).alias("zb"))
    run = scanned(marked, "conv", ["depth"], xors=("za", "zb"))
    prefixes = settle(run.select("conv", "depth", "bytes", "za", "zb", F.col("za_run").alias("a"), F.col("zb_run").alias("b"), F.floor((F.col("depth") - 1) / F.lit(BLOCK)).alias("block")), "prefixes")

    blocks = settle(_blocks(prefixes), "blocks")
    block = ["block", "pa", "pb", "end", "ea", "eb"]
    distinct = settle(blocks.groupBy(*block).agg(F.count("*").alias("members"), F.min("conv").alias("conv")), "distinct-blocks")
    kinds = distinct.groupBy("block", "pa", "pb").agg(F.count("*").alias("kinds"))
    chosen = distinct.join(kinds, ["block", "pa", "pb"]).select("conv", "block", "end", "ea", "eb", "members", (F.col("kinds") > 1).alias("parts"))
    # The turns of one conversation for each block.
    inside = settle(prefixes.join(chosen, ["conv", "block"]), "turns-of-blocks")
    shape = [*NODE, "conv", "n_convs", "bytes", "za", "zb"]
    straight = inside.where(~F.col("parts")).withColumn("n_convs", F.col("members")).select(*shape)
    parted = inside.where("parts").groupBy(*NODE).agg(F.min("conv").alias("conv"), F.sum("members").alias("n_convs"), F.max("bytes").alias("bytes"), F.max("za").alias("za"), F.max("zb").alias("zb")).select(*shape)
    nodes = straight.unionByName(parted).withColumn("weight", (F.col("n_convs") - 1) * F.col("bytes"))
    nodes = settle(scanned(nodes, "conv", ["depth"], sums=("weight",)), "nodes")

    above = [(F.col("depth") - 1).alias("depth"), F.col("a").bitwiseXOR(F.col("za")).alias("a"), F.col("b").bitwiseXOR(F.col("zb")).alias("b")]
    children = settle(nodes.select(*above).groupBy(*NODE).agg(F.count("*").alias("n_children")), "children")
    nodes = settle(nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes-with-children")
    owned = settle(nodes.groupBy("conv").agg(F.sum("weight").alias("owned"), F.count_if(F.col("n_children") == 0).alias("leaves")), "owned")
    sums = [F.sum("owned").alias("owned"), F.sum("leaves").alias("leaves")]
    by_block = blocks.join(owned, "conv").groupBy("end", "ea", "eb").agg(*sums)
    by_node = inside.select(*NODE, "end", "ea", "eb").join(by_block, ["end", "ea", "eb"]).groupBy(*NODE).agg(*sums)

    last = blocks.groupBy("conv").agg(F.max(F.struct("end", "ea", "eb")).alias("e")).select("conv", F.col("e.end").alias("depth"), F.col("e.ea").alias("a"), F.col("e.eb").alias("b"))
    zero = F.lit(0).cast("long")
    ends = convs.join(last, "conv", "left").select("conv", *(F.coalesce(c, zero).alias(c) for c in NODE))
    hashes = settle(_end_hashes(ends), "end-hashes")

    first = children.where("depth = 0").agg(F.coalesce(F.sum("n_children"), zero).alias("n_children"))
    every = owned.agg(F.coalesce(F.sum("owned"), zero).alias("saved_tokens"), F.coalesce(F.sum("leaves"), zero).alias("leaves"))
    n_convs, least, n_children, saved, leaves = (*convs.agg(F.count("*"), F.min("conv")).first(), *first.first(), *every.first())
    below = nodes.join(by_node, NODE).join(hashes, NODE, "left")
    names = nodes.select(*NODE, F.col("conv").alias("parent_conv_id"))
    parents = names.select(F.col("depth").alias("p_depth"), F.col("a").alias("p_a"), F.col("b").alias("p_b"), "parent_conv_id")
    linked = below.withColumns({"p_depth": above[0], "p_a": above[1], "p_b": above[2]}).join(parents, ["p_depth", "p_a", "p_b"], "left")
    empty = hashlib.sha256().hexdigest()
    result = linked.select(
        F.col("conv").alias("conv_id"), "depth", F.when(F.col("depth") == 1, F.lit(least).cast("long")).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), (F.col("owned") - F.col("weight_run") + F.col("weight")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )
    if not n_convs:
        return result
    top = conversations.sparkSession.createDataFrame([(least, 0, None, n_convs, n_children, leaves or 1, saved)], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")
    own = hashes.where("depth = 0").select(F.col("depth"), "ends_sha256")
    return result.unionByName(top.join(own, "depth", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(empty))).select(*result.columns))


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
