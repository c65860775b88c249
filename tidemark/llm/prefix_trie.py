"""Conversation prefix trie by whole-sequence collapse.

Every conversation becomes a sequence of turn digests.  Identical sequences are
collapsed into one weighted sequence with the list of the conversations that end
there; sequences that are proper prefixes of another one are told from leaves by
an anti-join; the prefixes of the weighted sequences are then aggregated.

No conversation is ever held in one row or task.  Turns lie in range parts (the
conversation, then its order), so a conversation of any length is cut into
blocks; counts, positions and prefix keys are running values inside a block plus
what the blocks before it add.  Only a conversation that crosses the border of
a part needs such an addition, so there are fewer of them than parts.

A prefix is named by two 64-bit lanes, each the XOR over its turns of a hash of
(position, turn digest).  Rows that meet on a name must agree on the parent's
name and on the digest of the last turn, which by induction makes the whole
prefixes equal; where they do not, the job stops.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_stream, materialize

# At most this many turns are taken over from another conversation.
SHARED_TURNS = 5
FAMILY = 100
# Decimal ids are joined in strings of this many before they are digested.
END_CHUNK = 4096
# A node with more than this share of all nodes as children is joined by
# broadcast; there are at most 1 / share of them.
HOT_SHARE = 1 / 256
EMPTY = hashlib.sha256(b"").hexdigest()

KEY = ["k1", "k2"]


def _parts(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def turn_rows(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
              role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, digest, size) of every row that has a conversation.

    The digest covers role and text, null as empty; size is the text's code points.
    """
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.char_length(text).cast("long").alias("size"))


def shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes from its family's first one."""
    return F.pmod(F.crc32(conv.cast("string")), F.lit(SHARED_TURNS + 1)).cast("int")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, part, i, digest, size): the turns of every rebuilt conversation, i from 1.

    A conversation c is rebuilt from the first h turns of c - c % 100 (% keeps
    the sign of c) and its own turns after its first h.  ``part`` is the range
    part of the row.
    """
    numbered = turns.withColumn("tie", F.monotonically_increasing_id())
    order = [F.col("turn").asc_nulls_first(), "digest", "tie"]
    first = numbered.where(F.col("conv") % FAMILY == 0) \
        .withColumn("rank", F.row_number().over(Window.partitionBy("conv").orderBy(*order))) \
        .where(F.col("rank") <= SHARED_TURNS) \
        .select(F.col("conv").alias("base"), F.col("rank").cast("long").alias("rank"), "digest", "size")
    members = turns.select("conv").distinct().withColumn("base", F.col("conv") - F.col("conv") % FAMILY)
    heads = members.join(first, "base").where(F.col("rank") <= shared_turns(F.col("conv"))) \
        .select("conv", F.lit(0).alias("kind"), F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"),
                "digest", F.col("rank").alias("tie"), "size")
    own = numbered.select("conv", F.lit(1).alias("kind"), "turn", "digest", "tie", "size")

    # Heads come in the order of their rank, own turns in that of the conversation.
    place = [F.col("conv"), F.col("kind"), F.when(F.col("kind") == 0, F.col("tie")).alias("at"),
             F.col("turn").asc_nulls_first(), F.col("digest"), F.col("tie")]
    together = heads.unionByName(own)
    rows = materialize(together.repartitionByRange(_parts(turns), *place).withColumn("part", F.spark_partition_id()),
                       "trie-turns")

    before = _before(rows.groupBy("conv", "part").agg(F.count_if(F.col("kind") == 0).alias("heads"),
                                                      F.count_if(F.col("kind") == 1).alias("owns")),
                     {"heads": F.sum, "owns": F.sum})
    # The same order as the range parts have.
    running = Window.partitionBy("conv", "part").orderBy(
        "kind", F.when(F.col("kind") == 0, F.col("tie")), F.col("turn").asc_nulls_first(), "digest", "tie") \
        .rowsBetween(Window.unboundedPreceding, 0)
    counted = rows.join(F.broadcast(before), ["conv", "part"], "left") \
        .withColumn("head_no", F.coalesce("heads_before", F.lit(0)) + F.count_if(F.col("kind") == 0).over(running)) \
        .withColumn("own_no", F.coalesce("owns_before", F.lit(0)) + F.count_if(F.col("kind") == 1).over(running))
    left_out = shared_turns(F.col("conv"))
    return counted.where((F.col("kind") == 0) | (F.col("own_no") > left_out)).select(
        "conv", "part",
        F.when(F.col("kind") == 0, F.col("head_no")).otherwise(F.col("head_no") + F.col("own_no") - left_out).alias("i"),
        "digest", "size")


def _before(blocks: DataFrame, how: dict) -> DataFrame:
    """What the earlier parts of a conversation add up to, for its later parts.

    Rows only for conversations that lie in more than one part: fewer rows than parts.
    """
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("conv", "part", *[f(c).over(earlier).alias(f"{c}_before") for c, f in how.items()],
                         F.row_number().over(Window.partitionBy("conv").orderBy("part")).alias("__no")) \
        .where(F.col("__no") > 1).drop("__no")


def prefix_rows(sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names of all prefixes, and the blocks they lie in.

    Rows (conv, part, i, digest, size, f1, f2, k1, k2, cum): the lanes of the
    turn and of the prefix that ends with it, and the code points up to it.
    """
    lanes = [F.xxhash64(F.lit(lane), F.col("digest"), F.col("i")).alias(f"f{lane}") for lane in (1, 2)]
    running = Window.partitionBy("conv", "part").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    local = materialize(sequences.select("*", *lanes).withColumns({
        "l1": F.bit_xor("f1").over(running), "l2": F.bit_xor("f2").over(running),
        "sum": F.sum("size").over(running)}), "trie-prefixes")
    blocks = materialize(local.groupBy("conv", "part").agg(
        F.bit_xor("f1").alias("x1"), F.bit_xor("f2").alias("x2"), F.sum("size").alias("sizes"),
        F.max("i").alias("depth")), "trie-blocks")
    before = _before(blocks, {"x1": F.bit_xor, "x2": F.bit_xor, "sizes": F.sum})
    rows = local.join(F.broadcast(before), ["conv", "part"], "left").select(
        "conv", "part", "i", "digest", "size", "f1", "f2",
        *[F.coalesce(f"x{lane}_before", F.lit(0).cast("long")).bitwiseXOR(F.col(f"l{lane}")).alias(f"k{lane}") for lane in (1, 2)],
        (F.coalesce("sizes_before", F.lit(0).cast("long")) + F.col("sum")).alias("cum"))
    return rows, blocks


def end_lists(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of the ids that end at a node, in ascending order.

    Ids are ordered by range and joined in strings of at most ``END_CHUNK`` where
    they lie; the strings of a node, in order, then pass through one digest.
    """

    def join_ids(rows: Iterator[tuple]) -> Iterator[tuple]:
        key, held = None, []
        for k1, k2, conv in rows:
            if held and (key != (k1, k2) or len(held) >= END_CHUNK):
                yield (*key, held[0], ",".join(map(str, held)))
                held = []
            key = k1, k2
            held.append(conv)
        if held:
            yield (*key, held[0], ",".join(map(str, held)))

    def digest(rows: Iterator[tuple]) -> Iterator[tuple]:
        key, running = None, None
        for k1, k2, _, ids in rows:
            if key != (k1, k2):
                if key:
                    yield (*key, running.hexdigest())
                key, running = (k1, k2), hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        if key:
            yield (*key, running.hexdigest())

    ordered = ends.select(*KEY, "conv").repartitionByRange(_parts(ends), *KEY, "conv").sortWithinPartitions(*KEY, "conv")
    joined = map_stream(ordered, [*KEY, "conv"], "k1 long, k2 long, first long, ids string", join_ids)
    by_node = joined.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return map_stream(by_node, [*KEY, "first", "ids"], "k1 long, k2 long, ends_sha256 string", digest)


def _named(nodes: DataFrame) -> DataFrame:
    """Nodes with their parent's conv_id.

    A parent with many children would make its name a hot join key; the few that
    have more than ``HOT_SHARE`` of all nodes below them are broadcast.
    """
    least = max(1, int(nodes.count() * HOT_SHARE))
    parents = nodes.where(F.col("n_children") > 0).select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = parents.where(F.col("n_children") > least).drop("n_children").withColumn("hot", F.lit(True))
    marked = nodes.where("depth > 0").join(F.broadcast(hot), ["p1", "p2"], "left")
    rest = marked.where("hot IS NULL").drop("parent_conv_id", "hot") \
        .join(parents.where(F.col("n_children") <= least).drop("n_children"), ["p1", "p2"])
    root = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return root.unionByName(marked.where("hot").drop("hot")).unionByName(rest)


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty; null turns come first; turns that share
    their number are ordered by their digest, and repeated rows are turns of
    their own.  Rows without a conversation are left out.  An empty table has no
    node; otherwise the root has all conversations, also those that are left
    without a turn.  Other columns are ignored.
    """
    turns = materialize(turn_rows(conversations, conv_col, turn_col, role_col, text_col), "trie-digests")
    rows, blocks = prefix_rows(rebuilt(turns))

    # Identical conversations become one weighted sequence, named by its smallest member.
    zero = F.lit(0).cast("long")
    found = blocks.groupBy("conv").agg(F.bit_xor("x1").alias("k1"), F.bit_xor("x2").alias("k2"),
                                       F.max("depth").alias("depth"), F.sum("sizes").alias("total"))
    ends = materialize(turns.select("conv").distinct().join(found, "conv", "left").select(
        "conv", *[F.coalesce(c, zero).alias(c) for c in (*KEY, "depth", "total")]), "trie-ends")
    weighted = materialize(ends.groupBy(*KEY).agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("weight"), F.max("depth").alias("depth"),
        F.max("total").alias("total")), "trie-sequences")

    # Prefixes of the weighted sequences: joined by block, so a long one stays spread out.
    here = blocks.select("conv", "part").join(weighted.select("conv", "weight"), "conv")
    walked = rows.join(here, ["conv", "part"])
    roots = weighted.select("conv", F.lit(-1).alias("part"), zero.alias("i"), F.lit(b"").alias("digest"), zero.alias("size"),
                            zero.alias("f1"), zero.alias("f2"), zero.alias("k1"), zero.alias("k2"), zero.alias("cum"), "weight")
    walked = materialize(walked.unionByName(roots), "trie-walks")

    parent = [F.col(f"k{lane}").bitwiseXOR(F.col(f"f{lane}")) for lane in (1, 2)]
    nodes = walked.groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"), F.sum("weight").alias("n_convs"), F.max("i").alias("depth"),
        F.max("size").alias("size"), F.max("cum").alias("cum"), F.max("digest").alias("digest"),
        F.max(parent[0]).alias("p1"), F.max(parent[1]).alias("p2"),
        *[F.min(c).alias(f"least_{n}") for n, c in (("i", F.col("i")), ("digest", F.col("digest")), ("p1", parent[0]), ("p2", parent[1]))])
    same = (F.col("least_i") == F.col("depth")) & (F.col("least_digest") == F.col("digest")) \
        & (F.col("least_p1") == F.col("p1")) & (F.col("least_p2") == F.col("p2"))
    nodes = materialize(nodes.withColumn("depth", F.when(same, F.col("depth")).otherwise(
        F.raise_error(F.lit("two different prefixes have one name")).cast("long")))
        .select(*KEY, "p1", "p2", "conv_id", "n_convs", "depth", "size", "cum"), "trie-nodes")

    # Leaves: sequences that are no proper prefix of another one.
    children = nodes.where("depth > 0").groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("n_children")) \
        .select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "n_children")
    children = materialize(children, "trie-children")
    leaves = weighted.join(children, KEY, "left_anti").withColumn("leaf", F.lit(1))
    inner = weighted.join(children, KEY, "left_semi").withColumn("leaf", F.lit(0))

    # A sequence owns the nodes that are named after it: those from some depth on.
    # Each node's text is counted once below every ancestor by way of its owner.
    owned = nodes.groupBy(F.col("conv_id").alias("conv")).agg(
        F.min("depth").alias("own_from"), F.min_by(F.col("cum") - F.col("size"), "depth").alias("cum_before"))
    known = materialize(leaves.unionByName(inner).join(owned, "conv", "left").select(
        "conv", "total", "leaf", "own_from", (F.col("total") - F.col("cum_before")).alias("own_total")), "trie-owners")
    spread = blocks.select("conv", "part").unionByName(weighted.select("conv", F.lit(-1).alias("part"))).join(known, "conv")
    below = F.col("total") - F.col("cum") + F.col("size")
    mine = F.when(F.col("own_from").isNull(), zero).when(F.col("i") >= F.col("own_from"), below).otherwise(F.col("own_total"))
    sums = walked.join(spread, ["conv", "part"]).groupBy(*KEY).agg(
        F.sum("leaf").alias("n_leaves"), F.sum(F.col("weight") * below - mine).alias("saved_tokens"))

    counted = materialize(nodes.join(children, KEY, "left").join(sums, KEY).join(end_lists(ends), KEY, "left")
                          .withColumn("n_children", F.coalesce("n_children", zero)), "trie-counted")
    return _named(counted).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                                  F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
