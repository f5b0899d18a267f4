"""The trie of conversation prefixes, rolled up by centroid decomposition of its parent edges.

Conversations are rebuilt turn by turn, and each prefix is named by its content: blocks of ``BLOCK`` turns are hashed
prefix by prefix, blocks of blocks in the same way, so that a conversation with a third of all turns is as many small
groups as it has blocks. Equal names are one node. A node belongs to the smallest conversation through it, and the nodes of one
conversation are a stretch at the end of its path; the paths of the conversations that own nodes are all that the rollup needs.

The rollup splits the tree at centroids. A centroid is the deepest node whose part of its component is at least half of it.
Removed, it leaves the parts below it and the part above. The totals of the parts below and its own value are added to
every node on the path from the centroid to the top of the component. What a node gets over all rounds is the sum of its
subtree. Components of more than ``LOCAL_NODES`` nodes are split by joins and aggregations, smaller ones
are split to the end where they lie, many at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.ordered import keep_places, number_in_order
from orderloom.session import stage

# Fixed values of the rebuilding: conversations a family, and the bound of the turns taken from its head
FAMILY, HEADS = 5, 9
BLOCK = 64
LOCAL_NODES = 4096
ROWS_A_STEP = 200_000
IDS_A_CHUNK = 1000

VALUES = ["n_leaves", "saved_tokens"]


# --- rebuilt conversations -----------------------------------------------------------------------
def _turn_digest(role: Column, text: Column) -> Column:
    """Names what is said in a turn. The length of the role keeps role and text apart."""
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


def _numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, _pos, _size, said, n_bytes): turns in order, without their texts."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    slim = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"), _turn_digest(role, text).alias("said"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("said")]
    return number_in_order(keep_places(slim, "turns"), ["conv_id"], order, "turns-in-order").select("conv_id", "_pos", "_size", "said", "n_bytes")


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The staged turns (conv_id, q, said, n_bytes) of the rebuilt conversations, q from 1, and (conv_id, length) of each."""
    spark = conversations.sparkSession
    turns = stage(spark, _numbered_turns(conversations), "numbered-turns")
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    whole = turns.where("_pos = 0").select("conv_id", F.col("_size").alias("own"), head.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"))
    first = whole.where("conv_id = family").select("family", F.col("own").alias("first_own"))
    plan = whole.join(first, "family", "left").select(
        "conv_id", "family", "h", "own", F.least("h", F.coalesce("first_own", F.lit(0))).alias("taken")
    )
    plan = stage(spark, plan, "rebuilding")
    borrowed = turns.where(F.col("conv_id") % FAMILY == 0).where(F.col("_pos") < HEADS).withColumnRenamed("conv_id", "family")
    borrowed = borrowed.join(plan.select("conv_id", "family", "taken"), "family").where("_pos < taken")
    borrowed = borrowed.select("conv_id", (F.col("_pos") + 1).alias("q"), "said", "n_bytes")
    kept = turns.join(plan.select("conv_id", "h", "taken"), "conv_id").where("_pos >= h")
    kept = kept.select("conv_id", (F.col("_pos") - F.col("h") + F.col("taken") + 1).alias("q"), "said", "n_bytes")
    lengths = plan.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).cast("long").alias("length"))
    return stage(spark, borrowed.unionByName(kept), "rebuilt-turns"), lengths


def prefix_names(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, q from 1, said, n_bytes) with ``node``, which names the first q turns by their content."""
    spark = turns.sparkSession
    block = F.floor((F.col("q") - 1) / BLOCK)
    said = F.transform("turns", lambda t: t["said"])
    blocks = turns.groupBy("conv_id", block.alias("block")).agg(F.array_sort(F.collect_list(F.struct("q", "said", "n_bytes"))).alias("turns"))
    # at most BLOCK names: the prefixes of a block that begins where the block does
    names = F.transform(said, lambda _, i: F.unhex(F.sha2(F.array_join(F.transform(F.slice(said, F.lit(1), i + 1), F.hex), "").cast("binary"), 256)))
    blocks = stage(spark, blocks.withColumn("names", names), "prefix-blocks")
    most = blocks.agg(F.max("block")).first()[0] or 0
    if most:
        whole = blocks.where(F.size("turns") == BLOCK)
        above = whole.select("conv_id", (F.col("block") + 1).alias("q"), F.element_at("names", -1).alias("said"), F.lit(0).cast("long").alias("n_bytes"))
        before = prefix_names(above).select("conv_id", F.col("q").alias("block"), F.col("node").alias("before"))
        blocks = blocks.join(before, ["conv_id", "block"], "left")
    else:
        blocks = blocks.withColumn("before", F.lit(None).cast("binary"))
    rows = blocks.select("conv_id", "before", F.explode(F.arrays_zip("turns", "names")).alias("z"))
    inner = F.col("z.names")
    node = F.when(F.col("before").isNull(), inner).otherwise(F.unhex(F.sha2(F.concat("before", inner), 256)))
    return rows.select("conv_id", F.col("z.turns.q").alias("q"), F.col("z.turns.said").alias("said"), F.col("z.turns.n_bytes").alias("n_bytes"), node.alias("node"))


ROOT = hashlib.sha256(b"").digest()


def _paths(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, depth, node, before, n_bytes, last): every node of every conversation's path, the root included."""
    named = prefix_names(turns)
    root = F.lit(bytearray(ROOT))
    rows = named.select("conv_id", F.col("q").alias("depth"), "node", "n_bytes")
    rows = rows.unionByName(lengths.select("conv_id", F.lit(0).cast("long").alias("depth"), root.alias("node"), F.lit(0).cast("long").alias("n_bytes")))
    return rows


# --- what a node holds by itself -----------------------------------------------------------------
ENDS = T.StructType([T.StructField("depth", T.LongType()), T.StructField("node", T.BinaryType()), T.StructField("first", T.LongType()), T.StructField("ids", T.StringType())])
HASHED = T.StructType([T.StructField("depth", T.LongType()), T.StructField("node", T.BinaryType()), T.StructField("ends_sha256", T.StringType())])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (depth, node, conv_id) in order as chunks of joined identifiers, each of one node."""
    for batch in batches:
        depth, node, conv = (batch.column(k).to_pylist() for k in range(3))
        out: dict[str, list] = {f.name: [] for f in ENDS}
        at = 0
        while at < len(conv):
            end = at + 1
            while end < len(conv) and end - at < IDS_A_CHUNK and node[end] == node[at] and depth[end] == depth[at]:
                end += 1
            for name, value in zip(out, (depth[at], node[at], conv[at], ",".join(map(str, conv[at:end])))):
                out[name].append(value)
            at = end
        yield pa.record_batch([pa.array(out["depth"], pa.int64()), pa.array(out["node"], pa.binary()), pa.array(out["first"], pa.int64()), pa.array(out["ids"], pa.string())], names=list(out))


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash for each node from its chunks in order; only a hasher's state is held."""
    key, hasher = None, None
    for batch in batches:
        done: list[tuple] = []
        for depth, node, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
            if key == (depth, node):
                hasher.update(b",")
            else:
                if key is not None:
                    done.append((*key, hasher.hexdigest()))
                key, hasher = (depth, node), hashlib.sha256()
            hasher.update(ids.encode())
        yield _hashed(done)
    if key is not None:
        yield _hashed([(*key, hasher.hexdigest())])


def _hashed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.binary(), pa.string())
    return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=HASHED.names)


def ends_hashes(ends: DataFrame) -> DataFrame:
    """(depth, node, ends_sha256) of rows (depth, node, conv_id), the conversations that end in a node.

    The hash runs over all identifiers of a node in order, so its last step is one task's; what that task reads are
    chunks of a thousand identifiers, made before by tasks that share the node.
    """
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["depth", "node"]
    laid = ends.select(*key, "conv_id").repartitionByRange(parts, *key, "conv_id").sortWithinPartitions(*key, "conv_id")
    chunks = laid.mapInArrow(_chunks, ENDS)
    return chunks.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(_hash_chunks, HASHED)


# --- rollup --------------------------------------------------------------------------------------
def split_locally(conv: np.ndarray, depth: np.ndarray, parent_conv: np.ndarray, component: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree sums of ``values`` in whole components, by centroid decomposition of all of them side by side."""
    n = len(conv)
    order = np.lexsort((depth, conv))
    keys = np.rec.fromarrays([conv[order], depth[order]])
    wanted = np.rec.fromarrays([parent_conv, depth - 1], dtype=keys.dtype)
    place = np.minimum(np.searchsorted(keys, wanted), n - 1)
    parent = order[place]
    known = (conv[parent] == parent_conv) & (depth[parent] == depth - 1) & (component[parent] == component)
    parent = np.where(known, parent, -1)
    by_depth = np.argsort(depth, kind="stable")
    levels = np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1)
    sums, alive = np.zeros_like(values), np.ones(n, dtype=bool)
    while alive.any():
        levels = [kept for level in levels if len(kept := level[alive[level]])]
        size, top = alive.astype(np.int64), np.arange(n)
        for level in reversed(levels):
            below = level[parent[level] >= 0]
            np.add.at(size, parent[below], size[below])
        for level in levels:
            below = level[parent[level] >= 0]
            top[below] = top[parent[below]]
        here = np.flatnonzero(alive)
        heavy = here[2 * size[here] >= size[top[here]]]  # a path down from each top; its end is the centroid
        heavy = heavy[np.argsort(depth[heavy], kind="stable")]
        centroid_of = np.full(n, -1)
        centroid_of[top[heavy]] = heavy
        centroids = centroid_of[centroid_of >= 0]
        chosen = np.zeros(n, dtype=bool)
        chosen[centroids] = True
        # totals of the parts that remain, then those below each centroid together with its own value
        cut = (parent >= 0) & chosen[np.maximum(parent, 0)]
        part = np.arange(n)
        for level in levels:
            below = level[(parent[level] >= 0) & ~cut[level]]
            part[below] = part[parent[below]]
        totals = np.zeros_like(values)
        np.add.at(totals, part[here], values[here])
        whole = values.copy()
        # the part that begins at a centroid is the centroid alone, as all edges below it are cut
        tops = np.flatnonzero(cut & alive)
        np.add.at(whole, parent[tops], totals[tops])
        at, added = centroids, whole[centroids]
        while len(at):
            np.add.at(sums, at, added)
            up = parent[at]
            at, added = up[up >= 0], added[up >= 0]
        alive[centroids] = False
        parent = np.where(cut | chosen, -1, parent)
    return sums


LOCAL = "depth long, node binary, n_leaves long, saved_tokens long"


def _local_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (component, conv_id, depth, node, parent_conv_id, n_leaves, saved_tokens), components side by side, with their sums."""
    held: list[pa.Table] = []
    rows = 0

    def done(table: pa.Table) -> pa.RecordBatch:
        _, component = np.unique(np.array(table.column("component").to_pylist(), dtype=object).astype("S64"), return_inverse=True)
        conv, depth, parent, leaves, saved = (table.column(c).to_numpy() for c in ("conv_id", "depth", "parent_conv_id", *VALUES))
        sums = split_locally(conv, depth, parent, component, np.stack([leaves, saved], axis=1))
        node = table.column("node").combine_chunks()
        return pa.record_batch([pa.array(depth), node, pa.array(sums[:, 0]), pa.array(sums[:, 1])], names=["depth", "node", *VALUES])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows >= ROWS_A_STEP:
            table = pa.concat_tables(held)
            names = table.column("component").to_pylist()
            cut = len(names)
            while cut and names[cut - 1] == names[-1]:
                cut -= 1
            if cut:
                yield done(table.slice(0, cut))
            held, rows = [table.slice(cut)], len(names) - cut
    if rows:
        yield done(pa.concat_tables(held))


def _split_by_joins(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round over large components.

    ``rows`` (conv_id, depth, node, parent_conv_id, own, component, values) are the paths of the owning conversations inside
    them. Returns the rows with their next component, the centroids' left out, and what nodes (depth, node) get.
    """
    # a path lies in a component as one stretch, and its own nodes are the end of that
    runs = rows.groupBy("conv_id", "component").agg(F.max("depth").alias("end"), F.min(F.when(F.col("own"), F.col("depth"))).alias("own_from"))
    below = F.col("end") - F.greatest("depth", "own_from") + 1
    owning = rows.join(runs.where("own_from IS NOT NULL"), ["conv_id", "component"])
    sizes = stage(spark, owning.groupBy("component", "depth", "node").agg(F.sum(below).alias("size")), "trie-sizes")
    totals = sizes.groupBy("component").agg(F.max("size").alias("total"))
    heavy = sizes.join(totals, "component").where("2 * size >= total")
    centroids = heavy.groupBy("component").agg(F.max(F.struct("depth", "node")).alias("c"))
    centroids = stage(spark, centroids.select("component", F.col("c.depth").alias("at"), F.col("c.node").alias("centroid")), "trie-centroids")

    marked = rows.join(centroids, "component")
    through = (F.col("depth") == F.col("at")) & (F.col("node") == F.col("centroid"))
    child = F.max(F.when(F.col("depth") == F.col("at") + 1, F.col("node")))
    passing = marked.groupBy("conv_id", "component").agg(F.max(through).alias("passes"), child.alias("child")).where("passes")
    moved = marked.join(passing, ["conv_id", "component"], "left").withColumn("passes", F.coalesce("passes", F.lit(False)))
    part = F.when(F.col("passes") & (F.col("depth") > F.col("at")), F.col("child")).otherwise(F.col("component"))
    moved = stage(spark, moved.withColumn("part", part).withColumn("is_centroid", through), "trie-parts")

    # totals of the parts below a centroid, and with its own value what its path gets
    below_it = F.col("own") & (F.col("is_centroid") | (F.col("passes") & (F.col("depth") > F.col("at"))))
    part_totals = moved.where(below_it).groupBy("component", "part").agg(*[F.sum(v).alias(v) for v in VALUES])
    added = part_totals.groupBy("component").agg(*[F.sum(v).alias(f"add_{v}") for v in VALUES])
    owners = moved.where("own AND is_centroid").select("component", "conv_id")
    path = moved.where("depth <= at").join(owners, ["component", "conv_id"]).select("component", "depth", "node")
    gains = path.join(added, "component").select("depth", "node", *[F.col(f"add_{v}").alias(v) for v in VALUES])
    left = moved.where("NOT is_centroid").select("conv_id", "depth", "node", "parent_conv_id", "own", F.col("part").alias("component"), *VALUES)
    return left, stage(spark, gains, "trie-gains")


def _component_sizes(rows: DataFrame) -> DataFrame:
    return rows.where("own").groupBy("component").agg(F.count(F.lit(1)).alias("nodes"))


def subtree_sums(nodes: DataFrame, above: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """Rows (depth, node, n_leaves, saved_tokens) whose sums by node are those over its subtree.

    ``nodes`` has conv_id, depth, node, parent_conv_id and the values of each node, and ``above`` (conv_id, depth, node) what
    the path of every conversation that owns a node has above its own nodes.
    """
    spark = nodes.sparkSession
    of_others = above.select(
        "conv_id", "depth", "node", F.lit(None).cast("long").alias("parent_conv_id"), *[F.lit(0).cast("long").alias(v) for v in VALUES], F.lit(False).alias("own")
    )
    rows = nodes.select("conv_id", "depth", "node", "parent_conv_id", *VALUES, F.lit(True).alias("own")).unionByName(of_others)
    rows = rows.withColumn("component", F.lit(bytearray(ROOT)))
    # the whole tree is the first component; rows are those of large ones from here on
    some_large = nodes.count() > local_nodes
    small, gains = None if some_large else rows.where("own"), []
    while some_large:
        left, gained = _split_by_joins(spark, rows)
        left = stage(spark, left, "trie-left")
        gains.append(gained)
        large = stage(spark, _component_sizes(left).where(F.col("nodes") > local_nodes).select("component"), "trie-large")
        some_large = not large.isEmpty()
        rest = left.where("own")
        rest = rest.join(large, "component", "left_anti") if some_large else rest
        small = rest if small is None else small.unionByName(rest)
        rows = left.join(large, "component", "left_semi")

    local = small.withColumn("parent_conv_id", F.coalesce("parent_conv_id", F.lit(-1).cast("long")))
    local = local.select("component", "conv_id", "depth", "node", "parent_conv_id", *VALUES)
    sums = local.repartition("component").sortWithinPartitions("component").mapInArrow(_local_sums, LOCAL)
    for gained in gains:
        sums = sums.unionByName(gained)
    return sums


def _hung_up(nodes: DataFrame, tops: DataFrame) -> DataFrame:
    """``nodes`` with parent_conv_id, n_children and their values.

    ``tops`` (conv_id, depth, over_conv) says whose node the stretch of a conversation hangs on. A node counts as a child one
    place up, in its own conversation, and a top in the other one too; where a conversation has no node of its own, such a count
    stands alone and goes.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    nobody, no_node = F.lit(None).cast("long"), F.lit(None).cast("struct<node:binary,n_convs:bigint,n_bytes:bigint>")

    def said(conv: str, up: int, node: Column, over: Column, child: Column) -> Column:
        return F.struct(F.col(conv).alias("conv_id"), (F.col("depth") - up).alias("depth"), node.alias("own"), over.alias("over_conv"), child.alias("child"))

    of_node = F.array(said("conv_id", 0, F.struct("node", "n_convs", "n_bytes"), nobody, zero), said("conv_id", 1, no_node, nobody, one))
    of_top = F.array(said("conv_id", 0, no_node, F.col("over_conv"), zero), said("over_conv", 1, no_node, nobody, one))
    rows = nodes.select(F.explode(of_node).alias("r")).unionByName(tops.select(F.explode(of_top).alias("r"))).select("r.*")
    whole = rows.groupBy("conv_id", "depth").agg(
        F.first("own", True).alias("own"), F.max("over_conv").alias("over_conv"), F.sum("child").alias("n_children")
    ).where("own IS NOT NULL")
    return whole.select(
        "conv_id", "depth", "own.node", F.when(F.col("depth") > 0, F.coalesce("over_conv", "conv_id")).alias("parent_conv_id"), "own.n_convs", "n_children",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("own.n_convs") - 1) * F.col("own.n_bytes")).alias("saved_tokens"),
    )


def prefix_trie(conversations: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    Turns of a conversation stand by ``turn``, none first, then by role and by a hash of what is said; repeated rows are
    turns of their own. A null role or text is empty. Rows without conv_id belong to no conversation. The head of the family of a negative
    conv_id is found with SQL's remainder, which has its sign. Other columns are not looked at. An empty table has no
    conversation, and no root either.
    """
    spark = conversations.sparkSession
    turns, lengths = rebuilt_turns(conversations)
    paths = stage(spark, _paths(turns, lengths), "prefixes")
    nodes = paths.groupBy("depth", "node").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes"))
    nodes = stage(spark, nodes, "trie-nodes")

    # a conversation owns the end of its path; the node above that is the only one of another's that it hangs on
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("from"))
    above = paths.select("conv_id", "depth", "node").join(owned, "conv_id").where(F.col("depth") < F.col("from"))
    above = stage(spark, above, "paths-above")
    hangs = above.where("depth = from - 1").select("conv_id", F.col("from").alias("depth"), F.col("node").alias("above"))
    over = nodes.select(F.col("depth").alias("over"), F.col("node").alias("above"), F.col("conv_id").alias("over_conv"))
    tops = hangs.join(over, (hangs["depth"] - 1 == over["over"]) & (hangs["above"] == over["above"])).select("conv_id", "depth", "over_conv")
    nodes = stage(spark, _hung_up(nodes, tops), "trie-values")
    sums = subtree_sums(nodes, above, local_nodes)

    last = F.max(F.struct("depth", "node")).alias("last")
    ends = ends_hashes(paths.groupBy("conv_id").agg(last).select("conv_id", "last.depth", "last.node"))
    # what is known of a node meets in one shuffle
    key, own = ["depth", "node"], F.struct("conv_id", "parent_conv_id", "n_convs", "n_children").alias("own")
    known = nodes.select(*key, own)
    for more in (sums, ends):
        known = known.unionByName(more, allowMissingColumns=True)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        known.groupBy(*key)
        .agg(F.first("own", True).alias("own"), *[F.sum(v).alias(v) for v in VALUES], F.max("ends_sha256").alias("ends"))
        .select("own.conv_id", "depth", "own.parent_conv_id", "own.n_convs", "own.n_children", *VALUES, F.coalesce("ends", none).alias("ends_sha256"))
    )
