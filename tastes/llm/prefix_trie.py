"""The prefix trie of rebuilt conversations, from sorted neighbours.

Every conversation becomes a sequence of turn digests. The sequences are range
partitioned and sorted; the common prefix length (LCP) of sorted neighbours
says at which depth they part. In a partition a union-find over these LCP
edges, deepest first, builds the trie from its leaves: a merge of components at
depth d creates (or joins) the branching node there, the nodes between it and
the components' tops are chains with one child, and the counts of a node are
those of its component. The root is what is left when all edges are used.

A partition's first and last sequence may go on in its neighbours, so the nodes
on their two paths are open; all others are complete with their whole subtree.
A partition's forest is contracted to those two paths, whose nodes carry the
partition's share of every count, and the shares are merged by the digest of
the node's prefix, in a plain aggregation. The shares add up because a node
that an earlier partition holds too counts there: it is those nodes of the
first path that are no deeper than the LCP with the previous partition's last
sequence. Likewise the last sequence is a leaf here only if the next
partition's first does not begin with it. Both are known from one row a
partition. `saved_tokens` is a sum over members (additive) minus a sum over
nodes (additive with that correction).

A group of equal sequences is dealt over partitions by conversation id; its
members' ids are hashed in ascending order from chunks, one row a partition, by
a task that holds one chunk at a time.

Defined results: rows without a conv_id belong to no conversation; null role
and text are empty; turns are in order of `turn`, null first, equal ones in
order of a digest of role and text, and a repeated row is one more turn. A
conversation whose rebuilt sequence is empty ends at the root. An empty table
has no nodes. Other columns of the table are not looked at, whatever their
names. Texts of any length are read once, for their digest. Memory: a task holds the
digests and sizes of one conversation (24 bytes a turn) and of the sequences of
one partition, about `PARTITION_BYTES`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate, chain

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastes.llm.common import Scratch

# Fixed values of the rebuilding: turns come from the first conversation of a
# block of ids, as many as the checksum of the id says.
SHARED_IDS = 5
HEAD_SIZES = 9

# Bytes of sequences a partition holds, and those of one turn and of one row.
PARTITION_BYTES = 32 << 20
TURN_BYTES = 24
ROW_BYTES = 64

DIGEST = 16
OUT_ROWS = 50_000

_NODE_SCHEMA = (
    "kind string, part int, depth long, id string, parent_id string, conv_id long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, tokens long, "
    "once_tokens long, before long, on_left boolean, on_right boolean, ends string, "
    "first_key binary, first_sizes array<long>, last_key binary"
)


def rebuild(conversations: DataFrame, shared_ids: int = SHARED_IDS, head_sizes: int = HEAD_SIZES) -> DataFrame:
    """(conv_id, turns) with turns array<(digest, size)>: head of the block's first, own rest."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    own = (
        conversations.where("conv_id is not null")
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.struct(
                F.col("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size")
            ).alias("t"),
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
    )
    n = F.crc32(F.col("conv_id").cast("string").cast("binary")) % head_sizes
    base = F.col("conv_id") - F.col("conv_id") % shared_ids
    heads = own.select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, head_sizes - 1).alias("head")
    )
    return (
        own.withColumn("base", base)
        .join(heads, "base", "left")
        .withColumn("n", n.cast("int"))
        .select(
            "conv_id",
            F.expr(
                "concat(coalesce(slice(head, 1, n), cast(array() as array<struct<turn: bigint, "
                "digest: binary, size: bigint>>)), slice(turns, n + 1, size(turns)))"
            ).alias("turns"),
        )
    )


def common_prefix(a: bytes, b: bytes) -> int:
    """Number of leading digests that two sequences share."""
    n = min(len(a), len(b)) // DIGEST
    if a[: n * DIGEST] == b[: n * DIGEST]:
        return n
    low = 0
    while n - low > 1:
        middle = (low + n) // 2
        if a[low * DIGEST : middle * DIGEST] == b[low * DIGEST : middle * DIGEST]:
            low = middle
        else:
            n = middle
    return low


class Forest:
    """The trie of one partition's distinct sequences, by union-find.

    `add` takes the sequences in sorted order; `build` merges them. Node i has
    depth[i], parent[i] (-1: root), members n[i], smallest member least[i],
    children[i], leaves[i], and over its subtree tokens[i] (last texts' bytes
    times members) and once[i] (last texts' bytes).
    """

    def __init__(self) -> None:
        self.keys: list[bytes] = []
        self.sizes: list[list[int]] = []
        self.members: list[list[int]] = []
        self.depth: list[int] = []
        self.parent: list[int] = []
        self.n: list[int] = []
        self.least: list[int] = []
        self.children: list[int] = []
        self.leaves: list[int] = []
        self.tokens: list[int] = []
        self.once: list[int] = []
        self.sequence: list[int] = []  # one whose path the node lies on

    def add(self, key: bytes, sizes, conv_id: int) -> None:
        if self.keys and self.keys[-1] == key:
            self.members[-1].append(conv_id)
        else:
            self.keys.append(key)
            self.sizes.append(sizes)
            self.members.append([conv_id])

    def _node(self, depth: int, n: int, least: int, sequence: int) -> int:
        self.depth.append(depth)
        self.parent.append(-1)
        self.n.append(n)
        self.least.append(least)
        self.children.append(0)
        self.leaves.append(0)
        self.tokens.append(0)
        self.once.append(0)
        self.sequence.append(sequence)
        return len(self.depth) - 1

    def _close(self, node: int) -> None:
        """All children are there: add the node's own last text, count it if a leaf."""
        if not self.children[node]:
            self.leaves[node] = 1
        depth = self.depth[node]
        if depth:
            size = int(self.sizes[self.sequence[node]][depth - 1])
            self.tokens[node] += self.n[node] * size
            self.once[node] += size

    def _attach(self, child: int, node: int) -> None:
        self.parent[child] = node
        self.children[node] += 1
        self.leaves[node] += self.leaves[child]
        self.tokens[node] += self.tokens[child]
        self.once[node] += self.once[child]

    def _climb(self, node: int, depth: int) -> int:
        """Close `node` and its chain up to the child of a node at `depth`."""
        self._close(node)
        for d in range(self.depth[node] - 1, depth, -1):
            above = self._node(d, self.n[node], self.least[node], self.sequence[node])
            self._attach(node, above)
            self._close(above)
            node = above
        return node

    def build(self) -> None:
        top = [
            self._node(len(key) // DIGEST, len(ids), ids[0], i)
            for i, (key, ids) in enumerate(zip(self.keys, self.members, strict=True))
        ]
        component = list(range(len(top)))

        def find(i: int) -> int:
            while component[i] != i:
                component[i] = component[component[i]]
                i = component[i]
            return i

        edges = [
            (-common_prefix(a, b), i) for i, (a, b) in enumerate(zip(self.keys, self.keys[1:]))
        ]
        for shallow, i in sorted(edges):
            depth, left, right = -shallow, find(i), find(i + 1)
            node = top[left]
            if self.depth[node] > depth:
                child = self._climb(node, depth)
                node = self._node(depth, self.n[child], self.least[child], self.sequence[child])
                self._attach(child, node)
            child = self._climb(top[right], depth)
            self._attach(child, node)
            self.n[node] += self.n[child]
            self.least[node] = min(self.least[node], self.least[child])
            component[right] = left
            top[left] = node
        node = top[find(0)]
        if self.depth[node]:
            child = self._climb(node, 0)
            node = self._node(0, self.n[child], self.least[child], self.sequence[child])
            self._attach(child, node)
        self._close(node)

    def path(self, i: int) -> list[int]:
        """The nodes from the root to the end of sequence i (node i is its end)."""
        found, node = [], i
        while node >= 0:
            found.append(node)
            node = self.parent[node]
        return found[::-1]


def _prefix_ids(key: bytes) -> list[str]:
    """The digest of every prefix, the empty one first; the depth is part of it."""
    running, ids = hashlib.md5(), ["0:"]
    for d in range(len(key) // DIGEST):
        running.update(key[d * DIGEST : (d + 1) * DIGEST])
        ids.append(f"{d + 1}:{running.hexdigest()}")
    return ids


def _ids_text(ids: list[int]) -> str:
    return ",".join(map(str, ids))


def forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A partition's complete nodes, its open nodes' shares, and one row of its ends."""
    forest, part = Forest(), None
    for batch in batches:
        if len(batch):
            part = int(batch["part"].iloc[0])
        for key, sizes, conv_id in zip(batch["key"], batch["sizes"], batch["conv_id"], strict=True):
            forest.add(bytes(key), sizes, int(conv_id))
    if part is None:
        return
    forest.build()
    ends = len(forest.keys)
    open_ids: dict[int, str] = {}
    bytes_before: dict[int, int] = {}
    sides: list[set[int]] = []
    for i in (0, ends - 1):
        path = forest.path(i)
        sides.append(set(path))
        open_ids.update(zip(path, _prefix_ids(forest.keys[i]), strict=True))
        above = accumulate((int(x) for x in forest.sizes[i][:-1]), initial=0)
        bytes_before.update(zip(path, chain((0,), above)))

    columns = [c.split()[0] for c in _NODE_SCHEMA.split(", ")]
    rows: list[tuple] = []
    empty = hashlib.sha256(b"").hexdigest()
    for i in range(len(forest.depth)):
        above, is_open = forest.parent[i], i in open_ids
        if is_open:
            listed = _ids_text(forest.members[i]) if i < ends else None
        else:
            listed = hashlib.sha256(_ids_text(forest.members[i]).encode()).hexdigest() if i < ends else empty
        known = not is_open and above not in open_ids
        rows.append(
            (
                "open" if is_open else "closed" if known else "below",
                part,
                forest.depth[i],
                open_ids.get(i),
                open_ids.get(above),
                forest.least[i],
                forest.least[above] if known else None,
                forest.n[i],
                forest.children[i],
                forest.leaves[i],
                forest.tokens[i],
                forest.once[i],
                bytes_before.get(i, 0),
                i in sides[0],
                i in sides[1],
                listed,
                None,
                None,
                None,
            )
        )
        if len(rows) >= OUT_ROWS:
            yield _frame(rows, columns)
            rows = []
    border = dict.fromkeys(columns)
    border |= {"kind": "border", "part": part, "first_key": forest.keys[0], "last_key": forest.keys[-1]}
    border["first_sizes"] = [int(x) for x in forest.sizes[0]]
    rows.append(tuple(border[c] for c in columns))
    yield _frame(rows, columns)


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns, dtype=object)


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per partition: depth shared with the previous one, its bytes, whether the end goes on."""
    for batch in batches:
        out = []
        for r in batch.itertuples():
            shared = -1 if r.previous is None else common_prefix(bytes(r.previous), bytes(r.first_key))
            last = bytes(r.last_key)
            goes_on = r.following is not None and bytes(r.following)[: len(last)] == last
            out.append((r.part, shared, sum(int(x) for x in r.first_sizes[: max(shared, 0)]), goes_on))
        yield pd.DataFrame(out, columns=["part", "shared", "shared_bytes", "goes_on"])


def _hash_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each node's chunks, which come in order; one chunk at a time."""
    current, running = None, None
    for batch in batches:
        done = []
        for r in batch.itertuples():
            if r.id != current:
                if current is not None:
                    done.append((current, running.hexdigest()))
                current, running = r.id, hashlib.sha256(r.ends.encode())
            else:
                running.update(b"," + r.ends.encode())
        yield pd.DataFrame(done, columns=["id", "ends_sha256"])
    if current is not None:
        yield pd.DataFrame([(current, running.hexdigest())], columns=["id", "ends_sha256"])


def prefix_trie(conversations: DataFrame, shared_ids: int = SHARED_IDS, head_sizes: int = HEAD_SIZES) -> DataFrame:
    """One row per trie node: conv_id, depth, parent_conv_id, counts, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    scratch = Scratch(spark, "prefix-trie")
    sequences = scratch.save(
        rebuild(conversations, shared_ids, head_sizes).select(
            "conv_id",
            F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")).alias("key"),
            F.transform("turns", lambda t: t["size"]).alias("sizes"),
        ),
        "sequences",
    )
    size = sequences.select(F.sum(F.size("sizes") * TURN_BYTES + ROW_BYTES)).first()[0] or 0
    setting = spark.conf.get("spark.sql.shuffle.partitions")
    parts = max(int(setting) if setting.isdigit() else 1, size // PARTITION_BYTES + 1)
    ordered = (
        sequences.repartitionByRange(parts, "key", "conv_id")
        .sortWithinPartitions("key", "conv_id")
        .withColumn("part", F.spark_partition_id())
    )
    nodes = scratch.save(ordered.mapInPandas(forests, _NODE_SCHEMA), "nodes")

    # One row a partition: what its first and last sequence share with the next ones.
    by_part = Window.orderBy("part")
    borders = scratch.save(
        nodes.where("kind = 'border'")
        .select("part", "first_key", "first_sizes", "last_key")
        .withColumn("previous", F.lag("last_key").over(by_part))
        .withColumn("following", F.lead("first_key").over(by_part))
        .mapInPandas(_neighbours, "part int, shared long, shared_bytes long, goes_on boolean"),
        "borders",
    )
    shares = nodes.where("kind = 'open'").join(borders, "part")
    counted_before = F.col("on_left") & (F.col("depth") <= F.col("shared"))
    child_before = F.col("on_left") & (F.col("depth") < F.col("shared"))
    goes_on = F.col("on_right") & F.col("goes_on")
    merged = scratch.save(
        shares.groupBy("id", "depth", "parent_id").agg(
            F.min("conv_id").alias("conv_id"),
            F.sum("n_convs").alias("n_convs"),
            F.sum(F.col("n_children") - child_before.cast("long")).alias("n_children"),
            F.sum(F.col("n_leaves") - goes_on.cast("long")).alias("n_leaves"),
            F.sum(
                F.col("tokens")
                - F.col("once_tokens")
                + F.when(counted_before, F.col("shared_bytes") - F.col("before")).otherwise(0)
            ).alias("saved_tokens"),
        ),
        "open",
    )
    hashed = (
        nodes.where("kind = 'open' and ends is not null")
        .select("id", "part", "ends")
        .repartition("id")
        .sortWithinPartitions("id", "part")
        .mapInPandas(_hash_chunks, "id string, ends_sha256 string")
    )
    owners = merged.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    columns = [
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    ]
    complete = nodes.withColumn("saved_tokens", F.col("tokens") - F.col("once_tokens")).withColumnRenamed(
        "ends", "ends_sha256"
    )
    inside = complete.where("kind = 'closed'").select(*columns)
    below = complete.where("kind = 'below'").drop("parent_conv_id").join(owners, "parent_id").select(*columns)
    opened = (
        merged.join(hashed, "id", "left")
        .join(owners, "parent_id", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
        .select(*columns)
    )
    return inside.union(below).union(opened)
