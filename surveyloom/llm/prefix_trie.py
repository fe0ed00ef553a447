"""Trie of conversation prefixes: ternary search trees over range shards.

**Conversations** are put together anew: the first ``h`` turns of conversation ``c - c % 5``, then
the own turns after the first ``h``, where ``h`` is the CRC-32 of the decimal ``c``, modulo 9. The
conversations of such a family (nine at most, where ids below nought meet those above) are built
together, so this is one shuffle. Texts are not shuffled: a turn travels as a 128-bit digest of its role and text, and
the length of its text in bytes.

**Shards.** Equal sequences are counted before anything else, so a conversation that a third of all
rows repeat is one row. Sequences are dealt by range of their digests in order, so that all members
of a node lie in neighbouring shards. In a shard, digests are numbered in order (its dictionary) and
sequences put into a ternary search tree, the median first, then the medians of both halves, so that
every tree of siblings is balanced. Nodes are created after their parents; walking them backwards,
without recursion, adds up members, leaves and savings.

**Boundaries.** Only nodes on the path of a shard's first or last sequence can have members
elsewhere, and how far these paths are shared follows from the first and last sequence of neighbouring shards.
The first shard of such a node counts it as a child, as a leaf and once in the savings; all
figures then add up, and boundary nodes are put together by one aggregate.

**Ends.** The ids that end at a node are sorted by range, joined into pieces inside each task and
digested in order, so that what one task takes up for a node is pieces of ``PIECE`` ids, not rows.

Null roles and texts are empty, turns without a number come first, ties go by role, then by the
digest; repeated rows are repeated turns. Rows without ``conv_id`` belong to no conversation and
are left out. Columns other than ``conv_id, turn, role, text`` are not read; an empty table has no
nodes. A conversation is one row of 24 bytes a turn. Sequences that agree in their first
``KEY_TURNS`` turns stay in one shard.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveyloom.sources.workspace import written

ID_BYTES = 16
FAMILY, HEADS = 5, 9
#: Turns of a shard, where the session's shuffle partitions would give larger ones.
SHARD_TURNS = 500_000
#: Turns that are compared when sequences are dealt to shards; the driver sees a sample of such keys.
KEY_TURNS = 64
#: Ids that are joined into one piece of text.
PIECE = 50_000
_ROWS = 20_000

NODE = (
    "key string, parent_key string, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
RESULT = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, ids, sizes``: digests of the turns of each conversation, one after the other."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    conv = F.col("conv_id").cast("long")
    turns = conversations.where(conv.isNotNull()).select(
        (conv - conv % FAMILY).alias("family"),
        F.struct(
            conv.alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
            # The length of the role tells it from the text.
            F.left(F.sha2(F.concat(F.octet_length(role), F.lit(":"), role, text), 256), F.lit(2 * ID_BYTES))
            .alias("id"),
            F.octet_length(text).cast("long").alias("size"),
        ).alias("t"),
    )
    families = turns.groupBy("family").agg(F.sort_array(F.collect_list("t")).alias("all"))
    members = families.select(
        "family", "all", F.explode(F.array_distinct("all.conv")).alias("conv_id")
    )

    def turns_of(conv_id: Column) -> Column:
        return F.filter("all", lambda t: t["conv"] == conv_id)

    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    own = turns_of(F.col("conv_id"))
    whole = F.concat(
        F.slice(turns_of(F.col("family")), F.lit(1), head.cast("int")),
        F.slice(own, head.cast("int") + 1, F.greatest(F.size(own), F.lit(1))),
    )
    built = members.select("conv_id", F.explode(F.array(whole)).alias("whole"))
    return built.select(
        "conv_id", F.unhex(F.array_join("whole.id", "")).alias("ids"), F.col("whole.size").alias("sizes")
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of the batches as tuples, in order."""
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def ends(sequences: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of ``conv_id, key``: digest of the ids of each key in order."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, int, str]] = []
        key, ids = None, []
        for next_key, conv_id in _runs(batches):
            if next_key != key or len(ids) == PIECE:
                if ids:
                    out.append((key, ids[0], ",".join(map(str, ids))))
                    if len(out) >= _ROWS or len(ids) == PIECE:
                        yield _batch(out, "key", "first", "piece")
                        out = []
                key, ids = next_key, []
            ids.append(conv_id)
        if ids:
            out.append((key, ids[0], ",".join(map(str, ids))))
            yield _batch(out, "key", "first", "piece")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, str]] = []
        key, state = None, None
        for next_key, _, piece in _runs(batches):
            if next_key == key:
                state.update(b"," + piece.encode())
                continue
            if state is not None:
                out.append((key, state.hexdigest()))
            if len(out) >= _ROWS:
                yield _batch(out, "key", "ends_sha256")
                out = []
            key, state = next_key, hashlib.sha256(piece.encode())
        if state is not None:
            out.append((key, state.hexdigest()))
            yield _batch(out, "key", "ends_sha256")

    in_order = sequences.select("key", "conv_id").repartitionByRange("key", "conv_id")
    cut = in_order.sortWithinPartitions("key", "conv_id").mapInArrow(
        pieces, "key string, first long, piece string"
    )
    together = cut.repartition("key").sortWithinPartitions("key", "first")
    return together.mapInArrow(digests, "key string, ends_sha256 string")


def _batch(rows: list[tuple], *names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: pa.array(c) for n, c in zip(names, zip(*rows))})


def dealt(sequences: DataFrame, shards: int) -> DataFrame:
    """Distinct sequences with counts, least id and ends, and the range shard of each."""
    distinct = sequences.groupBy("ids").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"),
        F.any_value("sizes").alias("sizes"),
    )
    with_ends = distinct.withColumn("key", F.sha2("ids", 256)).join(ends(sequences), "key")
    beginning = F.substring("ids", 1, KEY_TURNS * ID_BYTES)
    spread = with_ends.repartitionByRange(shards, beginning)
    return spread.select(
        "ids", "sizes", "n", "least", "ends_sha256", F.spark_partition_id().alias("shard")
    )


def common_turns(a: bytes | None, b: bytes | None) -> int:
    """Turns in which two sequences agree from the beginning; -1 where one is missing."""
    if a is None or b is None:
        return -1
    length = min(len(a), len(b)) // ID_BYTES
    left, right = (np.frombuffer(x, np.uint8)[: length * ID_BYTES] for x in (a, b))
    different = np.flatnonzero(left != right)
    return int(different[0]) // ID_BYTES if len(different) else length


def shared_depths(sequences: DataFrame) -> dict[int, tuple[int, int]]:
    """For each shard, how deep its first and its last path are shared with its neighbours.

    One row for each shard meets its neighbours in a window; three numbers of each reach the driver.
    """
    borders = sequences.groupBy("shard").agg(F.min("ids").alias("first"), F.max("ids").alias("last"))
    order = Window.orderBy("shard")
    beside = borders.select(
        "shard", "first", "last", F.lag("last").over(order).alias("before"),
        F.lead("first").over(order).alias("after"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, first, last, before, after in _runs(batches):
            row = (shard, common_turns(before, first), common_turns(last, after))
            yield _batch([row], "shard", "before", "after")

    rows = beside.mapInArrow(run, "shard long, before long, after long").collect()
    return {r["shard"]: (r["before"], r["after"]) for r in rows}


class TernaryTree:
    """Sequences of numbers; nodes are numbered from 0, the root, parents before children."""

    def __init__(self) -> None:
        self.symbol, self.parent = array("q", [-1]), array("q", [-1])
        #: Root of the tree of a node's children; left and right among siblings. 0 is none.
        self.down, self.left, self.right = array("q", [0]), array("q", [0]), array("q", [0])

    def _new(self, symbol: int, parent: int) -> int:
        for values, value in (
            (self.symbol, symbol), (self.parent, parent), (self.down, 0), (self.left, 0),
            (self.right, 0),
        ):
            values.append(value)
        return len(self.symbol) - 1

    def insert(self, sequence: Iterable[int]) -> int:
        """Puts a sequence in and returns the node at which it ends."""
        above, symbols = 0, self.symbol
        for symbol in sequence:
            node = self.down[above]
            if not node:
                node = self.down[above] = self._new(symbol, above)
            while symbols[node] != symbol:
                side = self.left if symbol < symbols[node] else self.right
                if not side[node]:
                    side[node] = self._new(symbol, above)
                node = side[node]
            above = node
        return above


def medians(count: int) -> Iterator[int]:
    """0 to count - 1: the median, then the medians of both halves, and so on."""
    waiting = [(0, count)]
    while waiting:
        low, high = waiting.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            waiting += [(middle + 1, high), (low, middle)]


def shard_nodes(rows: list[tuple], before: int, after: int) -> Iterator[tuple]:
    """Nodes of one shard, as rows of ``NODE``.

    ``rows`` are ``(ids, sizes, n, least, ends_sha256)`` in order of ``ids``. Nodes shared with a
    neighbour have a key and figures that add up with those of the other shards.
    """
    flat = np.frombuffer(b"".join(r[0] for r in rows), dtype=">u8").reshape(-1, 2)
    _, numbers = np.unique(flat.astype(np.uint64), axis=0, return_inverse=True)
    numbers = numbers.ravel().tolist()
    begins = np.cumsum([0] + [len(r[0]) // ID_BYTES for r in rows]).tolist()
    tree, last_nodes = TernaryTree(), [0] * len(rows)
    for place in medians(len(rows)):
        last_nodes[place] = tree.insert(numbers[begins[place]:begins[place + 1]])
    count = len(tree.symbol)
    members, least = array("q", [0]) * count, array("q", [(1 << 63) - 1]) * count
    size, ending = array("q", [0]) * count, {}
    shared, owned = bytearray(count), bytearray(b"\1") * count
    for place, node in enumerate(last_nodes):
        _, sizes, n, low, sha = rows[place]
        members[node], least[node], ending[node] = n, low, sha
        # Walking up, until a node whose length is known.
        for one in reversed(sizes):
            if size[node]:
                break
            size[node] = one
            node = tree.parent[node]
    depth = array("q", [0]) * count
    for node in range(1, count):
        depth[node] = depth[tree.parent[node]] + 1
    keys = _border_keys(rows, last_nodes, tree, depth, before, after, shared, owned)
    # A last sequence that goes on in the next shard ends at no leaf.
    goes_on = after == len(rows[-1][1])
    children, leaves, saved = (array("q", [0]) * count for _ in range(3))
    for node in range(count - 1, -1, -1):
        if not tree.down[node] and not (goes_on and node == last_nodes[-1]):
            leaves[node] = 1
        saved[node] += (members[node] - owned[node]) * size[node]
        above = tree.parent[node]
        if above >= 0:
            members[above] += members[node]
            least[above] = min(least[above], least[node])
            children[above] += owned[node]
            leaves[above] += leaves[node]
            saved[above] += saved[node]
    for node in range(count):
        above = tree.parent[node]
        yield (
            keys.get(node), keys.get(above) if above >= 0 else None, least[node], depth[node],
            least[above] if above >= 0 else None, members[node], children[node], leaves[node],
            saved[node], ending.get(node),
        )


def _border_keys(
    rows: list[tuple], last_nodes: list[int], tree: TernaryTree, depth: array, before: int,
    after: int, shared: bytearray, owned: bytearray,
) -> dict[int, str]:
    """Marks shared nodes and names them by a digest of their turns."""
    keys: dict[int, str] = {}
    for place, common in ((0, before), (-1, after)):
        path, node = [], last_nodes[place]
        while node >= 0:
            path.append(node)
            node = tree.parent[node]
        state, ids = hashlib.sha256(), rows[place][0]
        for level, node in enumerate(reversed(path)):
            if level > common:
                break
            if level:
                state.update(ids[(level - 1) * ID_BYTES:level * ID_BYTES])
            keys[node], shared[node] = state.hexdigest(), 1
            if place == 0:
                owned[node] = 0
    return keys


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    shard, rows = None, []
    for next_shard, *row in _runs(batches):
        if next_shard != shard and rows:
            yield shard, rows
            rows = []
        shard = next_shard
        rows.append(tuple(row))
    if rows:
        yield shard, rows


def prefix_nodes(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations, columns ``RESULT``."""
    spark = conversations.sparkSession
    sequences = written(
        rebuilt(conversations).withColumn("key", F.sha2("ids", 256)), "conversations"
    )
    turns = sequences.agg(F.sum(F.size("sizes"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // shard_turns))
    spread = written(dealt(sequences, shards), "shards")
    depths = shared_depths(spread)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in NODE.split(", ")]
        kinds = [pa.string() if part.endswith("string") else pa.int64() for part in NODE.split(", ")]
        for shard, rows in _shards(batches):
            out = []
            for node in shard_nodes(rows, *depths[shard]):
                out.append(node)
                if len(out) == _ROWS:
                    yield _typed(out, names, kinds)
                    out = []
            if out:
                yield _typed(out, names, kinds)

    in_shards = spread.repartition(shards, "shard").sortWithinPartitions("shard", "ids")
    nodes = written(
        in_shards.select("shard", "ids", "sizes", "n", "least", "ends_sha256").mapInArrow(run, NODE),
        "trie-nodes",
    )
    borders = written(
        nodes.where("key IS NOT NULL").groupBy("key").agg(
            F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"),
            *[F.sum(n).alias(n) for n in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
            F.max("ends_sha256").alias("ends_sha256"),
        ),
        "trie-borders",
    )
    inner = nodes.where("key IS NULL")
    above = borders.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    below_border = (
        inner.where("parent_key IS NOT NULL").drop("parent_conv_id")
        .unionByName(borders, allowMissingColumns=True)
        .join(above, "parent_key", "left").withColumn("parent_conv_id", F.col("above"))
    )
    whole = inner.where("parent_key IS NULL").select(*RESULT).unionByName(below_border.select(*RESULT))
    return whole.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))


def _typed(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


#: Nodes from all prefixes written out, with the CRC-32 computed bit by bit.
ORACLE = """
WITH turns AS (
    SELECT conv_id, row_number() OVER (
               PARTITION BY conv_id
               ORDER BY turn NULLS FIRST, coalesce(role, ''),
                        sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
           ) AS place,
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
           strlen(coalesce(text, '')) AS size
    FROM conversations WHERE conv_id IS NOT NULL
), bytes AS (
    SELECT conv_id, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT) AS b
    FROM (SELECT DISTINCT conv_id FROM turns)
), heads AS (
    SELECT conv_id, conv_id - conv_id % 5 AS donor,
           xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda crc, c: list_reduce(
               list_prepend(xor(crc, c), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
               lambda x, i: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END::BIGINT)
           )), 4294967295::BIGINT) % 9 AS h
    FROM bytes
), built AS (
    SELECT heads.conv_id, place, id, size FROM heads JOIN turns ON turns.conv_id = donor AND place <= h
    UNION ALL
    SELECT heads.conv_id, place, id, size FROM heads JOIN turns ON turns.conv_id = heads.conv_id AND place > h
), placed AS (
    SELECT conv_id, id, size, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS d FROM built
), paths AS (
    SELECT conv_id, d, size, string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM placed
    UNION ALL SELECT conv_id, 0, 0, '' FROM heads
), nodes AS (
    SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size
    FROM paths GROUP BY path, d
), ended AS (
    SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
    FROM (SELECT *, max(d) OVER (PARTITION BY conv_id) AS longest FROM paths) WHERE d = longest GROUP BY path
), children AS (
    SELECT left(path, 64 * (d - 1)) AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), below AS (
    SELECT left(path, 64 * up) AS path, count(*) FILTER (WHERE n IS NULL) AS leaves,
           sum((n_convs - 1) * size) AS saved
    FROM (SELECT nodes.*, children.n, unnest(range(0, d + 1)) AS up FROM nodes LEFT JOIN children USING (path))
    GROUP BY 1
)
SELECT nodes.conv_id, nodes.d AS depth, parents.conv_id AS parent_conv_id, nodes.n_convs,
       coalesce(children.n, 0) AS n_children, below.leaves AS n_leaves,
       below.saved::BIGINT AS saved_tokens, sha256(coalesce(ended.ids, '')) AS ends_sha256
FROM nodes JOIN below USING (path) LEFT JOIN ended USING (path) LEFT JOIN children USING (path)
LEFT JOIN nodes AS parents ON nodes.d > 0 AND parents.path = left(nodes.path, 64 * (nodes.d - 1))
"""
