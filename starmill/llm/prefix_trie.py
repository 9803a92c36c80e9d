"""Trie of the shared beginnings of conversations.

A prefix of d turns is known by 128 bits: the exclusive or of a hash of each turn with its
place. Distinct conversations, sorted by their prefix hashes, are dealt to tasks by ranges,
so that any number of them may share a beginning. A task builds a z-fast trie: its nodes are
compacted (one per branching or end), each is stored in a hash table under the hash of the
prefix at its handle, the depth of its edge that is divisible by the highest power of two,
and a conversation is placed by a binary search over such depths. At the end edges are
expanded to one node per depth.

Only nodes on the way to a task's first or last conversation can have members in another
task. Tasks hand them over in parts, which are added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.workers import map_arrow
from starmill.sources.scratch import written

# A task's trie holds about this many turns.
TASK_TURNS = 100_000
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def ordered_turns(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv, place, a, b, words): place of each turn from 1, its 128-bit hash, its words.

    Null roles and texts are empty. A null turn comes first; turns of one number are
    ordered by hash, so equal rows are turns of their own. Rows without a conversation take
    no part.
    """
    said = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text)]
    rows = conversations.filter(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("bigint").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.xxhash64(*said).alias("a"),
        F.xxhash64(F.lit(7), *said).alias("b"),
        F.regexp_count(said[1], F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "a", "b")
    return rows.select("conv", F.row_number().over(order).alias("place"), "a", "b", "words")


def with_borrowed_heads(turns: DataFrame, lender: Column, heads: Column, most: int) -> DataFrame:
    """Turns of rebuilt conversations: the first ``heads`` turns of another one, then the
    own turns after as many.

    ``lender`` and ``heads`` (at most ``most``) are expressions on ``conv``. A lender with fewer
    turns lends all, one that does not exist none. A conversation left without turns has
    one row, whose place is 0.
    """
    turns = written(turns, "turns")
    convs = turns.groupBy("conv").agg(F.max("place").alias("n"))
    lent = convs.select(F.col("conv").alias("lender"), F.col("n").alias("n_lender"))
    rules = convs.select("conv", "n", lender.alias("lender"), heads.alias("heads"))
    rules = rules.join(lent, "lender", "left").select(
        "conv", "n", "lender", "heads",
        F.least("heads", F.coalesce("n_lender", F.lit(0))).alias("borrowed"),
    )
    rules = written(rules, "borrowers")
    first = turns.filter(F.col("place") <= most).withColumnRenamed("conv", "lender")
    borrowed = rules.select("conv", "lender", "borrowed").join(first, "lender")
    borrowed = borrowed.filter(F.col("place") <= F.col("borrowed")).select("conv", "place", "a", "b", "words")
    own = turns.join(rules.select("conv", "heads", "borrowed"), "conv").filter(F.col("place") > F.col("heads"))
    own = own.select("conv", (F.col("place") - F.col("heads") + F.col("borrowed")).alias("place"), "a", "b", "words")
    none = rules.filter((F.col("borrowed") == 0) & (F.col("n") <= F.col("heads"))).select(
        "conv", F.lit(0).alias("place"), *[F.lit(0).cast("bigint").alias(c) for c in ("a", "b", "words")]
    )
    return borrowed.unionByName(own).unionByName(none)


def paths(turns: DataFrame) -> DataFrame:
    """(conv, a, b, words): per conversation the prefix hashes of depths 1, 2, ... and the
    words of each turn. A row of place 0 stands for no turn."""
    order = Window.partitionBy("conv").orderBy("place")
    tagged = turns.select(
        "conv", "place", "words",
        F.xxhash64("place", "a", "b").alias("a"),
        F.xxhash64(F.lit(7), "place", "a", "b").alias("b"),
    )
    prefix = tagged.select(
        "conv",
        F.struct(
            "place", F.bit_xor("a").over(order).alias("a"), F.bit_xor("b").over(order).alias("b"), "words"
        ).alias("step"),
    )
    rows = prefix.groupBy("conv").agg(F.sort_array(F.collect_list("step")).alias("steps"))
    steps = F.filter("steps", lambda s: s["place"] > 0)
    return rows.select("conv", steps.alias("steps")).select(
        "conv", *[F.col(f"steps.{c}").alias(c) for c in ("a", "b", "words")]
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (n, a, b, conv) sorted so; per (n, a, b) the smallest conv, their number and the
    SHA-256 of all, comma-joined. Only the state of one digest is held."""
    names = ["n", "a", "b", "conv", "n_convs", "ends"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    key, first, count, digest = None, 0, 0, hashlib.sha256()

    def block(rows):
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        done = []
        for *own, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if own != key:
                if key is not None:
                    done.append((*key, first, count, digest.hexdigest()))
                key, first, count, digest = own, conv, 1, hashlib.sha256(b"%d" % conv)
            else:
                digest.update(b",%d" % conv)
                count += 1
        if done:
            yield block(done)
    if key is not None:
        yield block([(*key, first, count, digest.hexdigest())])


def _distinct_paths(rows: DataFrame) -> DataFrame:
    """One row per distinct path, that of the smallest conversation, with ``n_convs``, ``ends``."""
    ends = rows.select(
        F.size("a").alias("n"),
        *[F.coalesce(F.get(c, F.size(c) - 1), F.lit(0)).alias(c) for c in ("a", "b")],
        "conv",
    )
    grouped = ends.repartition("n", "a", "b").sortWithinPartitions("n", "a", "b", "conv")
    schema = "n int, a bigint, b bigint, conv bigint, n_convs bigint, ends string"
    digests = map_arrow(grouped, _digests, schema).select("conv", "n_convs", "ends")
    return rows.join(written(digests, "ends"), "conv")


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that is divisible by the highest power of two."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """Compacted trie of sequences given by their prefix hashes (``path[d]`` for depth d).

    Node i has the edge of depths ``low[i] + 1`` to ``high[i]``, read off ``path[i]``, and is
    found in ``handles`` under its handle's depth and hash. Node 0 is the root.
    """

    def __init__(self, root):
        self.low, self.high, self.path, self.words = [0], [0], [[root]], [[0]]
        self.parent: list[int] = [-1]
        self.children: list[dict] = [{}]
        self.ending: list[tuple | None] = [None]
        self.handles: dict[tuple, int] = {}

    def _handle(self, node: int) -> tuple:
        depth = two_fattest(self.low[node], self.high[node])
        return depth, self.path[node][depth]

    def exit_node(self, path: list) -> int:
        """Node on whose edge, or at whose end, the path leaves the trie."""
        low, high, node = 0, len(path) - 1, 0
        while low < high:
            depth = two_fattest(low, high)
            found = self.handles.get((depth, path[depth]))
            if found is None:
                high = depth - 1
                continue
            end = self.high[found]
            if end >= len(path) or path[end] != self.path[found][end]:
                return found
            low, node = end, found
        if low + 1 < len(path):
            return self.children[node].get(path[low + 1], node)
        return node

    def _shared(self, node: int, path: list) -> int:
        """Depth to which the path follows the node's edge."""
        own, low = self.path[node], self.low[node]
        high = min(self.high[node], len(path) - 1)
        while low < high:
            middle = (low + high + 1) // 2
            if own[middle] == path[middle]:
                low = middle
            else:
                high = middle - 1
        return low

    def _add(self, low: int, high: int, path: list, words: list, parent: int) -> int:
        node = len(self.low)
        self.low.append(low)
        self.high.append(high)
        self.path.append(path)
        self.words.append(words)
        self.parent.append(parent)
        self.children.append({})
        self.ending.append(None)
        self.children[parent][path[low + 1]] = node
        self.handles[self._handle(node)] = node
        return node

    def insert(self, path: list, words: list, ending: tuple) -> int:
        """Place a sequence that is not in the trie yet; returns the node at its end."""
        node, depth = self.exit_node(path), 0
        if node:
            depth = self._shared(node, path)
            if depth < self.high[node]:
                del self.handles[self._handle(node)]
                upper = self._add(self.low[node], depth, self.path[node], self.words[node], self.parent[node])
                self.low[node], self.parent[node] = depth, upper
                self.children[upper][self.path[node][depth + 1]] = node
                self.handles[self._handle(node)] = node
                node = upper
        if depth < len(path) - 1:
            node = self._add(depth, len(path) - 1, path, words, node)
        self.ending[node] = ending
        return node


_NODE_COLUMNS = [
    ("route", pa.int64()), ("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()),
    ("parent_a", pa.int64()), ("parent_b", pa.int64()), ("next_a", pa.int64()), ("next_b", pa.int64()),
    ("conv", pa.int64()), ("parent_conv", pa.int64()), ("n_convs", pa.int64()), ("words", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string()),
]
_NODE_SCHEMA = ", ".join(f"{n} {'string' if n == 'ends' else 'bigint'}" for n, _ in _NODE_COLUMNS)


def _expanded(trie: ZFastTrie, first: int, last: int, task: int) -> Iterator[tuple]:
    """One row per node and depth. Rows with a ``route`` are parts of nodes that other tasks
    may have, too: those above the task's first and last sequence, whose sums leave out the
    nodes on these two routes."""
    size = len(trie.low)
    count, leaves, saved, children, shared = ([0] * size for _ in range(5))
    routes = []
    for end in dict.fromkeys((first, last)):
        route = []
        while end >= 0:
            route.append(end)
            shared[end] = 1
            end = trie.parent[end]
        routes.append(route[::-1])
    conv = [None] * size
    for node in sorted(range(size), key=lambda i: -trie.high[i]):
        if trie.ending[node]:
            own, number, _ = trie.ending[node]
            conv[node] = own if conv[node] is None else min(own, conv[node])
            count[node] += number
        if not shared[node]:
            if not trie.children[node]:
                leaves[node] = 1
            words = sum(trie.words[node][trie.low[node] + 1 : trie.high[node] + 1])
            edge = saved[node] + (count[node] - 1) * words
        else:
            edge = saved[node]
        up = trie.parent[node]
        if up >= 0:
            conv[up] = conv[node] if conv[up] is None else min(conv[up], conv[node])
            count[up] += count[node]
            leaves[up] += leaves[node]
            saved[up] += edge
            children[up] += not shared[node]

    def ends(node: int, depth: int):
        here = depth == trie.high[node] and trie.ending[node]
        return trie.ending[node][2] if here else None

    for node in range(size):
        if shared[node]:
            continue
        path, words, below = trie.path[node], trie.words[node], saved[node]
        for depth in range(trie.high[node], trie.low[node], -1):
            below += (count[node] - 1) * words[depth]
            up, above = path[depth - 1], conv[node]
            if depth == trie.low[node] + 1:
                above = None if shared[trie.parent[node]] else conv[trie.parent[node]]
            yield (
                None, depth, *path[depth], *(up if above is None else (None, None)), None, None,
                conv[node], above, count[node], words[depth],
                children[node] if depth == trie.high[node] else 1, leaves[node], below, ends(node, depth),
            )
    told: set[int] = set()
    for number, route in enumerate(routes):
        path = trie.path[route[-1]]
        for node in route:
            again = node in told
            told.add(node)
            for depth in range(trie.low[node] + (node > 0), trie.high[node] + 1):
                after = path[depth + 1] if depth + 1 <= trie.high[route[-1]] else (None, None)
                yield (
                    2 * task + number, depth, *path[depth], *(path[depth - 1] if depth else (None, None)), *after,
                    None if again else conv[node], None, 0 if again else count[node], trie.words[node][depth],
                    children[node] if depth == trie.high[node] and not again else 0,
                    0 if again else leaves[node], 0 if again else saved[node], ends(node, depth),
                )


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of a task's sorted distinct paths (conv, n_convs, ends, a, b, words)."""
    root = (0, 0)
    trie, first, last = ZFastTrie(root), None, 0
    for batch in batches:
        for conv, number, ends, a, b, words in zip(*(c.to_pylist() for c in batch.columns)):
            last = trie.insert([root, *zip(a, b)], [0, *words], (conv, number, ends))
            first = last if first is None else first
    if first is None:
        return
    rows: list[tuple] = []

    def block() -> pa.RecordBatch:
        arrays = [pa.array(c, k) for c, (_, k) in zip(zip(*rows), _NODE_COLUMNS)]
        return pa.record_batch(arrays, names=[n for n, _ in _NODE_COLUMNS])

    for row in _expanded(trie, first, last, TaskContext.get().partitionId()):
        rows.append(row)
        if len(rows) == 10_000:
            yield block()
            rows = []
    if rows:
        yield block()


_KEY = ["depth", "a", "b"]


def _merged(parts: DataFrame) -> DataFrame:
    """Nodes that several tasks know: their parts added up, then their own leaves and savings
    added along the routes. Each is counted on one route, the smallest that it lies on. There
    are two routes a task."""
    nodes = parts.groupBy(*_KEY).agg(
        F.min("route").alias("owner"),
        *[F.min(c).alias(c) for c in ("parent_a", "parent_b", "conv")],
        F.sum("n_convs").alias("n_convs"),
        (F.sum("n_children") + F.count_distinct("next_a", "next_b")).alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved").alias("saved"),
        F.max("words").alias("words"),
        F.max("ends").alias("ends"),
    )
    nodes = written(nodes, "route-nodes")
    own = nodes.select(
        *_KEY, "owner",
        (F.col("n_children") == 0).cast("bigint").alias("own_leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("own_saved"),
    )
    steps = parts.select("route", *_KEY).join(own, _KEY)
    below = Window.partitionBy("route").orderBy(F.col("depth").desc())
    owned = F.col("owner") == F.col("route")
    sums = steps.select(
        *_KEY,
        *[F.sum(F.when(owned, F.col(c)).otherwise(0)).over(below).alias(c) for c in ("own_leaf", "own_saved")],
    )
    sums = sums.groupBy(*_KEY).agg(F.sum("own_leaf").alias("own_leaf"), F.sum("own_saved").alias("own_saved"))
    return nodes.join(sums, _KEY).select(
        *_KEY, "parent_a", "parent_b", "conv", "n_convs", "n_children",
        (F.col("n_leaves") + F.col("own_leaf")).alias("n_leaves"),
        (F.col("saved") + F.col("own_saved")).alias("saved"),
        "ends",
    )


def prefix_nodes(turns: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations in ``turns`` (conv, place, a, b, words).

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    A node is named by its smallest member. Equal conversations are members alike. Without
    conversations there are no nodes. A conversation's hashes (24 bytes a turn) travel as
    one row, and the ids that end at one node stream through one task, as a digest demands.
    """
    distinct = written(_distinct_paths(written(paths(turns), "paths")), "distinct-paths")
    total = distinct.agg(F.sum(F.size("a") + 1)).first()[0] or 0
    tasks = max(1, -(-int(total) // TASK_TURNS))
    steps = F.arrays_zip("a", "b")
    ranges = distinct.repartitionByRange(tasks, steps).sortWithinPartitions(steps)
    wanted = ranges.select("conv", "n_convs", "ends", "a", "b", "words")
    nodes = written(map_arrow(wanted, _build, _NODE_SCHEMA), "nodes")
    shared = written(_merged(nodes.filter("route IS NOT NULL")), "shared-nodes")
    columns = ["depth", "conv", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    inner = nodes.filter("route IS NULL")
    known = inner.filter("parent_a IS NULL").select(*columns)
    open_ = inner.filter("parent_a IS NOT NULL").select("depth", "parent_a", "parent_b", *columns[1:2], *columns[3:])
    open_ = open_.unionByName(shared.select(*open_.columns))
    above = shared.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("parent_a"), F.col("b").alias("parent_b"),
        F.col("conv").alias("parent_conv"),
    )
    found = open_.join(above, ["depth", "parent_a", "parent_b"], "left").select(*columns)
    return known.unionByName(found).select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
