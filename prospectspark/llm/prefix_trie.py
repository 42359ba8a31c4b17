"""Prefix trie of conversations: which first turns conversations share, and how much text that saves.

Conversations are sorted by their turns; the longest common prefixes of sorted neighbours are the edges.  Union-find over the edges in descending
depth merges neighbouring stretches: each merge creates the branching node at that depth, and the turns between two merges are its unary path.

Every task does so for its stretch of the sorted conversations.  A node that holds neither the first nor the last conversation of the stretch is
finished there.  What is left, the paths of those two conversations with the sums of what hangs on them, is the contracted forest of the task: two
paths whatever the number of its rows.  The contracted forests are merged across the boundaries by the same union-find over the paths; the finished
nodes next to them then learn who their parent is.

Memory: a task holds the digests of its stretch; the merge holds two paths for each task.  A conversation is one row (32 bytes a turn), sorted by its
conv_id after its turns, so that copies are dealt over tasks.  The ids of those that end at a node stay rows (``ends``): no group is collected.

Edge cases: null role and text are empty; turns without a number come first, and turns of one number in the order of their digests; rows that repeat
a turn are turns of their own; rows without conv_id belong to no conversation; a conversation may have no turns left; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, shuffle_partitions, stored
from .variants import CRC_OF, CRC_SQL

NODE = "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long"
#: Of a task: finished nodes (kind 0), ids that end at a node (1), nodes of the paths that go on (2).  path: 0 of the first, 1 of the last conversation.
#: A finished node under a path, and ends of a node on one, name it by path and depth.
PART = NODE + ", kind int, task int, path int, ends array<long>, turns array<binary>, sizes array<int>"


class Path:
    """What a task knows of the nodes of one path, by depth: conversations, the smallest, finished children, their leaves, what they save."""

    def __init__(self, turns: list[bytes], sizes: list[int]):
        n = len(turns) + 1
        self.turns, self.sizes = turns, sizes
        self.n, self.least, self.children, self.leaves, self.saved = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n


class Stretch:
    """Neighbouring conversations that share a node: the first and last of them, and what is known of the node."""

    __slots__ = ("first", "last", "head", "n", "least", "children", "leaves", "saved", "tops", "ends", "sums")

    def __init__(self, i: int, depth: int):
        self.first = self.last = i
        self.head = depth
        self.n, self.least = 0, None
        self.children = self.leaves = self.saved = 0
        self.tops: list[int] = []  # finished nodes whose parent is this one
        self.ends: list[int] = []
        self.sums: Path | None = None


def common(a: list[bytes], b: list[bytes]) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def merged(turns: list[list[bytes]], stretches: list[Stretch], close) -> Stretch:
    """Union-find over the edges between neighbours, deepest first.  close(stretch, depth): make the nodes down to depth + 1 known, go on at depth."""
    edges = [common(a, b) for a, b in zip(turns[:-1], turns[1:], strict=True)]
    owner = list(range(len(turns)))

    def find(i: int) -> int:
        while owner[i] != i:
            owner[i] = owner[owner[i]]
            i = owner[i]
        return i

    for i in sorted(range(len(edges)), key=lambda i: -edges[i]):
        a, b = stretches[find(i)], stretches[find(i + 1)]
        for s in (a, b):
            close(s, edges[i])
        owner[find(i + 1)] = find(i)
        a.last = b.last
        a.n += b.n
        a.least = b.least if a.least is None else a.least if b.least is None else min(a.least, b.least)
        a.children, a.leaves, a.saved = a.children + b.children, a.leaves + b.leaves, a.saved + b.saved
        a.tops += b.tops
        a.ends += b.ends
        if b.sums:
            upto = edges[i] + 1
            for name in ("n", "children", "leaves", "saved"):
                x, y = getattr(a.sums, name), getattr(b.sums, name)
                x[:upto] = [p + q for p, q in zip(x[:upto], y[:upto], strict=True)]
            a.sums.least[:upto] = [q if p is None else p if q is None else min(p, q) for p, q in zip(a.sums.least[:upto], b.sums.least[:upto], strict=True)]
    root = stretches[find(0)]
    close(root, 0)
    return root


def task_forest(ids: list[int], turns: list[list[bytes]], sizes: list[list[int]]) -> tuple[list[list], list[tuple], list[Path]]:
    """Nodes, ends and the two paths of sorted conversations.

    Nodes: [conv_id, depth, parent or None, n_convs, n_children, n_leaves, saved, path or None of the parent].  Ends: (path or None, conv_id of the
    node or None, depth, ids).
    """
    count = len(ids)
    paths = [Path(turns[0], sizes[0]), Path(turns[-1], sizes[-1])]
    nodes: list[list] = []
    ends: list[tuple] = []

    def close(s: Stretch, depth: int) -> None:
        on = 0 if s.first == 0 else 1 if s.last == count - 1 else None
        while s.head > depth:
            known(s, on)
            s.head -= 1

    def known(s: Stretch, on: int | None) -> None:
        d = s.head
        if s.ends:
            ends.append((on, s.least, d, s.ends))
        for i in s.tops:
            nodes[i][2], nodes[i][7] = (s.least, None) if on is None else (None, on)
        s.ends, s.tops = [], []
        if on is None:
            leaves = s.leaves or 1
            saved = s.saved + (s.n - 1) * sizes[s.first][d - 1]
            s.tops = [len(nodes)]
            nodes.append([s.least, d, None, s.n, s.children, leaves, saved, None])
            s.children, s.leaves, s.saved = 1, leaves, saved
        else:
            p = paths[on]
            p.n[d], p.least[d], p.children[d], p.leaves[d], p.saved[d] = s.n, s.least, s.children, s.leaves, s.saved
            s.children = s.leaves = s.saved = 0

    stretches = []
    for i, c in enumerate(ids):
        s = Stretch(i, len(turns[i]))
        s.n, s.least, s.ends = 1, c, [c]
        stretches.append(s)
    root = merged(turns, stretches, close)
    known(root, 0)
    return nodes, ends, paths


def merged_paths(paths: list[Path]) -> tuple[list[list], list[list[int | None]]]:
    """The nodes of all tasks' paths, in sorted order; and of each path, by depth, the smallest conversation of the whole node."""
    nodes: list[list] = []
    whole: list[list[int | None]] = [[None] * (len(p.turns) + 1) for p in paths]

    def close(s: Stretch, depth: int) -> None:
        while s.head > depth:
            known(s)
            s.head -= 1

    def known(s: Stretch) -> None:
        d, p = s.head, s.sums
        least = p.least[d]
        for i in s.tops:
            nodes[i][2] = least
        children = p.children[d] + s.children
        leaves = p.leaves[d] + s.leaves if children else 1
        saved = p.saved[d] + s.saved + ((p.n[d] - 1) * p.sizes[d - 1] if d else 0)
        s.tops = [len(nodes)]
        nodes.append([least, d, None, p.n[d], children, leaves, saved])
        for i in range(s.first, s.last + 1):
            whole[i][d] = least
        s.children, s.leaves, s.saved = 1, leaves, saved

    stretches = []
    for i, p in enumerate(paths):
        s = Stretch(i, len(p.turns))
        s.sums = p
        stretches.append(s)
    root = merged([p.turns for p in paths], stretches, close)
    known(root)
    return nodes, whole


# --- conversations ---------------------------------------------------------------------------------------------------


def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: array of (digest of role and text, code points of the text), by turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.filter("conv_id is not null").select("conv_id", F.struct(F.col("turn").cast("long").alias("turn"), F.unhex(digest).alias("digest"), F.length(text).alias("size")).alias("t"))
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return lists.select("conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))


def with_shared_heads(lists: DataFrame, every: int, longest: int) -> DataFrame:
    """Conversation c gets the first h turns of conversation c - c % every in place of its own first h; h is the CRC-32 of c's digits modulo ``longest``."""
    base = lists.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("__base"), F.slice("turns", 1, longest - 1).alias("__head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest).cast("int")
    own = lists.withColumn("__of", F.col("conv_id") - F.col("conv_id") % every)
    joined = own.join(base, F.col("__of") == F.col("__base"), "left")
    none: Column = F.slice("turns", 1, 0)
    head = F.slice(F.coalesce("__head", none), F.lit(1), h)
    tail = F.slice("turns", h + 1, F.size("turns"))
    return joined.select("conv_id", F.concat(head, F.when(F.size("turns") > h, tail).otherwise(none)).alias("turns"))


# --- the trie --------------------------------------------------------------------------------------------------------


def prefix_trie(lists: DataFrame, tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes and ends.  Nodes: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved (code points of all repeated
    turns in the subtree).  Ends: conv_id, depth, task, ids: conversations that end at the node, ascending in each task and from task to task.

    lists: conv_id, turns (digest, size).
    """
    tasks = tasks or shuffle_partitions(lists.sparkSession)
    rows = lists.select(F.transform("turns", lambda t: t["digest"]).alias("turns"), F.transform("turns", lambda t: t["size"]).alias("sizes"), "conv_id")
    dealt = stored(rows, "conversations").repartitionByRange(tasks, "turns", "conv_id").sortWithinPartitions("turns", "conv_id").withColumn("task", F.spark_partition_id())
    parts = stored(dealt.mapInArrow(forests, PART), "forests")
    paths = parts.filter("kind = 2").select("task", "path", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved", "turns", "sizes")
    # two paths a task, whatever it held: one task can merge them
    top = stored(paths.repartition(1).sortWithinPartitions("task", "path", "depth").mapInArrow(merge, NODE + ", task int, path int"), "paths")
    nodes = parts.filter("kind = 0")
    names = top.filter("task is not null").select(F.col("conv_id").alias("__conv"), F.col("depth").alias("__depth"), F.col("task").alias("__task"), F.col("path").alias("__path"))
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved"]
    under = (F.col("task") == F.col("__task")) & (F.col("path") == F.col("__path"))
    hung = nodes.filter("path is not null").join(names, under & (F.col("depth") - 1 == F.col("__depth"))).withColumn("parent_conv_id", F.col("__conv"))
    out = [df.select(*columns[:2], "parent_conv_id", *columns[2:]) for df in (nodes.filter("path is null"), hung, top.filter("task is null"))]
    ends = parts.filter("kind = 1").select("conv_id", "depth", "task", "path", F.col("ends").alias("ids"))
    on_path = ends.filter("path is not null").drop("conv_id").join(names, under & (F.col("depth") == F.col("__depth"))).withColumn("conv_id", F.col("__conv"))
    ends = ends.filter("path is null").drop("path").unionByName(on_path.select("conv_id", "depth", "task", "ids"))
    return out[0].unionByName(out[1]).unionByName(out[2]), ends


def batch_of(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(rows), 10_000):
        part = rows[a : a + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*part, strict=True), schema.types, strict=True)], schema=schema)


NODE_TYPES = [("conv_id", pa.int64()), ("depth", pa.int32()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64())]


def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([*NODE_TYPES, ("kind", pa.int32()), ("task", pa.int32()), ("path", pa.int32()), ("ends", pa.list_(pa.int64())), ("turns", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int32()))])
    ids: list[int] = []
    turns: list[list[bytes]] = []
    sizes: list[list[int]] = []
    task = 0
    for batch in batches:
        if batch.num_rows:
            task = batch.column("task")[0].as_py()
            ids += batch.column("conv_id").to_pylist()
            turns += batch.column("turns").to_pylist()
            sizes += batch.column("sizes").to_pylist()
    if not ids:
        return
    nodes, ends, paths = task_forest(ids, turns, sizes)
    rows = [(c, d, up, n, k, leaves, saved, 0, task, on, None, None, None) for c, d, up, n, k, leaves, saved, on in nodes]
    rows += [(c if on is None else None, d, None, None, None, None, None, 1, task, on, e, None, None) for on, c, d, e in ends]
    for on, p in enumerate(paths):
        # the turn that leads to each depth, so that long paths are many small rows
        rows += [(p.least[d], d, None, p.n[d], p.children[d], p.leaves[d], p.saved[d], 2, task, on, None, p.turns[d - 1 : d] if d else [], p.sizes[d - 1 : d] if d else []) for d in range(len(p.turns) + 1)]
    yield from batch_of(rows, schema)


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes on the paths of all tasks (task is null), and for each depth of each path the smallest conversation of its node."""
    paths: list[Path] = []
    names: list[tuple[int, int]] = []
    for batch in batches:
        for r in batch.to_pylist():
            if not r["depth"]:
                names.append((r["task"], r["path"]))
                paths.append(Path([], []))
            else:
                paths[-1].turns += r["turns"]
                paths[-1].sizes += r["sizes"]
            p = paths[-1]
            if r["depth"]:
                for x in (p.n, p.least, p.children, p.leaves, p.saved):
                    x.append(None)
            p.n[-1], p.least[-1], p.children[-1], p.leaves[-1], p.saved[-1] = r["n_convs"], r["conv_id"], r["n_children"], r["n_leaves"], r["saved"]
    if not paths:
        return
    nodes, whole = merged_paths(paths)
    schema = pa.schema([*NODE_TYPES, ("task", pa.int32()), ("path", pa.int32())])
    yield from batch_of([(*node, None, None) for node in nodes], schema)
    yield from batch_of([(c, d, None, None, None, None, None, *name) for name, row in zip(names, whole, strict=True) for d, c in enumerate(row)], schema)


def hashed_ends(ends: DataFrame, tasks: int) -> DataFrame:
    """conv_id, depth, ends_sha256: the digest of the comma-joined ids of each node, taken piece by piece in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int32()), ("ends_sha256", pa.string())])
        node, digest = None, hashlib.sha256()
        for batch in batches:
            done = []
            for c, d, ids in zip(batch.column("conv_id").to_pylist(), batch.column("depth").to_pylist(), batch.column("ids"), strict=True):
                text = ",".join(map(str, ids.as_py())).encode()
                if node == (c, d):
                    digest.update(b"," + text)
                    continue
                if node:
                    done.append((*node, digest.hexdigest()))
                node, digest = (c, d), hashlib.sha256(text)
            yield from batch_of(done, schema)
        if node:
            yield from batch_of([(*node, digest.hexdigest())], schema)

    dealt = ends.repartition(tasks, "conv_id", "depth").sortWithinPartitions("conv_id", "depth", "task").select("conv_id", "depth", "ids")
    return dealt.mapInArrow(run, "conv_id long, depth int, ends_sha256 string")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = with_shared_heads(turn_lists(read_table(spark, sf_dir, "conversations")), every=100, longest=6)
    nodes, ends = prefix_trie(lists)
    digests = hashed_ends(ends, shuffle_partitions(spark)).select(F.col("conv_id").alias("__conv"), F.col("depth").alias("__depth"), "ends_sha256")
    joined = nodes.join(digests, (F.col("conv_id") == F.col("__conv")) & (F.col("depth") == F.col("__depth")), "left")
    return joined.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


OP12_SQL = (
    "with "
    + CRC_SQL
    + r""",
t as (select conv_id, turn, sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as g, length(coalesce(text, '')) as size from conversations where conv_id is not null),
own as (select conv_id, list(struct_pack(g := g, size := size) order by turn nulls first, g) as ts from t group by conv_id),
crc as (select conv_id, ts, (select """
    + CRC_OF.replace("ts[", "tab[")
    + r""" from (select list_transform(range(1, length(conv_id::varchar) + 1), lambda i: ascii(substr(conv_id::varchar, i, 1))::bigint) as x) q, (select ts as tab from crc_table) k) % 6 as h from own),
made as (select crc.conv_id, list_concat(coalesce(own.ts[1 : h::bigint], []), crc.ts[h::bigint + 1 :]) as ts from crc left join own on own.conv_id = crc.conv_id - crc.conv_id % 100),
keyed as (select conv_id, list_transform(ts, lambda x: x.g) as gs, list_transform(ts, lambda x: x.size) as sizes from made),
m as (select conv_id, d, gs[1 : d] as p, len(gs) as n, case when d > 0 then sizes[d] end as size from (select *, unnest(range(0, len(gs) + 1)) as d from keyed)),
node as (select p, d, min(conv_id) as conv_id, count(*) as n_convs, any_value(size) as size, string_agg(conv_id::varchar, ',' order by conv_id) filter (n = d) as ends from m group by p, d),
kids as (select p[1 : d - 1] as p, d - 1 as d, count(*) as k from node where d > 0 group by 1, 2),
full_node as (select node.*, coalesce(k, 0) as k from node left join kids using (p, d)),
sums as (select a.p, a.d, sum(case when b.k = 0 then 1 else 0 end) as leaves, sum((b.n_convs - 1) * coalesce(b.size, 0)) as saved from full_node b, lateral (select b.p[1 : i] as p, i as d from range(0, b.d + 1) as r(i)) a group by 1, 2)
select f.conv_id, f.d::bigint as depth, up.conv_id as parent_conv_id, f.n_convs::bigint as n_convs, f.k::bigint as n_children, leaves::bigint as n_leaves, saved::bigint as saved_tokens, sha256(coalesce(f.ends, '')) as ends_sha256
from full_node f join sums using (p, d) left join node up on f.d > 0 and up.d = f.d - 1 and up.p = f.p[1 : f.d - 1]
"""
)
