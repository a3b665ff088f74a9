"""The prefix trie of conversations.

A turn is named by a 128-bit hash of role and text, a conversation by the names of its turns in order. Sorted by these
names, the conversations below any node of the trie are neighbours, and an edge between two neighbours is as deep as
the turns that they share. A union-find takes the edges of a sorted block in descending depth: every component that a
depth merges is a node of the trie, and with it all that is counted below it, since counts are sums over the
conversations and the edges of a component:

* leaves: one more than the edges that are shorter than the conversation on their left;
* children: the edges of the node's own depth whose right side is longer, and the first conversation if it is;
* tokens saved: of every edge the bytes shared, without those above the node.

Components that touch an end of a block are open. A block's forest is contracted to its first conversation, its last
one and one group of what lies between for each depth at which an end can still grow, so its size depends on the depth
of two conversations alone. Contracted blocks are merged across their boundaries in rounds, a bounded number at a time,
by the same function. Nodes that had an open parent learn its name at the end, by a join on block and depth.

A component stands for a chain of nodes, from below the depth at which it is merged to its own; the chains are
expanded by Spark.

Defined results
* Rows without a conv_id belong to no conversation. Turns of one number are ordered by the hash of role and text, so
  repeated rows are turns of their own. NULL role and NULL text are empty.
* Without conversations there is no node, not even the root.
* A conversation travels as 24 bytes a turn. Other columns are never read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import stored, whole_text

# Blocks that are merged at once.
FAN = 32
NAME_BYTES = 16
CHUNK_IDS = 5_000
NO_ENDS = hashlib.sha256(b"").hexdigest()
# Parameters of the regrouping: so many conversations share the first turns of one; less than this many turns of it.
FAMILY, HEADS = 5, 9


def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id and turns, an array of (name, bytes of the text) in the order of turns."""
    role, text = whole_text("role"), whole_text("text")
    name = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", name.alias("name"), F.octet_length(text).alias("bytes")).alias("at")
    )
    turns = F.transform(F.sort_array(F.collect_list("at")), lambda at: F.struct(at["name"].alias("name"), at["bytes"].alias("bytes")))
    return rows.where("conv_id IS NOT NULL").groupBy("conv_id").agg(turns.alias("turns"))


def regrouped(lists: DataFrame) -> DataFrame:
    """Every conversation with its first turns, a number drawn by its id, taken from the first of its family."""
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    heads = lists.select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head"))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("taken")), F.filter("turns", lambda _: F.lit(False)))
    rest = F.slice("turns", F.col("taken") + 1, F.greatest(F.size("turns") - F.col("taken"), F.lit(0)))
    return lists.withColumns({"base": base, "taken": taken}).join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("turns"))


class Part:
    """A run of sorted neighbours. If it is a component (``own``), it is the node at ``depth`` and the chain above."""

    __slots__ = ("n", "least", "leaves", "shared", "first_len", "ends", "own", "depth", "children", "sums")

    def __init__(self, n, least, leaves, shared, first_len, ends, own, depth, children, sums) -> None:
        self.n, self.least, self.leaves, self.shared = n, least, leaves, shared
        self.first_len, self.ends, self.own, self.depth, self.children, self.sums = first_len, ends, own, depth, children, sums

    def row(self) -> list:
        return [getattr(self, field) for field in self.__slots__]


class Edge:
    """Between two neighbours: the turns they share, what it counts, and the names of the nodes it makes."""

    __slots__ = ("depth", "leaves", "children", "shared", "refs")

    def __init__(self, depth, leaves, children, shared, refs=()) -> None:
        self.depth, self.leaves, self.children, self.shared, self.refs = depth, leaves, children, shared, refs

    def row(self) -> list:
        return [getattr(self, field) for field in self.__slots__]


def edge_between(left: bytes, right: bytes, sums: list[int]) -> Edge:
    """``sums``: the bytes of the left conversation's first turns, by their number."""
    import numpy as np

    least = min(len(left), len(right))
    if left[:least] != right[:least]:
        differ = np.frombuffer(left, np.uint8, least) != np.frombuffer(right, np.uint8, least)
        least = int(differ.argmax())
    depth = least // NAME_BYTES
    return Edge(depth, int(depth < len(left) // NAME_BYTES), int(len(right) // NAME_BYTES > depth), sums[depth])


# What a block gives: nodes from depth lo to hi, names of open nodes, ends of conversations, the contracted block.
_LONGS = ("n", "least", "leaves", "shared", "children", "parent", "block", "part")
_TEXTS = ("kind", "ends", "parent_ref", "ref", "body")
OUTPUT = ", ".join(["lo int", "hi int", *(f"{c} long" for c in _LONGS), *(f"{c} string" for c in _TEXTS), "sums array<long>"])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    types = {"lo": pa.int32(), "hi": pa.int32()} | dict.fromkeys(_LONGS, pa.int64()) | dict.fromkeys(_TEXTS, pa.string())
    return pa.RecordBatch.from_pylist(rows, pa.schema(types | {"sums": pa.list_(pa.int64())}))


class Forest:
    """Merges parts along edges and keeps the rows to be returned."""

    def __init__(self) -> None:
        self.rows: list[dict] = []

    def emit(self, part: Part, above: int, parent: int | None = None, ref: str | None = None) -> None:
        """The nodes of a component that is merged at depth ``above``."""
        lo, hi = above + 1, part.depth
        if part.own and lo <= hi:
            sums = [part.sums[max(depth - 1, 0)] for depth in range(lo, hi + 1)] if part.n > 1 else []
            ends = part.ends if part.first_len == hi else NO_ENDS
            self.rows.append({
                "kind": "chain", "lo": lo, "hi": hi, "n": part.n, "least": part.least, "leaves": part.leaves + 1, "shared": part.shared,
                "children": part.children, "ends": ends, "sums": sums, "parent": parent, "parent_ref": ref,
            })

    def name(self, edge: Edge, parent: int | None = None, ref: str | None = None) -> None:
        self.rows.extend({"kind": "ref", "ref": old, "parent": parent, "parent_ref": ref} for old in edge.refs)

    def merged(self, parts: list[Part], edges: list[Edge], inner: list[int]) -> list[Part]:
        """The components that the edges numbered in ``inner`` leave, by union-find in descending depth. Edge k is
        between parts k and k + 1."""
        above = list(range(len(parts)))
        at = dict(enumerate(parts))

        def find(k: int) -> int:
            while above[k] != k:
                above[k] = above[above[k]]
                k = above[k]
            return k

        inner = sorted(inner, key=lambda k: (-edges[k].depth, k))
        for depth, level in itertools.groupby(inner, key=lambda k: edges[k].depth):
            runs: dict[int, tuple[list[Part], list[Edge]]] = {}
            for k in level:
                left, right = find(k), find(k + 1)
                run = runs.setdefault(left, ([at[left]], []))
                run[0].append(at.pop(right))
                run[1].append(edges[k])
                above[right] = left
            for root, (members, joints) in runs.items():
                node = at[root] = together(members, joints)
                node.own, node.depth, node.sums = True, depth, next(part.sums for part in members if part.sums is not None)
                node.children = int(node.first_len > depth) + sum(edge.children for edge in joints)
                for part in members:
                    self.emit(part, depth, parent=node.least)
                for edge in joints:
                    self.name(edge, parent=node.least)
        return [at[k] for k in sorted(at)]

    def contracted(self, parts: list[Part], edges: list[Edge], label: str) -> tuple[list[Part], list[Edge]]:
        """The block without what is complete. Left of the shallowest edges those stay that are shallower than all
        before them, right of them those shallower than all after them: the depths at which an end can still grow."""
        if len(parts) == 1:
            return parts, edges
        shallowest = min(edge.depth for edge in edges)
        lows = [k for k, edge in enumerate(edges) if edge.depth == shallowest]
        left, right = [], []
        for marks, numbers in ((left, range(lows[0] + 1)), (right, range(len(edges) - 1, lows[-1] - 1, -1))):
            for k in numbers:
                if not marks or edges[k].depth < edges[marks[-1]].depth:
                    marks.append(k)
        marks = sorted({*left, *right})
        kept_parts, kept_edges = [parts[0]], [Edge(edges[k].depth, 0, 0, 0, [f"{label}.{k}"]) for k in marks]
        by_mark = dict(zip(marks, kept_edges, strict=True))

        def count(k: int, into: Edge) -> None:
            edge = edges[k]
            into.leaves, into.children, into.shared = into.leaves + edge.leaves, into.children + edge.children, into.shared + edge.shared
            self.name(edge, ref=into.refs[0])

        for k in marks:
            count(k, by_mark[k])
        for start, end in itertools.pairwise(marks):
            # What lies between belongs to the deeper of the two depths, or to both where these are one.
            level = by_mark[start if edges[start].depth >= edges[end].depth else end]
            own = range(start + 1, end)
            for k in own:
                if edges[k].depth == level.depth:
                    count(k, level)
            components = self.merged(parts[start + 1 : end + 1], edges[start + 1 : end], [k - start - 1 for k in own if edges[k].depth > level.depth])
            for part in components:
                self.emit(part, level.depth, ref=level.refs[0])
            kept_parts.append(together(components, []))
        return [*kept_parts, parts[-1]], kept_edges


def together(parts: list[Part], joints: list[Edge]) -> Part:
    """Neighbouring parts as one group."""
    first, counted = parts[0], [*parts, *joints]
    leaves, shared = sum(one.leaves for one in counted), sum(one.shared for one in counted)
    return Part(sum(part.n for part in parts), min(part.least for part in parts), leaves, shared, first.first_len, first.ends, False, 0, 0, None)


def _packed(block: int, first_key: bytes, last_key: bytes, parts: list[Part], edges: list[Edge]) -> dict:
    body = [first_key.hex(), last_key.hex(), [part.row() for part in parts], [edge.row() for edge in edges]]
    return {"kind": "block", "block": block, "body": json.dumps(body)}


def _pages(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    for page in itertools.batched(rows, 10_000):
        yield _batch(list(page))


def sorted_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of one block (block, key, conv_id, sizes), sorted by key and conv_id."""
    ids, keys, parts, edges = [], [], [], []
    forest, block = Forest(), None
    for batch in batches:
        block = batch.column(0)[0].as_py() if batch.num_rows else block
        keys += batch.column(1).to_pylist()
        ids += batch.column(2).to_pylist()
        for sizes in batch.column(3).to_pylist():
            parts.append([0, *itertools.accumulate(sizes)])
    if not ids:
        return
    at = 0
    for key, run in itertools.groupby(keys):
        n = len(list(run))
        whole = at > 0 and at + n < len(ids)
        name = hashlib.md5(key).hexdigest()
        ends = hashlib.sha256(",".join(map(str, ids[at : at + n])).encode()).hexdigest() if whole else f"={name}"
        if not whole:
            for number, chunk in enumerate(itertools.batched(ids[at : at + n], CHUNK_IDS)):
                forest.rows.append({"kind": "ends", "ref": name, "block": block, "part": number, "body": ",".join(map(str, chunk))})
        for k in range(at, at + n):
            depth = len(key) // NAME_BYTES
            parts[k] = Part(1, ids[k], 0, 0, depth, ends, True, depth, 0, parts[k])
        at += n
    edges = [edge_between(keys[k], keys[k + 1], parts[k].sums) for k in range(len(keys) - 1)]
    parts, edges = forest.contracted(parts, edges, f"0.{block}")
    forest.rows.append(_packed(block, keys[0], keys[-1], parts, edges))
    yield from _pages(forest.rows)


def neighbours_merged(step: int, last: bool) -> Callable:
    """Merges neighbouring contracted blocks. In the ``last`` step nothing is beyond their ends."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        forest, group = Forest(), key[0].as_py()
        first_key = last_key = None
        parts: list[Part] = []
        edges: list[Edge] = []
        for row in sorted(table.to_pylist(), key=lambda row: row["block"]):
            first, final, new_parts, new_edges = json.loads(row["body"])
            first, final = bytes.fromhex(first), bytes.fromhex(final)
            if parts:
                edges.append(edge_between(last_key, first, parts[-1].sums))
            else:
                first_key = first
            last_key = final
            parts += [Part(*fields) for fields in new_parts]
            edges += [Edge(*fields) for fields in new_edges]
        if last:
            (root,) = forest.merged(parts, edges, list(range(len(edges))))
            forest.emit(root, -1)
        else:
            parts, edges = forest.contracted(parts, edges, f"{step}.{group}")
            forest.rows.append(_packed(group, first_key, last_key, parts, edges))
        return pa.Table.from_batches(_pages(forest.rows))

    return merge


def end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ref, digest) from chunks of ids (ref, body) that come in their order."""
    schema = pa.schema({"ref": pa.string(), "digest": pa.string()})
    now, digest = None, None
    for batch in batches:
        for ref, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ref == now:
                digest.update(b"," + body.encode())
                continue
            if now is not None:
                yield pa.RecordBatch.from_pylist([{"ref": now, "digest": digest.hexdigest()}], schema)
            now, digest = ref, hashlib.sha256(body.encode())
    if now is not None:
        yield pa.RecordBatch.from_pylist([{"ref": now, "digest": digest.hexdigest()}], schema)


def _looked_up(rows: DataFrame, column: str, known: DataFrame, value: str) -> DataFrame:
    """``value`` replaced by that of ``known`` (ref, found) where ``column`` has a name to look up; the other rows
    take no part in the join."""
    asked = F.col(column).startswith("=") if column == value else F.col(column).isNotNull()
    key = F.expr(f"substr({column}, 2)") if column == value else F.col(column)
    found = rows.where(asked).withColumn("ref", key).join(known, "ref").drop("ref", value).withColumnRenamed("found", value)
    return rows.where(~asked).unionByName(found.select(*rows.columns))


def prefix_trie(lists: DataFrame, fan: int = FAN) -> DataFrame:
    """One row a node of the trie of ``lists`` (conv_id, turns of name and bytes): conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    key = F.unhex(F.array_join(F.transform("turns", lambda turn: turn["name"]), ""))
    sizes = F.transform("turns", lambda turn: turn["bytes"].cast("long"))
    keyed = stored(lists.select("conv_id", key.alias("key"), sizes.alias("sizes")), "trie-keys")
    ranged = keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    blocks = ranged.select(F.spark_partition_id().cast("long").alias("block"), "key", "conv_id", "sizes")
    steps = [stored(blocks.mapInArrow(sorted_block, OUTPUT), "trie-blocks")]
    last = False
    while not last:
        open_blocks = steps[-1].where("kind = 'block'").select("block", "body")
        last = open_blocks.count() <= fan
        group = F.lit(0) if last else F.floor(F.col("block") / fan)
        merge = neighbours_merged(len(steps), last)
        steps.append(stored(open_blocks.groupBy(group.cast("long").alias("group")).applyInArrow(merge, OUTPUT), "trie-blocks"))

    known = None
    for rows in reversed(steps[1:]):
        refs = rows.where("kind = 'ref'").select("ref", F.col("parent").alias("found"), "parent_ref")
        if known is None:
            known = refs.select("ref", "found")
        else:
            later = known.select(F.col("ref").alias("parent_ref"), F.col("found").alias("later"))
            refs = refs.join(later, "parent_ref", "left").select("ref", F.coalesce("found", "later").alias("found"))
            known = known.unionByName(refs)
    chunks = steps[0].where("kind = 'ends'").select("ref", "block", "part", "body").repartition("ref")
    chunks = chunks.sortWithinPartitions("ref", "block", "part").select("ref", "body")
    digests = chunks.mapInArrow(end_digests, "ref string, digest string").withColumnRenamed("digest", "found")

    chains = steps[0]
    for rows in steps[1:]:
        chains = chains.unionByName(rows)
    chains = chains.where("kind = 'chain'").drop("kind", "ref", "block", "part", "body")
    chains = _looked_up(_looked_up(chains, "parent_ref", known, "parent"), "ends", digests, "ends")
    nodes = chains.withColumn("depth", F.explode(F.sequence("lo", "hi")))
    top, bottom = F.col("depth") == F.col("lo"), F.col("depth") == F.col("hi")
    saved = F.col("shared") - (F.col("n") - 1) * F.get("sums", F.col("depth") - F.col("lo"))
    return nodes.select(
        F.col("least").alias("conv_id"),
        F.col("depth").cast("long").alias("depth"),
        F.when(top, F.col("parent")).otherwise(F.col("least")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(bottom, F.col("children")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.when(F.col("n") == 1, F.lit(0)).otherwise(saved).cast("long").alias("saved_tokens"),
        F.when(bottom, F.col("ends")).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"),
    )


TRIE_SQL = f"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, md5(concat(strlen(role), ':', role, text)) AS name, strlen(text) AS bytes
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name) AS pos FROM t
), convs AS (
  SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, c: list_reduce(list_concat([xor(crc, c)], range(8)),
      lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % {HEADS} AS taken
  FROM (SELECT DISTINCT conv_id FROM t)
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, pos, name, bytes FROM convs c JOIN numbered n ON n.conv_id = c.base AND n.pos <= c.taken
  UNION ALL
  SELECT c.conv_id, 1, pos, name, bytes FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND n.pos > c.taken
), members AS (
  SELECT conv_id, row_number() OVER w AS depth, array_to_string(list(name) OVER w, '') AS path, bytes
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM members GROUP BY path, depth
), families AS (
  SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), below AS (
  SELECT left(n.path, 32 * CAST(d AS INT)) AS path, count(*) FILTER (f.path IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM nodes) n LEFT JOIN families f ON f.path = n.path GROUP BY 1
), ends AS (
  SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM members m WHERE depth = (SELECT max(depth) FROM members o WHERE o.conv_id = m.conv_id) GROUP BY path
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(f.n_children, 0) AS n_children, b.n_leaves,
  CAST(b.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM nodes n JOIN below b ON b.path = n.path LEFT JOIN families f ON f.path = n.path LEFT JOIN ends e ON e.path = n.path
  LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, 32 * CAST(n.depth - 1 AS INT))
"""
