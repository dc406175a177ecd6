"""Prefix trie of conversations, built in range shards.

A conversation is a sequence of turns; every distinct sequence of first turns is a node, the empty one
the root.  Turns are identified by 16 bytes of the SHA-256 of role and text (length of the role in
front).  Conversations are range-partitioned and sorted by (sequence, conv_id), so a node's members
follow each other, and copies of one conversation may spread over many shards.

A task works a shard off in blocks of about ``BLOCK_TURNS`` turns.  Inside a block turn ids are
dictionary-encoded as small integers, and the block's distinct sequences enter a ternary search
tree median first, which keeps its low and high links balanced.  An iterative traversal lists the
nodes and adds up members, leaves and savings from the bottom.  Nodes on the way to the block's first or last
sequence may have members in other blocks; all others are finished.  A block passes those
two ways on, each node with what hangs below it inside the block.  The ways of all blocks
are sequences again and enter the same procedure, level by level, until one block holds
them (a level has at most an eighth of the ways of the one before).  Smallest members found there go back down, block by
block, as the parents of nodes below.

Conversation ids that end at a boundary node go aside as sorted runs, one a block, and are hashed
run by run: SHA-256 has one state, so a hot node's runs pass one task, one run in memory at a time.

Turns of one conversation are held together, so memory is bounded by a block or the longest
conversation.  Null role or text is empty; turns go by turn number, null first, equal numbers by turn
id; rows with null conv_id belong to no conversation; repeated rows are turns of their own; an
empty table gives no node; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweather.llm.common import shuffle_partitions, stage, table

BLOCK_TURNS = 200_000
LEAST_SEQUENCES = 16  # of a block
HEAD_EVERY = 100
HEAD_TURNS = 6
NO_ID = np.iinfo(np.int64).max
EMPTY_HASH = hashlib.sha256(b"").hexdigest()

# One row a way: per node from the root on, what hangs there and not on the way's next node.
WAY = (
    "block string, side int, seq array<binary>, chars array<bigint>, n array<bigint>, least array<bigint>,"
    " children array<bigint>, leaves array<bigint>, saved array<bigint>"
)
NODE = (
    "node string, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint,"
    " n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
# kind: node, way, run (of ids that end at a boundary node) or back (where to find a way's smallest members).
OUT = (
    f"kind string, {WAY}, {NODE}, above string, above_side int, above_depth int, first_id bigint, ids string"
)
NAMES = [c.split()[0] for c in OUT.split(", ")]


def turn_sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, seq, chars) of each conversation: its turns' ids and code points, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    t = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.unhex(F.substring(F.sha2(whole, 256), 1, 32)).alias("id"),
            F.length(text).cast("long").alias("chars"),
        ).alias("t"),
    )
    got = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return got.select("conv_id", F.col("t.id").alias("seq"), F.col("t.chars").alias("chars"))


def rebuilt(sequences: DataFrame) -> DataFrame:
    """Each conversation c opens with the first crc32(c) % 6 turns of conversation c - c % 100 instead of its own."""
    first = F.col("conv_id") - F.col("conv_id") % HEAD_EVERY
    h = (F.crc32(F.col("conv_id").cast("string")) % HEAD_TURNS).cast("int")
    heads = sequences.where(F.col("conv_id") % HEAD_EVERY == 0).select(
        F.col("conv_id").alias("head_id"), *(F.slice(c, 1, HEAD_TURNS - 1).alias(f"head_{c}") for c in ("seq", "chars"))
    )
    both = sequences.join(heads, first == F.col("head_id"), "left")

    def joined(c):
        kind = "array<binary>" if c == "seq" else "array<bigint>"
        head = F.coalesce(F.slice(F.col(f"head_{c}"), F.lit(1), h), F.array().cast(kind))
        return F.concat(head, F.slice(F.col(c), h + 1, F.greatest(F.size(c) - h, F.lit(0)))).alias(c)

    return both.select("conv_id", joined("seq"), joined("chars"))


@dataclass
class Tree:
    """Ternary search tree over integer sequences; entry 0 is the root of the trie, which has no key."""

    key: list[int] = field(default_factory=lambda: [-1])
    low: list[int] = field(default_factory=lambda: [0])
    high: list[int] = field(default_factory=lambda: [0])
    down: list[int] = field(default_factory=lambda: [0])
    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])

    def _add(self, key: int, parent: int) -> int:
        self.key.append(key)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        for links in (self.low, self.high, self.down):
            links.append(0)
        return len(self.key) - 1

    def insert(self, seq: list[int]) -> list[int]:
        """Entries on the way of ``seq``, the root first."""
        key, low, high, down = self.key, self.low, self.high, self.down
        way, at = [0], 0
        for k in seq:
            here = down[at]
            if not here:
                here = down[at] = self._add(k, at)
            while key[here] != k:
                side = low if k < key[here] else high
                if not side[here]:
                    side[here] = self._add(k, at)
                here = side[here]
            at = here
            way.append(at)
        return way

    def traverse(self) -> list[int]:
        """All entries, each before those below it, without recursion."""
        order, todo = [0], [self.down[0]]
        while todo:
            at = todo.pop()
            if at:
                order.append(at)
                todo += (self.low[at], self.high[at], self.down[at])
        return order


def median_first(n: int):
    """0 .. n - 1, medians of halves before the halves."""
    todo = [(0, n)]
    while todo:
        a, b = todo.pop()
        if a < b:
            mid = (a + b) // 2
            yield mid
            todo += ((a, mid), (mid + 1, b))


def common(a: list, b: list) -> int:
    """Length of the common prefix."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


class Block:
    """Sorted ways of one block in a tree, with what hangs at each entry added up."""

    def __init__(self, seqs: list[list[bytes]], chars: list[list[int]], parts: list[list[tuple]]):
        """parts[i][d]: (n, least, children, leaves, saved) at depth d of way i."""
        flat = np.frombuffer(b"".join(k for s in seqs for k in s), "S16")
        ids = np.unique(flat, return_inverse=True)[1].tolist() if len(flat) else []
        starts = np.cumsum([0, *map(len, seqs)]).tolist()
        coded = [ids[starts[i] : starts[i + 1]] for i in range(len(seqs))]
        different = [i for i in range(len(coded)) if not i or coded[i] != coded[i - 1]]
        self.tree, entry = Tree(), {}
        for k in median_first(len(different)):
            entry[different[k]] = self.tree.insert(coded[different[k]])
        self.ways, last = [], []
        for i in range(len(coded)):
            last = entry.get(i, last)
            self.ways.append(last)
        size = len(self.tree.key)
        self.n, self.children, self.leaves, self.saved, self.chars = ([0] * size for _ in range(5))
        self.least, self.own_least = [NO_ID] * size, [NO_ID] * size
        self.own = [[0, 0, 0, 0] for _ in range(size)]
        for way, cs, part in zip(self.ways, chars, parts):
            for d, (n, least, children, leaves, saved) in enumerate(part):
                at, own = way[d], self.own[way[d]]
                own[0] += n
                own[1] += children
                own[2] += leaves
                own[3] += saved
                self.own_least[at] = min(self.own_least[at], least)
                if d:
                    self.chars[at] = cs[d - 1]
        self.order = self.tree.traverse()
        for at in reversed(self.order):
            n, children, leaves, saved = self.own[at]
            self.n[at] += n
            self.children[at] += children
            self.leaves[at] = self.leaves[at] + leaves if self.children[at] else 1
            self.saved[at] += saved + max(0, self.n[at] - 1) * self.chars[at]
            self.least[at] = min(self.least[at], self.own_least[at])
            if at:
                up = self.tree.parent[at]
                self.n[up] += self.n[at]
                self.children[up] += 1
                self.leaves[up] += self.leaves[at]
                self.saved[up] += self.saved[at]
                self.least[up] = min(self.least[up], self.least[at])

    def node(self, at: int, name=None, ends=None, known_parent: bool = True) -> dict:
        up = self.tree.parent[at]
        return {
            "kind": "node", "node": name, "conv_id": self.least[at], "depth": self.tree.depth[at], "n_convs": self.n[at],
            "parent_conv_id": self.least[up] if at and known_parent else None, "n_children": self.children[at],
            "n_leaves": self.leaves[at], "saved_tokens": self.saved[at], "ends_sha256": ends,
        }

    def rest(self, way: list[int], boundary: set[int], shared: int) -> list[tuple]:
        """Per entry of the way: its parts without what hangs below a boundary entry; nothing for the first ``shared``."""
        kids = {at: [] for at in way}
        for at in self.order[1:]:
            if self.tree.parent[at] in kids and at in boundary:
                kids[self.tree.parent[at]].append(at)
        out = []
        for d, at in enumerate(way):
            if d < shared:
                out.append((0, None, 0, 0, 0))
                continue
            below = kids[at]
            least = self.own_least[at]
            for child in self.finished.get(at, ()):
                least = min(least, self.least[child])
            hung = self.own[at]
            found = self.finished.get(at, ())
            out.append(
                (
                    self.n[at] - sum(self.n[c] for c in below),
                    None if least == NO_ID else least,
                    self.children[at] - len(below),
                    hung[2] + sum(self.leaves[c] for c in found),
                    hung[3] + sum(self.saved[c] for c in found),
                )
            )
        return out


def path_names(seq: list[bytes]) -> list[str]:
    """A name for every node on the way, by a running digest."""
    state, out = hashlib.sha256(), []
    for k in [b"", *seq]:
        state.update(k)
        out.append(state.copy().hexdigest()[:32])
    return out


def work_block(name: str, seqs, chars, parts, ends, sources, final: bool):
    """Rows of OUT for one block.

    ``ends``: conv_id that ends at way i (bottom level) or None; ``sources``: (block, side) that way i comes from, or None.
    """
    block = Block(seqs, chars, parts)
    tree = block.tree
    edges = [] if final else [block.ways[0], block.ways[-1]]
    boundary = {at for way in edges for at in way}
    block.finished = {}
    for at in block.order[1:]:
        if at not in boundary:
            block.finished.setdefault(tree.parent[at], []).append(at)
    by_end: dict[int, list[int]] = {}
    if ends is not None:
        for way, c in zip(block.ways, ends):
            by_end.setdefault(way[-1], []).append(c)
    names = {}
    if sources is not None or edges:
        for i in range(len(seqs)) if sources is not None else (0, len(seqs) - 1):
            if block.ways[i][-1] not in names:
                names.update(zip(block.ways[i], path_names(seqs[i])))
    side_of = {at: 1 for at in edges[1]} | {at: 0 for at in edges[0]} if edges else {}
    for at in block.order:
        if at in boundary:
            if ids := by_end.get(at):
                yield {"kind": "run", "node": names[at], "first_id": ids[0], "ids": ",".join(map(str, ids))}
            continue
        ended = by_end.get(at, ())
        ends_hash = hashlib.sha256(",".join(map(str, ended)).encode()).hexdigest() if ends is not None else None
        up = tree.parent[at]
        row = block.node(at, names.get(at), ends_hash, up not in boundary)
        if up in boundary:
            row |= {"above": name, "above_side": side_of[up], "above_depth": tree.depth[up]}
        yield row
    for side, way in enumerate(edges):
        i = (0, len(seqs) - 1)[side]
        shared = common(edges[0], edges[1]) if side else 0
        columns = zip(*block.rest(way, boundary, shared))
        yield {"kind": "way", "block": name, "side": side, "seq": seqs[i], "chars": chars[i]} | dict(
            zip(("n", "least", "children", "leaves", "saved"), map(list, columns))
        )
    if sources is not None:
        for way, (source, side) in zip(block.ways, sources):
            upto = [common(way, e) for e in edges] or [0]
            k = int(np.argmax(upto))
            yield {
                "kind": "back", "block": source, "side": side, "least": [block.least[at] for at in way],
                "above": name if edges else None, "above_side": k if edges else None, "above_depth": upto[k],
            }


def _batches(rows):
    """Arrow batches of OUT rows, some thousands each."""
    held = []
    schema = pa.schema([(n, ARROW[n]) for n in NAMES])
    for row in rows:
        held.append(row)
        if len(held) >= 4000:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_TYPES = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "array<binary>": pa.list_(pa.binary()), "array<bigint>": pa.list_(pa.int64())}
ARROW = {n: _TYPES[kind] for n, kind in (c.split() for c in OUT.split(", "))}


def _worker(level: int, final: bool, block_turns: int):
    """mapInArrow function over sorted rows: conversations at level 0, ways above."""

    def work(batches):
        def rows():
            shard = TaskContext.get().partitionId()
            seqs, chars, parts, ends, sources, turns, nth = [], [], [], [], [], 0, 0

            def flush():
                nonlocal turns, nth
                if seqs:
                    name = f"{level}.{shard}.{nth}"
                    yield from work_block(name, seqs, chars, parts, None if level else ends, sources if level else None, final)
                for held in (seqs, chars, parts, ends, sources):
                    held.clear()
                turns, nth = 0, nth + 1

            for batch in batches:
                for row in batch.to_pylist():
                    seqs.append(row["seq"])
                    chars.append(row["chars"])
                    if level:
                        columns = (row[c] for c in ("n", "least", "children", "leaves", "saved"))
                        parts.append([(n, NO_ID if x is None else x, c, v, s) for n, x, c, v, s in zip(*columns)])
                        sources.append((row["block"], row["side"]))
                    else:
                        parts.append([(0, NO_ID, 0, 0, 0)] * len(row["seq"]) + [(1, row["conv_id"], 0, 0, 0)])
                        ends.append(row["conv_id"])
                    turns += len(row["seq"]) + 1
                    if turns >= block_turns and len(seqs) >= LEAST_SEQUENCES and not final:
                        yield from flush()
            yield from flush()

        yield from _batches(rows())

    return work


def _hash_runs(batches):
    """(node, hash) of sorted (node, first_id, ids) rows; a node's runs are read one after the other."""
    node, state = None, None
    for batch in batches:
        done = []
        for name, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if name != node:
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = name, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield pa.RecordBatch.from_pydict({"name": [d[0] for d in done], "hash": [d[1] for d in done]}, _HASHED)
    if node is not None:
        yield pa.RecordBatch.from_pydict({"name": [node], "hash": [state.hexdigest()]}, _HASHED)


_HASHED = pa.schema([("name", pa.string()), ("hash", pa.string())])


def build_trie(sequences: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Columns of NODE (without the name) for every node of the trie of (conv_id, seq, chars) rows."""
    spark = sequences.sparkSession
    shards = shuffle_partitions(spark)
    rows = stage(sequences.select("conv_id", "seq", "chars"), "trie-sequences")
    sized = rows.agg(F.sum(F.size("seq") + 1).alias("turns")).first().turns or 0
    order, columns, levels = ["seq", "conv_id"], ["conv_id", "seq", "chars"], []
    while True:
        final = bool(levels) and (sized <= block_turns or rows.count() <= LEAST_SEQUENCES)
        parts = 1 if final else max(1, min(shards, -(-sized // block_turns)) if levels else shards)
        dealt = rows.select(*columns).repartitionByRange(parts, *order).sortWithinPartitions(*order)
        made = stage(dealt.mapInArrow(_worker(len(levels), final, block_turns), OUT), f"trie-level-{len(levels)}")
        levels.append(made)
        if final:
            break
        order, columns = ["seq", "block", "side"], [c.split()[0] for c in WAY.split(", ")]
        rows = made.where("kind = 'way'").select(*columns)
        sized = rows.agg(F.sum(F.size("seq") + 1).alias("turns")).first().turns or 0
    runs = levels[0].where("kind = 'run'").select("node", "first_id", "ids")
    hashed = runs.repartition(shards, "node").sortWithinPartitions("node", "first_id").mapInArrow(_hash_runs, "name string, hash string")
    out, back = None, None
    plain = [c.split()[0] for c in NODE.split(", ")][1:]
    for k in range(len(levels) - 1, -1, -1):
        nodes = levels[k].where("kind = 'node'")
        if back is not None:
            # The smallest members on the ways of this level's blocks, as the level above knows them.
            ways = back.select(F.col("block").alias("b"), F.col("side").alias("s"), F.col("least").alias("mins"))
            at = (F.col("above") == F.col("b")) & (F.col("above_side") == F.col("s"))
            hung = nodes.where("above IS NOT NULL").join(ways, at).withColumn("parent_conv_id", F.get("mins", F.col("above_depth")))
            nodes = nodes.where("above IS NULL").unionByName(hung.drop("b", "s", "mins"))
        if k:
            ended = nodes.join(hashed, F.col("node") == F.col("name"), "left")
            nodes = ended.withColumn("ends_sha256", F.coalesce("hash", F.lit(EMPTY_HASH)))
        nodes = nodes.select(*plain)
        out = nodes if out is None else out.unionByName(nodes)
        mine = levels[k].where("kind = 'back'").select("block", "side", "least", "above", "above_side", "above_depth")
        if k and back is not None:
            mine = mine.join(ways, at, "left").withColumn(
                "least", F.when(F.col("b").isNull(), F.col("least")).otherwise(
                    F.concat(F.slice("mins", F.lit(1), F.col("above_depth")), F.slice("least", F.col("above_depth") + 1, F.size("least")))
                )
            )
        back = stage(mine.select("block", "side", "least"), f"trie-back-{k}") if k else None
    return out


def query(spark, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return build_trie(rebuilt(turn_sequences(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))))


# crc32 by its polynomial (fixed value), bit by bit over the decimal digits.
ORACLE_SQL = """
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS nth,
           {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, list(t ORDER BY nth) AS turns FROM turns GROUP BY conv_id
), heads AS (
    SELECT conv_id, turns, xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(range(1, length(conv_id::VARCHAR) + 1),
            lambda i: unicode(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
        lambda a, b: list_reduce(list_concat([xor(a, b)], list_transform(range(8), lambda k: 0::BIGINT)),
            lambda x, y: xor(x >> 1, (x & 1) * 3988292384)))) % 6 AS h
    FROM convs
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(list_slice(b.turns, 1, c.h), []), list_slice(c.turns, c.h + 1, len(c.turns))) AS turns
    FROM heads c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 100
), members AS (
    SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt
), prefixed AS (
    SELECT conv_id, depth, list_slice(turns, 1, depth) AS path, len(turns) = depth AS ended FROM members
), nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
    FROM prefixed GROUP BY path, depth
), linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1
               AND list_slice(c.path, 1, n.depth) = n.path) AS n_children,
           CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * length(n.path[n.depth].text) END AS saved
    FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = list_slice(n.path, 1, n.depth - 1)
), below AS (
    SELECT list_slice(path, 1, up) AS path, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
    FROM (SELECT path, saved, n_children, unnest(range(0, depth + 1)) AS up FROM linked) GROUP BY 1
)
SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM linked n JOIN below b ON b.path = n.path
"""
