"""MinHash near-duplicates by an inverted join of signature coordinates.

A document's set are its distinct word shingles; equal sets are one node, named by their smallest doc_id.  A signature has
``COORDINATES`` min-hashes.  Nodes are posted under (coordinate, value) for the first ``POSTED``
coordinates.  Two sets with the least similarity agree on at least ``POSTED_MATCHES`` of
them and on ``MATCHES`` of all coordinates, but for about one pair in 180,000.

* Prefix merging: values are ordered by the length of their lists, shortest first.  Two nodes
  that agree on POSTED_MATCHES coordinates meet in the first
  POSTED - POSTED_MATCHES + 1 values of both, so only those are posted.
* Skip merging: the rest of the values is not merged; whether a pair that met reaches
  the match threshold is counted on the signatures, one byte of each coordinate.

Long lists (a group of thousands of copies) are not expanded into pairs:

1. each list names its most typical member (the one whose values have the longest lists) as
   hub; each node is compared with its best hub only, and components are formed;
2. lists whose members are in one component are done.  In the others, members outside the list's
   largest component are compared with all members, in blocks of about ``BLOCK`` by numpy; a block's
   texts are brought together once to confirm its pairs, and its links join the components.

A pair between components is only skipped once its ends are connected, so no component is
lost.  All links are confirmed on the full sets.

Null or wordless text has an empty set and is linked with nothing.  Rows with null doc_id
are not linked; their component is null and they are kept.  Repeated rows share node and
component; a doc_id that stands for several texts has a node for each of their sets.  Very long texts are read
whole; a block's texts are held together, so memory is bounded by ``BLOCK`` texts of a list.  An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweather.llm.common import stage, table, text_or_empty, tidy
from geoweather.llm.components import components
from geoweather.llm.texts import MIX, scramble, text_groups, word_hashes

COORDINATES, MATCHES = 128, 80
POSTED, POSTED_MATCHES = 64, 36
PREFIX = POSTED - POSTED_MATCHES + 1
PERCENT = 80
BLOCK = 256
BROADCAST_IDS = 1_000_000
GROUP_CHARS = 1_000_000
_SEEDS = np.random.default_rng(20).integers(0, 1 << 63, size=(2, COORDINATES), dtype=np.uint64)
_FACTOR, _SALT = _SEEDS[0] * np.uint64(2) + np.uint64(1), _SEEDS[1]

# Nodes of further texts of one doc_id lie below all doc_ids (which are taken to be above this bound).
FURTHER = -(1 << 62)

SKETCH = "doc_id bigint, text_key bigint, n_shingles bigint, digest string, posted array<bigint>, sketch binary"


def shingle_sets(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one text behind the other, and the size of each set."""
    hashes, lengths = word_hashes(texts)
    ends = np.cumsum(lengths)
    n = len(hashes)
    doc = np.repeat(np.arange(len(texts)), lengths)
    whole = np.minimum(lengths, width)  # a text of fewer words is one shingle
    room = (ends[doc] - np.arange(n)) if n else np.zeros(0, np.int64)
    starts = np.nonzero(room >= whole[doc])[0]
    h = np.zeros(len(starts), np.uint64)
    for k in range(width):
        at = starts + k
        inside = k < whole[doc[starts]]
        h = np.where(inside, scramble(h * MIX[0] + hashes[np.minimum(at, max(n - 1, 0))] + np.uint64(k + 1)), h)
    order = np.lexsort((h, doc[starts]))
    h, owner = h[order], doc[starts][order]
    fresh = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])][: len(h)]
    return h[fresh], np.bincount(owner[fresh], minlength=len(texts))


def signatures(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(non-empty sets, COORDINATES) min-hashes, scrambled so that any byte of them is uniform."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    out = np.empty((len(starts), COORDINATES), np.uint64)
    for k in range(COORDINATES if len(starts) else 0):
        out[:, k] = np.minimum.reduceat((shingles ^ _SALT[k]) * _FACTOR[k], starts)
    return scramble(out + np.arange(COORDINATES, dtype=np.uint64))


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """Set size, digest of the set, posted values and one byte of each coordinate (columns of SKETCH)."""

    def work(batches):
        names = [x.split()[0] for x in SKETCH.split(", ")]
        for batch in batches:
            for a, b, texts in text_groups(batch.column(2), GROUP_CHARS):
                shingles, sizes = shingle_sets(texts, width)
                sigs = signatures(shingles, sizes)
                ends, row = np.cumsum(sizes), 0
                digests, posted, bytes_ = [], [], []
                for size, end in zip(sizes.tolist(), ends.tolist(), strict=True):
                    if size:
                        digests.append(hashlib.blake2b(shingles[end - size : end].tobytes(), digest_size=16).hexdigest())
                        posted.append(sigs[row, :POSTED].view(np.int64))
                        bytes_.append(sigs[row].astype(np.uint8).tobytes())
                        row += 1
                    else:
                        digests.append(None)
                        posted.append(None)
                        bytes_.append(None)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(a, b - a) for i in (0, 1)),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests, pa.string()),
                        pa.array(posted, pa.list_(pa.int64())),
                        pa.array(bytes_, pa.binary()),
                    ],
                    names=names,
                )

    return docs.select(F.col("doc_id").cast("long"), text_key(), text_or_empty().alias("text")).mapInArrow(tidy(work), SKETCH)


def text_key():
    """Tells the texts of one doc_id apart."""
    return F.xxhash64(text_or_empty()).alias("text_key")


def postings(nodes: DataFrame) -> DataFrame:
    """(key, node, weight): each node under its PREFIX rarest values, lists of one left out.

    ``weight`` is the node's typicality: the sum of the logarithms of its lists' lengths.
    """
    all_keys = nodes.select("node", F.explode("posted").alias("key"))
    shared = all_keys.groupBy("key").agg(F.count("*").alias("length")).where("length > 1")
    listed = all_keys.join(shared, "key")
    of_node = listed.groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("length", "key"))).alias("keys"), F.sum(F.log("length")).alias("weight")
    )
    # Values that no other node has come first in the order and use up the prefix.
    room = F.greatest(F.lit(0), PREFIX - (POSTED - F.size("keys")))
    prefix = of_node.select("node", "weight", F.explode(F.slice("keys", F.lit(1), room)).alias("k"))
    prefix = stage(prefix.select("node", "weight", F.col("k.key").alias("key")), "dup-prefix")
    several = prefix.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("several"))
    return prefix.join(several, F.col("key") == F.col("several"), "left_semi")


def agreeing(a: str, b: str):
    """Number of equal bytes of two sketches, in SQL functions."""
    return F.expr(f"aggregate(sequence(1, {COORDINATES}), 0, (n, i) -> n + IF(substr({a}, i, 1) = substr({b}, i, 1), 1, 0))")


def similar_sizes(a, b):
    return (100 * F.least(a, b)) >= (PERCENT * F.greatest(a, b))


def best_hubs(posted: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): each node with the hub, of those of its lists, that agrees with it most, if often enough."""
    hubs = posted.groupBy("key").agg(F.max(F.struct("weight", (-F.col("node")).alias("minus")))["minus"].alias("minus"))
    pairs = posted.join(hubs, "key").select(F.col("node").alias("a"), (-F.col("minus")).alias("b")).where("a <> b").distinct()
    left = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sa"), F.col("n_shingles").alias("na"))
    right = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sb"), F.col("n_shingles").alias("nb"))
    met = pairs.join(left, "a").join(right, "b").where(similar_sizes(F.col("na"), F.col("nb")))
    met = met.select("a", "b", agreeing("sa", "sb").alias("n")).where(F.col("n") >= MATCHES)
    best = met.groupBy("a").agg(F.max(F.struct("n", (-F.col("b")).alias("minus")))["minus"].alias("minus"))
    return best.select("a", (-F.col("minus")).alias("b"))


def texts_of(wanted: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(doc, text) of the nodes in ``wanted`` (column doc), from the row that stands for each node's set."""
    rows = sets.select(F.col("node").alias("doc"), F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_key").alias("rep_key"))
    wanted = stage(rows.join(wanted.distinct(), "doc", "left_semi"), "dup-wanted")
    if wanted.count() <= BROADCAST_IDS:  # 24 bytes each; beyond, Spark shuffles both sides
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(), text_or_empty().alias("text"))
    found = texts.join(wanted, (F.col("doc_id") == F.col("rep_id")) & (F.col("text_key") == F.col("rep_key")))
    return stage(found.select("doc", "text").dropDuplicates(["doc"]), "dup-texts")


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets (sorted arrays) have the least similarity."""
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common > 0 and 100 * common >= PERCENT * (len(a) + len(b) - common)


def sets_of(texts: list[str], width: int) -> list[np.ndarray]:
    shingles, sizes = shingle_sets(texts, width)
    return np.split(shingles, np.cumsum(sizes)[:-1])


def confirm(pairs: DataFrame, docs: DataFrame, sets: DataFrame, width: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; texts are joined for these nodes only."""
    pairs = stage(pairs, "dup-pairs")
    texts = texts_of(pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc"))), docs, sets)
    both = pairs.join(texts.select(F.col("doc").alias("a"), F.col("text").alias("ta")), "a")
    both = both.join(texts.select(F.col("doc").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")

    def work(batches):
        for batch in batches:
            good = []
            for i in range(0, batch.num_rows, 64):
                first, second = (batch.column(c).slice(i, 64).to_pylist() for c in (2, 3))
                good += [similar(p, q) for p, q in zip(sets_of(first, width), sets_of(second, width), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(tidy(work), "a bigint, b bigint")


TASKS = "task string, nodes array<bigint>, comps array<bigint>, left binary, right binary"


def crossing(posted: DataFrame, nodes: DataFrame, comps: DataFrame) -> DataFrame:
    """Blocks of lists with the pairs in them that still cross components (columns of TASKS).

    Per list, members outside its largest component are compared with all members, in blocks.  A row
    has the nodes of a block that are in such pairs, and the pairs as places in ``nodes``.
    """
    member = posted.select("key", "node").join(comps.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
    member = stage(member.select("key", "node", F.coalesce("component", "node").alias("comp")), "dup-members")
    counts = member.groupBy("key", "comp").agg(F.count("*").alias("n"))
    lists = counts.groupBy("key").agg(F.sum("n").alias("all"), F.max(F.struct("n", "comp")).alias("major"), F.count("*").alias("comps"))
    lists = lists.where("comps > 1").select(
        "key", F.col("major.comp").alias("major"), F.ceil(F.col("all") / BLOCK).alias("blocks"),
        F.ceil((F.col("all") - F.col("major.n")) / BLOCK).alias("minor_blocks"),
    )
    packed = posted.groupBy("node").agg(F.array_sort(F.collect_list(F.hash("key"))).alias("prefix"))
    facts = nodes.select("node", "n_shingles", "sketch").join(packed, "node").withColumnRenamed("node", "of")
    rows = member.join(lists, "key").join(facts, F.col("node") == F.col("of"))
    rows = rows.withColumn("minor", F.col("comp") != F.col("major"))
    one = F.struct("node", "comp", F.col("n_shingles").alias("size"), "minor", "sketch", "prefix")
    zero = F.lit(0).cast("long")
    # A list of one block needs no copies: its minor members ask and answer.
    small = (F.col("blocks") == 1) & (F.col("minor_blocks") == 1)
    as_small = rows.where(small).select(
        "key", zero.alias("block"), zero.alias("minor_block"), F.lit(None).cast("boolean").alias("asks"), one.alias("m")
    )
    large = rows.where(~small)
    as_member = large.select(
        "key", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"),
        F.explode(F.sequence(zero, F.col("minor_blocks") - 1)).alias("minor_block"), F.lit(False).alias("asks"), one.alias("m"),
    )
    as_minor = large.where("minor").select(
        "key", F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("node", F.lit(1)), F.col("minor_blocks")).alias("minor_block"), F.lit(True).alias("asks"), one.alias("m"),
    )
    parts = as_small.unionByName(as_member).unionByName(as_minor)
    groups = parts.groupBy("key", "block", "minor_block").agg(F.collect_list(F.struct("asks", "m")).alias("ms"))
    groups = groups.select(F.hash("key").alias("key"), F.concat_ws(":", "key", "block", "minor_block").alias("task"), "ms")

    def work(batches):
        kinds = (pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary())
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                task = block_pairs(batch.column(0)[i].as_py(), batch.column(2)[i].as_py())
                if task is not None:
                    found.append((batch.column(1)[i].as_py(), *task))
            columns = zip(*found, strict=True) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in TASKS.split(", ")])

    return groups.mapInArrow(tidy(work), TASKS)


def block_pairs(key: int, ms: list[dict]):
    """Nodes, their components, and the pairs of one block that reach the threshold across components.

    A pair is taken in one of the lists it shares only: that of the smallest key in both
    prefixes.  Pairs that agree most come first.
    """
    asking = [x["m"] for x in ms if x["m"]["minor"] and x["asks"] is not False]
    answering = [x["m"] for x in ms if not x["asks"]]
    if not asking or not answering:
        return None

    def facts(side):
        sketches = np.frombuffer(b"".join(m["sketch"] for m in side), np.uint8).reshape(len(side), COORDINATES)
        return sketches, *(np.array([m[k] for m in side], np.int64) for k in ("node", "comp", "size"))

    a_sketch, a_node, a_comp, a_size = facts(asking)
    b_sketch, b_node, b_comp, b_size = facts(answering)
    b_minor = np.array([m["minor"] for m in answering])
    b_prefix = [set(m["prefix"]) for m in answering]
    pairs = []
    for i, m in enumerate(asking):
        equal = (b_sketch == a_sketch[i]).sum(axis=1)
        low, high = np.minimum(b_size, a_size[i]), np.maximum(b_size, a_size[i])
        # Two minor members ask each other: the smaller one's question is enough.
        good = (equal >= MATCHES) & (b_comp != a_comp[i]) & (100 * low >= PERCENT * high) & (~b_minor | (b_node > a_node[i]))
        for j in np.nonzero(good)[0].tolist():
            if min(b_prefix[j].intersection(m["prefix"])) == key:
                pairs.append((-int(equal[j]), i, j))
    if not pairs:
        return None
    pairs.sort()
    place: dict[int, int] = {}
    comps = []

    def put(node, comp):
        if node not in place:
            place[node] = len(place)
            comps.append(comp)
        return place[node]

    left = np.array([put(int(a_node[i]), int(a_comp[i])) for _, i, _ in pairs], np.uint32)
    right = np.array([put(int(b_node[j]), int(b_comp[j])) for _, _, j in pairs], np.uint32)
    return list(place), comps, left.tobytes(), right.tobytes()


def confirm_blocks(tasks: DataFrame, docs: DataFrame, sets: DataFrame, width: int) -> DataFrame:
    """Links (a, b) among the pairs of each block, confirmed on the full sets.

    A block's texts are brought together once.  Within a block, a pair is skipped if links found there
    have connected its components already.
    """
    tasks = stage(tasks, "dup-tasks")
    texts = texts_of(tasks.select(F.explode("nodes").alias("doc")), docs, sets)
    of_task = tasks.select(F.col("task").alias("of"), F.explode("nodes").alias("doc")).join(texts, "doc")
    of_task = of_task.groupBy("of").agg(F.collect_list(F.struct("doc", "text")).alias("texts"))
    joined = tasks.join(of_task, F.col("task") == F.col("of")).select("nodes", "comps", "left", "right", "texts")

    def work(batches):
        for batch in batches:
            links = []
            for i in range(batch.num_rows):
                nodes, comps, left, right, texts = (c[i].as_py() for c in batch.columns)
                text_of = {t["doc"]: t["text"] for t in texts}
                sets = dict(zip(text_of, sets_of(list(text_of.values()), width), strict=True))
                root = {c: c for c in comps}

                def find(c, root=root):
                    while root[c] != c:
                        c = root[c]
                    return c

                for x, y in zip(np.frombuffer(left, np.uint32).tolist(), np.frombuffer(right, np.uint32).tolist(), strict=True):
                    p, q = find(comps[x]), find(comps[y])
                    if p != q and similar(sets[nodes[x]], sets[nodes[y]]):
                        root[p] = q
                        links.append((nodes[x], nodes[y]))
            yield pa.RecordBatch.from_arrays([pa.array([link[k] for link in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return joined.mapInArrow(tidy(work), "a bigint, b bigint")


def distinct_sets(usable: DataFrame) -> DataFrame:
    """(digest, rep, least, node) of every different set: a row that has it, its smallest doc_id, and its node.

    The node is that doc_id; of several sets with one smallest doc_id, all but the first get numbers below FURTHER.
    """
    sets = usable.groupBy("digest").agg(F.min(F.struct("doc_id", "text_key")).alias("rep"))
    sets = stage(sets.select("digest", "rep", F.col("rep.doc_id").alias("least")), "dup-distinct")
    first = sets.groupBy("least").agg(F.min("digest").alias("first")).select("first")
    own = sets.join(first, F.col("digest") == F.col("first"), "left")
    number = F.lit(FURTHER) - 1 - F.monotonically_increasing_id()
    node = F.when(F.col("first").isNotNull(), F.col("least")).otherwise(number)
    return stage(own.select("digest", "rep", "least", node.alias("node")), "dup-sets")


def labelled(sets: DataFrame, comps: DataFrame) -> DataFrame:
    """(digest, group_id, label): the component of each set, and the smallest doc_id in it."""
    names = comps.withColumnRenamed("node", "of")
    found = sets.join(names, F.col("node") == F.col("of"), "left")
    found = found.select("digest", "least", F.coalesce("component", "node").alias("group_id"))
    # The smallest node is the smallest doc_id, unless further texts of a doc_id are in the component.
    further = found.where(F.col("group_id") < FURTHER)
    label = further.groupBy(F.col("group_id").alias("of_group")).agg(F.min("least").alias("label"))
    named = further.join(label, F.col("group_id") == F.col("of_group")).select("digest", "group_id", "label")
    return found.where(F.col("group_id") >= FURTHER).select("digest", "group_id", F.col("group_id").alias("label")).unionByName(named)


def near_duplicates(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_key, group_id) for each row of ``docs``.

    ``text_key`` tells the texts of one doc_id apart, ``group_id`` the components.
    """
    rows = stage(sketch(docs, width), "dup-sketch")
    usable = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    sets = distinct_sets(usable)
    reps = sets.select("node", F.col("digest").alias("of"), F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_key").alias("rep_key"))
    at = (F.col("digest") == F.col("of")) & (F.col("doc_id") == F.col("rep_id")) & (F.col("text_key") == F.col("rep_key"))
    nodes = usable.join(reps, at).select("node", "n_shingles", "posted", "sketch")
    nodes = stage(nodes.dropDuplicates(["node"]), "dup-nodes")
    posted = stage(postings(nodes), "dup-postings")
    links = stage(confirm(best_hubs(posted, nodes), docs, sets, width), "dup-links")
    comps = stage(components(links), "dup-comps")
    more = confirm_blocks(crossing(posted, nodes, comps), docs, sets, width)
    comps = stage(components(links.unionByName(more)), "dup-comps")
    of_set = labelled(sets, comps).withColumnRenamed("digest", "of")
    joined = rows.join(of_set, (rows["digest"] == of_set["of"]) & rows["doc_id"].isNotNull(), "left")
    component = F.coalesce("label", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), "text_key", "group_id")


def query(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on shingles of two words."""
    return near_duplicates(table(spark, sf_dir, "documents"), 2)


def stage_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one text (of the smallest doc_id) of each group on shingles of five words.

    Texts without a word are in no group and stay, and so do all rows without doc_id; rows that agree in doc_id and text are one.
    """
    found = near_duplicates(docs, 5).where("kept AND doc_id IS NOT NULL")
    grouped = found.where("group_id IS NOT NULL").groupBy("group_id").agg(F.min(F.struct("doc_id", "text_key")).alias("one"))
    keep = grouped.select("one.*").unionByName(found.where("group_id IS NULL").select("doc_id", "text_key").distinct())
    keep = keep.select(F.col("doc_id").alias("keep_id"), F.col("text_key").alias("keep_key"))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_key(), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = rows.join(keep, (F.col("id") == F.col("keep_id")) & (F.col("text_key") == F.col("keep_key")), "left_semi")
    return kept.dropDuplicates(["id", "text_key"]).select("row.*").unionByName(docs.where("doc_id IS NULL"))
