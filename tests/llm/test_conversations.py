"""Prefix trie against a plain version."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from geoweather.llm import prefixtrie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, seq string, node int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """Nodes of the trie of rebuilt conversations, from the definition."""
    convs = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            r, t = role or "", text or ""
            digest = hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()
            convs[conv].append(((turn is not None, turn or 0), digest, (r, t)))
    convs = {c: tuple(x[-1] for x in sorted(found)) for c, found in convs.items()}
    whole = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = convs.get(c - c % 100, ())[:h] + own[h:]
    members = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        kids = children[path]
        leaves[path] = sum(leaves[k] for k in kids) if kids else 1
        own = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        saved[path] = own + sum(saved[k] for k in kids)
    out = []
    for path, cs in members.items():
        ended = ",".join(str(c) for c in sorted(cs) if whole[c] == path)
        parent = min(members[path[:-1]]) if path else None
        row = (min(cs), len(path), parent, len(cs), len(children[path]), leaves[path], saved[path], hashlib.sha256(ended.encode()).hexdigest())
        out.append(row)
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def trie(df, **more):
    return prefixtrie.build_trie(prefixtrie.rebuilt(prefixtrie.turn_sequences(df)), **more)


def some_rows(seed, n_convs, n_texts, hot=0.0):
    rng = random.Random(seed)
    rows = []
    for c in range(n_convs):
        if rng.random() < hot:
            turns = ["hot", "copy", "copy"]
        else:
            turns = [f"t{rng.randrange(n_texts)}" * rng.randint(1, 2) for _ in range(rng.randint(1, 9))]
        rows += [(c, i, "user" if i % 2 == 0 else "assistant", t, "x", i) for i, t in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,n_convs,n_texts,hot,block", [(1, 300, 2, 0.0, 40), (2, 400, 30, 0.4, 64), (3, 500, 1, 0.3, 30), (4, 60, 4, 0, 10**6)])
def test_trie_equals_plain_version_over_many_blocks_and_levels(spark, seed, n_convs, n_texts, hot, block):
    rows = some_rows(seed, n_convs, n_texts, hot)
    got = found(trie(spark.createDataFrame(rows, SCHEMA).repartition(5), block_turns=block))
    assert got == plain(rows)


def test_identical_conversations_span_many_shards(spark):
    rows = [(100 * c + 7, t, "user", f"turn {t}", "x", 1) for c in range(700) for t in range(8)]
    got = found(trie(spark.createDataFrame(rows, SCHEMA), block_turns=50))
    assert got == plain(rows)
    assert max(r[3] for r in got) == 700


def test_nulls_ties_repeats_empty_and_long_texts(spark):
    rows = [
        (None, 1, "user", "of no conversation", "x", 1),
        (7, None, None, None, "x", 1),
        (7, 2, "user", "", "x", 1),
        (7, 2, "user", "", "x", 1),
        (7, 2, "", "user", "x", 1),
        (8, 1, "us", "er", "x", 1),
        (8, 2, "u", "ser", "x", 1),
        (-5, 0, "user", "é" * 300_000, "x", 1),
        (100, 0, "user", "head", "x", 1),
        (103, 0, "user", "own", "x", 1),
    ]
    rows += [(104, t, "user", "again", "x", 1) for t in range(400)]
    got = found(trie(spark.createDataFrame(rows, SCHEMA)))
    assert got == plain(rows)


def test_empty_table_has_no_node(spark):
    assert trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_tree_is_balanced_by_median_insertion():
    tree, n = prefixtrie.Tree(), 1023
    for i in prefixtrie.median_first(n):
        tree.insert([i])

    def height(at):
        return 0 if not at else 1 + max(height(tree.low[at]), height(tree.high[at]))

    assert height(tree.down[0]) == 10
    assert sorted(tree.traverse()) == list(range(n + 1))
