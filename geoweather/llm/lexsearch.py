"""Ranked lexical search with bags of documents deduplicated.

Terms are runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased.  For a block of items:

1. Documents are restricted to the items' vocabulary: a bag is the sorted term numbers, their counts
   and m, the length part of the weight (25 + 75 * n * N div L).
2. Bags with equal hashes are grouped, and the group's smallest and largest bag are compared: if they
   are the same bytes, the group is a class of identical bags; otherwise the bags themselves
   are its keys.  Documents without a term of the vocabulary score 0 and are in no class.
3. Every class is scored once, against all items, as a product of matrices in 64-bit integers' range.
   A task keeps the ``k`` best classes of each item by (score, smallest doc_id); no document of another
   class can be among the ``k`` best documents, as each of those classes has one that goes before it.
4. The best classes are expanded to their members by ascending doc_id, at most ``k`` of each, and ranked.

Blocks hold about ``BLOCK_CHARS`` characters of items, so the vocabulary sent to tasks is bounded (by that, or
one longer item); each block is searched over all documents.  Counts (documents N, terms L,
document frequencies) cover all documents.

Null text has no term; an item without a term, or whose terms occur nowhere, has no result; items that
share an item_id are searched one by one; rows that repeat a doc_id are documents of
their own and each take a rank; null doc_ids come after others of equal score; an empty table gives
an empty result; other columns are ignored.  Texts are split in groups of about ``GROUP_CHARS``
characters, or one longer text.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoweather.llm.common import stage, table
from geoweather.llm.texts import FOLD, text_groups

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
TOP = 10
BLOCK_CHARS = 4_000_000
GROUP_CHARS = 2_000_000
CELLS = 4_000_000  # entries of a dense block of bags
EXACT = 1 << 53

BAG = "doc_id bigint, n bigint, bag binary"
SCORE = "item bigint, class binary, first_id bigint, score bigint"


def terms(text: str) -> list[str]:
    return TERM.findall(text.lower() if text.isascii() else text.translate(FOLD))


def pack(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Bytes of a bag: term numbers, then their counts."""
    return ids.astype("<i4").tobytes() + counts.astype("<i8").tobytes()


def unpack(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = len(bag) // 12
    return np.frombuffer(bag, "<i4", size), np.frombuffer(bag, "<i8", size, 4 * size)


def bags(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, n, bag) of each row of ``docs``: its number of terms, and its bag over the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by BLOCK_CHARS

    def work(batches):
        number = {t: i for i, t in enumerate(shared.value)}
        for batch in batches:
            for a, b, texts in text_groups(batch.column(1), GROUP_CHARS):
                sizes, packed = [], []
                for text in texts:
                    found = terms(text)
                    sizes.append(len(found))
                    times = Counter(map(number.get, found))
                    times.pop(None, None)
                    ids = np.array(sorted(times), np.int64)
                    packed.append(pack(ids, np.array([times[i] for i in ids.tolist()], np.int64)))
                columns = [batch.column(0).slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "bag"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, BAG)


def document_frequencies(found: DataFrame) -> dict[int, int]:
    """Term number -> documents that hold it, added up in each task first."""

    def work(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids = [unpack(b)[0] for b in batch.column(0).to_pylist()]
            here = np.bincount(np.concatenate([np.zeros(0, np.int32), *ids]), minlength=len(total))
            here[: len(total)] += total
            total = here
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(total[at])], names=["term", "n"])

    counted = found.select("bag").mapInArrow(work, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    return {r.term: r.n for r in counted.collect()}  # one row a term of the bounded vocabulary


def bag_hash() -> Column:
    """128 bits of a bag and its m."""
    return F.unhex(F.concat(*(F.lpad(F.hex(F.xxhash64("m", "bag", F.lit(s))), 16, "0") for s in (1, 2))))


def classes(found: DataFrame, key: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """((class, bag, m, first_id), (class, doc_id)): classes of identical bags and m, and their members."""
    b = found.where(F.length("bag") > 0)
    key = bag_hash() if key is None else key
    whole = F.concat(F.unhex(F.lpad(F.hex("m"), 16, "0")), F.col("bag"))
    keyed = b.select("doc_id", "m", "bag", key.alias("key"), whole.alias("whole"))
    first = F.min("doc_id").alias("first_id")
    grouped = keyed.groupBy("key").agg(F.min("whole").alias("least"), F.max("whole").alias("most"), first)
    grouped = stage(grouped, "bag-classes")
    one = grouped.where("least = most").select(
        F.col("key").alias("class"),
        F.expr("substring(least, 9)").alias("bag"),
        F.conv(F.hex(F.expr("substring(least, 1, 8)")), 16, 10).cast("long").alias("m"),
        "first_id",
    )
    mixed = grouped.where("least <> most").select(F.col("key").alias("mixed"))
    members = keyed.select(F.col("key").alias("class"), "doc_id")
    if mixed.limit(1).count():
        # Hashes that stand for several bags: these bags are their own keys.
        apart = keyed.join(mixed, F.col("key") == F.col("mixed"))
        split = apart.groupBy("whole").agg(F.first("bag").alias("bag"), F.first("m").alias("m"), first)
        one = one.unionByName(split.select(F.col("whole").alias("class"), "bag", "m", "first_id"))
        alone = keyed.join(mixed, F.col("key") == F.col("mixed"), "left_anti").select(F.col("key").alias("class"), "doc_id")
        members = alone.unionByName(apart.select(F.col("whole").alias("class"), "doc_id"))
    return one, members


def product(a: np.ndarray, q: np.ndarray) -> np.ndarray:
    """a @ q for integers; by floating numbers where every sum is exact in them."""
    if float(a.max(initial=0)) * float(q.sum(axis=0).max(initial=0)) < EXACT:
        return (a.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return a @ q


def score_classes(found: DataFrame, weights: np.ndarray, queries: list[dict[int, int]], k: int) -> DataFrame:
    """SCORE rows: each task's ``k`` best classes of each item; ``queries``: term number -> repeats."""
    shared = found.sparkSession.sparkContext.broadcast((weights, queries))  # bounded by BLOCK_CHARS

    def work(batches):
        weights, queries = shared.value
        best: list[list[tuple]] = [[] for _ in queries]
        rows = max(1, CELLS // max(1, len(weights)))

        def order(x):
            return -x[0], x[1] is None, x[1] or 0, x[2]

        def take(names, firsts, ms, packed):
            a = [unpack(p) for p in packed]
            used, at = np.unique(np.concatenate([ids for ids, _ in a]), return_inverse=True)
            place = {t: i for i, t in enumerate(used.tolist())}
            q = np.zeros((len(used), len(queries)), np.int64)
            for j, query in enumerate(queries):
                for t, times in query.items():
                    if t in place:
                        q[place[t], j] = times
            tf = np.concatenate([c for _, c in a])
            row = np.repeat(np.arange(len(a)), [len(ids) for ids, _ in a])
            m = np.array(ms, np.int64)[row]
            dense = np.zeros((len(a), len(used)), np.int64)
            dense[row, at] = weights[used][at] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            scores = product(dense, q)
            for j in range(len(queries)):
                column = scores[:, j]
                some = np.nonzero(column > 0)[0]
                if len(some) > k:
                    least = np.partition(column[some], len(some) - k)[len(some) - k]
                    some = some[column[some] >= least]
                best[j] = sorted(best[j] + [(int(column[i]), firsts[i], names[i]) for i in some.tolist()], key=order)[:k]

        for batch in batches:
            held = [batch.column(i).to_pylist() for i in range(4)]
            for i in range(0, len(held[0]), rows):
                take(*(h[i : i + rows] for h in held))
        out = [(j, name, first, score) for j, found in enumerate(best) for score, first, name in found]
        columns = [[r[i] for r in out] for i in range(4)]
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in SCORE.split(", ")])

    return found.select("class", "first_id", "m", "bag").mapInArrow(work, SCORE)


def ranked(docs: DataFrame, items: list[tuple[int, str]], k: int) -> DataFrame:
    """(item_id, rank, doc_id, score) for one block of items."""
    spark = docs.sparkSession
    counted = [Counter(terms(text)) for _, text in items]
    vocabulary = sorted(set().union(*counted)) if counted else []
    number = {t: i for i, t in enumerate(vocabulary)}
    found = stage(bags(docs, vocabulary), "bags")
    totals = found.agg(F.sum((F.col("n") > 0).cast("long")).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = totals.docs or 0, max(1, totals.terms or 0)
    df = document_frequencies(found)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(vocabulary))], np.int64)
    m = F.lit(25).cast("long") + F.expr(f"(75L * n * {n_docs}L) div {n_terms}L")
    one, members = classes(found.withColumn("m", m))
    queries = [{number[t]: times for t, times in c.items()} for c in counted]
    scored = score_classes(one, weights, queries, k)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("first_id"), "class")
    top = scored.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k).select("item", "class", "score")
    top = stage(top, "best-classes")
    wanted = top.select(F.col("class").alias("of")).distinct()
    inside = Window.partitionBy("class").orderBy(F.asc_nulls_last("doc_id"))
    held = members.join(wanted, F.col("class") == F.col("of"))
    held = held.withColumn("nth", F.row_number().over(inside)).where(F.col("nth") <= k).select(F.col("class").alias("of"), "doc_id")
    rank = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    final = top.join(held, F.col("class") == F.col("of")).withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    ids = spark.createDataFrame([(j, i) for j, (i, _) in enumerate(items)], "of_item bigint, item_id bigint")
    return final.join(ids, F.col("item") == F.col("of_item")).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best rows of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    asked = items.where("text IS NOT NULL").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    chars = asked.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    blocks = -(-chars // block_chars)
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for b in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else asked
        texts = sorted(((r.item_id, r.text) for r in mine.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        if texts:
            out = out.unionByName(ranked(docs, texts, k))
    return out


def query(spark, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH words AS (
    SELECT row_number() OVER () AS row_id, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents WHERE text IS NOT NULL
), sizes AS (
    SELECT row_id, doc_id, len(terms)::BIGINT AS n FROM words
), totals AS (
    SELECT count(*) FILTER (WHERE n > 0) AS docs, sum(n)::BIGINT AS terms FROM sizes
), asked AS (
    SELECT row_number() OVER () AS item, item_id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE text IS NOT NULL
), wanted AS (
    SELECT item, item_id, term, count(*) AS times FROM asked GROUP BY ALL
), tf AS (
    SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(terms) AS term FROM words)
    WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * (SELECT docs FROM totals) + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf GROUP BY term
), scored AS (
    SELECT q.item, q.item_id, s.doc_id, s.row_id,
           sum(q.times * w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (25 + (75 * s.n * z.docs) // z.terms))))::BIGINT AS score
    FROM wanted q JOIN tf t USING (term) JOIN weights w USING (term) JOIN sizes s USING (row_id) CROSS JOIN totals z
    GROUP BY q.item, q.item_id, s.doc_id, s.row_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id, row_id) AS rank
    FROM scored WHERE score > 0
) WHERE rank <= 10
"""
