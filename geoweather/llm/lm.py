"""Language-model scores by stupid backoff, counts and n-grams joined by hash.

A document's words are scored by the n-gram counts of all other documents (a row's own
occurrences are taken off): log of c(n-gram) / c(context) for the longest n-gram seen elsewhere, less
log(1 / ``BACKOFF``) for each order backed off; a word not seen elsewhere counts as one in a corpus
of one word more.  ``ORDER`` is the longest n-gram; the empty n-gram's count is the corpus size.

Scale.  Documents are worked off in groups of about ``GROUP_CHARS`` characters, hashed and stored once (asking and
scoring read the same stored groups, so no group can be lost between the two).  A group's distinct
n-gram hashes (64 bits), summed, are cut into buckets by their leading bits and shuffled as packed
arrays, one row a group and bucket: counts are combined before the shuffle, and a frequent
n-gram is one entry a group.  Each bucket merges its arrays to its part of the count table, joins it with
the arrays and answers every group, with counts only for the n-grams that other groups have too.

Counts are asked for order by order, so that one order's n-grams at a time lie in shuffle files.  First for words and
pairs of words; words without a pair that occurs in
another document are scored at once.  Then for longer n-grams, and only for those whose pairs all
occur in another document: an n-gram seen elsewhere has no other pairs, and an n-gram that is not
asked for occurs in one document only, so this drops no count that a score needs.  Words that no
such n-gram holds are not kept for the second time.  Scores are summed per document.  Shuffles and tables
are deleted when the next table is written.

Words are split at ASCII white space, A-Z lower-cased.  Null and wordless texts have 0 words,
score 0 and null mean.  Rows that repeat are documents of their own.  An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweather.llm.common import discard, stage, table, text_or_empty, tidy
from geoweather.llm.texts import MIX, folded_words, text_groups

ORDER = 5
BACKOFF = 0.4
GROUP_CHARS = 2_400_000
BUCKET_BYTES = 8 << 20  # of text per bucket of an order
EMPTY = np.uint64(0x5DEECE66D)  # hash of the n-gram of no words

FIRST = 2  # orders up to this one are asked for first
FREQUENT = 255  # words of a group that are numbered first

ASKS = "bucket bigint, id string, hashes binary, counts binary"  # of n-grams of one order
ANSWERS = "bucket bigint, id string, seen binary, more binary"
GROUPS = "id string, doc_ids array<bigint>, lengths array<bigint>, vocabulary binary, words binary"
OPEN = GROUPS + ", pairs binary, context binary, score array<double>, off array<bigint>, unseen array<bigint>"
SCORES = "doc_id bigint, n_words bigint, log_score double, mean_score double, n_backed_off bigint, n_unseen bigint"


def longer(hashes: np.ndarray, words: np.ndarray, order: int) -> np.ndarray:
    """Hashes of the n-grams of this order that end at each word, from those of one word less; valid if the document has so many words there."""
    out = np.zeros_like(words)
    np.multiply(hashes[:-1], MIX[0], out=out[1:])
    out += words
    out += np.uint64(order)
    shifted = out >> np.uint64(30)
    for factor, shift in ((MIX[1], 27), (MIX[2], 31)):
        out ^= shifted
        out *= factor
        np.right_shift(out, np.uint64(shift), out=shifted)
    out ^= shifted
    return out


def ngram_hashes(words: np.ndarray, order: int) -> np.ndarray:
    """Hashes of the n-grams of this order that end at each word (a word's is its own)."""
    hashes = words
    for n in range(2, order + 1):
        hashes = longer(hashes, words, n)
    return hashes


def places(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document of each word, and how many words of the document come before it."""
    return np.repeat(np.arange(len(lengths)), lengths), np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def asked(lengths: np.ndarray, order: int, paired: np.ndarray | None) -> np.ndarray:
    """Positions where the n-grams of this order end that are asked for.

    Those are all up to ``FIRST``; longer ones if all their pairs end at a position of ``paired``.
    """
    if order <= FIRST:
        return np.nonzero(places(lengths)[1] >= order - 1)[0]
    at = paired.copy()  # a document's first word ends no pair
    for k in range(1, order - 1):
        at[:k] = False
        at[k:] &= paired[:-k]
    return np.nonzero(at)[0]


def elsewhere(grams: np.ndarray, docs: np.ndarray, told: list[dict], bits: int) -> np.ndarray:
    """Count of each n-gram in all documents but its own; ``told`` are the answers in order of the buckets."""
    if not len(grams):
        return np.zeros(0)
    by = np.argsort(grams, kind="stable")  # documents ascend among equal n-grams
    g, d = grams[by], docs[by]
    new = np.r_[True, g[1:] != g[:-1]]
    gram, run = np.cumsum(new) - 1, np.cumsum(new | np.r_[True, d[1:] != d[:-1]]) - 1
    out = np.empty(len(g))
    out[by] = np.bincount(gram)[gram] + told_counts(told, g[new], bits)[gram] - np.bincount(run)[run]
    return out


def told_counts(told: list[dict], unique: np.ndarray, bits: int) -> np.ndarray:
    """Other groups' counts of a group's sorted distinct n-grams."""
    bucket = unique >> np.uint64(64 - bits) if bits else np.zeros(len(unique), np.uint64)
    starts = np.nonzero(np.r_[True, bucket[1:] != bucket[:-1]])[0]
    out = np.zeros(len(unique))
    for x, a, b in zip(told, starts, np.r_[starts[1:], len(unique)], strict=True):
        seen = np.unpackbits(np.frombuffer(x["seen"], np.uint8), count=b - a).astype(bool)
        out[a:b][seen] = opened(x["more"], np.uint64)
    return out


def pack_sorted(hashes: np.ndarray) -> bytes:
    """Differences in six bytes each, after the first value; in eight if one is larger."""
    steps = np.diff(hashes)
    width = 6 if not len(steps) or int(steps.max()) < 1 << 48 else 8
    body = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + hashes[:1].astype("<u8").tobytes() + body.tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    width = data[0]
    body = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(body), 8), np.uint8)
    steps[:, :width] = body
    return np.cumsum(np.r_[np.frombuffer(data, "<u8", 1, 1), steps.view("<u8").ravel()], dtype=np.uint64)


def squeezed(values: np.ndarray) -> bytes:
    """Compressed, all lowest bytes first; as many bytes of each number as the largest one has."""
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)[:, :width].T
    return bytes([width]) + len(values).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def opened(data: bytes, kind) -> np.ndarray:
    out = np.zeros((int.from_bytes(data[1:9], "little"), np.dtype(kind).itemsize), np.uint8)
    if data[0]:
        out[:, : data[0]] = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[9:]), np.uint8).reshape(data[0], -1).T
    return out.view(kind).ravel()


def numbered_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words in order of their first places, each word's number among them, words of each text."""
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    numbers, lengths = [np.zeros(0, np.uint32)], []
    for text in texts:
        words = folded_words(text)
        numbers.append(np.fromiter(map(known.__getitem__, words), np.uint32, len(words)))
        lengths.append(len(words))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known)), np.concatenate(numbers), np.array(lengths, np.int64)


def groups_of(batches, chars: int):
    """(id, doc ids, vocabulary, word numbers, words per document) of each group of documents; equal groups share an id."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for a, b, texts in text_groups(batch.column(1), chars):
            vocabulary, numbers, lengths = numbered_words(texts)
            said = repr(ids[a:b]).encode(), lengths.tobytes(), vocabulary.tobytes(), numbers.tobytes()
            yield hashlib.blake2b(b"".join(said), digest_size=16).hexdigest(), ids[a:b], vocabulary, numbers, lengths


def _rows(columns: list[list], schema: str, kinds) -> pa.RecordBatch:
    names = [x.split()[0] for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def stored_words(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vocabulary, word numbers and words per document of the group in row i of a batch with the columns lengths, vocabulary, words."""
    lengths, vocabulary, numbers = (batch.column(c)[i].as_py() for c in ("lengths", "vocabulary", "words"))
    return unpacked_vocabulary(vocabulary), opened(numbers, np.uint32), np.array(lengths, np.int64)


def packed_words(vocabulary: np.ndarray, numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Words that occur, the ``FREQUENT`` most frequent ones in front, each part sorted; and numbers in that order."""
    counts = np.bincount(numbers, minlength=len(vocabulary))
    by = np.argsort(vocabulary)
    by = by[counts[by] > 0]
    rare = np.ones(len(by), bool)
    rare[np.argsort(-counts[by], kind="stable")[:FREQUENT]] = False
    by = np.r_[by[~rare], by[rare]]
    new = np.zeros(len(vocabulary), np.uint32)
    new[by] = np.arange(len(by))
    parts = [pack_sorted(part) if len(part) else b"" for part in np.split(vocabulary[by], [np.count_nonzero(~rare)])]
    return len(parts[0]).to_bytes(4, "little") + parts[0] + parts[1], squeezed(new[numbers])


def unpacked_vocabulary(data: bytes) -> np.ndarray:
    end = 4 + int.from_bytes(data[:4], "little")
    return np.concatenate([unpack_sorted(part) if part else np.zeros(0, np.uint64) for part in (data[4:end], data[end:])])


def asks(groups: DataFrame, order: int, bits: int) -> DataFrame:
    """Packed n-grams of one order and their counts of every group, one row a bucket that has any (columns of ASKS).

    ``groups`` has the columns of GROUPS, of OPEN beyond ``FIRST``.  With the words, EMPTY is asked for; it counts all words.
    """
    later = order > FIRST

    def group_asks(batches):
        for batch in batches:
            for i, name in enumerate(batch.column("id").to_pylist()):
                vocabulary, numbers, lengths = stored_words(batch, i)
                words = vocabulary[numbers]
                paired = opened(batch.column("pairs")[i].as_py(), np.uint64) > 0 if later else None
                grams = ngram_hashes(words, order)[asked(lengths, order, paired)]
                unique, counts = np.unique(grams if order > 1 else np.r_[EMPTY, grams], return_counts=True)
                if order == 1:
                    counts[np.searchsorted(unique, EMPTY)] = len(words)
                if len(unique):
                    yield name, unique, counts

    def work(batches):
        for name, unique, counts in group_asks(batches):
            bucket = (unique >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(unique), np.int64)
            starts = np.nonzero(np.r_[True, bucket[1:] != bucket[:-1]])[0]
            ends = np.r_[starts[1:], len(unique)]
            parts = [(pack_sorted(unique[a:b]), squeezed(counts[a:b].astype(np.uint32))) for a, b in zip(starts, ends, strict=True)]
            yield _rows(
                [bucket[starts], [name] * len(parts), [p[0] for p in parts], [p[1] for p in parts]],
                ASKS, (pa.int64(), pa.string(), pa.binary(), pa.binary()),
            )

    return groups.select("id", "lengths", "vocabulary", "words", *["pairs"] * later).mapInArrow(tidy(work), ASKS)


def answers(asked: DataFrame) -> DataFrame:
    """Each bucket's count table joined with the arrays that asked (columns of ANSWERS).

    ``seen`` has a bit for each n-gram, set if other groups have it, ``more`` their counts of those.
    """

    def answer(bucket, rows):
        hashes = [unpack_sorted(h) for _, h, _ in rows]
        counts = [opened(c, np.uint32) for _, _, c in rows]
        _, place = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(counts).astype(np.float64)).astype(np.uint64)
        ends = np.cumsum([len(h) for h in hashes])
        out = {}
        for (name, _, _), own, end in zip(rows, counts, ends, strict=True):
            if name not in out:
                more = total[place[end - len(own) : end]] - own
                out[name] = np.packbits(more > 0).tobytes(), squeezed(more[more > 0])
        columns = [[bucket] * len(out), list(out), *map(list, zip(*out.values(), strict=True))]
        return _rows(columns, ANSWERS, (pa.int64(), pa.string(), pa.binary(), pa.binary()))

    def work(batches):
        now, rows = None, []
        for batch in batches:
            for bucket, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now and rows:
                    yield answer(now, rows)
                    rows = []
                now = bucket
                rows.append(row)
        if rows:
            yield answer(now, rows)

    return asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(work), ANSWERS)


def packed_groups(docs: DataFrame, chars: int) -> DataFrame:
    """Words of every group as numbers of its own vocabulary (columns of GROUPS)."""

    def work(batches):
        for name, ids, vocabulary, numbers, lengths in groups_of(batches, chars):
            vocabulary, numbers = packed_words(vocabulary, numbers)
            yield _rows(
                [[name], [ids], [lengths.tolist()], [vocabulary], [numbers]],
                GROUPS, (pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()),
            )

    return docs.mapInArrow(tidy(work), GROUPS)


def begin(words: np.ndarray, lengths: np.ndarray, told: list[list[dict]], order: int, bits: int):
    """Counts of pairs elsewhere and of their contexts (0 if not seen elsewhere), and sums of the other words' scores per document."""
    n = len(words)
    doc, place = places(lengths)
    most = np.minimum(order, place + 1)
    counts = elsewhere(np.r_[EMPTY, words], np.r_[-1, doc], told[0], bits)
    others, single = counts[0] + n - lengths[doc], counts[1:]  # counts[0]: words of other groups
    pairs, context = np.zeros(n), np.zeros(n)
    if order > 1:
        at = asked(lengths, 2, None)
        pairs[at] = elsewhere(ngram_hashes(words, 2)[at], doc[at], told[1], bits)
        context[at] = np.where(pairs[at] > 0, single[at - 1], 0)
    seen, paired = single > 0, pairs > 0
    score = np.zeros(n)
    score[seen] = np.log(single[seen] / others[seen])
    score[~seen] = -np.log(others[~seen] + 1)
    score += np.where(seen, most - 1, most) * np.log(BACKOFF)
    score[paired] = 0.0
    add = lambda w: np.bincount(doc, weights=w, minlength=len(lengths))
    off, unseen = add(~paired & (~seen | (most > 1))), add(~seen)
    return pairs.astype(np.uint64), context.astype(np.uint64), add(score), off.astype(np.int64), unseen.astype(np.int64)


def finish(words: np.ndarray, lengths: np.ndarray, pairs: np.ndarray, context: np.ndarray, told: list[list[dict]], order: int, bits: int):
    """Sums of scores, and of words backed off, per document, of the words that end a pair seen elsewhere."""
    paired = pairs > 0
    doc, place = places(lengths)
    most = np.minimum(order, place + 1)
    score, reached = np.zeros(len(words)), np.full(len(words), FIRST)
    score[paired] = np.log(pairs[paired] / context[paired]) + (most[paired] - FIRST) * np.log(BACKOFF)
    before, hashes = pairs.astype(np.float64), ngram_hashes(words, FIRST)
    for k in range(FIRST + 1, order + 1):
        at, hashes, now = asked(lengths, k, paired), longer(hashes, words, k), np.zeros(len(words))
        now[at] = elsewhere(hashes[at], doc[at], told[k - FIRST - 1], bits)
        at = at[now[at] > 0]
        score[at] = np.log(now[at] / before[at - 1]) + (most[at] - k) * np.log(BACKOFF)
        reached[at], before = k, now
    add = lambda w: np.bincount(doc, weights=w, minlength=len(lengths))
    return add(score), add(paired & (reached < most)).astype(np.int64)


def with_answers(groups: DataFrame, answered: list[DataFrame]) -> DataFrame:
    """``groups`` with ``told``: for each of these answers those of the group, in order of the buckets."""
    rows = None
    for n, one in enumerate(answered):
        one = one.select("id", F.lit(n).alias("n"), "bucket", "seen", "more")
        rows = one if rows is None else rows.unionByName(one)
    if rows is None:
        return groups.withColumn("told", F.lit(None).cast("array<struct<n:int,bucket:bigint,seen:binary,more:binary>>"))
    told = rows.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", "bucket", "seen", "more"))).alias("told"))
    return groups.join(told, "id", "left")


def told_to(batch: pa.RecordBatch, i: int, n: int) -> list[list[dict]]:
    """The answers of each of ``n`` orders to the group in row i, in order of the buckets."""
    out = [[] for _ in range(n)]
    for x in batch.column("told")[i].as_py() or []:
        out[x["n"]].append(x)
    return out


def opened_groups(groups: DataFrame, order: int, bits: int) -> DataFrame:
    """What is left to do for every group after the first answers (columns of OPEN)."""
    kinds = (
        pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(),
        pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64()),
    )

    def work(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                vocabulary, numbers, lengths = stored_words(batch, i)
                pairs, context, *sums = begin(vocabulary[numbers], lengths, told_to(batch, i, min(order, FIRST)), order, bits)
                paired = pairs > 0
                kept = paired | np.r_[paired[1:], False][: len(paired)]
                numbers = np.where(kept, numbers, numbers[np.argmax(kept)] if len(numbers) else 0)
                same = [batch.column(c)[i].as_py() for c in ("id", "doc_ids", "lengths")]
                columns = [*same, *packed_words(vocabulary, numbers), squeezed(pairs), squeezed(context), *[x.tolist() for x in sums]]
                yield _rows([[c] for c in columns], OPEN, kinds)

    return groups.select("id", "doc_ids", "lengths", "vocabulary", "words", "told").mapInArrow(tidy(work), OPEN)


def score_documents(docs: DataFrame, order: int = ORDER, chars: int = GROUP_CHARS) -> DataFrame:
    """Stupid-backoff scores (columns of SCORES) of each row of ``docs`` by the counts of all other rows."""
    docs = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, int(size // BUCKET_BYTES).bit_length())

    def told(groups, orders):
        return [stage(answers(asks(groups, n, bits)), f"lm-answers-{n}", once=True) for n in orders]

    groups = stage(packed_groups(docs, chars), "lm-groups", once=True)
    first = told(groups, range(1, min(order, FIRST) + 1))
    left = stage(opened_groups(with_answers(groups, first), order, bits), "lm-open", once=True)
    discard(groups, *first)
    left = with_answers(left, told(left, range(FIRST + 1, order + 1)))

    def work(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                vocabulary, numbers, lengths = stored_words(batch, i)
                pairs, context = (opened(batch.column(c)[i].as_py(), np.uint64) for c in ("pairs", "context"))
                ids, score, off, unseen = (batch.column(c)[i].as_py() for c in ("doc_ids", "score", "off", "unseen"))
                more, more_off = finish(vocabulary[numbers], lengths, pairs, context, told_to(batch, i, max(0, order - FIRST)), order, bits)
                score, off = np.array(score) + more, np.array(off, np.int64) + more_off
                mean = [s / n if n else None for s, n in zip(score.tolist(), lengths.tolist(), strict=True)]
                yield _rows([ids, lengths, score, mean, off, unseen], SCORES, [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()])

    used = ("doc_ids", "lengths", "vocabulary", "words", "pairs", "context", "score", "off", "unseen", "told")
    return left.select(*used).mapInArrow(tidy(work), SCORES)


def query(spark, sf_dir: str) -> DataFrame:
    """Score every document by the n-gram counts of all others."""
    return score_documents(table(spark, sf_dir, "documents"))
