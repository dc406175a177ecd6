"""Language identification by a linear-chain conditional random field over words.

Each word (a run of letters, lower-cased) is labelled with a language.  Emission features
are its character 2- to 4-grams with word ends marked (so its prefixes and suffixes too),
hashed into ``2**HASH_BITS`` weights a label, and membership in the lexicon of a language.
Transitions between neighbours' labels are learned with the emissions by maximising the
conditional likelihood of training sequences; as documents carry one label, the training
sequences are spliced from pieces of different documents, which makes them code-switched.

A document's words are labelled by forward-backward over its whole text: blocks of words are
turned into transfer matrices side by side, their running products give the messages at block
ends, and messages inside blocks follow.  The document's language is the label with the
largest mean posterior, its score that mean.

Learning uses text and lang of a bounded sample: ``SAMPLE_DOCS`` documents of each language
with crc32(doc_id) mod 5 <> 0 and non-null lang, the ones with the smallest digest of doc_id,
and ``SAMPLE_CHARS`` characters of each, from a place that the digest picks.  The model (weights and lexicon)
is bounded and sent to executors.

Null text, or text without a letter, is ``und`` with score 0, and so is every text if there is
nothing to learn from.  Of more than ``MAX_LANGUAGES`` labels the most frequent are learned.  A null doc_id is neither learned from nor held out.  Repeated rows
get the same answer; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoweather.llm.common import table, tidy
from geoweather.llm.texts import text_groups

SAMPLE_DOCS = 300  # per language
SAMPLE_CHARS = 1500  # per document
MAX_LANGUAGES = 256
HASH_BITS = 17
GRAMS = (2, 3, 4)
SEQUENCE = 48  # words
ROUNDS = 40
LEXICON_COUNT = 3
BLOCK = 32  # words
GROUP_CHARS = 2_000_000
MIN_SCORE = 0.4
LETTERS = re.compile(r"[^\W\d_]+")
EDGE = 1  # code of a word's two ends
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double"


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters; runs of other numeric characters only are left out."""
    words = LETTERS.findall(text.lower())
    if "".join(words).isalpha():
        return words
    return [w for w in words if any(map(str.isalpha, w))]


def gram_ids(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all words in one array, and the number of the word each belongs to."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    marked = "\x01" + "\x01\x01".join(words) + "\x01"
    codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), lengths)
    ids, owner = [], []
    for n in GRAMS:
        m = len(codes) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h = (h ^ codes[k : k + m]) * np.uint64(MIX[0])
            h ^= h >> np.uint64(29)
        inside = word[:m] == word[n - 1 :]
        ids.append(((h * np.uint64(MIX[1])) >> np.uint64(64 - HASH_BITS))[inside].astype(np.int64))
        owner.append(word[:m][inside])
    return np.concatenate(ids), np.concatenate(owner)


class Model:
    """Weights of the random field.  ``grams``: (2**HASH_BITS, L); ``lexicon``: word -> language number."""

    def __init__(self, languages: list[str], lexicon: dict[str, int]):
        n = len(languages)
        self.languages, self.lexicon = languages, lexicon
        self.grams = np.zeros((1 << HASH_BITS, n))
        self.entry = np.zeros((n + 1, n))  # the last row: words outside the lexicon
        self.moves = np.zeros((n, n))

    def features(self, words: list[str]):
        ids, owner = gram_ids(words)
        get, other = self.lexicon.get, len(self.languages)
        return ids, owner, np.fromiter((get(w, other) for w in words), np.int64, len(words))

    def emissions(self, features) -> np.ndarray:
        ids, owner, entry = features
        out = self.entry[entry].copy()
        size = np.bincount(owner, minlength=len(entry))
        for label in range(out.shape[1]):
            out[:, label] += np.bincount(owner, weights=self.grams[ids, label], minlength=len(entry)) / size
        return out

    def posteriors(self, words: np.ndarray, lengths: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Label posteriors of every word; ``words`` are row numbers of ``scores``, documents end to end."""
        n_labels = scores.shape[1]
        moves = np.exp(self.moves - self.moves.max())
        potentials = np.exp(scores - scores.max(axis=1, keepdims=True))
        blocks = -(-lengths // BLOCK)
        doc = np.repeat(np.arange(len(lengths)), blocks)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        size = np.minimum(BLOCK, lengths[doc] - nth * BLOCK)
        start = np.repeat(np.cumsum(lengths) - lengths, blocks) + nth * BLOCK
        at = start[:, None] + np.arange(BLOCK)
        inside = np.arange(BLOCK) < size[:, None]
        x = np.ones((len(doc), BLOCK, n_labels))
        x[inside] = potentials[words[at[inside]]]

        def scaled(m, step=0):
            """Each message or matrix divided by its largest entry, in every eighth step (potentials are at most 1)."""
            return m if step % 8 else m / m.max(axis=tuple(range(1, m.ndim)), keepdims=True)

        transfer = np.broadcast_to(np.eye(n_labels), (len(doc), n_labels, n_labels)).copy()
        for t in range(BLOCK):
            moved = (transfer.reshape(-1, n_labels) @ moves).reshape(transfer.shape)
            if t == 0:
                moved[nth == 0] = transfer[nth == 0]
            moved *= x[:, t, None, :]
            live = inside[:, t, None, None]
            transfer = scaled(moved if live.all() else np.where(live, moved, transfer), t)
        # Running products of the blocks of a document, from its start and from its end.
        upto, onward, hop = transfer.copy(), transfer.copy(), 1
        while hop < blocks.max(initial=0):
            late = np.nonzero(nth >= hop)[0]
            joined = scaled(upto[late - hop] @ upto[late])
            early = np.nonzero(nth + hop < blocks[doc])[0]
            joined_on = scaled(onward[early] @ onward[early + hop])
            upto[late], onward[early] = joined, joined_on
            hop *= 2
        forward = np.ones((len(doc), n_labels))
        late = np.nonzero(nth > 0)[0]
        forward[late] = scaled(upto[late - 1].sum(axis=1))
        backward = np.ones((len(doc), n_labels))
        early = np.nonzero(nth + 1 < blocks[doc])[0]
        backward[early] = scaled(onward[early + 1].sum(axis=2))
        alpha = np.empty_like(x)
        for t in range(BLOCK):
            moved = forward @ moves
            if t == 0:
                moved[nth == 0] = 1.0
            forward = scaled(np.where(inside[:, t, None], moved * x[:, t], forward), t)
            alpha[:, t] = forward
        for t in range(BLOCK - 1, -1, -1):
            alpha[:, t] *= backward
            backward = scaled(np.where(inside[:, t, None], (x[:, t] * backward) @ moves.T, backward), t)
        found = alpha[inside]
        return found / found.sum(axis=1, keepdims=True)

    def label(self, texts: list[str]):
        """Per text: its words, and their posteriors as one array for all texts."""
        number = defaultdict(count().__next__)
        split = [words_of(t) for t in texts]
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        ids = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, int(lengths.sum()))
        if not len(ids) or not self.languages:
            return lengths, np.zeros((0, len(self.languages)))
        scores = self.emissions(self.features(list(number)))
        some = lengths > 0
        return lengths, self.posteriors(ids, lengths[some], scores)

    def classify(self, texts: list[str]) -> list[tuple[str, float]]:
        lengths, found = self.label(texts)
        out = [("und", 0.0)] * len(texts)
        if len(found):
            some = np.nonzero(lengths)[0]
            starts = np.r_[0, np.cumsum(lengths[some])[:-1]]
            means = np.add.reduceat(found, starts, axis=0) / lengths[some][:, None]
            best = means.argmax(axis=1)
            for i, label, score in zip(some.tolist(), best.tolist(), means.max(axis=1).tolist(), strict=True):
                out[i] = self.languages[label], min(1.0, score)
        return out


def train(rows: list[tuple[str, str]], seed: int = 7) -> Model:
    """Fit the random field on (text, language) rows by full-batch Adam steps on the log-likelihood."""
    languages = sorted({lang for _, lang in rows})
    code = {x: i for i, x in enumerate(languages)}
    n = len(languages)
    seen = defaultdict(Counter)
    pieces = []
    rng = np.random.default_rng(seed)
    for text, lang in sorted(rows, key=lambda r: (r[1], r[0])):
        words = words_of(text)
        for w in words:
            seen[w][code[lang]] += 1
        at = 0
        while at < len(words):
            size = int(rng.integers(3, SEQUENCE))
            pieces.append((code[lang], words[at : at + size]))
            at += size
    lexicon = {}
    for w, by in seen.items():
        (label, times), total = by.most_common(1)[0], sum(by.values())
        if times >= LEXICON_COUNT and 2 * times > total:
            lexicon[w] = label
    model = Model(languages, lexicon)
    if n < 2:
        return model
    stream = [(w, label) for i in rng.permutation(len(pieces)) for label, words in [pieces[i]] for w in words]
    rows_n = len(stream) // SEQUENCE
    if not rows_n:
        return model
    stream = stream[: rows_n * SEQUENCE]
    number = defaultdict(count().__next__)
    ids = np.array([number[w] for w, _ in stream]).reshape(rows_n, SEQUENCE)
    gold = np.array([label for _, label in stream]).reshape(rows_n, SEQUENCE)
    features = model.features(list(number))
    gram, owner, entry = features
    size = np.bincount(owner, minlength=len(entry))
    weights = [model.grams, model.entry, model.moves]
    memory = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    truth = np.eye(n)[gold]
    pairs = np.zeros((n, n))
    np.add.at(pairs, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
    for step in range(1, ROUNDS + 1):
        x = np.exp(model.emissions(features))[ids]
        moves = np.exp(model.moves)
        alpha, beta = np.empty_like(x), np.empty_like(x)
        f = x[:, 0]
        for t in range(SEQUENCE):
            f = x[:, t] * (f @ moves) if t else f
            f = f / f.sum(axis=1, keepdims=True)
            alpha[:, t] = f
        b = np.ones((rows_n, n))
        expected = np.zeros((n, n))
        for t in range(SEQUENCE - 1, -1, -1):
            beta[:, t] = b
            into = x[:, t] * b
            if t:
                both = alpha[:, t - 1, :, None] * moves * into[:, None, :]
                expected += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b = into @ moves.T
            b = b / b.sum(axis=1, keepdims=True)
        post = alpha * beta
        post /= post.sum(axis=2, keepdims=True)
        error = (truth - post).reshape(-1, n)
        by_word = np.stack([np.bincount(ids.ravel(), weights=error[:, k], minlength=len(entry)) for k in range(n)], axis=1)
        spread = (by_word / size[:, None])[owner]
        slopes = [
            np.stack([np.bincount(gram, weights=spread[:, k], minlength=1 << HASH_BITS) for k in range(n)], axis=1),
            np.stack([np.bincount(entry, weights=by_word[:, k], minlength=n + 1) for k in range(n)], axis=1),
            pairs - expected,
        ]
        for w, g, (m, v) in zip(weights, slopes, memory, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += 0.25 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8) - 0.001 * w
    return model


def held_out():
    """Column: crc32 of doc_id as text divides by 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Train on the bounded sample of ``docs`` (doc_id, text, lang) that the module names."""
    by = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out())
    digest = F.md5(F.col("doc_id").cast("string"))
    # Digests are uniform: the smallest SAMPLE_DOCS of a language lie, but for chance, below four times
    # their share, so only so many rows of a large language are ranked together.  The shares are those of
    # the MAX_LANGUAGES most frequent languages; labels beyond them are not learned.
    sizes = by.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES)
    known = docs.sparkSession.createDataFrame([(r.lang, 4 * sample_docs / r.n) for r in sizes.collect()], "of string, share double")
    place = F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(1 << 48)
    thinned = by.select("doc_id", "lang", place.alias("place")).join(F.broadcast(known), F.col("lang") == F.col("of"))
    thinned = thinned.where(F.col("place") <= F.col("share"))
    ranked = thinned.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy(digest, "doc_id")))
    picked = ranked.where(F.col("nth") <= sample_docs).select(F.col("doc_id").alias("picked")).distinct()
    ids = [r.picked for r in picked.collect()]  # at most sample_docs * MAX_LANGUAGES
    if not ids:
        return Model([], {})
    spark = docs.sparkSession
    room = F.greatest(F.lit(1), F.length("text") - sample_chars)
    start = F.conv(F.substring(digest, 1, 7), 16, 10).cast("int") % room + 1
    sample = by.join(F.broadcast(spark.createDataFrame([(i,) for i in ids], "picked bigint")), F.col("doc_id") == F.col("picked"))
    rows = sample.where("text IS NOT NULL").select(digest.alias("place"), F.substring("text", start, F.lit(sample_chars)).alias("t"), "lang")
    rows = rows.join(F.broadcast(known), F.col("lang") == F.col("of"), "left_semi").distinct().orderBy("place", "t", "lang").limit(len(ids))
    return train([(r.t, r.lang) for r in rows.collect()])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: HASH_BITS, lexicon of the sample

    def work(batches):
        model = shared.value
        for batch in batches:
            found = [x for _, _, texts in text_groups(batch.column(2), GROUP_CHARS) for x in model.classify(texts)]
            langs, scores = ([x[k] for x in found] for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string")).mapInArrow(work, SCHEMA)


def label_words(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang, n_words, from_word): runs of words of one language, in order, of each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        model = shared.value
        names = np.array(model.languages)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for a, b, texts in text_groups(batch.column(1), GROUP_CHARS):
                lengths, found = model.label(texts)
                if not len(found):
                    continue
                best = found.argmax(axis=1)
                doc = np.repeat(np.arange(a, b), lengths)
                first = np.nonzero(np.r_[True, (best[1:] != best[:-1]) | (doc[1:] != doc[:-1])])[0]
                begin = np.cumsum(lengths) - lengths
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[d] for d in doc[first]], pa.int64()),
                        pa.array(names[best[first]].tolist(), pa.string()),
                        pa.array(np.diff(np.r_[first, len(best)])),
                        pa.array(first - begin[doc[first] - a]),
                    ],
                    names=["doc_id", "lang", "n_words", "from_word"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        work, "doc_id bigint, lang string, n_words bigint, from_word bigint"
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Predict every document's language with a model learned from the same table's other folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, learn(docs))


def stage_language(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose text is of a learned language with score of at least MIN_SCORE."""
    shared = spark.sparkContext.broadcast(learn(docs))
    at = docs.columns.index("text")

    def work(batches):
        model = shared.value
        for batch in batches:
            found = [x for _, _, texts in text_groups(batch.column(at), GROUP_CHARS) for x in model.classify(texts)]
            yield batch.filter(pa.array([lang != "und" and score >= MIN_SCORE for lang, score in found], pa.bool_()))

    return docs.mapInArrow(tidy(work), docs.schema)
