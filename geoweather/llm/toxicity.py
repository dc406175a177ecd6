"""Toxicity by compression distance: two Zstandard dictionaries, window by window.

Texts are read as windows of ``WINDOW`` words (A-Z lower-cased, joined by single blanks), neighbours
sharing ``OVERLAP`` words.  A window's margin is its compressed length with the ordinary dictionary
less that with the toxic one: the bytes that knowing toxic text saves.  Both dictionaries end in the
same bytes, trained on ordinary text; the toxic one has in front of them what is trained on toxic text,
so that the two lengths differ by that part alone.

Each half of the learning sample calibrates dictionaries of the other; the final ones are trained on all of it.  Ordinary samples are words with both
neighbours, a few for each word.  Toxic samples are the words of toxic texts that toxic text
uses more often than ordinary text does, by a log-likelihood ratio over different contexts (so that
copies of a text count once), in the order of the text.

Calibration: the margin that ``WINDOW_QUANTILE`` of the ordinary windows stay at or below is
the window threshold, and a logistic curve over a text's largest margin, its sum of margins above
the threshold and its number of windows gives the score.

Labels are learned from a bounded sample: of the rows with crc32(doc_id) mod 5 <> 0 and a label,
``SAMPLE_TOXIC`` toxic and ``SAMPLE_ORDINARY`` ordinary documents, those with the smallest digest of
doc_id, and ``SAMPLE_CHARS`` characters of each.  Scoring reads whole texts.

Null or blank text has no window: the curve's value at no evidence.  Without labels of both kinds the score is
the share of toxic labels (0 without any).  Several labels of one doc_id count as toxic if one is; a null
doc_id is neither learned from nor held out.  Repeated rows get the same answer; an empty
table gives an empty result; other columns are ignored.  Texts are worked off in groups
of about ``GROUP_CHARS`` characters, or one longer text.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweather.llm.common import table
from geoweather.llm.langid import held_out
from geoweather.llm.texts import folded_words, text_groups

SAMPLE_TOXIC = 1500
SAMPLE_ORDINARY = 3000
SAMPLE_CHARS = 10_000
WINDOW = 12  # words
OVERLAP = 1
LEVEL = 12
ORDINARY_BYTES = 65_536
TOXIC_BYTES = 8_192
SEGMENT = 16  # bytes that the trainer picks at a time
WINDOW_QUANTILE = 0.999
MIN_RATIO = 4.0
MIN_EVIDENCE = 15.0
CONTEXTS_EACH = 3
ORDINARY_SAMPLES = 200_000
GROUP_CHARS = 2_000_000
PUNCTUATION = b".,;:!?\"'()"

SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int, n_windows bigint, top_margin bigint, top_word bigint"


def windows(text: str) -> list[bytes]:
    """Windows of the whole text, each with a blank at both ends."""
    words = folded_words(text)
    step = WINDOW - OVERLAP
    return [b" " + b" ".join(words[i : i + WINDOW]) + b" " for i in range(0, max(1, len(words) - OVERLAP), step)] if words else []


def contexts(texts: list[str]) -> dict[bytes, set[bytes]]:
    """word (without punctuation) -> the different word triples around it."""
    found = defaultdict(set)
    for text in texts:
        words = [b"", *folded_words(text), b""]
        for before, word, after in zip(words, words[1:], words[2:]):
            if bare := word.strip(PUNCTUATION):
                found[bare].add((before + b" " + word + b" " + after).strip())
    return found


def evidence(k1, n1, k0, n0):
    """Log-likelihood ratio of k1 of n1 against k0 of n0."""
    together = (k1 + k0) / (n1 + n0)

    def part(k, n):
        with np.errstate(divide="ignore", invalid="ignore"):
            seen = np.where(k > 0, k * np.log(k / n / together), 0.0)
            rest = np.where(n > k, (n - k) * np.log((1 - k / n) / (1 - together)), 0.0)
        return seen + rest

    return 2 * (part(k1, n1) + part(k0, n0))


def telling_words(toxic: dict[bytes, set], ordinary: dict[bytes, set]) -> list[bytes]:
    """Words that toxic text uses more often than ordinary text, the most frequent first."""
    words = sorted(toxic)
    if not words:
        return []
    k1 = np.array([len(toxic[w]) for w in words], float)
    k0 = np.array([len(ordinary.get(w, ())) for w in words], float)
    n1, n0 = k1.sum(), max(1.0, float(sum(map(len, ordinary.values()))))
    good = (k1 / n1 > MIN_RATIO * k0 / n0) & (evidence(k1, n1, k0, n0) >= MIN_EVIDENCE)
    return [words[i] for i in np.argsort(-k1, kind="stable") if good[i]]


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """Dictionary bytes trained on the samples; the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=SEGMENT, d=6, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[:size]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(content) >= 8 else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False)


@dataclass
class Model:
    """Both dictionaries, the window threshold and the weights of the curve (or a constant score)."""

    ordinary: bytes = b""
    toxic: bytes = b""
    threshold: float = 0.0
    weights: list[float] = field(default_factory=list)
    constant: float = 0.0

    def ready(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """A model with its compressors, which cannot be sent between processes."""

    def __init__(self, model: Model):
        self.model = model
        self.plain, self.toxic = compressor(model.ordinary), compressor(model.toxic + model.ordinary)

    def margins(self, text: str) -> np.ndarray:
        plain, toxic = self.plain.compress, self.toxic.compress
        return np.array([len(plain(w)) - len(toxic(w)) for w in windows(text)], np.int64)

    def features(self, margins: np.ndarray) -> list[float]:
        above = np.maximum(margins - self.model.threshold, 0).sum()
        return [1.0, float(margins.max(initial=0)), float(np.log1p(above)), float(np.log1p(len(margins)))]

    def score(self, margins: np.ndarray) -> float:
        if not self.model.weights:
            return self.model.constant
        z = float(np.dot(self.features(margins), self.model.weights))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton steps; the ridge spares the first weight."""
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - penalty @ w
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, slope)
    return w


def dictionaries(toxic_texts: list[str], ordinary_texts: list[str]) -> Model:
    """A model with both dictionaries and no curve yet."""
    ordinary, toxic = contexts(ordinary_texts), contexts(toxic_texts)
    telling = telling_words(toxic, ordinary)
    known, residues = set(telling), []
    for text in toxic_texts:
        left = [w for w in (x.strip(PUNCTUATION) for x in folded_words(text)) if w in known]
        if left:
            residues.append(b" " + b" ".join(left) + b" ")
    common = [b" " + c + b" " for w in sorted(ordinary) for c in sorted(ordinary[w])[:CONTEXTS_EACH]]
    trained = train_dictionary(list(dict.fromkeys(residues)), TOXIC_BYTES) if residues else b""
    missed = b"".join(b" " + w for w in telling if b" " + w + b" " not in trained)
    stride = max(1, len(common) // ORDINARY_SAMPLES)
    return Model(train_dictionary(common[::stride], ORDINARY_BYTES), missed[:TOXIC_BYTES] + b" " + trained)


def train(rows: list[tuple[str, bool]]) -> Model:
    """Train on (text, toxic) rows: each half calibrates the dictionaries of the other, then both halves make the final ones."""
    by = {kind: list(dict.fromkeys(t for t, toxic in rows if toxic == kind)) for kind in (True, False)}
    if min(map(len, by.values())) < 2:
        return Model(constant=len(by[True]) / max(1, len(by[True]) + len(by[False])))
    kept = []
    for half in (0, 1):
        scorer = dictionaries(by[True][half::2], by[False][half::2]).ready()
        kept += [(scorer.margins(t), kind) for kind in (True, False) for t in by[kind][1 - half :: 2]]
    model = dictionaries(by[True], by[False])
    model.threshold = float(np.quantile(np.concatenate([m for m, kind in kept if not kind] + [np.zeros(1)]), WINDOW_QUANTILE))
    scorer = model.ready()
    x = np.array([scorer.features(m) for m, _ in kept])
    model.weights = fit_curve(x, np.array([kind for _, kind in kept], float)).tolist()
    return model


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on the bounded sample of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) that the module names."""
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out())
    marked = marked.groupBy(F.col("doc_id").alias("of")).agg((F.max("toxic") > 0).alias("toxic"))
    digest = F.md5(F.col("of").cast("string"))
    sample = []
    for kind, most in ((True, SAMPLE_TOXIC), (False, SAMPLE_ORDINARY)):
        sample += [(r.of, kind) for r in marked.where(F.col("toxic") == kind).orderBy(digest, "of").limit(most).collect()]
    if not sample:
        return Model()
    ids = F.broadcast(docs.sparkSession.createDataFrame(sample, "of bigint, kind boolean"))
    found = docs.where("text IS NOT NULL").join(ids, F.col("doc_id") == F.col("of"))
    rows = found.select(digest.alias("place"), F.substring("text", 1, SAMPLE_CHARS).alias("t"), "kind").distinct()
    rows = rows.orderBy("place", "t").limit(SAMPLE_TOXIC + SAMPLE_ORDINARY).collect()
    return train([(r.t, r.kind) for r in rows])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Columns of SCHEMA for each row of ``docs``; top_word is the first word of the window with the largest margin."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the two dictionaries' sizes

    def work(batches):
        scorer = shared.value.ready()
        for batch in batches:
            for a, b, texts in text_groups(batch.column(2), GROUP_CHARS):
                found = [scorer.margins(t) for t in texts]
                scores = [scorer.score(m) for m in found]
                columns = [
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                    pa.array([len(m) for m in found], pa.int64()),
                    pa.array([m.max(initial=0) for m in found], pa.int64()),
                    pa.array([int(m.argmax()) * (WINDOW - OVERLAP) if len(m) else None for m in found], pa.int64()),
                ]
                names = ["doc_id", "held_out", "score", "predicted", "n_windows", "top_margin", "top_word"]
                yield pa.RecordBatch.from_arrays([c.slice(a, b - a) for c in batch.columns[:2]] + columns, names=names)

    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string")).mapInArrow(work, SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    """Score every document with a model learned from the labels of the other folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, learn(docs, table(spark, sf_dir, "labels")))
