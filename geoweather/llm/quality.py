"""Quality rules with suffix-array repetition.

Words are runs of anything but ASCII white space.  Base figures are plain counts.  The
repetition rule sorts the word suffixes of each document (prefix doubling, many documents
at a time in one array, only suffixes that are still tied are sorted again), takes the
longest common prefixes of neighbours, and reads maximal repeated substrings of at least
``MIN_REPEAT`` words off the LCP intervals: an interval is a right-maximal repeat, and a
maximal one if the words before its occurrences differ.  Their spans are united.  A
document fails if they cover more than ``MAX_COVERED`` of its words, or if one repeat is
longer than ``MAX_LONGEST`` words.

Null text counts as empty: no words, base_failed.  Texts are read whole; a partition is
worked off in groups of documents of about ``GROUP_CHARS`` characters, so memory is bounded
by that or by the longest document.  Repeated rows are judged alike; an empty table gives
an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweather.llm.common import table
from geoweather.llm.texts import text_groups

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MIN_REPEAT = 8  # words
MAX_COVERED = 0.40
MAX_LONGEST = 100  # words
GROUP_CHARS = 3_000_000
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " base_failed boolean, kept boolean, covered_words bigint, longest_repeat bigint, n_maximal_repeats bigint"
)


def tied_ranks(words: np.ndarray, doc_of: np.ndarray, doc_end: np.ndarray):
    """Ranks of suffixes by their first 1, 2, 4, ... words: equal rank means equal words in one document.

    Yields (length, ranks) until no two suffixes of a document are tied; ranks carry one
    more entry, -1, for the end of the array.
    """
    n = len(words)
    active = np.arange(n)
    group = np.zeros(n, np.int64)
    key = doc_of * (int(words.max(initial=0)) + 1) + words
    ranks, length = np.full(n + 1, -1, np.int64), 1
    while True:
        order = np.argsort(key, kind="stable")
        sorted_key, old = key[order], group[order]
        place = np.arange(len(order))
        new = np.r_[True, sorted_key[1:] != sorted_key[:-1]][: len(order)]
        new_old = np.r_[True, old[1:] != old[:-1]][: len(order)]
        first = np.maximum.accumulate(np.where(new, place, 0))
        first_old = np.maximum.accumulate(np.where(new_old, place, 0))
        ranks = ranks.copy()
        ranks[active[order]] = old + first - first_old
        yield length, ranks
        tied = ~new | ~np.r_[new[1:], True][: len(order)]
        active = np.sort(active[order[tied]])
        if not len(active):
            return
        group = ranks[active]
        after = active + length
        key = group * (n + 2) + np.where(after < doc_end[active], ranks[np.minimum(after, n)] + 2, 0)
        length *= 2


def common_prefix(levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b (pairwise different positions)."""
    n = len(levels[0][1]) - 1
    a, b, total = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for length, ranks in reversed(levels):
        same = (a < n) & (b < n) & (ranks[np.minimum(a, n)] == ranks[np.minimum(b, n)])
        step = same * length
        a, b, total = a + step, b + step, total + step
    return total


def lcp_intervals(lcp: list[int], least: int):
    """(length, first, last) of each LCP interval of at least ``least``; lcp[i] is between entries i - 1 and i."""
    stack = [(0, 0)]
    for i, value in enumerate([*lcp, 0]):
        start = i - 1
        while stack[-1][0] > value:
            length, start = stack.pop()
            if length >= least:
                yield length, start, i - 1
        if stack[-1][0] < value:
            stack.append((value, start))


def repetition(words: np.ndarray, lengths: np.ndarray, least: int = MIN_REPEAT):
    """Per document: words in repeated 3-word windows, words covered by maximal repeats, longest repeat, maximal repeats."""
    n_docs, n = len(lengths), len(words)
    ends = np.cumsum(lengths)
    doc_of = np.repeat(np.arange(n_docs), lengths)
    zero = np.zeros(n_docs, np.int64)
    if not n:
        return zero, zero, zero, zero
    doc_end = ends[doc_of]
    levels = list(tied_ranks(words, doc_of, doc_end))

    def covered(starts, spans):
        steps = np.bincount(starts, minlength=n + 1) - np.bincount(starts + spans, minlength=n + 1)
        return np.bincount(doc_of, weights=np.cumsum(steps)[:n] > 0, minlength=n_docs).astype(np.int64)

    pairs = dict(levels).get(2)
    windows3 = zero
    if pairs is not None:
        at = np.arange(n)
        at = at[at + 3 <= doc_end]
        _, inverse, times = np.unique(pairs[at] * (n + 1) + levels[0][1][at + 2], return_inverse=True, return_counts=True)
        at = at[times[inverse] > 1]
        windows3 = covered(at, np.full(len(at), 3))
    last = levels[-1][1][:n]
    base = max((x for x in levels if x[0] <= least), key=lambda x: x[0])[1][:n]
    shared = np.bincount(base, minlength=n)[base] > 1
    sa = np.nonzero(shared)[0]
    sa = sa[np.argsort(last[sa], kind="stable")]
    if len(sa) < 2:
        return windows3, zero, zero, zero
    lcp = np.r_[0, common_prefix(levels, sa[:-1], sa[1:])]
    reach = np.maximum(lcp, np.r_[lcp[1:], 0])
    long = reach >= least
    cover = covered(sa[long], reach[long])
    longest = zero.copy()
    np.maximum.at(longest, doc_of[sa[long]], reach[long])
    before = np.where((sa > 0) & (sa - 1 >= (ends - lengths)[doc_of[sa]]), words[np.maximum(sa - 1, 0)], -1 - sa)
    changes = np.cumsum(np.r_[0, before[1:] != before[:-1]])
    repeats = zero.copy()
    for _, first, end in lcp_intervals(np.where(lcp >= least, lcp, 0).tolist(), least):
        if changes[first] != changes[end]:
            repeats[doc_of[sa[first]]] += 1
    return windows3, cover, longest, repeats


def judge_group(texts: list[str]) -> list[tuple]:
    """Rows of SCHEMA, without doc_id, for some texts."""
    number = defaultdict(count().__next__)
    ids, lengths, plain = [], [], []
    for text in texts:
        words = text.encode("utf-8", "surrogatepass").split()
        ids.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        lengths.append(len(words))
        lines = [x for x in text.split("\n") if x.strip(BLANKS)]
        plain.append((len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines))))
    found = repetition(np.concatenate(ids), np.array(lengths))
    rows = []
    for n, (chars, symbols, dup), win, cover, longest, repeats in zip(lengths, plain, *(x.tolist() for x in found), strict=True):
        failed = n < MIN_WORDS or 100 * win > MAX_REPEATED_PERCENT * n
        kept = not failed and cover <= MAX_COVERED * n and longest <= MAX_LONGEST
        rows.append((n, chars, symbols, dup, win, failed, kept, cover, longest, repeats))
    return rows


def _judge(batches):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    for batch in batches:
        for a, b, texts in text_groups(batch.column(1), GROUP_CHARS):
            columns = zip(*judge_group(texts), strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(c) for c in columns)], names=names)


def judge_quality(docs: DataFrame) -> DataFrame:
    """Base figures, verdict and repetition figures (columns of SCHEMA) for each row of ``docs``."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_judge, SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    """Judge every document."""
    return judge_quality(table(spark, sf_dir, "documents"))
