"""Lexical search against a plain version; toxicity by held-out accuracy and edge cases."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from geoweather.llm import lexsearch, toxicity
from geoweather.llm.common import table

DOCS = "doc_id bigint, text string, score double, bag int, item_id int"
ITEMS = "item_id bigint, text string, doc_id int"


def plain_terms(text):
    out, run = [], ""
    for ch in (text or "") + " ":
        if ord(ch) > 127 or ch.isascii() and ch.isalnum():
            run += ch.lower() if "A" <= ch <= "Z" else ch
        elif run:
            out.append(run)
            run = ""
    return out


def plain_search(docs, items, k=10):
    split = [(d, plain_terms(t)) for d, t in docs]
    n_docs, n_terms = sum(1 for _, t in split if t), sum(len(t) for _, t in split)
    df = Counter(w for _, t in split for w in set(t))
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, words in split:
            tf, m = Counter(words), 25 + (75 * len(words) * n_docs) // max(1, n_terms)
            total = 0
            for w in plain_terms(text):
                if tf[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    total += weight * ((1_000_000_000 * tf[w]) // (1000 * tf[w] + 8 * m))
            if total > 0:
                scored.append((-total, doc_id is None, doc_id or 0))
        for rank, (total, null, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item_id, rank, None if null else doc_id, -total))
    return sorted(out, key=str)


def corpus(seed=3):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "été", "x1", "delta", "epsilon", "zeta"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 12)))) for i in range(300)]
    docs += [(rng.randrange(10**6), "alpha beta, alpha") for _ in range(150)]  # one class of a third of all rows
    docs += [(5, docs[5][1]), (None, "alpha beta, alpha"), (900, None), (901, ""), (902, "---"), (903, "zeta " * 50_000)]
    items = [(1, "Alpha alpha BETA"), (2, "été x1!"), (3, None), (4, ""), (5, "nowhere"), (6, "zeta gamma gamma"), (6, "delta"), (7, "alpha beta alpha")]
    return docs, items


def searched(spark, docs, items, **more):
    d = spark.createDataFrame([(i, t, 0.5, 1, 2) for i, t in docs], DOCS).repartition(7)
    got = lexsearch.search(d, spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS), **more).collect()
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=str)


@pytest.mark.parametrize("block_chars", [10**6, 20])
def test_search_equals_plain_version_in_one_or_many_blocks(spark, block_chars):
    docs, items = corpus()
    assert searched(spark, docs, items, block_chars=block_chars) == plain_search(docs, items)


def test_search_of_empty_tables(spark):
    docs, items = corpus()
    assert searched(spark, [], items) == []
    assert searched(spark, docs, []) == []


def test_classes_tell_colliding_bags_apart(spark):
    docs, items = corpus()
    vocabulary = sorted({w for _, t in items for w in plain_terms(t)})
    d = spark.createDataFrame([(i, t, 0.5, 1, 2) for i, t in docs], DOCS)
    found = lexsearch.bags(d, vocabulary).withColumn("m", F.lit(25).cast("long") + F.col("n"))
    for key in (None, F.lit(b"same").cast("binary"), F.unhex(F.format_string("%02x", F.col("n") % 3))):
        one, members = lexsearch.classes(found, key)
        got = members.join(one, "class").select("doc_id", "m", "bag").collect()
        assert sorted(map(str, got)) == sorted(map(str, found.where("length(bag) > 0").select("doc_id", "m", "bag").collect()))
        assert one.count() == found.where("length(bag) > 0").select("m", "bag").distinct().count()


def test_terms_are_the_stated_pattern():
    text = "Ab-c1_É x\x00y{z}~ÄÖ 9"
    assert lexsearch.terms(text) == plain_terms(text) == [w.translate(lexsearch.FOLD) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]


TEXTS = "doc_id bigint, text string, held_out int, score string"
LABELS = "doc_id bigint, toxic int, quality int"


def planted(n=400, seed=5):
    rng = random.Random(seed)
    syllables = ["an", "the", "or", "ti", "re", "ou", "in", "st", "ha", "ed"]
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(20, 200))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randint(2, 6)):
                words[rng.randrange(len(words))] = rng.choice(["grumbix", "Snarkol,", "vexpod"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic), 0))
    return docs, labels


def scored(spark, docs, labels):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], TEXTS)
    model = toxicity.learn(d, spark.createDataFrame(labels, LABELS))
    return toxicity.score(d, model).collect()


def test_toxicity_on_held_out_documents_and_edge_cases(spark):
    docs, labels = planted()
    edge = [(1000, None), (1001, ""), (1002, " \n "), (1003, "an the or " * 30_000), (1004, "an the or " * 20_000 + "grumbix vexpod snarkol " + "ti re " * 9), (None, docs[0][1]), (3, docs[3][1])]
    labels += [(1000, None, 1), (None, 1, 1), (0, 0, 0)]
    got = scored(spark, docs + edge, labels)
    assert len(got) == len(docs) + len(edge) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    wrong = sum(r.predicted != int(r.doc_id % 4 == 0) for r in got if r.held_out and r.doc_id is not None and r.doc_id < 1000)
    assert wrong <= 3 and sum(r.held_out for r in got) > 50
    assert [by[i][0].n_windows for i in (1000, 1001, 1002)] == [0, 0, 0] and by[1000][0].predicted == 0
    assert by[1003][0].predicted == 0 and by[1004][0].predicted == 1
    assert by[1004][0].top_word >= 59_900
    assert by[3][0].score == by[3][1].score and by[None][0].predicted == 1 and not by[None][0].held_out


def test_toxicity_without_labels_of_both_kinds(spark):
    docs, labels = planted(30)
    assert {r.score for r in scored(spark, docs, [])} == {0.0}
    assert {r.score for r in scored(spark, docs, [x for x in labels if x[1]])} == {1.0}
    assert scored(spark, [], labels) == []


def test_labels_of_held_out_documents_change_nothing(spark):
    docs, labels = planted(120)
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], TEXTS)
    out = {r.doc_id for r in d.where(toxicity.held_out()).collect()}
    turned = [(i, 1 - t if i in out else t, q) for i, t, q in labels]
    first, second = (toxicity.learn(d, spark.createDataFrame(x, LABELS)) for x in (labels, turned))
    assert first == second


def test_windows_cover_the_whole_text():
    text = " ".join(f"w{i}" for i in range(1000))
    found = toxicity.windows(text)
    assert set(b" ".join(found).split()) == set(text.encode().split())


def test_held_out_accuracy_on_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity.query(spark, sf).where("held_out").join(table(spark, sf, "labels"), "doc_id").select("predicted", "toxic").collect()
    clean = [r.predicted for r in got if r.toxic == 0]
    toxic = [r.predicted for r in got if r.toxic == 1]
    assert sum(clean) / len(clean) < 0.05 and sum(toxic) / len(toxic) > 0.6
