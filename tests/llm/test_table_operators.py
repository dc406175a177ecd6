"""WARC bundles, URL filters, mixing, near-duplicates, nearest neighbours and the pipeline against plain versions."""

import base64
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import tiktoken
from conftest import plan_text
from pyspark.sql import functions as F

import corpus_pipeline
from geoweather.llm import ann, bpe, langid, mixing, neardup, pii, urlfilter, warc
from geoweather.llm.components import components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


# ---------------------------------------------------------------- WARC
PAGES = [
    (1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, "same"), (4, "http://c/\r\nX: y", "other é"), (5, "u", None),
    (6, "u", ""), (7, "u", "x" * 700_000), (7, "u", "x" * 700_000), (None, "u", "lost"),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit("clash"))


def test_warc_round_trip_and_revisits(spark):
    bundles = warc.write_bundles(pages(spark))
    got = Counter(tuple(r) for r in warc.read_bundles(bundles).collect())
    want = Counter()
    for page, _, html in PAGES:
        payload = (html or "").encode()
        newest = max((p for p, _, h in PAGES if p is not None and (h or "") == (html or "")), default=None)
        response = page == newest or page is None
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want[(page, len(payload), digest, "response" if response else "revisit", None if response else newest)] += 1
    assert got == want
    ids = spark.createDataFrame([("urn:page:3",), ("urn:page:7",), ("urn:page:99",)], "record string")
    fetched = {r.record: bytes(r.payload) for r in warc.fetch(bundles, ids).collect()}
    assert fetched == {"urn:page:3": b"same", "urn:page:7": b"x" * 700_000}
    assert warc.record_index(bundles).count() == len(PAGES)


def test_warc_seek_table_and_small_payloads(spark, tmp_path):
    got = warc.read_bundles(warc.write_bundles(pages(spark), min_payload=5)).collect()
    assert all(r.record_type == "response" for r in got)  # "same" is below the limit; the long one repeats its own id
    data = warc.write_bundles(pages(spark)).first().data
    entries = warc.seek_table(bytes(data))
    assert sum(c for _, c, _ in entries) + 8 + 8 * len(entries) + 9 == len(data)
    assert warc.export_bundles(warc.write_bundles(pages(spark)), str(tmp_path / "out")) >= 1
    assert warc.read_bundles(warc.write_bundles(pages(spark, []))).count() == 0


def test_warc_query(spark):
    html = {r.page_id: (r.html or "") for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = warc.query(spark, SF).collect()
    assert {r.page_id: r.payload_bytes for r in got} == {k: len(v.encode()) for k, v in html.items()}


# ---------------------------------------------------------------- URL filter
def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    m = min([rest.find(c, n) for c in "?#" if rest.find(c, n) >= 0], default=len(rest))
    return rest[:n].lower(), rest[n:m]


def test_urls(spark):
    urls = [
        "http://a.net/x", "HTTP://X.EXAMPLE.NET/en/1?x#y", "http://example.com/de/", "http://example.com/dex", "https://b.org/fr/1", None,
        "no scheme", "", "http://", "http://bad.org?x=/en/", "http://www.shop.org/a.html", "https://m.shop.org/a/", "http://shop.org/a?utm=1",
        "http://shop.org/b", "http://xexample.com/de/", "a://b://c/d", "http://notnet/en/", "http://net/",
    ]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumn("host", F.lit("clash"))
    listed = spark.createDataFrame([("shop.org/a",), ("other.org/z",)], "url string")
    got = {r.page_id: r for r in urlfilter.judge_urls(df, listed).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        host, path = plain_parts(url)
        fits = [(len(h + p), h + p, act) for act, h, p in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits)[1] if fits else None
        verdict = max(fits)[2] if fits else "block" if i in (10, 11, 12) else "allow"
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), url
    assert urlfilter.judge_urls(df.limit(0), listed).count() == 0
    assert urlfilter.judge_urls(df, listed.limit(0)).where("rule IS NULL AND verdict = 'block'").count() == 0


def test_bloom_filter_has_no_false_negatives(spark):
    listed = spark.range(3000).select(F.concat(F.lit("host/"), "id").alias("url"))
    blocks, n = urlfilter.build_filter(listed)
    assert urlfilter.possible_hits(listed, blocks, n).distinct().count() == 3000
    other = spark.range(10_000).select(F.concat(F.lit("else/"), "id").alias("url"))
    assert urlfilter.possible_hits(other, blocks, n).count() < 500
    plan = urlfilter.judge_urls(spark.read.parquet(f"{SF}/pages.parquet"), listed)._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan


# ---------------------------------------------------------------- mixing
def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: most * sizes[s] for s in over}


def test_mix_targets_and_sampling(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.choice([0, 1, 5, 40]), "en", rng.choice(["a", "b", "b", "b", "é", "Z", None]), 0) for i in range(3000)]
    rows += [(5000, None, "en", "empty", 0), (5001, "one", "en", "tiny", 0), (7, rows[7][1], "en", rows[7][3], 0)]
    df = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash")).withColumn("r", F.lit(1))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 3000, 2)] + [(0, 1, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = mixing.mix_sources(df, labels).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len((text or "").split())
    targets = plain_targets(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 40
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix_sources(df, labels).collect()), key=str)
    assert mixing.mix_sources(df.limit(0), labels).count() == 0
    # quality weighs: good documents are taken more often where a source gives a fraction
    share = {q: np.mean([r.copies for r in got if r.doc_id is not None and r.doc_id < 3000 and r.doc_id % 2 == 0 and (r.doc_id % 4 == 2) == q and r.source == "b"]) for q in (True, False)}
    assert set(share) == {True, False}


# ---------------------------------------------------------------- near-duplicates
def plain_components(rows, width):
    sets = {}
    for i, text in rows:
        w = (text or "").lower().split()
        sets[i] = frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] * bool(w))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("block", [256, 8])
def test_near_duplicates_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(40)]
    texts = []
    base = [rng.choice(words) for _ in range(60)]
    for _ in range(70):  # a group of near copies, some of them only near to others than the base
        edited = [rng.choice(words) if rng.random() < rng.choice([0.02, 0.05, 0.08]) else w for w in base]
        texts.append(" ".join(edited))
    texts += [" ".join([rng.choice(words) for _ in range(60)] + passage) for _ in range(30)]
    texts += [texts[0], texts[0].upper(), "one", "one", "one two", None, "", " ", "short text", "a b c d e", "a b c d e f"]
    rows = [(i * 3, t, "en", "s", 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS).withColumn("digest", F.lit("clash")).withColumn("node", F.lit(0))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, 2).collect()}
    assert got == plain_components([(i, t) for i, t, *_ in rows], 2)


def test_near_duplicate_edges(spark):
    df = spark.createDataFrame([(None, "x y z", "en", "s", 0), (None, "x y z", "en", "s", 0), (4, "x y z", "en", "s", 0), (4, "x y z", "en", "s", 0), (2, "x y z", "en", "s", 0)], DOCS)
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in neardup.near_duplicates(df, 2).collect())
    assert got == [(-1, -1, True), (-1, -1, True), (2, 2, True), (4, 2, False), (4, 2, False)]
    assert neardup.near_duplicates(df.limit(0), 2).count() == 0
    kept = neardup.stage_near_duplicates(spark, df, SF)
    assert kept.columns == df.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, -1, 2]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (7, 7)] + [(500, x) for x in range(501, 560)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()))
    want = {i: 0 for i in range(41)} | {100: 100, 150: 100, 200: 100} | {x: 500 for x in range(500, 560)}
    assert got == want


# ---------------------------------------------------------------- nearest neighbours
def test_nearest_neighbours_recall(spark):
    got = defaultdict(list)
    for r in ann.query(spark, SF).collect():
        got[r.query_id].append(r)
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows])
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:10]
        found = sorted(got[q], key=lambda r: r.rank)
        assert [r.rank for r in found] == list(range(1, 11))
        assert all(r.score == pytest.approx(float(d[ids == r.vec_id][0]), abs=1e-12) for r in found)
        hits += len({r.vec_id for r in found} & set(ids[order].tolist()))
        total += 10
    assert hits / total >= 0.9


def test_nearest_neighbour_edges(spark):
    vectors = [(i, [float(i % 7), 1.0]) for i in range(60)] + [(100, [1.0, 1.0]), (100, [1.0, 1.0])]
    odd = [(200, None), (300, [0.0, 0.0]), (400, [1.0, None]), (500, [math.nan, 1.0]), (600, [math.inf, 1.0]), (700, [1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(vectors + odd, "vec_id bigint, embedding array<float>").withColumn("node", F.lit("clash"))
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest_neighbours(df, df.where("vec_id % 100 = 0")).collect())
    want = []
    for q in (0, 100):
        x = q % 7 if q < 60 else 1
        order = sorted((abs(v[0] - x), i) for i, v in dict(vectors).items() if i != q)[:10]
        want += [(q, n + 1, i, d) for n, (d, i) in enumerate(order)]
    assert got == want
    assert ann.nearest_neighbours(df.limit(0), df).count() == 0
    few = spark.createDataFrame(vectors[:3], "vec_id bigint, embedding array<float>")
    assert ann.nearest_neighbours(few, few).count() == 6


def test_nearest_neighbours_grow_with_the_table(spark, monkeypatch):
    small = {"K": 4, "BEAM": 12, "EXPAND": 6, "BLOCK": 20, "BASE_NODES": 50}
    for name, value in small.items():
        monkeypatch.setattr(ann, name, value, raising=False)
    x = np.random.default_rng(2).normal(size=(3000, 32))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>")
    got = defaultdict(set)
    for r in ann.nearest_neighbours(df, df.where("vec_id % 100 = 0")).collect():
        got[r.query_id].add(r.vec_id)
    hits = 0
    for q in range(0, 3000, 100):
        order = np.argsort(((x - x[q]) ** 2).sum(axis=1))
        hits += len(got[q] & set(order[1:11].tolist()))
    assert hits / 300 >= 0.9


def test_measured_rows_of_a_query_do_not_grow_with_the_table(spark, monkeypatch):
    """With 16 times as many nodes a query's rows grow by less than the root of that, and queries outside the index still find theirs."""
    for name, value in {"K": 12, "BEAM": 40, "EXPAND": 10, "BLOCK": 20, "BASE_NODES": 250}.items():
        monkeypatch.setattr(ann, name, value)
    kept, measured = [], ann.measured

    def counted(*args):
        kept.append(ann.stage(measured(*args), "counted"))
        return kept[-1]

    monkeypatch.setattr(ann, "measured", counted)
    x = np.random.default_rng(5).normal(size=(4020, 16))
    asked = spark.createDataFrame([(10_000 + i, v) for i, v in enumerate(x[4000:].tolist())], "vec_id bigint, embedding array<double>")
    rows = {}
    for n in (250, 4000):
        kept.clear()
        df = spark.createDataFrame([(i, v) for i, v in enumerate(x[:n].tolist())], "vec_id bigint, embedding array<double>")
        got = defaultdict(set)
        for r in ann.nearest_neighbours(df, asked).collect():
            got[r.query_id - 10_000].add(r.vec_id)
        rows[n] = sum(k.count() for k in kept)
        near = [set(np.argsort(((x[:n] - x[4000 + q]) ** 2).sum(axis=1))[:10].tolist()) for q in range(20)]
        assert sum(len(got[q] & near[q]) for q in range(20)) / 200 >= 0.9
    assert rows[4000] <= 4 * rows[250]


def test_nearest_neighbour_rounds_and_steps_take_few_shuffles(spark, monkeypatch):
    """Each shuffle costs as many tasks as there are partitions; the tables that the rounds write are no crowd of tiny files."""
    for name, value in {"K": 6, "BEAM": 20, "EXPAND": 8, "BLOCK": 20}.items():
        monkeypatch.setattr(ann, name, value)
    shuffles, files, stage = defaultdict(list), defaultdict(list), ann.stage

    def counted(df, name, **options):
        shuffles[name].append(plan_text(df).count("Exchange hashpartitioning"))
        staged = stage(df, name, **options)
        files[name].append(len(staged.inputFiles()))
        return staged

    monkeypatch.setattr(ann, "stage", counted)
    x = np.random.default_rng(3).normal(size=(600, 8)).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        assert ann.nearest_neighbours(df, df.where("vec_id % 100 = 0")).count() == 60
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    cores = spark.sparkContext.defaultParallelism
    assert len(shuffles["ann-graph"]) > 1 and max(shuffles["ann-graph"]) <= 4
    assert len(shuffles["ann-beam"]) > 2 and max(shuffles["ann-beam"][1:]) <= 4
    assert max(files["ann-graph"] + files["ann-beam"]) <= max(8, cores)


def test_nearest_neighbours_send_no_unpacked_rows_to_every_task(spark, monkeypatch):
    """Lists are packed in files smaller than any limit of Spark's; what they unpack to passes the driver only up to ``WHOLE`` bytes."""
    for name, value in {"K": 6, "BEAM": 20, "EXPAND": 8, "BLOCK": 20}.items():
        monkeypatch.setattr(ann, name, value)
    plans, stage = defaultdict(list), ann.stage

    def seen(df, name, **options):
        plans[name].append(plan_text(df))
        return stage(df, name, **options)

    monkeypatch.setattr(ann, "stage", seen)
    x = np.random.default_rng(4).normal(size=(600, 8)).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    rows = {}
    for whole in (16_000_000, 0):
        plans.clear()
        monkeypatch.setattr(ann, "WHOLE", whole, raising=False)
        rows[whole] = sorted(map(tuple, ann.nearest_neighbours(df, df.where("vec_id % 100 = 0")).collect()))
    assert len(plans["ann-graph"]) > 1 and len(plans["ann-beam"]) > 2
    assert not [p for p in plans["ann-graph"] + plans["ann-beam"][1:] if "Broadcast" in p]
    assert len({str(r) for r in rows.values()}) == 1


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages_in_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language id", "near duplicates", "pii", "mix sources", "byte bpe"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = langid.learn(docs)
    ids = sorted(texts)
    said = dict(zip(ids, model.classify([texts[i] or "" for i in ids]), strict=True))
    want = {i for i, (lang, score) in said.items() if lang != "und" and score >= langid.MIN_SCORE}
    for name, fn in corpus_pipeline.STAGES[:2]:
        docs = fn(spark, docs, SF).cache()
        assert docs.columns == columns
        if name == "language id":
            assert {r.doc_id for r in docs.collect()} == want
    groups = plain_components([(i, texts[i]) for i in sorted(want)], 5)
    assert sorted(r.doc_id for r in docs.collect()) == sorted({c for _, c in groups.values()})


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100


# ---------------------------------------------------------------- repeated and null ids
def test_mix_cuts_row_by_row_under_equal_and_null_ids(spark):
    rows = [(None if i < 800 else i, f"{'w ' * 15}{i % 300}", "en", "a", 0) for i in range(1000)]
    rows += [(7, "same words here", "en", "a", 0)] * 40 + [(5000 + i, "v " * 30, "en", "b", 0) for i in range(900)]
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.mix_sources(df, None).collect()
    assert len(got) == len(rows)
    for source in "ab":
        mine = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 30
        copies = {r.copies for r in mine}
        assert len(copies) <= 2 and max(copies) - min(copies) <= 1
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix_sources(df, None).collect()), key=str)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    con.register("labels", labels.toArrow())
    found = con.execute(mixing.ORACLE_SQL).fetchall()
    plain = sorted(((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got), key=str)
    assert sorted(found, key=str) == plain
    staged = mixing.stage_mix(spark, df, SF)
    assert staged.columns == df.columns


def test_stage_mix_gives_the_copies_of_the_mix(spark):
    rows = [(i % 50 if i % 3 else None, f"text {i % 60} " * 6, "en", "a" if i % 4 else "b", i) for i in range(400)]
    df = spark.createDataFrame(rows, DOCS).withColumn("digest", F.lit("clash")).withColumn("copies", F.lit(9))
    want = defaultdict(int)
    for r in mixing.mix_sources(df, spark.read.parquet(f"{SF}/labels.parquet")).collect():
        want[r.doc_id, r.source, r.digest] += r.copies
    got = defaultdict(int)
    for r in mixing.stage_mix(spark, df, SF).collect():
        got[r.doc_id, r.source, hashlib.md5(r.text.encode()).hexdigest()] += 1
    assert got == {k: n for k, n in want.items() if n}
    assert mixing.stage_mix(spark, df.limit(0), SF).count() == 0


def test_near_duplicates_keep_all_texts_of_a_repeated_id(spark):
    rng = random.Random(4)

    def text(n=60):
        return " ".join(f"w{rng.randrange(900)}" for _ in range(n))

    a, b, c, d = text(), text(), text(), text()
    near_b, near_c = b + " end", c.replace(c.split()[0], "zz", 1)
    rows = [(1, a), (1, b), (2, near_b), (3, c), (4, near_c), (4, d), (5, d), (6, text()), (1, a), (9, ""), (9, None), (9, " ")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).withColumn("text_key", F.lit(1)).withColumn("group_id", F.lit(2))
    got = {(r.doc_id, r.text_key): r.component_id for r in neardup.near_duplicates(df, 5).collect()}
    key = {t: spark.createDataFrame([(t,)], "text string").select(neardup.text_key()).first()[0] for _, t in rows if t}
    assert [got[i, key[t]] for i, t in rows[:8]] == [1, 1, 1, 3, 3, 4, 4, 6]
    kept = neardup.stage_near_duplicates(spark, df, SF)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text and r.text.strip()) == sorted([(1, a), (1, b), (3, c), (4, d), (6, rows[7][1])])
    assert {r.doc_id for r in kept.collect()} == {1, 3, 4, 6, 9}


def test_near_duplicates_of_long_texts(spark):
    long = " ".join(f"w{i % 7919}" for i in range(60_000))
    df = spark.createDataFrame([(1, long, "en", "s", 0), (2, long + " more", "en", "s", 0), (3, "other", "en", "s", 0)], DOCS)
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df, 5).collect()} == {1: 1, 2: 1, 3: 3}


def test_last_three_stages_equal_plain_versions(spark):
    """Masked texts from the operator's spans, copies by the SQL of the mix, ids by the tiktoken library."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(120)
    ranks = bpe.codec(bpe.VOCABULARY, bpe.PATTERN).transducer.ranks
    library = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    masked = pii.stage_pii(spark, docs, SF).cache()
    spans = {r.doc_id: r.spans for r in pii.find_pii(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in masked.collect():
        cut = [tuple(map(int, s.split(":")[1:])) for s in (spans[r.doc_id] or "").split(",") if s]
        inside = {i for a, b in cut for i in range(a, b)}
        rest = "".join(ch for i, ch in enumerate(texts[r.doc_id]) if i not in inside)
        assert re.sub(r"<[A-Z]+>", "", r.text) == re.sub(r"<[A-Z]+>", "", rest)
    con = duckdb.connect()
    con.register("documents", masked.toArrow())
    con.execute(f"CREATE VIEW labels AS SELECT * FROM read_parquet('{SF}/labels.parquet')")
    size = {i: n for i, n, *_ in con.execute(mixing.ORACLE_SQL).fetchall()}
    copies = {i: taken // n if n else None for i, n, _, _, taken in con.execute(mixing.ORACLE_SQL).fetchall()}
    mixed = mixing.stage_mix(spark, masked, SF).cache()
    times = Counter(r.doc_id for r in mixed.collect())
    assert all(times.get(i, 0) == n for i, n in copies.items() if size[i])
    out = bpe.stage_encode(spark, mixed, SF).collect()
    text = {r.doc_id: r.text for r in masked.collect()}
    assert Counter(r.doc_id for r in out) == times
    for r in out:
        ids = library.encode_ordinary(text[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
