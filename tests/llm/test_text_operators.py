"""PII, byte BPE, language-model scores, quality rules and language ID against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken

from geoweather.llm import bpe, langid, lm, pii, quality

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# A row of each awkward kind: null text, empty, blank, a tie, a repeated row, a null id, a very long text.
LONG = "ab cd " * 40_000 + "x" * 100_000
AWKWARD = [
    (1, None, "en", "s", 0), (2, "", None, "s", 0), (3, " \t\n\x0b", "en", None, 4), (4, "Same words here", "en", "s", 15),
    (5, "Same words here", "en", "s", 15), (5, "Same words here", "en", "s", 15), (None, "no id", "en", "s", 5), (6, LONG, "en", "s", 1),
]


def awkward(spark, extra=""):
    df = spark.createDataFrame(AWKWARD, DOCS)
    for name in extra.split():
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# ---------------------------------------------------------------- PII
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    def luhn(digits):
        values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return sum(v - 9 if v > 9 else v for v in values) % 10 == 0

    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if max(map(int, m.group().split("."))) <= 255]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_base_spans_match_plain_patterns():
    rng = random.Random(3)
    bits = ["1", "25", "256", "0", ".", ".", "@", "a", "b.c", "-", " ", "+", "(", ")", "_", "é", "4111111111111111", "\n"]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" + " " * 200_000):
        pii.scan_text(text)


def test_pii_query(spark):
    got = {r.doc_id: r for r in pii.query(spark, SF).collect()}
    for r in documents(spark).collect():
        spans = plain_spans(r.text or "")
        said = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        g = got[r.doc_id]
        assert (g.n_email, g.n_ip, g.n_card, g.n_phone) == tuple(sum(k == x for k, _, _ in spans) for x in range(4))
        assert g.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert set(said.split(",")) <= set(g.spans.split(","))


def test_context_discovers_unseen_identifiers(spark):
    rows = [(i, f"please write mail to: user{i}@host{i}.org thanks", "en", "s", 0) for i in range(30)]
    rows += [(100, "please write mail to: hidden[at]host.org thanks", "en", "s", 0), (101, "see hidden2[at]host.org elsewhere", "en", "s", 0)]
    got = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, DOCS)).collect()}
    start = rows[30][1].index("hidden")
    assert got[100].spans == f"email:{start}:{start + len('hidden[at]host.org')}" and got[100].n_added == 1 and got[100].n_email == 0
    assert got[101].spans == ""


def test_context_discovers_addresses(spark):
    rows = [(i, f"server address: 10.0.{i}.7 is down", "en", "s", 0) for i in range(30)]
    new = ["10[.]0[.]0[.]9", "10 dot 4 dot 0 dot 9", "10(dot)5(dot)0(dot)9", "2001:db8::8a2e:370:7334", "1:2:3:4:5:6:7:8"]
    rows += [(100 + i, f"server address: {x} is down", "en", "s", 0) for i, x in enumerate(new)]
    clean = ["300[.]0[.]0[.]9", "12:30:45", "std::map", "a::b::c", "1" * 25, "1234 5678 " * 6]
    rows += [(200 + i, f"server address: {x} is down", "en", "s", 0) for i, x in enumerate(clean)]
    rows += [(300, "elsewhere 10[.]0[.]0[.]8 said", "en", "s", 0)]
    got = {r.doc_id: r.spans for r in pii.find_pii(spark.createDataFrame(rows, DOCS)).collect()}
    assert [got[100 + i] for i in range(len(new))] == [f"ip:16:{16 + len(x)}" for x in new]
    assert not any(got[i] for i in got if i >= 200)


def plain_believed(rows):
    """The scored graph by plain loops over (kind, looks, instance, patterns) of all finds."""
    edges = {(p, i) for _, _, i, ps in rows for p in ps}
    seeds = {(i, k): 1.0 for k, _, i, _ in rows if k >= 0}
    known = {i for i, _ in seeds}
    looks = {}
    for k, look, i, _ in rows:
        if k < 0 and i not in known:
            looks[i] = looks.get(i, 0) | look
    members, contexts = {}, {}
    for p, i in edges:
        members.setdefault(p, set()).add(i)
        contexts.setdefault(i, set()).add(p)
    taken = {}
    while True:
        belief = seeds | taken
        share = {}
        for p, instances in members.items():
            for k in range(4):
                support = sum(belief.get((i, k), 0.0) for i in instances)
                if support >= pii.MIN_SUPPORT and support / len(instances) >= pii.MIN_SHARE:
                    share[p, k] = support / len(instances)
        new = {}
        for i, look in looks.items():
            for k in range(4):
                found = [max(1e-9, 1 - share[p, k]) for p in contexts.get(i, ()) if (p, k) in share]
                if look >> k & 1 and found and 1 - math.prod(found) >= pii.MIN_BELIEF:
                    new[i, k] = 1 - math.prod(found)
        if len(new) == len(taken):
            return set(new)
        taken = new


def test_scored_graph_matches_plain_loops(spark):
    rng = random.Random(5)
    ways = [lambda n: f"u{n}@h{n}.org", lambda n: f"u{n}[at]h{n}.org", lambda n: f"10.0.{n % 250}.{n % 9}", lambda n: f"10[.]0[.]{n % 250}[.]7", lambda n: f"+49 30 555{n:04d}", lambda n: f"030-555{n:04d}"]
    texts = []
    for n in range(500):
        kind = rng.randrange(3)
        said = [["mail", "write", "to"], ["host", "server", "at"], ["call", "phone", "dial"]][kind if rng.random() < 0.97 else rng.randrange(3)]
        texts.append(f"{rng.choice(said)} {rng.choice(said)} {ways[2 * kind + (rng.random() < 0.09)](n % 400)} {rng.choice(said)} now")
    # a chain: each context is learned from identifiers that the one before has discovered
    texts += [f"far s0 u{j}@seed.org" for j in range(1500)]
    for step, n in enumerate((300, 60, 12, 2)):
        texts += [f"far s{k} u{j}[at]c{step}.org" for k in (step, step + 1) for j in range(n)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)
    scanned = pii.scan(df).cache()
    rows = [(f.kind, f.looks, f.instance, f.patterns) for r in scanned.collect() for f in r.found]
    want = plain_believed(rows)
    got = {(r.instance, r.kind) for r in pii.believed(scanned).collect()}
    assert got == want and len(want) > 374 and {k for _, k in want} == {0, 1, 3}
    rows = [(f.kind, f.looks, f.instance, f.patterns) for r in pii.scan(documents(spark)).collect() for f in r.found]
    got = {(r.instance, r.kind) for r in pii.believed(pii.scan(documents(spark))).collect()}
    assert got == plain_believed(rows)


def test_pii_edges_and_stage(spark):
    got = pii.find_pii(awkward(spark, "n_email spans found")).collect()
    assert len(got) == len(AWKWARD) and all(r.spans == "" for r in got)
    assert pii.find_pii(empty(spark)).count() == 0
    df = spark.createDataFrame([(1, "a@b.com and 10.0.0.1", "en", "s", 20), (2, None, "en", "s", None)], DOCS)
    out = {r.doc_id: (r.text, r.n_chars) for r in pii.stage_pii(spark, df, SF).collect()}
    assert out == {1: ("<EMAIL> and <IP>", 16), 2: (None, None)}


# ---------------------------------------------------------------- BPE
@pytest.fixture(scope="module")
def codec():
    return bpe.codec(bpe.VOCABULARY, bpe.PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=codec.transducer.ranks, special_tokens={})


def test_codec_equals_library(codec, library):
    rng = random.Random(1)
    bits = ["a", "b", "ab", "é", "ñ", "日本", " ", "  ", "\n", "\x1c", "\x85", "\xa0", "²", "½", "ǅ", "1", "23", "!", "🙂", "the", "tion", "'s", "\u0301", "A"]
    for _ in range(1500):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 60)))
        assert codec.encode(text) == library.encode_ordinary(text)
        assert codec.decode(codec.encode(text)) == text
    for text in ("a" * 3000, "é" * 1000, "abcdefghij" * 300):
        assert codec.encode(text) == library.encode_ordinary(text)


def test_states_are_rebuilt_when_full(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 50)
    small = bpe.Transducer(codec.transducer.ranks)
    for word in ("internationalisation", "überraschungsgäste", "zzzzxxyyq"):
        assert small.encode(word.encode()) == library.encode_ordinary(word)
    assert len(small.states) <= 52


def test_utf8_machine_streams_and_replaces(codec):
    machine = codec.machine
    for data in ("héé日🙂".encode(), b"\xe6\x97", b"\xf0\x9f\x99a", b"\xc0\xaf\xff", b"\xed\xa0\x80", b"\xe2\x82\xac\xe2\x82"):
        pending, text = b"", ""
        for i in range(len(data)):
            more, pending = machine.move(pending, data[i : i + 1])
            text += more
        assert text + "\ufffd" * bool(pending) == data.decode("utf-8", "replace")


def test_bpe_query(spark, library):
    got = {r.doc_id: r for r in bpe.query(spark, SF).collect()}
    for r in documents(spark).collect():
        ids = library.encode_ordinary(r.text or "")
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert g.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() and g.decoded_chars == len(r.text or "")


def test_bpe_edges(spark):
    got = bpe.encode_documents(awkward(spark, "n_tokens ids_sha256")).collect()
    assert len(got) == len(AWKWARD) and {r.n_tokens for r in got if r.doc_id in (1, 2)} == {0}
    back = bpe.decode_ids(bpe.token_ids(awkward(spark))).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((i, t or "") for i, t, *_ in AWKWARD)
    assert bpe.encode_documents(empty(spark)).count() == 0


# ---------------------------------------------------------------- language model
def plain_scores(rows, order):
    words = {n: [w for w in re.split(rb"[ \t-\r]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode()) if w] for n, t in enumerate(rows)}

    def grams(w):
        c = Counter(tuple(w[j : j + k]) for k in range(1, order + 1) for j in range(len(w) - k + 1))
        c[()] = len(w)
        return c

    everything = Counter()
    for w in words.values():
        everything.update(grams(w))
    out = []
    for w in words.values():
        own, total = grams(w), 0.0
        for j in range(len(w)):
            most = min(order, j + 1)
            for k in range(most, 0, -1):
                g = tuple(w[j - k + 1 : j + 1])
                if everything[g] > own[g]:
                    total += math.log((everything[g] - own[g]) / (everything[g[:-1]] - own[g[:-1]])) + (most - k) * math.log(0.4)
                    break
            else:
                total += -math.log(everything[()] - own[()] + 1) + most * math.log(0.4)
        out.append((len(w), total))
    return out


@pytest.mark.parametrize(("order", "chars"), [(1, 20_000), (2, 6_000_000), (2, 20_000), (3, 20_000), (5, 20_000), (5, 6_000_000)])
def test_scores_match_plain_counts(spark, order, chars):
    rows = documents(spark).select("doc_id", "text").orderBy("doc_id").limit(60).collect()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in lm.score_documents(df, order, chars).collect()}
    for r, (n, total) in zip(rows, plain_scores([r.text for r in rows], order), strict=True):
        assert got[r.doc_id].n_words == n and got[r.doc_id].log_score == pytest.approx(total, rel=1e-9)


def test_query_scores_match_plain_counts_on_whole_table(spark):
    rows = documents(spark).select("doc_id", "text").orderBy("doc_id").collect()
    want = {r.doc_id: x for r, x in zip(rows, plain_scores([r.text for r in rows], lm.ORDER), strict=True)}
    got = {r.doc_id: (r.n_words, r.log_score) for r in lm.query(spark, SF).collect()}
    assert got.keys() == want.keys()
    assert all(got[k][0] == n and got[k][1] == pytest.approx(total, rel=1e-9) for k, (n, total) in want.items())


def test_scores_of_repeated_groups(spark, monkeypatch):
    """Equal groups of equal rows share an id; each counts for the other."""
    texts = ["a b c d e f", "a b c x", "", "b c d e", "q r s", None]
    df = spark.createDataFrame([(i % 6, texts[i % 6]) for i in range(24)], "doc_id bigint, text string").repartition(5, "doc_id")
    for buckets in (1 << 20, 8):
        monkeypatch.setattr(lm, "BUCKET_BYTES", buckets)
        got = {(r.doc_id, r.log_score) for r in lm.score_documents(df, 5, 1).collect()}
        assert len(got) == 6
        for i, total in got:
            assert total == pytest.approx(plain_scores(texts * 4, 5)[i][1], rel=1e-9)


def test_score_query_uses_long_contexts(spark, tmp_path):
    texts = ["a b c d e", "a b c d e", "x b c d f", "y z c d g", "q q q d h"] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.log_score for r in lm.query(spark, str(tmp_path)).collect()}
    for n, (_, total) in enumerate(plain_scores(texts, 5)):
        assert got[n] == pytest.approx(total, rel=1e-9)


def test_score_edges(spark):
    got = lm.score_documents(awkward(spark, "bucket n_words id"), chars=50).collect()
    assert len(got) == len(AWKWARD) and all(r.mean_score is None and r.log_score == 0 for r in got if r.n_words == 0)
    same = {r.log_score for r in got if r.doc_id in (4, 5)}
    assert len(same) == 1
    assert lm.score_documents(empty(spark)).count() == 0


def test_sorted_hashes_pack_and_unpack():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 5000):
        for top in (1 << 20, 1 << 63):
            h = np.unique(rng.integers(0, top, n, dtype=np.uint64))
            assert not len(h) or (lm.unpack_sorted(lm.pack_sorted(h)) == h).all()
            assert (lm.opened(lm.squeezed(h), np.uint64) == h).all()
            numbers = rng.integers(0, len(h), 3 * n).astype(np.uint32) if n else np.zeros(0, np.uint32)
            vocabulary, packed = lm.packed_words(h[::-1], numbers)
            assert (lm.unpacked_vocabulary(vocabulary)[lm.opened(packed, np.uint32)] == h[::-1][numbers]).all()


# ---------------------------------------------------------------- quality
def plain_quality(text):
    words = [w for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    triples = Counter(zip(words, words[1:], words[2:]))
    in3 = {i + k for i in range(len(words) - 2) if triples[tuple(words[i : i + 3])] > 1 for k in range(3)}
    longest, cover = 0, set()
    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            n = 0
            while j + n < len(words) and words[i + n] == words[j + n]:
                n += 1
            if n >= quality.MIN_REPEAT:
                longest = max(longest, n)
                cover |= set(range(i, i + n)) | set(range(j, j + n))
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(in3), len(cover), longest


def test_quality_matches_brute_force():
    rng = random.Random(5)
    texts = ["", " \n", "a", "a a a a a a a a a a a a"]
    for _ in range(60):
        line = " ".join(rng.choice("abcdef") for _ in range(rng.randint(1, 14)))
        parts = [rng.choice([line, " ".join(rng.choice("abcdefghijklmnop#é") for _ in range(rng.randint(0, 20)))]) for _ in range(rng.randint(1, 12))]
        texts.append(rng.choice(["\n", " ", "\r\n"]).join(parts))
    for text, row in zip(texts, quality.judge_group(texts), strict=True):
        n, chars, symbols, dup, win, failed, kept, cover, longest, repeats = row
        assert (n, chars, symbols, dup, win, cover, longest) == plain_quality(text), text
        assert failed == (n < 50 or 100 * win > 50 * n) and (not kept or not failed) and (repeats > 0) == (longest > 0)


def test_quality_query_and_edges(spark):
    got = {r.doc_id: r for r in quality.query(spark, SF).collect()}
    assert set(got) == {r.doc_id for r in documents(spark).select("doc_id").collect()}
    assert sum(r.kept for r in got.values()) > len(got) / 2
    edge = quality.judge_quality(awkward(spark, "n_words kept")).collect()
    assert len(edge) == len(AWKWARD) and not any(r.kept for r in edge)
    assert quality.judge_quality(empty(spark)).count() == 0


def test_lcp_intervals():
    found = set(quality.lcp_intervals([0, 2, 3, 3, 0, 1], 1))
    assert found == {(3, 1, 3), (2, 0, 3), (1, 4, 5)}


# ---------------------------------------------------------------- language ID
def test_messages_match_plain_forward_backward():
    rng = np.random.default_rng(0)
    model = langid.Model(["a", "b", "c"], {})
    model.moves = rng.normal(size=(3, 3))
    lengths = np.array([1, 5, 32, 33, 64, 100])
    scores = rng.normal(size=(lengths.sum(), 3))
    found, at = model.posteriors(np.arange(len(scores)), lengths, scores), 0
    for n in lengths:
        x, moves = np.exp(scores[at : at + n]), np.exp(model.moves)
        forward, backward = [x[0]], [np.ones(3)]
        for t in range(1, n):
            forward.append((forward[-1] @ moves) * x[t])
            backward.append(moves @ (x[n - t] * backward[-1]))
        both = np.array(forward) * np.array(backward[::-1])
        assert np.allclose(found[at : at + n], both / both.sum(axis=1, keepdims=True))
        at += n


def test_language_held_out_accuracy(spark):
    got = {r.doc_id: r for r in langid.query(spark, "/root/testdata/sf0.01").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    right = [got[r.doc_id].lang_pred == r.lang for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert len(right) > 100 and sum(right) / len(right) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_code_switched_words_are_split(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.learn(docs)
    clean = {lang: docs.where(f"lang = '{lang}' AND n_chars > 400").orderBy("doc_id").first().text[:300] for lang in ("de", "fr")}
    mixed = spark.createDataFrame([(1, clean["fr"] + " " + clean["de"])], "doc_id bigint, text string")
    runs = langid.label_words(mixed, model).orderBy("from_word").collect()
    assert runs[0].lang == "fr" and runs[-1].lang == "de"


def test_language_edges(spark):
    df = awkward(spark, "lang_pred score held").unionByName(spark.createDataFrame([(9, "123 ½ ²", "en", "s", 1)], DOCS), allowMissingColumns=True)
    got = langid.identify(df, langid.learn(df)).collect()
    said = {r.doc_id: r for r in got}
    assert len(got) == len(AWKWARD) + 1 and said[None].held_out is False
    assert {said[i].lang_pred for i in (1, 2, 3, 9)} == {"und"} and said[6].lang_pred == "en"
    nothing = langid.identify(empty(spark), langid.learn(empty(spark)))
    assert nothing.count() == 0
    unlabelled = df.withColumn("lang", df["lang"].substr(1, 0)).where("false")
    assert {r.lang_pred for r in langid.identify(df, langid.learn(unlabelled)).collect()} == {"und"}
    assert langid.stage_language(spark, awkward(spark), SF).columns == awkward(spark).columns
