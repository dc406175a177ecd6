"""Personal data by bootstrapped contextual extraction.

Base finds (email, ip, card, phone) are fixed text rules over whole texts; they are always
reported.  They are also the seeds: the words around a find are lexical patterns
(two words before it, one before, one after), and things that look like an identifier of
a kind without meeting its base rule (obfuscated at-signs, addresses with bracketed or spelled
dots, IPv6 addresses, numbers of 7 to 19 digits with other separators) are candidates.  All of them form a
graph of patterns and instances, an edge being a context in which an instance was seen.  Spark
scores it in rounds, until one takes up no new candidate:

* a pattern's score for a kind is the share of its instances believed to be of that kind,
  and it is trusted with at least ``MIN_SUPPORT`` believed instances and ``MIN_SHARE``;
* a candidate's belief is 1 - prod(1 - share) over its trusted patterns, and it is taken up
  if that reaches ``MIN_BELIEF`` for a kind it looks like.

Occurrences of candidates so taken up are added as spans.  Belief in a seed is always 1.  Beliefs
never fall from round to round, so a candidate once taken up stays, and the rounds come to an end.

Null text counts as empty: no spans.  Repeated rows are each reported, and count once in the
graph; an empty table gives an empty result; other columns are ignored.  Base rules run in
time linear in the text.  Edges are distinct pairs, so copies do not multiply them; a hot
pattern or instance is summed before the shuffle or split by Spark's skew handling.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweather.llm.common import stage, table, text_or_empty, tidy

KINDS = ("email", "ip", "card", "phone")
MIN_SUPPORT = 5.0
MIN_SHARE = 0.8
MIN_BELIEF = 0.9
CONTEXT_CHARS = 64

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Each digit run is consumed once, so long runs take linear time; group 1 tells a full match.
IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?+")
CARD = re.compile(r"[0-9]((?:[ -]?[0-9])++)?+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
DIGITS = re.compile("[0-9]+")
NOT_DIGIT = re.compile("[^0-9]+")
# Candidates: numbers with separators (whole runs, so that no tail of a longer one is taken), names at a domain in
# another spelling, four numbers with bracketed or spelled dots, and groups of hexadecimal digits between colons.
NUMBER = re.compile(r"[+(]?[0-9](?:[ ()./_-]{0,2}+[0-9])*+")
DOTS = r"(?: ?(?:\[ ?(?:\.|dot) ?\]|\( ?(?:\.|dot) ?\)) ?| dot )"
SPELLED_IP = re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?:{DOTS}[0-9]{{1,3}}){{3}}(?![0-9])", re.I)
COLONS = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{0,4}:){2,7}+[0-9A-Fa-f]{0,4}(?![\w:])")
AT = re.compile(r"[A-Za-z0-9._%+-]{1,64}(?: ?[\[(] ?at ?[\])] ?|@)[A-Za-z0-9-]{1,63}(?:(?: ?[\[(] ?dot ?[\])] ?|\.)[A-Za-z0-9-]{1,63}){0,8}")

OCCURRENCE = "struct<kind:int,looks:int,first:bigint,last:bigint,instance:string,patterns:array<string>>"
SCANNED = (
    "doc_id bigint, text_hash bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string,"
    f" found array<{OCCURRENCE}>"
)


def emails(text: str):
    """Leftmost non-overlapping matches of local@domain, driven by the at-signs."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base rules, by kind, then start."""
    spans = [(0, a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if m.group(1) and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                spans.append((1, *m.span()))
        for m in CARD.finditer(text):
            if m.group(1):
                digits = NOT_DIGIT.sub("", m.group())
                if 16 <= len(digits) <= 19 and luhn(digits):
                    spans.append((2, *m.span()))
        for m in PHONE.finditer(text):
            if 8 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                spans.append((3, *m.span()))
    return spans


def is_ipv6(text: str) -> bool:
    """An address with at least two groups of digits (``::`` and ``::1`` also occur in program text)."""
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return sum(map(bool, text.split(":"))) >= 2


def candidates(text: str, taken: list[tuple[int, int, int]]):
    """(looks, start, end): bit k of looks is set if the thing could be of kind k."""
    found = []
    if DIGIT.search(text):
        for m in NUMBER.finditer(text):
            digits = len(NOT_DIGIT.sub("", m.group()))
            looks = 8 * (7 <= digits <= 15) | 4 * (13 <= digits <= 19)
            if looks:
                found.append((looks, *m.span()))
        if "dot" in text.lower() or "." in text:
            found += [(2, *m.span()) for m in SPELLED_IP.finditer(text) if all(int(n) <= 255 for n in DIGITS.findall(m.group()))]
    if ":" in text:
        found += [(2, *m.span()) for m in COLONS.finditer(text) if is_ipv6(m.group())]
    if "@" in text or "at]" in text or "at)" in text or "at ]" in text or "at )" in text:
        found += [(1, *m.span()) for m in AT.finditer(text)]
    # Drop what overlaps a base span: both lists in order of start.
    base, i = sorted((a, b) for _, a, b in taken), 0
    for looks, a, b in sorted(found, key=lambda x: x[1]):
        while i < len(base) and base[i][1] <= a:
            i += 1
        if i == len(base) or base[i][0] >= b:
            yield looks, a, b


def patterns(text: str, start: int, end: int) -> list[str]:
    before = text[max(0, start - CONTEXT_CHARS) : start].lower().split()
    after = text[end : end + CONTEXT_CHARS].lower().split()
    said = [re.sub("[0-9]", "0", w) for w in before[-2:]]
    out = [f"1<{w}" for w in said[-1:]] + [f"2<{' '.join(said)}"] * (len(said) == 2)
    return out + [f"1>{re.sub('[0-9]', '0', w)}" for w in after[:1]]


def instance(text: str) -> str:
    """Key of an identifier: a digest of its digits, or of its lower-cased text with plain signs if it has an at-sign, letters or four dotted numbers."""
    plain = re.sub(r" ?[\[(] ?at ?[\])] ?", "@", text.lower())
    plain = re.sub(r" ?[\[(] ?(?:dot|\.) ?[\])] ?| dot ", ".", plain)
    whole = "@" in plain or ":" in plain or IP.fullmatch(plain)
    return hashlib.sha256((plain if whole else NOT_DIGIT.sub("", plain)).encode("utf-8", "surrogatepass")).hexdigest()[:32]


def spans_text(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def scan_text(text: str):
    """Counts, base digest and occurrences (base finds, then candidates) of one text."""
    base = base_spans(text) if "@" in text or DIGIT.search(text) else []
    found = [(k, 1 << k, a, b, instance(text[a:b]), patterns(text, a, b)) for k, a, b in base]
    found += [(-1, looks, a, b, instance(text[a:b]), patterns(text, a, b)) for looks, a, b in candidates(text, base)]
    counts = [sum(k == x for x, _, _ in base) for k in range(4)]
    return (*counts, hashlib.sha256(spans_text(base).encode()).hexdigest(), found)


def scan(docs: DataFrame) -> DataFrame:
    """Base finds and candidates of each row of ``docs`` (columns of SCANNED)."""
    kinds = pa.list_(
        pa.struct([("kind", pa.int32()), ("looks", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))])
    )
    names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "found"]
    types = [pa.int64()] * 4 + [pa.string(), kinds]
    fields = [kinds.value_type.field(i).name for i in range(6)]

    def work(batches):
        for batch in batches:
            rows = [scan_text(t.as_py()) for t in batch.column(2)]
            columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in names]
            columns[5] = [[dict(zip(fields, x, strict=True)) for x in found] for found in columns[5]]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=["doc_id", "text_hash", *names])

    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(work, SCANNED)


def believed(scanned: DataFrame) -> DataFrame:
    """(instance, kind): candidates that the scored graph takes up."""
    seen = scanned.select(F.explode("found").alias("f")).select("f.*")
    edges = stage(seen.select(F.explode("patterns").alias("pattern"), "instance").distinct(), "pii-edges")
    ones = F.lit(1.0).alias("belief")
    seeds = stage(seen.where("kind >= 0").select("instance", "kind", ones).distinct(), "pii-seeds")
    looks = seen.where("kind < 0").select("instance", "looks").distinct().join(seeds.select("instance"), "instance", "left_anti")
    looks = stage(looks.groupBy("instance").agg(F.bit_or("looks").alias("looks")), "pii-looks")
    sizes = stage(edges.groupBy("pattern").agg(F.count("*").alias("size")).where(F.col("size") >= MIN_SUPPORT), "pii-sizes")
    beliefs, n_taken, n_before = seeds, 0, -1
    while n_taken > n_before:
        support = edges.join(beliefs, "instance").groupBy("pattern", "kind").agg(F.sum("belief").alias("support"))
        trusted = support.where(F.col("support") >= MIN_SUPPORT).join(sizes, "pattern")
        trusted = trusted.select("pattern", "kind", (F.col("support") / F.col("size")).alias("share")).where(F.col("share") >= MIN_SHARE)
        trusted = stage(trusted, "pii-patterns")
        doubt = F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("share")))))
        scored = edges.join(trusted, "pattern").join(looks, "instance")
        scored = scored.where(F.expr("shiftright(looks, kind) & 1 = 1")).groupBy("instance", "kind").agg((1 - doubt).alias("belief"))
        taken = stage(scored.where(F.col("belief") >= MIN_BELIEF), "pii-taken")
        beliefs, n_before, n_taken = seeds.unionByName(taken), n_taken, taken.count()
    return taken.select("instance", "kind")


def discovered(scanned: DataFrame) -> DataFrame:
    """(key_id, key_hash, added): spans found by context, for texts that have any."""
    seen = scanned.select("doc_id", "text_hash", F.explode("found").alias("f")).where("f.kind < 0")
    seen = seen.select("doc_id", "text_hash", "f.first", "f.last", F.col("f.instance").alias("seen")).distinct()
    known = stage(believed(scanned), "pii-believed")
    hits = seen.join(known, seen["seen"] == known["instance"])
    span = F.struct(F.col("kind").alias("kind"), F.col("first").alias("first"), F.col("last").alias("last"))
    return hits.groupBy(F.col("doc_id").alias("key_id"), F.col("text_hash").alias("key_hash")).agg(F.collect_set(span).alias("added"))


def find_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans, n_added) for each row of ``docs``.

    Counts and base_sha256 are of the base finds; ``spans`` has all ``n_spans``, ``n_added`` of them by context.
    """
    scanned = stage(scan(docs), "pii-scan")
    added = stage(discovered(scanned), "pii-added")
    keyed = (scanned["doc_id"].eqNullSafe(added["key_id"])) & (scanned["text_hash"] == added["key_hash"])
    base = F.transform(F.filter("found", lambda f: f["kind"] >= 0), lambda f: F.struct(f["kind"].alias("kind"), f["first"].alias("first"), f["last"].alias("last")))
    every = F.array_sort(F.concat(base, F.coalesce(F.col("added"), F.array().cast("array<struct<kind:int,first:bigint,last:bigint>>"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    said = F.transform(every, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["first"], s["last"]))
    return scanned.join(added, keyed, "left").select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", F.array_join(said, ",").alias("spans"),
        F.size(every).cast("long").alias("n_spans"),
        F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_added"),
    )


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span replaced by its kind in angle brackets; overlapping spans are joined under the first one's kind."""
    out, at = [], 0
    joined: list[list[int]] = []
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if joined and a < joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b, k])
    for a, b, k in joined:
        out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = b
    return "".join([*out, text[at:]])


def query(spark, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return find_pii(table(spark, sf_dir, "documents"))


def stage_pii(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document, with its spans masked in the text (n_chars follows)."""
    added = stage(discovered(stage(scan(docs), "pii-scan")), "pii-added")
    fields, names = docs.schema, docs.columns
    keyed = docs.withColumn("__hash", F.xxhash64(text_or_empty()))
    keyed = keyed.join(added, keyed["doc_id"].eqNullSafe(added["key_id"]) & (keyed["__hash"] == added["key_hash"]), "left")
    at = {n: names.index(n) for n in ("text", "n_chars") if n in names}

    def work(batches):
        for batch in batches:
            texts, adds = batch.column(at["text"]).to_pylist(), batch.column(len(names)).to_pylist()
            new = []
            for text, add in zip(texts, adds, strict=True):
                spans = base_spans(text) if text and ("@" in text or DIGIT.search(text)) else []
                spans += [(s["kind"], s["first"], s["last"]) for s in add or []]
                new.append(mask(text, spans) if spans else text)
            arrays = [batch.column(i) for i in range(len(names))]
            arrays[at["text"]] = pa.array(new, arrays[at["text"]].type)
            if "n_chars" in at:
                old = arrays[at["n_chars"]].to_pylist()
                counts = [n if a is b else len(b) for n, a, b in zip(old, texts, new, strict=True)]
                arrays[at["n_chars"]] = pa.array(counts, arrays[at["n_chars"]].type)
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return keyed.select(*[docs[n] for n in names], "added").mapInArrow(tidy(work), fields)
