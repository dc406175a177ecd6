"""Mixing sources to target weights (Efraimidis-Spirakis sampling, DataFrame functions only).

Targets.  Sources, in code point order with null last, get the weights in turn and share
the total of all sizes by them.  No target exceeds ``max_epochs`` times its source's size;
the excess is shared again by weight.  That fixed point is a water level: with sources
ordered by cap / weight, the level is the first one at which a source is not capped.

Selection.  A document gets the exponential key -ln(u) / quality weight, u being drawn
from a digest of its doc_id, its text, its number among equal rows and the seed, so reruns agree.  A source first gives as many
complete epochs as its target holds; what is left is filled with documents in key order
up to the budget (the document that crosses it is taken if that comes closer).

The cut in key order is found without sorting a source in one task: keys are mapped
monotonically to 30-bit ranks, and sizes are summed per 10-bit digit, three times, each
time only inside the digit in which the budget runs out.  Only the rows of that last
digit (a 2^-30 share of a source) meet in a window.

Null source is a source of its own; null or blank text has size 0 and is taken 0 words;
rows that repeat a doc_id, null or not, have keys of their own and are each taken or left in key order; an
empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoweather.llm.common import stage, table

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
# Sampling weight of a document by its quality label; unlabelled documents weigh 1.
QUALITY_WEIGHT = {1: 2.0, 0: 0.5}
WORDS = r"[^ \t-\r]+"
DIGIT_BITS, LEVELS = 10, 3
TIE = ("doc_id", "digest", "nth")  # order of rows with equal keys; null doc_id first


def _key(doc_id, digest, nth, weight, seed: str):
    """Exponential key: -ln(u) / weight, u in (0, 1) from 52 bits of md5(doc_id:seed:digest:nth)."""
    said = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}:"), digest, F.lit(":"), nth.cast("string"))
    u = (F.conv(F.substring(F.md5(said), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / weight


def text_digest():
    return F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))


def sized(docs: DataFrame, labels: DataFrame | None, seed: str = SEED) -> DataFrame:
    """(doc_id, source, digest, nth, size, e, r): size in words, exponential key and its 30-bit rank.

    Rows that agree in doc_id, source and text are counted and numbered, so every row has a key of its own.
    """
    d = docs.select(
        F.col("doc_id"), F.col("source"), text_digest().alias("digest"),
        F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
    )
    d = d.groupBy("doc_id", "source", "digest", "size").agg(F.count("*").alias("rows"))
    weight = F.lit(1.0)
    if labels is not None:
        good, bad = F.lit(QUALITY_WEIGHT[1]), F.lit(QUALITY_WEIGHT[0])
        q = (
            labels.where(F.col("doc_id").isNotNull())
            .groupBy(F.col("doc_id").alias("label_id"))
            .agg(F.max("quality").alias("label"))
            .withColumn("label_spread", F.lit(0).cast("long"))
        )
        # Null doc_ids have no label; a second key spreads them over the join's tasks.
        spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0).cast("long"))
        d = d.withColumn("spread", spread)
        d = d.join(q, (d["doc_id"] == q["label_id"]) & (d["spread"] == q["label_spread"]), "left")
        weight = F.when(F.col("label") == 1, good).when(F.col("label") == 0, bad).otherwise(weight)
    d = d.select("doc_id", "source", "digest", "size", weight.alias("weight"), F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("nth"))
    top = (1 << (DIGIT_BITS * LEVELS)) - 1
    key = _key(F.col("doc_id"), F.col("digest"), F.col("nth"), F.col("weight"), seed)
    d = d.select("doc_id", "source", "digest", "nth", "size", key.alias("e"))
    return d.withColumn("r", F.least(F.lit(top), F.floor((1 - F.exp(-F.col("e"))) * (top + 1))).cast("long"))


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target, epochs, budget), one row per source.

    Windows here run over one row per source.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    nth = (F.row_number().over(by_name) - 1) % len(weights)
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size").cast("double") * max_epochs)
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn(
        "level",
        (F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))),
    ).withColumn("nth", F.row_number().over(order))
    free = F.when(F.col("cap") / F.col("w") >= F.col("level"), F.struct("nth", "level"))
    s = s.withColumn("level", F.coalesce(F.min(free).over(everything)["level"], F.lit(float("inf"))))
    s = s.withColumn("target", F.least(F.col("cap"), F.col("level") * F.col("w")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    s = s.withColumn("epochs", epochs.cast("long"))
    return s.select(
        "source", "source_size", "target", "epochs", (F.col("target") - F.col("epochs") * F.col("source_size")).alias("budget")
    )


def _same_source(left: DataFrame, right: DataFrame):
    return left["source"].eqNullSafe(right["of"])


def cuts(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """(of, source_size, target, epochs, cut_r, cut): a document is in the fractional part
    if its rank is below cut_r, or equal and (key, doc_id) is at most cut."""
    state = goals.withColumnRenamed("source", "of").withColumn("at", F.lit(0).cast("long")).withColumn("below", F.lit(0).cast("long"))
    for level in range(LEVELS):
        shift = DIGIT_BITS * (LEVELS - 1 - level)
        inside = sizes.join(
            state.select("of", "at"), _same_source(sizes, state) & (F.shiftright(sizes["r"], shift + DIGIT_BITS) == F.col("at"))
        )
        digits = inside.groupBy("source", F.shiftright("r", shift).alias("digit")).agg(F.sum("size").alias("n"))
        upto = Window.partitionBy("source").orderBy("digit")
        digits = digits.withColumn("upto", F.sum("n").over(upto))
        hit = digits.join(state, _same_source(digits, state)).where(
            (F.col("budget") > 0) & (F.col("below") + F.col("upto") >= F.col("budget"))
        )
        first = hit.groupBy("source").agg(F.min(F.struct("digit", (F.col("below") + F.col("upto") - F.col("n")).alias("low"))).alias("first"))
        first = first.withColumnRenamed("source", "crossed")
        state = stage(
            state.join(first, state["of"].eqNullSafe(first["crossed"]), "left").select(
                "of", "source_size", "target", "epochs", "budget", F.coalesce("first.digit", F.lit(-1).cast("long")).alias("at"),
                F.coalesce("first.low", F.lit(0).cast("long")).alias("below"),
            ),
            "mix-cut",
        )
    rows = sizes.join(state, _same_source(sizes, state) & (sizes["r"] == F.col("at")))
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("e", *TIE).rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("upto", F.col("below") + upto)
    over = F.col("upto") - F.col("budget")
    rows = rows.where((over <= 0) | ((F.col("upto") - F.col("size") < F.col("budget")) & (over < F.col("size") - over)))
    last = rows.groupBy(F.col("source").alias("cut_of")).agg(F.max(F.struct("e", *TIE)).alias("cut"))
    return state.join(last, state["of"].eqNullSafe(last["cut_of"]), "left").select(
        "of", "source_size", "target", "epochs", F.col("at").alias("cut_r"), "cut"
    )


def mix_sources(
    docs: DataFrame, labels: DataFrame | None = None, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED
) -> DataFrame:
    """(doc_id, source, digest, size, source_size, target, copies, taken), a row for each of ``docs``: ``copies`` says how often the mix
    takes the document, ``taken`` how many words that is."""
    sizes = stage(sized(docs, labels, seed), "mix-sizes")
    goals = stage(targets(sizes, weights, max_epochs), "mix-goals")
    cut = stage(cuts(sizes, goals), "mix-cuts")
    inside = (F.col("r") < F.col("cut_r")) | (
        (F.col("r") == F.col("cut_r")) & F.col("cut").isNotNull() & (F.struct("e", *TIE) <= F.col("cut"))
    )
    copies = F.col("epochs") + F.coalesce(inside, F.lit(False)).cast("long")
    return sizes.join(cut, _same_source(sizes, cut)).select(
        "doc_id", "source", "digest", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Mix all documents; quality weights come from ``labels``."""
    mixed = mix_sources(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def stage_mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each document as many times as the mix takes it.

    Rows that agree in doc_id, source and text give the copies of all of them together, as the least of these rows.
    """
    keys = ("doc_id", "source", "digest")
    mixed = mix_sources(docs, table(spark, sf_dir, "labels")).groupBy(*[F.col(k).alias(f"mixed_{k}") for k in keys])
    mixed = mixed.agg(F.sum("copies").alias("copies")).where("copies > 0")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = docs.groupBy(F.col("doc_id"), F.col("source"), text_digest().alias("digest")).agg(F.min(row).alias("row"))
    same = [one[k].eqNullSafe(mixed[f"mixed_{k}"]) for k in keys]
    joined = one.join(mixed, same[0] & same[1] & same[2])
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("row.*")


ORACLE_SQL = f"""
WITH labelled AS (SELECT doc_id, max(quality) AS label FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
numbered AS (
  SELECT doc_id, source, text, md5(coalesce(text, '')) AS digest,
         row_number() OVER (PARTITION BY doc_id, source, md5(coalesce(text, ''))) AS nth
  FROM documents),
sizes AS (
  SELECT d.doc_id, d.source, d.digest, d.nth,
         coalesce(len(regexp_extract_all(d.text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         -ln((('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '') || ':{SEED}:' || d.digest || ':' || d.nth::VARCHAR), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
           / CASE l.label WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END AS e
  FROM numbered d LEFT JOIN labelled l ON d.doc_id = l.doc_id),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS w
  FROM sizes GROUP BY source),
levels AS (
  SELECT *, source_size::DOUBLE * 3 AS cap, source_size::DOUBLE * 3 / w AS ratio,
         ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(source_size::DOUBLE * 3) OVER ranked, 0))
           / (sum(w) OVER () - coalesce(sum(w) OVER ranked, 0)) AS level,
         row_number() OVER (ORDER BY source_size::DOUBLE * 3 / w, source IS NULL, source) AS nth
  FROM sources
  WINDOW ranked AS (ORDER BY source_size::DOUBLE * 3 / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (SELECT arg_min(level, nth) AS level FROM levels WHERE ratio >= level),
goals AS (
  SELECT source, source_size, least(cap, water.level * w) AS target,
         CASE WHEN source_size > 0 THEN floor(least(cap, water.level * w) / source_size) ELSE 0 END::BIGINT AS epochs
  FROM levels, water),
keyed AS (
  SELECT s.doc_id, s.size, g.*, g.target - g.epochs * g.source_size AS budget,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.e, s.doc_id NULLS FIRST, s.digest, s.nth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM sizes s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN upto <= budget
                           OR (upto - size < budget AND upto - budget < size - (upto - budget)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM keyed
"""
