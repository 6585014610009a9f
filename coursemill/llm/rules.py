"""Quality rules in built-in expressions: plain counts, then a log-likelihood ratio of hashed n-grams.

The n-grams are whole words, pairs of neighbouring words and pairs of their endings (the last ``ENDING`` characters), hashed into ``BUCKETS``
buckets: whole words tell what a text says, endings show capitals, symbol runs and tables. Each word and each ending is hashed once; pairs, and the windows of
three that the base counts look for, are made of these hashes. Two multinomials are
estimated: one over trusted documents, one over all documents, each bucket with ``PRIOR`` n-grams added in the share of the whole, so that a
rarely seen n-gram says nothing either way. A document's score is the mean of
``log(trusted / raw)`` over its n-grams; it is kept if the score reaches ``THRESHOLD``. No sampling takes part: every document is judged by
the same fixed threshold. The ratio table has ``BUCKETS`` entries whatever the corpus, so it can go to every task.

Defined results: null and word-less texts have zero counts and fail the base rules; a document without n-grams
has score 0; without any trusted document all ratios are 0, so the base rules alone decide; each repeated row is
judged alike and counted as often as it occurs; null ids are judged like any other row and are never trusted; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemill.llm.common import Scratch, words

BUCKETS = 1 << 16
ENDING = 3
PRIOR = 30
THRESHOLD = -0.2
LEAST_WORDS = 50
REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"


def _hashes(w: Column) -> tuple[Column, Column]:
    """``_h`` and ``_e``: a hash of each word and of its ending."""
    return F.transform(w, lambda x: F.xxhash64(x)).alias("_h"), F.transform(w, lambda x: F.xxhash64(F.right(x, F.lit(ENDING)))).alias("_e")


def _runs(h: Column, length: int) -> Column:
    """A hash of each run of ``length`` neighbours."""
    each = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, length)]))
    return F.slice(each, 1, F.greatest(F.size(h) - (length - 1), F.lit(0)))


def _grams(h: Column, e: Column) -> Column:
    """Hashes of all n-grams: words, then pairs of words, then pairs of endings."""
    return F.concat(h, _runs(h, 2), _runs(e, 2))


def counts(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The base counts of each text beside the columns ``carry``; ``_h`` and ``_e`` are the hashes of its words and their endings."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    symbols = F.regexp_count(text, F.lit(f"[{SYMBOLS}]"))
    step = docs.select(*carry, "text", words(F.col("text")).alias("_w"), symbols.cast("bigint").alias("n_symbols"), lines.alias("_lines"))
    w = F.col("_w")
    step = step.select(
        *carry, "text", *_hashes(w), F.size(w).cast("bigint").alias("n_words"), F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"), "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
    )
    step = step.withColumn("_t", _runs(F.col("_h"), 3))
    t = F.col("_t")
    # in the order of their hash, equal windows are neighbours; most texts have none and need no order
    windows = F.when(F.size(F.array_distinct(t)) < F.size(t), F.sort_array(F.transform(t, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    step = step.withColumn("_s", windows).drop("_t")
    s = F.col("_s")
    again = F.filter(s, lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]))
    step = step.withColumn("_p", F.sort_array(F.transform(again, lambda x: x["i"]))).drop("_s")
    p = F.col("_p")
    # a window covers three words, less those that the next one covers too
    covered = F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))), F.lit(0), lambda a, b: a + b)
    return step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("_p")


def _bucket(h: Column) -> Column:
    return F.pmod(h, F.lit(BUCKETS)).cast("int")


def log_ratios(docs: DataFrame, trusted: DataFrame, scratch: Scratch) -> DataFrame:
    """``ratios``: one row with ``BUCKETS`` values of log(trusted / raw)."""
    sure = trusted.select(F.col("doc_id").alias("_id")).filter("_id is not null").distinct().withColumn("_t", F.lit(1)).hint("merge")  # ids grow with the corpus: the same plan at every size
    flagged = docs.select("doc_id", "text").join(sure, F.col("doc_id") == F.col("_id"), "left")
    hashed = flagged.select("_t", words(F.col("text")).alias("_w")).select("_t", *_hashes(F.col("_w")))
    grams = hashed.select("_t", F.explode(_grams(F.col("_h"), F.col("_e"))).alias("h"))
    seen = scratch.keep(grams.groupBy(_bucket(F.col("h")).alias("bucket")).agg(F.count("*").alias("raw"), F.count("_t").alias("good")), "buckets")
    raw, good = seen.agg(F.sum("raw"), F.sum("good")).first()
    part = (good or 0) / (raw or 1)
    ratio = F.log((F.coalesce("good", F.lit(0)) + PRIOR * part) / (F.coalesce("raw", F.lit(0)) + PRIOR) / part) if part else F.lit(0.0)
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(seen, "bucket", "left")
    pairs = every.select(F.struct("bucket", ratio.alias("r")).alias("x"))
    return pairs.agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["r"]).alias("ratios"))


def quality_rules(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, carry: list[str] | None = None) -> DataFrame:
    """Counts, ``score``, ``base_failed`` and ``kept`` of every row of ``docs``, beside ``carry`` (``doc_id`` alone if not given).

    ``trusted`` has the ``doc_id`` of the documents that stand for the target.
    """
    scratch = Scratch(docs.sparkSession, "rules")
    # a table of fixed size, folded into one array constant that tasks look up by position
    table = log_ratios(docs, trusted, scratch).first()["ratios"]
    ratios = F.split(F.lit(" ".join(map(repr, table))), " ").cast("array<double>")
    carry = ["doc_id"] if carry is None else carry
    plain = docs.select(*[c for c in docs.columns if c in {*carry, "text"}])
    step, n = counts(plain, [c for c in carry if c != "text"]), F.col("n_words")
    # the constant stands in the plan's text, which the driver keeps for each query that ran: it is named once only
    grams = F.transform(_grams(F.col("_h"), F.col("_e")), lambda x: F.get(ratios, _bucket(x)))
    step, v = step.withColumn("_v", grams), F.col("_v")
    w = F.size("_h")
    pairs = lambda i: F.get(v, w + i) + F.get(v, 2 * w - 1 + i)
    each = F.transform(F.col("_h"), lambda _, i: F.get(v, i) + F.when(i + 1 < w, pairs(i)).otherwise(F.lit(0.0)))
    total = F.aggregate(each, F.lit(0.0), lambda a, b: a + b)
    step = step.withColumn("score", F.when(n > 0, total / (3 * n - 2)).otherwise(F.lit(0.0)))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    step = step.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    out = [*carry, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept"]
    # a filter on the verdict must not pull copies of the whole computation below: it cannot pass a generated row
    return step.select(F.explode(F.array(F.struct(*out))).alias("r")).select("r.*")
