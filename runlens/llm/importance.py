"""Quality by importance weights: hashed n-gram log-likelihood ratio of a trusted target to the whole corpus.

Words are split at blanks. Hashed n-grams of one and of two words, and besides
the character bigram at the end of each word (where punctuation and junk symbols
sit), of all documents give the corpus multinomial, those of trusted documents
(quality 1) the target's. The general functions take ``pairs``, whether n-grams
of two words count; the query and the pipeline always count them. A document's
score is the mean log ratio over its n-grams; below ``THRESHOLD`` it is
rejected. All documents are counted and scored, by SQL expressions inside the
row. Texts are shuffled once, to meet the distinct trusted ids, of which there
may be any number; besides, only the counts of a fixed number of bins are
shuffled.

Defined cases: a missing text has no words and fails the base rule; with no
trusted rows the ratio is 0 everywhere and the base rule decides alone; repeated
labels count once and labels of absent documents not at all; rows of one trusted
id are all counted; a row is judged by itself; columns named like
an added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.common import stored, table, whole_text
from runlens.llm.registry import query

BINS = 1 << 14
THRESHOLD = -0.25
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"

ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def bins_of(word: Column) -> list[Column]:
    """Bins of a word and of its last two characters."""
    return [F.pmod(F.xxhash64(F.lit(k), part), F.lit(BINS)).cast("int") for k, part in enumerate((word, F.right(word, F.lit(2))))]


def pair_bin(pair: Column) -> Column:
    """Bin of the hash of a two-word run."""
    return F.pmod(pair, F.lit(BINS)).cast("int")


def trusted(labels: DataFrame) -> DataFrame:
    """Distinct ids of all trusted documents."""
    return labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()


def log_ratios(docs: DataFrame, labels: DataFrame, pairs: bool = False) -> DataFrame:
    """One row with the log ratio of every bin, as an array; ``pairs``: two-word runs count too."""
    spark = docs.sparkSession
    # One plan for all sizes, so that figures of small tables hold for large ones.
    target = trusted(labels).select(F.col("doc_id").alias("_trusted")).hint("merge")
    # The second key deals out rows without an id.
    dealt = F.coalesce(F.col("_id"), F.xxhash64("_text"))
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), whole_text().alias("_text")).join(
        target, (F.col("_id") == F.col("_trusted")) & (dealt == F.col("_trusted")), "left"
    )
    known = F.col("_trusted").isNotNull().cast("long").alias("_in_target")
    if pairs:
        following = F.slice("_words", 2, F.size("_words"))
        words = (
            texts.select(known, words_of(F.col("_text")).alias("_words"))
            .select("_in_target", F.explode(F.arrays_zip(F.col("_words").alias("a"), following.alias("b"))).alias("_w"))
            .select("_in_target", F.col("_w.a").alias("_word"), F.col("_w.b").alias("_next"))
        )
        # The last word of a text begins no run.
        run = F.when(F.col("_next").isNotNull(), pair_bin(F.xxhash64("_word", "_next")))
        found = F.array(*bins_of(F.col("_word")), run)
    else:
        words = texts.select(known, F.explode(F.split("_text", BLANKS)).alias("_word")).filter("_word <> ''")
        found = F.array(*bins_of(F.col("_word")))
    bins = (
        words.select("_in_target", F.explode(found).alias("bin"))
        .filter("bin IS NOT NULL")
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("raw"), F.sum("_in_target").alias("target"))
    )
    counted = spark.range(BINS).select(F.col("id").cast("int").alias("bin")).join(bins, "bin", "left")
    # Fixed size: the array holds BINS entries however large the corpus is.
    gathered = counted.agg(
        F.array_sort(
            F.collect_list(F.struct("bin", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target")))
        ).alias("b"),
        F.coalesce(F.sum("raw"), F.lit(0)).alias("n_raw"),
        F.coalesce(F.sum("target"), F.lit(0)).alias("n_target"),
    )
    ratio = lambda x: F.log((x["target"] + 1) / (F.col("n_target") + BINS)) - F.log(
        (x["raw"] + 1) / (F.col("n_raw") + BINS)
    )
    return gathered.select(
        F.transform("b", lambda x: F.when(F.col("n_target") > 0, ratio(x)).otherwise(F.lit(0.0))).alias("ratios")
    )


def paired(words: Column) -> Column:
    """Hashes of all two-word runs."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.xxhash64(a, b))


def repeated_words(pairs: Column):
    """Hashes of all eight-word windows from those of two-word runs; and how many words repeated windows cover."""
    window = WINDOW
    n = F.greatest(F.size(pairs) - (window - 2), F.lit(0))
    hashes = F.transform(F.arrays_zip(*[F.slice(pairs, k + 1, n) for k in range(0, window, 2)]), lambda x: F.xxhash64(x))

    def covered(h: Column) -> Column:
        order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        none = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
        beside = F.arrays_zip(order.alias("x"), F.concat(none, order).alias("p"), F.slice(order, 2, F.size(order)).alias("q"))
        twice = F.filter(
            beside,
            lambda z: z["x"].isNotNull()
            & (F.coalesce(z["x"]["h"] == z["p"]["h"], F.lit(False)) | F.coalesce(z["x"]["h"] == z["q"]["h"], F.lit(False))),
        )
        starts = F.sort_array(F.transform(twice, lambda z: z["x"]["i"]))
        steps = F.zip_with(starts, F.slice(starts, 2, F.size(starts)), lambda a, b: F.least(F.coalesce(b - a, F.lit(window)), F.lit(window)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    return hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h))


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, pairs: bool = False) -> DataFrame:
    """``docs`` with the base figures, the length-normalised ratio and the verdict."""
    ratios = log_ratios(docs, labels, pairs).scalar()
    kept_columns = [c for c in docs.columns if c not in ADDED]
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    hashes, covered = repeated_words(F.col("_pairs"))
    ratio_of = lambda x: sum((F.get("_ratios", b) for b in bins_of(x)), F.lit(0.0))
    total = F.aggregate("_words", F.lit(0.0), lambda a, x: a + ratio_of(x))
    n_grams = 2 * F.size("_words")
    if pairs:
        total = F.aggregate("_pairs", total, lambda a, x: a + F.get("_ratios", pair_bin(x)))
        n_grams = n_grams + F.size("_pairs")
    return (
        docs.select(*kept_columns, whole_text().alias("_text"))
        .select("*", words_of(F.col("_text")).alias("_words"), lines.alias("_lines"), ratios.alias("_ratios"))
        .select("*", paired(F.col("_words")).alias("_pairs"))
        .select("*", hashes.alias("_hashes"))
        .select(
            *kept_columns,
            F.size("_words").cast("long").alias("n_words"),
            F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
            F.regexp_count("_text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            covered(F.col("_hashes")).alias("n_repeat_words"),
            F.when(F.size("_words") > 0, total / n_grams).otherwise(F.lit(0.0)).alias("score"),
        )
        .withColumn(
            "base_failed",
            (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")),
        )
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    )


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the rule keeps.

    Verdicts are stored before the filter: a filter above the scoring would be
    pushed below its projections, with every figure's expressions written out
    again and again.
    """
    scored = score(docs, table(spark, sf_dir, "labels"), pairs=True)
    return stored(scored.select(*docs.columns, F.col("kept").alias("_kept")), "scored", "zstd").filter("_kept").select(*docs.columns)


@query("op7_importance")
def op7_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, table(spark, sf_dir, "labels"), pairs=True).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )
