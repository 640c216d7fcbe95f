"""Benchmark decontamination: a prefix-filtered join of benchmark windows with document positions.

An item's windows are its runs of ten words (one shorter window where the item
is shorter). A window occurs only where its rarest word does, so that word, by
counts over all documents, is the one prefix token that must be joined; the
offset of the token in the window and the length of the document bound where it
can start, and the words around the token are then compared with the whole
window. Everything is built from SQL functions; texts are shuffled once, to meet
their own candidate positions, and only the words around them go on.

Defined cases: a missing or empty text has no words; an item without words has
no window; equal windows of several items count for each of them; rows with the
same id and text are judged alike and all kept; columns named like an added one
are replaced; empty tables give clean documents or no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.common import sized, stored, table, whole_text
from runlens.llm.registry import query

WINDOW = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ADDED = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def parts(text: Column) -> Column:
    """Lower-case words; empty strings may stand at both ends."""
    return F.split(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), SEPARATORS)


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, words) of every window of every item."""
    words = items.select("item_id", F.array_remove(parts(whole_text()), "").alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    return words.select("item_id", "w", F.explode(starts).alias("s")).select("item_id", F.slice("w", F.col("s"), window).alias("words"))


def rarest_words(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Distinct windows with their rarest word and its offset; windows with a word no document has are left out."""
    distinct = windows.select("words").distinct()
    by_word = distinct.select("words", F.posexplode("words").alias("offset", "token"))
    vocabulary = by_word.select("token").distinct()
    counts = (
        docs.select(F.explode(parts(whole_text())).alias("token"))
        .join(sized(vocabulary), "token", "left_semi")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = by_word.join(counts, "token", "left").groupBy("words").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "offset")).alias("first")
    )
    return ranked.filter("first.n > 0").select("words", "first.token", "first.offset")


def covered(starts: Column) -> Column:
    """How many positions sorted (start, length) runs cover."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(a, x):
        stop = x["start"] + x["length"]
        return F.struct(
            F.greatest(a["end"], stop).alias("end"),
            (a["n"] + F.greatest(stop - F.greatest(a["end"], x["start"]), F.lit(0))).alias("n"),
        )

    return F.aggregate(starts, zero, add, lambda a: a["n"])


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (doc_id, text, ...) with n_words, n_hit, n_items, items_sha256 and contaminated."""
    docs = docs.select(*[c for c in docs.columns if c not in ADDED])
    keyed = docs.withColumns(
        {"_a": F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "_b": F.xxhash64("doc_id", whole_text())}
    )
    all_windows = stored(item_windows(items, window), "windows")
    windows = stored(rarest_words(docs, all_windows), "prefixes")
    tokens = sized(windows.select("token").distinct())
    at = (
        keyed.select("_a", "_b", F.posexplode(parts(whole_text())).alias("at", "token"))
        .join(tokens, "token", "left_semi")
        .groupBy("_a", "_b")
        .agg(F.collect_set("at").alias("_at"))
    )
    joined = keyed.join(at, ["_a", "_b"], "left").withColumn("_parts", parts(whole_text()))
    around = F.transform(
        "_at",
        lambda p: F.struct(
            p.alias("at"),
            F.slice("_parts", F.greatest(p - (window - 2), F.lit(1)), F.least(p, F.lit(window - 1)) + window).alias("near"),
        ),
    )
    met = stored(
        joined.select(
            *docs.columns if "text" not in docs.columns else [c for c in docs.columns if c != "text"],
            "_a",
            "_b",
            F.size(F.array_remove("_parts", "")).cast("long").alias("n_words"),
            around.alias("_around"),
        ),
        "around",
    )
    # Position of the token within ``near``, then the window's start within it, both from 1.
    token_at = F.least(F.col("c.at"), F.lit(window - 1)) + 1
    start = F.col("token_at") - F.col("offset")
    hits = (
        met.select("_a", "_b", F.explode("_around").alias("c"))
        .select("_a", "_b", F.col("c.at").alias("at"), F.col("c.near").alias("near"), token_at.alias("token_at"))
        .withColumn("token", F.element_at("near", F.col("token_at")))
        .join(sized(windows), "token")
        .filter((start >= 1) & (start + F.size("words") - 1 <= F.size("near")))
        .filter(F.slice("near", F.when(start >= 1, start).otherwise(1), F.size("words")) == F.col("words"))
        .select("_a", "_b", (F.col("at") - F.col("offset")).alias("start"), F.size("words").alias("length"), "words")
    )
    hits = stored(hits, "hits")
    n_hit = hits.groupBy("_a", "_b").agg(covered(F.sort_array(F.collect_set(F.struct("start", "length")))).alias("n_hit"))
    found = (
        hits.select("_a", "_b", "words")
        .distinct()
        .join(sized(all_windows.distinct()), "words")
        .groupBy("_a", "_b")
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("_items"))
    )
    n_hits = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (
        met.drop("_around")
        .join(n_hit, ["_a", "_b"], "left")
        .join(found, ["_a", "_b"], "left")
        .withColumns(
            {
                "n_hit": n_hits,
                "n_items": F.coalesce(F.size("_items"), F.lit(0)).cast("long"),
                "items_sha256": F.sha2(F.coalesce(F.array_join("_items", ","), F.lit("")), 256),
                "contaminated": n_hits > 0,
            }
        )
        .drop("_a", "_b", "_items")
    )


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without any benchmark window."""
    own = docs.withColumn("_text", F.col("text"))
    found = find(own, table(spark, sf_dir, "benchmark")).filter("NOT contaminated")
    return found.withColumn("text", F.col("_text")).select(*docs.columns)


SQL = f"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[s:s + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS s FROM item WHERE len(w) > 0)),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
run AS (
  SELECT doc_id, s, k, array_to_string(w[s:s + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
        FROM doc, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
hit AS (SELECT run.doc_id, run.s, run.k, item_id FROM run JOIN win ON run.win = win.win AND run.k = win.k),
pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY 1)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(pos.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(its.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN pos ON doc.doc_id = pos.doc_id LEFT JOIN its ON doc.doc_id = its.doc_id
"""


@query("op4_decontaminate", SQL)
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
