"""MinHash near-duplicate detection with exact links and connected components.

A document's set holds its distinct five-word shingles. Documents with equal
sets form a class. Classes meet in bands of ``ROWS`` out of ``BANDS * ROWS``
universal hash minima; a pair at the threshold similarity misses all bands with
a probability below 1e-6. Candidates are estimated from their signatures and
confirmed on full sets, recomputed from whole texts.

A bucket's members are first compared with one pivot, the member that meets most
others, so that a large group of copies costs one comparison for each. Where a
bucket still holds several components (large-star and small-star) its members'
differences from the pivot are joined by an exact prefix filter
(``pairs_by_difference``), which finds every link between them without expanding
the bucket into its pairs.

Defined cases: texts without words are linked with nothing; rows that share an
id are one document; rows without an id are known by a 62-bit hash of their text
(``row_key``) and linked like all others; a component's id is the least id of its
rows, none if no row has one, and then its row with the least key is kept; columns
named like an added one are replaced; an empty table gives no rows. The pipeline
stage keeps one of equal texts under a kept id or key, and all different texts of
one id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.common import arrow_rows, stored, table, whole_text
from runlens.llm.components import components
from runlens.llm.registry import query

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 28, 3
# Five standard deviations of the estimate below the threshold.
LEAST_ESTIMATE = 0.5
ADDED = ("n_shingles", "component_id", "kept")


# Keys of rows without an id start here, so that a row with a common id comes first.
NO_ID = 1 << 62


def row_key():
    """The id of a row, or a hash of its text if it has none."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(whole_text()).bitwiseAND(NO_ID - 1).bitwiseOR(NO_ID))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(row_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


def free_name(name: str, docs: DataFrame) -> str:
    """``name``, longer by as many signs as set it apart from all columns."""
    while name in docs.columns:
        name += "_"
    return name


def odd_numbers(n: int, seed: int, kind) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, np.iinfo(kind).max, n, kind) | kind(1)


def shingle_hashes():
    """A function from a text to the sorted 64-bit hashes of its distinct shingles."""
    import xxhash

    word_hash = xxhash.xxh3_64_intdigest
    weights = odd_numbers(SHINGLE, 11, np.uint64)

    def hashes(text: str) -> np.ndarray:
        words = text.encode().lower().split()  # bytes: A-Z and ASCII blanks only
        w = np.fromiter(map(word_hash, words), np.uint64, len(words))
        n = len(w)
        if n < SHINGLE:
            return np.sum(w * weights[:n], dtype=np.uint64, keepdims=True) + np.uint64(n) if n else w
        s = w[: n - SHINGLE + 1] * weights[0]
        for k in range(1, SHINGLE):
            s += w[k : n - SHINGLE + 1 + k] * weights[k]
        s ^= s >> np.uint64(32)
        return np.unique(s)

    return hashes


def minima():
    """A function from shingle hashes to ``BANDS * ROWS`` universal hash minima."""
    n = BANDS * ROWS
    times, plus = odd_numbers(n, 12, np.uint32)[:, None], odd_numbers(n, 13, np.uint32)[:, None]

    def of(hashes: np.ndarray) -> np.ndarray:
        folded = ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
        least = np.full(n, np.iinfo(np.uint32).max, np.uint32)
        for k in range(0, len(folded), 4096):
            np.minimum(least, (folded[None, k : k + 4096] * times + plus).min(axis=1), out=least)
        return least

    return of


def sketches(docs: DataFrame) -> DataFrame:
    """(key, doc_id, n_shingles, fingerprint of the set, signature) of every row."""

    def make():
        import xxhash

        hashes, signature = shingle_hashes(), minima()

        def step(batch):
            sizes, prints, signatures = [], [], []
            for value in batch.column(2):
                h = hashes(value.as_py())
                sizes.append(len(h))
                prints.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                signatures.append(signature(h).tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(signatures, pa.binary())],
                ["key", "doc_id", "n_shingles", "fingerprint", "signature"],
            )

        return step

    return keyed(docs).mapInArrow(arrow_rows(make), "key long, doc_id long, n_shingles long, fingerprint binary, signature binary")


def alike(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (u, v) whose signatures may come from linked sets."""

    def make():
        def step(batch):
            width = 4 * BANDS * ROWS
            a, b = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, width // 4) for k in (2, 3)
            )
            yield batch.filter(pa.array((a == b).mean(axis=1) >= LEAST_ESTIMATE)).select([0, 1])

        return step

    signed = classes.select("rep", "signature")
    both = (
        pairs.join(signed.withColumnRenamed("signature", "su"), F.col("u") == F.col("rep")).drop("rep")
        .join(signed.withColumnRenamed("signature", "sv"), F.col("v") == F.col("rep")).drop("rep")
    )
    return both.select("u", "v", "su", "sv").mapInArrow(arrow_rows(make), "u long, v long")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (u, v) whose full sets are linked."""

    def make():
        hashes = shingle_hashes()
        held: list = [None, None]

        def step(batch):
            keep = []
            for tu, tv in zip(batch.column(2), batch.column(3)):
                tv = tv.as_py()
                if held[0] != tv:
                    held[:] = tv, hashes(tv)
                a, b = hashes(tu.as_py()), held[1]
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(both > 0 and 100 * both >= PERCENT * (len(a) + len(b) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

        return step

    both = (
        pairs.join(texts.select(F.col("doc_id").alias("u"), F.col("text").alias("tu")), "u")
        .join(texts.select(F.col("doc_id").alias("v"), F.col("text").alias("tv")), "v")
    )
    return both.select("u", "v", "tu", "tv").mapInArrow(arrow_rows(make), "u long, v long").distinct()


def differences(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(u, q, size, other, linked, diff): how the full set of u differs from that of the pivot q."""
    names = ["u", "q", "size", "other", "linked", "diff"]

    def make():
        hashes = shingle_hashes()
        held: list = [None, None]

        def rows(found):
            us, qs, sizes, others, linked, diffs = zip(*found)
            ends = np.cumsum([0, *map(len, diffs)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(diffs).view(np.int64)))
            columns = [pa.array(x, pa.int64()) for x in (us, qs, sizes, others)] + [pa.array(linked, pa.bool_()), lists]
            return pa.RecordBatch.from_arrays(columns, names)

        def step(batch):
            found, size = [], 0
            for u, q, tu, tq in zip(*(batch.column(k) for k in range(4))):
                tq = tq.as_py()
                if held[0] != tq:
                    held[:] = tq, hashes(tq)
                a, b = hashes(tu.as_py()), held[1]
                d = np.setxor1d(a, b, assume_unique=True)
                found.append((u.as_py(), q.as_py(), len(a), len(b), 7 * len(d) <= len(a) + len(b), d))
                size += len(d)
                if size > 500_000:
                    yield rows(found)
                    found, size = [], 0
            if found:
                yield rows(found)

        return step

    both = pairs.join(texts.select(F.col("doc_id").alias("u"), F.col("text").alias("tu")), "u").join(
        texts.select(F.col("doc_id").alias("q"), F.col("text").alias("tq")), "q"
    )
    return both.select("u", "q", "tu", "tq").mapInArrow(
        arrow_rows(make), "u long, q long, size long, other long, linked boolean, diff array<bigint>"
    )


def pivots_of(buckets: DataFrame) -> DataFrame:
    """(key, met, q): of each bucket the member that meets most others in all its buckets."""
    met = buckets.groupBy("rep").agg(F.sum("n").alias("met"))
    best = F.max(F.struct("met", (-F.col("rep")).alias("least"))).alias("p")
    return buckets.join(met, "rep").groupBy("key").agg(best).select("key", "p.met", (-F.col("p.least")).alias("q"))


def pivot_pairs(buckets: DataFrame, pivots: DataFrame) -> DataFrame:
    """(u, v): each member of some bucket with the most met pivot of its buckets."""
    return (
        buckets.join(pivots, "key")
        .filter("q <> rep")
        .groupBy(F.col("rep").alias("u"))
        .agg(F.max(F.struct("met", (-F.col("q")).alias("least"))).alias("p"))
        .select("u", (-F.col("p.least")).alias("v"))
    )


def placed_in(rows: DataFrame, node: str, labels: DataFrame) -> DataFrame:
    return rows.join(labels, F.col(node) == F.col("id"), "left").withColumn("root", F.coalesce("root", node)).drop("id")


def open_members(buckets: DataFrame, pivots: DataFrame, labels: DataFrame) -> DataFrame:
    """(u, q): members of buckets that hold several components, with the buckets' pivots."""
    placed = placed_in(buckets.select("key", "rep"), "rep", labels)
    several = placed.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("key")
    return placed.join(several, "key").join(pivots, "key").filter("q <> rep").select(F.col("rep").alias("u"), "q").distinct()


def pairs_by_difference(diffs: DataFrame, labels: DataFrame) -> DataFrame:
    """(u, v) that may be linked although their components differ, from what both differ from a common pivot in.

    With n(u) shingles and d(u) differences from q, u and v are linked exactly
    if their differences share at least (d(u) + d(v) - (n(u) + n(v)) / 7) / 2
    entries. Not both are linked with q, and an unlinked v has
    d(v) > (n(v) + n(q)) / 7, which bounds the prefix of u's differences, rarest
    first, that must meet v's. Copies with edits of their own share no rare
    differences, so they never meet, however many there are.
    """
    d = placed_in(diffs.withColumn("nd", F.size("diff").cast("long")), "u", labels)
    entries = d.select("q", "u", F.explode("diff").alias("x"))
    common = entries.groupBy("q", "x").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    ordered = (
        entries.join(common, ["q", "x"])
        .groupBy("q", "u")
        .agg(F.sort_array(F.collect_list(F.struct("n", "x"))).alias("xs"))
        .join(d.drop("diff"), ["q", "u"])
    )
    # Entries that only one member has stand before all others.
    at = F.col("nd") - F.size("xs") + F.col("k") + 1
    short = F.floor((7 * F.col("nd") + F.col("size") - F.col("other")) / 14) + 1
    rows = (
        ordered.select("*", F.posexplode("xs").alias("k", "e"))
        .select("q", F.col("e.x").alias("x"), "u", "size", "nd", "linked", "root", at.alias("at"), (at <= short).alias("early"))
        .filter("early OR NOT linked")
    )
    a = rows.filter("early").select("q", "x", *[F.col(c).alias(f"{c}_a") for c in ("u", "size", "nd", "linked", "root", "at")])
    met = a.join(rows.filter("NOT linked"), ["q", "x"]).filter(
        (F.col("root_a") != F.col("root"))
        & (F.col("linked_a") | (F.col("early") & (F.col("u_a") < F.col("u"))))
        & (4 * F.least("size", "size_a") >= 3 * F.greatest("size", "size_a"))
        & (
            14 * (1 + F.least(F.col("nd") - F.col("at"), F.col("nd_a") - F.col("at_a")))
            >= 7 * (F.col("nd") + F.col("nd_a")) - F.col("size") - F.col("size_a")
        )
    )
    return met.select(F.least("u_a", "u").alias("u"), F.greatest("u_a", "u").alias("v")).distinct()


def keyed_duplicates(docs: DataFrame) -> DataFrame:
    """(key, doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    sketch = stored(sketches(docs), "sketches")
    classes = (
        sketch.filter("n_shingles > 0")
        .groupBy("fingerprint")
        .agg(F.min("key").alias("rep"), F.min("doc_id").alias("least"), F.max("signature").alias("signature"))
    )
    classes = stored(classes, "classes")
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.substring(F.col("signature"), b * (4 * ROWS) + 1, F.lit(4 * ROWS))),
    )
    members = classes.select("rep", F.explode(keys).alias("key"))
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = stored(members.join(shared, "key"), "buckets")
    candidates = buckets.select(F.col("rep").alias("doc_id")).distinct()
    texts = keyed(docs).select(F.col("key").alias("doc_id"), "text").join(candidates, "doc_id", "left_semi")
    texts = stored(texts, "texts")
    pivots = stored(pivots_of(buckets), "pivots")
    links = stored(confirmed(alike(pivot_pairs(buckets, pivots), classes), texts), "links")
    labels = components(links)
    diffs = stored(differences(open_members(buckets, pivots, labels), texts), "differences")
    if not diffs.isEmpty():
        links = links.union(diffs.filter("linked").select("u", F.col("q").alias("v")))
        labels = components(links)
        more = stored(confirmed(alike(pairs_by_difference(diffs, labels), classes), texts), "more")
        labels = labels if more.isEmpty() else components(links.union(more))
    placed = classes.select("fingerprint", "rep", "least").join(labels, F.col("rep") == F.col("id"), "left").select(
        "fingerprint", "least", F.coalesce("root", "rep").alias("root")
    )
    # A root from ``NO_ID`` on may be the key of a row without an id, or an id with lesser ones of its component behind it.
    high = placed.filter(F.col("root") >= NO_ID).groupBy("root").agg(F.min("least").alias("component"))
    # All other rows are dealt out by negative numbers, which meet nothing: a root of many classes is no hot key.
    apart = F.when(F.col("root") >= NO_ID, F.col("root")).otherwise(-1 - F.pmod(F.xxhash64("fingerprint"), F.lit(1 << 30)))
    met = placed.drop("least").withColumn("met", apart).join(high.withColumnRenamed("root", "met"), "met", "left")
    placed = met.drop("met").withColumn(
        "component", F.when(F.col("root") < NO_ID, F.col("root")).otherwise(F.col("component"))
    )
    out = sketch.select("key", "doc_id", "n_shingles", "fingerprint").join(placed, "fingerprint", "left")
    # Texts without words have no class.
    alone = F.col("n_shingles") == 0
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component"))
    kept = alone | F.coalesce(F.col("doc_id") == F.col("component"), F.col("component").isNull() & (F.col("key") == F.col("root")))
    return out.select("key", "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(kept, F.lit(False)).alias("kept"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    return keyed_duplicates(docs).drop("key")


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each component; repeats of its text go, texts without words stay."""
    key, text = free_name("_key", docs), free_name("_text", docs)
    repeated = F.count_if(F.col("n_shingles") > 0) > 1
    kept = stored(keyed_duplicates(docs).filter("kept").groupBy(F.col("key").alias(key)).agg(repeated.alias("repeated")), "kept")
    rows = docs.withColumn(key, row_key())
    once = rows.join(kept.filter("NOT repeated").select(key), key, "left_semi")
    again = kept.filter("repeated").select(key)
    if not again.isEmpty():
        several = rows.join(again, key, "left_semi").withColumn(text, whole_text())
        once = once.union(several.dropDuplicates([key, text]).drop(text))
    return once.select(*docs.columns)


@query("op3_near_dup")
def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
