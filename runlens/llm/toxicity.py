"""Toxicity by subword-bag embeddings and a linear softmax, trained jointly in numpy.

A word's vector is the mean of the embeddings of its hashed character n-grams,
so a misspelling shares most of the vector of the word it comes from. Vectors are
averaged twice, over windows of a few neighbouring words and over the whole text,
and go through two linear softmax heads on the same embeddings: a text's logit is
that of its most toxic window plus that of its mean. One insult in a long text so
counts as much as in a short one, while clean windows and repeats add nothing.
In training the most toxic window is a weighted mean that sharpens from epoch to
epoch (``SHARPEST``), so early steps reach all windows.

Training sees at most ``TRAIN_ROWS`` labelled texts of each class, first by
hashed id, and of these whole texts as many as fit into ``TRAIN_CHARS``
characters together; held-out ids never. Scoring covers every whole text and
needs no shuffle.

Defined cases: a missing or empty text gets the score of no windows; without
labelled rows of both classes every text gets the same score; a label that is
missing counts for nothing, repeated labels count as toxic if any does; columns
named like an added one are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runlens.llm.common import arrow_rows, table, whole_text
from runlens.llm.registry import query

TRAIN_ROWS = 2500
TRAIN_CHARS = 40_000_000
BINS = 1 << 18
SIZE = 8
WINDOW = 6
GRAMS = (3, 4, 5)
EPOCHS, LEAST_STEPS = 5, 400
BATCH = 64
KEPT_WORDS = 300_000
LEAST_SCORE = 0.3
START_BIAS = -5.0
SHARPEST = 10.0
EDGES = " \t\r\n.,;:!?\"'()[]{}#$%&*|<>-_=+~^`/\\"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def words_of(text: str) -> list[str]:
    return [s for w in text.lower().split() if (s := w.strip(EDGES))]


def grams_of(word: str) -> list[int]:
    """Bins of the word's character n-grams and of the word itself."""
    b = f"<{word}>".encode()
    mask, crc = BINS - 1, zlib.crc32
    return [crc(b[i : i + n]) & mask for n in GRAMS for i in range(len(b) - n + 1)] + [crc(b, 1) & mask]


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, axis=0)


class Bags:
    """Texts as windows of words, and distinct words as bags of n-grams."""

    def __init__(self, texts: list[str]):
        index: dict[str, int] = {}
        self.texts = [np.array([index.setdefault(w, len(index)) for w in words_of(t)], np.int64) for t in texts]
        grams = [grams_of(w) for w in index]
        self.counts = np.array([len(g) for g in grams], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.counts)))
        self.grams = np.fromiter((g for x in grams for g in x), np.int64, int(self.starts[-1]))

    def grams_at(self, words: np.ndarray) -> np.ndarray:
        counts = self.counts[words]
        first = np.repeat(self.starts[words] - np.cumsum(counts) + counts, counts)
        return self.grams[first + np.arange(len(first))]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def epochs_for(rows: int) -> int:
    return max(EPOCHS, LEAST_STEPS // (rows // BATCH + 1))


def train(texts: list[str], labels: list[int], epochs: int | None = None) -> dict:
    """Embeddings, weights of both heads and bias, by adaptive gradient steps over random batches."""
    rng = np.random.default_rng(31)
    bags = Bags(texts)
    known = np.array([k for k, t in enumerate(bags.texts) if len(t)], np.int64)
    y = np.array(labels, np.float64)
    embed = rng.uniform(-1 / SIZE, 1 / SIZE, (BINS, SIZE)).astype(np.float32)
    # Two classes each: first for windows, then for the mean of the text.
    heads = rng.normal(0, 0.3, (2, SIZE, 2)).astype(np.float32)
    bias = np.array([0.0, START_BIAS], np.float32)
    seen = {"e": np.full(BINS, 1e-6, np.float32), "w": np.full(heads.shape, 1e-6, np.float32), "b": np.full(2, 1e-6, np.float32)}
    positives = max(1.0, y[known].sum()) if len(known) else 1.0
    lift = min(3.0, max(1.0, (len(known) - positives) / positives))
    epochs = (epochs or epochs_for(len(known))) if len(set(y[known])) == 2 else 0
    for epoch in range(epochs):
        rate = 0.5 * (1 - epoch / epochs) + 0.05
        sharp = 1 + (SHARPEST - 1) * epoch / max(epochs - 1, 1)
        order = rng.permutation(known)
        for at in range(0, len(known), BATCH):
            chosen = order[at : at + BATCH]
            lengths = np.array([len(bags.texts[k]) for k in chosen])
            words, back = np.unique(np.concatenate([bags.texts[k] for k in chosen]), return_inverse=True)
            grams, counts = bags.grams_at(words), bags.counts[words]
            vectors = sums(embed[grams], np.cumsum(counts) - counts) / counts[:, None]
            per_text = -(-lengths // WINDOW)
            text_starts = np.cumsum(per_text) - per_text
            inside = np.arange(per_text.sum()) - np.repeat(text_starts, per_text)
            begin = np.repeat(np.cumsum(lengths) - lengths, per_text) + inside * WINDOW
            size = np.minimum(WINDOW, np.repeat(lengths, per_text) - inside * WINDOW)
            in_window = sums(vectors[back], begin)
            bag, mean = in_window / size[:, None], sums(in_window, text_starts) / lengths[:, None]
            window_head, text_head = heads[:, :, 1] - heads[:, :, 0]
            margin = bag @ window_head
            top = np.maximum.reduceat(margin, text_starts)
            share = np.exp(sharp * (margin - np.repeat(top, per_text)))
            share /= np.repeat(sums(share, text_starts), per_text)
            p = sigmoid(sums(share * margin, text_starts) + mean @ text_head + bias[1] - bias[0])
            pull = ((p - y[chosen]) * np.where(y[chosen] > 0, lift, 1.0) / len(chosen)).astype(np.float32)
            g = (np.repeat(pull, per_text) * share).astype(np.float32)
            to_words = np.repeat(g[:, None] * window_head / size[:, None], size, axis=0)
            to_words += np.repeat(pull[:, None] * text_head / lengths[:, None], lengths, axis=0)
            by_word = np.stack([np.bincount(back, to_words[:, d], len(words)) for d in range(SIZE)], axis=1) / counts[:, None]
            bins, place = np.unique(grams, return_inverse=True)
            wide = np.repeat(by_word, counts, axis=0)
            step = np.stack([np.bincount(place, wide[:, d], len(bins)) for d in range(SIZE)], axis=1).astype(np.float32)
            seen["e"][bins] += (step**2).mean(axis=1)
            embed[bins] -= rate * step / np.sqrt(seen["e"][bins])[:, None]
            toxic = np.stack([bag.T.astype(np.float32) @ g, mean.T.astype(np.float32) @ pull])
            for value, name, change in ((heads, "w", np.stack([-toxic, toxic], axis=2)), (bias, "b", np.array([-pull.sum(), pull.sum()]))):
                seen[name] += change**2
                value -= 0.2 * rate * change / np.sqrt(seen[name])
    # A gram's part in the logits is all that scoring needs.
    window, text = (embed @ (head[:, 1] - head[:, 0]).astype(np.float32) for head in heads)
    return {"windows": window, "texts": text, "bias": float(bias[1] - bias[0])}


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the bounded sample."""
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    first = lambda flag: known.filter(f"toxic = {flag}").orderBy(F.xxhash64("_id"), "_id").limit(TRAIN_ROWS)
    sample = first(0).union(first(1))  # two bounded lists of ids
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), whole_text().alias("text"))
    # A text beyond the whole bound cannot be part of a sample within it.
    fitting = texts.filter(F.length("text") <= TRAIN_CHARS).join(F.broadcast(sample), "_id")
    single = fitting.groupBy("_id", "toxic").agg(F.max("text").alias("text"))
    so_far = F.sum(F.length("text")).over(Window.orderBy(F.xxhash64("_id"), "_id").rowsBetween(Window.unboundedPreceding, 0))
    return single.withColumn("_chars", so_far).filter(F.col("_chars") <= TRAIN_CHARS).drop("_chars")


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """The model, trained in one task from the bounded sample."""

    def run(batches):
        rows = sorted((r["_id"], r["text"], r["toxic"]) for b in batches for r in b.to_pylist())
        model = train([r[1] for r in rows], [r[2] for r in rows])
        packed = zlib.compress(pickle.dumps(model), 1)
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["model"])

    packed = training_rows(docs, labels).repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(zlib.decompress(packed.model)) if packed else train([], [])


class WordScores(dict):
    """Word -> its mean part in the logit of a window, and in ``in_text`` in that of a text; a memory for ``KEPT_WORDS`` and one text."""

    def __init__(self, model: dict):
        super().__init__()
        self.windows, self.texts, self.bias = model["windows"].tolist(), model["texts"].tolist(), model["bias"]
        self.in_text: dict[str, float] = {}

    def __missing__(self, word: str) -> float:
        bins = grams_of(word)
        self.in_text[word] = sum(map(self.texts.__getitem__, bins)) / len(bins)
        score = self[word] = sum(map(self.windows.__getitem__, bins)) / len(bins)
        return score

    def of(self, text: str) -> float:
        words = words_of(text)
        if not words:
            return sigmoid(self.bias)
        if len(self) >= KEPT_WORDS:
            self.clear()
            self.in_text.clear()
        values = np.fromiter(map(self.__getitem__, words), np.float64, len(words))
        starts = np.arange(0, len(words), WINDOW)
        top = (np.add.reduceat(values, starts) / np.minimum(WINDOW, len(words) - starts)).max()
        return sigmoid(top + sum(map(self.in_text.__getitem__, words)) / len(words) + self.bias)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with score and predicted."""
    docs = docs.select(*[c for c in docs.columns if c not in ("score", "predicted")])
    place = docs.columns.index("text")
    schema = docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        of = WordScores(shared.value).of

        def step(batch):
            found = np.array([of(t.as_py() or "") for t in batch.column(place)], np.float64)
            columns = [*batch.columns, pa.array(found), pa.array((found >= LEAST_SCORE).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

        return step

    return docs.mapInArrow(arrow_rows(make), schema)


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
