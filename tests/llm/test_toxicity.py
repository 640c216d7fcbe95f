from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from runlens.llm import toxicity
from tests.llm import brute

SCHEMA = "doc_id long, text string"
INSULTS = ["wretchling", "bogbreath", "numskull"]


def made(n: int, seed: int):
    rng = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        words = brute.prose(rng, rng.randrange(10, 200)).split(" ")
        toxic = k % 3 == 0
        for _ in range(2 * toxic):
            words[rng.randrange(len(words))] = rng.choice(INSULTS)
        docs.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = made(600, 1)
    rng = random.Random(2)
    # Held-out misspellings, never seen in training.
    unseen = [(10_000 + k, brute.prose(rng, 40) + " " + w + " " + brute.prose(rng, 40)) for k, w in enumerate(["wretchlng", "bogbreathh", "numskul"] * 5)]
    extra = [(20_000, None), (20_001, ""), (None, "a wretchling"), (20_002, "word " * 30_000)]
    df = spark.createDataFrame(docs + unseen + extra, SCHEMA)
    model = toxicity.fit(df, spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int"))
    rows = toxicity.score(df.withColumn("score", df.doc_id), model).collect()
    return docs, dict(labels), rows


def test_held_out_accuracy(scored):
    docs, labels, rows = scored
    held = [r for r in rows if r.doc_id is not None and r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 100
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def test_unseen_misspellings(scored):
    rows = [r for r in scored[2] if r.doc_id is not None and 10_000 <= r.doc_id < 20_000]
    assert np.mean([r.predicted for r in rows]) > 0.7


def test_missing_empty_and_long_texts(scored):
    rows = {r.doc_id: r for r in scored[2] if r.doc_id is None or r.doc_id >= 20_000}
    assert rows[20_000].score == rows[20_001].score < 0.3
    assert rows[None].predicted == 1 and rows[20_002].predicted == 0
    assert len(scored[2]) == 619


def test_no_labels_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "wretchling")], SCHEMA)
    model = toxicity.fit(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert len({r.score for r in toxicity.score(df, model).collect()}) >= 1
    assert toxicity.score(df.filter("doc_id > 5"), model).count() == 0


def test_held_out_labels_are_never_used(spark):
    docs, labels = made(80, 4)
    df, known = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    used = {r["_id"] for r in toxicity.training_rows(df, known).collect()}
    assert used and not any(zlib.crc32(str(i).encode()) % 4 == 2 for i in used)


def plain_training(texts, labels, epochs):
    """The same steps, one text, window and word at a time."""
    t = toxicity
    rng = np.random.default_rng(31)
    docs = [t.words_of(x) for x in texts]
    known = np.array([k for k, d in enumerate(docs) if d])
    embed = rng.uniform(-1 / t.SIZE, 1 / t.SIZE, (t.BINS, t.SIZE))
    heads, bias = rng.normal(0, 0.3, (2, t.SIZE, 2)), np.array([0.0, t.START_BIAS])
    seen_e, seen_w, seen_b = np.full(t.BINS, 1e-6), np.full(heads.shape, 1e-6), np.full(2, 1e-6)
    positives = sum(labels[k] for k in known)
    lift = min(3.0, max(1.0, (len(known) - positives) / positives))
    for epoch in range(epochs):
        rate, sharp = 0.5 * (1 - epoch / epochs) + 0.05, 1 + (t.SHARPEST - 1) * epoch / max(epochs - 1, 1)
        order = rng.permutation(known)
        for at in range(0, len(order), t.BATCH):
            chosen = order[at : at + t.BATCH]
            to_embed, to_heads, to_bias = {}, np.zeros(heads.shape), np.zeros(2)
            window_head, text_head = heads[0, :, 1] - heads[0, :, 0], heads[1, :, 1] - heads[1, :, 0]
            for k in chosen:
                vectors = [np.mean([embed[g] for g in t.grams_of(w)], axis=0) for w in docs[k]]
                windows = [range(i, min(i + t.WINDOW, len(vectors))) for i in range(0, len(vectors), t.WINDOW)]
                bags = [np.mean([vectors[i] for i in w], axis=0) for w in windows]
                margins = [float(b @ window_head) for b in bags]
                weights = np.exp([sharp * (m - max(margins)) for m in margins])
                weights /= weights.sum()
                mean = np.mean(vectors, axis=0)
                p = 1 / (1 + np.exp(-(weights @ margins + mean @ text_head + bias[1] - bias[0])))
                pull = (p - labels[k]) * (lift if labels[k] else 1.0) / len(chosen)
                for window, weight, bag in zip(windows, weights, bags):
                    to_heads[0] += np.outer(pull * weight * bag, [-1, 1])
                    for i in window:
                        change = pull * (weight * window_head / len(window) + text_head / len(vectors))
                        grams = t.grams_of(docs[k][i])
                        for g in grams:
                            to_embed[g] = to_embed.get(g, 0) + change / len(grams)
                to_heads[1] += np.outer(pull * mean, [-1, 1])
                to_bias += pull * np.array([-1, 1])
            for g, change in to_embed.items():
                seen_e[g] += (change**2).mean()
                embed[g] -= rate * change / np.sqrt(seen_e[g])
            seen_w += to_heads**2
            heads -= 0.2 * rate * to_heads / np.sqrt(seen_w)
            seen_b += to_bias**2
            bias -= 0.2 * rate * to_bias / np.sqrt(seen_b)
    return embed, heads, bias


def plain_score(text, embed, heads, bias):
    t = toxicity
    vectors = [np.mean([embed[g] for g in t.grams_of(w)], axis=0) for w in t.words_of(text)]
    logit = bias[1] - bias[0]
    if vectors:
        windows = [np.mean(vectors[i : i + t.WINDOW], axis=0) for i in range(0, len(vectors), t.WINDOW)]
        logit += max(w @ (heads[0, :, 1] - heads[0, :, 0]) for w in windows) + np.mean(vectors, axis=0) @ (heads[1, :, 1] - heads[1, :, 0])
    return 1 / (1 + np.exp(-logit))


def test_training_and_score_against_a_plain_version(spark):
    docs, labels = made(100, 5)
    texts, y = [t for _, t in docs] + ["", "one"], [x for _, x in labels] + [0, 1]
    plain = plain_training(texts, y, 3)
    rows = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    for r in toxicity.score(rows, toxicity.train(texts, y, 3)).collect():
        assert abs(r.score - plain_score(r.text, *plain)) < 1e-3


def test_repeated_and_long_clean_texts_stay_clean(spark):
    docs, labels = made(600, 1)
    model = toxicity.train([t for _, t in docs], [x for _, x in labels])
    rng = random.Random(6)
    rows = [(k, (brute.prose(rng, 40) + " ") * 400) for k in range(10)] + [(100 + k, brute.prose(rng, 20_000)) for k in range(5)]
    rows += [(200 + k, brute.prose(rng, 5000) + " wretchling numskull " + brute.prose(rng, 5000)) for k in range(5)]
    for r in toxicity.score(spark.createDataFrame(rows, SCHEMA), model).collect():
        assert r.predicted == (r.doc_id >= 200), r.doc_id


def test_training_texts_are_whole_and_bounded_together(spark, monkeypatch):
    docs, labels = made(80, 4)
    df, known = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "TRAIN_CHARS", 12_000)
    used = {r["_id"]: r["text"] for r in toxicity.training_rows(df, known).collect()}
    assert used and all(dict(docs)[i] == t for i, t in used.items())
    assert sum(map(len, used.values())) <= 12_000
