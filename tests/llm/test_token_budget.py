from __future__ import annotations

import random

import pytest

from runlens.llm import token_budget
from tests.llm import brute


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=token_budget.model_path("piece_bpe_32k.model"))


def odd_texts():
    rng = random.Random(1)
    chars = "abcdethn  \n▁éß1.<>s/中😀\t'².'\x00"
    texts = ["".join(rng.choice(chars) for _ in range(rng.randrange(30))) for _ in range(600)]
    texts += [s for k in range(1, 40) for s in (" " * k, "a" + " " * k + "b", "\n" + " " * k + "the", "▁" * k)]
    return texts + ["<s>x</s><unk>", "²." * 9 + " the.²", "ab" * 4000]


def test_every_prefix_has_the_count_of_its_own_encoding(library):
    table = token_budget.PrefixCounts(token_budget.model_path("piece_bpe_32k.model"))
    for text in odd_texts()[:150] + [t for _, t in brute.awkward_documents(1) if t and len(t) < 600][:5]:
        counts, done = [], 0
        for word in table.words(text):
            inside = table.prefixes(word)
            counts += [done + n for n in inside]
            done += inside[-1]
        assert counts[1:] == [len(library.encode(text[:k])) for k in range(1, len(text) + 1)], repr(text)


def test_counts_and_budgets_of_whole_tables(spark, library):
    rows = brute.awkward_documents(2) + [(10_000 + k, t) for k, t in enumerate(odd_texts())]
    df = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r for r in token_budget.token_counts(df, budget=20).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        t = t or ""
        assert got[d].n_tokens == len(library.encode(t)), repr(t)
        if len(t) < 400:
            assert got[d].fit_chars == max(k for k in range(len(t) + 1) if len(library.encode(t[:k])) <= 20)


def test_memory_is_bounded(monkeypatch, library):
    monkeypatch.setattr(token_budget, "KEPT_WORDS", 50)
    table = token_budget.PrefixCounts(token_budget.model_path("piece_bpe_32k.model"))
    texts = [t or "" for _, t in brute.awkward_documents(3)]
    assert [table.counts([t])[0] for t in texts] == [len(library.encode(t)) for t in texts]


def test_empty_table(spark):
    assert token_budget.token_counts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
