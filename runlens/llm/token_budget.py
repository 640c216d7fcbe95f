"""Exact token counts at every prefix of a text, by dynamic programming over the vocabulary.

The last token of a byte-pair encoding of a prefix is the one vocabulary entry
that ends there, whose remaining prefix is encoded too, and that stays apart
from that prefix's last token when both are encoded together. So a table over
positions holds the token count of *every* prefix, and truncation or budget
questions are look-ups. No entry of the vocabulary holds a blank after another
character, so texts fall into independent words and the table of a word is
kept; words recur, so a text costs one look-up for each of its words.

Defined cases: a missing or empty text has no tokens, rows are never joined or
dropped, so repeated rows and clashing column names do no harm.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.common import arrow_rows, by_length, table, whole_text
from runlens.llm.registry import query

LIMIT = 4096
KEPT_WORDS = 500_000
CHARS_AT_ONCE = 2_000_000
# Entries of the vocabulary hold letters or other characters, not both, so a
# word ends there too; texts with one of the exceptions are split at blanks only.
WORD = re.compile(r" *[^\W\d_]+| *(?:[^\w \n]|[\d_])+| +|\n")
BLANK_WORD = re.compile(r" *[^ \n]+| +|\n")


class PrefixCounts(dict):
    """Word -> token count; ``prefixes`` gives the counts at all prefixes of a word.

    A bounded memory: it starts anew when ``KEPT_WORDS`` words are held.
    """

    def __init__(self, model_file: str):
        import sentencepiece

        super().__init__()
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        sp, ids = self.sp, range(self.sp.get_piece_size())
        self.pieces = {
            sp.id_to_piece(i): i
            for i in ids
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
        }
        if any("▁" in p.lstrip("▁") for p in self.pieces):
            raise ValueError("the vocabulary joins words; prefixes of words are not independent")
        self.mixed = [p.strip("▁") for p in self.pieces if len(WORD.findall(p.replace("▁", " "))) > 1]
        # Lengths of the entries that end in two given characters, longest first.
        lengths: dict[str, set[int]] = {}
        for p in self.pieces:
            if len(p) > 1:
                lengths.setdefault(p[-2:], set()).add(len(p))
        self.lengths = {k: sorted(v, reverse=True) for k, v in lengths.items()}
        self.apart: dict[str, bool] = {}

    def stay_apart(self, left: str, right: str) -> bool:
        """Whether encoding ``left + right`` gives just these two entries."""
        # A line break is never part of an entry, and keeps the library's own
        # leading blank away from the pair.
        ids = self.sp.encode(f"\n{left}{right}")
        if len(self.apart) > 2 * KEPT_WORDS:
            self.apart.clear()
        known = self.apart[f"{left}\n{right}"] = ids[2:] == [self.pieces[left], self.pieces[right]]
        return known

    def extend(self, s: str, counts: list[int], last: list[str]) -> None:
        """Continue the tables of a prefix of ``s`` to all of ``s``; entry 0 is the empty prefix."""
        pieces, lengths, apart = self.pieces, self.lengths, self.apart
        for end in range(len(counts), len(s) + 1):
            for size in lengths.get(s[end - 2 : end], ()) if end > 1 else ():
                start = end - size
                if start < 0 or (piece := s[start:end]) not in pieces:
                    continue
                before = last[start]
                if before:
                    fits = apart.get(f"{before}\n{piece}")
                    if not (self.stay_apart(before, piece) if fits is None else fits):
                        continue
                counts.append(counts[start] + 1)
                last.append(piece)
                break
            else:
                char = s[end - 1]
                known = char in pieces  # else one token for each of its bytes
                counts.append(counts[-1] + (1 if known else len(char.encode())))
                last.append(char if known else "")

    def prefixes(self, word: str) -> list[int]:
        """Token counts of word[:1], word[:2], ..."""
        counts, last = [0], [""]
        self.extend(word.replace(" ", "▁"), counts, last)
        return counts[1:]

    def learn(self, words: set[str]) -> None:
        """Tables of new words; in sorted order each continues its neighbour's common prefix."""
        counts, last, held = [0], [""], ""
        for word in sorted(words):
            s = word.replace(" ", "▁")
            same, most = 0, min(len(s), len(held))
            while same < most and s[same] == held[same]:
                same += 1
            del counts[same + 1 :], last[same + 1 :]
            self.extend(s, counts, last)
            self[word], held = counts[-1], s

    def __missing__(self, word: str) -> int:
        self.learn({word})
        return self[word]

    def counts(self, texts: list[str]) -> list[int]:
        """Token counts of whole texts."""
        split = [self.words(t) for t in texts]
        new = {w for words in split for w in words if w not in self}
        if len(self) + len(new) > KEPT_WORDS:
            self.clear()
            new = set().union(*split)
        self.learn(new)
        return [sum(map(self.__getitem__, words)) for words in split]

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        word = BLANK_WORD if any(p in text for p in self.mixed) else WORD
        return word.findall(" " + text.replace("▁", " "))

    def fitting(self, text: str, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens (a shorter prefix may have more)."""
        words = self.words(text)
        if not words:
            return 0
        ends = np.cumsum([self[w] for w in words])
        # No prefix that ends in a later word fits once the words before it exceed the budget.
        stop = int(np.searchsorted(ends, budget, side="right"))
        sizes = np.cumsum([len(w) for w in words])
        if stop == len(words):
            return len(text)
        done = int(ends[stop - 1]) if stop else 0
        inside = [k + 1 for k, n in enumerate(self.prefixes(words[stop])) if done + n <= budget]
        return max(0, (int(sizes[stop - 1]) if stop else 0) + (inside[-1] if inside else 0) - 1)


def model_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, budget: int = LIMIT, vocabulary: str = "piece_bpe_32k.model", text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, and fit_chars: how many characters of the text fit the budget.

    Columns of ``docs`` with these names are replaced.
    """
    docs = docs.drop(*[c for c in ("n_tokens", "fit_chars") if c != text])
    schema = docs.withColumns({"n_tokens": F.lit(0).cast("long"), "fit_chars": F.lit(0).cast("long")}).schema

    def make():
        table_of = PrefixCounts(model_path(vocabulary))

        def step(batch):
            column = batch.column(batch.schema.get_field_index(text))
            counts, fits = [], []
            for texts in by_length((v.as_py() or "" for v in column), CHARS_AT_ONCE):
                found = table_of.counts(texts)
                counts += found
                fits += [len(t) if n <= budget else table_of.fitting(t, budget) for t, n in zip(texts, found)]
            batch = batch.append_column("n_tokens", pa.array(counts, pa.int64()))
            yield batch.append_column("fit_chars", pa.array(fits, pa.int64()))

        return step

    return docs.mapInArrow(arrow_rows(make), schema)


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", whole_text().alias("text"))
    return token_counts(docs).select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > LIMIT).alias("over_limit"),
        "fit_chars",
    )
