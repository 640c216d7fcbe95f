"""Byte-pair encoding through a table of distinct words, and decoding through a table of pieces.

Texts are split once into the words of the vocabulary's own pattern, on all
executors. A task cuts its rows into pieces and writes each text as numbers into
its piece's list of distinct words. The lists of all pieces meet by word; each
distinct word of the corpus is encoded once, and its ids go back to every
(piece, place) that holds it. Texts stay where they were written: their table is
bucketed by piece, so only words and their ids are shuffled. A piece holds a word
once, however frequent it is, so no word is a hot key, and nothing depends on
ids, hashes of rows or their number. Decoding looks every id up in the
id-to-piece table, one row for each vocabulary entry.

Defined cases: a missing or empty text has no ids; the vocabulary's special
strings inside texts become their ids; rows without an id, of one id or equal in
all columns are rows of their own and all stay; columns named like an added one
are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import unicodedata
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.llm.common import arrow_rows, shared_folder, table, whole_text
from runlens.llm.registry import query

VOCABULARY = "byte_bpe_50k.json"
# A piece ends with the text that brings it to so many distinct words or characters.
PIECE_WORDS, PIECE_CHARS = 1 << 19, 1 << 25
# Bytes of text for each bucket of the table of written texts.
BUCKET_BYTES = 16 << 20
# Words whose ids are sent back together, and texts that are returned together.
WORDS_AT_ONCE, TEXTS_AT_ONCE = 1 << 17, 500
# Marks that stand together as one word behind letters, and in none of the vocabulary's special strings.
PLAIN_MARKS = ",.;:!?"
# The two libraries know different Unicode versions; within these ranges they agree.
AGREED = r"[^\x00-ԯ - 　-鿯가-힣]"


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def plain_pattern(pattern: str) -> re.Pattern:
    """The vocabulary's pattern for the standard library, exact within the agreed ranges.

    The contractions may come second, as no other word before them starts with an apostrophe.
    """
    # Fixed value: the pattern that this rewrites.
    if pattern != r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+":
        raise ValueError("the vocabulary splits words by another pattern")
    space = r" \t\n\x0b\f\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    agreed = re.compile(AGREED.replace("[^", "["))
    other = "".join(c for c in map(chr, range(0xD800)) if agreed.match(c) and unicodedata.category(c) in ("No", "Nl"))
    letter, number = rf"[^\W\d_{other}]", rf"[\d{other}]"
    rest = rf"(?:[^\w{space}]|_)"
    return re.compile(rf" ?{letter}+| ?{number}+|'(?:[stmd]|re|ve|ll)| ?{rest}+|[{space}]+(?![^{space}])|[{space}]+")


class Splitter:
    """Texts to the words of a byte-level vocabulary; their encodings joined are the text's."""

    def __init__(self, name: str):
        import os

        import public_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        path = vocabulary_path(name)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{name} is not a plain byte-level vocabulary")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.word = plain_pattern(public_tokenizers.PATTERN)
        self.unusual = re.compile(AGREED)
        self.blanks = re.compile(r"\s ")
        self.cut = re.compile(r"(?<=\S) ")
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = set(special)
        self.apart = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def plain(self, text: str) -> list[str]:
        if self.unusual.search(text):
            return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return self.word.findall(text)

    def words(self, text: str) -> list[str]:
        if self.apart is None or not self.apart.search(text):
            return self.plain(text)
        out: list[str] = []
        for part in self.apart.split(text):
            out += [part] if part in self.special else self.plain(part)
        return out

    def units(self, text: str) -> list[str]:
        """``text`` cut at each blank that follows something else; all but the first lack that blank.

        No word reaches over such a place, so the words of a text are those of
        its first unit and of each other one with its blank.
        """
        if any(" " in s for s in self.special):
            return [text]
        return self.cut.split(text) if self.blanks.search(text) else text.split(" ")

    def unit_words(self, unit: str) -> list[str]:
        """The words of a unit that lacks its leading blank; letters with plain marks behind them need no pattern."""
        core = unit.rstrip(PLAIN_MARKS)
        if core.isalpha() and (core.isascii() or not self.unusual.search(core)):
            return [" " + core] if len(core) == len(unit) else [" " + core, unit[len(core) :]]
        return self.words(" " + unit)

    def encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]


def byte_letters() -> dict[str, int]:
    """The characters that stand for bytes: byte-level vocabularies write those that do not print as characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    return letters | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}


def pieces(name: str = VOCABULARY) -> list[bytes]:
    """The id-to-piece table: bytes of each vocabulary entry, in order of ids."""
    with open(vocabulary_path(name), encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    by_id = {i: bytes(letters[c] for c in piece) for piece, i in spec["model"]["vocab"].items()}
    by_id |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    return [by_id.get(i, b"") for i in range(max(by_id) + 1)]


def packed(numbers) -> bytes:
    """Numbers below 2^32, compressed byte plane by byte plane, as high bytes are mostly zero."""
    import zstandard

    data = numbers if isinstance(numbers, bytes) else np.asarray(numbers, "<u4")
    planes = np.frombuffer(data, np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


class Numbers(dict):
    """Words numbered as they come up, as 32-bit bytes; the units of texts that were met are remembered likewise."""

    def __init__(self, splitter: Splitter):
        super().__init__()
        self.splitter = splitter
        self.units: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        self[word] = number = len(self).to_bytes(4, "little")
        return number

    def text(self, text: str) -> bytes:
        """Numbers of all words of a text."""
        first, *rest = self.splitter.units(text)
        known, number, words_of = self.units, self.__getitem__, self.splitter.unit_words
        for unit in set(rest).difference(known):
            known[unit] = b"".join(map(number, words_of(unit)))
        return b"".join([*map(number, self.splitter.words(first)), *map(known.__getitem__, rest)])


def written_pieces(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The columns of ``docs`` without text, _piece, _packed (the text's words by number), _words; stored, bucketed by piece.

    A piece's own row has its words in order of their numbers and no text.
    """
    spark = docs.sparkSession
    others = [c for c in docs.columns if c != "text"]
    place = docs.columns.index("text")
    # Every column may be missing: in a piece's own row, or in those of its texts.
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema.fields if f.name != "text"])
    schema = schema.add("_piece", T.LongType()).add("_packed", T.BinaryType()).add("_words", T.ArrayType(T.StringType()))

    def make():
        splitter = Splitter(vocabulary)
        piece = TaskContext.get().partitionId() << 32
        numbers, chars = Numbers(splitter), 0

        def closing(fields):
            row = [pa.nulls(1, f.type) for f in fields]
            return pa.RecordBatch.from_arrays([*row, pa.array([piece]), pa.nulls(1, pa.binary()), pa.array([list(numbers)])], schema.names)

        def step(batch):
            nonlocal piece, numbers, chars
            kept = [k for k in range(batch.num_columns) if k != place]
            fields = [batch.schema.field(k) for k in kept]
            start, out = 0, []
            for at, value in enumerate(batch.column(place), 1):
                text = value.as_py()
                out.append(packed(numbers.text(text)))
                chars += len(text)
                full = len(numbers) >= PIECE_WORDS or chars >= PIECE_CHARS
                if full or at == batch.num_rows:
                    columns = [batch.column(k).slice(start, at - start) for k in kept]
                    columns += [pa.array([piece] * len(out)), pa.array(out, pa.binary()), pa.nulls(len(out), pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays(columns, schema.names)
                    start, out = at, []
                if full:
                    yield closing(fields)
                    piece, numbers, chars = piece + 1, Numbers(splitter), 0
            step.fields = fields

        step.last = lambda: [closing(step.fields)] if numbers else []
        return step

    def run(batches):
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield from step(batch)
        yield from step.last()

    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(spark.sparkContext.defaultParallelism, size // BUCKET_BYTES + 1)
    # A name is needed to write buckets; the files lie in the shared folder and outlive it.
    name = f"bpe_{uuid.uuid4().hex}"
    rows = docs.mapInArrow(run, schema)
    rows.write.option("compression", "zstd").bucketBy(int(buckets), "_piece").option("path", shared_folder(spark, "pieces")).saveAsTable(name)
    pieces = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return pieces


def word_ids(pieces: DataFrame, vocabulary: str) -> DataFrame:
    """(_piece, places): the ids of the words of ``pieces`` and their places there; each distinct word is encoded once."""

    def sent(rows):
        """Rows of (piece, place, ids) of many words, one row for each piece."""
        piece, at, ids = (pa.concat_arrays([r[k] for r in rows]) for k in range(3))
        piece, at = piece.to_numpy(), at.to_numpy()
        order = np.lexsort((at, piece))
        piece, at, ids = piece[order], at[order], ids.take(pa.array(order))
        sizes, flat, offsets = ids.value_lengths().to_numpy(), ids.flatten().to_numpy(), np.asarray(ids.offsets)
        begins = np.concatenate(([0], np.flatnonzero(np.diff(piece)) + 1))
        places = [
            packed(np.concatenate(([b - a], at[a:b], sizes[a:b], flat[offsets[a] - offsets[0] : offsets[b] - offsets[0]])))
            for a, b in zip(begins, [*begins[1:], len(piece)])
        ]
        return pa.RecordBatch.from_arrays([pa.array(piece[begins]), pa.array(places, pa.binary())], ["_piece", "places"])

    def encode_sorted(batches):
        splitter = Splitter(vocabulary)
        last, last_ids, rows, size = None, None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column(0).dictionary_encode()  # sorted, so equal words lie together
            distinct = words.dictionary.to_pylist()
            known = [last_ids] if distinct[0] == last else []
            ids = known + splitter.encode(distinct[len(known) :])
            last, last_ids = distinct[-1], ids[-1]
            lists = pa.array(ids, pa.list_(pa.int32())).take(words.indices)
            rows.append((batch.column(1), batch.column(2), lists))
            size += batch.num_rows
            if size >= WORDS_AT_ONCE:
                yield sent(rows)
                rows, size = [], 0
        if rows:
            yield sent(rows)

    words = pieces.filter("_words IS NOT NULL").select("_piece", F.posexplode("_words").alias("_at", "_word"))
    words = words.select("_word", "_piece", "_at").repartition("_word").sortWithinPartitions("_word")
    return words.mapInArrow(encode_sorted, "_piece long, places binary")


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, and_decode: bool = False) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ids (array of int) in place of text; or with the text that they decode to as well.

    Decoding in the same pass saves a second set of Python workers.
    """
    docs = docs.select(*[c for c in docs.columns if c != "ids"]).withColumn("text", whole_text())
    others = [c for c in docs.columns if c != "text"]
    pieces_table = written_pieces(docs, vocabulary)
    schema = docs.select(*others, F.lit(None).cast("array<int>").alias("ids"))
    schema = (schema.withColumn("text", F.lit(None).cast("string")) if and_decode else schema).schema

    def fill(texts: pa.Table, words: pa.Table) -> pa.Table:
        piece = pa.array(pieces(vocabulary), pa.binary()) if and_decode else None
        at, sizes, flat = [], [], []
        for blob in words.column("places").to_pylist():
            data = unpacked(blob)
            n = int(data[0])
            at.append(data[1 : n + 1])
            sizes.append(data[n + 1 : 2 * n + 1])
            flat.append(data[2 * n + 1 :].astype(np.int32))
        none = [np.zeros(0, np.int64)]
        at, sizes, flat = (np.concatenate(x or none) for x in (at, sizes, flat))
        starts, order = np.cumsum(sizes) - sizes, np.argsort(at)
        if not np.array_equal(at[order], np.arange(len(at))):
            raise ValueError("a piece did not get the ids of all its words")
        starts, sizes, flat = starts[order], sizes[order], flat.astype(np.int32)

        def ids_of(blob) -> pa.Array:
            numbers = unpacked(blob.as_py())
            count = sizes[numbers]
            place = np.repeat(starts[numbers] - np.cumsum(count) + count, count) + np.arange(count.sum())
            return pa.array(flat[place], pa.int32())

        batches = []
        for batch in texts.to_batches(max_chunksize=TEXTS_AT_ONCE):
            ids = [ids_of(x) for x in batch.column("_packed")]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays([pa.array([], pa.int32()), *ids]))
            columns = [*(batch.column(c) for c in others), lists]
            if and_decode:
                columns.append(pa.array(decoded(piece, lists), pa.string()))
            batches.append(pa.RecordBatch.from_arrays(columns, schema.names))
        kinds = pa.schema([texts.schema.field(c) for c in others] + [("ids", pa.list_(pa.int32()))] + [("text", pa.string())] * and_decode)
        return pa.Table.from_batches(batches) if batches else kinds.empty_table()

    texts = pieces_table.filter("_packed IS NOT NULL").select(*others, "_piece", "_packed")
    met = texts.groupBy("_piece").cogroup(word_ids(pieces_table, vocabulary).groupBy("_piece"))
    return met.applyInArrow(fill, schema)


def decoded(piece: pa.Array, lists: pa.ListArray) -> list[str]:
    """Texts of lists of ids: the pieces' bytes joined in order."""
    found = piece.take(lists.flatten())
    # The pieces of all lists stand joined in one buffer, in order of their positions.
    whole, at = memoryview(found.buffers()[2] or b""), np.asarray(pa.Array.from_buffers(pa.int32(), len(found) + 1, [None, found.buffers()[1]]))
    sizes = np.cumsum([0, *(len(x) if x.is_valid else 0 for x in lists)])
    cut = at[sizes]
    return [bytes(whole[a:b]).decode("utf-8", "replace") for a, b in zip(cut, cut[1:])]


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``encoded`` (ids, ...) with text: each id's piece from the id-to-piece table, bytes joined in order.

    Bytes that are no UTF-8 become replacement characters. A missing list gives an empty text.
    """
    encoded = encoded.select(*[c for c in encoded.columns if c != "text"])
    place = encoded.columns.index("ids")
    schema = encoded.withColumn("text", F.lit(None).cast("string")).schema

    def make():
        piece = pa.array(pieces(vocabulary), pa.binary())

        def step(batch):
            texts = decoded(piece, batch.column(place))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema.names)

        return step

    return encoded.mapInArrow(arrow_rows(make), schema)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with their ids, and the text that the ids decode to."""
    return encode(docs, and_decode=True).select(*docs.columns, F.size("ids").cast("long").alias("n_tokens"), "ids")


@query("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, and_decode=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
