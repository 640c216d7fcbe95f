"""Token ids as binary files: one shared zstandard dictionary, each document compressed apart.

Documents are dealt out by ranges of their id; each range becomes one shard,
encoded and written by the task that holds it. A dictionary is trained once on
serialised id arrays of a bounded sample (at most about ``SAMPLE_DOCUMENTS``
documents of at most ``SAMPLE_TOKENS`` ids each; it changes sizes only, every
document is written whole). A shard is a data file, whose header carries the
dictionary's hash and the width of an id and whose frames follow one another,
and an index file with id, offset, frame length and id count of each document.
So any document is read by one seek and one small frame (``fetch``), and a whole
shard is read by a task of its own (``read_back``). A task writes under a name
of its own attempt and renames at the end, so a repeated task leaves one whole
shard; the manifest names the shards and how many ids lie before each.

Defined cases: a missing or empty text has the end id alone; rows without an id
come first; rows of one id are ordered by a hash of their text, and equal rows
all stay; fewer than ``LEAST_SAMPLE`` samples give no dictionary (its hash is
then that of no bytes); other columns are not written; an empty table
gives no shard and no rows.
"""

from __future__ import annotations

import gc
import hashlib
import posixpath
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pfs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runlens.llm.bpe import VOCABULARY, Splitter, byte_letters
from runlens.llm.common import arrow_rows, shared_folder, stored, table, whole_text
from runlens.llm.registry import query

END_ID = 2
SAMPLE_DOCUMENTS, SAMPLE_TOKENS, LEAST_SAMPLE = 2048, 2048, 64
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
SHARD_BYTES = 64 << 20
# Words, and units around them, whose ids a task remembers; of older ones as many again.
WORDS_KEPT = 1 << 18

# The file format: a mark, the dictionary's hash, the bytes of one id.
MARK = b"TOKIDS01"
HEADER = len(MARK) + 32 + 1
INDEX = np.dtype([("has_id", "<u1"), ("doc_id", "<i8"), ("offset", "<u8"), ("length", "<u8"), ("n_tokens", "<u8")])


class Remembered(dict):
    """Values of a function, the last ``WORDS_KEPT`` or more that were asked for."""

    def __init__(self, value_of):
        super().__init__()
        self.value_of, self.older = value_of, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.value_of(key)
        if len(self) >= WORDS_KEPT:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Serialiser:
    """Whole texts to little-endian id arrays that close with the end id; words and the units around them are remembered."""

    def __init__(self, vocabulary: str):
        self.splitter = Splitter(vocabulary)
        tokenizer = self.splitter.tokenizer
        self.kind = np.dtype("<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.tokenize = tokenizer.model.tokenize
        self.special = {w: tokenizer.token_to_id(w) for w in self.splitter.special}
        self.shown = str.maketrans({chr(b): c for c, b in byte_letters().items()})
        self.blank = " ".translate(self.shown)
        self.words = Remembered(self.word)
        self.units = Remembered(self.unit)
        self.of_id = [x.tobytes() for x in np.arange(tokenizer.get_vocab_size(), dtype=self.kind)]
        self.end = self.of_id[END_ID]

    def word(self, word: str) -> bytes:
        if word in self.special:
            return self.of_id[self.special[word]]
        rest = word[1:]
        if word[0] == " " and rest.isalpha() and rest.isascii():
            shown = self.blank + rest
        else:
            shown = word.encode().decode("latin-1").translate(self.shown)
        return b"".join([self.of_id[t.id] for t in self.tokenize(shown)])

    def unit(self, unit: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.splitter.unit_words(unit)))

    def serialise(self, text: str) -> bytes:
        first, *rest = self.splitter.units(text)
        head = map(self.words.__getitem__, self.splitter.words(first))
        return b"".join([*head, *map(self.units.__getitem__, rest), self.end])


def is_short():
    """Texts whose id arrays may be looked at for the dictionary; arrays beyond ``SAMPLE_TOKENS`` ids are still left out."""
    return F.octet_length("text").between(1, 8 * SAMPLE_TOKENS)


def train_dictionary(docs: DataFrame, short: int, vocabulary: str = VOCABULARY) -> bytes:
    """A dictionary of serialised id arrays from a bounded sample of the ``short`` short documents; empty if there are too few."""
    import zstandard

    share = min(1.0, SAMPLE_DOCUMENTS / max(short, 1))
    picked = docs.select("text").filter(is_short()).filter(F.pmod(F.xxhash64(F.lit(17), "text"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def make():
        serialiser = Serialiser(vocabulary)

        def step(batch):
            rows = [serialiser.serialise(x) for x in batch.column(0).to_pylist()]
            rows = [r for r in rows if len(r) <= SAMPLE_TOKENS * serialiser.kind.itemsize]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["ids"])

        return step

    # Copies of one text are picked together; each counts once.
    sample = picked.distinct().mapInArrow(arrow_rows(make), "ids binary").limit(2 * SAMPLE_DOCUMENTS)
    samples = sorted(r.ids for r in sample.collect())
    if len(samples) < LEAST_SAMPLE:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""  # too little to learn from


def opened(path: str):
    """File system and path of a folder that all executors can reach."""
    return pfs.FileSystem.from_uri(path) if "://" in path or path.startswith(("file:", "/")) else (pfs.LocalFileSystem(), path)


def write_shards(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Writes ``docs`` (doc_id, text) below ``folder``; the manifest (shard, path, n_docs, n_ids, before) is stored and returned."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    size = F.octet_length("text")
    total, short = rows.agg(F.coalesce(F.sum(size + 16), F.lit(0)), F.count_if(is_short())).first()
    dictionary = train_dictionary(rows, short, vocabulary)
    held = spark.sparkContext.broadcast(dictionary)
    shards = max(spark.sparkContext.defaultParallelism, total // SHARD_BYTES + 1)
    by = [F.col("doc_id").asc_nulls_first(), F.col("_tie")]
    dealt = rows.withColumn("_tie", F.xxhash64("text")).repartitionByRange(int(shards), *by).sortWithinPartitions(*by)

    def write(batches):
        import zstandard

        fs, base = opened(folder)
        context = TaskContext.get()
        gc.disable()  # what a task makes here holds no cycles, and looking for them takes a sixth of its time
        try:
            yield from shard_of(batches, zstandard, fs, base, context)
        finally:
            gc.enable()

    def shard_of(batches, zstandard, fs, base, context):
        name = f"{context.partitionId():06d}"
        draft = posixpath.join(base, f"{name}-{context.taskAttemptId()}")
        out, index, at, n_ids = None, [], HEADER, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                serialiser = Serialiser(vocabulary)
                shared = zstandard.ZstdCompressionDict(held.value) if held.value else None
                packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=True)
                fs.create_dir(base, recursive=True)
                out = fs.open_output_stream(f"{draft}.ids")
                out.write(MARK + hashlib.sha256(held.value).digest() + bytes([serialiser.kind.itemsize]))
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = serialiser.serialise(text.as_py())
                frame = packer.compress(ids)
                out.write(frame)
                n = len(ids) // serialiser.kind.itemsize
                index.append((doc_id is not None, doc_id or 0, at, len(frame), n))
                at += len(frame)
                n_ids += n
        if out is None:
            return
        out.close()
        with fs.open_output_stream(f"{draft}.index") as f:
            f.write(np.array(index, INDEX).tobytes())
        for ending in ("index", "ids"):
            fs.move(f"{draft}.{ending}", f"{posixpath.join(base, name)}.{ending}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in ((int(name), pa.int64()), (posixpath.join(folder, name), pa.string()), (len(index), pa.int64()), (n_ids, pa.int64()))],
            ["shard", "path", "n_docs", "n_ids"],
        )

    fs, base = opened(folder)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(posixpath.join(base, "dictionary")) as f:
        f.write(dictionary)
    manifest = stored(dealt.mapInArrow(write, "shard long, path string, n_docs long, n_ids long"), "token-manifest")
    # One row for each shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


class Shard:
    """A shard's index and frames; frames are read one at a time."""

    def __init__(self, path: str):
        import zstandard

        fs, base = opened(path)
        with fs.open_input_stream(posixpath.join(posixpath.dirname(base), "dictionary")) as f:
            dictionary = f.read()
        with fs.open_input_stream(f"{base}.index") as f:
            self.index = np.frombuffer(f.read(), INDEX)
        self.data = fs.open_input_file(f"{base}.ids")
        header = self.data.read(HEADER)
        if header[: len(MARK)] != MARK or header[len(MARK) : -1] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path} was not written with this dictionary")
        self.kind = np.dtype(f"<u{header[-1]}")
        self.unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def ids(self, entry) -> np.ndarray:
        self.data.seek(int(entry["offset"]))
        frame = self.data.read(int(entry["length"]))
        return np.frombuffer(self.unpacker.decompress(frame), self.kind).astype("<u4")


def read_back(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, from the files; ids are little-endian 32-bit bytes."""
    kinds = "doc_id long, start long, n_tokens long, ids binary"

    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(path)
                rows, size = [], 0
                for entry in shard.index:
                    ids = shard.ids(entry)
                    rows.append((int(entry["doc_id"]) if entry["has_id"] else None, start, len(ids), ids.tobytes()))
                    start += len(ids)
                    size += 4 * len(ids)
                    if size > 8 << 20:
                        yield as_batch(rows)
                        rows, size = [], 0
                if rows:
                    yield as_batch(rows)

    def as_batch(rows):
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["doc_id", "start", "n_tokens", "ids"])

    return _one_a_task(manifest).mapInArrow(read, kinds)


def _one_a_task(manifest: DataFrame) -> DataFrame:
    """Shards dealt over tasks, about one in each."""
    tasks = max(manifest.count(), 1)
    return manifest.select("path", "before").repartitionByRange(tasks, "path")


def fetch(manifest: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids) of the wanted ids (doc_id): indexes are searched, and only the wanted frames are read.

    The first and last id of every shard travel to all tasks: two numbers for
    each shard, as its path does.
    """

    def covered(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                index = Shard(path).index
                held = index["doc_id"][index["has_id"] == 1]
                if len(held):
                    columns = [pa.array([path]), *(pa.array([int(x)], pa.int64()) for x in (held[0], held[-1]))]
                    yield pa.RecordBatch.from_arrays(columns, ["path", "lo", "hi"])

    ranges = sorted((r.lo, r.hi, r.path) for r in _one_a_task(manifest).mapInArrow(covered, "path string, lo long, hi long").collect())
    lo, hi, paths = (list(c) for c in zip(*ranges)) if ranges else ([], [], [])

    def placed(batches):
        lows, highs = np.array(lo, np.int64), np.array(hi, np.int64)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            first, last = np.searchsorted(highs, ids), np.searchsorted(lows, ids, "right")
            found = [(paths[k], i) for i, a, b in zip(ids.tolist(), first, last) for k in range(a, b)]
            if found:
                names, ids = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(ids, pa.int64())], ["path", "doc_id"])

    def read(batches):
        for batch in batches:
            for path, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(path)
                missing = int(np.count_nonzero(shard.index["has_id"] == 0))
                held = shard.index["doc_id"][missing:]
                for doc_id in ids:
                    first, last = np.searchsorted(held, doc_id) + missing, np.searchsorted(held, doc_id, "right") + missing
                    for entry in shard.index[first:last]:
                        found = shard.ids(entry)
                        columns = [pa.array([doc_id], pa.int64()), pa.array([len(found)], pa.int64()), pa.array([found], pa.list_(pa.int64()))]
                        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids"])

    ids = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    met = ids.mapInArrow(placed, "path string, doc_id long")
    asked = met.groupBy("path", F.expr("doc_id DIV 4096").alias("_some")).agg(F.collect_list("doc_id").alias("ids"))
    return asked.select("path", "ids").mapInArrow(read, "doc_id long, n_tokens long, ids array<long>")


@query("op13_token_files")
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = write_shards(docs, shared_folder(spark, "token-files"))
    return read_back(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
