"""Quotation linking: conversations in reply order, without the passages their messages quote.

Each message is parsed into its own text and quoted passages with their level
(the number of quote marks). Passages and their lines are normalised and hashed,
and meet the texts, paragraphs and lines that earlier messages of the same
conversation wrote themselves. Equal passages of several messages belong to the
earliest, so a passage that everyone repeats costs one row on that side. A
message replies to the latest message among those its level-one quotes come
from; threads are the connected components of replies.

Defined cases: a missing text is empty; quotes without a source are dropped from
the text and counted; a message without known quotes starts a thread; equal rows
stay; a missing conversation or turn is linked with nothing; columns named like
an added one are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.common import arrow_rows, stored, table, whole_text
from runlens.llm.components import components
from runlens.llm.registry import query

MARKS = re.compile(r"(?: ?>)+ ?")
ADDED = ("own_text", "n_quotes", "n_linked", "reply_to", "thread")


def normal(text: str) -> str:
    return " ".join(text.split()).lower()


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """A message's own text, and its quoted passages as (level, text)."""
    runs: list[tuple[int, list[str]]] = []
    for line in text.split("\n"):
        found = MARKS.match(line)
        level = found[0].count(">") if found else 0
        body = line[found.end() :] if found else line
        if not runs or runs[-1][0] != level:
            runs.append((level, []))
        runs[-1][1].append(body)
    own = "\n".join("\n".join(lines) for level, lines in runs if not level)
    if any(level for level, _ in runs):
        own = own.strip("\n")
    return own, [(level, "\n".join(lines)) for level, lines in runs if level]


def parsed(messages: DataFrame) -> DataFrame:
    """``messages`` with own_text, _quoted (level, whole, key) and _written (keys)."""
    place = messages.columns.index("text")
    schema = messages.withColumns(
        {
            "own_text": F.lit(""),
            "_n": F.lit(0).cast("long"),
            "_quoted": F.lit(None).cast("array<struct<passage:int,level:int,whole:boolean,key:bigint>>"),
            "_written": F.lit(None).cast("array<bigint>"),
        }
    ).schema

    def make():
        import xxhash

        def key(text: str) -> int | None:
            t = normal(text)
            if not t:
                return None
            x = xxhash.xxh3_64_intdigest(t.encode())
            return x - (1 << 64) if x >> 63 else x

        def step(batch):
            owns, counts, quoted, written = [], [], [], []
            for value in batch.column(place):
                own, passages = parse(value.as_py() or "")
                rows = []
                for k, (level, text) in enumerate(passages):
                    rows.append((k, level, True, key(text)))
                    rows += [(k, level, False, key(line)) for line in text.split("\n")]
                owns.append(own)
                counts.append(len(passages))
                quoted.append([dict(zip(("passage", "level", "whole", "key"), r)) for r in rows if r[3] is not None])
                mine = {key(own), *map(key, re.split(r"\n\s*\n", own)), *map(key, own.split("\n"))} - {None}
                written.append(sorted(mine))
            kinds = pa.list_(pa.struct([("passage", pa.int32()), ("level", pa.int32()), ("whole", pa.bool_()), ("key", pa.int64())]))
            columns = [pa.array(owns, pa.string()), pa.array(counts, pa.int64()), pa.array(quoted, kinds), pa.array(written, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], schema.names)

        return step

    return messages.mapInArrow(arrow_rows(make), schema)


def link_quotes(messages: DataFrame) -> DataFrame:
    """``messages`` (conv_id, turn, text, ...) with own_text, n_quotes, n_linked, reply_to and thread."""
    messages = messages.select(*[c for c in messages.columns if c not in ADDED])
    # Only what links need is stored and shuffled twice; own texts stay with their rows.
    rows = stored(parsed(messages), "messages")
    named = rows.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    written = (
        named.select("conv_id", "turn", F.explode("_written").alias("key"))
        .groupBy("conv_id", "key")
        .agg(F.min("turn").alias("source"))
    )
    quoted = named.select("conv_id", "turn", F.inline("_quoted")).distinct()
    links = (
        quoted.join(written, ["conv_id", "key"])
        .filter("source < turn")
        .groupBy("conv_id", "turn", "passage", "level")
        .agg(F.coalesce(F.max(F.when(F.col("whole"), F.col("source"))), F.max("source")).alias("source"))
    )
    per_message = links.groupBy("conv_id", "turn").agg(
        F.count(F.lit(1)).alias("n_linked"), F.max(F.when(F.col("level") == 1, F.col("source"))).alias("reply_to")
    )
    per_message = stored(per_message, "links")
    # Nodes of the reply graph are hashed (conversation, turn); threads are named by conversation and root.
    node = lambda turn: F.xxhash64("conv_id", turn)
    replies = per_message.filter("reply_to IS NOT NULL")
    roots = components(replies.select(node("turn").alias("u"), node("reply_to").alias("v")))
    threads = (
        replies.select("conv_id", "turn", node("turn").alias("id"))
        .union(replies.select("conv_id", F.col("reply_to").alias("turn"), node("reply_to").alias("id")))
        .distinct()
        .join(roots, "id", "left")
        .select("conv_id", "turn", F.coalesce("root", "id").alias("root"))
    )
    first = threads.groupBy("conv_id", "root").agg(F.min("turn").alias("thread"))
    placed = threads.join(first, ["conv_id", "root"]).select("conv_id", "turn", "thread")
    return (
        rows.join(per_message, ["conv_id", "turn"], "left")
        .join(placed, ["conv_id", "turn"], "left")
        .select(
            *messages.columns,
            "own_text",
            F.col("_n").alias("n_quotes"),
            F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
            "reply_to",
            F.coalesce("thread", "turn").alias("thread"),
        )
    )


def reply_ordered(linked: DataFrame) -> DataFrame:
    """Messages sorted so that each conversation's threads stand together and replies follow what they answer."""
    return linked.orderBy("conv_id", "thread", "turn")


def as_mail(conversations: DataFrame) -> DataFrame:
    """Turns as messages that quote the turn before them, with what that one quoted one level deeper."""
    turns = conversations.select("conv_id", "turn", "role", whole_text().alias("text"))
    by_turn = turns.groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    back = lambda k, name: by_turn.select("conv_id", (F.col("turn") + k).alias("turn"), F.col("text").alias(name))
    marked = lambda mark, name: F.concat(F.lit(mark), F.replace(name, F.lit("\n"), F.lit("\n" + mark)), F.lit("\n"))
    return (
        turns.join(back(1, "_p"), ["conv_id", "turn"], "left")
        .join(back(2, "_q"), ["conv_id", "turn"], "left")
        .select(
            "conv_id",
            "turn",
            "role",
            F.concat(F.coalesce(marked(">> ", "_q"), F.lit("")), F.coalesce(marked("> ", "_p"), F.lit("")), "text").alias("text"),
        )
    )


SQL = r"""
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
n AS (SELECT conv_id, turn, min(text) AS text, trim(regexp_replace(min(text), '\s+', ' ', 'g')) AS norm FROM t GROUP BY 1, 2),
o AS (SELECT conv_id, lower(norm) AS norm, min(turn) AS source FROM n GROUP BY 1, 2),
l AS (SELECT n.conv_id, n.turn, p.source AS ps, q.source AS qs,
        (a.conv_id IS NOT NULL)::BIGINT + (b.conv_id IS NOT NULL)::BIGINT AS n_quotes
      FROM n LEFT JOIN n a ON a.conv_id = n.conv_id AND a.turn = n.turn - 1
        LEFT JOIN o p ON p.conv_id = n.conv_id AND p.norm = lower(a.norm)
        LEFT JOIN n b ON b.conv_id = n.conv_id AND b.turn = n.turn - 2
        LEFT JOIN o q ON q.conv_id = n.conv_id AND q.norm = lower(b.norm))
SELECT t.conv_id, t.turn, t.role, n_quotes, (ps IS NOT NULL)::BIGINT + (qs IS NOT NULL)::BIGINT AS n_linked,
  ps AS reply_to, min(t.turn) OVER (PARTITION BY t.conv_id) AS thread, sha256(t.text) AS own_sha256
FROM t JOIN l ON t.conv_id = l.conv_id AND t.turn = l.turn
"""


@query("op8_quote_links", SQL)
def op8_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = link_quotes(as_mail(table(spark, sf_dir, "conversations")))
    return linked.select("conv_id", "turn", "role", "n_quotes", "n_linked", "reply_to", "thread", F.sha2("own_text", 256).alias("own_sha256"))
