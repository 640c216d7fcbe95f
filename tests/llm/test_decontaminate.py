from __future__ import annotations

import hashlib
import random
import re

from runlens.llm import decontaminate
from tests.llm import brute

SCHEMA = "doc_id long, text string"
ITEMS = "item_id long, text string"


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(docs, items):
    windows = set()
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - 9)) if w else ():
            windows.add((tuple(w[s : s + 10]), i))
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for win, i in windows:
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s : s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    ids.add(str(i))
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(ids), sha, bool(hit)))
    return sorted(out, key=str)


def result(spark, docs, items):
    found = decontaminate.find(spark.createDataFrame(docs, SCHEMA).repartition(3), spark.createDataFrame(items, ITEMS))
    return sorted((tuple(r) for r in found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=str)


def cases():
    rng = random.Random(11)
    items = [(k, brute.prose(rng, n)) for k, n in enumerate([12, 30, 10, 9, 3, 1, 25])]
    items += [(50, items[1][1]), (51, "Straße É é 123 x_y"), (52, None), (53, ""), (54, "..."), (55, "cedar " * 14)]
    docs = [r for r in brute.awkward_documents(1) if len(r[1] or "") < 4000]
    for k, (_, t) in enumerate(items):
        docs.append((9000 + k, brute.prose(rng, 30) + " " + (t or "").upper() + "! " + brute.prose(rng, 30)))
        cut = " ".join((t or "").split(" ")[2:])
        docs.append((9100 + k, cut + "\n" + cut))
    docs += [(9300, items[0][1]), (9300, items[0][1]), (None, items[0][1]), (None, items[6][1]), (9301, "cedar " * 300), (9302, " " + items[2][1])]
    return docs, items


def test_same_as_sliding_windows(spark):
    docs, items = cases()
    assert result(spark, docs, items) == plain(docs, items)


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "sized", lambda df: df)
    docs, items = cases()
    assert result(spark, docs, items) == plain(docs, items)


def test_empty_tables_and_extra_columns(spark):
    docs, items = cases()
    assert result(spark, [], items) == []
    assert not any(r[5] for r in result(spark, docs, []))
    df = spark.createDataFrame([(1, "a b", 3)], SCHEMA + ", n_hit int")
    assert decontaminate.find(df, spark.createDataFrame([(1, "b", "x")], ITEMS + ", words string")).first().n_hit == 1
