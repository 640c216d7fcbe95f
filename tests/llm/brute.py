"""Plain versions of the operators, and small tables with awkward rows."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

WORDS = "amber birch cedar dune ember fjord grove heath inlet jetty knoll ledge marsh notch oasis plain quarry ridge shoal tarn".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(n))


def edited(rng: random.Random, text: str, edits: int) -> str:
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(WORDS) + str(rng.randrange(1000))
    return " ".join(words)


def awkward_documents(seed: int = 5) -> list[tuple]:
    """(doc_id, text): nulls, blanks, long texts, ties, exact and near copies, chains, repeated passages."""
    rng = random.Random(seed)
    texts = [None, "", " \n\t ", "one", "one two three four", "one two three four five", "É é Straße İ", "a" * 3000, " x y"]
    base = [prose(rng, rng.randrange(30, 300)) for _ in range(12)]
    texts += base + base[:4] + [base[0].upper(), base[1].replace(" ", "  \n")]
    for b in base[:8]:
        texts += [edited(rng, b, k) for k in (1, 2, 4, 8, 16)]
    chain = prose(rng, 120)
    for _ in range(12):
        chain = edited(rng, chain, 3)
        texts.append(chain)
    passage = prose(rng, 80)
    texts += [prose(rng, 20) + " " + passage + " " + prose(rng, 20) for _ in range(15)]
    texts.append(" ".join([passage] * 3))
    texts.append(prose(rng, 4000))
    rows = [(10 * i + 3, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def shingles(text: str | None) -> set:
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def near_duplicates(rows: list[tuple]) -> dict:
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids, where = sorted(sets), defaultdict(list)
    for d in ids:
        for s in sets[d]:
            where[s].append(d)
    met = Counter()
    for d in ids:
        for e, n in Counter(e for s in sets[d] for e in where[s] if e > d).items():
            met[d, e] = n
    for (d, e), n in met.items():
        if 100 * n >= 75 * (len(sets[d]) + len(sets[e]) - n):
            a, b = find(d), find(e)
            root[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def repeated_bytes(rows: list[tuple], width: int) -> dict:
    import hashlib

    data = {d: (t or "").encode() for d, t in rows}
    seen = Counter(b[i : i + width] for b in data.values() for i in range(len(b) - width + 1))
    out = {}
    for d, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out
