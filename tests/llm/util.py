"""Small documents with every awkward case, and brute-force helpers."""

import random
from collections import defaultdict

#: Extra columns whose names clash with columns that the operators use themselves.
CLASHING = ("key", "region", "doc", "th", "list", "row", "host", "bands", "seq", "rep", "n_words", "kept", "component_id", "start", "stop", "_id_hash", "hash", "id", "a", "comp", "places", "draw")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def frame(spark, rows, parts=3):
    """Documents from (doc_id, text[, lang[, source]]) with the clashing columns."""
    full = []
    for r in rows:
        doc, text, lang, source = (*r, *(None,) * (4 - len(r)))
        full.append((doc, text, lang, source, None if text is None else len(text), *("x",) * len(CLASHING)))
    df = spark.createDataFrame(full, SCHEMA)
    return df.repartition(parts) if rows else df


def messy_texts(seed, n=120, alphabet="ab c\né", long=300):
    """Texts that share pieces, with empty, tiny, repetitive and missing ones."""
    rng = random.Random(seed)
    base = ["".join(rng.choices(alphabet, k=rng.randint(0, 2 * long))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            b = rng.choice(base)
            a = rng.randint(0, len(b))
            parts.append(b[a : a + rng.randint(0, long)])
            if rng.random() < 0.3:
                parts.append("".join(rng.choices(alphabet, k=20)))
        out.append("".join(parts))
    return [*out, None, "", "a" * 150, "a" * 60 + "b", "ab" * 100, out[3], out[3], " \n\t "]


def messy_words(seed, n=90, vocabulary=40, long=120):
    """Texts of words that share passages, near copies included."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "#tag", "a.b"]
    base = [[rng.choice(words) for _ in range(rng.randint(20, long))] for _ in range(5)]
    out = []
    for _ in range(n):
        b = list(rng.choice(base))
        kind = rng.random()
        if kind < 0.5:
            for _ in range(rng.randint(0, 5)):
                b[rng.randrange(len(b))] = rng.choice(words)
        elif kind < 0.8:
            a = rng.randrange(len(b))
            b = [rng.choice(words) for _ in range(rng.randint(0, 30))] + b[a:] + [rng.choice(words) for _ in range(rng.randint(0, 30))]
        else:
            b = [rng.choice(words) for _ in range(rng.randint(0, 8))]
        out.append(rng.choice((" ", "  ", "\n")).join(b))
    return [*out, None, "", " \t", "one", "One", "x x x x x x x x", "x x x x x", out[0], out[0]]


def smallest_reachable(nodes, links):
    """Node -> smallest node it reaches."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    top = {}
    for n in sorted(nodes):
        todo = [n] if n not in top else []
        while todo:
            x = todo.pop()
            if x not in top:
                top[x] = n
                todo += near[x]
    return top
