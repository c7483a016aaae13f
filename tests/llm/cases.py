"""Small tables and brute-force versions that the tests of this folder share."""

from __future__ import annotations

import hashlib
import random
import re

from millwright.llm.text import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns with the names that operators give their own results or steps.
CLASHING = {
    "size": "1", "target": "2.0D", "key": "'k'", "n_words": "3L", "failures": "0L", "kept": "true", "line": "'x'",
    "lines": "array('x')", "site": "'s'", "digest": "'d'", "id": "7L", "bucket": "1", "piece": "1", "length": "9",
    "sequence_id": "5L", "spans": "'s'", "component_id": "1L", "html": "'h'", "host": "'h'", "verdict": "'v'",
}


def docs(spark, rows):
    """(doc_id, text[, source]) as a documents table."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def clashing(df):
    return df.selectExpr("*", *[f"{value} as {name}" for name, value in CLASHING.items() if name not in df.columns])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def words(n, seed=0, size=2_000):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(size)}" for _ in range(n))


def edge_rows():
    """Null, empty, blank, tiny, long, repeated and tied rows."""
    long = words(30_000, 1)
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (6, "One"), (7, long), (8, long), (8, long),
        (9, "é" * 200), (None, "one"), (None, None), (10, words(60, 2), None), (11, words(60, 2), "src1"),
    ]


def documents(spark, sf_dir):
    return [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]


# ---- brute force ------------------------------------------------------------


def repeated(rows, width=50):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256) of rows with ids of their own."""
    first = {}
    for doc_id, text in sorted(rows):
        raw = (text or "").encode()
        for i in range(len(raw) - width + 1):
            first.setdefault(raw[i : i + width], doc_id)
    found = {}
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - width + 1):
            if first[raw[i : i + width]] < doc_id:
                gone[i : i + width] = b"\x01" * width
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        found[doc_id] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return found


def shingles(text):
    found = [w.lower() for w in (text or "").encode().split()]
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def near(rows, percent=75):
    """doc_id -> (n_shingles, component_id, kept), from all pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in rows}
    holders, shared = {}, {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    for group in holders.values():
        for i, b in enumerate(group):
            for a in group[:i]:
                shared[a, b] = shared.get((a, b), 0) + 1
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}
