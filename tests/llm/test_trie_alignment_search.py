"""The conversation trie, token alignment and top-k search against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwright.llm import prefix_trie, token_alignment, topk_search
from millwright.llm.prefix_trie import ZFastTrie, conversation_trie, two_fattest
from millwright.llm.queries import BYTE_VOCABULARY, PIECE_MODEL, QUERIES
from millwright.llm.token_alignment import BLOCK_DOCS, align_tokens, byte_symbols, packed, unpacked, words
from millwright.llm.topk_search import Best, open_pairs, top_scores
from tests.conftest import SF_DIR
from tests.llm import cases
from tests.llm.cases import clashing, docs, edge_rows

# ---- conversations ----------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"
NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def nodes_of(df):
    return sorted((tuple(r[c] for c in NODE) for r in conversation_trie(df).collect()), key=repr)


def trie(rows):
    """The nodes of (conv_id, turn, role, text) rows without ties of turns."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    found, below = [], {}
    for node in sorted(members, key=len, reverse=True):
        m, down = members[node], [below[x] for x in children[node]]
        leaves = sum(x[0] for x in down) or 1
        saved = sum(x[1] for x in down) + ((len(m) - 1) * len(node[-1][1].encode()) if node else 0)
        below[node] = leaves, saved
        told = hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()
        found.append((m[0], len(node), members[node[:-1]][0] if node else None, len(m), len(down), leaves, saved, told))
    return sorted(found, key=repr)


def talks(seed, n=120):
    pick = random.Random(seed)
    rows = []
    for c in pick.sample(range(300), n):
        rows += [(c, t, pick.choice(["user", None]), pick.choice("ab") * t) for t in range(pick.randrange(1, 12))]
    # a conversation kept after every turn, and one that very many repeat
    rows += [(1000 + 5 * k, t, "user", f"é{t}") for k in range(20) for t in range(k + 1)]
    return rows + [(2000 + 5 * k, t, "user", f"same {t}") for k in range(200) for t in range(3)]


@pytest.mark.parametrize("turns", [200_000, 40, 1])
def test_trie_is_that_of_brute_force(spark, monkeypatch, turns):
    monkeypatch.setattr(prefix_trie, "TRIE_TURNS", turns)
    rows = talks(turns)
    assert nodes_of(spark.createDataFrame(rows, TURNS).repartition(5)) == trie(rows)


def test_trie_of_odd_turns(spark):
    rows = [
        (1, None, "user", "a"), (1, 0, None, None), (1, 1, "", ""), (2, 0, "user", "x" * 500_000), (6, 0, "user", "x" * 500_000),
        (None, 0, "user", "lost"), (-3, 0, "user", "a"), (7, 5, None, ""), (7, 9, "u", "é"),
    ]
    df = spark.createDataFrame(rows, TURNS)
    assert nodes_of(df) == trie(rows)
    assert nodes_of(clashing(df).selectExpr("*", "1 as depth", "'d' as parent")) == trie(rows)
    assert nodes_of(df.where("false")) == []


def test_equal_turns_go_by_their_digest_and_repeated_rows_stay(spark):
    rows = [(5 * c, 0, "user", text) for c, texts in ((1, "abb"), (2, "bab"), (3, "ab")) for text in texts]
    df = spark.createDataFrame(rows, TURNS)
    first = nodes_of(df)
    assert first == nodes_of(df.orderBy(F.desc("text"))) and max(n[1] for n in first) == 3
    assert max(n[3] for n in first if n[1] == 3) == 2


def test_fat_search_ends_where_a_walk_ends():
    assert [two_fattest(0, 5), two_fattest(4, 7), two_fattest(3, 4), two_fattest(5, 6), two_fattest(6, 7)] == [4, 6, 4, 6, 7]
    pick = random.Random(1)
    tree, seen = ZFastTrie(), []
    for c in range(400):
        base = pick.choice(seen) if seen and pick.random() < 0.8 else ()
        turns = base[: pick.randrange(len(base) + 1)] + tuple(pick.choice("ab") for _ in range(pick.randrange(20)))
        path = prefix_trie._prefixes([(t.encode(), 1) for t in turns])[0]
        node, child, depth = tree.locate(path)
        longest = max((next((i for i, (x, y) in enumerate(zip(turns, s, strict=False)) if x != y), min(len(turns), len(s))) for s in seen), default=0)
        assert depth == longest and (child is None) == (depth == node.depth)
        tree.insert(c, path, [1] * len(turns))
        seen.append(turns)


# ---- alignment --------------------------------------------------------------


def aligned(rows):
    """The rows of ``align_tokens`` for (doc_id, text), from both tokenizers on whole texts."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(BYTE_VOCABULARY)
    first.encode_special_tokens = True
    second, symbols = SentencePieceProcessor(model_file=PIECE_MODEL), byte_symbols()

    def piece(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    found, count = [], Counter()
    for doc_id, text in rows:
        raw = f" {text}".encode()
        a = first.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        cut_a = [bytes(symbols[c] for c in first.id_to_token(i)) for i in a]
        cut_b = [piece(i) for i in b]
        if not text or b"".join(cut_a) != raw or b"".join(cut_b) != raw:
            found.append((doc_id, 0, 0, [], ""))
            continue
        place = {int(e): j for j, e in enumerate(np.cumsum([len(x) for x in cut_b]))}
        links, told, i0, j0 = [], [], 0, 0
        for i, e in enumerate(np.cumsum([len(x) for x in cut_a])):
            if (j := place.get(int(e))) is not None:
                links.append((a[i], b[j]))
                told.append(",".join(map(str, a[i0 : i + 1])) + "|" + ",".join(map(str, b[j0 : j + 1])))
                i0, j0 = i + 1, j + 1
        count.update(links)
        found.append((doc_id, len(a), len(b), links, hashlib.sha256(";".join(told).encode()).hexdigest()))
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return sorted(((d, n_a, n_b, len(ls), len(ls), sum(count[x] == most[x[1]] for x in ls), sum(count[x] for x in ls), told)
                   for d, n_a, n_b, ls, told in found), key=repr)


ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def aligned_by_spark(df):
    return sorted((tuple(r[c] for c in ALIGNED) for r in align_tokens(df, BYTE_VOCABULARY, PIECE_MODEL).collect()), key=repr)


ODD = [
    " ", "  a  b ", "a\nb\n c \n d", "a▁ b", "\ttab\r\nx", "<|endoftext|> <s> x</s> <unk> <0x41>", "한국 𝒳 é é \xa0 　 x",
    "x" * 50_000, "ﬁ ﻿ a", "\n", "it's don't 's", "12345 6 7.8, 9", "a\xa0 b", "\x00 \x01", "\x1c a\x85 b",
]


@pytest.mark.parametrize("links", [3_000_000, 500])
def test_alignment_is_that_of_brute_force(spark, monkeypatch, links):
    monkeypatch.setattr(token_alignment, "BLOCK_LINKS", links)
    monkeypatch.setattr(token_alignment, "CACHED_WORDS", links)
    monkeypatch.setattr(token_alignment, "RUN_CHARS", links)
    pick = random.Random(links)
    parts = [" ", "\n", "a", "the", ".", "é", " ", "'s", "  ", "한", "\t", "ing"]
    made = ["".join(pick.choice([*parts, "▁"] if i % 9 == 0 else parts) for _ in range(60)) for i in range(100)]
    rows = [*edge_rows(), *((100 + i, t) for i, t in enumerate([*ODD, *made]))]
    df = docs(spark, rows)
    expected = aligned([r[:2] for r in rows])
    assert aligned_by_spark(df) == expected
    assert aligned_by_spark(clashing(df).selectExpr("*", "1 as block", "2 as a", "3 as at", "'p' as postings").repartition(3)) == expected
    assert aligned_by_spark(df.where("false")) == []


def test_alignment_of_the_table(spark):
    found = sorted((tuple(r[c] for c in ALIGNED) for r in QUERIES["op12_token_alignment"](spark, SF_DIR).collect()), key=repr)
    assert found == aligned(cases.documents(spark, SF_DIR))


def test_ids_of_any_type(spark):
    df = docs(spark, [(1, "one two"), (None, "two")]).selectExpr("concat('d', doc_id) as doc_id", "text")
    assert [r[0] for r in aligned_by_spark(df)] == sorted(["d1", None], key=repr)


def test_words_join_to_the_text():
    for text in [*ODD, "a b", "a", " a", "a "]:
        cut = words(text)
        assert " ".join(cut) == text
        assert all(w and not before[-1:].isspace() and not w[0].isspace() for before, w in zip(cut, cut[1:], strict=False))


def test_postings_give_back_documents_and_multiplicities():
    pick = np.random.default_rng(2)
    pair = np.concatenate([np.full(30_000, 7), pick.integers(0, 500, 20_000), np.full(300, 9 << 16)])
    doc = np.concatenate([pick.integers(0, BLOCK_DOCS, 30_000), pick.integers(0, BLOCK_DOCS, 20_000), np.full(300, 5)])
    pairs, n_docs, n_links, postings, ends = packed(pair, doc)
    expected = Counter(zip(pair.tolist(), doc.tolist(), strict=True))
    found = Counter()
    for row, plane, at in unpacked(postings, np.concatenate([[0], ends[:-1]]), ends):
        for r, k, d in zip(row.tolist(), plane.tolist(), at.tolist(), strict=True):
            found[int(pairs[r]), d] += 1 << k
    assert found == expected
    assert dict(zip(pairs.tolist(), n_docs.tolist(), strict=True)) == Counter(p for p, _ in expected)
    assert dict(zip(pairs.tolist(), n_links.tolist(), strict=True)) == Counter(pair.tolist())
    assert [len(x) for x in packed(np.zeros(0, np.int64), np.zeros(0, np.int64))] == [0] * 5


# ---- search -----------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def nearest(rows, k=20, every=20):
    """(query_id, rank, vec_id, score) of (vec_id, vector) rows."""
    clean = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v)]
    found = []
    for at, (i, q) in enumerate(clean):
        if i % every == 0:
            scores = ((sum(x * y for x, y in zip(q, v, strict=False)), j) for n, (j, v) in enumerate(clean) if n != at)
            scored = sorted((-max(1 - 2**63, min(2**63 - 1, s)), j) for s, j in scores)
            found += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(found)


def searched(df, k=20):
    return sorted(tuple(r) for r in top_scores(df, F.col("vec_id") % 20 == 0, k).select("query_id", "rank", "vec_id", "score").collect())


def vectors(seed, n=700, dims=24):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(5, dims))
    found = [(i, [float(x) for x in centres[i % 5] + 0.4 * pick.normal(size=dims)]) for i in range(n)]
    return found + [(n + i, found[40][1]) for i in range(60)]  # one vector very many times


@pytest.mark.parametrize("small", [False, True])
def test_search_is_that_of_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in (("GROUP_QUERIES", 7), ("QUERY_ROWS", 3), ("BLOCK_ROWS", 16), ("BLOCK_DIMS", 4), ("SHARE_ROWS", 100)):
            monkeypatch.setattr(topk_search, name, value)
        monkeypatch.setattr(topk_search, "SPARSE", 0.5)
    rows = vectors(3)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(4)
    assert searched(df) == nearest(rows)


def test_search_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf]), (20, []), (5, [0.5]), (6, [1.0, 2.0, 3.0]),
        (None, [9.0, 9.0]), (20, [1.0, 1.0]), (20, [1.0, 1.0]), (-20, [3e38, 3e38]), (7, [-3e38, 3e38]), (8, [3e38]), (40, [1e-9, -1e-9]),
    ]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    assert searched(df) == nearest(rows) and searched(df, 3) == nearest(rows, 3)
    assert searched(df.selectExpr("*", "1 as score", "2 as share", "3 as query_row", "4 as `rank`")) == nearest(rows)
    assert searched(df.where("false")) == []


def test_a_block_loses_no_pair():
    pick = np.random.default_rng(4)
    queries, block = np.floor(64 * pick.normal(size=(30, 64))), np.floor(64 * pick.normal(size=(64, 300)))
    scores = queries @ block
    least = np.sort(scores, axis=1)[:, -21]
    for sparse in (0.0, 0.02, 1.0):
        topk_search.SPARSE, before = sparse, topk_search.SPARSE
        q, c, s = open_pairs(queries, block, least, 16)
        topk_search.SPARSE = before
        assert sorted(zip(q, c, strict=True)) == sorted(zip(*np.nonzero(scores >= least[:, None]), strict=True))
        assert (s == scores[q, c]).all()
    best = Best(2, 2)
    best.add(np.array([0, 0, 0, 1]), np.array([5.0, 5.0, 7.0, 1.0]), np.array([9, 3, 8, 1]))
    assert best.id.tolist() == [8, 3, 1] and best.least.tolist() == [5.0, -np.inf]
