"""Repeated passages, phrases and conversation prefixes against plain versions on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridmill.llm import passages, phrases, prefixes
from gridmill.llm.fmindex import FMIndex, WaveletMatrix, suffix_order

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- index -------------------------------------------------------------------------


def test_suffix_order_and_rank():
    rng = np.random.default_rng(1)
    for size in (1, 2, 30, 500):
        text = np.append(rng.integers(0, 5, size), 0)
        ends = np.cumsum(text == 0)
        key = [
            [(1, int(c)) if c else (0, int(e)) for c, e in zip(text[i:], ends[i:], strict=True)]
            for i in range(len(text))
        ]
        assert list(suffix_order(text)) == sorted(range(len(text)), key=key.__getitem__)
        tree = WaveletMatrix(text)
        symbols = rng.choice(text, 50)
        place = rng.integers(0, len(text) + 1, 50)
        counts = [int((text[:p] == s).sum()) for s, p in zip(symbols, place, strict=True)]
        assert list(tree.rank(symbols, place)) == counts


def test_backward_search():
    rng = np.random.default_rng(2)
    text = np.append(rng.integers(0, 4, 600), 0)
    begins = np.array([b for b in range(len(text) - 5) if 0 not in text[b : b + 5]])
    index = FMIndex(text)
    hit, low, high = index.matches(text, begins, 5)
    wins = Counter(tuple(text[b : b + 5]) for b in begins)
    assert list(hit) == [i for i, b in enumerate(begins) if wins[tuple(text[b : b + 5])] > 1]
    for i, lo, up in zip(hit, low, high, strict=True):
        same = {tuple(text[p : p + 5]) for p in index.order[lo:up]}
        assert same == {tuple(text[begins[i] : begins[i] + 5])}
        assert up - lo == wins[tuple(text[begins[i] : begins[i] + 5])]


# -- passages ------------------------------------------------------------------------


def plain_passages(rows, window=13):
    first = {}
    order = lambda i: float("-inf") if i is None else i
    found = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, words in found:
        for k in range(len(words) - window + 1):
            win = tuple(words[k : k + window])
            first[win] = min(first.get(win, float("inf")), order(i))
    out = []
    for i, words in found:
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < order(i):
                gone[k : k + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        start = gone.index(True) if True in gone else None
        out.append((i, len(words), sum(gone), digest(kept), start))
    return sorted(out, key=repr)


def found_passages(frame, **sizes):
    return sorted(map(tuple, passages.repeated_passages(frame, **sizes).collect()), key=repr)


def test_passages_of_odd_rows(docs, rows):
    assert found_passages(docs) == plain_passages([(r[0], r[1]) for r in rows])


def test_passages_in_small_blocks(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    shared = [[rng.choice(words) for _ in range(rng.randrange(5, 60))] for _ in range(12)]
    rows = []
    for i in range(300):
        own = []
        for _ in range(rng.randrange(0, 4)):
            own += [rng.choice(words) for _ in range(rng.randrange(0, 30))] + rng.choice(shared)
        rows.append((rng.randrange(150), rng.choice([" ", "\n", " \t"]).join(own)))
    rows += [(500 + i, "same words again " * 60) for i in range(3)]
    rows += [(None, "same words again " * 10), (None, None), (7, "x " * 13), (6, "x " * 12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert found_passages(frame, block_bytes=3000) == plain_passages(rows)


def test_passages_of_a_hot_group(spark):
    """Two thirds of the rows are one text, most others share its passage."""
    rng = random.Random(9)
    base = " ".join(f"b{rng.randrange(900)}" for _ in range(80))
    rows = [(i, base) for i in range(400)]
    rows += [(400 + i, f"start {i} " + base[:200] + f" end {i}") for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found_passages(frame) == plain_passages(rows)


def test_passages_of_nothing(empty):
    assert passages.repeated_passages(empty).collect() == []


# -- phrases ---------------------------------------------------------------------------


def plain_phrases(rows, least, most, percent=50):
    f, n, out = Counter(), Counter(), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    good = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, p), a in good.items():
        for q in (p[:2], p[1:]) if len(p) == 3 else ():
            longer[lang, q] = max(longer[lang, q], a)
    for lang in n:
        own = []
        for (g, p), a in good.items():
            if g != lang or (longer[g, p] and 100 * longer[g, p] >= percent * a):
                continue
            parts = [(f[g, p[:k]], f[g, p[k:]], k) for k in range(1, len(p))]
            score, k = min((1000000 * a * a // (x * y), k) for x, y, k in parts)
            own.append((-score, -a, " ".join(p).encode(), parts[k - 1]))
        for rank, (score, a, p, (x, y, k)) in enumerate(sorted(own)[:most], 1):
            out.append((lang, rank, p.decode(), -a, x, y, n[lang], -score, k))
    return sorted(out)


@pytest.mark.parametrize("least, most", [(2, 50), (10, 2000)])
def test_phrases_of_odd_rows(docs, rows, least, most):
    found = sorted(map(tuple, phrases.collocations(docs, least, most).collect()))
    assert found == plain_phrases([(r[2], r[1]) for r in rows], least, most)


def test_phrases_of_copies_and_runs(spark):
    """Copies of one text, runs of one word and pieces of all kinds; counts over many chunks."""
    rng = random.Random(3)
    words = ["New", "york", "a", "b", "ç", "THE", "of", "x_y", "漢字", "\x1c"]
    text = "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ". ", "\n"]) for _ in range(300))
    rows = [("en", text)] * 500 + [("en", "a " * 5000), (None, "a a a b " * 900), ("en", None)]
    rows += [(rng.choice(["en", "fr"]), text[i:]) for i in range(100)]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    found = sorted(map(tuple, phrases.collocations(frame, block_bytes=5000).collect()))
    assert found == plain_phrases(rows, 10, 2000)


def test_phrases_with_large_products(spark):
    """Scores of counts whose products pass 64 bits."""
    rows = [("en", "a b", 9 * 10**12), ("en", "a", 10**13), ("en", "b", 11 * 10**12)]
    frame = spark.createDataFrame(rows, "lang string, phrase string, n long")
    (row,) = phrases.scored(frame).collect()
    assert row["score"] == 1000000 * 81 * 10**24 // (11 * 10**25)


def test_phrases_of_nothing(empty):
    assert phrases.collocations(empty).collect() == []


# -- conversations --------------------------------------------------------------------


def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(own)] for c, own in turns.items()}
    members = defaultdict(list)
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 9
        whole = tuple(turns.get(conv - conv % 5, [])[:h] + own[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append((conv, len(whole) == d))
    children = Counter(k[:-1] for k in members if k)
    smallest = {k: min(m)[0] for k, m in members.items()}
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c, end in sorted(m) if end)
        up = smallest[k[:-1]] if k else None
        out.append((smallest[k], len(k), up, len(m), children[k], leaves[k], saved[k], digest(ends)))
    return sorted(out, key=repr)


def odd_turns():
    rng = random.Random(5)
    rows = []
    for conv in range(-12, 90):
        for turn in range(rng.randrange(0, 12)):
            text = rng.choice(["hi", "so", "é", "", None, f"own {conv}"])
            rows.append((conv, turn, rng.choice(["user", "bot", None]), text))
    for conv in range(100, 400):  # a third of all share their first turns, some are copies
        deep = rng.randrange(0, 5)
        rows += [(conv, t, "user", f"t{t}") for t in range(deep)]
        rows += [(conv, None, "user", "first")] * rng.randrange(2)
    rows += [(500 + 5 * i, t, "user", "same") for i in range(4) for t in range(60)]
    rows += [(600 + 5 * i, t, "user", "chain" if t <= i else f"{i}") for i in range(20)
             for t in range(i + 2)]
    rows += [(None, 0, "user", "nobody"), (0, 1, "user", "tie"), (0, 1, "user", "tie")]
    return rows


@pytest.mark.parametrize("batch", [prefixes.BATCH, 7])
def test_trie_of_odd_turns(spark, batch):
    rows = odd_turns()
    schema = "conv_id long, turn long, role string, text string"
    frame = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS depth", "2 AS node")
    shards = prefixes.prefix_trie(frame.repartition(5), batch)
    assert sorted(map(tuple, shards.collect()), key=repr) == plain_trie(rows)


def test_trie_of_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefixes.prefix_trie(spark.createDataFrame([], schema)).collect() == []
    (row,) = prefixes.prefix_trie(spark.createDataFrame([(10, 0, "user", "x")] * 0 + [
        (11, 0, "user", "only")], schema)).where("depth = 0").collect()
    assert (row["n_convs"], row["conv_id"]) == (1, 11)


def test_batches_are_put_together():
    """The same conversations in batches of any size give the same merged nodes."""
    convs = list(range(40))
    mark = lambda t: prefixes._turn(b"user", t.encode())
    turns = [[mark(str(i % 3)), mark(str(i % 7)), mark("z")][: i % 4] for i in convs]

    def merged(size):
        nodes = {}
        for b in range(0, 40, size):
            for row in prefixes._trie(convs[b : b + size], turns[b : b + size]):
                key, parent, depth, conv, n, _, ends = row
                old = nodes.get(key, (parent, depth, conv, 0, []))
                ids = [e["ids"] for e in ends]
                nodes[key] = (parent, depth, min(conv, old[2]), old[3] + n, old[4] + ids)
        return {k: (*v[:4], ",".join(v[4])) for k, v in nodes.items()}

    assert merged(40) == merged(7) == merged(1)
