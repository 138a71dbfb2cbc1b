"""Operators that look across rows: mixing, dedup, sharding, language, and the pipeline."""

import re
from collections import Counter, defaultdict
from zlib import crc32

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from gridmill.llm import exact, language, mixing, near, queries, shards
from gridmill.llm.common import stage, word_count
from gridmill.llm.components import components

FOLDER = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# -- exact dedup -------------------------------------------------------------------------


def short_key(text):
    """A hash of few values, so that chains and deep directories come about."""
    return F.xxhash64(F.substring(text, 1, 1))


@pytest.mark.parametrize("key", [exact.hash_key, short_key], ids=["hash", "colliding"])
def test_duplicates(docs, rows, key):
    groups = defaultdict(list)
    for doc, text, _, _ in rows:
        groups[text or ""].append(doc)
    found = exact.duplicates(docs, capacity=4, key=key).collect()
    expected = Counter()
    for members in groups.values():
        known = [d for d in members if d is not None]
        keep = max(known) if known else None
        expected.update((d, keep, len(members), d == keep) for d in members)
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in found)
    assert got == expected
    unique = exact.unique_documents(docs, capacity=4)
    assert unique.columns == docs.columns
    assert sorted(r["text"] or "" for r in unique.collect()) == sorted(groups)


def test_index(docs):
    index = exact.build_index(docs, capacity=4).collect()
    per_bucket = Counter(r["bucket"] for r in index)
    assert max(per_bucket.values()) <= 4
    assert all(r["links"] == 1 and r["body"] is None for r in index)


def test_directory_doubles(spark):
    keys = spark.range(4000).select(F.xxhash64("id").alias("key"))
    depth, buckets = exact.directory(keys, capacity=100)
    assert depth >= 6
    numbered = keys.withColumn("bucket", exact.bucket_of(F.col("key"), depth, buckets))
    counts = numbered.groupBy("bucket").count().collect()
    assert max(r["count"] for r in counts) <= 100
    assert len(buckets) >= len(counts)
    # Uneven keys: only the crowded side is split further.
    uneven = keys.select(F.when(F.col("key") > 0, F.col("key") % 1000).otherwise(F.col("key")).alias("key"))
    depth, buckets = exact.directory(uneven.distinct(), capacity=500)
    assert min(d for _, d in buckets) < depth


def test_nothing_to_dedup(empty):
    assert exact.duplicates(empty).count() == 0
    assert exact.unique_documents(empty).count() == 0


# -- near dedup -----------------------------------------------------------------------------


def shingles(text, k):
    own = (text or "").encode().lower().split()
    return frozenset(tuple(own[i : i + k]) for i in range(max(1, len(own) - k + 1))) if own else frozenset()


def plain_components(rows, k, percent):
    parent = {d: d for d, *_ in rows if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(d, shingles(t, k)) for d, t, *_ in rows if d is not None]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a_, b_ = find(a), find(b)
                parent[max(a_, b_)] = min(a_, b_)
    return {d: find(d) for d in parent}


@pytest.mark.parametrize("match", [near.Match(), near.Match(3, 85)], ids=["5-80", "3-85"])
def test_near_duplicates(docs, rows, match, monkeypatch):
    wanted = plain_components(rows, match.words, match.percent)
    for group in (near.GROUP, 4):  # the second cuts the groups into blocks
        monkeypatch.setattr(near, "GROUP", group)
        found = near.near_duplicates(docs, match).collect()
        assert len(found) == len(rows)
        for r in found:
            assert r["component_id"] == wanted.get(r["doc_id"])
            assert r["kept"] == (r["component_id"] == r["doc_id"])
    sizes = Counter((d, len(shingles(t, match.words))) for d, t, *_ in rows)
    assert Counter((r["doc_id"], r["n_shingles"]) for r in found) == sizes


def near_families(families, copies, seed):
    """Texts a word or two from those of their family, families some words from each other."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(120)]
    out = []
    for f in range(families):
        own = list(base)
        for at in range(f, 120, 24):
            own[at] = f"f{f}x{at}"
        for c in range(copies):
            own[rng.integers(120)] = f"c{f}x{c}"
            out.append(" ".join(own))
    return [(int(i), out[k]) for i, k in enumerate(rng.permutation(len(out)))]


@pytest.mark.parametrize("turns", [near.TURNS, 1])
def test_large_groups_are_compared_in_few_copies(spark, monkeypatch, turns):
    monkeypatch.setattr(near, "GROUP", 16)
    monkeypatch.setattr(near, "BUCKET", 16)
    monkeypatch.setattr(near, "SAMPLE", 1)
    monkeypatch.setattr(near, "TURNS", turns)
    dealt, compared = [], near.compared

    def counted(rows, keys, *more):
        dealt.append((keys, rows.count()))
        return compared(rows, keys, *more)

    monkeypatch.setattr(near, "compared", counted)
    given = near_families(5, 40, 3)
    match = near.Match(3, 85)
    docs = spark.createDataFrame(given, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(docs, match).collect()}
    wanted = plain_components(given, 3, 85)
    assert found == wanted
    assert 1 < len(set(wanted.values())) < 100
    # A text goes to its part, or to all of them if it is among the few that do.
    assert dealt[0][0] == ["group", "part"] and dealt[0][1] <= 3 * len(given)


def test_rows_without_partners_leave_large_groups(spark, monkeypatch):
    """What goes is linked with nothing, also where rows differ in size and share nearly all."""
    monkeypatch.setattr(near, "GROUP", 4)
    rng = np.random.default_rng(8)
    base, given = [f"w{i}" for i in range(60)], []
    for d in range(120):
        own = base[: rng.integers(40, 60)]
        for c in range(rng.integers(0, 8)):
            own[rng.integers(len(own))] = f"x{d}x{c}" if c % 2 else f"y{c}"
        given.append((d, " ".join(own)))
    match = near.Match(3, 85)
    docs = spark.createDataFrame(given, "rep long, text string").selectExpr("1L AS `group`", "*")
    sets = near.shingle_rows(docs, match, ["group", "rep"])
    left = {r["rep"] for r in near.peeled(sets, match).collect()}
    wanted = plain_components(given, 3, 85)
    sizes = Counter(wanted.values())
    alone = {d for d, c in wanted.items() if sizes[c] == 1}
    assert set(wanted) - left <= alone
    assert 10 < len(set(wanted) - left)
    # Another text of the same id, all its own, takes none of the id's linked texts away.
    more = sets.unionByName(
        near.shingle_rows(
            docs.withColumn("text", F.expr("concat_ws(' ', transform(sequence(1, 90), i -> rep * 1000 + i))")),
            match, ["group", "rep"],
        )
    )
    both = near.peeled(more, match)
    assert {r["rep"] for r in both.join(sets, ["rep", "hashes"], "left_semi").collect()} >= (
        set(wanted) - alone
    )


def test_rows_of_one_id_link_its_texts(spark):
    rng = np.random.default_rng(9)
    first, second = ([f"{k}{w}" for w in rng.integers(0, 10**6, 80)] for k in "ab")
    other = [*second[:-1], "end"]
    given = [(3, first), (7, first), (7, second), (9, other), (11, ["alone"])]
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in given], "doc_id long, text string")
    found = {(r["doc_id"], r["component_id"]) for r in near.near_duplicates(docs).collect()}
    assert found == {(3, 3), (7, 3), (9, 3), (11, 11)}


def test_forest_of_pairs_with_other_labels():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = 30
        labels, places = rng.integers(0, 4, n), rng.integers(0, 60, n)
        near_ = lambda i, left: abs(places[i] - places[left]) <= 2
        edges = near._forest_apart(labels, near_)
        pairs = [(i, j) for i in range(n) for j in range(i)
                 if abs(places[i] - places[j]) <= 2 and labels[i] != labels[j]]
        plain = lambda edges: _joined(n, edges)
        assert plain(edges) == plain(pairs) and set(edges) <= {*pairs, *[(j, i) for i, j in pairs]}


def _joined(n, edges):
    label = list(range(n))
    for i, j in edges:
        low, high = sorted((label[i], label[j]))
        label = [low if x == high else x for x in label]
    return label


def test_one_of_each_group_stays(docs, rows):
    unique = near.unique_documents(docs)
    assert unique.columns == docs.columns
    wanted = plain_components(rows, 5, 80)
    got = {r["doc_id"] for r in unique.select("doc_id").collect()}
    assert got == {d for d, c in wanted.items() if d == c} | {None}


def test_no_near_duplicates(empty):
    assert near.near_duplicates(empty).count() == 0
    assert near.unique_documents(empty).count() == 0


def test_match_misses_few():
    match = near.Match(3, 85)
    short = 0.85**near.DEEP
    missed = 1 - (1 - (1 - short) ** match.m) ** 2
    assert missed <= near.MISSED


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))]
    edges += [(i, i + 1) for i in range(1000, 1060)]  # a chain
    parent = {x: x for e in edges for x in e if e[0] != e[1]}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    found = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r["node"]: r["component"] for r in found} == {x: find(x) for x in parent}
    assert len(found) == len(parent)


# -- mixing ------------------------------------------------------------------------------------


def test_targets():
    assert mixing.targets([100, 100, 100]) == [200.0, 250 / 3, 500 / 3]
    assert mixing.targets([]) == []
    assert mixing.targets([0, 0]) == [0.0, 0.0]
    sizes = [5, 1000, 3, 70, 70, 400]
    found = mixing.targets(sizes)
    assert sum(found) == pytest.approx(1.5 * sum(sizes))
    assert all(t <= 2 * s for t, s in zip(found, sizes, strict=True))


def test_split_quotas():
    quotas = [7, 0, 100, 33]
    found = mixing.split_quotas(quotas, 6)
    assert found.sum(axis=0).tolist() == quotas
    assert set(found.sum(axis=1)) <= {140 // 6, 140 // 6 + 1}
    assert (found == mixing.split_quotas(quotas, 6)).all()


def test_mix(docs, rows):
    measured = stage(mixing.measured(docs), "test-mix")
    drawn = mixing.draw(measured, mixing.make_plan(measured, shards=4)).collect()
    assert Counter((r["doc_id"], r["size"]) for r in drawn) == Counter(
        (d, len(words(t))) for d, t, *_ in rows
    )
    per_source = defaultdict(list)
    for r in drawn:
        per_source[r["source"]].append(r)
        taken = sum(d["words"] for d in r["draws"])
        assert 0 <= taken <= 2 * r["size"]
        assert len({d["epoch"] for d in r["draws"]}) == len(r["draws"])
        assert all(0 <= d["shard"] < 4 for d in r["draws"])
    order = sorted(per_source, key=lambda s: (s is None, s or ""))
    sizes = [sum(r["size"] for r in per_source[s]) for s in order]
    for source, size, target in zip(order, sizes, mixing.targets(sizes), strict=True):
        own = per_source[source]
        assert {(r["source_size"], r["target"]) for r in own} == {(size, target)}
        assert sum(d["words"] for r in own for d in r["draws"]) == round(target)
    again = mixing.draw(measured, mixing.make_plan(measured, shards=4)).collect()
    assert Counter(map(repr, again)) == Counter(map(repr, drawn))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    whole = Counter(
        r["doc_id"] for r in drawn for d in r["draws"] if 2 * d["words"] >= r["size"]
    )
    assert Counter(r["doc_id"] for r in mixed.select("doc_id").collect()) == whole


def test_no_mix(empty):
    measured = mixing.measured(empty)
    assert mixing.draw(measured, mixing.make_plan(measured)).count() == 0
    assert mixing.mixed_documents(empty).count() == 0


def test_words(spark):
    texts = ["", None, " ", "a", "a\tb\x0b\x0cc\r\nd", "x　y\xa0z", "\x1c a"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [r[0] for r in frame.select(word_count("text")).collect()]
    assert found == [len(words(t)) for t in texts]


# -- sharding -------------------------------------------------------------------------------------


def test_best_fit():
    assert shards.best_fit([5, 4, 3, 2], 2, 7) == [0, 1, 1, 0]
    assert shards.best_fit([5, 4, 3, 3], 2, 7) is None
    sizes = np.random.default_rng(1).integers(1, 1000, 3000).tolist()
    loads = Counter()
    for size, bin_ in zip(sizes, shards.pack(sizes, 40), strict=True):
        loads[bin_] += size
    assert len(loads) == 40
    assert max(loads.values()) <= 1.001 * sum(sizes) / 40
    assert shards.pack([], 3) == []


def test_shards(docs, rows):
    found = shards.assign(docs, shards=3, grain=8).collect()
    expected = Counter(
        (d, len((t or "").encode()) + 16, crc32((t or "").encode())) for d, t, *_ in rows
    )
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == expected
    slots = defaultdict(list)
    where = defaultdict(set)
    load = Counter()
    for r in found:
        slots[r["shard"]].append(r["slot"])
        where[r["text_crc32"]].add(r["shard"])
        load[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= {0, 1, 2}
    # The long text twice is more than a third of all bytes, and the only group that is cut.
    capacity = sum(load.values()) // 3
    for crc, at in where.items():
        size = sum(r["size"] for r in found if r["text_crc32"] == crc)
        assert len(at) == 1 or size > capacity


def test_no_shards(empty):
    assert shards.assign(empty).count() == 0


# -- language ----------------------------------------------------------------------------------------


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(docs).join(
        docs.select("doc_id", "lang", F.length("text").alias("n")), "doc_id"
    )
    rows = [r for r in found.where("held_out").collect() if r["n"] >= 20]
    right = sum(r["lang"] == r["lang_pred"] for r in rows)
    assert right >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)


def test_language_of_odd_rows(docs, rows):
    found = language.identify(docs).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    for doc, text, *_ in rows:
        if doc is not None and not any(c.isalpha() for c in text or ""):
            assert (by_id[doc]["lang_pred"], by_id[doc]["score"]) == ("und", 0.0)
    assert {r["lang_pred"] for r in found} <= {r[2] for r in rows} | {"und"}


def test_bundles_are_sums_of_bound_triples():
    texts = ["Aß c", "", "1 2", "aß  C", "x" * 5000]
    found = language.bundles(texts)
    a, b, c, s = (language.letter_vector(ord(x)) for x in "aßc ")
    turn = np.roll
    triples = [(s, a, b), (a, b, s), (b, s, c), (s, c, s)]
    expected = sum(turn(x, 2) * turn(y, 1) * z for x, y, z in triples)
    assert (found[0] == expected).all() and (found[3] == expected).all()
    assert not found[1].any() and not found[2].any()


def test_no_language(spark, empty, docs):
    assert language.identify(empty).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(unlabelled).collect()} == {"und"}


# -- queries and pipeline --------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query(spark, tables, name):
    con = duckdb.connect()
    for table, file in tables.items():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{file}'")
    frame = queries.QUERIES[name](spark, FOLDER)
    relation = con.execute(queries.CHECKS[name])
    columns = [d[0] for d in relation.description]
    assert sorted(columns) == sorted(frame.columns)
    ours = sorted(repr([r[c] for c in columns]) for r in frame.collect())
    assert ours == sorted(repr(list(r)) for r in relation.fetchall())


def test_pipeline(spark):
    """Each stage against a plain version of what it should keep of its own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    previous = docs.collect()
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = stage(function(spark, docs, FOLDER), "test-pipeline")
        rows = out.collect()
        assert out.columns == columns
        had = Counter(map(repr, previous))
        if name == "exact_dedup":
            last = {}
            for r in previous:
                last[r["text"]] = max(last.get(r["text"], -1), r["doc_id"])
            assert {r["doc_id"] for r in rows} == set(last.values())
        if name == "near_dedup":
            wanted = plain_components([(r["doc_id"], r["text"]) for r in previous], 5, 80)
            assert {r["doc_id"] for r in rows} == {d for d, c in wanted.items() if d == c}
        if name == "quality_rules":
            assert all(len(words(r["text"])) >= 50 for r in rows)
        copies = Counter(map(repr, rows))
        most = 2 if name == "source_mix" else 1
        assert all(n <= most * had[r] for r, n in copies.items())
        docs, previous = out, rows
    encoded = corpus_pipeline.encode(spark, docs, FOLDER).collect()
    tool = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in encoded) == Counter(
        (r["doc_id"], (*tool.encode(r["text"]), 2)) for r in previous
    )
    whole = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter(map(repr, whole)) == Counter(map(repr, encoded))


def test_pipeline_of_nothing(spark, empty):
    docs = empty
    for _, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, FOLDER), "test-empty")
        assert docs.count() == 0
