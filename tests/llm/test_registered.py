"""Registered queries that SQL cannot check, against plain versions over the whole table."""

import hashlib
import re
import zlib
from array import array
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as driver
from gridmill.llm import mixing

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    return {r["doc_id"]: r for r in rows}


def rows_of(spark, name):
    return driver.queries()[name](spark, FOLDER).collect()


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_all_are_registered():
    names = [n for n in driver.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in driver.queries()


def test_token_planes(spark, table):
    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected, start = [], 0
    for doc in sorted(table):
        ids = [*tool.encode(table[doc]["text"], add_special_tokens=False).ids, 2]
        expected.append((doc, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    assert sorted(map(tuple, rows_of(spark, "op1_token_planes"))) == expected


def test_source_mix(spark, table):
    found = rows_of(spark, "op3_source_mix")
    assert len(found) == len(table)
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for d, r in table.items()}
    per_source = defaultdict(list)
    for r in found:
        assert r["size"] == size[r["doc_id"]] and 0 <= r["taken"] <= 2 * r["size"]
        per_source[table[r["doc_id"]]["source"]].append(r)
    order = sorted(per_source)
    sizes = [sum(r["size"] for r in per_source[s]) for s in order]
    for source, total, target in zip(order, sizes, mixing.targets(sizes), strict=True):
        own = per_source[source]
        assert {(r["source_size"], r["target"]) for r in own} == {(total, target)}
        assert abs(sum(r["taken"] for r in own) - target) <= 1
    assert sorted(map(tuple, rows_of(spark, "op3_source_mix"))) == sorted(map(tuple, found))


def test_sharding(spark, table):
    found = rows_of(spark, "op8_sharding")
    slots, load, where = defaultdict(list), Counter(), defaultdict(set)
    for r in found:
        text = table[r["doc_id"]]["text"].encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 16, zlib.crc32(text))
        assert r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
        where[text].add(r["shard"])
    assert len(found) == len(table) and set(slots) <= set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    share = sum(load.values()) // 40
    group = Counter()
    for r in found:
        group[table[r["doc_id"]]["text"].encode()] += r["size"]
    # Equal texts stay together unless they are more than a shard's share.
    assert all(len(at) == 1 or group[text] > share for text, at in where.items())
    assert max(load.values()) <= max(1.05 * share, max(r["size"] for r in found))


def test_sentencepiece(spark, table):
    tool = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    expected = []
    for doc, row in table.items():
        ids = [*tool.encode(row["text"]), 2]
        listed = " ".join(map(str, ids))
        expected.append((doc, len(ids), digest(listed), digest(tool.decode(ids))))
    found = rows_of(spark, "op9_sentencepiece")
    assert sorted(tuple(r)[:4] for r in found) == sorted(expected)
    assert all(r["n_bytes"] == len(table[r["doc_id"]]["text"].encode()) for r in found)


def test_language(spark, table):
    found = rows_of(spark, "op10_language_id")
    assert len(found) == len(table)
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    out = [r for r in found if r["held_out"]]
    right = sum(r["lang_pred"] == table[r["doc_id"]]["lang"] for r in out)
    assert right >= 0.95 * len(out)
