"""Operators that look at one row at a time: ids, secrets, quality, personal data, pieces."""

import random
import re
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from gridmill.llm import pieces, pii, quality, secrets, tokens
from gridmill.llm.automaton import Rule, compile_rules, longest, run_states
from gridmill.llm.charmap import Normaliser

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def order(value):
    return (value is not None, value)


# -- token ids in planes -----------------------------------------------------------


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [1, 7, 8, 1000, 65_536])
def test_planes_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32).tobytes()
    planes = tokens.to_planes(ids, bits)
    assert len(planes) == (32 if bits else 4)
    assert tokens.from_planes(planes, n) == ids


@pytest.mark.parametrize("bits", [False, True])
def test_token_files(spark, docs, rows, tmp_path, bits):
    out = str(tmp_path / "tokens")
    tokens.write_tokens(docs, out, BYTE_BPE, bits=bits)
    tool = Tokenizer.from_file(BYTE_BPE)
    start = 0
    keyed = sorted(rows, key=lambda r: order(r[0]))
    by_id = {}
    for key, text, _, _ in keyed:
        ids = [*tool.encode(text or "", add_special_tokens=False).ids, tokens.END_ID]
        by_id.setdefault(key, []).append(ids)
    found = tokens.read_tokens(spark, out, with_ids=True).orderBy("start").collect()
    assert len(found) == len(rows)
    assert [r["doc_id"] for r in found] == [r[0] for r in keyed]
    for row in found:  # rows of one id may stand in either order
        assert row["start"] == start
        assert row["ids"] in by_id[row["doc_id"]]
        by_id[row["doc_id"]].remove(row["ids"])
        assert row["n_tokens"] == len(row["ids"])
        assert row["ids_crc32"] == zlib.crc32(array("I", row["ids"]).tobytes())
        start += row["n_tokens"]
    assert not any(by_id.values())
    index = spark.read.parquet(f"{out}/index").orderBy("start").collect()
    assert [r["start"] for r in index] == list(np.cumsum([0, *[r["n_ids"] for r in index]])[:-1])
    assert sum(r["n_docs"] for r in index) == len(rows)


def test_no_tokens(spark, empty, tmp_path):
    out = str(tmp_path / "tokens")
    tokens.write_tokens(empty, out, BYTE_BPE)
    assert tokens.read_tokens(spark, out).count() == 0


def test_words_go_to_the_model_at_once(monkeypatch):
    """Words of Latin letters take no splitting; anything else still goes through the tokenizer."""
    words = ["a", " a", "Straße", " MENTEÓ", " ÿÀ", "ÑMENTEÓ", " lichstheit", "x" * 300, " aª"]
    words += [" ×", "can't", " 12", "漢字", ".96@mail5.example", " \n"]
    own, whole = tokens.Encoder(BYTE_BPE), tokens.Encoder(BYTE_BPE)
    assert [own.ids(w) for w in words] == whole.encode(words)
    assert [own.encode_piece(w) for w in words] == whole.encode(words)
    text = "".join(f" {w.strip()}" for w in words[:8])
    ids, own = whole.encode([text])[0], tokens.Encoder(BYTE_BPE)
    monkeypatch.setattr(own, "encode", lambda texts: pytest.fail("split again"))
    assert own.ids(text) == ids


def test_byte_pieces_are_cut_where_the_library_cuts():
    tool = tokens.Encoder(BYTE_BPE)
    rng = random.Random(1)
    signs = ["a", "The", " ", "  ", "\n", "\r\n", "\t", "'s", "'ll", "12", "é", "漢", "😀", "\x1f"]
    signs += ["<|endoftext|>", ".", "##", ",", "-", "x", "’", "word", "' ", "_", "É", "　", "\xa0"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    assert [tool.ids(t) for t in texts] == tool.encode(texts)


# -- secrets -------------------------------------------------------------------------

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
BASE = ["assign", "access", "hex"]


def plain_secrets(text):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], BASE.index(s[0])))


def test_secrets_equal_plain_expressions():
    scanner = secrets.Scanner(secrets.RULES)
    rng = random.Random(3)
    signs = ["token", "password", "API_KEY", "apikey", "secret", " ", "  ", "=", ":", "'", '"', "abc"]
    signs += ["AKIA", "ABCDEF0123456789", "0123abcd", "é", "😀", "/", "token: token", "\n", "deadbeef"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    found = scanner.scan([t.encode() for t in texts])
    for text, spans in zip(texts, found, strict=True):
        assert [s for s in spans if s[0] in BASE] == plain_secrets(text)


def test_secrets_of_the_table(docs, rows):
    found = secrets.find_secrets(docs).collect()
    assert len(found) == len(rows)
    by_text = {}
    for key, text, _, _ in rows:
        by_text.setdefault(key, []).append(plain_secrets(text or ""))
    for row in found:
        own = [(s["kind"], s["start"], s["end"]) for s in row["spans"] if s["kind"] in BASE]
        assert own in by_text[row["doc_id"]]
    kinds = {s["kind"] for r in found for s in r["spans"] if r["doc_id"] == 2006}
    assert kinds == {"assign", "access", "hex", "github"}


def test_no_secrets(empty):
    assert secrets.find_secrets(empty).count() == 0


@pytest.mark.parametrize(
    "pattern", ["ab*c", "(a|bc)+d?", "a{2,4}b", "x[^a-y]{1,2}", "[ab]{3}", "a(b|c){0,2}d"]
)
def test_automaton_against_expressions(pattern):
    rng = random.Random(7)
    one = compile_rules([Rule("r", pattern)], anchored=True)
    all_ = compile_rules([Rule("r", pattern), Rule("s", "zz")])
    for _ in range(400):
        text = "".join(rng.choice("abcdxyz") for _ in range(rng.randint(0, 12))).encode()
        every = re.compile(pattern.encode())
        for start in range(len(text)):
            ends = [e for e in range(start, len(text) + 1) if every.fullmatch(text, start, e)]
            assert longest(one, text, start) == max(ends, default=-1)
        if text:
            marks = all_.accepts[run_states(all_, text)] & 1
            for end in range(1, len(text) + 1):
                hit = any(every.fullmatch(text, s, end) for s in range(end))
                assert bool(marks[end - 1]) == hit


# -- quality -------------------------------------------------------------------------


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return (
        len(words), sum(map(len, words)), symbols, len(lines), len(lines) - len(set(lines)),
        len(covered),
    )


def test_ledger(docs, rows):
    ledger = quality.ledger(docs).cache()
    found = sorted(
        ((r["doc_id"], *[r[m] for m in quality.MEASURES]) for r in ledger.collect()),
        key=lambda r: (order(r[0]), r[1:]),
    )
    expected = sorted(
        ((k, *plain_measures(t)) for k, t, _, _ in rows), key=lambda r: (order(r[0]), r[1:])
    )
    assert found == expected
    kept = quality.accepted(docs)
    assert kept.columns == docs.columns
    assert kept.count() == ledger.where(~quality.rejected(quality.FULL)).count()
    rows_ = ledger.collect()
    for row in quality.ablations(ledger, [quality.BASE, quality.FULL]).collect():
        mask = {"base-1": quality.BASE, "full-1": quality.FULL}[row["version"]].mask
        bit = 1 << quality.RULES[row["rule"]]
        assert row["failed"] == sum(bool(r["failed"] & bit) for r in rows_)
        assert row["alone"] == sum(r["failed"] & mask == bit for r in rows_)
        assert row["kept_without"] == sum(not r["failed"] & mask & ~bit for r in rows_)


def test_no_quality(empty):
    assert quality.ledger(empty).count() == 0
    assert quality.accepted(empty).count() == 0


# -- personal data ---------------------------------------------------------------------


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_private(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            lambda s: all(int(p) <= 255 for p in s.split(".")),
        ),
        "card": (
            r"[0-9]([\x20-]?[0-9])+",
            lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s)),
        ),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    return [
        (kind, *m.span())
        for kind, (pattern, holds) in rules.items()
        for m in re.finditer(pattern, text)
        if holds(m[0])
    ]


def private_of(frame):
    base = {k.name for k in pii.BASE}
    return {
        r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] in base]
        for r in pii.find_personal_data(frame).collect()
    }


def test_personal_data_equals_plain_expressions(spark):
    rng = random.Random(5)
    signs = ["a", "x.y", "@", "b.c", ".", "..", "%", "-", " ", "+", "1", "12", "255", "256", "4111", "("]
    signs += [")", "4111 1111 1111 1111", "5500-0000-0000-0004", "+49 30 1234567", "é", "😀", "1.2.3.4"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["a@" + "b." * 50_000 + "c", "1." * 4_000, "+1" + " 2" * 4_000, "9" * 8_000]
    texts += [" ".join(f"10.0.{i % 300}.7" for i in range(1000))]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert private_of(frame) == {i: plain_private(t) for i, t in enumerate(texts)}


def test_personal_data_of_the_table(docs, rows):
    found = pii.find_personal_data(docs).collect()
    assert len(found) == len(rows)
    own = next(r["spans"] for r in found if r["doc_id"] == 2007)
    assert [(s["kind"], s["score"]) for s in own] == [
        ("email", 1.0), ("email", 0.9), ("ip", 0.7), ("card", 0.9), ("phone", 0.8), ("iban", 1.0),
    ]
    wanted = dict((k, plain_private(t or "")) for k, t, _, _ in rows if k not in (None, 2013))
    got = private_of(docs)
    assert all(got[k] == v for k, v in wanted.items())


def test_long_runs_are_read_once(spark):
    texts = ["a" * 500_000, "1." * 200_000, "9" * 500_000, "@a" * 200_000, "a@b" + ".c" * 200_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = private_of(frame)
    assert found[0] == found[2] == found[3] == []
    assert found[4] == [("email", 0, len(texts[4]))]
    assert len(found[1]) == 50_000  # addresses, one after the other


def test_no_personal_data(empty):
    assert pii.find_personal_data(empty).count() == 0


# -- pieces ----------------------------------------------------------------------------


def test_pieces_of_the_table(docs, rows):
    tool = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = pieces.encode_pieces(docs, PIECES).collect()
    assert len(found) == len(rows)
    wanted = {}
    for key, text, _, _ in rows:
        wanted.setdefault(key, []).append((text or "").encode())
    for row in found:
        texts = {tuple([*tool.encode(t.decode()), 2]): t for t in wanted[row["doc_id"]]}
        text = texts[tuple(row["ids"])]
        assert row["decoded"] == tool.decode(row["ids"])
        spans = list(zip(row["begins"], row["ends"], strict=True))
        # The spans lie end to end and cover the whole text.
        assert b"".join(text[a:b] for a, b in spans) == text
        assert spans[-1] == (len(text), len(text))


def test_no_pieces(empty):
    assert pieces.encode_pieces(empty, PIECES).count() == 0


def test_piece_parts_are_cut_where_no_piece_crosses():
    tool = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    own = pieces.Encoder(PIECES)
    rng = random.Random(1)
    signs = ["a", "The", " ", "  ", "\n", "\t", "▁", "12", "é", "漢", "😀", "\x00", "<s>", "</s>", "."]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    assert [own.encode(t)[0].tolist() for t in texts] == tool.encode(texts)


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nfkc_cf", "nmt_nfkc_cf"])
def test_normalisation_by_compiled_maps(rule):
    squeeze = rule != "nfkc"
    library = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True,
        remove_extra_whitespaces=squeeze,
    )
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(library.serialized_model_proto())
    own = Normaliser(model.normalizer_spec.precompiled_charsmap, True, squeeze)
    rng = random.Random(2)
    signs = ["a", "The", " ", "  ", "\n", "▁", "é", "漢", "😀", "ﬁ", "㌔", "Ａ", "½", "é", "ß", "K"]
    for _ in range(1500):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 20)))
        made = own(text.encode())
        assert made.text.decode() == library.normalize(text)
        assert len(made.begin) == len(made.end) == len(made.text)
        assert (made.begin <= made.end).all() and (np.diff(made.begin) >= 0).all()
