"""The registered queries of the operators, with the SQL that checks them where SQL can."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.llm import (
    exact,
    language,
    mixing,
    near,
    passages,
    phrases,
    pieces,
    pii,
    prefixes,
    quality,
    secrets,
    shards,
    tokens,
)
from gridmill.llm.common import documents, stage
from gridmill.scratch import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            CHECKS[name] = sql
        return function

    return register


@query("op1_token_planes")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch(spark, "op1")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    tokens.write_tokens(documents(spark, folder), out, tokenizer)
    return tokens.read_tokens(spark, out)


def _kind(name: str) -> Column:
    """How many spans are of that kind."""
    return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long")


def _listed(spans: Column | str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(text, ",")


def _base(names: list[str]) -> Column:
    return F.sha2(_listed(F.filter("spans", lambda s: s["kind"].isin(names))), 256)


# Matches of one pattern: their places are sums of the lengths of the gaps and matches before them.
_SPANS = """
    SELECT doc_id, '{kind}' AS kind, {rank} AS rank, found[i] AS f,
        list_sum([length(x) FOR x IN gaps[1:i]])
            + coalesce(list_sum([length(x) FOR x IN found[1:i - 1]]), 0) AS start
    FROM (SELECT doc_id, found, gaps, unnest(range(1, len(found) + 1)) AS i FROM (
        SELECT doc_id, regexp_extract_all(body, '{pattern}') AS found,
            string_split_regex(body, '{pattern}') AS gaps FROM texts))"""


def _spans_sql(patterns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        _SPANS.format(kind=k, rank=i, pattern=p.replace("'", "''"))
        for i, (k, p) in enumerate(patterns.items())
    )


def _either_case(words: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.islower() else c for c in words)


_VALUE = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_OP2_KINDS = {
    "assign": f"(?:{_either_case('password|passwd|secret|token|api_?key')}){_VALUE}",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
    "github": r"gh[oprsu]_[A-Za-z0-9]{36,}",
    "slack": r"xox[abprs]-[A-Za-z0-9-]{10,}",
    "google": r"AIza[A-Za-z0-9_-]{35}",
    "stripe": r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}",
    "jwt": r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+",
    "keyfile": r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----",
}
_OP2 = (
    "WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents), spans AS ("
    + _spans_sql(_OP2_KINDS)
    + f"""), checked AS (
        SELECT doc_id, kind, rank, start, kind || ':' || start || ':' || (start + length(f)) AS span
        FROM spans WHERE CASE kind
            WHEN 'assign' THEN
                length(regexp_extract(f, '{_OP2_KINDS["assign"].replace("'", "''")}', 1)) >= 6
            WHEN 'access' THEN length(f) >= 20 WHEN 'hex' THEN length(f) >= 24 ELSE true END)
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
        count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 3), ''))
            AS base_sha256,
        coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (kind IS NOT NULL), '') AS spans
    FROM texts LEFT JOIN checked USING (doc_id) GROUP BY doc_id"""
)


@query("op2_secret_scan", _OP2)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    base = [rule.name for rule in secrets.BASE]
    return secrets.find_secrets(documents(spark, folder)).select(
        "doc_id",
        *[_kind(name).alias(f"n_{name}") for name in base],
        _base(base).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )


@query("op3_source_mix")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    rows = stage(mixing.measured(documents(spark, folder)), "op3-rows")
    return mixing.draw(rows, mixing.make_plan(rows)).select(
        "doc_id", "size", "source_size", "target", mixing.taken().alias("taken")
    )


@query(
    "op4_exact_dedup",
    """
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
    groups AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY body)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
    FROM texts JOIN groups USING (body)""",
)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return exact.duplicates(documents(spark, folder)).drop("bucket")


# Measurements word by word; a window is covered if its three words occur again in the text.
_OP5 = r"""
    WITH words AS (
        SELECT doc_id, coalesce(text, '') AS body,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    lines AS (
        SELECT *, list_filter(string_split(body, chr(10)),
            lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM words),
    places AS (
        SELECT row, doc_id, i, w[i:i + 2]::VARCHAR AS win FROM (
            SELECT row_number() OVER () AS row, doc_id, w, unnest(range(1, len(w) - 1)) AS i
            FROM words)),
    again AS (
        SELECT doc_id, i FROM (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM places)
        WHERE n > 1),
    covered AS (
        SELECT doc_id, count(DISTINCT i + j) AS n
        FROM again, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
    rows AS (
        SELECT doc_id, len(w)::BIGINT AS n_words,
            coalesce(list_sum([length(x) FOR x IN w]), 0)::BIGINT AS word_chars,
            (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT
                AS n_symbols,
            len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
            coalesce(c.n, 0)::BIGINT AS n_repeat_words
        FROM lines LEFT JOIN covered c USING (doc_id)),
    bits AS (
        SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
            + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
            + CASE WHEN 10 * word_chars < 15 * n_words THEN 4 ELSE 0 END
            + CASE WHEN 10 * word_chars > 250 * n_words THEN 8 ELSE 0 END
            + CASE WHEN 100 * n_symbols > 30 * n_words THEN 16 ELSE 0 END
            + CASE WHEN n_dup_lines > 1 AND 100 * n_dup_lines > 60 * n_lines THEN 32 ELSE 0 END
            )::BIGINT AS failed FROM rows)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed FROM bits"""


@query("op5_quality_rules", _OP5)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.ledger(documents(spark, folder))
    base, full = quality.rejected(quality.BASE), quality.rejected(quality.FULL)
    return rows.select(
        "doc_id",
        *[m for m in quality.MEASURES if m != "n_lines"],
        base.alias("base_failed"),
        (~full).alias("kept"),
        "failed",
    )


_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
_OP6 = rf"""
    WITH RECURSIVE texts AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
            '[^\x20\x09-\x0D]+') AS w FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w::VARCHAR]
            ELSE list_distinct([w[i:i + 2]::VARCHAR FOR i IN range(1, len(w) - 1)]) END AS s
        FROM texts),
    shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
    links AS (
        SELECT a.doc_id AS u, b.doc_id AS v FROM shingles a JOIN shingles b USING (x)
        WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
        HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
    reach AS (
        SELECT doc_id AS u, doc_id AS v FROM texts
        UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u)
    SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, component_id = doc_id AS kept
    FROM sets JOIN (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u)
        USING (doc_id)"""


@query("op6_near_dedup", _OP6)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    match = near.Match(words=3, percent=85)
    return near.near_duplicates(documents(spark, folder), match).drop("set_id")


_OP7_KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
}
_OP7 = (
    "WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents), spans AS ("
    + _spans_sql(_OP7_KINDS)
    + r"""), digits AS (
        SELECT *, regexp_replace(f, '[^0-9]', '', 'g') AS d, replace(f, ' ', '') AS s FROM spans),
    checked AS (
        SELECT doc_id, kind, rank, start,
            kind || ':' || start || ':' || (start + length(f)) AS span FROM digits
        WHERE CASE kind WHEN 'email' THEN true
            WHEN 'ip' THEN list_max([x::HUGEINT FOR x IN string_split(f, '.')]) <= 255
            WHEN 'phone' THEN length(d) BETWEEN 9 AND 15
            WHEN 'card' THEN length(d) BETWEEN 13 AND 19 AND list_sum([
                CASE WHEN i % 2 = 0 THEN d[length(d) - i]::INT
                    WHEN d[length(d) - i]::INT > 4 THEN d[length(d) - i]::INT * 2 - 9
                    ELSE d[length(d) - i]::INT * 2 END FOR i IN range(length(d))]) % 10 = 0
            ELSE length(s) BETWEEN 15 AND 34 AND list_aggregate([
                CASE WHEN ord(c) < 65 THEN c ELSE (ord(c) - 55)::VARCHAR END
                FOR c IN string_split(s[5:] || s[:4], '')], 'string_agg', '')::HUGEINT % 97 = 1
            END)
    SELECT doc_id,
        count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
        count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
        sha256(coalesce(string_agg(span, ',' ORDER BY rank, start) FILTER (rank < 4), ''))
            AS base_sha256,
        coalesce(string_agg(span, ',' ORDER BY rank, start) FILTER (kind IS NOT NULL), '') AS spans
    FROM texts LEFT JOIN checked USING (doc_id) GROUP BY doc_id"""
)


@query("op7_personal_data", _OP7)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    base = [kind.name for kind in pii.BASE]
    return pii.find_personal_data(documents(spark, folder)).select(
        "doc_id",
        *[_kind(name).alias(f"n_{name}") for name in base],
        _base(base).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )


@query("op8_sharding")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    rows = shards.assign(documents(spark, folder))
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op9_sentencepiece")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.encode_pieces(documents(spark, folder), model)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.element_at("ends", -1).cast("long").alias("n_bytes"),
        F.size(F.filter(F.arrays_zip("begins", "ends"), lambda s: s["begins"] == s["ends"]))
        .cast("long")
        .alias("n_empty_spans"),
    )


@query("op10_language_id")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    rows = language.identify(documents(spark, folder))
    return rows.select("doc_id", "held_out", "lang_pred", "score")


_OP11 = r"""
    WITH texts AS (
        SELECT row_number() OVER () AS row, doc_id,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    wins AS (
        SELECT row, doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM (
            SELECT row, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM texts)),
    least AS (SELECT win, min(doc_id) AS least FROM wins GROUP BY win),
    hit AS (SELECT row, i FROM wins JOIN least USING (win) WHERE least < doc_id),
    gone AS (SELECT DISTINCT row, i + j AS p FROM hit, (SELECT unnest(range(13)) AS j)),
    words AS (SELECT row, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM texts),
    kept AS (
        SELECT row, string_agg(x, ' ' ORDER BY p) AS body
        FROM words ANTI JOIN gone USING (row, p) GROUP BY row),
    counts AS (SELECT row, count(*) AS n, min(p) - 1 AS first FROM gone GROUP BY row)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
        sha256(coalesce(body, '')) AS kept_sha256, first::BIGINT AS first_removed
    FROM texts LEFT JOIN counts USING (row) LEFT JOIN kept USING (row)"""


@query("op11_repeated_passages", _OP11)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(documents(spark, folder))


_OP12 = rf"""
    WITH texts AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM texts),
    grams AS (
        SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
            SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
            FROM pieces, (SELECT unnest([1, 2, 3]) AS k))),
    counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase),
    totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
    candidates AS (
        SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w
        FROM counts WHERE k > 1 AND f >= 10),
    cuts AS (
        SELECT c.*, j, array_to_string(w[1:j], ' ') AS p, array_to_string(w[j + 1:], ' ') AS q
        FROM candidates c, (SELECT unnest([1, 2]) AS j) WHERE j < size),
    scores AS (
        SELECT cuts.*, x.f AS l, y.f AS r,
            (1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM cuts JOIN counts x ON x.lang = cuts.lang AND x.phrase = p
        JOIN counts y ON y.lang = cuts.lang AND y.phrase = q),
    lowest AS (
        SELECT * FROM scores
        QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    longer AS (
        SELECT lang, phrase, max(a) AS longest FROM (
            SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')])
                AS phrase FROM candidates WHERE size = 3) GROUP BY lang, phrase)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
        phrase, a, l, r, n, score, j AS k
    FROM lowest LEFT JOIN longer USING (lang, phrase) JOIN totals USING (lang)
    WHERE longest IS NULL OR 100 * longest < 50 * a
    QUALIFY rank <= 2000"""


@query("op12_phrases", _OP12)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(documents(spark, folder))


# The remainder of the CRC-32 of a number's decimal digits, bit by bit.
_CRC = """
    (xor(list_reduce(list_prepend(4294967295::BIGINT,
        [ord(x)::BIGINT FOR x IN string_split(c::VARCHAR, '')]),
        lambda a, b: list_reduce(list_prepend(xor(a, b), [i::BIGINT FOR i IN range(8)]),
            lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT)
                ELSE v >> 1 END)), 4294967295::BIGINT) % 9)"""
_OP13 = f"""
    WITH turns AS (
        SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                coalesce(text, '')) AS p
        FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (SELECT c, c - c % 5 AS base, {_CRC} AS h FROM (SELECT DISTINCT c FROM turns)),
    rebuilt AS (
        SELECT convs.c, p, role, text FROM convs JOIN turns ON turns.c = base AND p <= h
        UNION ALL
        SELECT convs.c, p, role, text FROM convs JOIN turns ON turns.c = convs.c AND p > h),
    seqs AS (
        SELECT c, coalesce(s, []) AS s FROM convs LEFT JOIN (
            SELECT c, list({{'role': role, 'text': text}} ORDER BY p) AS s FROM rebuilt GROUP BY c)
        USING (c)),
    members AS (
        SELECT c, d, s[1:d]::VARCHAR AS k, len(s) = d AS last,
            CASE WHEN d > 0 THEN strlen(s[d].text) ELSE 0 END AS bytes
        FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM seqs)),
    nodes AS (
        SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
            sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), ''))
                AS ends_sha256 FROM members GROUP BY d, k),
    family AS (
        SELECT m.d, m.k, count(*) AS n_children FROM nodes n
        JOIN members m ON m.c = n.conv_id AND m.d = n.d - 1 GROUP BY m.d, m.k),
    full_ AS (
        SELECT nodes.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * bytes AS saved
        FROM nodes LEFT JOIN family USING (d, k)),
    below AS (
        SELECT m.d, m.k, count(*) FILTER (n.n_children = 0) AS n_leaves,
            sum(saved)::BIGINT AS saved_tokens FROM full_ n
        JOIN members m ON m.c = n.conv_id AND m.d <= n.d GROUP BY m.d, m.k)
    SELECT f.conv_id, f.d::BIGINT AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children,
        n_leaves, saved_tokens, f.ends_sha256
    FROM full_ f JOIN below USING (d, k)
    LEFT JOIN members m ON m.c = f.conv_id AND m.d = f.d - 1
    LEFT JOIN nodes up ON up.d = m.d AND up.k = m.k"""


@query("op13_prefix_trie", _OP13)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.prefix_trie(spark.read.parquet(f"{folder}/conversations.parquet"))
