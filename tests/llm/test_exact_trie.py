"""Exact dedup and the prefix trie against brute force: nulls, empty and long texts, ties,
repeated rows, hash clashes, empty tables, clashing columns."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import exact_dedup, prefix_trie

SCHEMA = "doc_id long, text string, lang string, `row` string, recipe string, row_no long, keep_id string"


def prose(seed, n):
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(list("abcdefghijÄßé中"), r.integers(1, 8))) for _ in range(n))


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def docs(spark):
    long = prose(1, 30_000)
    texts = [None, "", "A b", "a B", "a b ", "ÀÉ Ω", "àé ω", "àé Ω", long, long.upper(), long[:-1] + "X", "X" * 70_000, "x" * 70_000, "x" * 70_001, "\x00a", "\x00A", "a\r\nb", "a\nb"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "a b"), (3, "a b"), (None, "a b"), (None, "only here"), (None, "ONLY here"), (-5, ""), (2, "other")]
    return spark.createDataFrame([(*r, "en", "x", "y", 1, "z") for r in rows], SCHEMA)


def held(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[lowered(r.text)].append(r.doc_id)
    out = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, best, len(ids), digest) for i in ids]
    return out, {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}


@pytest.mark.parametrize("params", [{}, {"least": 8, "most": 64}, {"bits": 3}])
def test_exact_duplicates(docs, params):
    got = exact_dedup.exact_duplicates(docs, **params).collect()
    want, best = held(docs.select("doc_id", "text").collect())
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) == sorted(want, key=key)
    stay = [r for r in got if r.kept]
    assert len({r.text_sha256 for r in stay}) == len(stay) == len(best)
    assert all(r.doc_id == r.keep_id for r in stay)


def test_weak_identifiers_do_clash(docs):
    assert exact_dedup.clashes(docs, bits=3).count() > 0
    assert exact_dedup.clashes(docs).count() == 0


def test_deduplicated_rows_keep_their_columns(docs):
    got = exact_dedup.deduplicate(docs)
    assert got.schema == docs.schema
    _, best = held(docs.select("doc_id", "text").collect())
    assert sorted(lowered(r.text) for r in got.collect()) == sorted(best)
    assert {lowered(r.text): r.doc_id for r in got.collect()} == best


def test_chunks_are_content_defined(spark):
    text = prose(7, 20_000)
    one, two = (spark.range(1).select(exact_dedup.chunks(F.lit(t)).alias("c")).first().c for t in (text, "inserted " + text))
    data = text.encode().decode("latin-1")
    assert "".join(one) == data and max(map(len, one)) <= exact_dedup.MOST and min(map(len, one[:-1])) >= exact_dedup.LEAST
    assert len(set(one) & set(two)) > 0.9 * len(one)


def test_exact_dedup_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_duplicates(none).collect() == [] and exact_dedup.deduplicate(none).collect() == []


# ------------------------------------------------------------------ trie

TALK = "conv_id long, turn long, role string, text string, place string, f long"


def brute_trie(rows):
    own = defaultdict(list)
    for r in rows:
        if r.conv_id is not None:
            role, text = r.role or "", r.text or ""
            order = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[r.conv_id].append(((r.turn is not None, r.turn or 0, order), (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    talks = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        talks[c] = own.get(base, [])[:h] + own[c][h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for n in members:
        if n:
            children[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        leaves[n] = sum(leaves[x] for x in children[n]) or 1
        saved[n] = (len(members[n]) - 1) * (len(n[-1][1].encode()) if n else 0) + sum(saved[x] for x in children[n])
    return sorted((min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(children[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n in members)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture(scope="module")
def talks(spark):
    r = np.random.default_rng(3)
    rows = []
    for c in [*range(-12, 70), 10**15, 10**15 + 3]:
        for t in range(int(r.integers(0, 14))):
            shared = r.integers(0, 4) > 0
            rows.append((c, t, ["user", None, "", "bot"][t % 4], None if shared and t % 5 == 4 else "same é" * t if shared else prose(100 * c % 977 + t, 6)))
    rows += [(5, None, "user", "no number"), (5, None, "bot", "no number"), (5, 0, "user", "again"), (5, 0, "user", "again"), (None, 0, "user", "no conversation"), (None, None, None, None)]
    for c in (80, 81, 84, 85):  # long ones that go together for a while
        rows += [(c, t, "user", f"turn {t}" if t != 27 else f"turn {c // 5}") for t in range(40)]
    return spark.createDataFrame([(*x, "x", 1) for x in rows], TALK)


@pytest.mark.parametrize("params", [{}, {"run": 4, "width": 16}, {"p": 101}])
def test_trie(talks, params):
    got = prefix_trie.trie(talks, **params)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got.collect()) == brute_trie(talks.collect())


def test_small_moduli_do_clash(talks):
    lengths, prefixes = prefix_trie.rebuilt(prefix_trie.stored_turns(talks, 0, 3), 0, 3)
    assert prefix_trie._prefix_groups(prefixes).where("mixed").count() > 0


def test_trie_names_a_stored_turn(talks):
    node = prefix_trie.trie(talks).where("conv_id = 80 AND depth > 27").orderBy("depth").first()
    assert node.turn_conv_id == 80 and node.turn_place == node.depth


def test_trie_of_nothing(spark, talks):
    assert prefix_trie.trie(talks.where("conv_id IS NULL")).collect() == []
    one = spark.createDataFrame([(3, 0, "user", "x")], "conv_id long, turn long, role string, text string")  # h is 7, no base: no turn is left
    assert zlib.crc32(b"3") % 9 > 0
    assert sorted(tuple(r[c] for c in COLUMNS) for r in prefix_trie.trie(one).collect()) == brute_trie(one.collect())
