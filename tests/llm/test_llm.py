"""Each operator against brute force or the named library on small fixtures:
nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import tokenizers
import xxhash
from pyspark.sql import functions as F

from panelkit.llm import bpe, huffman_ids, language_id, mih_search, mixing, passages, quality_rules, simhash, toxicity, weak_quality

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, `row` string, fp long"
BPE, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")


def sentence(seed, n):
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(list("abcdefghij"), r.integers(2, 8))) for _ in range(n))


def texts():
    shared = sentence(1, 60)
    long = sentence(2, 4000)
    return [None, "", " ", "one", "ein zwei\ndrei", long, long, long + " end", sentence(3, 30) + " " + shared, shared + " " + sentence(4, 40),
            "the the the " * 40, "a  b\t\tc \n\n d　e  f", "<|endoftext|> it's 12,5€ \U0001f600", sentence(5, 120), sentence(5, 119) + " x",
            "line here\nline here\nother\n" * 6, "ALL CAPS!! " * 20, sentence(6, 55) * 2]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], ["s0", "s1", None][i % 3], len(t or ""), 7, "x", 3) for i, t in enumerate(texts())]
    rows += [rows[8], rows[3], (None, sentence(9, 80), "en", "s0", 1, 1, "y", 1), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def collected(df):
    return [r.asDict() for r in df.collect()]


# ------------------------------------------------------------------ ids, BPE

def test_token_files_match_the_library(spark, docs):
    got = huffman_ids.written_and_read(docs, JSON).collect()
    t = tokenizers.Tokenizer.from_file(JSON)
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    want = defaultdict(list)
    for r in rows:
        ids = np.array(t.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        want[r.doc_id].append((len(ids), zlib.crc32(ids.tobytes())))
    assert len(got) == len(rows)
    at = 0
    for g in sorted(got, key=lambda r: r.start):
        assert g.start == at and (g.n_tokens, g.ids_crc32) in want[g.doc_id]
        at += g.n_tokens
    order = [g.doc_id for g in sorted(got, key=lambda r: r.start)]
    assert order == [r.doc_id for r in rows]


def test_huffman_code_is_optimal_and_limited():
    import heapq
    for n in (1, 2, 3, 40, 3000):
        counts = np.append((np.random.default_rng(n).pareto(0.8, n) * 10 + 1).astype(int), [0, 0])
        bits = huffman_ids.code_lengths(counts)
        heap, total = [int(c) for c in counts[:n]], 0
        heapq.heapify(heap)
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            total += both
            heapq.heappush(heap, both)
        assert bits.max() <= huffman_ids.MOST_BITS and (bits[n:] == 0).all()
        if n > 1 and huffman_ids.code_lengths(counts, 40).max() <= huffman_ids.MOST_BITS:
            assert (bits * counts).sum() == total
        for size in (1, 511, 512, 513, 5000):
            ids = np.random.default_rng(size).integers(0, n, size)
            payload, checkpoints = huffman_ids.pack(ids, huffman_ids.canonical_codes(bits), bits)
            assert (huffman_ids.Decoder(bits).unpack(payload, checkpoints, size) == ids).all()


def test_token_files_of_nothing(spark, nothing):
    assert huffman_ids.written_and_read(nothing, JSON).collect() == []


def test_bpe_matches_the_library(docs, nothing):
    ranks = bpe.read_ranks(BPE)
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.round_trip(docs, BPE, P.PATTERN).join(docs.select(F.col("doc_id").alias("d"), "text"), F.col("doc_id").eqNullSafe(F.col("d"))).collect()
    for r in got:
        if r.doc_id is None:
            continue
        ids = np.array(lib.encode_ordinary(r.text or ""), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.round_trip(nothing, BPE, P.PATTERN).collect() == []


def test_special_token_strings_inside_texts():
    import pyarrow as pa
    from panelkit.llm.token_chunks import encoded
    some = ["a<|endoftext|>b c", "<|endoftext|>", "x <|endoftext|><|endoftext|> y  <|endoftext|>\n", " <|endoftext|>", "a <|endof text|> b <|endoftext|>. c d"]
    t = tokenizers.Tokenizer.from_file(JSON)
    got = [ids[a:b].tolist() for ids, at in encoded(pa.array(some), huffman_ids.worker_table(JSON)) for a, b in zip(at, at[1:])]
    assert got == [t.encode(x, add_special_tokens=False).ids for x in some]


def test_long_rows_without_a_space():
    """Single pre-tokens of up to a megabyte, and lengths around those at which rows are merged alone."""
    import time
    encoder = bpe.Encoder(bpe.read_ranks(BPE), P.PATTERN)
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    r = np.random.default_rng(0)
    letters = lambda n, some: "".join(r.choice(list(some), n))
    some = [letters(n, "etaoinshr") for n in (1022, 1023, 1024, 1025, 2048, 5000)] + ["a" * 3000, "中文字符" * 700, letters(4000, "aé"), letters(1_000_000, "etaoinshrdlu")]
    start = time.time()
    got = [np.frombuffer(x, "<i4").tolist() for x in encoder.merge([t.encode() for t in some])]
    assert got == [lib.encode_ordinary(t) for t in some] and time.time() - start < 120


def test_pieces_of_odd_white_space():
    import pyarrow as pa
    from panelkit.llm.token_chunks import PieceTable, encoded
    r = np.random.default_rng(0)
    odd = list("ab \n\t's1.\r \u0085　  ​é中\x1c")
    some = ["".join(r.choice(odd, r.integers(0, 40))) for _ in range(3000)]
    encoder = bpe.Encoder(bpe.read_ranks(BPE), P.PATTERN)
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    got = [ids[a:b].tolist() for ids, at in encoded(pa.array(some), PieceTable(encoder.encode_pieces, 500)) for a, b in zip(at, at[1:])]
    assert got == [lib.encode_ordinary(t) for t in some]


# --------------------------------------------------------------- classifiers

def test_language_id(spark, nothing, docs):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.identify(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    assert language_id.identify(nothing).collect() == []
    odd = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert odd[0].lang_pred == odd[1].lang_pred == odd[2].lang_pred == "und" and odd[0].score == 0


def test_phrases_are_greedy_longest_matches():
    sample, text = b"abracadabra", b"abrabrazadcab"
    parser = language_id.build_parser({"x": language_id.symbols(np.frombuffer(sample, np.uint8), np.array([0, len(sample)]))[0]})
    want, i = 0, 0
    while i < len(text):
        n = 1
        while i + n < len(text) and text[i:i + n + 1] in sample:
            n += 1
        i, want = i + n, want + 1
    value, at = language_id.symbols(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert parser.phrases(value, at)[0, 0] == want


def test_toxicity(spark, nothing):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    found = sum(r.predicted == 1 and r.toxic == 1 for r in got)
    assert found / sum(r.toxic for r in got) > 0.8
    assert sum(r.predicted == 1 and r.toxic == 0 for r in got) < 0.01 * len(got)
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxicity(nothing, empty).collect() == []
    assert [r.predicted for r in toxicity.toxicity(docs.limit(3), empty).collect()] == [1, 1, 1]  # share (0 + 1) / (0 + 2)


def test_swaps_lower_the_weight_of_group_names(spark):
    assert toxicity.swapped("Men, and WOMEN talk", [["men", "women"]]) == "women, and men talk"
    assert toxicity.swapped("nobody", [["men", "women"]]) is None
    rows = [(i, f"{'idiot' if i % 2 and i % 5 else 'kind'} {'muslims' if i % 2 and i % 3 else 'people'} w{i % 7} say", i % 2) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")
    neutral = spark.createDataFrame([(1, "muslims say"), (2, "christians say")], "doc_id long, text string")

    def gap(penalty):
        score = toxicity.score_udf(spark, toxicity.train(docs, labels, pair_penalty=penalty))
        a, b = (r.s for r in neutral.orderBy("doc_id").select(score("text").alias("s")).collect())
        return abs(a - b)

    assert gap(100.0) < 0.2 * gap(0.0)


def test_weak_quality(spark, nothing, docs):
    table, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = weak_quality.quality(table).join(labels, "doc_id").collect()
    assert sum(r.kept for r in got if r.quality) / sum(r.quality for r in got) > 0.97
    assert sum(not r.kept for r in got if not r.quality) / sum(1 - r.quality for r in got) > 0.5
    assert weak_quality.quality(nothing).collect() == []
    assert weak_quality.quality(docs).count() == docs.count()


def test_em_finds_the_labellers_accuracies():
    r = np.random.default_rng(1)
    truth, right = r.random(20000) < 0.7, [0.95, 0.8, 0.7, 0.5]
    votes = ["".join("01"[int(t ^ (r.random() > p))] for p in right) for t in truth]
    patterns, n = np.unique(votes, return_counts=True)
    share, p, _ = weak_quality.estimate(list(patterns), n.astype(float))
    assert abs(share - 0.7) < 0.03
    assert np.abs(p[:3, 1, 2] - right[:3]).max() < 0.04


# -------------------------------------------------------------------- search

def test_top_k(spark):
    r = np.random.default_rng(0)
    base = r.normal(size=(30, 40))
    rows = [(i, [float(x) for x in base[r.integers(30)] + 0.4 * r.normal(size=40)]) for i in range(300)]
    rows += [(i, [1.0] * 40) for i in range(300, 420)] + [(500, None), (501, [1.0, None, float("nan")]), (520, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for x in mih_search.top_k(vectors, F.col("vec_id") % 20 == 0, 5, index_block=64, query_block=4).orderBy("query_id", "rank").collect():
        got[x.query_id].append((x.neighbor_id, x.distance))
    code = {i: np.array([(v or 0) > 0 for v in e] + [False] * (40 - len(e))) for i, e in rows if e is not None}
    for q in (i for i in code if i % 20 == 0):
        want = sorted((int((code[q] ^ c).sum()), i) for i, c in code.items() if i != q)[:5]
        assert got.pop(q) == [(i, d) for d, i in want]
    assert not got
    assert mih_search.top_k(vectors.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_top_k_with_repeated_ids(spark):
    r = np.random.default_rng(1)
    vector = lambda: [float(x) for x in r.normal(size=24)]
    same, rows = vector(), []
    rows += [(0, same)] * 12 + [(i, vector()) for i in range(1, 15)]
    rows += [(20, vector()), (20, vector()), (20, vector()), (33, same), (33, same), (34, vector()), (34, vector()), (None, same)]
    got = defaultdict(list)
    for x in mih_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, 10).collect():
        got[x.query_id].append((x.rank, x.neighbor_id, x.distance))
    code = sorted({(i, tuple(v > 0 for v in e)) for i, e in rows if i is not None})
    want = defaultdict(list)
    for q, c in code:
        if q % 20 == 0:
            near = sorted((sum(a != b for a, b in zip(c, d)), i) for i, d in code if i != q)[:10]
            want[q] += [(k + 1, i, d) for k, (d, i) in enumerate(near)]
    assert {q: sorted(v) for q, v in got.items()} == {q: sorted(v) for q, v in want.items()}
    assert len(got[0]) == 10 and len(got[20]) == 30


# ------------------------------------------------------------------- dedup

def fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    hashes = [xxhash.xxh64(" ".join(w[i:i + 3]).encode(), seed=42).intdigest() for i in range(max(len(w) - 2, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, nothing):
    rows = [(r.doc_id, fingerprint(r.text)) for r in docs.collect()]
    got = [(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(x[:2] for x in got if x[0] is not None) == sorted(x for x in rows if x[0] is not None)
    group = {f: {f} for _, f in rows}
    for _, a in rows:
        for _, b in rows:
            if (a ^ b).bit_count() <= 3 and group[a] is not group[b]:
                group[a] |= group[b]
                for f in group[a]:
                    group[f] = group[a]
    for _, f, component in got:
        assert component == min((i for i, g in rows if g in group[f] and i is not None), default=None)
    assert simhash.near_duplicates(nothing).collect() == []
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len({frozenset(group[f]) for _, f in rows})


def test_unrelated_rows_without_or_with_equal_ids_all_stay(spark):
    rows = [(None, sentence(21, 40)), (None, sentence(22, 50)), (7, sentence(23, 60)), (7, sentence(24, 70)), (1, sentence(25, 80)),
            (None, sentence(25, 80)), (9, sentence(22, 50)), (7, sentence(24, 70))]
    df = spark.createDataFrame([(*r, "", "", 0, 0, "", 0) for r in rows], SCHEMA)
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_one(df).collect()), key=str)
    assert kept == sorted([(None, sentence(21, 40)), (9, sentence(22, 50)), (7, sentence(23, 60)), (7, sentence(24, 70)), (1, sentence(25, 80))], key=str)


def test_links_in_hot_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 40)
    r = np.random.default_rng(3)
    centre = [int(x) for x in r.integers(0, 1 << 62, 3)]
    fps = {c ^ sum(1 << int(b) for b in r.integers(0, 64, 2)) for c in centre for _ in range(150)} | {int(x) for x in r.integers(0, 1 << 62, 200)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    rows = spark.createDataFrame([(i, f) for i, f in enumerate(signed)], "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash.components(rows).collect()}
    parent = list(range(len(signed)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    array = np.array(signed).view(np.uint64)
    for i in range(len(array)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= 3):
            a, b = sorted((find(i), find(int(j))))
            parent[b] = a
    assert got == {i: find(i) for i in range(len(array))}


def repeats(rows, least=50):
    seen = defaultdict(list)
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - least + 1):
            seen[tuple(w[k:k + least])].append((i, k))
    repeated, removed = defaultdict(set), defaultdict(set)
    for places in seen.values():
        if len(places) > 1:
            for n, (i, k) in enumerate(places):
                repeated[i].update(range(k, k + least))
                if n:
                    removed[i].update(range(k, k + least))
    return repeated, removed


def test_passages(docs, nothing):
    rows = sorted({(r.doc_id, r.text) for r in docs.where("doc_id IS NOT NULL").collect()})
    repeated, removed = repeats(rows)
    covered = lambda spans: {k for s in spans for k in range(s["start"], s["end"])}
    got = {r.doc_id: r for r in passages.passages(docs).collect()}
    assert set(got) == set(repeated)
    for i, r in got.items():
        assert covered(r.repeated) == repeated[i] and covered(r.removed) == removed[i]
    assert passages.passages(nothing).collect() == []
    trimmed = passages.trim_passages(docs)
    assert trimmed.columns == docs.columns
    text = {r.doc_id: r for r in trimmed.collect()}
    for i, t in rows:
        left = [w for k, w in enumerate(words(t)) if k not in removed[i]]
        assert (words(text[i].text) == left) if left or not removed[i] else i not in text
        if removed[i] and left:
            assert text[i].n_chars == len(text[i].text)


# ------------------------------------------------------------ rules and mix

def test_base_counts_and_verdicts(docs, nothing):
    got = collected(quality_rules.quality_report(docs).join(docs.select(F.col("doc_id").alias("d"), "text").distinct(), F.col("doc_id") == F.col("d")))
    for r in got:
        t = r["text"] or ""
        w = words(t)
        windows = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        marked = {k + j for k, x in enumerate(windows) if windows.count(x) > 1 for j in range(5)} if len(w) < 1000 else None
        lines = [x for x in t.split("\n") if words(x)]
        assert r["n_words"] == len(w) and r["word_chars"] == sum(map(len, w))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", t)) and r["n_dup_lines"] == len(lines) - len(set(lines))
        if marked is not None:
            assert r["n_repeat_words"] == len(marked)
        assert r["base_failed"] == (len(w) < 10 or 100 * r["n_repeat_words"] > 20 * len(w))
        assert not (r["base_failed"] and r["kept"])
    assert quality_rules.quality_report(nothing).collect() == []
    kept = quality_rules.quality_rules(docs)
    assert kept.columns == docs.columns
    assert kept.where("doc_id IS NOT NULL").distinct().count() == sum(r["kept"] for r in {r["doc_id"]: r for r in got}.values())


def test_kneser_ney_sums_to_one_and_bands_reject(spark):
    data = b"the cat sat on the mat and the rat sat on the cat " * 3
    at = np.array([0, len(data)])
    keys, _ = quality_rules.ngram_keys(np.frombuffer(data, np.uint8), at, np.array([5]))
    known, n = np.unique(keys, return_counts=True)
    model = quality_rules.fit(known, n, 16)
    for context in (known[0] >> np.uint64(8), (np.uint64(5) << np.uint64(32)) | np.uint64(0x7A7A7A7A)):
        every = (context << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert abs(np.exp(model.logp(every)).sum() - 1) < 1e-3
    r = np.random.default_rng(0)
    # ordinary texts with some noise of several sizes, one of noise only
    rows = [(i, sentence(i, 60), "en") for i in range(200)] + [(999, " ".join("".join(map(chr, r.integers(0x2500, 0x2FFF, 9))) for _ in range(60)), "en")]
    got = quality_rules.quality_report(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert [r.doc_id for r in got if not r.kept] == [999]


def earliest_deadline_first(w, slots):
    """The source of each slot, one slot after the other."""
    total, done, out = sum(w), [0] * len(w), []
    for t in range(slots):
        due, i = min((-(-(done[i] + 1) * total // w[i]), i) for i in range(len(w)) if done[i] * total // w[i] <= t)
        assert due > t
        done[i] += 1
        out.append(i)
    return out


@pytest.mark.parametrize("share", [
    {"a": 0.5, "b": 0.31, None: 0.15, "c": 0.04}, {"a": 1.0}, {"a": 1.0, "b": 1.0, "c": 1.0}, {"": 3.0, None: 3.0, "x": 1.0},
    {"a": 0.5234567, "b": 0.3101, None: 0.1656333, "c": 0.00071, "d": 0.0001}, {s: k ** -1.3 for k, s in enumerate("abcdefghijklmno", 1)}], ids=str)
def test_mix_stays_within_one_block_of_the_target_weights(spark, share):
    total, slots = sum(share.values()), 6000
    weights = spark.createDataFrame([(s, x, int(slots * x / total) + 1) for s, x in share.items()], "source string, weight double, blocks long")
    names = sorted(share, key=lambda s: (s or "", s is not None))
    want = [names[i] for i in earliest_deadline_first([max(1, round(share[s] / total * mixing.PARTS)) for s in names], slots)]
    for frame in (37, mixing.FRAME, 1 << 20):
        frames = mixing.frames_of(weights, frame)
        if frame == 37 and min(share.values()) > total / 100:
            assert frames.count() > slots / 101
        dealt = sorted((r.slot, r.source or "", r.block, r.source) for r in mixing.block_slots(frames).collect())
        assert len(dealt) == sum(int(slots * x / total) + 1 for x in share.values())
        done = dict.fromkeys(share, 0)
        for t, (slot, _, block, s) in enumerate(dealt):
            if slot < slots:
                assert s == want[slot] and block == done[s]
                done[s] += 1
                if slot == t:  # until a source runs out
                    assert all(abs(done[k] - (t + 1) * x / total) < 1 for k, x in share.items())
        assert slot >= slots - 1


def test_mix_places_every_row(spark, docs, nothing):
    rows = mixing.schedule(docs, block_chars=100).collect()
    assert len(rows) == docs.count()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    for own in by.values():
        at = 0
        for r in sorted(own, key=lambda r: (r.start_char, r.key, -r.chars)):
            assert r.block == r.start_char // 100 and r.start_char <= at
            at = max(at, r.start_char + r.chars)
    mixed = mixing.mixed(docs, block_chars=100)
    assert mixed.columns == docs.columns and sorted(map(str, mixed.collect())) == sorted(map(str, docs.collect()))
    assert mixing.schedule(nothing).collect() == [] and mixing.mixed(nothing).collect() == []


def test_mix_ignores_weights_that_are_none(spark, docs):
    weights = spark.createDataFrame([("s0", 1.0), ("s0", 2.0), ("s1", float("nan")), (None, 1.0), ("absent", -1.0), ("gone", float("inf"))], "source string, weight double")
    slots = mixing.schedule(docs, weights, block_chars=100).groupBy("source").agg(F.count("slot").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    assert {r.source: r.n for r in slots} == {r.source: 0 if r.source == "s1" else r.rows for r in slots}


# ------------------------------------------------------------------ pipeline

def test_pipeline(spark, docs):
    import corpus_pipeline as pipeline
    assert len(pipeline.STAGES) == 5
    table = spark.read.parquet(f"{SF}/documents.parquet")
    first = pipeline.STAGES[0][1](spark, table, SF)
    good = {r.doc_id for r in quality_rules.quality_report(table).where("kept").collect()}
    assert {r.doc_id for r in first.select("doc_id").collect()} == good
    out = pipeline.run(spark, SF).collect()
    ids = {r.doc_id for r in out}
    component = {r.doc_id: r.component_id for r in simhash.near_duplicates(first).collect()}
    assert len(ids) == len(out) and ids <= {d for d, c in component.items() if d == c}
    kept = sorted((r.doc_id, r.text) for r in table.collect() if component.get(r.doc_id) == r.doc_id)
    _, removed = repeats(kept)
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(BPE), special_tokens={})
    text = dict(kept)
    assert ids == {d for d, t in kept if len(removed[d]) < len(words(t)) or not words(t)}
    for r in out:
        assert r.restored and r.n_tokens == len(r.ids)
        assert words(lib.decode(r.ids)) == [w for k, w in enumerate(words(text[r.doc_id])) if k not in removed[r.doc_id]]
    odd = docs
    for _, apply in pipeline.STAGES[:-1]:
        odd = apply(spark, odd, "")
        assert odd.columns == docs.columns
    assert pipeline.STAGES[-1][1](spark, odd, "").where("NOT restored").count() == 0


def test_pipeline_result_holds_the_mix(spark, monkeypatch):
    import corpus_pipeline as pipeline
    # the last two stages on many files of very different sizes, with blocks small enough for many slots
    monkeypatch.setattr(mixing.schedule, "__defaults__", tuple(500 if x == mixing.BLOCK_CHARS else x for x in mixing.schedule.__defaults__))
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text").where("doc_id < 400").repartitionByRange(7, "doc_id")
    docs = mixing.stage(table.unionByName(spark.createDataFrame([(9001, None, None), (9002, None, "short")], table.schema)), "mix-in")
    out = docs
    for _, apply in pipeline.STAGES[-2:]:
        out = mixing.stage(apply(spark, out, ""), "mix-test")
    rows = out.collect()
    assert len(rows) == docs.count() and all(r.restored for r in rows)
    place = {r.doc_id: (r.slot, r.start_char, r.key) for r in mixing.schedule(docs).collect()}
    assert {r.doc_id: (r.slot, r.start_char, r.mix_key) for r in rows} == place
    chars = {r.source: r.n for r in docs.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()}
    share = {s: n ** mixing.ALPHA for s, n in chars.items()}
    total, ends = sum(share.values()), {s: max(r.slot for r in rows if r.source == s) for s in share}
    used = defaultdict(set)
    for r in rows:
        used[r.source].add(r.slot)
    # any stretch of slots, until a source runs out (a slot whose block no document starts in is empty)
    last = min(e for s, e in ends.items() if s is not None)
    place_of = {(r.source, r.start_char // 500): r.slot for r in rows}
    for s, w in share.items():
        blocks = sorted((b, t) for (x, b), t in place_of.items() if x == s and t <= last)
        assert all(abs(b - t * w / total) < 1 for b, t in blocks)
    assert last > 20 and len(used) == len(share)


def test_ngrams_are_counted_and_scored_exactly(spark, docs):
    rows = docs.select("text", quality_rules.language_code(F.col("lang")).alias("code"))
    counts = quality_rules.stage(quality_rules.count_ngrams(rows, held=500), "counts")
    want = defaultdict(int)
    for r in rows.collect():
        data = (r.text or "").encode()
        for i in range(len(data) - 4):
            want[r.code << 40 | int.from_bytes(data[i:i + 5])] += 1
    assert {r.key: r.n for r in counts.collect()} == want
    keys, n = np.array(list(want), np.uint64), np.array(list(want.values()))
    for bits in (4, 16):  # far fewer ranges than n-grams lose none
        assert np.abs(np.sort(quality_rules.fit(keys, n, bits).top.values) - np.sort(quality_rules.fit(keys, n, 20).top.values)).max() == 0
    report = [sorted(map(str, quality_rules.judge(docs, F.col("text"), F.col("lang"), [F.col("doc_id")], pass_keys=k).withColumn("nll", F.round("nll", 6)).collect()))
              for k in (10**6, len(want) // 4)]
    assert report[0] == report[1]
    model = quality_rules.fit(np.sort(keys), n[np.argsort(keys)])
    got = quality_rules.probabilities(counts, held_out=False).collect()
    assert len(got) == len(want)
    assert np.abs(model.logp(np.array([r.key for r in got], np.uint64)) - [r.logp for r in got]).max() < 1e-4


def test_no_document_is_scored_by_its_own_ngrams(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang = 'en' AND doc_id % 4 = 0").select("doc_id", "text", "lang")
    r = np.random.default_rng(5)
    odd = {}
    for n in (100, 500, 2000):
        odd[-n] = " ".join(map(str, r.integers(0, 10**6, n)))
        odd[-n - 1] = " ".join(f"{x:08x}" for x in r.integers(0, 1 << 32, n))
        odd[-n - 2] = " ".join("".join(r.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), 6)) for _ in range(n))
    rows = table.unionByName(spark.createDataFrame([(i, t, "en") for i, t in odd.items()], table.schema))
    got = quality_rules.quality_report(rows).collect()
    assert not any(x.kept for x in got if x.doc_id in odd)
    score = {x.doc_id: x.nats_per_byte for x in got if x.nats_per_byte is not None}
    assert min(score[i] for i in odd) > np.median(list(score.values()))


def test_languages_of_long_texts_only_have_a_sample(spark):
    rows = [(i, "ab " * 60_000 + "xy " * 60_000, f"l{i:02d}") for i in range(12)] + [(50 + i, "cdefghij"[i] * 90_000, "many") for i in range(8)]
    got = language_id.draw_samples(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(got) == {r[2] for r in rows} and all(len(x) <= language_id.SAMPLE for x in got.values())
    assert all(set(b"abxy") <= set(got[f"l{i:02d}"].tolist()) for i in range(12))
    assert set(b"cdefghi") <= set(got["many"].tolist())
