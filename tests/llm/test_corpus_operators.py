"""Corpus operators against brute force and the libraries, and on awkward tables."""

import base64
import collections
import gzip
import hashlib
import json
import random
import re
import urllib.parse
import zlib
from types import SimpleNamespace

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import (ann, bpe, line_dedup, linear, mixing, quality, queries, secret_scan, simhash, token_file,
                         toxicity, winnow)
from tessera.llm.common import documents, id_bucket, id_edges, scratch_path

DOC = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use inside or return
CLASH = ("h", "n", "key", "keeper", "batch", "size", "target", "reps", "ids", "n_tokens", "spans", "score", "toxicity",
         "fp", "th", "root", "bucket", "line", "pos", "doc", "n_lines", "n_dropped", "whole", "cut", "frame", "hashes")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG_LINE = "This line is long enough to be counted."


def awkward_rows():
    body = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    rows = [(1, None, None, None), (2, "", "en", "b"), (3, " \t\n ", "en", "b"), (4, body, "en", "a"), (5, body, "en", "a"),
            (5, body, "en", "a"), (6, f"{LONG_LINE}\n{LONG_LINE}\nend", "en", "a"), (7, f"x\n  {LONG_LINE.upper()}\t\n", "de", None),
            (8, f"{LONG_LINE}", "fr", "é"), (None, f"{LONG_LINE}\nno id", "es", "a"),
            (9, "word " * 30_000 + "token=abcdefgh12345678", "en", "b"), (10, "naïve 中文 \U0001f600\r\n<|endoftext|> x", "en", "zz"),
            (11, "a" * 5_000, "en", "zz")]
    return [(i, t, g, s, None if t is None else len(t)) for i, t, g, s in rows]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOC).repartition(3).select("*", *[F.lit("clash").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def real(spark, sf_small):
    return documents(spark, sf_small)


@pytest.fixture(scope="module")
def texts(real):
    return {r.doc_id: r.text for r in real.select("doc_id", "text").collect()}


# --- line dedup -------------------------------------------------------------

def brute_lines(rows):
    """By (doc_id, text): lines before, dropped, and the kept text."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    low = lambda d: -(1 << 63) if d is None else d
    holders = collections.defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(low(d))
    hot = {k: max(v) for k, v in holders.items() if len(k) >= 20 and len(v) >= 3}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if hot.get(key(x), low(d)) == low(d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (4, 2), (5, 3)])
def test_line_dedup_awkward(awkward, batches, fanout):
    got = line_dedup.dedup_lines(awkward, batches=batches, fanout=fanout)
    assert got.columns.count("n_lines") == 1 and "keeper" in got.columns
    rows = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()]
    assert sorted(rows, key=repr) == brute_lines([r[:2] for r in awkward_rows()])


def test_line_dedup_keeps_repeats_in_the_keeper(spark):
    rows = [(1, LONG_LINE), (2, f"{LONG_LINE}\nother"), (9, f"{LONG_LINE}\n{LONG_LINE}")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r.n_dropped, r.text) for r in got] == [(1, ""), (1, "other"), (0, f"{LONG_LINE}\n{LONG_LINE}")]


def test_line_runs_are_compacted(spark):
    index = line_dedup.LineRuns(spark, fanout=2)
    for i in range(4):
        index.add(spark.range(10 * i, 10 * i + 15).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("h"), F.lit(4 - i).alias("doc")))
    assert [len(x) for x in index.levels] == [0, 0, 1]
    held = index.levels[2][0]
    assert held.count() == held.select("h").distinct().count() == 45
    assert index.repeated(2).count() == 15
    index.drop()


# --- mixing -----------------------------------------------------------------

def test_mixing_water_fill(spark):
    rows = [("a", 100), ("b", 1000), ("c", 10), (None, 500), ("z", 0)]
    got = {r.source: r for r in mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    # weights by code point, null last: a 3, b 1, c 2, z 3, null 1
    w = {"a": 3, "b": 1, "c": 2, "z": 3, None: 1}
    cap = {s: 2.0 * n for s, n in rows}
    left, aims, budget = set(w), {}, 1610 * 1.5
    while left:
        level = budget / sum(w[s] for s in left)
        over = {s for s in left if w[s] * level > cap[s]}
        if not over:
            aims.update({s: w[s] * level for s in left})
            break
        for s in over:
            aims[s], budget = cap[s], budget - cap[s]
        left -= over
    assert {s: round(r.target, 6) for s, r in got.items()} == {s: round(v, 6) for s, v in aims.items()}
    assert sum(aims.values()) == pytest.approx(1610 * 1.5)


def test_mixing_meets_targets_and_reruns_agree(real):
    first, again = (sorted(map(tuple, mixing.mix(d).select("doc_id", "size", "source", "target", "reps").collect()))
                    for d in (real, real.repartition(7)))
    assert first == again
    taken, most, aim = collections.Counter(), collections.Counter(), {}
    for d, size, source, target, reps in first:
        assert 0 <= reps <= 2
        taken[source] += size * reps
        most[source], aim[source] = max(most[source], size), target
    assert all(abs(taken[s] - aim[s]) <= most[s] for s in aim)


def test_mixing_awkward(awkward):
    rows = mixing.mix(awkward).select("doc_id", F.col("size").alias("words"), "source", "reps").collect()
    assert len(rows) == len(awkward_rows())
    assert {r.doc_id: r.words for r in rows}[1] == 0 and {r.doc_id: r.words for r in rows}[9] == 30_001
    assert mixing.mixture(awkward).columns == awkward.columns


# --- token files ------------------------------------------------------------

def test_token_files_round_trip(spark, awkward):
    folder = scratch_path(spark, "test-tokens")
    token_file.write_tokens(awkward, folder, shards=4)
    t = Tokenizer.from_file(token_file.default_path())
    got = token_file.read_tokens(spark, folder).orderBy("start").collect()
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert [r.doc_id for r in got][-1] is None and [r.doc_id for r in got][:-1] == sorted(x[0] for x in awkward_rows() if x[0])
    expect = sorted((str(d), t.encode(x or "", add_special_tokens=False).ids + [1]) for d, x, *_ in awkward_rows())
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u2").tolist()) for r in got) == expect
    one = token_file.read_one(spark, folder, 10)
    assert one.tolist() == t.encode(awkward_rows()[11][1], add_special_tokens=False).ids + [1]
    assert token_file.read_one(spark, folder, 12345) is None


def test_encoder_equals_the_library():
    t, e = Tokenizer.from_file(token_file.default_path()), token_file.Encoder(token_file.default_path())
    rng = random.Random(8)
    parts = [*"ab  \n\t.!'strevldmIS019ÄßéÑ×÷µ", "e\u0301", "中", "<|endoftext|>", "<|startoftext|>", "\x1c", "\x85", "\U0001f600", "İ", "Σ", "ﬁ", "'LL"]
    cases = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(3_000)] + ["", None, "x" * 2_000]
    ids, n = e.encode(cases)
    expect = [x.ids for x in t.encode_batch([x or "" for x in cases], add_special_tokens=False)]
    assert [ids[b - k:b].tolist() for b, k in zip(np.cumsum(n), n)] == expect


def test_token_file_query(spark, sf_small, texts):
    t = Tokenizer.from_file(token_file.default_path())
    start = 0
    expect = {}
    for d in sorted(texts):
        ids = [*t.encode(texts[d], add_special_tokens=False).ids, 1]
        expect[d] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_file.query(spark, sf_small).collect()} == expect


def test_small_blocks_keep_order(spark, real, monkeypatch):
    monkeypatch.setattr(token_file, "BLOCK_BYTES", 2_000)
    folder = scratch_path(spark, "test-blocks")
    token_file.write_tokens(real, folder, shards=3)
    assert spark.read.parquet(f"{folder}/blocks").count() > 20
    ids = [r.doc_id for r in token_file.read_tokens(spark, folder).orderBy("start", "doc_id").collect()]
    assert ids == sorted(ids) and len(ids) == real.count()


# --- byte-level BPE ---------------------------------------------------------

def test_bpe_equals_the_library():
    t = Tokenizer.from_file(bpe.default_path())
    c = bpe.Codec(bpe.default_path())
    rng = random.Random(3)
    parts = [*"ab  \n\t.!'strevldm019", "é", "ß", "中", "<|endoftext|>", " ", "\x1c", "՘", "\U0001f600", "é", "aaaa"]
    cases = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(3_000)]
    cases += ["", None, "a" * 5_000, "ab" * 3_000 + "!" * 999, " " * 700 + "x", "x" * 513, "".join(rng.choices("etaoin", k=4_000))]
    ids, n = c.encode(cases)
    ends = np.cumsum(n)
    expect = t.encode_batch([x or "" for x in cases], add_special_tokens=False)
    assert [ids[e - k:e].tolist() for e, k in zip(ends, n)] == [e.ids for e in expect]
    assert [x.decode() for x in c.decode(ids, n)] == t.decode_batch([e.ids for e in expect], skip_special_tokens=False)


def test_bpe_decodes_broken_ids_like_the_library():
    t, c = Tokenizer.from_file(bpe.default_path()), bpe.Codec(bpe.default_path())
    rng = np.random.default_rng(5)
    runs = [rng.integers(0, c.size, k) for k in rng.integers(0, 12, 500)]
    got = c.decode(np.concatenate(runs), np.array([len(r) for r in runs]))
    assert [x.decode() for x in got] == t.decode_batch([r.tolist() for r in runs], skip_special_tokens=False)


def test_bpe_one_place_a_round_agrees(monkeypatch):
    a, b = bpe.Codec(bpe.default_path()), bpe.Codec(bpe.default_path())
    b.all_at_once = False
    words = [w.encode() for w in ["banana", "aaaaaaa", "mississippi", "the", "zzzzzzzzzzz", "anbanban"]]
    assert a.merge(words)[0].tolist() == b.merge(words)[0].tolist()


def test_bpe_awkward(awkward):
    coded = bpe.encode(awkward)
    assert coded.columns.count("ids") == 1
    back = bpe.decode(coded)
    assert back.where(F.coalesce("text", F.lit("")) != F.col("decoded")).count() == 0


# --- winnowing --------------------------------------------------------------

def brute_winnow(text, gram, window):
    if not text:
        return []
    gram = min(gram, len(text))
    h = [int(winnow.gram_hashes(np.array([ord(c) for c in text[i:i + gram]], np.uint32), gram)[0]) for i in range(len(text) - gram + 1)]
    window, out = min(window, len(h)), []
    for i in range(len(h) - window + 1):
        low = min(h[i:i + window])
        j = max(x for x in range(i, i + window) if h[x] == low)
        if not out or out[-1] != (low, j):
            out.append((low, j))
    return out


@pytest.mark.parametrize("n", [0, 1, 3, 10, 50, 101, 400])
@pytest.mark.parametrize("letters", ["ab", "abcdé中\U0001f600", "a"])
def test_winnowing_is_exact(n, letters):
    t = "".join(random.Random(n).choices(letters, k=n))
    h, p = winnow.winnow(t, 5, 9)
    assert list(zip(h.tolist(), p.tolist())) == brute_winnow(t, 5, 9)


def test_winnowing_guarantee_over_long_texts():
    rng = random.Random(1)
    t = "".join(rng.choices("abcdefgh", k=150_000))
    shared = t[70_000:70_000 + winnow.GRAM + winnow.WINDOW - 1]
    other = "".join(rng.choices("ijkl", k=500)) + shared + "".join(rng.choices("ijkl", k=500))
    assert set(winnow.winnow(t)[0].tolist()) & set(winnow.winnow(other)[0].tolist())


@pytest.mark.parametrize("n,most", [(60, 0.15), (150, 0.1), (500, 0.05)])
def test_likeness_of_short_texts(n, most):
    rng, off, zero = random.Random(n), [], 0
    for _ in range(200):
        a, b = ("".join(rng.choices("abcdefgh ", k=n)) for _ in range(2))
        e = winnow.edited(a, b)
        got, full = (winnow.likeness(winnow.winnow(a, winnow.GRAM, w)[0], winnow.winnow(e, winnow.GRAM, w)[0]) for w in (winnow.WINDOW, 1))
        off.append(abs(got - full))
        zero += got == 0
    assert np.mean(off) < most and zero < 60


def test_short_shared_passages_are_seen():
    rng = random.Random(4)
    for _ in range(200):
        shared = "".join(rng.choices("abcdefgh", k=32))
        a, b = ("".join(rng.choices(x, k=300)) + shared + "".join(rng.choices(x, k=300)) for x in ("ijkl", "mnop"))
        assert set(winnow.winnow(a)[0].tolist()) & set(winnow.winnow(b)[0].tolist())


def test_against_edits(real, texts, awkward):
    ids = sorted(texts)
    got = {r.doc_id: r for r in winnow.against_edits(real).collect()}
    for i, d in enumerate(ids):
        t, after = texts[d], texts[ids[(i + 1) % len(ids)]]
        e = winnow.edited(t, after)
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        a, b, c = (set(winnow.winnow(x)[0].tolist()) for x in (t, e, after))
        share = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert (r.near_edited, r.near_next) == (share(a, b), share(a, c))
        assert r.fingerprint == winnow.digest(winnow.winnow(t)[0]) and r.positions == winnow.winnow(t)[1].tolist()
        assert r.edited_positions == winnow.winnow(e)[1].tolist() and len(r.edited_fingerprint) == 12 * len(r.edited_positions)
    odd = winnow.against_edits(awkward).collect()
    assert len(odd) == len(awkward_rows())
    five = [r for r in odd if r.doc_id == 5]
    assert five[0].fingerprint == five[1].fingerprint and max(r.near_next for r in five) == 1.0
    assert winnow.fingerprints(awkward).columns.count("hashes") == 1


def test_one_document_is_its_own_next(spark):
    r = winnow.against_edits(spark.createDataFrame([(3, "abcdef")], "doc_id long, text string")).collect()
    assert len(r) == 1 and r[0].edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and r[0].near_next == 1.0


# --- nearest neighbours -----------------------------------------------------

def test_nearest_is_exact_with_ties_and_bad_vectors(spark, monkeypatch):
    rng = np.random.default_rng(2)
    v = np.round(rng.normal(size=(600, 8)), 1)
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += [(600, None), (601, []), (602, [0.0] * 8), (603, [None] * 8), (604, [float("nan")] * 8), (605, [float("inf")] * 8),
             (606, [1.0, 2.0]), (700, [1.0, 2.5]), (None, [1.0] * 8), (5, rows[5][1])]
    monkeypatch.setattr(ann, "LEAST_GROUP", 100)
    monkeypatch.setattr(ann, "TILE", 37)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("dim", F.lit("x"))
    got = collections.defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    x = {i: np.array(v) for i, v in rows[:600]} | {606: np.array([1.0, 2.0]), 700: np.array([1.0, 2.5])}
    expect = {}
    for q in (i for i in x if i % 50 == 0):
        d = sorted((float(np.sqrt(np.cumsum((x[q] - x[c]) ** 2)[-1])), c) for c in x if c != q and len(x[c]) == len(x[q]))[:10]
        expect[q] = [(c, s) for s, c in d]
    assert dict(got) == expect and len(got[700]) == 1


def test_int8_bounds_hold():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 1_500)) * rng.lognormal(size=(200, 1))
    q, s, n, e = ann.quantise(x)
    near = np.sqrt(np.maximum(n[:, None] + n - 2 * ann.products(q, q) * s[:, None] * s, 0))
    true = np.sqrt(((x[:, None] - x) ** 2).sum(axis=2))
    assert (np.abs(near - true) <= e[:, None] + e + ann.SLACK * (np.sqrt(n)[:, None] + np.sqrt(n))).all()


# --- secrets ----------------------------------------------------------------

BASE = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)),
        ("access", re.compile("AKIA[A-Z0-9]+")), ("hex", re.compile("[0-9a-f]+"))]


def brute_secrets(t):
    out = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(BASE) for m in p.finditer(t)
           if (len(m.group(2)) >= 8 if k == "assign" else m.end() - m.start() >= (16 if k == "access" else 32))]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_secret_base_spans():
    rng = random.Random(2)
    parts = ["token", "=", ": ", '"', "secret", "api_key", "abc", "AKIA", "ABCDEF123456", "0123456789abcdef", "deadbeef", " ",
             "%3D", "%", "\\u0041", "ſecret", "K", "é", "\n", "x.y", "password"]
    for _ in range(4_000):
        t = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        base, every = secret_scan.find(t)
        assert secret_scan.joined(base) == brute_secrets(t) and set(base) <= set(every)


SECRET = "token=abcdefgh1234"
B64 = lambda b: base64.b64encode(b).decode()


@pytest.mark.parametrize("hidden", [
    urllib.parse.quote(SECRET), "".join(f"\\u{ord(c):04x}" for c in SECRET), B64(SECRET.encode()), B64(zlib.compress(SECRET.encode())),
    B64(gzip.compress(B64(urllib.parse.quote(SECRET).encode()).encode())), urllib.parse.quote(urllib.parse.quote(SECRET)),
    urllib.parse.quote("".join(f"\\u{ord(c):04x}" for c in SECRET), safe="")])
def test_secret_layers_map_back(hidden):
    t = f"héllo {hidden} bye"
    base, every = secret_scan.find(t)
    assert not base
    (kind, a, b), = every
    assert kind == "assign" and t[a:b] == hidden


GZ = gzip.compress(SECRET.encode(), mtime=0)


@pytest.mark.parametrize("hidden", [
    B64(gzip.compress(GZ)), B64(zlib.compress(GZ)), B64(gzip.compress(zlib.compress(gzip.compress(B64(GZ).encode())))),
    urllib.parse.quote(GZ), urllib.parse.quote_plus(gzip.compress(b"  + " + GZ)), "".join(f"%{b:02x}" for b in GZ),
    "".join(f"\\u{b:04X}" for b in GZ), json.dumps(GZ.decode("latin-1"))[1:-1], urllib.parse.quote(zlib.compress(GZ)),
    B64(urllib.parse.quote(GZ).encode()), urllib.parse.quote(urllib.parse.quote(GZ)),
    B64(b"".join(gzip.compress(SECRET[i:i + 5].encode()) for i in range(0, len(SECRET), 5))),
    B64(gzip.compress(b"first") + bytes(9) + GZ)])
def test_secret_layers_of_bytes(hidden):
    t = f"héllo 100%25 x^ {hidden} bye"
    base, every = secret_scan.find(t)
    assert not base
    (kind, a, b), = every
    assert kind == "assign" and t[a:b] in (hidden, hidden.rstrip("="))


@pytest.mark.parametrize("odd", ["\xa0", "\xad", "\u200b", "\u2028", "\u3000", "\ufeff", "\f", "\0", "\x1b", "\x7f"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress])
def test_secret_layers_with_odd_characters(odd, pack):
    t = f"see {B64(pack(f'{odd}é中 {SECRET}{odd}'.encode()))} bye"
    base, every = secret_scan.find(t)
    assert not base and [k for k, _, _ in every] == ["assign"]
    latin = B64(pack(f"é {SECRET} é".encode("latin-1")))
    assert [k for k, _, _ in secret_scan.find(latin)[1]] == ["assign"]


@pytest.mark.parametrize("pack", [bytes, gzip.compress, lambda b: zlib.compress(gzip.compress(b))])
@pytest.mark.parametrize("prefix", ["https://host.example/r/", "data_", "id-", "/", "a/b/", "abc"])
def test_secret_base64_after_a_prefix(prefix, pack):
    hidden = B64(pack(SECRET.encode() + b"!!!"))
    t = f"see {prefix}{hidden} bye"
    base, every = secret_scan.find(t)
    (kind, a, b), = every
    assert not base and kind == "assign" and a == t.index(hidden) and t[a:b] in (hidden, hidden.rstrip("="), B64(SECRET.encode()))


@pytest.mark.parametrize("width", [5, 64, 76])
@pytest.mark.parametrize("line_end", ["\n", "\r\n", "\n  "])
@pytest.mark.parametrize("head", ["see ", "see:\n", "-----BEGIN X-----\n", "a long word ends\n"])
def test_secret_base64_in_lines(width, line_end, head):
    noise = random.Random(3).randbytes(600).hex().upper()
    for at in (0, 20, 47, 51, 56, 57, 200):
        code = B64(f"{noise[:at]} {SECRET} {noise[at:]}".encode())
        t = head + line_end.join(code[i:i + width] for i in range(0, len(code), width)) + "\nbye"
        spans = secret_scan.find(t)[1]
        assert any(SECRET.encode() in base64.b64decode(code[4 * ((at + 1) // 3):][:28])
                   and re.sub(r"[\r\n ]", "", t[a:b]) in code and len(re.sub(r"[\r\n ]", "", t[a:b])) in (24, 25, 26) for _, a, b in spans)
        code = B64(gzip.compress(f"{noise[:at]} {SECRET} {noise[at:]}".encode()))
        t = head + line_end.join(code[i:i + width] for i in range(0, len(code), width)) + "\nbye"
        assert ("assign", t.index(code[:5]), t.rindex(code.rstrip("=")[-2:]) + 2) in {(k, a, len(t[:b].rstrip("=\n"))) for k, a, b in secret_scan.find(t)[1]}


def test_secret_scan_ends(monkeypatch):
    once = urllib.parse.quote(SECRET)
    for _ in range(12):
        once = B64(once.encode())
    assert secret_scan.find(once)[1][0][0] == "assign"
    monkeypatch.setattr(secret_scan, "MAX_INFLATED", 1_000)
    bomb = B64(zlib.compress(b"a" * 100_000))
    assert secret_scan.find(bomb)[1] == [("oversize", 0, len(bomb.rstrip("=")) + bomb.count("="))]


def test_secret_large_streams_are_scanned_in_pieces(monkeypatch):
    monkeypatch.setattr(secret_scan, "HELD", 4_000)
    for at in (0, 1_990, 3_990, 4_000, 50_000, 99_000):
        for hidden in (SECRET, B64(SECRET.encode()), urllib.parse.quote(GZ)):
            code = B64(zlib.compress(b"! " * (at // 2) + hidden.encode() + b" !" * 50_000))
            assert {k for k, *_ in secret_scan.find(f"x {code}")[1]} == {"assign"}
    inner = gzip.compress(random.Random(1).randbytes(9_000) + SECRET.encode())
    assert {k for k, *_ in secret_scan.find(B64(gzip.compress(inner)))[1]} >= {"oversize"}


def test_secret_scan_awkward(awkward):
    got = {r.doc_id: r for r in secret_scan.summary(awkward).collect()}
    assert got[9].n_assign == 1 and got[1].spans == "" and got[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert secret_scan.with_spans(awkward).where("doc_id = 9").first().spans[0].decoded is False


# --- simhash ----------------------------------------------------------------

def brute_fingerprint(t):
    w = WORD.findall((t or "").translate(FOLD))
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    lab = list(range(len(fps)))
    while True:
        new = [min(lab[j] for j, g in enumerate(fps) if (f ^ g).bit_count() <= 3) for f in fps]
        if new == lab:
            return lab
        lab = new


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_simhash_whole(real, texts):
    ids = sorted(texts)
    fps = [brute_fingerprint(texts[d]) for d in ids]
    lab = brute_components(fps)
    expect = {d: (f, ids[c]) for d, f, c in zip(ids, fps, lab)}
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(real).collect()}
    assert got == expect


@pytest.mark.parametrize("max_entry", [0, 2, 64])
def test_simhash_links_complete(spark, max_entry):
    rng = random.Random(max_entry)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    fps = set(seeds)
    for s in seeds:  # dense balls, chains, and things just out of reach
        for _ in range(60):
            x = s
            for b in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << b
            fps.add(x)
    fps |= {0, (1 << 64) - 1, 1 << 63, 7, 15 << 60}
    fps = sorted(fps, key=signed)
    lab = brute_components(fps)
    df = simhash.stored(spark.createDataFrame([(signed(f),) for f in fps], "fp long"), "test-fps")
    links = simhash.links(df, max_entry=max_entry).collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 3 for r in links)
    root = {r.node: r.root for r in simhash.components(simhash.links(df, max_entry=max_entry)).collect()}
    groups = collections.defaultdict(set)
    for f in fps:
        groups[root.get(signed(f), signed(f))].add(f)
    expect = collections.defaultdict(set)
    for f, c in zip(fps, lab):
        expect[c].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expect.values()))


def test_components_of_a_long_chain(spark):
    n = 300
    order = random.Random(0).sample(range(n), n)
    df = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(df).collect()}
    assert got == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}


def test_simhash_awkward(awkward):
    got = collections.defaultdict(set)
    for r in simhash.near_duplicates(awkward).collect():
        got[r.doc_id].add(r.component_id)
    assert got[1] == got[2] == got[3] == {1} and got[4] == got[5] == {4}
    kept = simhash.keep_one(awkward)
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert kept.columns == awkward.columns and len(ids) == len(set(ids)) and "5" not in ids and "1" in ids and "2" not in ids


# --- classifiers ------------------------------------------------------------

def labelled(n=600, seed=4):
    """Prose with a marked part: a toxic word of each language, junk for quality 0."""
    rng = random.Random(seed)
    marks = {"en": ["idiotic", "moronish"], "de": ["lowfoo", "lowbar", "lowbaz"], "fr": ["vequx", "vequz"], "es": ["chlaa", "chlab"]}
    rows = []
    for i in range(n):
        lang = rng.choice(list(marks))
        w = ["".join(rng.choices("aeioustrn", k=rng.randint(2, 8))) for _ in range(rng.randint(20, 90))]
        toxic, good = int(rng.random() < 0.3), int(rng.random() < 0.7)
        if toxic:
            w.insert(rng.randrange(len(w)), rng.choice(marks[lang]))
            w.append(rng.choice(marks[lang]).capitalize() + ".")
        if not good:
            w = [x + "%%%" for x in w]
        rows.append(SimpleNamespace(doc_id=i, text=" ".join(w), lang=lang, toxic=toxic, quality=good))
    return rows


def sample_of(spark, rows, label):
    """A labelled sample as a table."""
    return spark.createDataFrame([(r.doc_id, r.text, getattr(r, label)) for r in rows], f"doc_id long, text string, {label} int").repartition(3)


def test_toxicity_chain_held_out(spark):
    train, test = labelled(900), labelled(300, 5)
    chain = toxicity.fit_chain(sample_of(spark, train, "toxic"))
    p = chain.predict([r.text for r in test])
    y = np.array([r.toxic for r in test])
    assert ((p[:, -1] >= toxicity.THRESHOLD) == y).mean() >= 0.97
    assert (chain.earlier[np.triu_indices(5)] == 0).all() and chain.earlier[4, :4].any()
    assert chain.predict(["", None]).shape == (2, 5)


def test_chain_of_one_class(spark):
    rows = [SimpleNamespace(doc_id=i, text="a b c", lang=None, toxic=0) for i in range(20)]
    assert toxicity.fit_chain(sample_of(spark, rows, "toxic")).predict(["x"])[0, -1] < 0.1
    assert toxicity.fit_chain(sample_of(spark, [], "toxic")).predict(["x", None]).shape == (2, 5)


def test_quality_held_out(spark):
    train, test = labelled(900), labelled(300, 6)
    m = quality.fit(sample_of(spark, train, "quality"))
    p = m.predict([r.text for r in test])
    assert ((p >= quality.CUT) == np.array([r.quality for r in test])).mean() >= 0.97
    assert ((p >= 0) & (p <= 1)).all() and len(m.predict([None, ""])) == 2
    assert quality.fit(sample_of(spark, [], "quality")).predict(["x"])[0] == pytest.approx(0.5)


def test_long_labelled_texts_are_learned_from(spark):
    """Texts far above any batch's usual size, an empty one and a null one: all but the null one take part in the fits."""
    rng = random.Random(8)
    filler = [" ".join("".join(rng.choices("aeioustrn", k=6)) for _ in range(60_000)) for _ in range(2)]
    rows = [SimpleNamespace(doc_id=i, text=filler[i % 2] + (" zzmarkzz" if i % 4 < 2 else " qqplainqq"), toxic=int(i % 4 < 2)) for i in range(40)]
    rows += [SimpleNamespace(doc_id=90, text="", toxic=0), SimpleNamespace(doc_id=91, text=None, toxic=1)]
    assert len(rows[0].text) > 400_000
    labels = spark.createDataFrame([(r.doc_id, r.toxic) for r in rows], "doc_id long, toxic int")
    docs = spark.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id long, text string")
    sample = linear.labelled_sample(docs, labels, F.lit(True), ["toxic"])
    assert sorted(r.doc_id for r in sample.select("doc_id").collect()) == [*range(40), 90]
    bucket, marked, texts = linear.gram_counts(sample, toxicity.words, F.col("toxic") == 1, 3)
    plain = [set(linear.word_grams(list(set(r.text.split())))[0].tolist()) for r in rows[:40]]
    n = collections.Counter(b for s in plain for b in s)
    n1 = collections.Counter(b for s, r in zip(plain, rows) if r.toxic for b in s)
    want = sorted((b, n1[b], k) for b, k in n.items() if k >= 3)
    assert list(zip(bucket.tolist(), marked.tolist(), texts.tolist())) == want
    p = toxicity.fit_chain(sample).predict(["zzmarkzz", "qqplainqq"])[:, -1]
    assert p[0] > p[1]


def test_quality_keeps_its_features():
    assert quality.FEATURES == 60_000


def test_dual_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 4))
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=60) > 0, 1.0, -1.0)
    w, b = quality.dual_descent([(np.arange(4), v) for v in x], y, 4, epochs=400)
    loss = lambda w, b: 0.5 * (w @ w + b * b) + np.maximum(0, 1 - y * (x @ w + b)).sum()
    best = loss(w, b)
    assert all(loss(w + 0.05 * rng.normal(size=4), b + 0.05 * rng.normal()) >= best - 1e-6 for _ in range(300))


def test_runs():
    assert quality.runs(np.array([1, 2, 3])) == [] and quality.runs(np.array([], int)) == []
    assert quality.runs(np.array([1, 1, 1])) == [0, len(quality.MET_RUNS), len(quality.MET_RUNS) + 1]


def test_classifiers_on_tables(spark, awkward):
    rows = labelled(200)
    docs = spark.createDataFrame([(r.doc_id, r.text, r.lang) for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r.doc_id, r.quality, r.toxic) for r in rows] + [(None, 1, 0), (3, None, None)],
                                   "doc_id long, quality int, toxic int")
    scored = toxicity.score(awkward, toxicity.train(docs, labels))
    assert scored.count() == len(awkward_rows()) and scored.columns.count("toxicity") == 1
    assert scored.where("toxicity between 0 and 1").count() == len(awkward_rows())
    graded = quality.score(awkward, quality.train(docs, labels))
    assert graded.where("score between 0 and 1").count() == len(awkward_rows())
    clean = toxicity.keep_clean(docs, labels)
    assert clean.columns == docs.columns and 100 < clean.count() < 200


def test_labelled_sample_does_not_depend_on_the_order_of_rows(spark):
    docs = [(i, f"text {j} of {i}", "en") for i in range(50) for j in range(1 + i % 3)]
    labels = [(i, t) for i in range(60) for t in ((0, 1) if i % 5 == 0 else (i % 2,))] + [(None, 1)]
    seen = []
    for seed in (1, 2):
        random.Random(seed).shuffle(docs)
        random.Random(seed).shuffle(labels)
        d = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3).withColumn("toxic", F.lit(9))
        rows = linear.labelled_sample(d, spark.createDataFrame(labels, "doc_id long, toxic int"), F.col("toxic").isNotNull(), ["lang", "toxic"])
        seen.append(sorted(tuple(r) for r in rows.collect()))
    assert seen[0] == seen[1] == [(i, f"text 0 of {i}", "en", 1 if i % 5 == 0 else i % 2) for i in range(50)]
    few = linear.labelled_sample(d, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True), ["lang", "toxic"], 20)
    assert 5 < few.count() < 40


def test_quality_query_learns_from_the_rest(spark, sf_small):
    got = quality.query(spark, sf_small).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in got)


def test_logistic_gradient():
    rng = np.random.default_rng(0)
    doc, feature = np.nonzero(rng.random((80, 6)) < 0.4)
    x = linear.Rows(doc, feature, 80, 6)
    y = (rng.random(80) < 0.5).astype(float)
    w = linear.fit_logistic(x, rng.normal(size=(80, 1)), y, ridge=0.5, steps=300)
    assert np.isfinite(w).all()
    z = linear.fit_logistic(x, np.zeros((80, 0)), y, ridge=0.5, steps=300)
    r = linear.sigmoid(x.dot(z[:6]) + z[-1]) - y
    assert np.abs(x.back(r) + 0.5 * z[:6]).max() < 0.05 and abs(r.sum()) < 0.05


# --- shared -----------------------------------------------------------------

def test_id_buckets(spark):
    df = spark.createDataFrame([(i,) for i in [5, 1, 9, 9, 30, -4, None]], "doc_id long")
    edges = [1, 6, 9]
    got = {r.doc_id: r.b for r in df.select("doc_id", id_bucket(F.col("doc_id"), edges).alias("b")).collect()}
    assert got == {-4: 0, 1: 1, 5: 1, 9: 3, 30: 3, None: 3}
    assert id_edges(df, 1) == [] and id_edges(df.limit(0), 4) == []


def test_empty_tables(spark, empty):
    assert line_dedup.dedup_lines(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    folder = scratch_path(spark, "test-empty")
    token_file.write_tokens(empty, folder)
    assert token_file.read_tokens(spark, folder).count() == 0
    assert bpe.round_trip(empty).count() == 0 and bpe.decode(bpe.encode(empty)).count() == 0
    assert winnow.against_edits(empty).count() == 0 and winnow.fingerprints(empty).count() == 0
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 100 == 0).count() == 0
    assert secret_scan.summary(empty).count() == 0 and secret_scan.with_spans(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.score(empty, quality.train(empty, labels)).count() == 0
    assert toxicity.keep_clean(empty, labels).count() == 0


def test_contract_columns(spark, sf_small):
    want = {"op1_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            "op2_source_mixing": ["doc_id", "size", "source_size", "target", "taken"],
            "op3_token_file": ["doc_id", "start", "n_tokens", "ids_crc32"],
            "op4_winnowing": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
                               "positions", "edited_positions"],
            "op5_quality_nbsvm": ["doc_id", "held_out", "score", "predicted"],
            "op6_nearest_neighbours": ["query_id", "rank", "vec_id", "score"],
            "op7_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            "op8_bpe_round_trip": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            "op9_toxicity_chain": ["doc_id", "score", "predicted"], "op10_simhash_near_dedup": ["doc_id", "fingerprint", "component_id"],
            "op11_fill_in_middle": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
            "op12_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            "op13_hard_negatives": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]}
    assert set(queries.QUERIES) == set(want)
    for name, columns in want.items():
        assert queries.QUERIES[name](spark, sf_small).columns[:len(columns)] == columns


# --- pipeline ---------------------------------------------------------------

@pytest.fixture(scope="module")
def stage_dir(spark, tmp_path_factory):
    """A folder with labels only: the stages get their documents as a frame."""
    d = tmp_path_factory.mktemp("stages")
    rows = labelled(200)
    spark.createDataFrame([(r.doc_id, r.quality, r.toxic) for r in rows], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(r.doc_id, r.text, r.lang, f"s{r.doc_id % 3}", len(r.text)) for r in rows], DOC).write.parquet(f"{d}/documents.parquet")
    return str(d)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_awkward_and_empty(spark, awkward, empty, stage_dir, name, stage):
    last = name == corpus_pipeline.STAGES[-1][0]
    for docs in (awkward, empty):
        out = stage(spark, docs, stage_dir)
        rows = out.collect()
        assert last or out.columns == docs.columns
        assert bool(rows) == (docs is awkward)


def test_pipeline_against_a_plain_version(spark, stage_dir):
    docs = {r.doc_id: r for r in documents(spark, stage_dir).collect()}
    labels = toxicity.labels_of(spark, stage_dir)
    chain = toxicity.train(documents(spark, stage_dir), labels)
    ids = sorted(docs)
    p = chain.predict([docs[i].text for i in ids])[:, -1]
    ids = [i for i, x in zip(ids, p) if x < toxicity.THRESHOLD]
    text = {d: t for d, _, _, t in brute_lines([(i, docs[i].text) for i in ids])}
    fps = [brute_fingerprint(text[i]) for i in ids]
    ids = [i for k, (i, c) in enumerate(zip(ids, brute_components(fps))) if c == k]
    size = {i: len(WORD.findall(text[i])) for i in ids}
    rows = corpus_pipeline.run(spark, stage_dir).collect()
    t = Tokenizer.from_file(bpe.default_path())
    taken = collections.Counter(r.doc_id for r in rows)
    assert set(taken) <= set(ids) and max(taken.values()) <= 2
    total = sum(size.values())
    assert abs(sum(size[i] * k for i, k in taken.items()) - 1.5 * total) <= 3 * max(size.values())
    for r in rows:
        assert r.ids == t.encode(text[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
