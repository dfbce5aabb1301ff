"""Fill-in-the-middle, packing and hard negatives against brute force, and on awkward tables."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import fim, hard_negatives, packing
from tessera.llm.common import documents
from tessera.llm.token_file import default_path
from test_corpus_operators import DOC, awkward_rows

CLASH = ("form", "Output", "restored", "n_tokens", "prefix_chars", "ids", "start", "length", "dim", "part", "asks", "q", "key", "same", "v")


@pytest.fixture(scope="module")
def awkward(spark):
    rows = awkward_rows() + [(12, "<P>", "en", "a", 3), (13, "no <S> in here", "en", "a", 14), (14, "a <", "en", "a", 3)]
    return spark.createDataFrame(rows, DOC).repartition(3).select("*", *[F.lit("clash").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


# --- fill in the middle -----------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute_form(doc_id, text, rate=50):
    t = text or ""
    units = UNIT.findall(t)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return "plain", len(units), None, None, t
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 80 else f"<P>{p}<S>{s}<M>{m}"
    return "spm" if h[3] % 100 < 80 else "psm", len(units), len(p), len(m), out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \t\n\x0b\x0c\r\x1c\x85 abé中\U0001f600<PSM>", max_size=60), st.integers(-5, 2_000), st.integers(1, 9))
def test_forms_equal_brute_force_and_invert(text, doc_id, swap):
    raw, fim.SWAP = text.encode(), swap
    try:
        form, n, first, second = fim.plan(raw, doc_id, 42, 100, 80)
        out = fim.transform(raw, form, first, second)
        assert (form, n, out.decode()) == tuple(np.array(brute_form(doc_id, text, 100), object)[[0, 1, 4]])
        assert fim.invert(out, form) == raw
    finally:
        fim.SWAP = 1 << 16


@pytest.mark.parametrize("n", [0, 1, 2, 5, 63, 64, 65, 1_000])
def test_rotation_in_place(n, monkeypatch):
    monkeypatch.setattr(fim, "SWAP", 16)
    raw = bytes(random.Random(n).randrange(256) for _ in range(n))
    for a, m, b in [(0, n // 3, n), (n // 4, n // 2, n), (0, 0, n), (0, n, n), (n // 5, n // 4, n // 2)]:
        buf = bytearray(raw)
        fim.rotate(buf, a, m, b)
        assert buf == raw[:a] + raw[m:b] + raw[a:m] + raw[b:]
        fim.rotate(buf, a, a + b - m, b)
        assert buf == raw


def test_fim_awkward(awkward):
    out = fim.restore(fim.fill_in_middle(awkward))
    assert out.columns.count("form") == 1 and out.columns.count("output") == 1 and "Output" not in out.columns
    assert dict(out.dtypes)["n_tokens"] == "bigint" and dict(out.dtypes)["start"] == "string"
    rows = out.collect()
    assert len(rows) == len(awkward_rows()) + 3
    for r in rows:
        assert (r.form, r.n_tokens, r.prefix_chars, r.middle_chars, r.output) == brute_form(r.doc_id, r.text)
        assert r.restored == (r.text or "")
    assert {r.form for r in rows if r.doc_id in (1, 2, 12, 13)} == {"plain"}
    half = fim.fill_in_middle(awkward, rate=100).where("form <> 'plain'").count()
    assert half == len(awkward_rows()) + 1 - 2  # all but the empty texts and those with a sentinel


def test_fim_query(spark, sf_small):
    texts = {r.doc_id: r.text for r in documents(spark, sf_small).collect()}
    rows = fim.query(spark, sf_small).collect()
    assert {r.doc_id for r in rows} == set(texts) and {r.form for r in rows} == {"plain", "spm", "psm"}
    for r in rows:
        form, n, p, m, out = brute_form(r.doc_id, texts[r.doc_id])
        assert (r.form, r.n, r.prefix_chars, r.middle_chars) == (form, n, p, m)
        assert r.output_sha256 == hashlib.sha256(out.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# --- packing ----------------------------------------------------------------

def brute_levels(sizes, window):
    """Fill levels of the open windows after every placement, each by trying all of them."""
    open_ = collections.Counter()
    for s in sizes:
        def after(h):
            c = open_.copy()
            if h:
                c[h] -= 1
            if h + s < window:
                c[h + s] += 1
            return sum(x * x for x in c.values())
        choices = [h for h in open_ if open_[h] > 0 and h + s <= window] + [0]
        at = min(choices, key=lambda h: (after(h), -h))
        if at:
            open_[at] -= 1
        if at + s < window:
            open_[at + s] += 1
        yield +open_


@pytest.mark.parametrize("window,most", [(8, 7), (32, 31), (64, 20)])
def test_sum_of_squares_rule(window, most):
    rng, levels = random.Random(window), packing.Levels(window)
    sizes = [rng.randint(1, most) for _ in range(400)]
    for s, want in zip(sizes, brute_levels(sizes, window)):
        levels.place(packing.Piece(0, 0, np.zeros(s, np.uint32), s))
        assert {h: int(n) for h, n in enumerate(levels.count) if n} == dict(want)
        assert levels.held == sum(h * n for h, n in want.items())
        assert all(len(levels.open[h]) == n and all(sum(len(p.ids) for p in w) == h for w in levels.open[h]) for h, n in want.items())


def whole(sequences, docs, window):
    """Every id of every document lies in one piece; every sequence is full or a power of two."""
    got = collections.defaultdict(list)
    for seq in sequences:
        n = sum(len(p.ids) for p in seq)
        assert n == window or (n < window and n.bit_count() == 1) and all(len(p.ids) for p in seq)
        for p in seq:
            got[p.doc_id].append(p)
    for d, ids in docs:
        pieces = sorted(got.pop(d, []), key=lambda p: p.start)
        assert np.array_equal(np.concatenate([p.ids for p in pieces] or [np.zeros(0)]), ids)
        assert [p.start for p in pieces] == np.cumsum([0] + [len(p.ids) for p in pieces])[:-1].tolist()
        assert all(p.total == len(ids) for p in pieces)
    assert not got


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 150), max_size=40), st.sampled_from([32, 64]), st.sampled_from([0, 100, 10_000]))
def test_nothing_is_lost_or_padded(sizes, window, held):
    at = np.cumsum([0, *sizes])
    docs = [(i, np.arange(a, b, dtype=np.uint32)) for i, (a, b) in enumerate(zip(at, at[1:]))]
    whole(list(packing.packed(iter(docs), window, held)), docs, window)


def test_few_documents_are_cut():
    rng = random.Random(1)
    docs = [(i, np.zeros(max(1, int(rng.lognormvariate(6, 1))), np.uint32)) for i in range(5_000)]
    pieces = [p for s in packing.packed(iter(docs), 4096, packing.HELD) for p in s]
    needed = sum(-(-len(ids) // 4096) for _, ids in docs)
    assert len(pieces) - needed < 0.05 * len(docs)


def check_pieces(rows, encoded):
    """``rows`` hold each document (a multiset of id lists by doc_id) once, in gapless sequences."""
    sequences = collections.defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) // 4
        sequences[r.sequence_id].append(r)
    for s in sequences.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == np.cumsum([0] + [r.length for r in s])[:-1].tolist()
        n = sum(r.length for r in s)
        assert n <= 4096 and (n == 4096 or n.bit_count() == 1)
    found = collections.Counter()
    by_doc = collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for d, parts in by_doc.items():
        kinds = {len(ids) for ids in encoded[d]}
        assert {r.doc_tokens for r in parts} == kinds and sum(r.length for r in parts) == sum(map(len, encoded[d]))
        want = b"".join(sorted(np.array(ids, "<u4").tobytes() for ids in encoded[d]))
        if len(encoded[d]) == 1:
            assert b"".join(r.ids for r in sorted(parts, key=lambda r: r.start)) == want
        found[d] += 1
    assert set(found) == set(encoded)


def encode(texts):
    t = Tokenizer.from_file(default_path())
    t.no_truncation()
    t.no_padding()
    return [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]


def test_packing_awkward(awkward):
    rows = awkward_rows() + [(12, "<P>", "en", "a", 3), (13, "no <S> in here", "en", "a", 14), (14, "a <", "en", "a", 3)]
    encoded = collections.defaultdict(list)
    for (d, *_), ids in zip(rows, encode([r[1] for r in rows])):
        encoded[d].append(ids)
    out = packing.pack(awkward)
    assert out.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    check_pieces(out.collect(), encoded)
    check_pieces(packing.pack(awkward, held=0).collect(), encoded)


def test_sequences_hold_their_pieces(spark, sf_small):
    pieces = packing.pack(documents(spark, sf_small)).cache()
    rows = pieces.collect()
    parts = collections.defaultdict(dict)
    for r in rows:
        parts[r.sequence_id][r.offset] = bytes(r.ids)
    for r in packing.sequences(pieces).collect():
        assert bytes(r.ids) == b"".join(parts[r.sequence_id][o] for o in sorted(parts[r.sequence_id]))
        assert r.n_tokens == len(r.ids) // 4 and r.n_padding == 0
    pieces.unpersist()


def test_packing_query(spark, sf_small):
    texts = {r.doc_id: r.text for r in documents(spark, sf_small).collect()}
    encoded = dict(zip(texts, encode(texts.values())))
    rows = packing.query(spark, sf_small).collect()
    assert sum(r.length for r in rows) == sum(map(len, encoded.values()))
    for r in rows:
        ids = encoded[r.doc_id]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())


# --- hard negatives ---------------------------------------------------------

def brute_negatives(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    """``rows``: (id, label, vector) without unusable ones."""
    out = []
    best = {}
    for i, label, v in rows:
        if i not in best or (v, label) < best[i]:
            best[i] = (v, label)
    whole = [(i, label, [int(np.floor(np.float64(x) * 256)) for x in v]) for i, (v, label) in best.items()]
    for a, la, va in whole:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, label, v in whole if i != a and len(v) == len(va))
        for ps, p, _ in [s for s in scored if s[2] == la][:positives]:
            window = [s for s in scored if s[2] != la and low * -ps <= 100 * -s[0] <= high * -ps][:negatives]
            out += [(a, p, rank, n, -ps, -ns) for rank, (ns, n, _) in enumerate(window, 1)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int"


def mined(df, **kw):
    out = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()))


def planted(n, dims, seed, labels=3, step=0.25):
    """Coarse components, so that ties, zeros and negative scores are common."""
    rng = random.Random(seed)
    return [(i - 40, [float(np.float32(rng.randint(-4, 4) * step)) for _ in range(dims)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("tile,group,low,high", [(8_192, 4_096, 30, 90), (7, 16, 30, 90), (16, 50, 0, 100), (5, 9, 50, 50)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, tile, group, low, high):
    monkeypatch.setattr(hard_negatives, "LEAST_GROUP", group)
    monkeypatch.setattr(hard_negatives, "GROUP_BYTES", group * 8 * 4)
    rows = planted(400, 4, tile)
    want = brute_negatives([(i, label, v) for i, v, label in rows], lambda i: i % 10 == 0, low=low, high=high)
    assert want
    monkeypatch.setattr(hard_negatives, "TILE", tile)
    assert mined(spark.createDataFrame(rows, VECTORS).repartition(5), low=low, high=high) == want


def test_small_tiles_lose_nothing():
    rows = planted(300, 3, 9, labels=2)
    ids = np.array([r[0] for r in rows])
    x, labels = hard_negatives.integers(np.array([r[1] for r in rows]), 256), np.array([r[2] for r in rows])
    asks = ids % 10 == 0
    want = brute_negatives([(i, label, v) for i, v, label in rows], lambda i: i % 10 == 0)
    for size in (1, 4, 33, 300):
        tile = hard_negatives.Tile(ids[asks], labels[asks], x[asks], 5, 10, 30, 90)
        pairs = [(bytes(k), False) for t in range(0, 300, size)
                 for keys in tile.negatives_of(ids[t:t + size], labels[t:t + size], x[t:t + size]) for k in keys.view("V24").ravel()]
        pairs += [(bytes(k), True) for keys in tile.positive_keys() for k in keys.view("V24").ravel()]
        assert sorted(hard_negatives.walk(sorted(pairs), 5, 10, 30, 90)) == want


def test_hard_negatives_awkward(spark):
    good = planted(60, 3, 2) + [(10, [0.0, 0.0, 0.0], 1), (70, [1.0, 2.0], 1), (71, [1.0, 2.5], 1), (72, [0.5, 1.0], 2), (80, [], 1), (81, [], 2)]
    good += [(-40, [9.0, 9.0, 9.0], 0), (-40, [-9.0, 1.0, 1.0], 2), (0, good[40][1], 2)]
    bad = [(None, [1.0, 1.0, 1.0], 1), (90, None, 1), (100, [1.0, None, 1.0], 0), (110, [1.0, float("nan"), 1.0], 0),
           (120, [float("inf"), 1.0, 1.0], 0), (130, [1.0, 1.0, 1.0], None)]
    df = spark.createDataFrame(good + bad, VECTORS).repartition(4).select("*", *[F.lit("clash").alias(c) for c in CLASH])
    want = brute_negatives([(i, label, v) for i, v, label in good], lambda i: i % 10 == 0)
    assert mined(df) == want
    assert mined(spark.createDataFrame([], VECTORS)) == []
    with pytest.raises(ValueError):
        mined(df, low=90, high=30)


def test_wide_scores_stay_exact():
    a, b = np.array([[float(1 << 30), 3.0]]), np.array([[float(1 << 30), 1.0], [-1.0, float(1 << 29)]])
    assert hard_negatives.scores(a, b).tolist() == [[(1 << 60) + 3, 3 * (1 << 29) - (1 << 30)]]
    with pytest.raises(OverflowError):
        hard_negatives.scores(a * 64, b * 64)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(*[st.integers(-(1 << 63), (1 << 63) - 1)] * 3), min_size=1, max_size=20))
def test_keys_sort_by_anchor_descending_score_and_id(rows):
    packed = [bytes(k) for k in hard_negatives.pack_keys(*(np.array(c, np.int64) for c in zip(*rows))).view("V24").ravel()]
    assert [hard_negatives.unpack_key(k) for k in packed] == rows
    assert [hard_negatives.unpack_key(k) for k in sorted(packed)] == sorted(rows, key=lambda r: (r[0], -r[1], r[2]))


def test_empty_tables(spark, empty):
    assert fim.restore(fim.fill_in_middle(empty)).count() == 0
    assert packing.pack(empty).count() == 0 and packing.sequences(packing.pack(empty)).count() == 0


def test_memory_keeps_what_is_met_again_and_stays_bounded():
    import numpy as np

    from tessera.llm.chunks import Memo

    asked = []
    memo = Memo(lambda new: (asked.extend(new), np.array([len(c) for c in new], np.int32), np.ones(len(new), np.int64))[1:])
    for i in range(50):
        chunks = ["often", "too", *[f"once{i}-{j}" + "x" * (i + j) for j in range(20)]]
        rows = np.fromiter(map(memo.__getitem__, chunks), np.int64, len(chunks))
        memo.learn()
        assert memo.ids.take(rows)[0].tolist() == [len(c) for c in chunks]
        memo.forget(100)
        assert len(memo) <= 100
    assert asked.count("often") == asked.count("too") == 1
