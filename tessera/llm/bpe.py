"""Byte-level BPE encoding and decoding with batched numpy merge rounds.

The symbols of many distinct words lie in one flat array. A round finds every
neighbouring pair's rank by binary search over the sorted pair keys, takes each
word's lowest rank, and merges all its places from the left at once; words without a
mergeable pair leave the array. Merging all places of the lowest pair in one
round equals merging them one by one when no merge has a lower rank than the one
that makes its parts, which is checked when the table is read (otherwise one
place a round is merged). Very long words use the same rule with a heap.

Edge cases: a null or empty text has no ids and decodes to the empty text. The
vocabulary's special tokens, met in a text, become their ids, as the library
does. Repeated rows are encoded alike; other columns pass through (``ids``,
``n_tokens`` and ``decoded`` are replaced). An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.chunks import Memo, Ragged, per_text, resident, spread
from tessera.llm.common import arrow_map, documents

VOCABULARY = "byte_bpe_50k.json"
#: Words of more bytes than this are merged with a heap.
LONG_WORD = 512
NONE = np.int64(1 << 40)
# Unicode white space, which the splitting pattern treats specially
_SPACES = "\t-\r \x85\xa0  -     　"
_DOUBLE = regex.compile(f"[{_SPACES}]{{2}}")
_CHUNKS = regex.compile(f"[{_SPACES}]*[^{_SPACES}]+|[{_SPACES}]+")
#: Below this code point the ``regex`` library and the tokenizers library class letters and digits alike.
_SURE = regex.compile("[^\x00-ԯ]")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def _pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in out:
            out[b], spare = chr(spare), spare + 1
    return [out[b] for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        symbols = byte_symbols()
        to_byte = {c: b for b, c in enumerate(symbols)}
        self.size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.of_byte = np.array([vocab[c] for c in symbols], np.int64)
        left, right, made = (np.array(x, np.int64) for x in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in pairs)))
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        first = np.full(self.size, -1, np.int64)
        for r in range(len(made) - 1, -1, -1):
            first[made[r]] = r
        self.all_at_once = bool((np.maximum(first[left], first[right]) < np.arange(len(made))).all())
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.splits = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pattern = regex.compile(_pattern())
        self.path = path
        text = [b""] * self.size
        for token, i in vocab.items():
            text[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        for token, i in self.special.items():
            text[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        self.token_bytes = np.frombuffer(b"".join(text), np.uint8)
        self.token_len = np.array([len(t) for t in text], np.int64)
        self.token_at = np.concatenate(([0], np.cumsum(self.token_len)[:-1]))
        self.memo = Memo(self._chunks)

    @functools.cached_property
    def _pre(self):
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.path).pre_tokenizer

    def words(self, chunk: str) -> list[str]:
        """The pieces inside which merges take place."""
        if _SURE.search(chunk):
            return [chunk[a:b] for _, (a, b) in self._pre.pre_tokenize_str(chunk)]
        return self.pattern.findall(chunk)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every word (none empty) one after another, and how many each has."""
        lengths = np.array([len(w) for w in words], np.int64)
        sym = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        long = np.flatnonzero(lengths > LONG_WORD)
        done_sym, done_word = [], []
        for w in long:
            ids = self._merge_long(sym[word == w].tolist())
            done_sym.append(np.array(ids, np.int64))
            done_word.append(np.full(len(ids), w))
        if len(long):
            short = lengths[word] <= LONG_WORD
            sym, word = sym[short], word[short]
        rank = np.full(len(sym), NONE)
        if len(sym):
            same = word[:-1] == word[1:]
            rank[:-1][same] = self.rank(sym[:-1][same], sym[1:][same])
        while len(sym):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            low = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.concatenate((starts, [len(sym)])))
            if not (low < NONE).all():
                over = np.repeat(low == NONE, sizes)
                done_sym.append(sym[over])
                done_word.append(word[over])
                sym, word, rank = sym[~over], word[~over], rank[~over]
                sizes, low = sizes[low < NONE], low[low < NONE]
                if not len(sym):
                    break
            hit = rank == np.repeat(low, sizes)
            at = np.flatnonzero(hit)
            if self.all_at_once:
                # places that follow one another overlap: every second of such a run stays out
                head = np.concatenate(([True], np.diff(at) > 1))
                run = np.cumsum(head) - 1
                at = at[(at - at[head][run]) % 2 == 0]
            else:
                at = at[np.concatenate(([True], word[at[1:]] != word[at[:-1]]))]
            sym[at] = self.made[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            sym, word, rank = sym[keep], word[keep], rank[keep]
            at = moved[at]
            # only the pairs beside a merged symbol have new ranks
            near = np.unique(np.concatenate((at, at[at > 0] - 1)))
            last = near == len(sym) - 1
            rank[near[last]] = NONE
            near = near[~last]
            same = word[near] == word[near + 1]
            rank[near[~same]] = NONE
            near = near[same]
            rank[near] = self.rank(sym[near], sym[near + 1])
        sym, word = np.concatenate([*done_sym, sym]), np.concatenate([*done_word, word])
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=len(words))

    def _merge_long(self, sym: list[int]) -> list[int]:
        n = len(sym)
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        table = self._table
        heap = [(r, i, sym[i], sym[i + 1]) for i in range(n - 1) if (r := table.get((sym[i], sym[i + 1]))) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i] if alive[i] else n
            if j >= n or sym[i] != a or sym[j] != b:
                continue
            sym[i], alive[j], nxt[i] = int(self.made[r]), False, nxt[j]
            if nxt[j] < n:
                prev[nxt[j]] = i
            for x, y in ((prev[i], i), (i, nxt[i])):
                if x >= 0 and y < n and (q := table.get((sym[x], sym[y]))) is not None:
                    heapq.heappush(heap, (q, x, sym[x], sym[y]))
        return [s for s, a in zip(sym, alive) if a]

    @functools.cached_property
    def _table(self) -> dict[tuple[int, int], int]:
        return {(int(k) // self.size, int(k) % self.size): int(r) for k, r in zip(self.keys, self.ranks)}

    def _chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new chunks: split into words, special tokens apart, the distinct words merged together."""
        seen: dict[str, int] = {}
        rows, counts = [], []
        for c in chunks:
            if self.splits and (len(parts := self.splits.split(c)) > 1):
                w = [x for i, p in enumerate(parts) for x in ([-1 - self.special[p]] if i % 2 else self.words(p) if p else [])]
            else:
                w = self.words(c) if c else []
            rows.extend(x if isinstance(x, int) else seen.setdefault(x, len(seen)) for x in w)
            counts.append(len(w))
        words = Ragged()
        if seen:
            words.extend(*self.merge([w.encode() for w in seen]))
        n = words.n
        specials = sorted(self.special.values())
        words.extend(np.array(specials, np.int32), np.ones(len(specials), np.int64))
        place = {-1 - s: n + i for i, s in enumerate(specials)}
        flat, lengths = words.take(np.array([place[r] if r < 0 else r for r in rows], np.int64))
        return flat, per_text(lengths, np.array(counts, np.int64))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        chunks, counts = [], []
        for t in texts:
            if not t:
                parts = []
            elif _DOUBLE.search(t):
                parts = _CHUNKS.findall(t)
            else:
                parts = t.split(" ")
                parts[1:] = [" " + p for p in parts[1:]]
            chunks += parts
            counts.append(len(parts))
        rows = np.array(list(map(self.memo.__getitem__, chunks)), np.int64)
        self.memo.learn()
        flat, lengths = self.memo.ids.take(rows)
        self.memo.forget()
        return flat, per_text(lengths, np.array(counts, np.int64))

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """UTF-8 of every text; what is no valid UTF-8 becomes the replacement character."""
        sizes = self.token_len[ids]
        flat = self.token_bytes[spread(self.token_at[ids], sizes)].tobytes()
        ends = np.cumsum(per_text(sizes, lengths)).tolist()
        out, a = [], 0
        for b in ends:
            raw, a = flat[a:b], b
            try:
                raw.decode()
            except UnicodeDecodeError:
                raw = raw.decode(errors="replace").encode()
            out.append(raw)
        return out


def codec(path: str) -> Codec:
    """The codec of a file, kept by this process with its memory of chunks."""
    return resident(lambda held: isinstance(held, Codec) and held.path == path, lambda: Codec(path))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``n_tokens``."""
    path = path or default_path()
    docs = docs.drop("ids", "n_tokens")
    at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_tokens", T.LongType())])

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        ids, n = codec(path).encode(b.column(at).to_pylist())
        offsets = pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [*b.columns, pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())), pa.array(n, pa.int64())],
            [*b.schema.names, "ids", "n_tokens"])

    return arrow_map(docs, run, schema)


def decode(coded: DataFrame, path: str | None = None) -> DataFrame:
    """``coded`` with ``decoded``, the text of its ``ids`` (null ids: the empty text)."""
    path = path or default_path()
    coded = coded.drop("decoded")
    at = coded.columns.index("ids")
    schema = T.StructType([*coded.schema.fields, T.StructField("decoded", T.StringType())])

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        ids = [x or [] for x in b.column(at).to_pylist()]
        n = np.array([len(x) for x in ids], np.int64)
        flat = np.array([i for x in ids for i in x], np.int64)
        text = [x.decode() for x in codec(path).decode(flat, n)]
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string())], [*b.schema.names, "decoded"])

    return arrow_map(coded, run, schema)


def round_trip(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: both ways in one pass; ``ids`` leave the task only if asked for."""
    path = path or default_path()

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(path)
        ids, n = c.encode(b.column(1).to_pylist())
        raw = ids.astype("<u4").tobytes()
        ends = np.concatenate(([0], np.cumsum(n)))
        cuts = (ends * 4).tolist()
        out = {"doc_id": b.column(0), "n_tokens": pa.array(n, pa.int64()),
               "ids_sha256": pa.array([hashlib.sha256(raw[i:j]).hexdigest() for i, j in zip(cuts, cuts[1:])]),
               "decoded_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in c.decode(ids, n)])}
        if with_ids:
            out["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
        return pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run,
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


def query(spark, sf_dir):
    return round_trip(documents(spark, sf_dir))
