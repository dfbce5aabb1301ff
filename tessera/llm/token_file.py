"""Token ids in files: a shared zstandard dictionary, one compressed frame per document.

Layout of a token folder, which any store Spark reads can hold (Parquet, so writes are
committed by Spark and survive lost executors):

* ``dictionary``: one row ``(dict_hash, width, dictionary)``; the dictionary is trained on the
  serialized ids of a bounded sample of documents, and ``width`` is the bytes of a serialized id.
* ``blocks``: rows of about ``BLOCK_BYTES`` in ascending document order, each
  ``(shard, block, start, dict_hash, doc_ids, tokens, offsets, payload)``: ``payload`` is the
  frames one after another, ``offsets`` where each begins (and the end), ``tokens`` the ids of each,
  ``start`` the ids of the shard before the block. A single document is read by its block's
  index and one short frame.

Shards are ranges of ``doc_id``; only frames are shuffled into them, never texts.

Edge cases: a null or empty text is the end id alone. Documents without an id come last. Rows
with equal ids stay apart, in the order of their frames. Other columns are not stored. With an empty table, or too
few samples to train on, the dictionary is empty and frames are plain.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.bpe import byte_symbols
from tessera.llm.chunks import Memo, per_text, spread
from tessera.llm.common import arrow_map, batches, documents, id_bucket, id_edges, scratch_path, stored

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: The dictionary: its size, the documents it is trained on (about), and the longest text of those.
DICT_BYTES, SAMPLE_DOCS, SAMPLE_TEXT = 64 << 10, 1_000, 32 << 10
BLOCK_BYTES, LEVEL = 256 << 10, 3
#: Distinct chunks, and pieces of them, that a task process remembers.
MEMO = 150_000
#: Texts whose chunks are looked up together: few, so that the chunks are still in the processor's cache.
TEXTS = 32
#: The splitting pattern that the short way knows: no piece holds white space, so chunks joined by spaces are searched together.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A space, which begins a chunk, or a piece of it.
PIECES = regex.compile(f" |{WORDS}")
#: Whether the library and Python lower-case and class a character alike, and no normal form changes it; by code point, all above the last as the last.
PLAIN = np.array([bool(regex.match("[\t-\r -~À-ÖØ-öø-ÿ]", chr(i))) for i in range(257)])


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


class Encoder:
    """The tokenizers library behind a memory of distinct chunks (its tokens never span a space).

    New chunks of plain letters, digits and signs are lower-cased and split as the file's own pattern says, all in one
    search, and the library's model encodes each distinct piece once; any other chunk is encoded by the library as it is.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = [n["type"] for n in spec["normalizer"]["normalizers"]], [p["type"] for p in spec["pre_tokenizer"]["pretokenizers"]]
        # what the short way does by hand; another vocabulary goes through the library alone
        self.plain = (names == (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"])
                      and spec["pre_tokenizer"]["pretokenizers"][0]["pattern"].get("Regex") == WORDS)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special)) if special else "(?!)").search
        self.as_bytes = {b: c for b, c in enumerate(byte_symbols())}
        self.pieces, self.memo = Memo(self._pieces), Memo(self._chunks)

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        tokenize, odd = self.tokenizer.model.tokenize, [p[1:] for p in pieces if p[0] == "\0"]
        whole = iter(self.tokenizer.encode_batch_fast(odd, add_special_tokens=False))
        ids, n = [], []
        for p in pieces:
            if p[0] == "\0":
                found = next(whole).ids
            elif p == " ":
                found = ()
            else:
                found = [t.id for t in tokenize(p if p.isascii() else p.encode().decode("latin-1").translate(self.as_bytes))]
            ids += found
            n.append(len(found))
        return np.array(ids, np.int32), np.array(n, np.int64)

    def _odd(self, chunks: list[str]) -> np.ndarray:
        """Which chunks only the library can encode."""
        if not self.plain:
            return np.ones(len(chunks), bool)
        joined = " ".join(chunks)
        odd = np.array([bool(self.special(c)) for c in chunks]) if self.special(joined) else np.zeros(len(chunks), bool)
        if not joined.isascii() or not joined.isprintable():
            points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            ends = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1)
            odd[np.searchsorted(ends, np.flatnonzero(~PLAIN[np.minimum(points, 256)]), side="right")] = True
        return odd

    def _chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new chunks, none of which holds a space: a space before each tells where its pieces begin."""
        odd = self._odd(chunks)
        some = bool(odd.any())
        short = [c for c, o in zip(chunks, odd.tolist()) if not o] if some else chunks
        pieces = PIECES.findall(" " + " ".join(short).lower()) if short else []
        if some:
            pieces += [x for c, o in zip(chunks, odd.tolist()) if o for x in (" ", "\0" + c)]
        space = self.pieces[" "]
        rows = self.pieces.rows(pieces)
        self.pieces.learn()
        counts = np.diff(np.flatnonzero(rows == space), append=len(rows))
        if some:
            # from the plain ones first to the chunks' own order
            starts, order = np.cumsum(counts) - counts, np.argsort(np.argsort(odd, kind="stable"), kind="stable")
            counts = counts[order]
            rows = rows[spread(starts[order], counts)]
        flat, n = self.pieces.ids.take(rows)
        self.pieces.forget(2 * MEMO)
        return flat, per_text(n, counts)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another and how many each text has, end ids left out."""
        counts, found = [], [np.empty(0, np.int64)]
        for at in range(0, len(texts), TEXTS):
            chunks = []
            for t in texts[at:at + TEXTS]:
                parts = t.split(" ") if t else []
                chunks += parts
                counts.append(len(parts))
            found.append(self.memo.rows(chunks))
        rows = np.concatenate(found)
        self.memo.learn()
        flat, n = self.memo.ids.take(rows)
        self.memo.forget(MEMO)
        return flat, per_text(n, np.array(counts, np.int64))

    def serialized(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids, with the end id, as little-endian unsigned integers."""
        ids, n = self.encode(texts)
        ends = np.cumsum(n)
        with_end = np.insert(ids, ends, END_ID).astype(f"<u{self.width}").tobytes()
        at = np.concatenate(([0], (ends + np.arange(1, len(n) + 1)) * self.width)).tolist()
        return [with_end[a:b] for a, b in zip(at, at[1:])]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def train_dictionary(docs: DataFrame, path: str) -> bytes:
    """Dictionary from the ids of about ``SAMPLE_DOCS`` documents, picked by a hash of their id."""
    n = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(n, 1))
    picked = (docs.where((F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
                         & (F.octet_length("text") <= SAMPLE_TEXT)).select("text").limit(2 * SAMPLE_DOCS))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(encoder(path).serialized(b.column(0).to_pylist()), pa.binary())], ["ids"])

    samples = sorted(bytes(r.ids) for r in arrow_map(picked, run, "ids binary").collect())
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, sum(map(len, samples)) // 8), samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _frames(docs: DataFrame, path: str, dictionary: bytes) -> DataFrame:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if shared:
            shared.precompute_compress(level=LEVEL)
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared).compress
        for b in it:
            if b.num_rows:
                e = encoder(path)
                raw = e.serialized(b.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([len(r) // e.width for r in raw], pa.int64()),
                     pa.array([pack(r) for r in raw], pa.binary())], ["doc_id", "n_tokens", "frame"])

    batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, frame binary")


_BLOCK = ("shard int, block long, start long, dict_hash string, doc_ids array<bigint>, tokens array<bigint>, "
          "offsets array<bigint>, payload binary")


def _blocks(dict_hash: str, limit: int):
    """Sorted ``(shard, doc_id, n_tokens, frame)`` rows to block rows, one block in memory at a time."""
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("start", pa.int64()), ("dict_hash", pa.string()),
                        ("doc_ids", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64())),
                        ("offsets", pa.list_(pa.int64())), ("payload", pa.binary())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, start, held, size = None, 0, 0, [], 0

        def out():
            offsets = np.concatenate(([0], np.cumsum([len(f) for _, _, f in held]))).tolist()
            return pa.RecordBatch.from_pylist(
                [{"shard": shard, "block": block, "start": start, "dict_hash": dict_hash, "doc_ids": [d for d, _, _ in held],
                  "tokens": [n for _, n, _ in held], "offsets": offsets, "payload": b"".join(f for _, _, f in held)}], schema)

        for b in it:
            for s, *row in zip(*(c.to_pylist() for c in b.columns)):
                if held and (s != shard or size >= limit):
                    yield out()
                    block, start = block + 1, start + sum(n for _, n, _ in held)
                    held, size = [], 0
                if s != shard:
                    shard, block, start = s, 0, 0
                held.append(row)
                size += len(row[2])
        if held:
            yield out()

    return run


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, shards: int | None = None) -> None:
    """Encode every text of ``docs`` and write ``folder``."""
    spark, path = docs.sparkSession, path or default_path()
    dictionary = train_dictionary(docs, path)
    dict_hash = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(dict_hash, encoder(path).width, bytearray(dictionary))],
                          "dict_hash string, width int, dictionary binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    edges = id_edges(docs, shards or int(spark.conf.get("spark.sql.shuffle.partitions")))
    (_frames(docs, path, dictionary).withColumn("shard", id_bucket(F.col("doc_id"), edges))
     .repartitionById(len(edges) + 1, F.col("shard"))
     .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_last(), "frame")
     .select("shard", "doc_id", "n_tokens", "frame").mapInArrow(_blocks(dict_hash, BLOCK_BYTES), _BLOCK)
     .write.option("compression", "none").parquet(f"{folder}/blocks"))


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document of a token folder, ``ids`` serialized as written."""
    d = spark.read.parquet(f"{folder}/dictionary").first()
    dictionary, dict_hash, width = bytes(d.dictionary), d.dict_hash, d.width
    if hashlib.sha256(dictionary).hexdigest() != dict_hash:
        raise ValueError(f"the dictionary of {folder} does not have its hash")
    blocks = spark.read.parquet(f"{folder}/blocks")
    # one row a shard: the ids of all shards before it
    base = (blocks.groupBy("shard").agg(F.sum(F.aggregate("tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
            .withColumn("base", F.sum("n").over(Window.orderBy("shard")) - F.col("n")).select("shard", "base"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        unpack = zstandard.ZstdDecompressor(dict_data=shared).decompress
        for b in it:
            for r in b.to_pylist():
                if r["dict_hash"] != dict_hash:
                    raise ValueError("a block was written with another dictionary")
                at, n = r["offsets"], np.array(r["tokens"], np.int64)
                starts = r["base"] + r["start"] + np.cumsum(n) - n
                for i in range(0, len(n), 1_000):
                    ids = [unpack(r["payload"][a:z]) for a, z in zip(at[i:i + 1_000], at[i + 1:i + 1_001])]
                    if any(len(x) != k * width for x, k in zip(ids, n[i:i + 1_000].tolist())):
                        raise ValueError("a frame does not hold the ids of its index")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(r["doc_ids"][i:i + 1_000], pa.int64()), pa.array(starts[i:i + 1_000]),
                         pa.array(n[i:i + 1_000]), pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    # a batch of blocks stays below BATCH_ROWS * BLOCK_BYTES (and a block of one very long document)
    batches(spark)
    return (blocks.join(F.broadcast(stored(base, "token-shards")), "shard")
            .select("dict_hash", "base", "start", "doc_ids", "tokens", "offsets", "payload")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary"))


def read_one(spark: SparkSession, folder: str, doc_id: int) -> np.ndarray | None:
    """The ids of one document (the first row of that id), through its block's index."""
    d = spark.read.parquet(f"{folder}/dictionary").first()
    row = (spark.read.parquet(f"{folder}/blocks").where(F.array_contains("doc_ids", F.lit(doc_id).cast("long")))
           .withColumn("i", F.array_position("doc_ids", F.lit(doc_id).cast("long")).cast("int"))
           .orderBy("shard", "block")
           .select(F.expr("substring(payload, cast(offsets[i - 1] + 1 as int), cast(offsets[i] - offsets[i - 1] as int))")
                   .alias("frame")).first())
    if row is None:
        return None
    shared = zstandard.ZstdCompressionDict(bytes(d.dictionary)) if d.dictionary else None
    return np.frombuffer(zstandard.ZstdDecompressor(dict_data=shared).decompress(bytes(row.frame)), f"<u{d.width}")


def digests(tokens: DataFrame, width: int) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)``, the checksum over ids of four bytes."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        crc = [zlib.crc32(np.frombuffer(x.as_buffer(), f"<u{width}").astype("<u4").tobytes()) for x in b.column(3)]
        return pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(crc, pa.int64())],
                                          ["doc_id", "start", "n_tokens", "ids_crc32"])

    return arrow_map(tokens, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def query(spark, sf_dir):
    folder = scratch_path(spark, "tokens")
    write_tokens(documents(spark, sf_dir).select("doc_id", "text"), folder)
    width = spark.read.parquet(f"{folder}/dictionary").first().width
    return digests(read_tokens(spark, folder), width)
