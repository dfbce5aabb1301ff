"""SimHash near-dedup with multi-index hashing.

Fingerprints: each text's shingles vote bit by bit; exact copies of a
fingerprint collapse into one before anything is compared. With a limit of 3
bits, one half of two linked fingerprints differs in at most one bit, so every
fingerprint is listed under both its halves (the tables) and looks up its halves'
balls of radius one (the probes), of which only 0-to-1 flips are needed as a pair
differing in one bit is met from one side. What a probe fetches is verified over all 64 bits.

A table entry with more than ``MAX_ENTRY`` fingerprints is not enumerated: its
members go through an exact way whose size is linear in them. Each emits the 65
keys of its radius-one ball as a centre, and the keys got by raising two zero bits as
a reach. Two centres sharing a key are at most 2 bits apart, a centre and a reach at
most 3; and of any two fingerprints 3 bits apart, one has two zeros among the
three bits, so it reaches a key of the other's ball. Linking all that meet at a
key to one centre there is thus complete, and every link it makes is real.

Components are found by alternating large-star and small-star rounds.

Edge cases: a null or empty text, or one of blanks, has fingerprint zero and is
linked like any other. A null ``doc_id`` counts as the largest (a component of
such rows alone has a null ``component_id``). Repeated rows share a fingerprint.
Other columns are ignored by the matching. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, UPPER, arrow_map, documents, stored

WORDS, MAX_BITS, SEED = 3, 3, 42
#: Fingerprints of one table entry that probes compare themselves with one by one.
MAX_ENTRY = 64
_FOLD = str.maketrans(UPPER, LOWER)
_BLANK_TO_SPACE = str.maketrans("\t\n\x0b\x0c\r", " " * 5)
_BITS = np.arange(64, dtype=np.uint64)
#: Stands for a missing id where rows are joined.
NO_ID = -(1 << 63)


def shingle_hashes(text: str | None, words: int = WORDS) -> list[int]:
    """XXH64 of every shingle, repeats included."""
    w = [x for x in (text or "").translate(_FOLD).translate(_BLANK_TO_SPACE).split(" ") if x]
    if not w:
        return []
    h = xxhash.xxh64_intdigest
    if len(w) <= words:
        return [h(" ".join(w).encode(), SEED)]
    raw = [x.encode() for x in w]
    flat = b" ".join(raw)
    ends = np.cumsum([len(x) + 1 for x in raw])
    starts = (ends - [len(x) + 1 for x in raw]).tolist()
    return [h(flat[a:b], SEED) for a, b in zip(starts, (ends[words - 1:] - 1).tolist())]


def with_fingerprint(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``(doc_id, th, fp)``: a hash that tells rows of one id apart, and the fingerprint as a signed long."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.zeros(b.num_rows, dtype=np.uint64)
        texts = b.column(2)
        for i in range(b.num_rows):
            h = shingle_hashes(texts[i].as_py(), words)
            if h:
                a = np.array(h, dtype=np.uint64)
                # 64 votes at once: the hashes' bits as rows of a small matrix
                bits = np.unpackbits(a.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                up = bits.sum(axis=0, dtype=np.int64) * 2 > len(h)
                fps[i] = np.packbits(up, bitorder="little").view("<u8")[0]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))],
                                           ["doc_id", "th", "fp"])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text"), run,
                     "doc_id long, th long, fp long")


def _half(fp, s: int):
    return F.shiftrightunsigned(fp, 32 * s).bitwiseAND(F.lit(0xFFFFFFFF))


def _flips(fp, bits: range, zeros_only: bool = True):
    """``fp`` with one of ``bits`` raised, for each that is zero (or flipped, for each)."""
    one = [F.lit(1 << b if b < 63 else -(1 << 63)) for b in bits]
    if not zeros_only:
        return F.array(*[fp.bitwiseXOR(m) for m in one])
    return F.filter(F.transform(F.array(*one), lambda m: F.when(fp.bitwiseAND(m) == 0, fp.bitwiseOR(m))),
                    lambda x: x.isNotNull())


def _entries(fps: DataFrame, flips: bool) -> DataFrame:
    """``(s, key, fp)``: the halves of each fingerprint, and with ``flips`` their balls' keys met from below."""
    def listed(s: int):
        half = _half(F.col("fp"), s)
        keys = F.concat(F.array(half), _flips(half, range(32))) if flips else F.array(half)
        return F.transform(keys, lambda k: F.struct(F.lit(s).alias("s"), k.alias("key")))

    return fps.select("fp", F.explode(F.concat(listed(0), listed(1))).alias("e")).select("e.s", "e.key", "fp")


def links(fps: DataFrame, max_bits: int = MAX_BITS, max_entry: int = MAX_ENTRY) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints: enough of the pairs at most ``max_bits`` apart for their components.

    ``fps`` is a stored table of distinct ``fp``.
    """
    if max_bits != 3:
        raise ValueError("the halves' balls of radius one answer a limit of 3 bits")
    rank = F.row_number().over(Window.partitionBy("s", "key").orderBy("fp"))
    # at most max_entry + 1 of an entry leave each task, so a large entry is never gathered
    table = (_entries(fps, False).withColumn("r", rank).where(F.col("r") <= max_entry + 1)
             .groupBy("s", "key").agg(F.collect_list("fp").alias("entry")))
    table = stored(table, "simhash-table")
    near = F.filter("entry", lambda m: (F.bit_count(m.bitwiseXOR(F.col("fp"))) <= max_bits) & (m != F.col("fp")))
    large = F.size("entry") > max_entry
    # sizes before an explode say nothing about the 34 probes of a fingerprint: without the hint they are broadcast
    fetched = stored(_entries(fps, True).hint("merge").join(table, ["s", "key"])
                     .select("fp", large.alias("large"), F.when(~large, near).otherwise(F.array().cast("array<bigint>")).alias("near"))
                     .where("large or size(near) > 0"), "simhash-fetched")
    pairs = fetched.select(F.col("fp").alias("a"), F.explode("near").alias("b"))
    many = fetched.where("large").select("fp").distinct()
    if many.limit(1).count() == 0:
        return pairs.distinct()
    return pairs.unionByName(_star_links(stored(many, "simhash-many"))).distinct()


def _star_links(many: DataFrame) -> DataFrame:
    """Links of a set of fingerprints through the keys of their balls; linear in the set."""
    fp = F.col("fp")
    ball = F.concat(F.array(fp), _flips(fp, range(64), False))

    def reach(b):
        x = np.array(b.column(0).to_numpy(zero_copy_only=False), dtype=np.int64).view(np.uint64)
        keys, owners = [], []
        for i in range(63):
            for_i = (x >> _BITS[i]) & np.uint64(1) == 0
            xi = x[for_i] | (np.uint64(1) << _BITS[i])
            if not len(xi):
                continue
            high = _BITS[i + 1:]
            zero = ((xi[:, None] >> high) & np.uint64(1)) == 0
            keys.append((xi[:, None] | (np.uint64(1) << high))[zero])
            owners.append(np.repeat(x[for_i], zero.sum(axis=1)))
        keys = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        owners = np.concatenate(owners) if owners else np.empty(0, np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(owners.view(np.int64))], ["key", "fp"])

    met = (many.select(F.explode(ball).alias("key"), "fp").withColumn("centre", F.lit(True))
           .unionByName(arrow_map(many.select("fp"), reach, "key long, fp long").withColumn("centre", F.lit(False))))
    # a key has at most 1 + 64 + 2016 fingerprints: the window stays small
    first = F.min(F.when(F.col("centre"), F.col("fp"))).over(Window.partitionBy("key"))
    return (met.withColumn("a", first).where("a is not null and a <> fp")
            .select("a", F.col("fp").alias("b")).distinct())


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, root)``: the smallest node reachable, for every node of ``edges`` ``(a, b)``.

    Large-star links every larger neighbour of a node to the smallest around it, small-star the smaller ones; when
    neither changes anything, every node hangs on its root. Rounds are stored, so lineage does not grow. A
    node with very many neighbours is pre-aggregated by ``min`` and its edges meet that one row in a join that
    adaptive execution can split.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .where("u <> v").distinct(), label)
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), label)
        large = (both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        large = stored(large, label)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct())
        now = stored(small, label)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state


def _components(docs: DataFrame, words: int, max_bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their fingerprint, fingerprints with their component's root, roots with their first document."""
    marked = stored(with_fingerprint(docs, words), "simhash-docs")
    fps = stored(marked.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th"))
                                          .alias("first")), "simhash-fps")
    comp = components(links(fps.select("fp"), max_bits), "simhash-components")
    rooted = stored(fps.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
                    .select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    return marked, rooted, stored(rooted.groupBy("root").agg(F.min("first").alias("first")), "simhash-first")


def near_duplicates(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``."""
    marked, rooted, first = _components(docs, words, max_bits)
    # a component's one row meets its fingerprints, and each of those its documents, in joins that can be split
    named = rooted.select("fp", "root").join(first, "root").select("fp", F.col("first.doc_id").alias("component_id"))
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest id (then of the smallest text hash)."""
    first = _components(docs, words, max_bits)[2].select(
        F.coalesce("first.doc_id", F.lit(NO_ID)).alias("_simhash_id"), F.col("first.th").alias("_simhash_th"))
    row = F.row_number().over(Window.partitionBy("_simhash_id", "_simhash_th").orderBy("text"))
    return (docs.withColumn("_simhash_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))
            .withColumn("_simhash_th", F.xxhash64("text")).join(first, ["_simhash_id", "_simhash_th"], "left_semi")
            .withColumn("_simhash_row", row).where("_simhash_row = 1").select(*[F.col(f"`{c}`") for c in docs.columns]))


def query(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
