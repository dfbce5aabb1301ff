"""Document fingerprints by winnowing.

Every ``GRAM`` code points are hashed by a rolling polynomial, and of each
window of ``WINDOW`` neighbouring gram hashes the smallest is chosen, the rightmost of equal
ones. The chosen hashes and their positions are the fingerprint: two texts that share
a passage of at least ``GRAM + WINDOW - 1`` code points share a chosen hash, and
nothing shorter than ``GRAM`` ever matches. A text with fewer hashes than a window is
one window; one shorter than a gram is hashed whole.

Likeness of two fingerprints is the Jaccard index of their hash sets.

``against_edits`` meets every document with the next one in ascending ``doc_id``. Ids are cut
into ranges, each sorted in one task, and the first row of each range is also
sent to the range before it, so no ordering passes through one task and texts are shuffled once.

Edge cases: a null or empty text has the empty fingerprint; two empty fingerprints are alike (1), an empty
and another are not (0). Rows without an id come last. Rows of equal ids follow one another by
text. The only row of a table is its own next. Other columns pass through ``fingerprints``
(``hashes`` and ``positions`` are replaced). An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import arrow_map, batches, documents, id_bucket, id_edges

#: Any 32 shared code points are seen, and a text of 50 has a handful of hashes, so that likeness of short texts is graded.
GRAM, WINDOW = 16, 17
#: Gram positions looked at together; a chosen hash's 48 bits and a place among these fill one integer.
SPAN = 1 << 16
BASE = 0x9E3779B97F4A7C15
_UINT = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _UINT)
    out[0] = 1
    return np.cumprod(out, dtype=_UINT)


_UP_POWERS = _powers(BASE, SPAN + GRAM)
_DOWN_POWERS = _powers(pow(BASE, -1, 1 << 64), SPAN + GRAM)


def gram_hashes(codes: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """48-bit hashes of all grams of at most ``SPAN + gram`` code points: differences of prefix sums, mixed."""
    sums = np.zeros(len(codes) + 1, _UINT)
    np.cumsum((codes.astype(_UINT) + _UINT(1)) * _UP_POWERS[:len(codes)], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * _DOWN_POWERS[:len(codes) - gram + 1]
    h ^= h >> _UINT(29)
    h *= _UINT(0xBF58476D1CE4E5B9)
    h ^= h >> _UINT(32)
    h *= _UINT(0x94D049BB133111EB)
    return h >> _UINT(16)


def _window_minima(keys: np.ndarray, window: int) -> np.ndarray:
    """The least key of every window, by doubling."""
    least, width = keys, 1
    while width * 2 <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    return np.minimum(least[:len(keys) - window + 1], least[window - width:]) if width < window else least


def winnow(text: str | None, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes and their positions in the order of the text."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return np.empty(0, _UINT), np.empty(0, np.int64)
    gram = min(gram, len(codes))
    n = len(codes) - gram + 1
    window = min(window, n)
    up_to = SPAN + GRAM - gram if gram > GRAM else SPAN
    hashes, places, at = [], [], 0
    while at == 0 or at + window <= n:
        size = min(up_to, n - at)
        h = gram_hashes(codes[at:at + size + gram - 1], gram)
        # the later of equal hashes has the smaller key
        keys = (h << _UINT(16)) | (_UINT(SPAN - 1) - np.arange(size, dtype=_UINT))
        least = _window_minima(keys, window)
        chosen = least[np.concatenate(([True], least[1:] != least[:-1]))]
        hashes.append(chosen >> _UINT(16))
        places.append(at + (SPAN - 1) - (chosen & _UINT(SPAN - 1)).astype(np.int64))
        at += size - window + 1
    h, p = np.concatenate(hashes), np.concatenate(places)
    new = np.concatenate(([True], p[1:] != p[:-1]))
    return h[new], p[new]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard index of two sets of hashes."""
    x, y = np.unique(a), np.unique(b)
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def digest(hashes: np.ndarray) -> str:
    """The hashes as 12 hexadecimal digits each, in the order of the text."""
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex() if len(hashes) else ""


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``hashes`` and ``positions`` (arrays of long)."""
    docs = docs.drop("hashes", "positions")
    at = docs.columns.index("text")
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([*docs.schema.fields, T.StructField("hashes", longs), T.StructField("positions", longs)])

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [winnow(t.as_py(), gram, window) for t in b.column(at)]
        return pa.RecordBatch.from_arrays(
            [*b.columns, pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64())),
             pa.array([p for _, p in found], pa.list_(pa.int64()))], [*b.schema.names, "hashes", "positions"])

    return arrow_map(docs, run, schema)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of the text that follows."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, positions array<int>, edited_positions array<int>")


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Ranges of ``docs`` in order, one a partition: ``(bucket, guest, doc_id, text)``, the next range's first row at the end."""
    spark = docs.sparkSession
    edges = id_edges(docs, ranges or int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(id_bucket(F.col("doc_id"), edges).alias("bucket"), F.col("doc_id").cast("long"),
                       F.coalesce("text", F.lit("")).alias("text"))
    # the first id of each range, and to which range its row goes as well: the one before it that has rows
    first = (rows.groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("f")).orderBy("bucket").collect())
    if not first:
        return rows.select("bucket", F.lit(False).alias("guest"), "doc_id", "text")
    sends = [(r.f.doc_id, first[i - 1].bucket) for i, r in enumerate(first)]
    ids = spark.createDataFrame([(d, b) for d, b in sends], "first_id long, to int")
    guests = (rows.alias("r").join(F.broadcast(ids).alias("f"), F.expr("r.doc_id <=> f.first_id"))
              .groupBy("to").agg(F.min("text").alias("text"), F.first("doc_id").alias("doc_id"))
              .select(F.col("to").alias("bucket"), F.lit(True).alias("guest"), "doc_id", "text"))
    return (rows.select("bucket", F.lit(False).alias("guest"), "doc_id", "text").unionByName(guests)
            .repartitionById(len(edges) + 1, F.col("bucket"))
            .sortWithinPartitions("bucket", "guest", F.col("doc_id").asc_nulls_last(), "text"))


def against_edits(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Every document's fingerprint, its edited text's, and the likeness to that and to the next document.

    ``positions`` and ``edited_positions`` tell where each hash of the two fingerprints begins (code points): two texts that
    share a run of ``gram + window - 1`` code points share a hash whose positions lie in that run.
    """
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in it:
            out = {k: [] for k in ("doc_id", "n_chars", "sha", "fp", "efp", "ne", "nn", "p", "ep")}
            for bucket, _, doc, text in zip(*(c.to_pylist() for c in b.columns)):
                mark, places = winnow(text, gram, window)
                if held and held[0] == bucket:
                    _, d, t, m, p = held
                    e = edited(t, text)
                    em, ep = winnow(e, gram, window)
                    for k, v in zip(out, (d, len(t), hashlib.sha256(e.encode()).hexdigest(), digest(m), digest(em),
                                          likeness(m, em), likeness(m, mark), p.astype(np.int32), ep.astype(np.int32))):
                        out[k].append(v)
                held = bucket, doc, text, mark, places
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out.values(), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(),
                                                               pa.float64(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.int32())))],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
                 "positions", "edited_positions"])

    batches(docs.sparkSession)
    return with_next(docs).mapInArrow(run, _RESULT)


def query(spark, sf_dir):
    return against_edits(documents(spark, sf_dir))
