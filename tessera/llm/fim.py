"""Fill-in-the-middle documents by block rotation inside one buffer.

A text is cut into a prefix, a middle and a suffix at two of its token ends, chosen by a
hash of the document's id. The cuts are scanned in the bytes of the text; the three
sentinels are inserted in a bytearray, which then holds ``<P>prefix<M>middle<S>suffix``; and one
exchange of two neighbouring segments gives either form: a psm document exchanges the middle
with the suffix, an spm document everything before the suffix with the suffix. An exchange is a rotation made
of three reversals in place, in pieces of ``SWAP`` bytes. A document is restored from its output and its form
alone: the sentinels are found, the inverse rotation is made, and the sentinels are cut out.

A token is ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+`` or, at the end of a text, ``[\\x20\\x09-\\x0D]+``. All these
characters are ASCII, so token ends are the same over bytes and over code points.

Edge cases: a null text is empty, and an empty text is plain. A text that holds a sentinel is plain, as it could
not be restored otherwise. A document without an id is hashed as if its id had no digits. Repeated rows are
transformed alike. Very long texts are transformed whole, in a buffer of their own size and index arrays of a few bytes a
byte. Other columns pass through; input columns with the name of a new one are replaced. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import BLANKS, arrow_map, documents

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, SPM, PSM = "plain", "spm", "psm"
SEED = 42
#: Share of documents that are transformed, and share of these in suffix-first form, in percent.
RATE, SPM_RATE = 50, 80
#: Bytes exchanged at a time by a reversal.
SWAP = 1 << 16
_BLANK = np.isin(np.arange(256), np.frombuffer(BLANKS.encode(), np.uint8))
NEW = {"form": T.StringType(), "n_tokens": T.LongType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(),
       "output": T.StringType()}


def token_ends(raw: bytes) -> np.ndarray:
    """Where the tokens of ``raw`` end, ascending."""
    if not raw:
        return np.zeros(0, np.int64)
    blank = _BLANK[np.frombuffer(raw, np.uint8)]
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    return np.append(ends, len(raw))  # the last word, or the blanks after it


def code_points(raw) -> int:
    return int(np.count_nonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)) if len(raw) else 0


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four unsigned 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4)]


def reverse(buf: bytearray, a: int, b: int) -> None:
    """``buf[a:b]`` back to front, in place."""
    while b - a > 1:
        k = min(SWAP, (b - a) // 2)
        head = buf[a:a + k]
        buf[a:a + k] = buf[b - k:b][::-1]
        buf[b - k:b] = head[::-1]
        a, b = a + k, b - k


def rotate(buf: bytearray, a: int, m: int, b: int) -> None:
    """Exchange ``buf[a:m]`` and ``buf[m:b]`` in place by three reversals."""
    reverse(buf, a, m)
    reverse(buf, m, b)
    reverse(buf, a, b)


def transform(raw: bytes, form: str, first: int, second: int) -> bytes:
    """``raw``, cut at the bytes ``first`` and ``second``, in its form."""
    if form == PLAIN:
        return raw
    buf = bytearray(raw)
    for at, mark in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buf[at:at] = mark
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(buf, 0 if form == SPM else middle, suffix, len(buf))
    return bytes(buf)


def invert(output: bytes, form: str) -> bytes:
    """The text that :func:`transform` made ``output`` of."""
    if form == PLAIN:
        return output
    buf = bytearray(output)
    if form == SPM:  # suffix, then prefix and middle
        rotate(buf, 0, buf.index(PREFIX), len(buf))
    else:
        rotate(buf, buf.index(SUFFIX), buf.index(MIDDLE), len(buf))
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = buf.index(mark)
        del buf[at:at + len(mark)]
    return bytes(buf)


def plan(raw: bytes, doc_id: int | None, seed: int, rate: int, spm_rate: int) -> tuple[str, int, int, int]:
    """Form, number of tokens, and the two cuts of a document."""
    ends = token_ends(raw)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not raw or h3 % 100 >= rate or any(mark in raw for mark in (PREFIX, SUFFIX, MIDDLE)):
        return PLAIN, len(ends), 0, 0
    first, second = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    cut = lambda k: int(ends[k - 1]) if k else 0
    return (SPM if h4 % 100 < spm_rate else PSM), len(ends), cut(first), cut(second)


def _raw(column: pa.Array) -> list[bytes]:
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def _text(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """``docs`` with ``form``, ``n_tokens``, ``prefix_chars``, ``middle_chars`` (null if plain) and ``output``, the transformed text."""
    kept = [c for c in docs.columns if c.lower() not in NEW]
    docs = docs.select(*[docs[f"`{c}`"] for c in kept])
    i, t = kept.index("doc_id"), kept.index("text")
    schema = T.StructType([*docs.schema.fields, *(T.StructField(k, v) for k, v in NEW.items())])

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        raws, rows = _raw(b.column(t)), []
        for raw, doc_id in zip(raws, b.column(i).to_pylist()):
            form, n, first, second = plan(raw, doc_id, seed, rate, spm_rate)
            chars = (None, None) if form == PLAIN else (code_points(raw[:first]), code_points(raw[first:second]))
            rows.append((form, n, *chars, transform(raw, form, first, second)))
        form, n, prefix, middle, output = zip(*rows)
        new = [pa.array(form, pa.string()), *(pa.array(x, pa.int64()) for x in (n, prefix, middle)), _text(output)]
        return pa.RecordBatch.from_arrays([*b.columns, *new], [*b.schema.names, *NEW])

    return arrow_map(docs, run, schema)


def restore(transformed: DataFrame, to: str = "restored") -> DataFrame:
    """``transformed`` with the texts rebuilt from ``output`` and ``form`` in the column ``to``; a null form is read as plain."""
    kept = [c for c in transformed.columns if c.lower() != to.lower()]
    rows = transformed.select(*[transformed[f"`{c}`"] for c in kept])
    f, o = kept.index("form"), kept.index("output")
    schema = T.StructType([*rows.schema.fields, T.StructField(to, T.StringType())])

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        back = [invert(x, form or PLAIN) for x, form in zip(_raw(b.column(o)), b.column(f).to_pylist())]
        return pa.RecordBatch.from_arrays([*b.columns, _text(back)], [*b.schema.names, to])

    return arrow_map(rows, run, schema)


def query(spark, sf_dir):
    done = restore(fill_in_middle(documents(spark, sf_dir).select("doc_id", "text")).drop("text"))
    return done.select("doc_id", F.col("n_tokens").alias("n"), "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
drawn AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS h1,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4
  FROM cut),
formed AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 50 THEN 'plain'
    WHEN h4 < 80 THEN 'spm' ELSE 'psm' END AS form,
    coalesce(array_to_string(units[1:least(h1, h2)], ''), '') AS p,
    coalesce(array_to_string(units[least(h1, h2) + 1:greatest(h1, h2)], ''), '') AS m,
    coalesce(array_to_string(units[greatest(h1, h2) + 1:], ''), '') AS s
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM formed
"""
