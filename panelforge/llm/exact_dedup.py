"""Exact deduplication with composable polynomial fingerprints.

A text is normalised by deleting every character of ``[\\x20\\x09-\\x0D]`` and cut
into chunks. Each chunk is hashed on its own as a polynomial in a fixed base, modulo
two primes; the hash of a whole text is the sum of its chunks' hashes, each shifted
by the base to the power of the bytes that follow it. Chunks can therefore be hashed
anywhere and added up in any order, also those of texts that are stored in pieces.

Equal fingerprints only nominate copies. Members of such a group are then compared
chunk by chunk: per (fingerprint, chunk number) the smallest and the largest chunk
must be the same string. The comparison is a map-side aggregate, so a group that holds
a third of all rows shrinks to one row a task before it is shuffled. Groups that fail
(true collisions) are regrouped by the SHA-256 of the whole text.

Defined results: null text is empty; empty texts are copies of each other; equal texts
keep the row with the most code points in the original, then the smallest doc_id; rows
that repeat doc_id and text are one row's copies and share its verdict; a null doc_id
sorts after all others; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import SPACE, materialize, pick, ship, slices, text_bytes

PRIMES = (2147483647, 2147483629)  # two primes below 2**31
BASES = (1000003, 998244353)
CHUNK = 1 << 16  # bytes; 255 * 2**31 * 2**16 stays below 2**63


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo prime, by doubling."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:
        step = np.uint64(pow(base, len(out), prime))
        out = np.concatenate([out, out * step % np.uint64(prime)])
    return out[:n]


POWERS = [_powers(b, p, CHUNK)[::-1].copy() for b, p in zip(BASES, PRIMES)]


def chunk_hash(chunk: bytes) -> tuple[int, int]:
    """Polynomial hashes of at most CHUNK bytes; byte values are taken plus one, so leading zeros count."""
    data = np.frombuffer(chunk, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    n = len(data)
    return tuple(int((data * pw[CHUNK - n:]).sum() % np.uint64(p)) if n else 0 for pw, p in zip(POWERS, PRIMES))


def shift(h: tuple[int, int], by: int) -> tuple[int, int]:
    """The hash's share in a text where `by` more bytes follow."""
    return tuple(x * pow(b, by, p) % p for x, b, p in zip(h, BASES, PRIMES))


def combine(left: tuple[int, int], right: tuple[int, int], right_bytes: int) -> tuple[int, int]:
    """Hash of left + right."""
    return tuple((a + b) % p for a, b, p in zip(shift(left, right_bytes), right, PRIMES))


CHUNK_SCHEMA = "id long, n_chars long, n_bytes long, sha256 string, chunk_no long, h1 long, h2 long"


def _chunks(batches):
    cut = SPACE
    for batch in slices(batches):
        ids, chars = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        rows = []
        for i, raw, n_chars in zip(ids, text_bytes(batch.column(1)), chars):
            norm = raw.translate(None, cut)
            sha = hashlib.sha256(norm).hexdigest()
            for no, at in enumerate(range(0, max(len(norm), 1), CHUNK)):
                piece = norm[at:at + CHUNK]
                h = shift(chunk_hash(piece), len(norm) - at - len(piece))
                rows.append((i, n_chars, len(norm), sha, no, *h))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
            names=["id", "n_chars", "n_bytes", "sha256", "chunk_no", "h1", "h2"])


def chunk_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per chunk of each (id, text): its shifted hashes, ready to be added up."""
    ship(docs.sparkSession)
    src = docs.select("id", F.coalesce("text", F.lit("")).alias("text"),
                      F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"))
    return src.mapInArrow(_chunks, CHUNK_SCHEMA)


def combine_chunks(chunks: DataFrame) -> DataFrame:
    """Add up shifted chunk hashes: one row per (id, n_chars, sha256) with its fingerprint.

    A row's own text is told from that of another row with the same id by its sha256 and
    length; rows that repeat both are counted in n_rows."""
    g = chunks.groupBy("id", "n_chars", "n_bytes", "sha256").agg(
        F.sum(F.when(F.col("chunk_no") == 0, 1).otherwise(0)).alias("n_rows"),
        F.sum("h1").alias("s1"), F.sum("h2").alias("s2"))
    # repeated rows add the same sum again: divide before the modulus
    return g.select("id", "n_chars", "n_bytes", "sha256", "n_rows",
                    F.expr(f"(s1 div n_rows) % {PRIMES[0]}").alias("f1"),
                    F.expr(f"(s2 div n_rows) % {PRIMES[1]}").alias("f2"))


def _collided(docs: DataFrame, prints: DataFrame, multi: DataFrame) -> DataFrame:
    """Fingerprints whose members differ in a chunk: chunkwise comparison by min and max."""
    members = prints.join(multi.select("f1", "f2", "n_bytes"), ["f1", "f2", "n_bytes"], "left_semi").select("id", "f1", "f2", "n_bytes").distinct()
    norm = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", "")
    pieces = F.expr(f"transform(sequence(0, greatest(cast(ceil(length(norm) / {CHUNK}) as int), 1) - 1), i -> substring(norm, i * {CHUNK} + 1, {CHUNK}))")
    rows = (docs.join(members, docs["id"].eqNullSafe(members["id"]))
            .select("f1", "f2", "n_bytes", norm.alias("norm"))
            .where(F.octet_length("norm") == F.col("n_bytes"))  # another text under the same id is not a member
            .select("f1", "f2", "n_bytes", F.posexplode(pieces).alias("no", "chunk")))
    return (rows.groupBy("f1", "f2", "n_bytes", "no").agg(F.min("chunk").alias("a"), F.max("chunk").alias("b"))
            .where("a <> b").select("f1", "f2", "n_bytes").distinct())


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256, fingerprint (see the module text)."""
    src = pick(docs, id=id_col, text=text_col)
    prints = materialize(combine_chunks(chunk_fingerprints(src)), "prints")
    key = ["f1", "f2", "n_bytes"]
    best = F.max_by(F.struct("id", "n_chars"), F.struct("n_chars", F.col("id").isNotNull().alias("k"), (-F.col("id")).alias("i")))
    groups = prints.groupBy(*key).agg(F.sum("n_rows").alias("size"), best.alias("best"))
    multi = materialize(groups.where("size > 1"), "groups")
    bad = materialize(_collided(src, prints, multi), "collided")
    # collided groups only: regrouped by the sha256 of the whole text beside the fingerprint
    apart = (prints.join(bad, key, "left_semi").groupBy(*key, "sha256")
             .agg(F.sum("n_rows").alias("size2"), best.alias("best2")))
    out = (prints.join(multi, key, "left").join(apart, [*key, "sha256"], "left")
           .select(F.col("id"), F.col("n_chars"), F.col("n_rows"), F.col("sha256").alias("text_sha256"),
                   F.coalesce("size2", "size", "n_rows").cast("long").alias("group_size"),
                   F.coalesce("best2", "best", F.struct("id", "n_chars")).alias("best"),
                   F.concat_ws("-", F.hex("f1"), F.hex("f2"), F.hex("n_bytes")).alias("fingerprint")))
    return (out.select(F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size",
                       (F.col("id").eqNullSafe(F.col("best.id")) & (F.col("n_chars") == F.col("best.n_chars"))).alias("kept"),
                       "text_sha256", "fingerprint", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))).alias("copy"))
            .withColumn("kept", F.col("kept") & (F.col("copy") == 1)).drop("copy"))
