"""N-gram Jaccard join with Bayesian candidate pruning.

A text is the set of its word 5-grams (words ``[^\\x20\\x09-\\x0D]+`` as they stand; a text of
one to four words has one gram of them all). Two texts are linked if the Jaccard similarity of their
sets is at least the threshold (0.8).

1. Texts with equal word sequences form one exact class; from here on each class is one
   node, so copies cost nothing.
2. Every node gets 96 MinHash values of 16 bits, which are 24 bands of four. Nodes that share a band meet
   in a bucket. A bucket of any size is cut into cells of about CELL nodes; every pair of cells is
   one group of work, so a hot bucket spreads over many tasks.
3. Pairs of a bucket are compared MinHash value by MinHash value, 24 at a time. With m matches among the
   first n values and a flat prior, the similarity's posterior is Beta(m + 1, n - m + 1); a
   pair is dropped as soon as P(similarity >= threshold) is below the tolerance. A pair that
   agrees in an earlier band was compared there and is skipped.
4. Surviving pairs only tell which nodes must be verified together: they leave a task as a
   spanning forest, never pair by pair, and their components are found in Spark.
5. Within a component (again cut into cells by text size) all pairs' intersections are counted exactly
   through an inverted index. A task returns each node's number of links and a spanning
   forest of the links; components of these are the near-duplicate groups.

Defined results: null and empty texts have no grams and no links, and are classes of their own;
the class id is the smallest doc_id of the group (null only if all are null); rows that repeat id and text
are copies; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import hash_words, materialize, partitions_for, pick, shield, ship, slices, text_bytes, words_of
from panelforge.llm.components import connected_components

GRAM, BANDS, ROWS = 5, 24, 4
HASHES = BANDS * ROWS
CELL = 2048  # nodes of a bucket cell
CELL_WORDS = 2_000_000  # words of a verification cell
TOLERANCE = 1e-6
_MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the word 5-grams of each text (no nulls), one after another, and the bounds of the texts."""
    words, row, _, _ = words_of(texts)
    coded = words.dictionary_encode()
    h = hash_words(coded.dictionary)[coded.indices.to_numpy()]
    n = np.bincount(row, minlength=len(texts))
    starts = np.concatenate([[0], np.cumsum(n)])
    grams = np.where(n >= GRAM, n - GRAM + 1, np.minimum(n, 1))
    bounds = np.concatenate([[0], np.cumsum(grams)])
    doc = np.repeat(np.arange(len(n)), grams)
    at = np.arange(bounds[-1]) - bounds[doc] + starts[doc]
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(GRAM):
        inside = k < n[doc]  # short texts: fewer words, told apart from others by their number
        word = h[np.minimum(at + k, max(len(h) - 1, 0))] if len(h) else out
        out = np.where(inside, (out ^ word) * _MIX ^ (out >> np.uint64(29)), out * _MIX + np.uint64(k))
    return out ^ (out >> np.uint64(32)), bounds


_rng = np.random.default_rng(20240501)
_XOR = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_MUL = _rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minhash(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(texts, 96) values of 16 bits; texts without grams get zeros."""
    out = np.zeros((len(bounds) - 1, HASHES), dtype=np.uint16)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        x = (hashes >> np.uint64(13)).astype(np.uint32)
        starts = bounds[:-1][full]
        for i in range(HASHES):
            out[full, i] = np.minimum.reduceat((x ^ _XOR[i]) * _MUL[i], starts).astype(np.uint16)
    return out


def needed_matches(threshold: float, tolerance: float, step: int = 24) -> dict[int, int]:
    """n -> the fewest matches among n values that keep a pair.

    P(similarity >= t | m of n) under a flat prior is P(Binomial(n + 1, t) <= m)."""
    need = {}
    for n in range(step, HASHES + 1, step):
        p, m = 0.0, -1
        while p < tolerance:
            m += 1
            p += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        need[n] = m
    return need


def forest(n: int, u: np.ndarray, v: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest reachable row of each of n rows."""
    label = np.arange(n) if label is None else label
    while len(u):
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        label = label[label]
        if (label == before).all() and (label[u] == label[v]).all():
            break
    return label


def bucket_pairs(band: np.ndarray, group: np.ndarray, side: np.ndarray, same: np.ndarray, sig: np.ndarray, need: dict[int, int]):
    """Pairs of rows (sorted by group) that pass the Bayesian test, as arrays u, v; yields bounded pieces.

    same: the row's group pairs a cell with itself; else only rows of different sides meet."""
    keys = sig.view(np.uint64)  # (rows, 24): a band is one key
    idx, k = np.arange(len(group) - 1), 0
    while len(idx):
        k += 1
        idx = idx[idx + k < len(group)]
        idx = idx[group[idx] == group[idx + k]]
        u, v = idx, idx + k
        ok = same[u] | (side[u] != side[v])
        u, v = u[ok], v[ok]
        for a in range(0, len(u), 20_000):
            yield _survivors(u[a:a + 20_000], v[a:a + 20_000], band, keys, sig, need)


def _survivors(u, v, band, keys, sig, need):
    agree = keys[u] == keys[v]
    ok = agree.argmax(axis=1) == band[u]  # the first band they share is this one
    u, v = u[ok], v[ok]
    matches, done = np.zeros(len(u), dtype=np.int32), 0
    for n, least in need.items():
        matches += (sig[u, done:n] == sig[v, done:n]).sum(axis=1)
        ok = matches >= least
        u, v, matches, done = u[ok], v[ok], matches[ok], n
    return u, v


def count_links(sets: list[np.ndarray], side: np.ndarray, same: bool, threshold: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Number of links of each set and a spanning forest's labels; exact, by an inverted index over the sets."""
    up, down = threshold  # similarity >= up / down
    size = np.array([len(s) for s in sets], dtype=np.int64)
    n = len(sets)
    owner = np.repeat(np.arange(n), size)
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(code, kind="stable")
    posting, times = owner[order], np.bincount(code)
    first = np.concatenate([[0], np.cumsum(times)])[:-1]
    bounds = np.concatenate([[0], np.cumsum(size)])
    links, label, us, vs = np.zeros(n, dtype=np.int64), np.arange(n), [], []
    for i in range(n):
        c = code[bounds[i]:bounds[i + 1]]
        c = c[times[c] > 1]
        t = times[c]
        total = int(t.sum())
        if not total:
            continue
        at = np.repeat(first[c] - np.concatenate([[0], np.cumsum(t)[:-1]]), t) + np.arange(total)
        both = np.bincount(posting[at], minlength=n)
        hit = both * (up + down) >= up * (size + size[i])
        hit &= both > 0
        hit[i] = False
        if not same:
            hit &= side != side[i]
        links[i] = int(hit.sum())
        j = np.flatnonzero(hit[:i])
        us.append(np.full(len(j), i))
        vs.append(j)
        if sum(map(len, us)) > 1_000_000:
            label, us, vs = forest(n, np.concatenate(us), np.concatenate(vs), label), [], []
    if us:
        label = forest(n, np.concatenate(us), np.concatenate(vs), label)
    return links, label


def _grouped(batches, key_columns: int):
    """Row lists of whole groups from sorted batches; the open group is carried over."""
    rest: list = []
    for batch in slices(batches):
        rows = list(zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns))))
        rest += rows
        last = rest[-1][:key_columns]
        cut = len(rest)
        while cut and rest[cut - 1][:key_columns] == last:
            cut -= 1
        if cut:
            yield rest[:cut]
            rest = rest[cut:]
    if rest:
        yield rest


def signatures(docs: DataFrame) -> DataFrame:
    """(id, text) -> id, tkey (hash of the text, tells rows of one id apart), fp, n_words, sig."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in slices(batches, 1 << 20):
            split = [t.split() for t in text_bytes(batch.column(1))]
            sig = minhash(*gram_hashes(pc.fill_null(batch.column(1), "")))
            fp = [hashlib.blake2b(b" ".join(ws), digest_size=16).digest() for ws in split]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(fp, pa.binary()), pa.array([len(ws) for ws in split], pa.int64()),
                 pa.array([s.tobytes() for s in sig], pa.binary())], names=["id", "tkey", "fp", "n_words", "sig"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text", F.xxhash64("text").alias("tkey")).mapInArrow(run, f"id {kind}, tkey long, fp binary, n_words long, sig binary")


def candidate_forest(nodes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(node, sig) -> edges (a, b) of a spanning forest of the pairs that pass the Bayesian test."""
    need = needed_matches(threshold, tolerance)

    def bands(batches):
        for batch in slices(batches):
            node = np.array(batch.column(0).to_pylist(), dtype=np.int64)
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.int64).reshape(len(node), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(node))), pa.array(keys.ravel()), pa.array(np.repeat(node, BANDS))],
                                             names=["band", "key", "node"])

    def pairs(batches):
        for rows in _grouped(batches, 4):
            band, key, a, b, side, node, raw = zip(*rows)
            sig = np.frombuffer(b"".join(raw), dtype=np.uint16).reshape(len(rows), HASHES)
            marks = np.array([*zip(band, key, a, b)], dtype=np.int64)
            group = np.concatenate([[0], np.cumsum((marks[1:] != marks[:-1]).any(axis=1))])
            same, us, vs, label = marks[:, 2] == marks[:, 3], [], [], np.arange(len(rows))
            for u, v in bucket_pairs(marks[:, 0], group, np.array(side), same, sig, need):
                us.append(u)
                vs.append(v)
                if sum(map(len, us)) > 500_000:
                    label, us, vs = forest(len(rows), np.concatenate(us), np.concatenate(vs), label), [], []
            if us:
                label = forest(len(rows), np.concatenate(us), np.concatenate(vs), label)
            at = np.flatnonzero(label != np.arange(len(rows)))
            ids = np.array(node, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(ids[label[at]])], names=["a", "b"])

    exploded = nodes.select("node", "sig").mapInArrow(bands, "band int, key long, node long")
    buckets = exploded.groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1")
    members = exploded.join(buckets.select("band", "key", F.ceil(F.col("size") / CELL).cast("int").alias("cells")), ["band", "key"])
    placed = _cell_pairs(members.join(nodes.select("node", "sig"), "node"), "node", "cells")
    n = partitions_for(nodes.sparkSession)
    ordered = (placed.select("band", "key", "cell_a", "cell_b", "cell", "node", "sig").repartition(n, "band", "key", "cell_a", "cell_b")
               .sortWithinPartitions("band", "key", "cell_a", "cell_b"))
    return ordered.mapInArrow(pairs, "a long, b long")


def _cell_pairs(rows: DataFrame, node: str, cells: str) -> DataFrame:
    """Put each row into its cell, and into every pair of cells that holds its own."""
    cell = F.pmod(F.xxhash64(node), F.col(cells)).cast("int")
    return (rows.withColumn("cell", cell).withColumn("other", F.explode(F.sequence(F.lit(0), F.col(cells) - 1)))
            .withColumn("cell_a", F.least("cell", "other")).withColumn("cell_b", F.greatest("cell", "other")))


def verified_links(docs: DataFrame, nodes: DataFrame, parts: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """(node, root) components -> per node and cell pair: node, links, root (of the verified links' forest)."""
    def run(batches):
        for rows in _grouped(batches, 3):
            at = 0
            while at < len(rows):
                end = at
                while end < len(rows) and rows[end][:3] == rows[at][:3]:
                    end += 1
                part, at = rows[at:end], end
                if len(part) > 1:
                    hashes, bounds = gram_hashes(pa.array([r[5] or "" for r in part], pa.string()))
                    sets = [np.unique(hashes[x:y]) for x, y in zip(bounds, bounds[1:])]
                    links, label = count_links(sets, np.array([r[3] for r in part]), part[0][1] == part[0][2], threshold)
                    node = np.array([r[4] for r in part], dtype=np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(links), pa.array(node[label])], names=["node", "links", "root"])

    sized = parts.join(nodes.select("node", "id", "tkey", "n_words"), "node")
    cells = sized.groupBy("root").agg(F.ceil(F.sum("n_words") / CELL_WORDS).cast("int").alias("cells"))
    placed = _cell_pairs(sized.join(cells, "root"), "node", "cells").select("root", "cell_a", "cell_b", "cell", "node", F.col("id").alias("nid"), "tkey")
    text = docs.select("id", "text", F.xxhash64("text").alias("tk"))
    joined = text.join(placed, text["id"].eqNullSafe(placed["nid"]) & (text["tk"] == placed["tkey"]))
    # rows that repeat id and text would come twice
    n = partitions_for(docs.sparkSession)
    ordered = (joined.select("root", "cell_a", "cell_b", "cell", "node", "text").repartition(n, "root", "cell_a", "cell_b")
               .sortWithinPartitions("root", "cell_a", "cell_b", "node"))

    def once(batches):
        last = None
        for batch in slices(batches):
            keys = list(zip(*(batch.column(c).to_pylist() for c in (0, 1, 2, 4))))
            fresh = [k != p for k, p in zip(keys, [last, *keys])]
            last = keys[-1]
            yield batch.filter(pa.array(fresh))

    return ordered.mapInArrow(lambda it: run(once(it)), "node long, links long, root long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: tuple[int, int] = (4, 5),
                    tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: id, class_id, rep_id, n_copies, n_links, tkey.

    class_id: smallest id of the near-duplicate group; rep_id: smallest id with the same words; n_copies: rows
    with the same words; n_links: different texts that this text is linked to."""
    src = pick(docs, id=id_col, text=text_col)
    prints = materialize(signatures(src), "signatures")
    own = F.min_by(F.struct("id", "tkey"), F.struct(F.col("id").isNull().alias("z"), "id", "tkey"))
    classes = (prints.where("n_words > 0").groupBy("fp").agg(own.alias("own"), F.count("*").alias("n_copies"), F.first("sig").alias("sig"), F.first("n_words").alias("n_words"))
               .select("fp", "own.id", "own.tkey", "n_copies", "sig", "n_words", F.monotonically_increasing_id().alias("node")))
    nodes = materialize(classes, "nodes")
    candidates = connected_components(candidate_forest(nodes, threshold[0] / threshold[1], tolerance))
    checked = materialize(verified_links(src, nodes, candidates, threshold), "links")
    links = checked.groupBy("node").agg(F.sum("links").alias("n_links"))
    groups = connected_components(checked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    rooted = nodes.select("fp", "node", "id", "n_copies").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node")).join(links, "node", "left")
    least = rooted.groupBy("root").agg(F.min("id").alias("class_id"))
    table = rooted.join(least, "root").select("fp", F.col("id").alias("rep_id"), "class_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = prints.select("id", "tkey", "n_words", "fp").join(table, "fp", "left")
    has = F.col("n_words") > 0
    return out.select(F.col("id").alias(id_col), F.when(has, F.col("class_id")).otherwise(F.col("id")).alias("class_id"),
                      F.when(has, F.col("rep_id")).otherwise(F.col("id")).alias("rep_id"),
                      F.when(has, F.col("n_copies")).otherwise(F.lit(1)).cast("long").alias("n_copies"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "tkey")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """The documents with one row of each group: the one with the smallest id (the smallest text hash among rows of one id).

    Of rows that repeat id and text one stays, also if they have no words. Other columns are kept whatever their names."""
    own = docs.columns
    docs, (id_col, text_col) = shield(docs, id_col, text_col)
    found = materialize(near_duplicates(docs, id_col, text_col, threshold), "near")
    key = F.struct(F.col(id_col).isNull().alias("z"), id_col, "tkey")
    lone = found.where((F.col("n_copies") == 1) & (F.col("n_links") == 0)).select(F.col(id_col).alias("__kid"), F.col("tkey").alias("__ktk"))
    group = found.where((F.col("n_copies") > 1) | (F.col("n_links") > 0))
    # the class id is the group's smallest id, null only where all are null
    first = (group.where(F.col(id_col).eqNullSafe(F.col("class_id"))).groupBy("class_id", F.when(F.col("class_id").isNull(), F.col("rep_id")).alias("r"))
             .agg(F.min(key).alias("k")).select(F.col(f"k.{id_col}").alias("__kid"), F.col("k.tkey").alias("__ktk")))
    keep = lone.distinct().union(first)
    marked = docs.withColumn("__mark", F.coalesce(F.xxhash64(text_col), F.lit(0)))
    out = marked.join(keep, marked[id_col].eqNullSafe(keep["__kid"]) & (marked["__mark"] == F.coalesce(keep["__ktk"], F.lit(0))))
    columns = docs.columns
    repeated = found.groupBy(id_col, "tkey").agg(F.count("*").alias("c")).where("c > 1").select(F.col(id_col).alias("__kid"), F.col("tkey").alias("__ktk"))
    twice = out.select(*columns, "__kid", "__ktk")
    plain = twice.join(repeated, twice["__kid"].eqNullSafe(repeated["__kid"]) & twice["__ktk"].eqNullSafe(repeated["__ktk"]), "left_anti").select(*columns)
    rest = twice.join(repeated, twice["__kid"].eqNullSafe(repeated["__kid"]) & twice["__ktk"].eqNullSafe(repeated["__ktk"]), "left_semi")
    return plain.union(rest.dropDuplicates(["__kid", "__ktk"]).select(*columns)).toDF(*own)
