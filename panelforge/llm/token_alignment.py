"""Cross-tokenizer alignment by whitespace-token anchors.

Both tokenizers encode the whole text. An anchor is a byte offset at which a token of A
and a token of B both begin with a space; then both also end a token there. Anchors cut a
document into windows of token ids, and a window's alignment depends on its ids alone, so
windows are aligned once per distinct pair of id tuples and remembered in the worker.

Within a window the ends of both token lists cut its bytes into elementary segments. Each
segment lies in exactly one A token and one B token, and each overlapping pair of tokens
shares exactly one segment: segments are the links, and ends that both lists have close
the groups.

Pass 1 writes per document its counts, the digest of its groups and its distinct id pairs
with multiplicities. A grouped sum of these gives the corpus-wide count of each pair and
the highest count of each B id; pass 2 looks the pairs up and adds them per document. The
lookup is broadcast if its files are small (checked) and joined by shuffling beyond that.

Defined results: texts that are null, empty, or whose token bytes differ from space+text
(a literal space mark) have no tokens: zeros and an empty digest. Repeated rows count each,
a null id stays null, an empty table gives no rows, extra columns are ignored whatever
their names.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import materialize, pick, ship, slices, small

#: aligned windows a worker remembers
CACHE = 100_000
SHIFT = 20  # bits of a pair key that hold the B id
#: characters whose letter, number and space classes are the same in every regular expression engine
PLAIN = re.compile(r"[\n\x20-\x7e\xa1-įı-ɏ]*")
_LOADED: dict = {}


class TokenizerA:
    """ids of a byte-level BPE file; special strings inside texts are plain text.

    With the same vocabulary as ranks at hand, texts of plain characters go through tiktoken, which gives the same ids."""

    def __init__(self, path: str, ranks_path: str | None, pattern: str | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        byte_of = {c: b for b, c in _byte_chars()}
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.fast = None
        if ranks_path:
            import tiktoken
            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
            if all(self.bytes[r] == t for t, r in ranks.items()):
                self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        plain = [self.fast is not None and PLAIN.fullmatch(t) is not None for t in texts]
        slow = iter(self.tok.encode_batch([t for t, p in zip(texts, plain) if not p], add_special_tokens=False)) if not all(plain) else iter(())
        return [self.fast.encode_ordinary(t) if p else next(slow).ids for t, p in zip(texts, plain)]


class TokenizerB:
    """ids of a SentencePiece model, which sets a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.sp.vocab_size()):
            piece = self.sp.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.sp.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.sp.encode(texts, num_threads=1) if texts else []


BAD = (b"", b"")


def merged(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union and intersection of two ascending lists without repeats."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    again = both[1:] == both[:-1]
    return both[np.concatenate([[True], ~again])] if len(both) else both, both[1:][again]


def written_groups(ids_a: np.ndarray, ids_b: np.ndarray, until_a: np.ndarray, until_b: np.ndarray, windows: np.ndarray) -> bytes:
    """Groups as text, those of a window joined by ; and windows by line feeds.

    Group g holds the A ids up to until_a[g] and the B ids up to until_b[g]; `windows` are the A ids up to each window's end."""
    na, nb = np.diff(until_a, prepend=0), np.diff(until_b, prepend=0)
    first = np.cumsum(na + nb) - na - nb  # where a group begins among all its ids
    ids, mark = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
    ids[np.repeat(first - (until_a - na), na) + np.arange(len(ids_a))] = ids_a
    ids[np.repeat(first + na - (until_b - nb), nb) + np.arange(len(ids_b))] = ids_b
    mark[first + na - 1] = ord("|")
    mark[first + na + nb - 1] = np.where(np.isin(until_a, windows), ord("\n"), ord(";"))
    width = len(str(int(ids.max())))
    digits = np.empty((len(ids), width + 1), np.uint8)
    left = ids.copy()
    for k in range(width - 1, -1, -1):
        left, digits[:, k] = np.divmod(left, 10)
    shown = np.ones(digits.shape, bool)
    for k in range(width - 1):
        shown[:, k] = ids >= 10 ** (width - 1 - k)
    digits[:, :width] += ord("0")
    digits[:, width] = mark
    return digits[shown][:-1].tobytes()


def _byte_chars() -> list[tuple[int, str]]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return [(b, chr(b)) for b in own] + [(b, chr(256 + k)) for k, b in enumerate(rest)]


class Aligner:
    """Aligns whole documents window by window."""

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.length = [np.array([len(t) for t in x.bytes], dtype=np.int64) for x in (a, b)]
        self.spaced = [np.array([t[:1] == b" " for t in x.bytes]) for x in (a, b)]
        self.cache: dict[bytes, tuple[bytes, bytes]] = {}

    def _align(self, windows: list[bytes]) -> list[tuple[bytes, bytes] | None]:
        """For each window its groups as text and its links as packed pair keys, all windows at once; None if its bytes differ."""
        size = np.array([len(w) for w in windows]) // 4
        buffer = np.frombuffer(b"".join(windows), dtype=np.uint32).astype(np.int64)
        at = np.cumsum(size) - size
        na = buffer[at]
        place = np.arange(len(buffer)) - np.repeat(at, size)
        side = place > np.repeat(na, size)
        ids_a, ids_b = buffer[~side & (place > 0)], buffer[side]
        nb = size - 1 - na
        ends_a, ends_b = np.cumsum(self.length[0][ids_a]), np.cumsum(self.length[1][ids_b])
        ends = merged(ends_a, ends_b)[0]  # a segment ends at each; windows end in both lists
        ia, ib = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        raw = ((ids_a[ia] << SHIFT) | ids_b[ib]).tobytes()
        shared = np.flatnonzero((ends_a[ia] == ends) & (ends_b[ib] == ends))
        until_a, until_b = np.cumsum(na), np.cumsum(nb)
        texts = written_groups(ids_a, ids_b, ia[shared] + 1, ib[shared] + 1, until_a).split(b"\n")
        edges = [0, *(8 * np.searchsorted(ends, ends_a[until_a - 1], side="right")).tolist()]
        bytes_a, bytes_b = (b"".join(map(x.bytes.__getitem__, ids.tolist())) for x, ids in ((self.a, ids_a), (self.b, ids_b)))
        out: list = [(t, raw[i:j]) for t, i, j in zip(texts, edges, edges[1:])]
        if bytes_a != bytes_b:
            cut = [0, *ends_a[until_a - 1].tolist()]
            out = [o if bytes_a[i:j] == bytes_b[i:j] else None for o, i, j in zip(out, cut, cut[1:])]
        return out

    def _windows(self, ids: list[np.ndarray], doc_ends: np.ndarray):
        """Token bounds of all windows in both lists, and the bytes at which windows begin."""
        starts = [np.concatenate([[0], np.cumsum(self.length[k][ids[k]])])[:-1] for k in (0, 1)]
        marked = [s[self.spaced[k][ids[k]]] for k, s in enumerate(starts)]
        anchors = merged(merged(*marked)[1], np.concatenate([[0], doc_ends[:-1]]))[0]
        return anchors, [np.append(np.searchsorted(s, anchors), len(s)) for s in starts]

    def align(self, texts: list[str]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, digest, pair keys, multiplicities) of each text."""
        none = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
        out = [none] * len(texts)
        full = [i for i, t in enumerate(texts) if t]
        spaced = [" " + texts[i] for i in full]
        lists = [[np.array(x, dtype=np.uint32) for x in ids] for ids in (self.a.encode(spaced), self.b.encode([texts[i] for i in full]))]
        good, size = [], []
        for j, i in enumerate(full):  # equal lengths here, equal bytes window by window
            n_bytes = len(texts[i].encode()) + 1
            if all(int(self.length[k][ids[j]].sum()) == n_bytes for k, ids in enumerate(lists)):
                good.append(j)
                size.append(n_bytes)
        if not good:
            return out
        n = [np.array([len(ids[j]) for j in good]) for ids in lists]
        ids = [np.concatenate([x[j] for j in good]) for x in lists]
        doc_ends = np.cumsum(size)
        anchors, bounds = self._windows(ids, doc_ends)
        codes, distinct = self._distinct(ids, bounds)
        cache = self.cache
        if len(cache) + len(distinct) > CACHE:
            cache.clear()
        todo = [w for w in distinct if w not in cache]
        if todo:
            cache.update(zip(todo, self._align(todo)))
        known = [cache[w] or BAD for w in distinct]
        strings = [g for g, _ in known]
        flat = np.frombuffer(b"".join(k for _, k in known), dtype=np.int64)
        sizes = np.array([len(k) // 8 for _, k in known])
        firsts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        n_links = sizes[codes]
        where = np.repeat(firsts[codes] - (np.cumsum(n_links) - n_links), n_links) + np.arange(n_links.sum())
        links = flat[where]
        first_window = np.searchsorted(anchors, np.concatenate([[0], doc_ends]))
        link_at = np.concatenate([[0], np.cumsum(n_links)])[first_window]
        wanted = codes.tolist()
        wrong = np.concatenate([[0], np.cumsum(np.array([k is BAD for k in known])[codes])])[first_window]
        for d, j in enumerate(good):
            if wrong[d + 1] > wrong[d]:
                continue
            groups = b";".join([strings[c] for c in wanted[first_window[d]:first_window[d + 1]]])
            keys, times = np.unique(links[link_at[d]:link_at[d + 1]], return_counts=True)
            out[full[j]] = (int(n[0][d]), int(n[1][d]), groups.count(b";") + 1, int(link_at[d + 1] - link_at[d]),
                            hashlib.sha256(groups).hexdigest(), keys, times)
        return out

    @staticmethod
    def _distinct(ids: list[np.ndarray], bounds: list[np.ndarray]) -> tuple[np.ndarray, list[bytes]]:
        """Windows as byte strings (number of A ids, A ids, B ids), coded by their distinct ones."""
        count = [np.diff(b) for b in bounds]
        whole = 1 + count[0] + count[1]
        at = np.cumsum(whole) - whole
        buffer = np.empty(int(whole.sum()), np.uint32)
        buffer[at] = count[0]
        for k, shift in ((0, at + 1), (1, at + 1 + count[0])):
            buffer[np.repeat(shift - bounds[k][:-1], count[k]) + np.arange(len(ids[k]))] = ids[k]
        offsets = np.append(at, len(buffer)) * 4
        column = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(buffer)])
        coded = column.dictionary_encode()
        return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def aligner(path_a: str, path_b: str, ranks: str | None, pattern: str | None) -> Aligner:
    key = (path_a, path_b, ranks)
    if key not in _LOADED:
        _LOADED[key] = Aligner(TokenizerA(path_a, ranks, pattern), TokenizerB(path_b))
    return _LOADED[key]


def _ragged(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else [], pa.int64()))


def align_documents(docs: DataFrame, path_a: str, path_b: str, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """(id, text) -> row (a number of the row), id, n_a, n_b, n_groups, n_links, groups_sha256, keys, times."""
    ship(docs.sparkSession)

    def run(batches):
        work, row = aligner(path_a, path_b, ranks, pattern), TaskContext.get().partitionId() << 33
        for batch in slices(batches, 1 << 20):
            found = work.align(batch.column(1).to_pylist())
            cols = list(zip(*found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(row, row + len(found)), pa.int64()), batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]),
                 pa.array(cols[4], pa.string()), _ragged(cols[5]), _ragged(cols[6])],
                names=["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "keys", "times"])
            row += len(found)

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(
        run, f"row long, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys array<long>, times array<long>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """key, a_id, b_id, n (links corpus-wide that hold the pair), best (n is its B id's highest)."""
    links = aligned.select(F.explode(F.arrays_zip("keys", "times")).alias("l")).select("l.keys", "l.times")
    counts = materialize(links.groupBy(F.col("keys").alias("key")).agg(F.sum("times").alias("n"))
                         .withColumn("b_id", F.col("key").bitwiseAND((1 << SHIFT) - 1)), "pair-counts")
    top = counts.groupBy("b_id").agg(F.max("n").alias("top"))
    return counts.join(top, "b_id").select("key", F.shiftright("key", SHIFT).alias("a_id"), "b_id", "n", (F.col("n") == F.col("top")).alias("best"))


def token_alignment(docs: DataFrame, path_a: str, path_b: str, ranks: str | None = None, pattern: str | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    aligned = materialize(align_documents(pick(docs, id=id_col, text=text_col), path_a, path_b, ranks, pattern), "aligned")
    lookup = materialize(pair_counts(aligned).select("key", "n", F.col("best").cast("long").alias("best")), "pair-lookup")
    links = aligned.select("row", F.explode(F.arrays_zip("keys", "times")).alias("l")).select("row", F.col("l.keys").alias("key"), "l.times")
    sums = links.join(small(lookup), "key").groupBy("row").agg(
        F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return aligned.drop("keys", "times").join(sums, "row", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
