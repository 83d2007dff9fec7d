"""Packing by concatenate and cut.

Pass 1 encodes every text, appends the end id and writes the ids once, with the running
total of ids before each document within its partition. The totals of the partitions
(one small row each) are summed up over the partitions in order; that prefix sum plus the
running total is a document's global offset. Pass 2 cuts at every multiple of the window:
piece k of a document lies in sequence ``offset div window``. A document that crosses a
window's boundary gives one piece on each side. Only the last sequence needs padding.

Encoding is that of the tokenizer file: the distinct words of a slice of text are encoded together, as arrays, and put in
place by their numbers.

Defined results: null text is empty and gives its end id alone; an empty table gives no
pieces; repeated rows are packed each; extra columns are ignored; the last sequence is
padded to the window unless its length is a power of two already.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import cut_words, materialize, pick, ship, slices

END_ID = 2
_LOADED: dict = {}


#: words of these characters only are merged by the fast engine: no controls, no white space, nothing that NFC changes
PLAIN = r"^[\x21-\x7e\x{a1}-\x{12f}\x{131}-\x{24f}]+$"


class Encoder:
    """ids of whole texts, equal to Tokenizer.encode(text, add_special_tokens=False).ids.

    The tokenizer drops white space and never merges across it, so ids of a text are those
    of its words one after another. Distinct words are encoded many at once. Plain words go to
    tiktoken's merge loop under the same vocabulary: byte 0 stands for the end of a word,
    and since the file's ids follow the order of its merges (checked), an id is its rank.
    All other words go to the tokenizer itself."""

    def __init__(self, path: str):
        import json
        import os

        import regex
        import tiktoken
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        made = [vocab["".join(m)] for m in merges]
        special = {t["id"] for t in spec["added_tokens"]}
        if made != sorted(made) or made[0] != 512 or max(vocab.values()) >= 1 << 16:
            raise ValueError("ids of this tokenizer don't follow its merges")
        chars = pre_tokenizers.ByteLevel.alphabet()
        byte_of = {c: bytes([b]) for b, c in _byte_chars(chars)}
        ranks = {}
        for token, i in vocab.items():
            if i not in special:
                end = token.endswith("</w>") and len(token) > 4
                ranks[b"".join(byte_of[c] for c in (token[:-4] if end else token)) + (b"\0" if end else b"")] = i
        self.cut = ranks[b"\1"]
        self.fast = tiktoken.Encoding("words", pat_str="\\x01|[^\\x00\\x01]+\\x00", mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        flat, lengths = [np.zeros(0, "<u2")], [np.zeros(0, np.int64)]
        for at in range(0, len(words), 20_000):
            part = words.slice(at, 20_000)
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part), "\n")[0].as_py()
            marked = self.split.sub("\\g<0>\0", text.lower()).replace("\n", "\1")
            ids = self.fast.encode_to_numpy(marked, disallowed_special=()).astype("<u2")
            own = ids != self.cut
            ends = np.flatnonzero(~own)
            if len(ends) != len(part) - 1:
                raise ValueError("words were not kept apart")
            flat.append(ids[own])
            lengths.append(np.diff(np.concatenate([[-1], ends, [len(ids)]])) - 1)
        return np.concatenate(flat), np.concatenate(lengths)

    def ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """16-bit ids of words (binary, without white space), one after another, and their numbers."""
        text = words.cast(pa.string())
        plain = pc.and_not(pc.match_substring_regex(text, PLAIN), pc.match_substring(text, "<|")).to_numpy(zero_copy_only=False)
        some, counts = self._plain(text.filter(pa.array(plain)))
        others = [np.array(self.tok.encode(w, add_special_tokens=False).ids, "<u2") for w in text.filter(pa.array(~plain)).to_pylist()]
        lengths = np.zeros(len(words), np.int64)
        lengths[plain], lengths[~plain] = counts, list(map(len, others))
        flat, mine = np.empty(lengths.sum(), "<u2"), np.repeat(plain, lengths)
        flat[mine], flat[~mine] = some, np.concatenate([np.zeros(0, "<u2"), *others])
        return flat, lengths

    def column(self, texts: pa.Array, end: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
        """16-bit ids of a string column, one text after another, each with the ids of ``end`` at its close, and the texts' bounds in them."""
        words, at, _, offsets = cut_words(pc.fill_null(texts, ""))
        coded = words.dictionary_encode()
        flat, lengths = self.ids(coded.dictionary)
        first = np.concatenate([np.cumsum(lengths) - lengths, [len(flat)]])
        flat, lengths = np.append(flat, np.array(end, "<u2")), np.append(lengths, len(end))
        row = np.searchsorted(at, offsets)  # bounds of the texts among the words
        token = np.full(len(words) + len(texts), len(lengths) - 1)  # the end closes each text
        token[np.arange(len(words)) + np.repeat(np.arange(len(texts)), np.diff(row))] = coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(lengths[token])])
        ids = flat[np.repeat(first[token] - ends[:-1], lengths[token]) + np.arange(ends[-1])]
        return ids, ends[row + np.arange(len(row))]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 16-bit ids of each text."""
        ids, bounds = self.column(pa.array(texts, pa.binary()).cast(pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]


def _byte_chars(alphabet: list[str]) -> list[tuple[int, str]]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [b for b in range(256) if chr(b) in set(alphabet)]
    rest = [b for b in range(256) if b not in own]
    return [(b, chr(b)) for b in own] + [(b, chr(256 + k)) for k, b in enumerate(rest)]


def encoder(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(id, text) -> id, part, before (ids before it in its part), n_ids, ids (16-bit, with the end id)."""
    ship(docs.sparkSession)

    def run(batches):
        enc, part, before = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in slices(batches, 2 << 20):
            ids, bounds = enc.column(batch.column(1), (end_id,))
            starts = before + bounds[:-1]
            before += int(bounds[-1])
            raw = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((2 * bounds).astype(np.int32)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(batch.num_rows, part)), pa.array(starts), pa.array(np.diff(bounds)), raw],
                names=["id", "part", "before", "n_ids", "ids"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, f"id {kind}, part long, before long, n_ids long, ids binary")


def global_offsets(encoded: DataFrame) -> DataFrame:
    """Add `at`, the ids before each document over all partitions.

    The broadcast side has one row of 16 bytes for each partition of the input scan."""
    totals = encoded.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return encoded.join(F.broadcast(totals.select("part", before.alias("part_at"))), "part").withColumn("at", F.col("part_at") + F.col("before"))


def cut_pieces(placed: DataFrame, window: int, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document; with_ids adds the piece's ids themselves."""
    def run(batches):
        for batch in slices(batches):
            rows = []
            for i, at, n, raw in zip(*(batch.column(c).to_pylist() for c in range(4))):
                ids = np.frombuffer(raw, "<u2").astype("<u4")
                start = 0
                while start < n:
                    seq, off = divmod(at + start, window)
                    length = min(n - start, window - off)
                    piece = ids[start:start + length].tobytes()
                    rows.append((i, start, length, zlib.crc32(piece), n, seq, off, piece if with_ids else None))
                    start += length
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], batch.schema.field(0).type), *(pa.array(c, pa.int64()) for c in cols[1:7]), pa.array(cols[7], pa.binary())],
                names=["id", "start", "length", "ids_crc32", "n_ids", "sequence_id", "offset", "ids"])

    kind = placed.schema["id"].dataType.simpleString()
    return placed.select("id", "at", "n_ids", "ids").mapInArrow(
        run, f"id {kind}, start long, length long, ids_crc32 long, n_ids long, sequence_id long, offset long, ids binary")


def pack(docs: DataFrame, tokenizer: str, window: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    encoded = materialize(encode_documents(pick(docs, id=id_col, text=text_col), tokenizer), "ids")
    pieces = cut_pieces(global_offsets(encoded), window)
    return pieces.select(F.col("id").alias(id_col), "start", "length", "ids_crc32", F.col("n_ids").alias("doc_tokens"), "sequence_id", "offset")


def sequences(docs: DataFrame, tokenizer: str, window: int = 4096, pad_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed sequences: sequence_id, ids (array of int, at most `window`), n_ids before padding.

    A group is one window, so it holds at most `window` pieces."""
    encoded = materialize(encode_documents(pick(docs, id=id_col, text=text_col), tokenizer), "ids")
    pieces = cut_pieces(global_offsets(encoded), window, with_ids=True)
    joined = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))

    def run(batches):
        for batch in slices(batches):
            out, lengths = [], []
            for parts in batch.column(1).to_pylist():
                ids = np.frombuffer(b"".join(p["ids"] for p in parts), "<u4").astype(np.int32)
                n = len(ids)
                lengths.append(n)
                out.append(ids if n & (n - 1) == 0 else np.pad(ids, (0, window - n), constant_values=pad_id))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int32())), pa.array(lengths, pa.int64())],
                                             names=["sequence_id", "ids", "n_ids"])

    return joined.mapInArrow(run, "sequence_id long, ids array<int>, n_ids long")
