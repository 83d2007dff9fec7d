"""Token counts of whole texts under a SentencePiece BPE model, by whole-token shortcut.

Offline, from the model file alone:

* no vocabulary piece holds the space mark after another character, and none holds a
  line feed: merges never cross such a place, so a text's tokens are those of its
  pre-tokens (a run of spaces with the word after it, or one line feed);
* every vocabulary string that encodes alone as one token is put into the shortcut
  table. A pre-token found there counts 1 without running the merges.

Only the other pre-tokens are merged, each distinct one once per task batch, by the
library itself. Both proofs are redone when a worker loads the model; a model that
breaks them is refused, never miscounted.

Defined results: null text is empty and has no tokens and no bytes; an empty table
gives an empty result; repeated rows are counted each; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import pick, ship, slices

MARK = "▁"  # the model's space mark; a literal one in a text is the same as a space
CACHE = 400_000  # merged pre-tokens a worker remembers; longer ones are not kept
_LOADED: dict = {}


class Counter:
    """Counts tokens as SentencePieceProcessor.encode does, without its special tokens."""

    def __init__(self, model: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.vocab_size())
                  if not (self.sp.is_control(i) or self.sp.is_byte(i) or self.sp.is_unknown(i))]
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces) or len(self.sp.encode("a \n b\n")) != 5:
            raise ValueError("pre-tokens of this model are not independent")
        spaced = [p.replace(MARK, " ") for p in pieces if p.startswith(MARK)]
        alone = self.sp.encode([s[1:] for s in spaced], num_threads=1)  # the model puts the first space there itself
        self.shortcut = {s: 1 for s, ids in zip(spaced, alone) if len(ids) == 1}
        self.shortcut["\n"] = self.shortcut[" "] = 1  # one byte piece; the bare mark
        self.cache: dict[str, int] = {}

    def _merge(self, todo: list[str]) -> list[int]:
        """Counts of pre-tokens: the model sets one space before each text, so it is taken off or put behind a line feed."""
        plain = [t[1:] if t[0] == " " else "\n" + t for t in todo]
        extra = [0 if t[0] == " " else 2 for t in todo]  # space mark and line feed
        return [len(ids) - x for ids, x in zip(self.sp.encode(plain, num_threads=1), extra)]

    def count_distinct(self, pretokens: list[str]) -> np.ndarray:
        known, cache = self.shortcut, self.cache
        out = [known.get(p) or cache.get(p) for p in pretokens]
        todo = [i for i, n in enumerate(out) if n is None]
        fresh = self._merge([pretokens[i] for i in todo]) if todo else []
        if len(cache) + len(todo) > CACHE:
            cache.clear()
        for i, n in zip(todo, fresh):
            out[i] = n
            if len(pretokens[i]) <= 64:
                cache[pretokens[i]] = n
        return np.array(out, dtype=np.int64)

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; texts come with one space before them, or empty."""
        texts = texts.cast(pa.large_binary())
        if texts.buffers()[2] is not None and b"\xe2\x96\x81" in memoryview(texts.buffers()[2]).tobytes():
            texts = pa.array([t.replace(MARK.encode(), b" ") for t in texts.to_pylist()], pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        if offsets[-1] == offsets[0]:
            return np.zeros(len(texts), dtype=np.int64)
        data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        feed, space = data == 10, data == 32
        first = feed.copy()
        first[1:] |= feed[:-1] | (space[1:] & ~space[:-1])
        first[offsets[:-1][offsets[:-1] < len(data)]] = True
        at = np.flatnonzero(first)
        pieces = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(np.append(at, len(data)).astype(np.int32)), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        n = self.count_distinct([p.decode("utf-8", "replace") for p in coded.dictionary.to_pylist()])
        total = np.concatenate([[0], np.cumsum(n[coded.indices.to_numpy()])])
        return np.diff(total[np.searchsorted(at, offsets)])


def counter(model: str) -> Counter:
    if model not in _LOADED:
        _LOADED[model] = Counter(model)
    return _LOADED[model]


def token_counts(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_bytes, n_tokens, over_limit. `model` is a SentencePiece file that every worker can open."""
    ship(docs.sparkSession)

    def run(batches):
        c = counter(model)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(c.count(batch.column(1)))],
                                             names=["id", "n_bytes", "n_tokens"])

    src = pick(docs, id=id_col, text=text_col)
    spaced = F.when(F.coalesce("text", F.lit("")) == "", F.lit("")).otherwise(F.concat(F.lit(" "), "text"))  # as the model puts it
    kind = src.schema["id"].dataType.simpleString()
    counted = src.select("id", spaced.alias("text"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")).mapInArrow(
        run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
