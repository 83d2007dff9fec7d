"""The pipeline: every stage and run() against brute force on their own input, odd rows and columns with the stages' own names."""
import random
import zlib
from collections import Counter

import corpus_pipeline as cp
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from panelforge.llm import mixing, packing
from panelforge.llm.production import MIX_WEIGHTS, mixing_tree

from .conftest import EDGE
from .test_dedup_ops import brute_lines, brute_near
from .test_text_ops import brute_quality

#: names that the stages use for columns of their own
TAKEN = ["__n_words", "n_words", "failed", "__doc", "__tk", "__d", "__t", "__lines", "__removed", "__mark", "__kid", "__ktk", "__id", "__copies", "__copy",
         "__l0", "__v0", "own0", "own1", "tk", "size", "word", "id", "row", "copies"]


def texts(seed=3, n=70):
    """Prose that passes the rules, with exact and near copies and repeated lines."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghiklmnoprstuvw", k=rng.randint(2, 9))) for _ in range(900)]
    line = lambda: " ".join(rng.choices(vocabulary, k=rng.randint(9, 16))).capitalize() + "."
    shared = [line() for _ in range(4)]
    out = []
    for i in range(n):
        body = [line() for _ in range(rng.randint(7, 14))]
        if i % 5 == 0:
            body.insert(rng.randrange(len(body)), rng.choice(shared))
        if i % 9 == 8:
            body = out[i - 3].split("\n")  # a copy
        out.append("\n".join(body))
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows = [(100 + i, t) for i, t in enumerate(texts())] + [r for r in EDGE if r[0] != 5] + [(5, "one")]
    rng = random.Random(1)
    full = [(i, t, rng.choice(["en", "de", None]), rng.choice(["src0", "src1", "src2", None]), None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    for c in TAKEN:
        df = df.withColumn(c, F.concat(F.lit("own "), F.col("doc_id").cast("string")))
    path = str(tmp_path_factory.mktemp("sf"))
    df.repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def stored(spark, folder, tmp_path_factory):
    """Each stage's input and output, each written and read again, as run() does."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in cp.STAGES:
        path = str(tmp_path_factory.mktemp(name)) + "/out"
        stage(spark, docs, folder).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs, after))
        docs = after
    return dict(zip([n for n, _ in cp.STAGES], out))


def rows_of(df):
    return df.collect()


def test_stages_keep_the_columns(stored):
    for name in ("quality", "lines", "near", "mix"):
        before, after = stored[name]
        assert after.columns == before.columns and after.dtypes == before.dtypes
        for r in after.collect():
            assert all(r[c] == (None if r.doc_id is None else f"own {r.doc_id}") for c in TAKEN)


def test_quality_stage(stored):
    before, after = stored["quality"]
    kept = Counter((r.doc_id, r.text) for r in after.collect())
    assert not kept - Counter((r.doc_id, r.text) for r in before.collect())
    for r in before.collect():
        n_words, _, _, _, repeated = brute_quality(r.text)
        if n_words < 50 or 100 * repeated > 50 * n_words:
            assert (r.doc_id, r.text) not in kept
        elif r.doc_id is not None and r.doc_id >= 100:
            assert (r.doc_id, r.text) in kept  # clean prose stays


def test_lines_stage(stored):
    before, after = stored["lines"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    gone, want = brute_lines(rows), {}
    for i, t in rows:
        left = "\n".join(x for n, x in enumerate(t.split("\n")) if n not in set(gone[i]))
        if left.split() or not gone[i]:
            want[i] = (left, len(left))
    got = {r.doc_id: (r.text, r.n_chars) for r in after.collect()}
    assert got == want and any(gone.values())


def test_near_stage(stored):
    before, after = stored["near"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, c, _ in brute_near(rows)})


def test_mix_stage(stored):
    before, after = stored["mix"]
    plan = mixing.mix(before.select("doc_id", "text", "lang", "source"), mixing_tree(), cp.BUDGET_SHARE, MIX_WEIGHTS, cp.EPOCHS)
    want = Counter()
    for r in plan.collect():
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in after.collect()) == +want
    total = sum(len(r.text.split()) for r in before.collect())
    taken = sum(len(r.text.split()) for r in after.collect())
    assert 0 < taken <= 1.05 * cp.EPOCHS * total * cp.BUDGET_SHARE


def test_pack_stage(stored):
    before, after = stored["pack"]
    tok = packing.Encoder(public_tokenizers.path("word_bpe_49k.json")).tok
    want = Counter()
    for r in before.collect():
        want[r.doc_id, zlib.crc32(np.array([*tok.encode(r.text, add_special_tokens=False).ids, 2], "<u4").tobytes())] += 1
    pieces = after.orderBy("sequence_id", "offset").collect()
    at = 0
    for p in pieces:  # gapless over all sequences
        assert p.sequence_id * 4096 + p.offset == at
        at += p.length
    whole = Counter((p.doc_id, p.ids_crc32) for p in pieces if p.length == p.doc_tokens)
    assert not whole - want and sum(want.values()) == sum(p.start == 0 for p in pieces)
    assert at == sum(p.doc_tokens for p in pieces if p.start == 0)


def test_run_is_the_chain(spark, folder, stored):
    cols = ["doc_id", "start", "length", "doc_tokens"]
    total = lambda df: Counter(r.doc_id for r in df.where("start = 0").collect())
    out = cp.run(spark, folder)
    assert out.columns == stored["pack"][1].columns and set(cols) <= set(out.columns)
    assert total(out) == total(stored["pack"][1])


def test_empty_table(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
