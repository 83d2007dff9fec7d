"""Personal data, cross-tokenizer alignment and whitening against brute force."""
import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.llm import pii, token_alignment, whitening
from panelforge.llm.token_alignment import Aligner, TokenizerA, TokenizerB

from .conftest import EDGE

A, B, RANKS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"))


# ------------------------------------------------------------------ personal data
def plain_spans(text):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out)


def test_base_spans_equal_plain_patterns(spark, sf_small):
    rng = random.Random(5)
    texts = ["".join(rng.choice("a1@.+ -()%é\n") for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["".join(rng.choice("0123456789 -.+") for _ in range(rng.randint(0, 80))) for _ in range(4000)]
    texts += ["a@b.c%d@e.f", "1.2.3.4.5.6.7.8", "001.02.3.0255", "x" * 300 + "@a.b", "a@b", "@a.b", "a@b..c", "4111 1111 1111 1111", "+1 (208) 555-1177"]
    texts += [r["text"] or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    for t in texts:
        assert pii.base_spans(t) == plain_spans(t), t


def test_long_words_take_linear_time():
    for t in ("x" * 400_000 + " 1", "1" * 400_000, "+1" + " " * 400_000, "a." * 200_000 + "@", "1." * 200_000, "@" * 200_000):
        pii.base_spans(t)
        pii.Graph(t, [])


def test_propagation_is_exact_on_trees():
    rng = np.random.default_rng(1)
    edges = np.array([[0, 1, 0], [1, 2, 1], [1, 3, 0], [3, 4, 1]])
    unary, pair = rng.normal(size=(6, pii.LABELS)), rng.normal(size=(2, pii.LABELS, pii.LABELS))
    node, joint = pii.propagate(unary, edges, pair)
    weights, want, want_joint = 0.0, np.zeros((6, pii.LABELS)), np.zeros((4, pii.LABELS, pii.LABELS))
    for y in itertools.product(range(pii.LABELS), repeat=6):
        w = np.exp(sum(unary[i, k] for i, k in enumerate(y)) + sum(pair[t, y[u], y[v]] for u, v, t in edges))
        weights += w
        want[range(6), y] += w
        want_joint[range(4), [y[e[0]] for e in edges], [y[e[1]] for e in edges]] += w
    assert np.allclose(np.exp(node), want / weights, atol=1e-6)
    assert np.allclose(np.exp(joint), want_joint / weights, atol=1e-6)


def test_gradient_of_the_field():
    """On a tree the learning step's direction is the slope of the exact likelihood."""
    g = [pii.Graph("Call +1 (208) 555-1177 or 7.5 now", [(5, 3, 22)])]
    feats, given, edges, _ = pii.joined(g)
    label = np.where(given < 0, pii.NONE, given)
    rng = np.random.default_rng(2)
    field = pii.Field(rng.normal(size=(pii.BUCKETS, pii.LABELS)) / 5, rng.normal(size=(2, pii.LABELS, pii.LABELS)) / 5)

    def likelihood(pair):
        score = lambda y: sum(field.unary(feats)[i, k] for i, k in enumerate(y)) + sum(pair[t, y[u], y[v]] for u, v, t in edges)
        return score(label) - np.log(sum(np.exp(score(y)) for y in itertools.product(range(pii.LABELS), repeat=len(label))))

    _, joint = pii.propagate(field.unary(feats), edges, field.pair)
    seen = np.zeros_like(field.pair)
    np.add.at(seen, (edges[:, 2], label[edges[:, 0]], label[edges[:, 1]]), 1)
    slope = seen[0] - np.exp(joint[edges[:, 2] == 0]).sum(0)
    for i, j in ((3, 3), (4, 3), (0, 1)):
        step = np.zeros_like(field.pair)
        step[0, i, j] = 1e-5
        assert abs((likelihood(field.pair + step) - likelihood(field.pair - step)) / 2e-5 - slope[i, j]) < 1e-4


def test_skip_edges_carry_a_label():
    """A number that is a phone elsewhere in the document is one here too; without the link it isn't sure."""
    field = pii.Field(pair=np.stack([np.zeros((pii.LABELS, pii.LABELS)), 4.0 * np.eye(pii.LABELS)]))
    text = "+1 (208) 555-1177 " + "word " * 500 + "555-1177. And 555-9999"
    graph = pii.Graph(text, pii.base_spans(text))
    assert (graph.edges[:, 2] == 1).sum() == 1
    at = text.index("555-1177.")
    assert field.added([graph]) == [[(at, 3, at + 8)]]


@pytest.fixture(scope="module")
def field(spark):
    return pii.fit_field(spark.read.parquet("/root/testdata/check_s/documents.parquet").select(F.col("doc_id").alias("id"), "text"))


def test_held_out_accuracy(spark, field):
    """Labels of words by the field alone, without the base spans as evidence, in documents it has not learned from."""
    docs = spark.read.parquet("/root/testdata/check_s/documents.parquet").where(F.col("text").rlike("[0-9@]") & (F.length("text") <= pii.SAMPLE_CHARS))
    rest = docs.orderBy(F.xxhash64(F.col("doc_id").cast("string"), "text")).offset(pii.SAMPLE).select("text").collect()
    texts = [r["text"] for r in rest if not pii.doubtful(r["text"])]
    assert len(texts) > 300
    graphs = [pii.Graph(t, pii.base_spans(t)) for t in texts]
    given = np.concatenate([g.given for g in graphs])
    right = field.beliefs(graphs, use_given=False).argmax(1) == np.where(given < 0, pii.NONE, given)
    assert right.mean() > 0.98
    assert all(right[given == k].mean() > 0.95 for k in range(4))


def test_field_adds_what_the_patterns_run_over(spark, field, make_docs):
    t = "Elle +1 (569) 555-6633 4795326016703902 chtion"
    docs = make_docs([(1, t), (2, "clean words only"), (3, "version 3. of 4.0.")] + EDGE[:4])
    got = {r["doc_id"]: r for r in pii.personal_data(docs, field).collect()}
    assert got[1]["base"] == "" and got[1]["spans"] == f"phone:5:22,card:23:{23 + 16}"
    assert all(r["spans"] == r["base"] for i, r in got.items() if i != 1)


def test_personal_data_on_odd_rows(spark, make_docs):
    rows = EDGE + [(20, "a@b.cc 1.2.3.4, 4111 1111 1111 1111 é+1 (208) 555-1177"), (20, "a@b.cc 1.2.3.4, 4111 1111 1111 1111 é+1 (208) 555-1177")]
    docs = make_docs(rows, clashing=True).withColumn("base", F.lit(1)).withColumn("spans", F.lit(1)).withColumn("n_ip", F.lit(1))
    got = sorted((str(r["doc_id"]), r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base"]) for r in pii.personal_data(docs).collect())
    want = []
    for i, t in rows:
        b = plain_spans(t or "")
        want.append((str(i), *(sum(k == w for _, k, _ in b) for w in range(4)), ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in b)))
    assert got == sorted(want)
    assert pii.personal_data(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ alignment
@pytest.fixture(scope="module")
def aligner():
    return Aligner(TokenizerA(A, RANKS, public_tokenizers.PATTERN), TokenizerB(B))


def brute(texts):
    """Every pair of tokens compared by byte ranges; then corpus counts."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    a, b = TokenizerA(A, None, None), TokenizerB(B)
    docs, count = [], Counter()
    for t in texts:
        ids = [tok.encode(" " + t, add_special_tokens=False).ids, b.sp.encode(t)] if t else [[], []]
        raw = [[x.bytes[i] for i in y] for x, y in zip((a, b), ids)]
        if not t or any(b"".join(r) != b" " + t.encode() for r in raw):
            docs.append(None)
            continue
        ends = [list(itertools.accumulate(map(len, r))) for r in raw]
        links, first = [], 0
        for i, (e, piece) in enumerate(zip(ends[0], raw[0])):
            while ends[1][first] <= e - len(piece):
                first += 1
            j = first
            while j < len(ends[1]) and ends[1][j] - len(raw[1][j]) < e:
                links.append((ids[0][i], ids[1][j]))
                j += 1
        groups, pa, pb = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            qa, qb = ends[0].index(e, pa) + 1, ends[1].index(e, pb) + 1
            groups.append(",".join(map(str, ids[0][pa:qa])) + "|" + ",".join(map(str, ids[1][pb:qb])))
            pa, pb = qa, qb
        docs.append((len(ids[0]), len(ids[1]), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        count.update(links)
    top = {}
    for (_, j), c in count.items():
        top[j] = max(top.get(j, 0), c)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (d[0], d[1], d[2], len(d[3]), sum(count[x] == top[x[1]] for x in d[3]), sum(count[x] for x in d[3]), d[4]) for d in docs]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("lookup", ["small", "large"])
def test_alignment_equals_all_pairs(spark, sf_small, make_docs, monkeypatch, lookup):
    if lookup == "large":
        monkeypatch.setattr(token_alignment, "small", lambda df: df.hint("merge"))
    rows = EDGE + [(30, "a ▁ literal mark"), (31, "  two  spaces\t\ttabs\r\n\n é ½ ªº 漢字 😀 \x7f\x00"), (32, " 1 234 567,89"), (33, "don't I'LL we've"), (34, "\u0085  x")]
    rows += [(100 + r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").where("length(text) < 4000").limit(120).collect()]
    docs = make_docs(rows, clashing=True).withColumn("keys", F.lit(1)).withColumn("row", F.lit(1)).withColumn("n_a", F.lit(1))
    got = token_alignment.token_alignment(docs, A, B, RANKS, public_tokenizers.PATTERN).collect()
    want = brute([t for _, t in rows])
    assert sorted((str(r["doc_id"]), *(r[c] for c in COLUMNS)) for r in got) == sorted((str(i), *w) for (i, _), w in zip(rows, want))


def test_windows_are_remembered_and_forgotten(aligner, monkeypatch, spark, sf_small):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").limit(40).collect()]
    want = [x[:5] for x in aligner.align(texts)]
    assert aligner.cache and want == [x[:5] for x in aligner.align(texts)]
    monkeypatch.setattr(token_alignment, "CACHE", 1)
    assert want == [x[:5] for x in aligner.align(texts)]


def test_ranks_give_the_ids_of_the_file(spark, sf_small):
    texts = [" " + r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect() if r["text"]]
    rng = random.Random(3)
    pool = [chr(c) for c in [10, *range(32, 127), *range(0xA1, 0x250)] if c not in (0x130,)]
    texts += ["".join(rng.choice(pool) for _ in range(80)) for _ in range(3000)]
    texts += ["".join(rng.choice("aZ9 \n'st.ªº²½") for _ in range(60)) for _ in range(3000)] + ["<|endoftext|> a<|endoftext|>"]
    assert TokenizerA(A, RANKS, public_tokenizers.PATTERN).encode(texts) == TokenizerA(A, None, None).encode(texts)


def test_alignment_of_no_rows(make_docs):
    assert token_alignment.token_alignment(make_docs([(1, "a")]).limit(0), A, B).count() == 0
    got = token_alignment.token_alignment(make_docs([(1, None), (2, "")]), A, B).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


# ------------------------------------------------------------------ whitening
VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("x", T.StringType())])


def whitened_by_numpy(vectors, k):
    x = np.floor(np.asarray(vectors, dtype=np.float64) * 64).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = (n * fit - s) / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return n, ((n * x - s) ** 2).sum(1), (n * x - s) / n @ q / np.sqrt(e), e / (c * c).sum() * n


def test_whitening_equals_the_dense_eigenproblem(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    df = df.unionByName(df.limit(7)).repartition(3)
    got = whitening.whiten(df).toPandas()
    rows = sorted(df.collect(), key=lambda r: r["vec_id"])
    n, deviation, w, share = whitened_by_numpy([r["embedding"] for r in rows], 16)
    p = got.sort_values(["vec_id", "component"])
    assert len(p) == 16 * len(rows) and (p.n == n).all() and p.identity_error.max() < 1e-12 and p.residual.max() < 2e-14
    assert sorted(p[p.component == 1].deviation) == sorted(deviation.tolist())
    ids = np.array([r["vec_id"] for r in rows])
    for j in range(16):
        mine = p[p.component == j + 1].groupby("vec_id").whitened.first()[ids].to_numpy()
        assert np.abs(mine * np.sign(mine @ w[:, j]) - w[:, j]).max() < 1e-9
        assert np.allclose(p[p.component == j + 1].explained, share[j], rtol=1e-12)


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 3), float(i % 5), 0.5], "x") for i in range(20)]
    odd = [(50, None, "x"), (51, [], "x"), (52, [1.0, None, 2.0], "x"), (53, [nan, 1.0, 1.0], "x"), (54, [inf, 1.0, 1.0], "x"), (55, [1.0], "x"), (56, [3e30, 0.0, 0.0], "x")]
    df = spark.createDataFrame(good + odd + [(None, [1.0, 1.0, 0.5], None), good[0]], VECTORS).withColumn("id", F.lit(1)).withColumn("n", F.lit(1)).withColumn("vec", F.lit(1))
    got = whitening.whiten(df).toPandas()
    assert len(got) == 22 * 2 and set(got.component) == {1, 2} and set(got.n) == {15}  # the third column is constant
    n, deviation, w, _ = whitened_by_numpy([g[1] for g in good], 2)
    first = got[got.vec_id.notna()].drop_duplicates(["vec_id", "component"]).sort_values(["vec_id", "component"])
    assert first[first.component == 1].deviation.tolist() == deviation.tolist()
    assert np.allclose(np.abs(first.whitened.to_numpy().reshape(-1, 2)), np.abs(w))


def test_whitening_without_variance(spark):
    for rows in ([], [(1, [1.0, 2.0], "x")], [(1, [1.0, 2.0], "x"), (2, [1.0, 2.0], "x")], [(1, None, "x")]):
        got = whitening.whiten(spark.createDataFrame(rows, VECTORS))
        assert got.columns[:4] == ["vec_id", "component", "n", "deviation"] and got.count() == 0


@pytest.mark.parametrize("d,wanted", [(1, 16), (5, 16), (40, 3), (300, 10), (300, 16)])
def test_jacobi_davidson_with_restarts(d, wanted):
    rng = np.random.default_rng(d)
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    e = np.sort(np.concatenate([np.linspace(5, 9, min(d, 20)), rng.uniform(0, 4.9, d)[: d - min(d, 20)]]))[::-1]
    v = (q * e) @ q.T
    v = (v + v.T) / 2
    got, u, residual = whitening.jacobi_davidson(lambda b: v @ b, d, wanted)
    k = min(d, wanted)
    assert np.allclose(got, e[:k], rtol=1e-13) and residual < 2e-14
    assert np.allclose(np.abs((u * q[:, :k]).sum(0)), 1, atol=1e-12)
    assert np.allclose(u.T @ u, np.eye(k), atol=1e-13)


def test_jacobi_davidson_with_equal_values():
    d, rng = 60, np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    e = np.array([3.0] * 5 + [2.0] * 20 + [0.0] * 35)
    v = (q * e) @ q.T
    got, u, _ = whitening.jacobi_davidson(lambda b: (v + v.T) @ b / 2, d, 12)
    assert np.allclose(got, e[:12], rtol=1e-12) and np.allclose(v @ u, u * got, atol=1e-13)


def test_large_entries_stay_exact(spark):
    rows = [(1, [1e9, 0.0], "x"), (2, [-1e9, 64.0], "x"), (3, [1e9, 3.0], "x")]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(spark.createDataFrame(rows, VECTORS)).where("component = 1").collect()}
    x = [[int(np.floor(np.float64(np.float32(c)) * 64)) + 1_000_000 for c in v] for _, v, _ in rows]
    s = [sum(c) for c in zip(*x)]
    want = [sum((3 * c - t) ** 2 for c, t in zip(v, s)) for v in x]
    assert got == {i + 1: w if w < 1 << 63 else None for i, w in enumerate(want)}
