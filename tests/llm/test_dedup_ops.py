"""Exact dedup, n-gram join and line dedup against brute force on small tables."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import EDGE
from panelforge.llm import common, exact_dedup, line_dedup, ngram_join
from panelforge.llm.components import connected_components

WORDS = [f"w{i}" for i in range(400)]


def corpus(seed, n=60):
    """Texts with exact copies, near copies, shared and nearly shared lines, common words."""
    rng = random.Random(seed)
    lines = [" ".join(rng.choices(WORDS, k=rng.randint(1, 30))) for _ in range(40)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.2:
            texts.append(rng.choice(texts))
        elif texts and kind < 0.5:
            words = rng.choice(texts).split(" ")
            for _ in range(max(1, len(words) // 60)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            texts.append(" ".join(words))
        else:
            own = [" ".join(rng.choices(WORDS, k=rng.randint(1, 40))) for _ in range(rng.randint(1, 6))]
            texts.append("\n".join(own + rng.sample(lines, rng.randint(0, 3))))
    return list(enumerate(texts))


# ---- exact dedup ---------------------------------------------------------------------

def test_fingerprints_compose():
    rng = random.Random(3)
    for _ in range(50):
        a, b = (bytes(rng.choices(range(256), k=rng.randint(0, 300))) for _ in range(2))
        assert exact_dedup.combine(exact_dedup.chunk_hash(a), exact_dedup.chunk_hash(b), len(b)) == exact_dedup.chunk_hash(a + b)
    assert exact_dedup.chunk_hash(b"\0") != exact_dedup.chunk_hash(b"\0\0")


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups["".join(c for c in (t or "") if c not in " \t\n\x0b\x0c\r")].append((i, len(t or "")))
    out = []
    for members in groups.values():
        best = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        out += [(i, best[0], len(members)) for i, _ in members]
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [EDGE, corpus(1), [(1, "ab" * 80_000), (2, "ab " * 80_000), (3, "ab" * 79_999 + "ac")]])
def test_exact_dedup_is_brute_force(make_docs, rows):
    got = exact_dedup.exact_dedup(make_docs(rows, clashing=True)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in got], key=str) == brute_exact(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got})


def test_colliding_fingerprints_are_taken_apart(make_docs, monkeypatch):
    weak = lambda d: d.withColumn("f1", d["f1"] * 0).withColumn("f2", d["f2"] * 0)
    real = exact_dedup.combine_chunks
    monkeypatch.setattr(exact_dedup, "combine_chunks", lambda c: weak(real(c)))
    rows = [(1, "abc"), (2, "a b c"), (3, "xyz"), (4, "xyw"), (5, "xyz")]
    got = exact_dedup.exact_dedup(make_docs(rows)).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == brute_exact(rows)


# ---- n-gram join ---------------------------------------------------------------------

def grams(text):
    w = (text or "").split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_near(rows):
    sets = [grams(t) for _, t in rows]
    words = [tuple((t or "").split()) for _, t in rows]
    links = [{words[j] for j in range(len(rows)) if words[j] != words[i] and sets[i] & sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])} for i in range(len(rows))]
    group = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if words[i] and (words[i] == words[j] or words[j] in links[i]):
                    group[i] = group[j] = min(group[i], group[j])
    least = {}
    for g, (i, _) in zip(group, rows):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    return sorted(((i, least[g], len(n)) for (i, _), g, n in zip(rows, group, links)), key=str)


@pytest.mark.parametrize("rows", [EDGE, corpus(2), corpus(5, 90)])
def test_near_duplicates_are_brute_force(make_docs, rows):
    got = ngram_join.near_duplicates(make_docs(rows, clashing=True)).collect()
    assert sorted([(r.doc_id, r.class_id, r.n_links) for r in got], key=str) == brute_near(rows)


def test_cells_lose_no_link(make_docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "CELL", 4)
    monkeypatch.setattr(ngram_join, "CELL_WORDS", 300)
    base = random.Random(1).choices(WORDS, k=120)
    rows = [(i, " ".join([*base[:-1], f"end{i}"])) for i in range(25)] + [(100, " ".join(reversed(base)))]
    got = ngram_join.near_duplicates(make_docs(rows)).collect()
    assert sorted([(r.doc_id, r.class_id, r.n_links) for r in got], key=str) == brute_near(rows)


def test_keep_one_keeps_one_of_each_group(make_docs):
    rows = corpus(2) + [(0, "repeated row of five words")] * 2
    docs = make_docs(rows)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {r.class_id for r in ngram_join.near_duplicates(docs).collect()}
    assert kept.count() >= len(groups) and {r.doc_id for r in kept.collect()} >= groups
    assert ngram_join.keep_one(make_docs(corpus(2))).count() == len({c for _, c, _ in brute_near(corpus(2))})


def test_keep_one_keeps_repeated_rows_without_words(make_docs):
    rows = [(1, None), (1, None), (2, ""), (2, ""), (2, ""), (3, " \n"), (3, " \n"), (None, " "), (None, " "), (4, ""), (4, None), (5, "some words"), (5, "some words")]
    got = sorted(((r.doc_id, r.text) for r in ngram_join.keep_one(make_docs(rows)).collect()), key=str)
    assert got == sorted(set(rows), key=str)


def test_bayesian_bound_falls_with_the_tolerance():
    strict, loose = ngram_join.needed_matches(0.8, 1e-2), ngram_join.needed_matches(0.8, 1e-8)
    assert list(strict) == [24, 48, 72, 96] and all(loose[n] < strict[n] < 0.8 * n for n in strict)


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (7, 7), (200, 201), (202, 201)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 200: 200, 201: 200, 202: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- line dedup ----------------------------------------------------------------------

def brute_lines(rows):
    lines, out = [], {}
    for i, t in sorted(((i, t) for i, t in rows if t is not None), key=lambda r: (r[0] is None, r[0] or 0)):
        gone = []
        for no, line in enumerate(t.split("\n")):
            s = frozenset(line.encode().split())
            if s:
                if any(9 * len(s & o) >= 4 * (len(s) + len(o)) for o in lines):
                    gone.append(no)
                lines.append(s)
        out[i] = gone
    return out


@pytest.mark.parametrize("rows", [[r for r in EDGE if r not in [(5, "one")]] + [(5, "one")], corpus(4), corpus(6, 90)])
def test_line_dedup_is_brute_force(make_docs, rows):
    docs = make_docs(rows, clashing=True)
    left = line_dedup.remove_lines(docs)
    assert left.columns == [*docs.columns, "__lines", "__removed"]
    want, texts = brute_lines(rows), dict(rows)
    for r in left.collect():
        if r.text is None:
            assert texts[r.doc_id] is None and r["__lines"] == 0
            continue
        gone = want[r.doc_id]
        assert list(r["__removed"]) == gone
        assert r.text == "\n".join(x for n, x in enumerate(texts[r.doc_id].split("\n")) if n not in set(gone))


@pytest.mark.parametrize("bits", [64, 1 << 22])
def test_lines_beyond_the_first_candidates(make_docs, monkeypatch, bits):
    """With one candidate a word and bitmaps that let all pairs pass, lost lines are found by the second search, also if its sieve lets all words pass."""
    monkeypatch.setattr(line_dedup, "FIRST", 1)
    monkeypatch.setattr(line_dedup, "SIEVE", bits)
    rng = random.Random(8)
    base = rng.sample(WORDS, 50)
    rows = [(i, " ".join([*base[:38], *rng.sample(WORDS, 12)])) for i in range(30)] + [(90 + i, " ".join([*base[:46], f"x{i}"])) for i in range(4)]
    rows += [(200 + i, rows[i][1]) for i in range(4)]  # their copies meet the second search too and must not be named twice
    got = {r.doc_id: list(r.removed_lines) for r in line_dedup.line_dedup(make_docs(rows)).collect()}
    assert got == brute_lines(rows)


def test_line_in_a_third_of_the_documents(make_docs, monkeypatch):
    """Equal lines are pre-aggregated in the slices and collapsed while a bucket is read; few rows of them reach a task."""
    monkeypatch.setattr(line_dedup, "HELD", 50)
    monkeypatch.setattr(line_dedup, "FLUSH", 40)
    rng = random.Random(21)
    hot, near = "the one line of many", " ".join(WORDS[:20])
    rows = []
    for i in range(240):
        lines = [" ".join(rng.sample(WORDS, 15)), hot if i % 3 == 0 else f"own{i} alone{i}"]
        if i % 4 == 1:
            lines.append(" ".join([*WORDS[:19], f"v{i}"]) if i % 8 == 1 else near)
        rows.append((i, "\n".join(lines)))
    docs = make_docs(rows)
    got = {r.doc_id: list(r.removed_lines) for r in line_dedup.line_dedup(docs).collect()}
    assert got == brute_lines(rows)
    texts = line_dedup._texts(docs.coalesce(1), "doc_id", "text")
    blocks = line_dedup.listed(texts, docs.sparkSession.sparkContext.broadcast([])).toPandas()
    listed = sum(len(b) // 72 for b in blocks[blocks.kind == 1].rows)
    copies = sum(len(b) // 32 for b in blocks[blocks.kind == 2].rows)
    distinct = {frozenset(x.split()) for _, t in rows for x in t.split("\n")}
    assert listed == sum(len(x) - -(-4 * len(x) // 5) + 1 for x in distinct) and copies == sum(t.count("\n") + 1 for _, t in rows) - len(distinct)


def test_words_of_is_split():
    rng = random.Random(2)
    for _ in range(300):
        texts = ["".join(rng.choices("a b\n\tcé\r\x0b", k=rng.randint(0, 12))) for _ in range(rng.randint(1, 5))]
        words, row, number, line = common.words_of(pa.array(texts))
        want = [(i, n, w) for i, t in enumerate(texts) for n, part in enumerate(t.encode().split(b"\n")) for w in part.split()]
        assert list(zip(row.tolist(), number.tolist(), words.to_pylist())) == want
        assert (np.diff(line) >= 0).all() and len(set(line.tolist())) == len({(i, n) for i, n, _ in want})


@pytest.mark.parametrize("run", [exact_dedup.exact_dedup, ngram_join.near_duplicates, ngram_join.keep_one, line_dedup.line_dedup])
def test_empty_table(make_docs, run):
    assert run(make_docs([])).count() == 0


def test_lines_of_a_text_are_picked_from_one_split(spark):
    """A text is split before its lines are picked, not once for each of them; lines are counted and removed as a split would."""
    texts = ["a\nb\n\nc", "", "\n", "x", "é\n\r\n z \n"]
    df = spark.createDataFrame([(i, t, list(range(t.count("\n") + 1))) for i, t in enumerate(texts)], "i int, text string, nos array<int>")
    got = df.select("i", line_dedup._lines_at("text", "nos").alias("at")).collect()
    assert {r["i"]: [tuple(x) for x in r["at"]] for r in got} == {i: list(enumerate(t.split("\n"))) for i, t in enumerate(texts)}
    out = {r["doc_id"]: r for r in line_dedup.line_dedup(df.selectExpr("cast(i as long) doc_id", "text")).collect()}
    assert {i: r["n_lines"] for i, r in out.items()} == {i: t.count("\n") + 1 for i, t in enumerate(texts)}
    plan = line_dedup.remove_lines(df.selectExpr("cast(i as long) doc_id", "text"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_loose_sieve_passes_the_same_rows():
    """Words are held against the sieve by their hashes first, those left by their places: the rows are those of the places alone."""
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(400)]
    texts = pa.array(["\n".join(" ".join(rng.choice(words, 6)) for _ in range(5)) for _ in range(60)])
    doc, tk = np.arange(60), np.zeros(60, dtype=np.int32)
    order = line_dedup.Order([w.encode() for w in words[:100]])
    for picked in (words[3:5] + words[300:303], words[300:301], words[7:8], ["absent"]):
        sieve = np.zeros(4096, dtype=np.uint64)
        at = line_dedup.sieve_place(order.of(pa.array([w.encode() for w in picked])), 64 * len(sieve))
        np.bitwise_or.at(sieve, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        want = line_dedup.line_rows(doc, tk, texts, order, sieve)
        got = line_dedup.line_rows(doc, tk, texts, order, sieve, order.loose(sieve))
        assert (got is None) == (want is None)
        assert got is None or all(np.array_equal(a, b) for a, b in zip(got, want))


def test_words_are_hashed_where_they_stand(monkeypatch):
    """Word spans are the words of cut_words; equal words have equal hashes, others don't; lines are listed without copies of their words."""
    rng = random.Random(6)
    texts = ["".join(rng.choices("ab \n\té\r\x00漢", weights=[6, 6, 2, 1, 1, 2, 1, 1, 2], k=rng.choice([0, 1, 30, 900]))) for _ in range(200)] + ["x" * 5000, "x" * 5001, "x" * 8 + "y", "x" * 8]
    seen = {}
    for column in (pa.array(texts), pa.array(texts).slice(7, 90), pa.array([" ", ""]), pa.array([], pa.string())):
        words, first, _, _ = common.cut_words(column)
        at, n, data, _ = common.word_spans(column)
        assert at.tolist() == first.tolist() and [bytes(data[a:a + k]) for a, k in zip(at, n)] == words.to_pylist()
        hashed = line_dedup.hashes(at, n, data).tolist()
        assert all(seen.setdefault(w, h) == h for w, h in zip(words.to_pylist(), hashed))
        assert line_dedup.Order([]).of(words).tolist() == hashed
    assert len(set(seen.values())) == len(seen)
    order = line_dedup.Order([b"b", b"a"])
    assert order.of(pa.array([b"a", b"c", b"b"]))[[2, 0]].tolist() == [1 << 62, (1 << 62) + 1]

    def copied(*_):
        raise AssertionError("words were copied")

    monkeypatch.setattr(common, "cut_words", copied)
    rows, copies = line_dedup.line_rows(np.arange(2), np.zeros(2, dtype=np.int32), pa.array(["a b c d e\nx", "e d c b a\ny z"]), order)
    assert copies.tolist() == [[1, 0, 0, 0]] and len(rows) == 4 and len(set(rows[:, 0].tolist())) == 4


def test_counted_words_are_ranked(make_docs, monkeypatch):
    """Words that repeat in a slice are counted by their hashes, also if a task hands its counts on early; the frequent ones are ranked rarest first."""
    monkeypatch.setattr(line_dedup, "COUNTED", 4)
    docs = make_docs([(i, "a b b c c c d" + " e" * i) for i in range(6)]).coalesce(1)
    words = [w.encode() for w in "abcde"]
    place = dict(zip(line_dedup.Order.hashed(pa.array(words)).tolist(), "abcde"))
    counts = line_dedup.word_counts(docs)
    assert {place[r["word"]]: r["n"] for r in counts.collect()} == {"a": 6, "b": 12, "c": 18, "d": 6, "e": 15}
    ranked = [place[x] for x in line_dedup.frequent_words(counts).tolist()]
    assert set(ranked[:2]) == {"a", "d"} and ranked[2:] == ["b", "e", "c"]


@pytest.mark.parametrize("together", [1, 1 << 16])
def test_pairs_of_a_long_list(monkeypatch, together):
    """All pairs of lines under a word that sizes, places and bitmaps let pass, however many are compared at once."""
    monkeypatch.setattr(line_dedup, "TOGETHER", together)
    rng = random.Random(12)
    sets = [sorted(rng.sample(range(30), rng.randint(3, 28))) for _ in range(150)]
    texts = pa.array([" ".join(f"w{x}" for x in s) for s in sets])
    rows, _ = line_dedup.line_rows(np.arange(150), np.zeros(150, dtype=np.int32), texts, line_dedup.Order([b"w%d" % x for x in range(30)]))
    by = np.argsort(rows[:, 0], kind="stable")
    got = {(int(a), int(b)) for a, b in zip(*(c for k, c in enumerate(line_dedup.candidate_pairs(*rows[by].T)[:4]) if k in (0, 2)))}
    near = {(a, b) for a in range(150) for b in range(a) if 9 * len({*sets[a]} & {*sets[b]}) >= 4 * (len(sets[a]) + len(sets[b])) and sets[a] != sets[b]}
    assert near and near <= got
    assert all(5 * min(len(sets[a]), len(sets[b])) >= 4 * max(len(sets[a]), len(sets[b])) for a, b in got)
