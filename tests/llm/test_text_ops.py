"""Token counts, quality rules, packing, mixing, WARC, HTML and scoring against brute force on small tables."""

import hashlib
import io
import math
import random
import re
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from panelforge.llm import html_main, lm_scoring, mixing, packing, quality_rules, token_counts, warc_zip
from panelforge.llm.production import MIX_WEIGHTS, mixing_tree
from tests.llm.conftest import EDGE

SPACE = re.compile(r"[\x20\x09-\x0D]+")
PIECES, CLIP, BYTES = (public_tokenizers.path(n) for n in ("piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.tiktoken"))


def words(text):
    return [w for w in SPACE.split(text or "") if w]


# ---- token counts --------------------------------------------------------------------

def test_token_counts_are_the_librarys(make_docs):
    c = token_counts.Counter(PIECES)
    rng = random.Random(4)
    texts = [t or "" for _, t in EDGE] + ["".join(rng.choices(" \n\t▁aeth.,<s>é①　 the1", k=rng.randint(0, 14))) for _ in range(3000)]
    assert c.count(pa.array([t and " " + t for t in texts])).tolist() == [len(x) for x in c.sp.encode(texts)]
    got = token_counts.token_counts(make_docs(EDGE, clashing=True), PIECES).collect()
    want = sorted((str(i), len((t or "").encode()), n, n > 4096) for (i, t), n in zip(EDGE, map(len, c.sp.encode([t or "" for _, t in EDGE]))))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


# ---- quality rules -------------------------------------------------------------------

def brute_quality(text):
    ws, text = words(text), text or ""
    windows = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(ws), sum(map(len, ws)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_measures_and_policies(make_docs):
    rng = random.Random(9)
    rows = EDGE + [(100 + i, "".join(rng.choices(["a", "b ", "é#", "\n", " c d e ", "|"], k=rng.randint(0, 120)))) for i in range(60)]
    entries = quality_rules.apply_policy(quality_rules.ledger(make_docs(rows, clashing=True))).collect()
    want = sorted((str(i), *brute_quality(t)) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in entries) == want
    for r in entries:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (r.failed == 0) and not (r.kept and r.base_failed)
    docs = make_docs(rows, clashing=True)
    left = quality_rules.filter_documents(docs)
    assert left.columns == docs.columns and sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r.doc_id) for r in entries if r.kept)


def test_ablation_counts_bits(spark):
    bits = [0, 1, 2, 3, 3, 4]
    table = spark.createDataFrame([(b,) for b in bits], "failed long")
    got = {r.rule: (r.failed, r.failed_alone) for r in quality_rules.ablation(table).collect()}
    order = list(quality_rules.RULES)
    assert got[order[0]] == (3, 1) and got[order[1]] == (3, 1) and got[order[2]] == (1, 1)


# ---- packing -------------------------------------------------------------------------

def test_packing_round_trip(make_docs):
    tok = packing.Encoder(CLIP).tok
    docs = make_docs(EDGE, clashing=True)
    want = sorted((np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for _, t in EDGE))
    pieces = packing.pack(docs, CLIP, 256).collect()
    spans = defaultdict(list)
    for p in pieces:
        assert 0 < p.length <= 256 - p.offset
        spans[p.sequence_id].append((p.offset, p.length))
    last = max(spans)
    for k in range(last + 1):  # gapless from 0, full but for the last
        at = 0
        for offset, length in sorted(spans[k]):
            assert offset == at
            at += length
        assert at == 256 or k == last
    full = {r.sequence_id: np.array(r.ids[:r.n_ids], "<u4") for r in packing.sequences(docs, CLIP, 256).collect()}
    for p in pieces:
        piece = full[p.sequence_id][p.offset:p.offset + p.length]
        assert zlib.crc32(piece.tobytes()) == p.ids_crc32
    joined = np.concatenate([full[k] for k in range(last + 1)])
    starts = sorted(p.sequence_id * 256 + p.offset for p in pieces if p.start == 0)
    assert sorted(joined[a:b].tobytes() for a, b in zip(starts, [*starts[1:], len(joined)])) == want
    sizes = {len(r.ids) for r in packing.sequences(docs, CLIP, 256).collect()}
    assert all(n == 256 or n & (n - 1) == 0 for n in sizes)


def test_encoder_is_the_library():
    enc, rng = packing.Encoder(CLIP), random.Random(5)
    texts = ["".join(rng.choices([*" \n\t▁aeth.,é①　'sΣσ\xa0́\x00\x01", "<|endoftext|>", "<|", "the", "ing"], k=rng.randint(0, 14))) for _ in range(4000)]
    want = [np.array(x.ids, "<u2").tobytes() for x in enc.tok.encode_batch(texts, add_special_tokens=False)]
    assert enc.encode([t.encode() for t in texts]) == want


def test_column_encodes_distinct_words_once():
    """A slice is one array of ids: null is empty, every text closes with the end id, and a word is encoded once however often it occurs."""
    enc, seen = packing.Encoder(CLIP), []
    texts = [None, "", " \n", *["the same words \u00e9 \u6f22 <|endoftext|> " * 50] * 20, "last"]
    plain = enc.ids
    enc.ids = lambda words: seen.extend(words.to_pylist()) or plain(words)
    ids, bounds = enc.column(pa.array(["cut off", *texts]).slice(1), (2,))
    want = [[*enc.tok.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want and len(seen) == len(set(seen)) == 7
    assert [x.tolist() for x in enc.column(pa.array([], pa.string()), (2,))] == [[], [0]]


# ---- mixing --------------------------------------------------------------------------

def brute_fill(budget, caps, weights):
    """Water filling by repeated sharing."""
    got, live = dict.fromkeys(caps, 0.0), {k for k in caps if weights[k] > 0 and caps[k] > 0}
    while live:
        unit = budget / sum(weights[k] for k in live)
        full = {k for k in live if caps[k] <= unit * weights[k] + 1e-9}
        if not full:
            return got | {k: unit * weights[k] for k in live}
        for k in full:
            got[k] = caps[k]
            budget -= caps[k]
        live -= full
    return got


def test_budgets_go_to_siblings_before_ancestors(spark):
    rng = random.Random(6)
    leaves = {(f"d{a}", f"l{b}", f"s{c}"): rng.choice([0, 5, 50, 500, 5000]) for a in range(3) for b in range(3) for c in range(4)}
    weights = [{"d0": 5.0, "d1": 1.0}, {"l0": 3.0, "l2": 0.0}, {"s1": 2.0}]
    df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "l0 string, l1 string, l2 string, tokens long")
    got = {(r.l0, r.l1, r.l2): r.budget for r in mixing.allocate(df, ["l0", "l1", "l2"], 9000.0, weights, 2).collect()}
    share = {(): 9000.0}
    for depth in range(3):
        nodes = defaultdict(float)
        for k, v in leaves.items():
            if all(weights[d].get(k[d], 1.0) > 0 for d in range(3)):
                nodes[k[:depth + 1]] += 2.0 * v
        below = defaultdict(dict)
        for k, cap in nodes.items():
            below[k[:-1]][k] = cap
        share = {c: b for p, caps in below.items() if p in share for c, b in brute_fill(share[p], caps, {c: weights[depth].get(c[-1], 1.0) for c in caps}).items()}
    assert got.keys() == leaves.keys()
    for k in leaves:
        assert math.isclose(got[k], share.get(k, 0.0), abs_tol=1e-6), k


def test_mix_takes_whole_epochs_then_a_prefix(make_docs):
    rng = random.Random(7)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["en", "de", None]), rng.choice(["src0", "src1", "src7", None]), 0) for i in range(300)]
    docs = make_docs(rows + [rows[3], (None, "no id", "en", "src0", 5), (900, None, "en", "src0", None)], clashing=True)
    got = mixing.mix(docs, mixing_tree(), 0.6, MIX_WEIGHTS).collect()
    assert len(got) == 303
    leaf = defaultdict(list)
    for r in got:
        leaf[(r.domain, r.language, r.origin)].append(r)
    for rs in leaf.values():
        tokens, budget = rs[0].leaf_tokens, rs[0].leaf_budget
        assert sum(r.n_tokens for r in rs) == tokens
        whole = min(int(round(budget / tokens, 9)) if tokens else 0, 2)
        left, at = budget - whole * tokens, 0
        for r in sorted(rs, key=lambda r: (hashlib.md5(f"mix-1:{whole}:{'∅' if r.doc_id is None else r.doc_id}".encode()).hexdigest(), r.n_tokens)):
            if r.doc_id != rows[3][0]:  # the repeated row shares one place
                assert r.copies == min(whole + (2 * at + r.n_tokens < 2 * left - 1e-2), 2) or abs(2 * at + r.n_tokens - 2 * left) < 1e-2
            at += r.n_tokens
    taken = mixing.take(docs, mixing_tree(), 0.6, MIX_WEIGHTS)
    assert taken.columns == docs.columns and taken.count() == sum(r.copies for r in got)


# ---- WARC ----------------------------------------------------------------------------

PAGES = [(1, "http://a.example/1", "x" * 1500), (2, "http://a.example/2", "x" * 1500), (3, None, "x" * 1500), (4, "u", None), (5, "u", ""), (6, "u", "small"),
         (7, "u", "small"), (None, "u", "x" * 1500), (8, "line\nfeed", "é" * 700), (9, "u", "é" * 700), (9, "u", "é" * 700), (10, "u", "WARC/1.1\r\n\r\n" * 200)]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("sha1", F.lit("own")).withColumn("id", F.lit(5)).repartition(3)
    got = warc_zip.archive_pages(pages).collect()
    assert len(got) == len(PAGES)
    largest = {t: max(i for i, _, h in PAGES if h == t and i is not None) for _, _, t in PAGES if t and len(t.encode()) >= 1000}
    want = []
    for i, _, h in PAGES:
        raw = (h or "").encode()
        ref = largest.get(h)
        ref = ref if i is not None and ref is not None and i != ref else None
        want.append((str(i), len(raw), hashlib.sha1(raw).hexdigest(), "response" if ref is None else "revisit", ref))
    assert sorted([(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == sorted(want, key=str)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_zip.archive_pages(empty).count() == 0


def test_payloads_come_back(spark, tmp_path):
    pages = spark.createDataFrame(PAGES[:7], "id long, url string, html string")
    packages = warc_zip.write_packages(warc_zip.plan_records(pages), str(tmp_path / "packages"))
    got = {r.page_id: r.payload for r in warc_zip.read_packages(spark, packages, with_payload=True).collect() if r.record_type == "response"}
    assert got == {3: bytearray(b"x" * 1500), 4: bytearray(b""), 5: bytearray(b""), 6: bytearray(b"small"), 7: bytearray(b"small")}


@pytest.mark.parametrize("wide", [False, True])
def test_central_directories(tmp_path, monkeypatch, wide):
    if wide:  # ZIP64 end records and extra fields
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    members = {f"m{i}": bytes([65 + i]) * (150 + i) for i in range(5)}
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as z:
        for n, data in members.items():
            z.writestr(n, data)
        z.writestr("packed", b"z" * 500, compress_type=zipfile.ZIP_DEFLATED)
        z.comment = b"a comment"
    path = tmp_path / "t.zip"
    path.write_bytes(raw.getvalue())
    with warc_zip.RangeFile(path.as_uri()) as f:
        found = warc_zip.central_directory(f)
        assert {n: f.read(*at) for n, at in found.items()} == members  # stored members only
    path.write_bytes(b"no archive")
    with warc_zip.RangeFile(path.as_uri()) as f, pytest.raises(ValueError):
        warc_zip.central_directory(f)


# ---- HTML ----------------------------------------------------------------------------

def page(body, i):
    return (f"<!DOCTYPE html><html><head><title>T {i}</title><style>p{{}}</style><script>var a='</p>';</script></head><body><nav><a href='/'>Home</a></nav>"
            f"<div class='ad'>Buy {i}</div><!-- c -->{body}<aside>side</aside><div id=comments><p>Nice {i}</p></div><form><p>Search</p></form><footer>&copy; x</footer></body></html>")


def test_main_text(spark):
    rows = [(i, "https://h.example/a", page(f"<article><h1>Title&nbsp;{i} &amp; co</h1><p>Some <b>bo</b>ld \n text {i}<br>next<p>Second &lt;p&gt; {i}"
                                            f"<div class='promo'>no</div></article><div class='x'>Template line</div>", i)) for i in range(20)]
    rows += [(100 + i, "https://plain.example/", f"<div class='top'>Same on all</div><div class='c'><p>Body of page {i}</p></div>") for i in range(20)]
    rows += [(200, None, None), (201, "u", ""), (202, "u", "just text"), (203, "u", "<p>open <i>tags"), (203, "u", "<p>open <i>tags"), (204, "u", "a < b &unknown; 5 > 3")]
    rows += [(300 + i, "http://copies.example/", page("<article><p>All the same article</p></article>", i)) for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("own")).withColumn("low", F.lit(1)).repartition(3)
    got = sorted((r.page_id, r.text, r.n_chars) for r in html_main.main_text(df).collect())
    want = [(i, f"Title {i} & co Some bold text {i} next Second <p> {i}") for i in range(20)] + [(100 + i, f"Body of page {i}") for i in range(20)]
    want += [(200, ""), (201, ""), (202, "just text"), (203, "open tags"), (203, "open tags"), (204, "a < b &unknown; 5 > 3")] + [(300 + i, "All the same article") for i in range(20)]
    assert got == [(i, t, len(t)) for i, t in want]
    assert html_main.main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("copies", [2, 60])
def test_copies_and_repeated_headings_stay(spark, copies):
    """Groups of copies, articles with the same headings and pages of template alone, on hosts of two sizes."""
    def grouped(g):
        return f"<article><h1>Title {g}</h1>" + "".join(f"<p>Text {g} {k}</p>" for k in range(10)) + "</article>"

    def headed(i):
        return "<main>" + "".join(f"<section><h2>{h}</h2><p>{h} of {i}</p></section>" for h in ("Aim", "Way", "Data", "End", "Notes")) + "</main>"

    rows = [(g, "http://groups.example/", page(grouped(g), i)) for g in range(5) for i in range(copies)]
    rows += [(100 + i, "http://headed.example/", page(headed(i), i)) for i in range(10 * copies)]
    rows += [(10_000 + g, "http://plain.example/", page(f"<div class='c'><p>Plain {g}</p></div>", i)) for g in range(5) for i in range(10 * copies)]
    rows += [(20_000 + i, "http://same.example/", page(f"<div class='c'>Gone{'' if i else ' first'}</div>", i)) for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {(r.page_id, r.text) for r in html_main.main_text(df).collect()}
    want = {(g, f"Title {g} " + " ".join(f"Text {g} {k}" for k in range(10))) for g in range(5)}
    want |= {(100 + i, " ".join(f"{h} {h} of {i}" for h in ("Aim", "Way", "Data", "End", "Notes"))) for i in range(10 * copies)}
    want |= {(10_000 + g, f"Plain {g}") for g in range(5)} | {(20_000 + i, "Gone" if i else "Gone first") for i in range(20)}
    assert got == want
    low = frozenset(["/html/body/div.c"])
    assert html_main.extract("<html><body><div class=c>All of it</div><nav>Home</nav></body></html>", low) == ("All of it", 0, 1)
    assert html_main.extract("<html><body><div class=c>Template</div><p>Text</p></body></html>", low) == ("Text", 1, 0)


def brute_low(pages, lists):
    """Template branches of one host's pages by recursion over a merged tree."""
    bodies = {}
    for html in pages:
        layouts = []
        found = html_main.blocks(html, layouts)
        left = sorted((p, t) for p, _, dropped, t in found if not (lists and dropped))
        if left:
            whole = Counter((p, html_main.TEXT, xxhash.xxh3_64_intdigest(t.encode()) - (1 << 63)) for p, _, _, t in found)
            whole.update((p, html_main.LAYOUT, xxhash.xxh3_64_intdigest("/".join(c).encode()) - (1 << 63)) for p, c in layouts if c)
            rank = xxhash.xxh3_128_digest(repr(sorted(whole.items())).encode())
            if repr(left) not in bodies or rank < bodies[repr(left)][0]:
                bodies[repr(left)] = rank, [(p, t) for p, _, _, t in found], [(p, tuple(c)) for p, c in layouts if c]
    root = {"kids": {}, "texts": [], "shapes": []}

    def node(path):
        at = root
        for step in path.split("/")[1:]:
            at = at["kids"].setdefault(step, {"kids": {}, "texts": [], "shapes": []})
        return at

    for _, texts, shapes in bodies.values():
        for p, t in texts:
            node(p)["texts"].append(t)
        for p, c in shapes:
            node(p)["shapes"].append(c)

    def effective(things):
        m = len(things)
        return math.exp(-sum(n / m * math.log(n / m) for n in Counter(things).values())) / m

    low = set()

    def walk(at, path):
        """(sum of blocks' content, blocks, highest importance) of a branch."""
        total, m, best = (effective(at["texts"]) * len(at["texts"]) if at["texts"] else 0.0), len(at["texts"]), 0.0
        for step, kid in at["kids"].items():
            t, n, b = walk(kid, f"{path}/{step}")
            total, m, best = total + t, m + n, max(best, b)
        if m:
            own = total / m
            if at["shapes"]:
                g = 0.9 ** len(set(at["shapes"]))
                own = (1 - g) * effective(at["shapes"]) + g * own
            best = max(best, own)
            tags = [s.split(".")[0] for s in path.split("/")[1:]]
            bare = path.rsplit("/", 1)[-1] in "p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot pre blockquote".split()
            if round(best, 9) < 0.3 and not bare and tags and tags[-1] not in ("html", "body") and not {"article", "main"} & set(tags):
                low.add(path)
        return total, m, best

    walk(root, "")
    return low


@pytest.mark.parametrize("lists", [True, False])
def test_style_tree_is_the_brute_force_one(spark, lists):
    rng = random.Random(8)

    def some(depth):
        tag = rng.choice(["div", "div class=a", "div class='b c'", "p", "ul", "li", "h2", "section", "div class=ad", f"div id=x{rng.random()}", "footer"])
        inner = "".join(some(depth - 1) for _ in range(rng.randint(0, 3))) if depth else ""
        return f"<{tag}>{rng.choice(['', 'same', 'two', f'own {rng.random()}'])}{inner}</{tag.split()[0]}>"

    rows = []
    for h, n in enumerate([1, 3, 12, 60]):
        fixed = some(3)
        pages = [f"<html><body>{fixed}{some(3)}{some(2)}</body></html>" for _ in range(n)]
        rows += [(h, f"http://h{h}.example/", x) for x in pages + pages[:n // 2]]
    rows = [(i, u, x) for i, (_, u, x) in enumerate(rows)]
    got = {r.page_id: (r.text, r.n_chars, r.by_tree, r.by_lists)
           for r in html_main.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5), lists=lists).collect()}
    low = {u: frozenset(brute_low([x for _, v, x in rows if v == u], lists)) for u in {u for _, u, _ in rows}}
    assert any(low.values())
    for i, u, x in rows:
        every = html_main.blocks(x)
        kept = [b for b in every if not any((b[0] + "/").startswith(p + "/") for p in low[u])]
        kept = kept if any(not (lists and b[2]) for b in kept) else every
        left = [b for b in kept if not (lists and b[2])]
        text = " ".join(b[3] for b in left)
        assert got[i] == (text, len(text), len(every) - len(kept), len(kept) - len(left))


def test_tree_alone_removes_what_repeats(spark):
    """Without lists: menus, notices, footers and a small pool of adverts go, ids per page or not; articles, headings in running text stay."""
    rng = random.Random(2)

    def whole(i):
        return (f"<html><body><div class=bar><ul>{''.join(f'<li>Menu {k}</li>' for k in rng.sample(range(9), 5))}</ul></div><div id='strip-{i}' class='n{i}'>We use cookies</div>"
                f"<div class=x>Buy {rng.randrange(6)}</div><div class=t><h2>Aim</h2><p>Aim of {i}</p><h2>Way</h2><p>Way of {i}</p></div><div class=foot><p>Site</p></div></body></html>")

    rows = [(i, "http://many.example/", whole(i)) for i in range(200)] + [(1000, "http://one.example/", whole(1000))]
    got = {r.page_id: r for r in html_main.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), lists=False).collect()}
    for i in range(200):
        assert got[i].text == f"Aim Aim of {i} Way Way of {i}" and got[i].by_tree == 8 and got[i].by_lists == 0
    assert "We use cookies" in got[1000].text  # a single page tells the tree nothing


# ---- scoring -------------------------------------------------------------------------

def test_scores(make_docs):
    rng = random.Random(3)
    vocab = {k: [f"{k}{i}" for i in range(60)] for k in ("th", "eau", "ung")}
    rows = [(i, " ".join(rng.choices(vocab[rng.choice(list(vocab))], k=rng.randint(5, 80)))) for i in range(400)]
    rows += [(1000 + i, t) for i, (_, t) in enumerate(EDGE) if t is None or len(t) < 1000] + [(None, "th1 th2"), (5, "th1")]
    got = lm_scoring.score_documents(make_docs(rows, clashing=True), BYTES, train_stride=1).collect()
    tokens = [[w.encode().lower() for w in words(t)] + [None] for _, t in rows]
    train = [i is None or zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows]
    counts = Counter(w for ts, mine in zip(tokens, train) if mine for w in ts)
    total, kinds = sum(counts.values()), len(counts)
    want = sorted((str(i), not mine, len(ts), sum(counts[w] > 0 for w in ts), total, round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in ts), 6))
                  for (i, _), ts, mine in zip(rows, tokens, train))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    held = [r for r in got if r.held_out and r.doc_id < 1000]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) and all(r.score < 0 for r in got)
    assert lm_scoring.score_documents(make_docs([]), BYTES).count() == 0


def test_every_window_trains(make_docs):
    """Short documents too: the scores are those of a training on every window."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(["th", "eau", "ung", "ko"], k=rng.choice([3, 10, 40])))) for i in range(60)]
    whole, every = ({r.doc_id: r.score for r in lm_scoring.score_documents(make_docs(rows), BYTES, **more).collect()} for more in ({}, {"train_stride": 1}))
    assert whole.keys() == every.keys() and all(math.isclose(whole[i], every[i], rel_tol=1e-4) for i in whole)


def test_rare_words_are_all_their_pieces():
    ws = ["zyxwvuts", "th", "漢字é", "th1", "Donaudampfschiff" * 9]
    speller = lm_scoring.Speller([b"th"], BYTES)
    place, flat, lengths = speller.ids(pa.array([w.encode() for w in ws], pa.binary()))
    spelled = np.split(flat, np.cumsum(lengths)[:-1])
    assert place.tolist() == [-1, 0, -1, -1, -1] and spelled[1].tolist() == [speller.first]
    assert [speller.bpe.decode((x - 1).tolist()) for i, x in enumerate(spelled) if i != 1] == [" " + w for w in ws if w != "th"]


def tiny_model(seed=0, size=40):
    rng = np.random.default_rng(seed)
    classes = np.append(rng.integers(0, lm_scoring.CLASSES, size), 0)
    return lm_scoring.Model(np.vstack([rng.normal(size=(size, lm_scoring.DIM)), np.zeros(lm_scoring.DIM)]).astype(np.float32), classes, np.zeros(size + 1, dtype=np.float32))


def test_attention_is_causal_and_scores_each_token_once():
    m, rng = tiny_model(), np.random.default_rng(1)
    ids = rng.integers(0, 40, 100).astype(np.int32)
    whole = m.score(ids, np.array([0, 100]))[0]
    prefixes = [m.score(ids[:n], np.array([0, n]))[0] for n in range(1, 101)]
    assert all(a > b for a, b in zip([0, *prefixes], prefixes)) and math.isclose(prefixes[-1], whole, rel_tol=1e-4)  # a later token changes nothing before it
    both = m.score(np.concatenate([ids, ids[:37]]), np.array([0, 100, 137]))
    assert np.allclose(both, [whole, prefixes[36]], rtol=1e-4)  # documents don't see each other


def test_gradient_is_the_slope():
    m, rng = tiny_model(2), np.random.default_rng(3)
    x, t = rng.integers(-1, 40, (5, 32)), rng.integers(-1, 40, (5, 16))
    grad, _ = m.gradient(x, t)
    for name in m.w:
        at = tuple(rng.integers(0, s) for s in m.w[name].shape)
        old = m.w[name][at]
        losses = []
        for d in (2e-2, -2e-2):
            m.w[name][at] = old + d
            losses.append(m.gradient(x, t)[1])
        m.w[name][at] = old
        assert math.isclose((losses[0] - losses[1]) / 4e-2, grad[name][at], rel_tol=0.1, abs_tol=3e-3), name


def test_probabilities_sum_to_one_far_from_zero():
    """Logits of any size: each id's score is its log softmax, as in plain float64 arithmetic with keys and values built."""
    ids = np.random.default_rng(5).integers(0, 40, 50).astype(np.int32)
    for shift in (0, -300, 300):
        m = tiny_model(4)
        m.w["b2"] += np.float32(shift)
        w = {k: v.astype(np.float64) for k, v in m.w.items()}
        inputs, targets, follows = m.windows(ids, np.array([0, 50]))
        x = m.joined(inputs, follows, 0, len(inputs))
        e = m.vectors[x].astype(np.float64)
        a = np.clip(e[:, 16:] @ w["wq"] / 4 @ (e @ w["wk"]).transpose(0, 2, 1) + w["pos"][m.lag], -30, 30) + m.mask + np.where(x < 0, -60, 0)[:, None, :]
        a = np.exp(a) / np.exp(a).sum(2, keepdims=True)
        z = np.maximum(np.concatenate([e[:, 16:], a @ (e @ w["wv"])], axis=2) @ w["w1"] + w["b1"], 0) @ w["w2"] + w["b2"]
        logp = z - z.max(2, keepdims=True)
        logp -= np.log(np.exp(logp).sum(2, keepdims=True))
        want = np.take_along_axis(logp, m.classes[targets][..., None], 2)[..., 0][targets >= 0].sum()
        assert math.isclose(m.score(ids, np.array([0, 50]))[0] * math.log(10), want, rel_tol=1e-4), shift
        assert math.isclose(m.gradient(x, targets)[1], -want / 50, rel_tol=1e-4), shift


def test_many_words_are_spelled_at_once():
    """The same ids as word by word, white space of other alphabets and repeated calls included."""
    speller = lm_scoring.Speller([], BYTES)
    ws = ["a", "it's", "'s", "x1", "--", "\u00a0", "a\u00a0", "\u00a0b", "a\u2003b", "\x1c", "\u3000\u3000", "\u6f22\u5b57\u00e9", "z" * 300, "\U0001f600!", "12,5", "\u200b"]
    ws += [f"w{i}" for i in range(30_000)]
    calls = []
    one, many = speller.bpe.encode_ordinary, speller.bpe.encode_to_numpy
    want = [(np.array(one(" " + w)) + 1).tolist() for w in ws]
    speller.bpe = type("Counted", (), {"encode_ordinary": lambda _, t: calls.append(t) or one(t), "encode_to_numpy": lambda _, t, **more: many(t, **more)})()
    for _ in range(2):
        assert [np.frombuffer(x, np.int32).tolist() for x in speller.pieces([w.encode() for w in ws])] == want
    assert len(calls) < 20


def test_hashing_in_arrow():
    from panelforge.llm.common import hash_words
    ws = [f"w{i}".encode() for i in range(5000)] + [b"x" * n for n in range(1, 300)]
    h = hash_words(pa.array(ws))
    assert len(set(h.tolist())) == len(ws) and h[7] == hash_words(pa.array([b"a", ws[7]]))[1]
