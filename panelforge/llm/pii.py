"""Personal data by fixed patterns and a skip-chain conditional random field.

Patterns give the base spans (email, ip, card, phone). The field adds what they miss: its
nodes are the words with a digit or an @, its labels the four kinds and "none". Neighbouring
nodes are linked in a chain; nodes with the same core (the word without punctuation around
it) or the same five or more digits are linked by skip edges, each to the next of its like,
however far away. So a number that is a phone in one place is pulled towards phone in every
other place. Words without digit or @ are outside the field by definition (label none).

Loopy belief propagation sends messages along all edges of a batch of documents at once,
until they settle. Base spans are evidence: the words they touch have their label fixed.
A word that no base span touches is added if one kind has a belief of at least SURE;
neighbouring added words of one kind make one span.

Weights are learned on the driver from a bounded sample, at most SAMPLE documents of at most
SAMPLE_CHARS characters that hold a digit or @, lowest hash first, repeated rows once. The labels there
are the base spans; features are shapes and contexts, not the patterns themselves. Documents
in which a pattern ran over several numbers (too many digits or a failed check, which the base
drops) don't teach: their labels are in doubt. The gradient is that of the likelihood under
propagated beliefs; the prior draws skip tables to consistency (SKIP_PRIOR on the diagonal),
since repeats are rare in a sample.

Defined results: null text is empty and has no spans; repeated rows and null ids give a row
each; an empty table gives no rows; extra columns are ignored whatever their names; without
any node in the sample all weights are 0 and nothing is added. All patterns run in linear
time on very long words.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import pick, ship, slices

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
LABELS = NONE + 1
SURE = 0.9
SAMPLE, SAMPLE_CHARS = 2_000, 20_000
BUCKETS = 1 << 12
SKIP_PRIOR = 2.0
WS = " \t\n\x0b\x0c\r"

# ---------------------------------------------------------------- base patterns
# Possessive and anchored at the start of a run: the same matches as the plain patterns, in linear time.
_LOCAL = r"[A-Za-z0-9._%+-]"
_MAIL = _LOCAL + r"++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
EMAIL_HERE, EMAIL = re.compile(_MAIL), re.compile(rf"(?<!{_LOCAL})" + _MAIL)
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MARKED = re.compile(r"[0-9@]")
NODE = re.compile(r"(?<![^\x20\t-\r])[^\x20\t-\r0-9@]*+[0-9@][^\x20\t-\r]*+")


def _emails(text: str):
    at = 0
    while True:
        m = EMAIL_HERE.match(text, at) if at else None
        m = m or EMAIL.search(text, at)
        if not m:
            return
        yield m
        at = m.end()


def _luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        v = int(ch)
        total += v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def _small_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base spans, by start, then kind."""
    if not MARKED.search(text):
        return []
    spans = [(m.start(), 0, m.end()) for m in _emails(text)] if "@" in text else []
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(_small_part, m.group().split(".")))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        if 14 <= len(digits) <= 19 and _luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if "+" in text:
        spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(spans)


def doubtful(text: str) -> bool:
    """A card or phone pattern ran over several numbers: too many digits, or cards' digits in parts that fail the check."""
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if len(digits) > 19 or len(digits) >= 14 and len(digits) < len(m.group()) and not _luhn(digits):
            return True
    return any(len(re.sub("[^0-9]", "", m.group())) > 15 for m in PHONE.finditer(text))


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


# ---------------------------------------------------------------- the graph of a document
EDGES_OF = ".,;:!?\"'"
TEMPLATES = 5


def shape(word: str) -> str:
    word = re.sub(r"[0-9]+", "9", word)
    return re.sub(r"[^\W0-9_]+", "a", word)


def _features(word: str, before: str, after: str) -> list[int]:
    digits = len(re.sub("[^0-9]", "", word))
    told = (shape(word), f"{min(digits, 20)}{shape(word)}", f"{min(digits, 20)}{'@' in word}", before, after)
    return [zlib.crc32(f"{i}{t}".encode()) % BUCKETS for i, t in enumerate(told)]


class Graph:
    """Nodes and edges of one document: spans (n, 2), features (n, TEMPLATES), given labels, edges (m, 3: u, v, type)."""

    def __init__(self, text: str, base: list[tuple[int, int, int]]):
        found = [(m.start(), m.end(), m.group()) for m in NODE.finditer(text)]
        n = len(found)
        near = [not text[a[1]:b[0]].strip(WS) for a, b in zip(found, found[1:])]
        feats, cores = [], []
        for i, (s, e, word) in enumerate(found):
            ahead = text[max(0, s - 40):s].split()
            before = found[i - 1][2] if i and near[i - 1] else (ahead[-1].lower() if ahead else "")
            after = shape(found[i + 1][2]) if i + 1 < n and near[i] else "-"
            feats.append(_features(word, shape(before) if i and near[i - 1] else before, after))
            core = word.strip(EDGES_OF)
            cores.append((s + (len(word) - len(word.lstrip(EDGES_OF))) if core else s, core))
        self.spans = np.array([(s, s + len(c)) if c else (s, s) for s, c in cores], dtype=np.int64).reshape(-1, 2)
        self.features = np.array(feats, dtype=np.int64).reshape(-1, TEMPLATES)
        self.given = np.full(n, -1, dtype=np.int64)
        at = 0
        for s, kind, e in base:
            while at < n and found[at][1] <= s:
                at += 1
            j = at
            while j < n and found[j][0] < e:
                if self.given[j] < 0:
                    self.given[j] = kind
                j += 1
        edges = {(i, i + 1, 0) for i, ok in enumerate(near) if ok}
        last: dict[str, int] = {}
        for i, (_, core) in enumerate(cores):
            digits = re.sub("[^0-9]", "", core)
            for key in (f"c{core.lower()}", f"d{digits}" if len(digits) >= 5 else ""):
                if len(key) > 1:
                    if key in last:
                        edges.add((last[key], i, 1))
                    last[key] = i
        self.edges = np.array(sorted(edges), dtype=np.int64).reshape(-1, 3)


def joined(graphs: list[Graph]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features, given labels and edges of many documents as one graph, and the first node of each."""
    at = np.concatenate([[0], np.cumsum([len(g.given) for g in graphs])]).astype(np.int64)
    edges = np.concatenate([g.edges + np.array([a, a, 0]) for g, a in zip(graphs, at)]) if graphs else np.zeros((0, 3), np.int64)
    feats = np.concatenate([g.features for g in graphs]) if graphs else np.zeros((0, TEMPLATES), np.int64)
    given = np.concatenate([g.given for g in graphs]) if graphs else np.zeros(0, np.int64)
    return feats, given, edges, at


# ---------------------------------------------------------------- the field
def _log_norm(a: np.ndarray) -> np.ndarray:
    top = a.max(-1, keepdims=True)
    return a - (top + np.log(np.exp(a - top).sum(-1, keepdims=True)))


def propagate(unary: np.ndarray, edges: np.ndarray, pair: np.ndarray, rounds: int = 60, settled: float = 1e-6):
    """Loopy belief propagation, all messages at once. Returns log beliefs of nodes and of edges.

    unary (n, L); edges (m, 3) of u, v, type; pair (types, L, L), rows for u. Exact on trees no deeper than `rounds`."""
    n, m = len(unary), len(edges)
    u, v, kind = edges.T if m else np.zeros((3, 0), np.int64)
    source, goal = np.concatenate([u, v]), np.concatenate([v, u])
    table = np.concatenate([pair[kind], pair[kind].transpose(0, 2, 1)]) if m else np.zeros((0, LABELS, LABELS))
    back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
    messages = np.full((2 * m, unary.shape[1]), -np.log(unary.shape[1]))
    for step in range(rounds):
        belief = _beliefs(unary, messages, goal, n)
        out = belief[source] - messages[back]
        top = out.max(1, keepdims=True)
        fresh = _log_norm(np.log(np.einsum("ei,eij->ej", np.exp(out - top), np.exp(table)) + 1e-300) + top)
        if step >= 10:
            fresh = _log_norm(0.5 * fresh + 0.5 * messages)  # loops that swing
        moved = np.abs(np.exp(fresh) - np.exp(messages)).max() if m else 0.0
        messages = fresh
        if moved < settled:
            break
    belief = _beliefs(unary, messages, goal, n)
    joint = np.zeros((0, LABELS, LABELS))
    if m:
        joint = (belief[u] - messages[m:])[:, :, None] + (belief[v] - messages[:m])[:, None, :] + pair[kind]
        flat = _log_norm(joint.reshape(m, -1))
        joint = flat.reshape(joint.shape)
    return _log_norm(belief), joint


def _beliefs(unary, messages, goal, n):
    return unary + np.stack([np.bincount(goal, messages[:, k], n) for k in range(unary.shape[1])], 1) if len(goal) else unary.copy()


class Field:
    """Weights of the skip-chain field: one per feature bucket and label, and one table each for chain and skip edges."""

    def __init__(self, node: np.ndarray | None = None, pair: np.ndarray | None = None):
        self.node = np.zeros((BUCKETS, LABELS)) if node is None else node
        self.pair = np.zeros((2, LABELS, LABELS)) if pair is None else pair

    def unary(self, features: np.ndarray) -> np.ndarray:
        return self.node[features].sum(1)

    def learn(self, graphs: list[Graph], steps: int = 120, rate: float = 0.1, penalty: float = 0.02) -> "Field":
        """Adam on the likelihood of the graphs' labels; expected counts are propagated beliefs."""
        feats, given, edges, _ = joined(graphs)
        n = len(given)
        if not n:
            return self
        prior = np.stack([np.zeros((LABELS, LABELS)), SKIP_PRIOR * np.eye(LABELS)])
        self.pair += prior
        label = np.where(given < 0, NONE, given)
        true = np.zeros((n, LABELS))
        true[np.arange(n), label] = 1
        seen = np.zeros_like(self.pair)
        np.add.at(seen, (edges[:, 2], label[edges[:, 0]], label[edges[:, 1]]), 1)
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in (self.node, self.pair)]
        for step in range(1, steps + 1):
            belief, joint = propagate(self.unary(feats), edges, self.pair, rounds=20, settled=1e-4)
            left = true - np.exp(belief)
            slope_node = np.stack([np.bincount(feats.ravel(), np.repeat(left[:, k], TEMPLATES), BUCKETS) for k in range(LABELS)], 1) - penalty * self.node
            slope_pair = seen - penalty * (self.pair - prior)
            for t in (0, 1):
                slope_pair[t] -= np.exp(joint[edges[:, 2] == t]).sum(0)
            slope_pair[1] = (slope_pair[1] + slope_pair[1].T) / 2  # skip edges have no direction
            for w, slope, (a, b) in zip((self.node, self.pair), (slope_node, slope_pair), moments):
                a += 0.1 * (slope - a)
                b += 0.01 * (slope * slope - b)
                w += rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
        return self

    def beliefs(self, graphs: list[Graph], use_given: bool = True) -> np.ndarray:
        """Label probabilities of all nodes; words under base spans keep their label."""
        feats, given, edges, _ = joined(graphs)
        unary = self.unary(feats)
        if use_given and len(given):
            fixed = np.flatnonzero(given >= 0)
            unary[fixed] = -50.0
            unary[fixed, given[fixed]] = 50.0
        return np.exp(propagate(unary, edges, self.pair)[0])

    def added(self, graphs: list[Graph]) -> list[list[tuple[int, int, int]]]:
        """Spans that the field adds to each document."""
        belief = self.beliefs(graphs)
        out, at = [], 0
        for g in graphs:
            n = len(g.given)
            p = belief[at:at + n]
            at += n
            kind = p.argmax(1) if n else np.zeros(0, int)
            take = (kind != NONE) & (g.given < 0) & (p.max(1) >= SURE) & (g.spans[:, 1] > g.spans[:, 0]) if n else np.zeros(0, bool)
            linked = set(g.edges[g.edges[:, 2] == 0, 0].tolist())
            spans: list[list[int]] = []
            last = -2
            for i in np.flatnonzero(take).tolist():
                if last == i - 1 and last in linked and spans[-1][1] == kind[i]:
                    spans[-1][2] = int(g.spans[i, 1])
                else:
                    spans.append([int(g.spans[i, 0]), int(kind[i]), int(g.spans[i, 1])])
                last = i
            out.append([tuple(s) for s in spans])
        return out


def fit_field(docs: DataFrame, sample: int = SAMPLE, most_chars: int = SAMPLE_CHARS) -> Field:
    """Learn from at most `sample` documents (id, text) of at most `most_chars` characters that hold a digit or @."""
    some = docs.where(F.col("text").rlike("[0-9@]") & (F.length("text") <= most_chars))
    some = some.select(F.xxhash64(F.col("id").cast("string"), "text").alias("hash"), "text")
    lowest = [r["hash"] for r in some.select("hash").orderBy("hash").limit(sample).collect()]  # tasks send numbers, not texts
    if not lowest:
        return Field()
    rows = some.where(F.col("hash") <= lowest[-1]).groupBy("hash").agg(F.first("text").alias("text")).orderBy("hash").collect()  # at most `sample`
    return Field().learn([Graph(r["text"], base_spans(r["text"])) for r in rows if not doubtful(r["text"])])


def personal_data(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_email, n_ip, n_card, n_phone, base, spans (written spans), n_added."""
    ship(docs.sparkSession)
    src = pick(docs, id=id_col, text=text_col)
    field = field or fit_field(src)
    weights = docs.sparkSession.sparkContext.broadcast((field.node, field.pair))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        model = Field(*weights.value)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            busy = [i for i, t in enumerate(texts) if MARKED.search(t)]
            added = dict(zip(busy, model.added([Graph(texts[i], base[i]) for i in busy]))) if busy else {}
            counts = [[sum(k == want for _, k, _ in b) for b in base] for want in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array([written(b) for b in base], pa.string()),
                 pa.array([written(sorted(b + added.get(i, []))) for i, b in enumerate(base)], pa.string()),
                 pa.array([len(added.get(i, [])) for i in range(len(texts))], pa.int64())],
                names=["id", *(f"n_{k}" for k in KINDS), "base", "spans", "n_added"])

    # texts without a digit or @ have no spans: they don't travel to Python
    slim = src.select("id", F.when(F.col("text").rlike("[0-9@]"), F.col("text")).alias("text"))
    found = slim.mapInArrow(run, f"id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string, n_added long")
    return found.withColumnRenamed("id", id_col)
