"""Line deduplication by an exact set-similarity join.

A line (text between line feeds) is the set of its words ``[^\\x20\\x09-\\x0D]+``. A line is removed
if any earlier line has Jaccard similarity of at least the threshold (0.8) with it. Lines are ordered by
doc_id, then by their number in the document.

1. All words are counted, by 62-bit hashes that stand for them up to step 4. Words of a line are ordered by rarity: the most frequent words of the corpus (a fixed
   number) by their counts, all others before them. Any total order gives exact results;
   this one keeps lists of lines short.
2. Prefix filter: a line of n words is listed under its n - ceil(t n) + 1 rarest words only.
3. Lines that share such a word meet in one task, ordered by size. Identical sets (equal size, rarest word,
   64-bit sum of word hashes and bitmap) are collapsed onto their earliest line before that: in each slice of text, so that the
   copies of a common line never reach the shuffle, and again while a bucket of words is read. The others must pass the length
   filter, the positional filter (words that remain behind the shared one) and a bitmap filter (a parity of the words, 64 or
   256 bits wide, bounds the sets' difference from below).
4. Pairs that are left are verified on the words themselves.

Each line needs one earlier match only, so a task passes on a line's candidates by the likeness of their bitmaps, until FIRST of them are
likely matches. Lines
that had more and found no match among these are searched again without that bound, all in one pass: a sieve of fixed size (a
bit per hash of their prefix words) keeps other lines out of the shuffle; what passes it by chance is dropped in the task.

Defined results: null text has no lines; lines without words are kept; a null doc_id comes last; rows that
repeat doc_id and text are one document whose lines share a verdict; rows of one doc_id with different texts
are ordered by a hash of the text; an empty table gives no rows; extra columns are kept, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import free_name, materialize, partitions_for, places, shield, ship, small, slices, span_hashes, word_spans

UP, DOWN = 4, 5  # threshold 4/5
FREQUENT = 65_536
COUNTED = 1 << 20  # counts kept in a task before they are added up
FIRST = 3
SIEVE = 1 << 22  # bits of the sieve of words in the second search
SUB, FLUSH = 16, 150_000  # buckets a partition; rows kept before they are dealt to buckets
TOGETHER = 1 << 16  # pairs of lines compared at once
_TOP = 1 << 62


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts, words by their hashes. Words that occur once in a slice of some megabytes are left out there: they are not
    frequent, and rare words are ordered by hash anyway."""
    def run(batches):
        held = []

        def total():
            word, n = (np.concatenate(c) for c in zip(*held))
            by = np.argsort(word)
            word, n = word[by], n[by]
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            return word[start], np.add.reduceat(n, start)

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(c) for c in total()], names=["word", "n"])

        for batch in slices(batches, 4 << 20):
            word = np.sort(hashes(*word_spans(batch.column(0))[:3]))
            edges = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1], [True]])) if len(word) else np.zeros(1, dtype=np.int64)
            n = np.diff(edges)
            if (n > 1).any():
                held.append((word[edges[:-1][n > 1]], n[n > 1]))
            if sum(len(w) for w, _ in held) >= COUNTED:
                held = [total()]
                if len(held[0][0]) >= COUNTED // 2:
                    yield rows()
                    held = []
        if held:
            yield rows()

    return texts.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame) -> np.ndarray:
    """At most FREQUENT words, rarest first: those above the lowest eighth of an octave of counts that fits."""
    fit = counts.where(F.col("n") > 1).withColumn("level", F.floor(F.log2("n") * 8).cast("int"))
    fit = materialize(fit, "frequent")
    steps = sorted(((r["level"], r["words"]) for r in fit.groupBy("level").agg(F.count("*").alias("words")).collect()), reverse=True)
    least, total = None, 0
    for at, words in steps:  # a few hundred levels at most
        total += words
        if total > FREQUENT:
            break
        least = at
    picked = [] if least is None else fit.where(F.col("level") >= least).collect()
    return np.array([w for _, w in sorted((r["n"], r["word"]) for r in picked)], dtype=np.int64)


def hashes(at: np.ndarray, n: np.ndarray, data: np.ndarray) -> np.ndarray:
    """62-bit hashes of the words at these places of data; they stand for the words."""
    return (span_hashes(at, n, data) >> np.uint64(2)).astype(np.int64)


class Order:
    """Words -> places in the order of rarity, whole numbers that also stand for the words.

    ranked: the frequent words or their hashes, rarest first."""

    def __init__(self, ranked: list[bytes] | np.ndarray):
        self.ranked = ranked if isinstance(ranked, np.ndarray) else self.hashed(pa.array(ranked, pa.binary()))
        self.by = np.argsort(self.ranked)
        self.sorted = self.ranked[self.by]

    def of(self, words: pa.Array) -> np.ndarray:
        return self.placed(self.hashed(words))

    def placed(self, hashed: np.ndarray) -> np.ndarray:
        if not len(self.sorted):
            return hashed.copy()
        at = np.minimum(np.searchsorted(self.sorted, hashed), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashed, _TOP + self.by[at], hashed)

    @staticmethod
    def hashed(words: pa.Array) -> np.ndarray:
        offsets = np.array([0, *np.cumsum([len(w) for w in words.to_pylist()])], dtype=np.int64)
        return hashes(offsets[:-1], np.diff(offsets), np.frombuffer(b"".join(words.to_pylist()), dtype=np.uint8))

    def loose(self, sieve: np.ndarray) -> np.ndarray:
        """The sieve with frequent words that pass it entered by their hashes too: what passes by its place passes this one by its hash."""
        kept = self.ranked[passes(sieve, _TOP + np.arange(len(self.ranked), dtype=np.int64))]
        at, out = sieve_place(kept, 64 * len(sieve)), sieve.copy()
        np.bitwise_or.at(out, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        return out


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - -(-UP * n // DOWN) + 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    return x * np.uint64(0xD6E8FEB86659FD93)


NAMES = ("word", "doc", "line", "size", "print", "bits0", "bits1", "bits2", "bits3")


def width(n: np.ndarray) -> np.ndarray:
    """Bitmap of a line of n words: 0, 1 and 2 for 64, 128 and 256 bits.

    Lines of middle length have the most rows, so theirs are narrower."""
    return np.select([n <= 10, n <= 24, n <= 96], [0, 2, 1], 2)




def line_rows(doc: np.ndarray, tk: np.ndarray, text: pa.Array, order: Order, sieve: np.ndarray | None = None,
              loose: np.ndarray | None = None):
    """Rows (NAMES) of a batch of documents, as one array, and its copies: (later doc, later line, doc, line) of lines with an equal
    earlier one in the batch, which get no rows.

    line: tk << 32 | number; size: n << 32 | place of the word in the line's order. sieve: rows under words that pass it alone;
    loose: order.loose(sieve), which spares most words the search for their place."""
    at, length, data, offsets = word_spans(text)
    if not len(at):
        return None
    hashed = hashes(at, length, data)
    hit = None if loose is None else passes(loose, hashed)
    if hit is not None and not hit.any():
        return None
    row, number, line = places(at, data, offsets)
    fresh = np.concatenate([[True], line[1:] != line[:-1]])
    if hit is not None:
        hit = np.logical_or.reduceat(hit, np.flatnonzero(fresh))[np.cumsum(fresh) - 1]
        row, number, hashed, fresh = row[hit], number[hit], hashed[hit], fresh[hit]
    doc, tl = doc[row[fresh]], tk[row[fresh]].astype(np.int64) << 32 | number[fresh]
    by = np.argsort(hashed)
    hashed, owner = hashed[by], (np.cumsum(fresh) - 1)[by]  # words by their hashes, and their lines
    first = np.concatenate([[True], hashed[1:] != hashed[:-1]])
    word = np.cumsum(first) - 1
    keys = order.placed(hashed[first])  # of the distinct words
    if sieve is not None:  # lines without such a word are left out before they are sorted
        hit = np.zeros(len(doc), dtype=bool)
        hit[owner[passes(sieve, keys)[word]]] = True
        if not hit.any():
            return None
        mine = hit[owner]
        word, owner, doc, tl = word[mine], (np.cumsum(hit) - 1)[owner[mine]], doc[hit], tl[hit]
    frequent = np.flatnonzero(keys >= _TOP)
    by = np.concatenate([np.flatnonzero(keys < _TOP), frequent[np.argsort(keys[frequent])]])  # hashes ascend already
    rank = np.empty(len(by), dtype=np.int64)
    rank[by] = np.arange(len(by))
    both = np.sort(owner << 32 | rank[word])
    both = both[np.concatenate([[True], both[1:] != both[:-1]])]  # each line's words once, rarest first
    owner, flat = both >> 32, keys[by][both & 0xFFFFFFFF]
    n = np.bincount(owner)
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    mixed = _mixed(flat)
    one = np.uint64(1) << (mixed >> np.uint64(58))
    block = (mixed >> np.uint64(56)) & np.uint64(3)
    bits = np.array([np.bitwise_xor.reduceat(np.where(block == k, one, np.uint64(0)), starts) for k in range(4)])
    fold = width(n) < 2  # narrower bitmaps are the wide one folded
    bits[0, fold] ^= bits[2, fold]
    bits[1, fold] ^= bits[3, fold]
    bits[2:, fold] = 0
    fold = width(n) < 1
    bits[0, fold] ^= bits[1, fold]
    bits[1, fold] = 0
    prints = np.add.reduceat(mixed ^ (mixed >> np.uint64(29)), starts) ^ n.astype(np.uint64)
    prints = prints.view(np.int64)
    by = np.lexsort((tl, doc, flat[starts], n, prints))
    same = np.zeros(len(n), dtype=bool)
    same[1:] = np.all([c[by[1:]] == c[by[:-1]] for c in (prints, n, flat[starts], *bits)], axis=0)
    leader = by[np.flatnonzero(~same)[np.cumsum(~same) - 1]]
    later, leader = by[same], leader[same]
    alone = np.ones(len(n), dtype=bool)
    alone[later] = False
    other = (doc[later] != doc[leader]) | (tl[later] != tl[leader])
    later, leader = later[other], leader[other]
    p = np.where(alone, prefix_length(n), 0)
    line = np.repeat(np.arange(len(n)), p)
    place = np.arange(len(line)) - np.repeat(np.concatenate([[0], np.cumsum(p)[:-1]]), p)
    if sieve is not None:
        mine = passes(sieve, flat[starts[line] + place])
        line, place = line[mine], place[mine]
    rows = np.stack([flat[starts[line] + place], doc[line], tl[line], n[line] << 32 | place, prints[line], *(x[line].view(np.int64) for x in bits)], axis=1)
    return rows, np.stack([doc[later], tl[later], doc[leader], tl[leader]], axis=1)


def sieve_place(word, bits: int):
    """The bit of a word (numpy array or column) in a sieve of so many bits, a power of two."""
    if isinstance(word, np.ndarray):
        return word.astype(np.uint64) & np.uint64(bits - 1)
    return word.bitwiseAND(F.lit(bits - 1))


def passes(sieve: np.ndarray, words: np.ndarray) -> np.ndarray:
    at = sieve_place(words, 64 * len(sieve))
    return (sieve[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def sieve_of(rows: DataFrame) -> np.ndarray:
    """The words of listed rows as a sieve of SIEVE bits: at most SIEVE / 64 numbers reach the driver, however many words there are."""
    def run(batches):
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_unpacked(batch.column(1), len(NAMES))[:, 0]))], names=["word"])

    at = sieve_place(F.col("word"), SIEVE)
    parts = (rows.select("bucket", "rows").mapInArrow(run, "word long").groupBy(F.shiftright(at, 6).alias("at"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(word & 63 as int))")).alias("bits")).collect())
    sieve = np.zeros(SIEVE // 64, dtype=np.int64)
    for r in parts:
        sieve[r["at"]] = r["bits"]
    return sieve.view(np.uint64)


#: rows of one bucket of words together, each 8 bytes a column of NAMES. kind 0: of lost lines, 1: of any lines, 2: copies, which need no search
LISTED = "bucket int, kind int, rows binary"


def _packed(table: np.ndarray, bucket: np.ndarray, kind: int) -> pa.RecordBatch:
    bucket = bucket.astype(np.uint16 if bucket.max() < 1 << 16 else np.int32)  # 16 bits are sorted by counting
    by = np.argsort(bucket, kind="stable")
    table, bucket = table[by], bucket[by]
    start = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    ends = (np.append(start, len(bucket)) * 8 * table.shape[1]).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(bucket[start].astype(np.int32)), pa.array(np.full(len(start), kind, dtype=np.int32)),
                                       pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(table)])], names=["bucket", "kind", "rows"])


def _unpacked(column: pa.Array, columns: int) -> np.ndarray:
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]].view(np.int64).reshape(-1, columns)


def listed(docs: DataFrame, frequent, sieve=None, kind: int = 1) -> DataFrame:
    """(doc, tk, text) -> one row per line and word of its prefix, rows of a bucket of words packed together.

    Lines that repeat in a slice are pre-aggregated: the earliest is listed, the others become copies."""
    buckets = partitions_for(docs.sparkSession) * SUB

    def run(batches):
        order, mine, held = Order(frequent.value), None if sieve is None else sieve.value, []
        loose = None if mine is None else order.loose(mine)

        def flush():
            table = np.concatenate(held)
            held.clear()
            return _packed(table, (_mixed(table[:, 0]) >> np.uint64(20)) % np.uint64(buckets), kind)

        for batch in slices(batches, 2 << 20):
            got = line_rows(batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2), order, mine, loose)
            if got is None:
                continue
            rows, copies = got
            if len(copies) and kind:
                yield _packed(copies, np.full(len(copies), copies[0, 1] % buckets), 2)
            for at in range(0, len(rows), FLUSH):
                held.append(rows[at:at + FLUSH])
                if sum(map(len, held)) >= FLUSH:
                    yield flush()
        if held:
            yield flush()

    return docs.select("doc", "tk", "text").mapInArrow(run, LISTED)


def candidate_pairs(word, doc, line, size, prints, *bits, first: int | None = None, wanted: np.ndarray | None = None):
    """Pairs of lines (later, earlier) among rows of whole words.

    Returns (later doc, later line, earlier doc, earlier line, same, cut, distance of the bitmaps). same: equal in size, print, bitmap and rarest word;
    such lines are one set. cut marks lines with candidates beyond their `first` likely ones. wanted: rows whose lines may be the later ones."""
    more = np.zeros(len(word) + 1, dtype=bool)
    more[1:-1] = word[1:] == word[:-1]
    many = np.flatnonzero(more[1:] | more[:-1])  # a word of one line joins nothing
    word, doc, line, size, prints, *bits = (c[many] for c in (word, doc, line, size, prints, *bits))
    wanted = None if wanted is None else wanted[many]
    by = np.lexsort((line, doc, prints, size, word))
    word, doc, line, size, prints, *bits = (c[by] for c in (word, doc, line, size, prints, *bits))
    wanted = None if wanted is None else wanted[by]
    n, place = size >> 32, size & 0xFFFFFFFF
    new = np.ones(len(word), dtype=bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in (word, size, prints, *bits)], axis=0)
    leader = np.flatnonzero(new)[np.cumsum(new) - 1]
    copies = ~new & (place == 0) & ((doc != doc[leader]) | (line != line[leader]))  # identical sets meet under their first word
    copies = np.flatnonzero(copies if wanted is None else copies & wanted)
    lead = np.flatnonzero(new)
    w, m, at, b = word[lead], n[lead], place[lead], [x[lead].view(np.uint64) for x in bits]
    late, early, far, sure = [], [], [], []
    wide, left = width(m), m - at
    group = np.cumsum(np.concatenate([[True], w[1:] != w[:-1]])) if len(w) else w
    # the sizes ascend under a word: partners stand behind a line, up to the first that is too large
    count = np.searchsorted(group << 32 | m, group << 32 | DOWN * m // UP, side="right") - np.arange(len(lead)) - 1
    edges = np.flatnonzero(np.diff((np.cumsum(count) - count) // TOGETHER, prepend=-1, append=-1)) if len(lead) else []
    for first_line, behind in zip(edges[:-1], edges[1:]):
        c = count[first_line:behind]
        i = np.repeat(np.arange(first_line, behind), c)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)
        ok = (UP + DOWN) * np.minimum(left[i], left[j]) >= UP * (m[i] + m[j])
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        total = m[i] + m[j]
        most = total - 2 * -(-UP * total // (UP + DOWN))  # of words that only one has; the rest is the least intersection
        apart = sum(np.bitwise_count(x[i] ^ x[j]).astype(np.int64) for x in b)
        narrow, differ = np.minimum(wide[i], wide[j]), wide[i] != wide[j]
        for level in (1, 0):  # bitmaps of two widths: fold the wide one
            mixed = np.flatnonzero((narrow == level) & differ)
            if len(mixed):
                x, y = i[mixed], j[mixed]
                even, odd = b[0][x] ^ b[2][x] ^ b[0][y] ^ b[2][y], b[1][x] ^ b[3][x] ^ b[1][y] ^ b[3][y]
                apart[mixed] = np.bitwise_count(even ^ odd) if level == 0 else np.bitwise_count(even).astype(np.int64) + np.bitwise_count(odd)
        ok = apart <= most
        i, j, apart, most = i[ok], j[ok], apart[ok], most[ok]
        u, v = lead[i], lead[j]
        swap = (doc[u] > doc[v]) | ((doc[u] == doc[v]) & (line[u] > line[v]))
        late.append(np.where(swap, u, v))
        early.append(np.where(swap, v, u))
        far.append(apart)
        # the bitmap of a short line hardly folds words onto each other; that of a long one must be well below the bound
        sure.append((m[j] <= 24) | (5 * apart <= 3 * most))
        if wanted is not None:
            mine = wanted[late[-1]]
            late[-1], early[-1], far[-1], sure[-1] = late[-1][mine], early[-1][mine], far[-1][mine], sure[-1][mine]
    late, early, far, sure = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (late, early, far, sure))
    by = np.lexsort((line[early], doc[early], far, late))  # the most alike first, then the earliest
    late, early, far, sure = late[by], early[by], far[by], sure[by].astype(bool)
    cut = np.zeros(len(late), dtype=bool)
    if first is not None and len(late):
        start = np.flatnonzero(np.concatenate([[True], late[1:] != late[:-1]]))
        total = np.cumsum(sure)
        before = total - sure
        passed = before - np.repeat(before[start], np.diff(np.append(start, len(late))))  # likely matches ahead of it
        stay = passed < first
        cut = np.isin(late, late[~stay])[stay]
        late, early, far = late[stay], early[stay], far[stay]
    same = np.concatenate([np.ones(len(copies), dtype=bool), np.zeros(len(late), dtype=bool)])
    late, early, cut = np.concatenate([copies, late]), np.concatenate([leader[copies], early]), np.concatenate([np.zeros(len(copies), dtype=bool), cut])
    return doc[late], line[late], doc[early], line[early], same, cut, np.concatenate([np.zeros(len(copies), dtype=np.int64), far.astype(np.int64)])


PAIRS = "later_doc long, later_line long, doc long, line long, same boolean, cut boolean, far long"


def collapsed(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The earliest of equal lines under each word, and the others as copies."""
    word, doc, line, size, prints, *bits = table.T
    table = table[np.lexsort((line, doc, prints, size, word))]
    new = np.ones(len(table), dtype=bool)
    new[1:] = np.any(table[1:, [0, 3, 4, 5, 6, 7, 8]] != table[:-1, [0, 3, 4, 5, 6, 7, 8]], axis=1)
    leader = table[np.flatnonzero(new)[np.cumsum(new) - 1]]
    other = ~new & (table[:, 3] & 0xFFFFFFFF == 0) & np.any(table[:, 1:3] != leader[:, 1:3], axis=1)
    return table[new], np.concatenate([table[other, 1:3], leader[other, 1:3]], axis=1)


HELD = 500_000  # rows of a bucket beyond which equal lines are collapsed while it is read


def candidates(rows: DataFrame, first: int | None) -> DataFrame:
    """Candidate pairs of all listed rows; a word's rows meet in one task, which takes one bucket of words at a time.

    Rows of kind 0, if any: pairs of these later lines only."""
    names = ["later_doc", "later_line", "doc", "line", "same", "cut", "far"]

    def as_pairs(copies):
        return pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(c)) for c in copies.T), pa.array(np.ones(len(copies), dtype=bool)),
                                           pa.array(np.zeros(len(copies), dtype=bool)), pa.array(np.zeros(len(copies), dtype=np.int64))], names=names)

    def out(lost, held):
        table, wanted = np.concatenate([*lost, *held]), None
        if lost:  # they come first among equal rows, so that they lead them
            wanted = np.arange(len(table)) < sum(map(len, lost))
            hit = np.isin(table[:, 0], table[wanted, 0])
            table, wanted = table[hit], wanted[hit]
        by = np.argsort(table[:, 0], kind="stable")
        return pa.RecordBatch.from_arrays([pa.array(c) for c in candidate_pairs(*table[by].T, first=first, wanted=None if wanted is None else wanted[by])], names=names)

    def run(batches, second=first is None):
        bucket, lost, held, full = None, [], [], HELD
        for batch in slices(batches):
            buckets, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], (buckets[1:] != buckets[:-1]) | (kinds[1:] != kinds[:-1]), [True]]))
            for a, b in zip(edges[:-1], edges[1:]):
                if buckets[a] != bucket:
                    if lost or held and not second:
                        yield out(lost, held)
                    bucket, lost, held, full = buckets[a], [], [], HELD
                part = batch.column(2).slice(a, b - a)
                if kinds[a] == 2:
                    if not second:
                        yield as_pairs(_unpacked(part, 4))
                elif kinds[a] == 0:
                    lost.append(_unpacked(part, len(NAMES)).copy())
                elif lost or not second:
                    held.append(_unpacked(part, len(NAMES)).copy())
                    if not second and sum(map(len, held)) >= full:
                        rest, copies = collapsed(np.concatenate(held))
                        held, full = [rest], 2 * len(rest) + HELD
                        yield as_pairs(copies)
        if lost or held and not second:
            yield out(lost, held)

    ordered = rows.repartition(partitions_for(rows.sparkSession), "bucket").sortWithinPartitions("bucket", "kind")
    return ordered.mapInArrow(run, PAIRS)


def _lines_at(text: str, nos: str):
    """(no, one) of the numbered lines of a text, which is split once and not again for each of them."""
    split = F.array(F.split(text, "\n", -1))  # bound as a lambda's variable
    return F.transform(split, lambda lines: F.transform(nos, lambda no: F.struct(no.alias("no"), lines[no].alias("one"))))[0]


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(later_doc, later_line, cut, ok) of lines with candidates, by the words themselves.

    Each line is held against its most alike candidate first, and against the others only if that fails."""
    late = ["later_doc", "later_line"]
    ends = pairs.select(F.col("later_doc").alias("doc"), F.col("later_line").alias("line")).union(pairs.select("doc", "line")).distinct()
    wanted = ends.groupBy("doc", F.shiftright("line", 32).cast("int").alias("tk")).agg(F.collect_list(F.col("line").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")).alias("nos"))
    wanted = small(materialize(wanted, "wanted"))
    lines = materialize(
        docs.join(wanted, ["doc", "tk"]).select("doc", "tk", F.explode(_lines_at("text", "nos")).alias("at"))
        .select("doc", (F.shiftleft(F.col("tk").cast("long"), 32) + F.col("at.no")).alias("line"), F.col("at.one").alias("one"))
        .select("doc", "line", F.array_distinct(F.array_remove(F.split("one", r"[\x20\x09-\x0D]+"), "")).alias("words")), "lines")
    later = lines.select(F.col("doc").alias("later_doc"), F.col("line").alias("later_line"), F.col("words").alias("later_words"))
    both = F.size(F.array_intersect("words", "later_words"))

    def held(some: DataFrame, name: str) -> DataFrame:
        return materialize(some.join(lines, ["doc", "line"]).join(later, late)
                           .select(*late, "cut", (both * (UP + DOWN) >= UP * (F.size("words") + F.size("later_words"))).alias("ok")), name)

    best = pairs.groupBy(*late).agg(F.max("cut").alias("cut"), F.min_by(F.struct("doc", "line"), F.struct("far", "doc", "line")).alias("b")).select(*late, "cut", "b.*")
    first = held(best, "first")
    others = pairs.join(first.where("not ok").select(*late), late, "left_semi")
    rest = held(others.select(*late, "doc", "line", "cut"), "others")
    return first.union(rest).groupBy(*late).agg(F.max("ok").alias("ok"), F.max("cut").alias("cut"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc (null last), tk (31 bits of the text's hash) and text."""
    return docs.select(F.coalesce(docs[id_col].cast("long"), F.lit((1 << 63) - 1)).alias("doc"), _tk(docs[text_col]).alias("tk"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def _tk(text) -> object:
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 33).cast("int")


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, tk, no) of every line that has an earlier match."""
    spark = docs.sparkSession
    ship(spark)
    texts = _texts(docs, id_col, text_col)
    frequent = spark.sparkContext.broadcast(frequent_words(word_counts(texts)))
    pairs = materialize(candidates(listed(texts, frequent), FIRST).groupBy("later_doc", "later_line", "doc", "line")
                        .agg(F.max("same").alias("same"), F.max("cut").alias("cut"), F.min("far").alias("far")), "pairs")
    late = ["later_doc", "later_line"]
    same = pairs.where("same").select(*late).distinct()
    # lines with an equal earlier line need no other match
    checked = materialize(verified(materialize(pairs.where("not same").join(same, late, "left_anti"), "unlike"), texts), "checked")
    found = same.union(checked.where("ok").select(*late))
    lost = checked.where("cut and not ok").select(F.col("later_doc").alias("doc"), F.col("later_line").alias("line"))
    if not lost.isEmpty():  # one more search for all of them, without a bound; other lines of their documents are left blank
        nos = lost.groupBy("doc", F.shiftright("line", 32).cast("int").alias("tk")).agg(F.collect_set(F.col("line").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")).alias("nos"))
        nos = small(materialize(nos, "lost"))
        own = F.transform(F.split("text", "\n", -1), lambda x, i: F.when(F.array_contains("nos", i), x).otherwise(""))
        mine = materialize(listed(texts.join(nos, ["doc", "tk"]).select("doc", "tk", F.array_join(own, "\n").alias("text")), frequent, kind=0), "lost-rows")
        near = listed(texts, frequent, spark.sparkContext.broadcast(sieve_of(mine)))
        again = materialize(candidates(mine.union(near), None).groupBy(*late, "doc", "line").agg(F.max("cut").alias("cut"), F.min("far").alias("far")), "again")
        found = found.union(materialize(verified(again, texts).where("ok").select(*late).distinct(), "again-ok"))
    found = materialize(found, "duplicates")
    return found.select(F.col("later_doc").alias("doc"), F.shiftright("later_line", 32).cast("int").alias("tk"),
                        F.col("later_line").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("no"))


def remove_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their text less the duplicate lines, plus two last columns __lines and __removed (line numbers from 0).

    Other columns are kept whatever their names; where one has the name of a new column, that gets a further _ in front."""
    columns = docs.columns
    docs, (id_col, text_col) = shield(docs, id_col, text_col)
    gone = duplicate_lines(docs, id_col, text_col).groupBy(F.col("doc").alias("__d"), F.col("tk").alias("__t")).agg(F.array_sort(F.collect_list("no")).alias("__removed"))
    gone = small(materialize(gone, "gone"))
    keyed = docs.withColumn("__doc", F.coalesce(docs[id_col].cast("long"), F.lit((1 << 63) - 1))).withColumn("__tk", _tk(docs[text_col]))
    joined = keyed.join(gone, (keyed["__doc"] == gone["__d"]) & (keyed["__tk"] == gone["__t"]), "left")
    kept = F.array_join(F.filter(F.split(F.col(text_col), "\n", -1), lambda x, i: ~F.array_contains("__removed", i)), "\n")
    text = F.when(F.col("__removed").isNull(), F.col(text_col)).otherwise(kept)
    feeds = F.octet_length(text_col) - F.octet_length(F.replace(F.col(text_col), F.lit("\n"), F.lit("")))  # counted without a split
    count = F.when(F.col(text_col).isNull(), 0).otherwise(feeds + 1).cast("long")
    out = joined.withColumn("__lines", count).withColumn("__removed", F.coalesce("__removed", F.array().cast("array<int>"))).withColumn(text_col, text)
    return out.select(*docs.columns, "__lines", "__removed").toDF(*columns, free_name("__lines", columns), free_name("__removed", columns))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_lines, n_removed, removed_lines, text (what is left)."""
    out = remove_lines(docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias(text_col)), id_col, text_col)
    return out.select(id_col, F.col("__lines").alias("n_lines"), F.size("__removed").cast("long").alias("n_removed"), F.col("__removed").alias("removed_lines"), text_col)
