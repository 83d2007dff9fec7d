"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one
``failed`` bitmask, bit N set when rule N failed. A policy is a versioned set of rule
names, that is a mask; applying it is ``failed & mask = 0``, without reading any text
again. Ablations (what each rule of a policy rejects, alone or with others) come from
one histogram of the masks, whose size depends on the number of rules only.

Words are ``[^\\x20\\x09-\\x0D]+``. Defined results: null and empty texts have no words and
fail ``few_words``; an empty table gives an empty ledger; repeated rows get one row each;
measurements are whole numbers, and ratios are compared as products, so ties are exact;
extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.llm.common import SPACE, pick, shield, ship, slices, text_bytes

SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_shouted")

#: rule -> SQL condition on the measurements under which a document fails; the order gives the bits
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "10 * n_symbols > 3 * n_words",  # over 0.3 symbols a word
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "few_letters": "100 * n_letters < 60 * word_chars",
    "shouting": "100 * n_shouted > 60 * n_words",
}
#: versioned policies; a new version is a new entry, so old verdicts can be made again
POLICIES = {
    "base-1": ("few_words", "repeated_windows"),
    "strict-1": tuple(RULES),
}
CURRENT = "strict-1"


def mask_of(policy: str | tuple[str, ...]) -> int:
    names = POLICIES[policy] if isinstance(policy, str) else policy
    order = list(RULES)
    return sum(1 << order.index(n) for n in names)


def repeat_words(words: list[bytes]) -> int:
    """Words covered by 3-word windows that occur twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def measure(raw: bytes) -> tuple[int, ...]:
    """MEASURES of one text in UTF-8."""
    words = raw.split()
    inner = raw.translate(None, SPACE)
    chars = len(inner) - sum(map(inner.count, _CONTINUED)) if not inner.isascii() else len(inner)
    seen, dup, lines = set(), 0, 0
    for line in raw.split(b"\n"):
        if line.strip():  # bytes.strip() takes off the same six characters
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    text = inner.decode("utf-8", "replace")
    letters = sum(map(str.isalpha, text)) if not text.isalpha() else len(text)
    shouted = sum(1 for w in raw.decode("utf-8", "replace").split() if len(w) > 1 and w.isupper()) if raw != raw.lower() else 0
    return len(words), chars, len(inner) - len(inner.translate(None, SYMBOLS)), dup, repeat_words(words), lines, letters, shouted


_CONTINUED = [bytes([b]) for b in range(0x80, 0xC0)]  # UTF-8 continuation bytes


def _measure(batches):
    names = ["id", *MEASURES]
    for batch in slices(batches):
        rows = [measure(raw) for raw in text_bytes(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in zip(*rows))], names=names)


def failed_bits() -> Column:
    return F.expr(" | ".join(f"(case when {cond} then {1 << i}L else 0L end)" for i, cond in enumerate(RULES.values())))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, the measurements, failed (bitmask over RULES)."""
    ship(docs.sparkSession)
    src = pick(docs, id=id_col, text=text_col)
    kind = src.schema["id"].dataType.simpleString()
    measured = src.mapInArrow(_measure, f"id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))
    return measured.withColumn("failed", failed_bits()).withColumnRenamed("id", id_col)


def apply_policy(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with base_failed and the policy's verdict, kept."""
    base, mask = mask_of("base-1"), mask_of(policy) | mask_of("base-1")
    return (entries.withColumn("base_failed", F.col("failed").bitwiseAND(F.lit(base)) != 0)
            .withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask)) == 0)
            .withColumn("policy", F.lit(policy)))


def filter_documents(docs: DataFrame, policy: str = CURRENT, text_col: str = "text") -> DataFrame:
    """The documents that a policy keeps, with their own columns, whatever their names: ledger and policy in one pass over the texts."""
    ship(docs.sparkSession)
    columns, names = docs.columns, list(MEASURES)
    at = columns.index(text_col)
    docs, _ = shield(docs)

    def run(batches):
        for batch in slices(batches):
            rows = [measure(raw) for raw in text_bytes(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.int64()) for c in zip(*rows))], names=[*batch.schema.names, *names])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in names)])
    measured = docs.mapInArrow(run, schema)
    mask = mask_of(policy) | mask_of("base-1")
    return measured.where(failed_bits().bitwiseAND(F.lit(mask)) == 0).drop(*names).toDF(*columns)


def ablation(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, and those that no other rule of the policy rejects."""
    mask = mask_of(policy)
    counts = (entries.select(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits")).groupBy("bits").agg(F.count("*").alias("n")))
    order = list(RULES)
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << order.index(n)).cast("long").alias("bit")) for n in POLICIES[policy]]))
    return (counts.select("bits", "n", each.alias("r")).groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
                 F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("failed_alone")))
