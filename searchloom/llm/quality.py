"""Quality rules as a ledger of failure bits.

Every rule is evaluated once, in one pass over each text. The ledger keeps the measurements and
one bit per failed rule. Policies are versions of which bits reject; applying one, or finding
what each rule contributes, is bit arithmetic on the ledger and never reads a text again.

Defined cases: a null text is an empty one and fails what an empty text fails. Rows are judged
one by one, so repeated rows and rows without id give one result each. Ratios of no words or no
lines count as 0. Empty tables give empty ledgers, and ablations that count 0.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchloom.llm.texts import row_of

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\v\f\r"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters"]

#: rule: (failed?, on the measurements). The position in this list is the bit, so only append.
RULES: list[tuple[str, Callable[[Callable[[str], Column]], Column]]] = [
    ("few_words", lambda m: m("n_words") < 50),
    ("repeated_words", lambda m: m("n_repeat_words") * 100 > m("n_words") * 50),
    ("word_length", lambda m: (m("word_chars") < m("n_words") * 2) | (m("word_chars") > m("n_words") * 16)),
    ("symbols", lambda m: m("n_symbols") * 10 > m("n_words")),
    ("repeated_lines", lambda m: m("n_dup_lines") * 2 > m("n_lines")),
    ("few_letters", lambda m: m("n_letters") * 10 < m("word_chars") * 6),
]
BITS = {name: 1 << at for at, (name, _) in enumerate(RULES)}
BASE = BITS["few_words"] | BITS["repeated_words"]


@dataclass(frozen=True)
class Policy:
    """A version of which rules reject a document."""

    version: str
    rejects: int

    @classmethod
    def of(cls, version: str, *rules: str) -> Policy:
        return cls(version, sum(BITS[r] for r in set(rules)))


POLICIES = {p.version: p for p in (Policy.of("1-base", "few_words", "repeated_words"), Policy.of("2-all", *BITS))}
CURRENT = POLICIES["2-all"]


def _repeated(words: list[bytes]) -> int:
    """Words inside a window of three words that occurs more than once."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    pairs = codes[:-1] * len(ids) + codes[1:]
    pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, counts = np.unique(pairs[:-1] * len(ids) + codes[2:], return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(twice)] |= twice
    return int(covered.sum())


def _measured(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = text.encode().split()  # bytes are split at ASCII white space only
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return (
        len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), _repeated(words), len(lines),
        len(text) - _others(text),
    )


_NO_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())


def _others(text: str) -> int:
    """ASCII characters that are no letters; all other characters count as letters here."""
    content = text.encode()
    return len(content) - len(content.translate(None, _NO_LETTERS))


@F.pandas_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def measured(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_measured(t) for t in texts], columns=MEASURES, dtype="int64")


def fail_bits(measures: str) -> Column:
    """One bit per failed rule, from a struct of measurements."""
    bits = F.lit(0).cast("long")
    for name, failed in RULES:
        bits = bits.bitwiseOR(F.when(failed(lambda c: F.col(f"{measures}.{c}")), BITS[name]).otherwise(0).cast("long"))
    return bits


def ledger(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, the measurements and ``fail_bits``."""
    # a udf that counts as nondeterministic is run once, however often its result is named
    rows = documents.select(F.col(id_col).alias("_id"), measured.asNondeterministic()(F.col(text_col)).alias("_m"))
    return rows.select(F.col("_id").alias(id_col), "_m.*", fail_bits("_m").alias("fail_bits"))


def rejected(policy: Policy, bits: str | Column = "fail_bits") -> Column:
    return (F.col(bits) if isinstance(bits, str) else bits).bitwiseAND(F.lit(policy.rejects)) != 0


def apply_policy(rows: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The ledger with ``policy`` and ``kept``."""
    return rows.withColumn("policy", F.lit(policy.version)).withColumn("kept", ~rejected(policy))


def ablations(rows: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """Per rule of the policy: documents that fail it, that only it rejects, and that are kept without it."""
    # at most one row per pattern of bits from here on
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.rejects)).alias("bits")).count()
    counts = []
    for name, bit in BITS.items():
        if policy.rejects & bit:
            for kind, fits in (("fails", F.col("bits").bitwiseAND(F.lit(bit)) != 0), ("alone", F.col("bits") == bit), ("kept_without", F.col("bits").bitwiseAND(F.lit(policy.rejects & ~bit)) == 0)):
                counts.append(F.coalesce(F.sum(F.when(fits, F.col("count"))), F.lit(0)).alias(f"{name}_{kind}"))
    one = patterns.agg(*counts)
    rules = [n for n, bit in BITS.items() if policy.rejects & bit]
    table = F.array(*[F.struct(F.lit(n).alias("rule"), *[F.col(f"{n}_{k}").alias(k) for k in ("fails", "alone", "kept_without")]) for n in rules])
    return one.select(F.lit(policy.version).alias("policy"), F.inline(table))


def report(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", policy: Policy = CURRENT) -> DataFrame:
    """Per row: id, measurements, ``base_failed``, ``fail_bits`` and ``kept`` under the policy and the base rules."""
    both = Policy(policy.version, policy.rejects | BASE)
    base = F.col("fail_bits").bitwiseAND(F.lit(BASE)) != 0
    return apply_policy(ledger(documents, id_col, text_col), both).withColumn("base_failed", base)


def passing(documents: DataFrame, text_col: str = "text", policy: Policy = CURRENT) -> DataFrame:
    """The documents that the policy keeps, all columns as they were."""
    names = documents.columns
    rows = documents.select(row_of(names).alias("_row"), measured.asNondeterministic()(F.col(text_col)).alias("_m"))
    return rows.where(~rejected(policy, fail_bits("_m"))).select("_row.*")
