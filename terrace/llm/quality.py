"""Quality rules: a ledger of failure bits, and policies applied to it.

Each rule is evaluated once per document and leaves one bit. A policy is a set of rules, that is a
mask, so any number of policies and their ablations read the ledger and never the texts again.
Built-in functions only; no shuffle except for the counts of an ablation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.rows import BLANK, aside, fixed, text_of, words_of

SYMBOLS = "[#*$%&|<>]"
SPAN = 8
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_same_as_previous"]

#: Rule -> when it fails, in terms of the measures. The place in this list is the rule's bit: append only.
RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "stuttering": "5 * n_same_as_previous > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
}
BIT = {rule: 1 << place for place, rule in enumerate(RULES)}

#: Version -> the rules that reject. A released version is never changed.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def mask(policy: str) -> int:
    return sum(BIT[rule] for rule in POLICIES[policy])


def rejected_by(policy: str) -> Column:
    """Whether a row of the ledger fails a rule of the policy."""
    return F.col("failure_bits").bitwiseAND(F.lit(mask(policy)).cast("bigint")) != 0


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``_row`` (the input row), the measures, and ``failure_bits``; one row per input row.

    A NULL text counts as empty. A text without a word has zeros and fails ``few_words`` only.
    Equal rows get equal ledger rows. Repeated windows are told apart by 64-bit hashes, within one
    text only.
    """
    split = aside(docs, _text=text_of(text)).withColumn("_words", words_of(F.col("_text")))
    n = F.size("_words")
    windows = F.transform(F.sequence(F.lit(1), n - (SPAN - 1)), lambda i: F.xxhash64(F.slice("_words", i, SPAN)))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(BLANK.replace("[", "[^")))
    measured = split.select(
        "_row",
        n.cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.size(F.filter("_words", lambda w, i: w == F.get("_words", i - 1))).cast("bigint").alias("n_same_as_previous"),
        lines.alias("_lines"),
        F.when(n >= SPAN, windows).otherwise(F.array().cast("array<bigint>")).alias("_windows"),
    )
    # Sorted only where some window occurs twice, which few texts have.
    twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    numbered = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    measured = measured.select(
        "*",
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(twice, F.sort_array(numbered)).alias("_sorted"),
    )
    repeated = F.filter(
        "_sorted", lambda x, j: (F.get("_sorted", j - 1)["h"] == x["h"]) | (F.get("_sorted", j + 1)["h"] == x["h"])
    )
    covered = F.array_distinct(F.flatten(F.transform(repeated, lambda x: F.sequence(x["i"], x["i"] + (SPAN - 1)))))
    measured = measured.withColumn(
        "n_repeat_words", F.when(F.col("_sorted").isNull(), 0).otherwise(F.size(covered)).cast("bigint")
    )
    bits = reduce(Column.bitwiseOR, (F.when(F.expr(rule), F.lit(BIT[name])).otherwise(F.lit(0)) for name, rule in RULES.items()))
    return fixed(measured.select("_row", *MEASURES, bits.cast("bigint").alias("failure_bits")), "_row")


def verdicts(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Ledger with ``base_failed`` and ``kept``: the base rules always reject, the policy's rules on top."""
    return ledger(docs).withColumns({"base_failed": rejected_by("base"), "kept": ~(rejected_by("base") | rejected_by(policy))})


def kept_documents(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The input rows that the policy keeps, unchanged."""
    return verdicts(docs, policy).where("kept").select("_row.*")


def ablations(ledger_rows: DataFrame, *policies: str) -> DataFrame:
    """Per policy and rule of it: rows that fail it, that only it rejects, and that are kept without it.

    Without ``policies`` for the current one. The ledger is first counted per distinct ``failure_bits``, at most two to the
    number of rules, so everything after one map-side combined count is tiny, for any number of policies. An empty ledger
    gives zeros.
    """
    counted = ledger_rows.groupBy("failure_bits").agg(F.count(F.lit(1)).alias("n"))
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    bits = lambda number: F.col("failure_bits").bitwiseAND(F.lit(number).cast("bigint"))
    found = [
        F.struct(
            F.lit(policy).alias("policy"),
            F.lit(rule).alias("rule"),
            total(bits(BIT[rule]) != 0).alias("n_failed"),
            total(bits(mask(policy)) == BIT[rule]).alias("n_only_this"),
            total(bits(mask(policy) & ~BIT[rule]) == 0).alias("n_kept_without"),
        ).alias(f"{policy}_{rule}")
        for policy in policies or (CURRENT,)
        for rule in POLICIES[policy]
    ]
    sums = counted.agg(*found)
    return sums.select(F.inline(F.array(*sums.columns)))
