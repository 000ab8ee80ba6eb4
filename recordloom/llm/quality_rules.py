"""Quality rules with a ledger: every rule is evaluated once, policies only read its bits.

``ledger`` measures each text and stores one bit for each rule that fails. A policy is a version with a mask of rules:
a document is kept if none of the policy's bits is set. What a rule alone costs, or what a policy would keep without
it, follows from the bits, by counting masks; no text is read again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm import words
from recordloom.llm.tables import by_batches

#: Windows of so many words that come twice make their words repeats.
REPEAT_WORDS = 8
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_echoes")


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``condition``, SQL over the measures in whole numbers, holds."""

    name: str
    condition: str


#: The bit of a rule is its place here; new rules are added at the end, so that old ledgers stay valid.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "100 * n_symbols > 3 * word_chars"),
    Rule("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule("capitals", "100 * n_upper > 40 * n_letters"),
    Rule("word_length", "word_chars > 30 * n_words OR word_chars < 2 * n_words"),
    Rule("echoes", "100 * n_echoes > 30 * n_words"),
)

#: Versions of the policy, by the names of their rules.
POLICIES = {
    1: ("few_words", "repeated_windows"),
    2: ("few_words", "repeated_windows", "symbols", "repeated_lines", "capitals", "word_length", "echoes"),
}


def mask(names: tuple[str, ...] | list[str]) -> int:
    place = {rule.name: k for k, rule in enumerate(RULES)}
    return sum(1 << place[name] for name in set(names))


def _repeats(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each item, whether its document has its value at least twice; and 2 where an earlier item has it."""
    order = np.lexsort((value, owner))
    same = np.zeros(len(value) + 1, bool)
    same[1:-1] = (owner[order][1:] == owner[order][:-1]) & (value[order][1:] == value[order][:-1])
    out = np.zeros(len(value), np.int8)
    out[order] = np.where(same[:-1], 2, np.where(same[1:], 1, 0))
    return out


def measure(texts: words.Texts) -> dict[str, np.ndarray]:
    """The measures of each text, as arrays."""
    data, n = texts.data, len(texts)
    found = words.words(texts)
    count = found.counts
    per_text = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[texts.offsets])
    upper = (data >= 65) & (data <= 90)
    # windows of words, not across documents
    long = np.maximum(count - REPEAT_WORDS + 1, 0)
    owner = np.repeat(np.arange(n), long)
    at = np.repeat(found.first[:-1] - (np.cumsum(long) - long), long) + np.arange(len(owner))
    windows = words.grams(found.hashes, REPEAT_WORDS)[at] if len(at) else np.zeros(0, np.uint64)
    hit = at[_repeats(owner, windows) > 0]
    cover = np.zeros(len(found.starts) + REPEAT_WORDS + 1, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + REPEAT_WORDS, -1)
    repeated = np.concatenate([[0], np.cumsum(np.cumsum(cover)[: len(found.starts)] > 0)])
    # lines that hold a word
    newline = np.flatnonzero(data == 10)
    ends = np.unique(np.concatenate([newline, texts.offsets[1:]]))
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    starts = starts + ((starts < len(data)) & (data[np.minimum(starts, max(len(data) - 1, 0))] == 10) & np.isin(starts, newline)) if len(data) else starts
    filled = np.concatenate([[0], np.cumsum(~_SPACE[data])])
    worded = filled[ends] > filled[np.minimum(starts, ends)]
    starts, ends = starts[worded], ends[worded]
    line_owner = np.searchsorted(texts.offsets, starts, "right") - 1
    again = _repeats(line_owner, words.hash_spans(data, starts, ends)) == 2
    echo = np.zeros(len(found.starts), bool)
    echo[1:] = found.hashes[1:] == found.hashes[:-1]
    echo[found.first[:-1][count > 0]] = False
    echoes = np.concatenate([[0], np.cumsum(echo)])
    return {
        "n_words": count,
        "word_chars": per_text(((data & 0xC0) != 0x80) & ~_SPACE[data]),
        "n_symbols": per_text(_SYMBOLS[data]),
        "n_dup_lines": np.bincount(line_owner[again], minlength=n),
        "n_repeat_words": repeated[found.first[1:]] - repeated[found.first[:-1]],
        "n_lines": np.bincount(line_owner, minlength=n),
        "n_upper": per_text(upper),
        "n_echoes": echoes[found.first[1:]] - echoes[found.first[:-1]],
        "n_letters": per_text(upper | ((data >= 97) & (data <= 122))),
    }


def measures(docs: DataFrame, *, id_columns: list[str], text_column: str = "text") -> DataFrame:
    """``id_columns`` and the measures of each row; a null text measures as an empty one."""
    rows = docs.select(F.col(text_column).cast("string").alias("__text"), *id_columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [batch.column(k + 1) for k in range(len(id_columns))]
            for texts in words.slices(batch.column(0)):
                found = measure(texts)
                yield pa.RecordBatch.from_arrays(
                    [c.slice(texts.first, len(texts)) for c in kept]
                    + [pa.array(found[m].astype(np.int64)) for m in MEASURES],
                    [f"c{k}" for k in range(len(id_columns) + len(MEASURES))],
                )

    fields = [(c, docs.schema[c].dataType.simpleString()) for c in id_columns] + [(m, "bigint") for m in MEASURES]
    return by_batches(rows, run, ", ".join(f"`{c}` {t}" for c, t in fields))


def failure_bits() -> Column:
    return sum((F.expr(f"CAST({rule.condition} AS BIGINT)") * F.lit(1 << k).cast("bigint") for k, rule in enumerate(RULES)), F.lit(0).cast("bigint"))


def ledger(docs: DataFrame, *, id_columns: list[str] | None = None, text_column: str = "text") -> DataFrame:
    """``id_columns`` (``doc_id``), the measures and ``failed``, the bits of the rules that fail.

    A null text counts as empty, so it fails ``few_words`` alone. Repeated rows have a ledger row each; further
    columns of ``docs`` are ignored, whatever their names. Whole texts are measured, however long.
    """
    return measures(docs, id_columns=id_columns or ["doc_id"], text_column=text_column).withColumn("failed", failure_bits())


def passes(policy: int) -> Column:
    """Whether a row of the ledger passes a version of the policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy])).cast("bigint")) == 0


def ablation(book: DataFrame, policy: int) -> DataFrame:
    """For each rule of a policy: rows that fail it, that fail it alone, and that the policy keeps with and without it.

    The ledger is first counted by mask, of which there are at most ``2 ** len(RULES)``.
    """
    rules = POLICIES[policy]
    by_mask = book.groupBy(F.col("failed").bitwiseAND(F.lit(mask(rules)).cast("bigint")).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    bit = F.col("bit")
    listed = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask([r])).cast("bigint").alias("bit")) for r in rules])
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias
    return (
        by_mask.select("bits", "n", F.inline(listed))
        .groupBy("rule")
        .agg(
            total(F.col("bits").bitwiseAND(bit) != 0)("n_failed"),
            total(F.col("bits") == bit)("n_failed_alone"),
            total(F.col("bits") == 0)("n_kept"),
            total(F.col("bits").bitwiseAND(F.bitwise_not(bit)) == 0)("n_kept_without"),
        )
    )


def apply_policy(docs: DataFrame, policy: int, *, text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text passes a version of the policy, in one pass without a shuffle."""
    names = docs.columns
    carried = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)], F.col(f"`{text_column}`").cast("string").alias("text"))
    book = ledger(carried, id_columns=[f"c{k}" for k in range(len(names))], text_column="text")
    return book.where(passes(policy)).select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)])
