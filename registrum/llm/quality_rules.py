"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one `fail_bits`
long, bit i set if rule i fails. Policies (versioned masks over the bits) are applied afterwards
without reading a text again, and ablations (what a policy would lose or gain by each rule) are
bitwise aggregations over the ledger.

Defined results: a null or empty text has no words (all measures 0) and fails `too_few_words`;
rows are treated one by one, so repeated rows give repeated ledger rows; other input columns are
ignored, whatever their names; an empty table gives an empty ledger.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrum.llm.common import as_bytes, code_points, slices, text_column

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(0x41, 0x5B))
LETTERS = UPPER + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bangs", "n_upper", "n_letters", "top_word", "n_same_next")


def measure(data: bytes) -> tuple[int, ...]:
    """The measurements of one text (UTF-8), in the order of MEASURES."""
    words = data.split()
    n = len(words)
    if not n:
        return (0, 0, len(data) - len(data.translate(None, SYMBOLS))) + (0,) * 8
    seen: set[bytes] = set()
    lines = duplicates = 0
    for line in data.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            if line in seen:
                duplicates += 1
            else:
                seen.add(line)
    counts = Counter(words)
    repeated = 0
    if len(counts) < n and n > 3:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(windows)) < n - 2:
            found = Counter(windows)
            reach = 0  # words before this position are counted
            for i, window in enumerate(windows):
                if found[window] > 1:
                    repeated += i + 3 - max(i, reach)
                    reach = i + 3
    bare = b"".join(words)
    return (
        n,
        code_points(bare),
        len(data) - len(data.translate(None, SYMBOLS)),
        duplicates,
        repeated,
        lines,
        data.count(b"!"),
        len(data) - len(data.translate(None, UPPER)),
        len(data) - len(data.translate(None, LETTERS)),
        max(counts.values()),
        sum(map(bytes.__eq__, words, words[1:])),
    )


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # SQL over the measures; integers only, so that every engine agrees


#: Rule i owns bit i. New rules are appended; a bit is never given to another rule.
RULES = (
    Rule("too_few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 25 * n_words"),
    Rule("duplicate_lines", "n_lines >= 5 AND 100 * n_dup_lines > 50 * n_lines"),
    Rule("shouting", "100 * n_upper > 40 * n_letters"),
    Rule("bangs", "100 * n_bangs > 25 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("one_word_dominates", "100 * top_word > 30 * n_words"),
    Rule("stutter", "100 * n_same_next > 20 * n_words"),
    Rule("few_letters", "100 * n_letters < 40 * word_chars"),
)
BIT = {rule.name: 1 << i for i, rule in enumerate(RULES)}
BASE_MASK = BIT["too_few_words"] | BIT["repeated_windows"]


@dataclass(frozen=True)
class Policy:
    """A versioned choice of rules: a document is kept if it fails none of them."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[name] for name in self.rules)


#: v1: the two base rules alone. v2 (default): all rules.
POLICIES = (
    Policy("v1", ("too_few_words", "repeated_windows")),
    Policy("v2", tuple(rule.name for rule in RULES)),
)
DEFAULT_POLICY = POLICIES[-1]


def ledger(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: id, the measures (long) and fail_bits (long)."""
    source = docs.select(docs[id_column].cast("long").alias("doc_id"), text_column(docs, text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            rows = list(zip(*map(measure, as_bytes(piece.column("text"))), strict=True)) or [()] * len(MEASURES)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *(pa.array(x, pa.int64()) for x in rows)], ["doc_id", *MEASURES])

    measured = source.mapInArrow(run, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = " + ".join(f"CASE WHEN {rule.fails} THEN {BIT[rule.name]}L ELSE 0L END" for rule in RULES)
    return measured.withColumn("fail_bits", F.expr(bits))


def passes(policy: Policy, bits: Column | None = None) -> Column:
    bits = F.col("fail_bits") if bits is None else bits
    return bits.bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablation(rows: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """Per policy and rule of it: documents that the policy rejects, that fail the rule, and that only
    this rule rejects (kept once the rule is dropped). One pass: the ledger is first counted by
    distinct fail_bits, of which there are 2 ^ rules at most whatever the number of documents."""
    patterns = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    choices = rows.sparkSession.createDataFrame(
        [(p.version, p.mask, name, BIT[name]) for p in policies for name in p.rules],
        "version string, mask long, rule string, bit long",
    )
    failed = F.col("fail_bits").bitwiseAND(F.col("mask"))
    count = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")
    return (
        choices.join(patterns, F.col("fail_bits").bitwiseAND(F.col("mask")) != 0, "left")
        .groupBy("version", "rule")
        .agg(count(failed != 0).alias("rejected"), count(failed.bitwiseAND(F.col("bit")) != 0).alias("failing"), count(failed == F.col("bit")).alias("only_this_rule"))
    )
