"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one
failure bit per rule; a policy is a versioned mask over those bits, so a new policy, or
the effect of leaving a rule out, is a bitwise test on the ledger and reads no text.

Words are ``[^\\x20\\x09-\\x0D]+``; a null or empty text has none (it fails ``few_words``).
Repeated rows are measured and returned each. Null doc_ids pass through.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .textblock import (SEPARATOR, Texts, batch_slices, byte_sums, mix, prefix_sums,
                        range_hash)

#: Characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"
#: Rule bits, in order, with their thresholds. The first two are the base rules.
RULES = ("few_words", "repeated_words", "many_words", "word_length", "symbol_ratio",
         "duplicate_lines", "few_alphabetic_words", "upper_case")
MIN_WORDS, MAX_WORDS = 50, 100_000
MEAN_WORD_LENGTH = (3.0, 10.0)
MAX_SYMBOLS_PER_WORD = 0.1
MAX_DUPLICATE_LINES = 0.3
MIN_ALPHABETIC_WORDS = 0.8
MAX_UPPER_WORDS = 0.5

BIT = {name: 1 << i for i, name in enumerate(RULES)}
BASE_MASK = BIT["few_words"] | BIT["repeated_words"]
#: Versioned policies: the bits that a document may not have.
POLICIES = {
    "base": BASE_MASK,
    "v1": BASE_MASK | BIT["many_words"] | BIT["word_length"] | BIT["symbol_ratio"]
    | BIT["duplicate_lines"],
    "v2": sum(BIT.values()),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_alpha_words", "n_upper_words")

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, dtype=bool)
_LOWER[97:123] = True
# letters for the alphabetic rule: ASCII letters, and any character beyond ASCII
_ALPHA = _UPPER | _LOWER | (np.arange(256) >= 128)


def _count(flags: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    run = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=run[1:])
    return run[end] - run[begin]


def _twice(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs at least twice."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def measure(t: Texts) -> dict[str, np.ndarray]:
    """The measurements of each document of a slice."""
    n, data = len(t), t.data
    begin, end, doc = t.words()
    out = {"n_words": np.bincount(doc, minlength=n)}
    code_point = (data & 0xC0) != 0x80
    out["word_chars"] = _count(code_point & ~SEPARATOR[data], t.starts, t.ends)
    out["n_symbols"] = _count(_SYMBOL[data], t.starts, t.ends)
    upper, lower = _count(_UPPER[data], begin, end), _count(_LOWER[data], begin, end)
    out["n_alpha_words"] = np.bincount(doc[_count(_ALPHA[data], begin, end) > 0], minlength=n)
    out["n_upper_words"] = np.bincount(doc[(upper >= 2) & (lower == 0)], minlength=n)
    sums = byte_sums(data)

    l_begin, l_end, l_doc = t.lines()
    worded = _count(~SEPARATOR[data], l_begin, l_end) > 0
    out["n_lines"] = np.bincount(l_doc, minlength=n)
    wd = l_doc[worded]
    key = mix(range_hash(sums, l_begin[worded], l_end[worded]) + wd.astype(np.uint64))
    _, first = np.unique(key, return_index=True)
    out["n_dup_lines"] = np.bincount(wd, minlength=n) - np.bincount(wd[first], minlength=n)

    # words inside a 3-word window that the text holds twice or more
    repeat = np.zeros(len(begin), dtype=bool)
    if len(begin) >= 3:
        w = prefix_sums(range_hash(sums, begin, end))
        at = np.nonzero(doc[2:] == doc[:-2])[0]
        if len(at):
            two = at[_twice(mix(range_hash(w, at, at + 3) + doc[at].astype(np.uint64)))]
            for k in range(3):
                repeat[two + k] = True
    out["n_repeat_words"] = np.bincount(doc[repeat], minlength=n)
    return out


def _measure_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, t in batch_slices(batch):
            m = measure(t)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(row, end - row).cast(pa.int64())]
                + [pa.array(m[k].astype(np.int64)) for k in MEASURES], ["doc_id", *MEASURES])


def _rules() -> dict[str, Column]:
    c, w = F.col, F.col("n_words")
    # a text without words has no mean; try_divide keeps ANSI mode from failing
    mean = F.try_divide(c("word_chars").cast("double"), w)
    return {
        "few_words": w < MIN_WORDS,
        "repeated_words": 100 * c("n_repeat_words") > 50 * w,
        "many_words": w > MAX_WORDS,
        "word_length": F.coalesce(~mean.between(*MEAN_WORD_LENGTH), F.lit(False)),
        "symbol_ratio": c("n_symbols") > MAX_SYMBOLS_PER_WORD * w,
        "duplicate_lines": c("n_dup_lines") > MAX_DUPLICATE_LINES * c("n_lines"),
        "few_alphabetic_words": c("n_alpha_words") < MIN_ALPHABETIC_WORDS * w,
        "upper_case": c("n_upper_words") > MAX_UPPER_WORDS * w,
    }


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the measurements, and ``failed_bits``."""
    schema = ", ".join(["doc_id long", *(f"{m} long" for m in MEASURES)])
    measured = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .mapInArrow(_measure_batches, schema)
    bits = F.lit(0).cast("long")
    for name, failed in _rules().items():
        bits = bits.bitwiseOR(F.when(failed, F.lit(BIT[name])).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("failed_bits", bits)


def apply_policy(ledger_rows: DataFrame, version: str = "v2") -> DataFrame:
    """Add ``base_failed`` and ``kept`` under a policy."""
    bits = F.col("failed_bits")
    return ledger_rows.withColumns({
        "base_failed": bits.bitwiseAND(F.lit(BASE_MASK)) != 0,
        "kept": bits.bitwiseAND(F.lit(POLICIES[version] | BASE_MASK)) == 0,
    })


def ablations(ledger_rows: DataFrame, version: str = "v2") -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone (so leaving the
    rule out would keep them), and what the policy keeps. One bitwise aggregate over the
    distinct bit patterns, at most 2**rules of them."""
    mask = POLICIES[version]
    rules = [r for r in RULES if BIT[r] & mask]
    seen = F.col("failed_bits").bitwiseAND(F.lit(mask))
    patterns = ledger_rows.groupBy(seen.alias("pattern")).agg(F.count(F.lit(1)).alias("docs"))
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("docs"))), F.lit(0))
    row = patterns.agg(
        total(F.col("pattern") == 0).alias("kept"),
        *[total(F.col("pattern").bitwiseAND(F.lit(BIT[r])) != 0).alias(f"f_{r}") for r in rules],
        *[total(F.col("pattern") == BIT[r]).alias(f"a_{r}") for r in rules])
    one = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"f_{r}").alias("failed"),
                                       F.col(f"a_{r}").alias("failed_alone")) for r in rules]))
    return row.select("kept", one.alias("x")).select(
        F.lit(version).alias("policy"), "x.rule", "x.failed", "x.failed_alone", "kept",
        (F.col("kept") + F.col("x.failed_alone")).alias("kept_without"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents under the current policy."""
    return apply_policy(ledger(read(spark, sf_dir, "documents"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failed_bits", "n_lines", "n_alpha_words", "n_upper_words")


OP3_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
line_counts AS (
    SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE worded) - count(DISTINCT line) FILTER (WHERE worded)
        AS n_dup_lines
    FROM (SELECT r, line, regexp_matches(line, '[^\x20\x09-\x0D]') AS worded FROM lines) GROUP BY r),
windows AS (
    SELECT r, i, array_to_string(words[i:i + 2], ' ') AS content
    FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM docs)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, content) AS n FROM windows) WHERE n > 1),
repeated AS (
    SELECT r, count(DISTINCT i + k) AS n FROM (SELECT r, i, unnest([0, 1, 2]) AS k FROM twice) GROUP BY r),
words AS (SELECT r, unnest(words) AS word FROM docs),
word_counts AS (
    SELECT r, sum(length(word)) AS word_chars,
           count(*) FILTER (WHERE regexp_matches(word, '[A-Za-z]|[^\x00-\x7F]')) AS n_alpha_words,
           count(*) FILTER (WHERE regexp_matches(word, '[A-Z].*[A-Z]') AND NOT regexp_matches(word, '[a-z]'))
               AS n_upper_words
    FROM words GROUP BY r),
measured AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
           CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words, n_lines,
           coalesce(n_alpha_words, 0) AS n_alpha_words, coalesce(n_upper_words, 0) AS n_upper_words
    FROM docs JOIN line_counts USING (r) LEFT JOIN repeated USING (r) LEFT JOIN word_counts USING (r)),
failed AS (
    SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
             + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
             + CASE WHEN n_words > 100000 THEN 4 ELSE 0 END
             + CASE WHEN n_words > 0 AND word_chars / n_words NOT BETWEEN 3.0 AND 10.0 THEN 8 ELSE 0 END
             + CASE WHEN n_symbols > 0.1 * n_words THEN 16 ELSE 0 END
             + CASE WHEN n_dup_lines > 0.3 * n_lines THEN 32 ELSE 0 END
             + CASE WHEN n_alpha_words < 0.8 * n_words THEN 64 ELSE 0 END
             + CASE WHEN n_upper_words > 0.5 * n_words THEN 128 ELSE 0 END) AS failed_bits FROM measured)
SELECT *, failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept FROM failed
"""
