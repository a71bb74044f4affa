"""Quality by weak supervision: rules vote or abstain, and expectation-maximisation weighs their votes.

Each rule looks at one statistic of a text and votes poor (0), abstains (1) or votes good (2). All texts with the same votes
are one pattern; the patterns with their counts, at most 3 to the number of rules, are all that expectation-maximisation
needs. It estimates the share of good texts and, per rule, how often it votes either way on good and on poor texts. The
posterior probability of good, not a rule that must pass, decides.

Defined cases: a null or empty text has no words, all counts 0, and fails the base rule. Rows that repeat are each counted
and answered. An empty table gives an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.texts import Texts, hashes, slabs

#: Characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
#: Steps of expectation-maximisation at most, and the change of a posterior below which it ends.
STEPS = 200
SETTLED = 1e-7

#: Statistics of a text, all long.
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_letters", "n_marks", "n_closed_lines")

#: name: (value, poor if at least, good if at most). A value that is null, or between the two, is an abstention.
RULES = {
    "symbols": ("try_divide(n_symbols, n_words)", 0.10, 0.02),
    "capitals": ("try_divide(n_capitals, n_letters)", 0.50, 0.20),
    "marks": ("try_divide(n_marks, n_words)", 0.60, 0.35),
    "repeated_lines": ("try_divide(n_dup_lines, n_lines)", 0.30, 0.05),
    "repeated_words": ("try_divide(n_repeat_words, n_words)", 0.40, 0.10),
    "open_lines": ("1 - try_divide(n_closed_lines, n_lines)", 0.80, 0.30),
    "word_length": ("abs(try_divide(word_chars, n_words) - 6)", 4.0, 2.5),
    "other_characters": ("1 - try_divide(n_letters, word_chars)", 0.30, 0.15),
}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_LETTER = _CAPITAL.copy()
_LETTER[97:123] = True
_LETTER[0xC2:] = True  # first byte of a character beyond ASCII
_HEAD = np.ones(256, bool)
_HEAD[0x80:0xC0] = False
_MARK = np.zeros(256, bool)
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_CLOSING = np.zeros(256, bool)
_CLOSING[list(b".!?:;\"')")] = True


def repeated_window_words(texts: Texts, width: int = 3) -> np.ndarray:
    """Per text, words that stand in a window of ``width`` words found twice or more in that text."""
    words = texts.words
    values, at = words.windows(width)
    if not len(values):
        return np.zeros(len(texts), np.int64)
    owner = words.owner[at]
    order = np.lexsort((values, owner))
    same = (values[order][1:] == values[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(values), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    covered = np.zeros(len(words.starts), bool)
    for k in range(width):
        covered[at[twice] + k] = True
    return np.bincount(words.owner[covered], minlength=len(texts))


def line_counts(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text, lines that hold a word, those equal to an earlier one, and those that end like a sentence."""
    data, words = texts.data, texts.words
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([texts.offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([texts.offsets[1:], breaks]), kind="stable")
    first = np.searchsorted(words.starts, starts)
    held = np.searchsorted(words.starts, ends) > first
    starts, ends = starts[held], ends[held]
    owner = np.searchsorted(texts.offsets, starts, side="right") - 1
    last = words.ends[np.searchsorted(words.starts, ends) - 1] - 1
    values = hashes(data, starts, ends)
    order = np.lexsort((values, owner))
    same = (values[order][1:] == values[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    count = lambda of: np.bincount(of, minlength=len(texts))
    return count(owner), count(owner[order][1:][same]), count(owner[_CLOSING[data[last]]])


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and STATISTICS of every whole text."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            texts = Texts.of(batch.column(1))
            words = texts.words
            bounds = texts.offsets

            def count(kind, texts=texts, bounds=bounds):
                marks = np.concatenate([[0], np.cumsum(kind[texts.data])])
                return np.diff(marks[bounds])

            inside = np.zeros(len(texts.data) + 1, np.int64)
            inside[words.starts] = 1
            inside[words.ends] -= 1
            heads = np.concatenate([[0], np.cumsum(_HEAD[texts.data] & (np.cumsum(inside[:-1]) > 0))])
            n_lines, n_dup_lines, n_closed = line_counts(texts)
            values = {
                "n_words": words.counts,
                "word_chars": np.diff(heads[bounds]),
                "n_symbols": count(_SYMBOL),
                "n_dup_lines": n_dup_lines,
                "n_repeat_words": repeated_window_words(texts),
                "n_lines": n_lines,
                "n_capitals": count(_CAPITAL),
                "n_letters": count(_LETTER),
                "n_marks": count(_MARK),
                "n_closed_lines": n_closed,
            }
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(values[x], pa.int64()) for x in STATISTICS)], names=[key, *STATISTICS])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).alias("text")).mapInArrow(measure, f"`{key}` {kind}, " + ", ".join(f"{x} long" for x in STATISTICS))


def base_failed(n_words="n_words", n_repeat_words="n_repeat_words"):
    return (F.col(n_words) < MIN_WORDS) | (100 * F.col(n_repeat_words) > 50 * F.col(n_words))


def pattern(rules: dict = RULES):
    """The votes of all rules as one number: base 3, the first rule last."""
    number = F.lit(0)
    for value, poor, good in reversed(rules.values()):
        value = F.expr(value)
        number = number * 3 + F.when(value >= poor, 0).when(value <= good, 2).otherwise(1)
    return number.cast("int")


def votes(number: int, rules: dict = RULES) -> list[int]:
    return [number // 3**k % 3 for k in range(len(rules))]


def weigh(counts: dict[int, int], rules: dict = RULES) -> dict[int, float]:
    """Posterior probability of good for each pattern, by expectation-maximisation over all texts.

    It starts from rules that are right more often than not, and a Dirichlet prior of a hundredth of the texts keeps it
    there: without it the two classes could change places or follow another division of the texts.
    """
    if not counts:
        return {}
    numbers = sorted(counts)
    seen = np.array([votes(x, rules) for x in numbers])
    n = np.array([counts[x] for x in numbers], float)
    onehot = np.stack([seen == v for v in range(3)], -1).astype(float)  # pattern, rule, vote
    start = np.array([[0.40, 0.30, 0.30], [0.02, 0.18, 0.80]])  # class (poor, good), vote
    prior = start[:, None, :] * max(1.0, 0.01 * n.sum())
    chances, share = np.repeat(start[:, None, :], len(rules), 1), np.array([0.2, 0.8])
    posterior = np.zeros((len(n), 2))
    for _ in range(STEPS):
        logs = np.log(share) + np.einsum("prv,crv->pc", onehot, np.log(chances))
        now = np.exp(logs - logs.max(1, keepdims=True))
        now /= now.sum(1, keepdims=True)
        moved = np.abs(now - posterior).max()
        posterior = now
        if moved < SETTLED:
            break
        held = posterior * n[:, None]
        share = (held.sum(0) + 1) / (n.sum() + 2)
        chances = np.einsum("pc,prv->crv", held, onehot) + prior
        chances /= chances.sum(-1, keepdims=True)
    return {number: float(p) for number, p in zip(numbers, posterior[:, 1], strict=True)}


def judge(measured: DataFrame, rules: dict = RULES) -> DataFrame:
    """``measured`` (a stored result of ``statistics``) with base_failed, quality (the posterior) and kept."""
    spark = measured.sparkSession
    voted = measured.withColumn("_pattern", pattern(rules))
    counts = {row["_pattern"]: row["count"] for row in voted.where(~base_failed()).groupBy("_pattern").count().collect()}
    known = weigh(counts, rules)
    weights = spark.createDataFrame(sorted(known.items()), "_pattern int, quality double")  # 3 to the number of rules rows at most
    return (
        voted.join(F.broadcast(weights), "_pattern", "left")
        .drop("_pattern")
        .withColumn("base_failed", base_failed())
        .withColumn("quality", F.coalesce("quality", F.lit(0.0)))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
    )
