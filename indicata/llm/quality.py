"""Quality rules: text statistics, a base rule, and a decision list learned by sequential covering.

The learner sees only ratios of the statistics.  It grows a conjunction of thresholds by FOIL gain on two thirds of
the labelled rows, prunes it on the last third, keeps it while it is precise there, takes away what it covers and
starts anew.  The list becomes one ordered Spark conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import map_slices, whole_row

SYMBOLS = b"#*$%&|<>"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits",
              "n_marks")
FEATURES = {
    "chars_per_word": ("word_chars", "n_words"), "symbols_per_word": ("n_symbols", "n_words"),
    "dup_per_line": ("n_dup_lines", "n_lines"), "repeat_per_word": ("n_repeat_words", "n_words"),
    "upper_per_char": ("n_upper", "word_chars"), "digits_per_char": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
}


def text_statistics(text: str | None) -> tuple[int, ...]:
    """The STATISTICS of one whole text."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    threes = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(threes)) < len(threes):
        times: dict[tuple, int] = {}
        for x in threes:
            times[x] = times.get(x, 0) + 1
        reach = 0  # words before this index are counted
        for i, x in enumerate(threes):
            if times[x] > 1:
                repeated += i + 3 - max(i, reach)
                reach = i + 3
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    less = lambda chars: len(raw) - len(raw.translate(None, chars))
    return (n, len(b"".join(words).decode()), less(SYMBOLS), len(lines) - len(set(lines)), repeated, len(lines),
            less(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), less(b"0123456789"), less(b"!?"))


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``df``) and ``stats`` (STATISTICS, long) of every whole text; null counts as empty."""
    packed = whole_row(df, (text, "text"))
    row = packed.schema["row"].dataType.simpleString()
    struct = ", ".join(f"{x}: bigint" for x in STATISTICS)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = zip(*map(text_statistics, batch.column("text").to_pylist()))
        stats = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in columns], list(STATISTICS))
        return pa.RecordBatch.from_arrays([batch.column("row"), stats], ["row", "stats"])

    return map_slices(packed, "text", run, f"row {row}, stats struct<{struct}>")


def base_failed(stats: str = "stats") -> Column:
    """Under 50 words, or over half of the words in repeated three-word windows."""
    n = F.col(f"{stats}.n_words")
    return (n < 50) | (100 * F.col(f"{stats}.n_repeat_words") > 50 * n)


def feature(name: str, stats: str = "stats") -> Column:
    """A ratio of two statistics; 0 where the divisor is 0."""
    over, under = FEATURES[name]
    return F.when(F.col(f"{stats}.{under}") > 0, F.col(f"{stats}.{over}") / F.col(f"{stats}.{under}")).otherwise(
        F.lit(0.0))


@dataclass
class DecisionList:
    """Ordered rules; each is a conjunction of (feature, "<" or ">=", threshold).  A row that any covers is rejected."""

    rules: list[list[tuple[str, str, float]]] = field(default_factory=list)

    def expression(self, stats: str = "stats") -> Column:
        """The list as one ordered conditional expression: true keeps."""
        verdict = None
        for rule in self.rules:
            holds = F.lit(True)
            for name, sign, at in rule:
                x = feature(name, stats)
                holds = holds & (x >= at if sign == ">=" else x < at)
            verdict = F.when(holds, F.lit(False)) if verdict is None else verdict.when(holds, F.lit(False))
        return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))

    def __str__(self) -> str:
        shown = [" and ".join(f"{a} {b} {c:.4g}" for a, b, c in rule) for rule in self.rules]
        return "; ".join(f"reject if {x}" for x in shown) or "reject nothing"


def _covered(rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    held = np.ones(n, bool)
    for name, sign, at in rule:
        held &= x[name] >= at if sign == ">=" else x[name] < at
    return held


def _best_literal(x: dict[str, np.ndarray], bad: np.ndarray):
    """The threshold with the highest FOIL gain over these rows, halfway between neighbouring values."""
    p0, n0 = bad.sum(), (~bad).sum()
    start = np.log2(p0 / (p0 + n0))
    best = (0.0, None)
    for name in sorted(x):
        order = np.argsort(x[name], kind="stable")
        values, marks = x[name][order], bad[order]
        cut = np.flatnonzero(np.diff(values) > 0)
        if not len(cut):
            continue
        at = (values[cut] + values[cut + 1]) / 2
        p_low, n_low = np.cumsum(marks)[cut], np.cumsum(~marks)[cut]
        for sign, p, n in (("<", p_low, n_low), (">=", p0 - p_low, n0 - n_low)):
            gain = p * (np.log2(np.maximum(p, 1e-9) / (p + n)) - start)
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-9:
                best = (float(gain[k]), (name, sign, float(at[k])))
    return best[1]


def learn_list(x: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.9, support: int = 3,
               most_literals: int = 4, most_rules: int = 16) -> DecisionList:
    """Sequential covering of the ``bad`` rows.  No rows, or no bad ones: an empty list, which keeps everything."""
    grow = np.arange(len(bad)) % 3 != 2
    left, rules = np.ones(len(bad), bool), []
    while len(rules) < most_rules:
        own = grow & left
        rule = []
        while len(rule) < most_literals:
            now = own & _covered(rule, x, len(bad))
            if not (now & bad).any() or not (now & ~bad).any():
                break
            literal = _best_literal({k: v[now] for k, v in x.items()}, bad[now])
            if literal is None:
                break
            rule.append(literal)
        if not rule:
            break
        held_out = ~grow & left

        def worth(r):
            c = held_out & _covered(r, x, len(bad))
            p, n = int((c & bad).sum()), int((c & ~bad).sum())
            return ((p - n) / (p + n) if p + n else -1.0, p, p / (p + n) if p + n else 0.0)

        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=lambda r: worth(r)[:2])
        _, p, precise = worth(rule)
        if p < support or precise < precision:
            break
        rules.append(rule)
        left &= ~_covered(rule, x, len(bad))
    return DecisionList(rules)


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          most_rows: int = 10_000) -> DecisionList:
    """Learn from labelled documents (``label`` 0: bad, 1: good; null is no label; a key with several has the lowest).

    ``most_rows`` bounds the labelled sample that the driver sees (its ratios only): the keys of lowest hash.  Rows
    that the base rule fails say nothing about the list and are left out.  No labelled rows: a list that keeps all.
    """
    k, y = F.col(f"`{key}`").cast("long"), F.col(f"`{label}`")
    known = labels.where(k.isNotNull() & y.isNotNull()).groupBy(k.alias("key")).agg(F.min(y).alias("label"))
    sample = known.orderBy(F.xxhash64("key"), "key").limit(most_rows)
    rows = docs.select(k.alias("key"), F.col(f"`{text}`").alias("text")).join(F.broadcast(sample), "key")
    stats = statistics(rows).where(~base_failed()).select(
        F.col("row.key").alias("key"), F.struct(F.col("row.label").alias("label"), *[feature(x).alias(x)
                                                for x in FEATURES]).alias("seen"))
    seen = stats.groupBy("key").agg(F.min("seen").alias("seen")).select("key", "seen.*").toPandas()
    seen = seen.sort_values("key")
    return learn_list({x: seen[x].to_numpy(float) for x in FEATURES}, seen["label"].to_numpy() == 0)


def judge(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """``row`` (all columns), ``stats``, ``base_failed`` and ``kept`` of every document, by its whole text.

    ``kept`` is false if the base rule fails (so for null and empty texts), else the verdict of the list.  Each row is
    judged alone: repeated rows get equal verdicts, an empty table gives none.
    """
    return statistics(docs, text).withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & rules.expression())
