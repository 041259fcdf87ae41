"""Weak supervision for quality rules: rules vote or abstain, EM estimates how accurate each is.

A document is good or has one of several faults, each found by some rules and not by others, so a single class of
bad documents would be no model: symbols, tables and repeats share no signs. There is a fault for each rule, which at
first it alone finds; expectation-maximisation over all votes then estimates how often each rule votes bad on good
documents and on each fault, and how common each is. An abstention says nothing. So a bad vote counts by what usually
goes with it: one that the other rules would have confirmed, and don't, can be outvoted.

The metrics and the votes are built-in column expressions. The votes of all documents are counted by pattern (at
most ``3 ** len(RULES)`` rows whatever the input), the fit runs over those counts, and the posterior is again a column
expression whose weights are literals. So there is no join and no shuffle but that of the pattern counts.

Cases: null text counts as empty; empty text has zero words, fails the base rule and is rejected; repeated
rows and ties are judged row by row; an empty table gives an empty result and the start model, which also stays where the
fit finds no good class; a table of few rows, of one pattern of votes or of abstentions alone is judged by a model near
the start; a text with its words and windows is one row of one task, some fifty times its size at most; other columns are carried through unless they bear the name of a result column, which then replaces them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.functions.timeops import let
from saltmarsh.llm.common import SPACE_RUN, WORD_SPACES, materialize

SYMBOLS = "#*$%&|<>"
METRICS = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_upper", "n_mark_runs", "n_ended_lines",
    "n_letterless",
)
#: Two or more punctuation marks in a row, a sentence mark at a line's end, and a word without a letter.
MARK_RUN = r"[!?.,;:]{2,}"
ENDED = r"[.!?][\x20\x09\x0B-\x0D]*(?=\n|\z)"
LETTERLESS = r"(?<![^\x20\x09-\x0D])[^\p{L}\x20\x09-\x0D]++(?![^\x20\x09-\x0D])"
RESULT = (*METRICS, "base_failed", "p_good", "kept")


def with_metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add METRICS, all long; columns named like them or ``_words``, ``_lines``, ``_windows`` give way.

    n_repeat_words counts the words inside three-word windows that occur twice or more in the text.
    Windows are sorted by a 64-bit hash and neighbours with equal hashes are compared word for word.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WORD_SPACES)) != "")
    w, s = F.col("_words"), F.col("_windows")

    def same(x: Column, y: Column) -> Column:
        equal = y["h"] == x["h"]
        for k in range(3):
            equal = equal & (F.get(w, y["p"] + k) == F.get(w, x["p"] + k))
        return F.coalesce(equal, F.lit(False))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda p: F.struct(F.xxhash64(F.get(w, p), F.get(w, p + 1), F.get(w, p + 2)).alias("h"), p.alias("p")),
    )
    repeated = F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)))
    covered = F.aggregate(
        F.sort_array(F.transform(repeated, lambda x: x["p"])),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    return (
        docs.withColumn("_words", F.filter(F.split(text, SPACE_RUN), lambda x: x != ""))
        .withColumn("_lines", lines)
        .withColumn("_windows", F.when(F.size(w) >= 3, F.sort_array(windows)))
        .withColumns(
            {
                "n_words": F.size(w).cast("long"),
                "word_chars": F.char_length(F.translate(text, WORD_SPACES, "")).cast("long"),
                "n_symbols": (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long"),
                "n_lines": F.size("_lines").cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
                "n_distinct_words": F.size(F.array_distinct("_words")).cast("long"),
                "n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long"),
                "n_mark_runs": F.regexp_count(text, F.lit(MARK_RUN)).cast("long"),
                "n_ended_lines": F.regexp_count(text, F.lit(ENDED)).cast("long"),
                "n_letterless": F.regexp_count(text, F.lit(LETTERLESS)).cast("long"),
            }
        )
        .drop("_words", "_lines", "_windows")
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _band(value: Column, bad: Column, good: Column) -> Column:
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The labelling functions over METRICS: 1 votes for good, -1 for bad, 0 abstains between the two."""
    n, lines = (F.nullif(F.col(c), F.lit(0)) for c in ("n_words", "n_lines"))
    size, symbols, dup, repeat = F.col("word_chars") / n, F.col("n_symbols") / n, F.col("n_dup_lines") / lines, F.col("n_repeat_words") / n
    distinct, upper = F.col("n_distinct_words") / n, F.col("n_upper") / F.nullif(F.col("word_chars"), F.lit(0))
    marks, ended, letterless = F.col("n_mark_runs") / n, F.col("n_ended_lines") / lines, F.col("n_letterless") / n
    return {
        "vote_word_size": _band(size, (size < 3.6) | (size > 7.0), (size >= 4.4) & (size <= 6.0)),
        "vote_symbols": _band(symbols, symbols > 0.1, symbols == 0),
        "vote_lines": _band(dup, dup > 0.3, (dup == 0) & (lines >= 2)),
        "vote_repeats": _band(repeat, repeat > 0.2, repeat <= 0.02),
        "vote_upper": _band(upper, upper > 0.25, upper <= 0.03),
        "vote_distinct": _band(distinct, distinct < 0.5, distinct >= 0.7),
        "vote_marks": _band(marks, marks > 0.1, marks == 0),
        "vote_endings": _band(ended, ended < 0.7, ended > 0.95),
        "vote_letters": _band(letterless, letterless > 0.2, letterless < 0.02),
    }


#: Where the fit starts: the share of good documents; how often the rule of a fault votes bad on it, and any other rule does.
START_GOOD, START_OWN, START_OTHER = 0.8, 0.9, 0.1
#: Documents of the start model that are added to the shares, and votes of each rule in each class. So no chance is 0 or 1, few
#: documents leave the model near its start, and no class bends to them sooner than another.
PSEUDO_DOCUMENTS, PSEUDO_VOTES = 10.0, 8.0
ROUNDS = 300


@dataclass(frozen=True)
class RuleModel:
    """How common good documents and each fault are, and by class how often each rule that votes votes bad."""

    names: tuple[str, ...]
    shares: tuple[float, ...]  # good first, then the faults
    bad: tuple[tuple[float, ...], ...]

    def posterior(self) -> Column:
        """P(good | votes), from METRICS: one over the odds of all classes against good."""
        by_name = rules()

        def odds(votes: Column, c: int) -> Column:
            out = F.lit(math.log(self.shares[c] / self.shares[0]))
            for r in range(len(self.names)):
                against, for_ = (math.log(f(self.bad[c][r]) / f(self.bad[0][r])) for f in (float, lambda p: 1 - p))
                out = out + F.when(votes[r] < 0, against).when(votes[r] > 0, for_).otherwise(0.0)
            return F.exp(F.least(out, F.lit(700.0)))

        def share_of_good(votes: Column) -> Column:
            total = F.lit(1.0)
            for c in range(1, len(self.shares)):
                total = total + odds(votes, c)
            return 1 / total

        return let(F.array(*(by_name[name] for name in self.names)), share_of_good)

    def accuracy(self) -> float:
        """Mean over the rules of being right on good documents and on the fault that each finds best."""
        own = [max(b[r] for b in self.bad[1:]) for r in range(len(self.names))]
        return sum(o + 1 - g for o, g in zip(own, self.bad[0], strict=True)) / (2 * len(self.names))


def start_model(names: list[str]) -> RuleModel:
    n = len(names)
    bad = tuple(tuple(START_OWN if c == r + 1 else START_OTHER for r in range(n)) for c in range(n + 1))
    return RuleModel(tuple(names), (START_GOOD, *[(1 - START_GOOD) / n] * n), bad)


def expectation_maximisation(patterns: list[tuple[tuple[int, ...], int]], names: list[str], rounds: int = ROUNDS) -> RuleModel:
    """Fit shares and chances to counted vote patterns, in ``rounds`` rounds.

    The start model stays where there is nothing to fit, and where the fit leaves the rules no better than chance, as then
    no class is the good one.
    """
    start = start_model(names)
    shares, bad = first_shares, first_bad = np.array(start.shares), np.array(start.bad)
    votes, counts = np.array([v for v, _ in patterns]).reshape(-1, len(names)), np.array([c for _, c in patterns], float)
    against, for_ = (votes < 0).astype(float), (votes > 0).astype(float)
    for _ in range(rounds if counts.sum() else 0):
        log = np.log(shares) + against @ np.log(bad).T + for_ @ np.log(1 - bad).T
        p = np.exp(log - log.max(axis=1, keepdims=True))
        weight = counts[:, None] * p / p.sum(axis=1, keepdims=True)
        shares = (weight.sum(axis=0) + PSEUDO_DOCUMENTS * first_shares) / (counts.sum() + PSEUDO_DOCUMENTS)
        no, yes = weight.T @ against, weight.T @ for_
        bad = (no + PSEUDO_VOTES * first_bad) / (no + yes + PSEUDO_VOTES)
    model = RuleModel(tuple(names), tuple(map(float, shares)), tuple(tuple(map(float, b)) for b in bad))
    return model if model.accuracy() > 0.5 else start


def fit(metrics: DataFrame) -> RuleModel:
    """Count the vote patterns of every row and fit the rules to them."""
    votes = rules()
    counted = metrics.select(*(c.alias(k) for k, c in votes.items())).groupBy(*votes).count().collect()
    return expectation_maximisation(sorted((tuple(r[k] for k in votes), r["count"]) for r in counted), list(votes))


def judge(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """Return ``carry`` (all columns by default) with METRICS, base_failed, p_good and kept.

    Metrics are written once to the shared folder: both the fit and the verdict read them.
    """
    taken = [c for c in (docs.columns if carry is None else carry) if c.lower() not in RESULT]
    slim = docs.select(F.struct(F.lit(0).alias("_"), *taken).alias("carried"), F.col(text_col).alias("text"))
    metrics = materialize(with_metrics(slim).drop("text"), "quality-metrics")
    return (
        metrics.withColumn("base_failed", base_failed())
        .withColumn("p_good", fit(metrics).posterior())
        .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))
        .select(*(F.col("carried").getField(c).alias(c) for c in taken), *RESULT)
    )
