"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. What speaks for either is what the line looks like (FEATURES), what the lines before and after
it look like, and which of the two its neighbours are: forward and backward messages over the whole text give each line
its marginal chance of being good, and the mean of those, weighted by the characters of the lines, is the document's score.

Training takes a bounded sample: of the labelled rows the SAMPLE_ROWS first in the order of a hash, and of each the
first SAMPLE_CHARS characters and SAMPLE_LINES lines, which all bear the document's label. Maximum likelihood with a small penalty, by
gradient steps over the same messages, in numpy on the driver. Scoring covers every line of every text, in an Arrow
function of the text column alone; other columns stay where they are, and nothing is shuffled. The model is some 60 numbers.

Kinds of characters are counted over the bytes of a whole batch at once; a message is one number, as there are two labels,
so a chain of any length takes two passes of plain arithmetic.

Cases: null and empty texts have one empty line and its score; lines are parted by ``\\n``; repeated rows score alike; a
sample without labels scores 0.5 everywhere, one of a single label leans to it by the penalty's measure; labels that
are null, or neither 0 nor 1, are not used; a document with several labels is sampled with each; an empty table gives an
empty result; a column named like a result gives way.
"""

from __future__ import annotations

import math
import string
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.llm.common import ship

#: Bounds of the training sample: rows, and characters and lines of each.
SAMPLE_ROWS, SAMPLE_CHARS, SAMPLE_LINES = 4000, 20_000, 200
#: Rounds and rate of the gradient steps, and the weight of the penalty.
ROUNDS, RATE, PENALTY = 300, 0.05, 1e-3
#: Characters of a kind, per character of the line.
SHARES = ("letters", "upper", "digits", "symbols", "marks", "mark_runs", "vowels")
FEATURES = (*SHARES, "log_length", "word_length", "words", "repeated_words", "same_words", "ended", "blank", "seen", "after_same")
#: Emissions beyond this are as good as certain.
CLAMP = 30.0


def _kind(characters: str) -> np.ndarray:
    """Which bytes are one of these ASCII characters."""
    out = np.zeros(256, bool)
    out[np.frombuffer(characters.encode(), np.uint8)] = True
    return out


_UPPER, _DIGITS, _MARKS, _SYMBOLS = _kind(string.ascii_uppercase), _kind(string.digits), _kind(".,;:!?"), _kind("#*$%&|<>=_{}@~^\\/+[]")
_LETTERS = _kind(string.ascii_letters) | (np.arange(256) >= 0xC3)
#: The letters U+00C0 to U+00FF are the byte 0xC3 and one of 64 others.
_LATIN = [chr(c) for c in range(0xC0, 0x100)]
_VOWELS = _kind("aeiouyAEIOUY")
_LATIN_UPPER, _LATIN_VOWELS = np.zeros(256, bool), np.zeros(256, bool)
_LATIN_UPPER[0x80:0xC0] = [c.isupper() for c in _LATIN]
_LATIN_VOWELS[0x80:0xC0] = [unicodedata.normalize("NFD", c)[0].lower() in "aeiouy" for c in _LATIN]


def _shares(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """SHARES of each line of UTF-8 text, each ended by a newline, and the characters of each line; letters beyond U+00FF are letters alone."""
    b = np.frombuffer(data, np.uint8)
    starts = np.concatenate([[0], np.flatnonzero(b == 10)[:-1] + 1])
    count = lambda mask: np.add.reduceat(mask, starts, dtype=np.int64)
    latin = np.zeros(len(b), bool)
    latin[1:] = b[:-1] == 0xC3
    mark = _MARKS[b]
    run = np.zeros(len(b), bool)  # the second mark of a run
    run[1:] = mark[1:] & mark[:-1]
    run[2:] &= ~mark[:-2]
    chars = count((b & 0xC0) != 0x80) - 1
    kinds = (_LETTERS[b], _UPPER[b] | latin & _LATIN_UPPER[b], _DIGITS[b], _SYMBOLS[b], mark, run, _VOWELS[b] | latin & _LATIN_VOWELS[b])
    return np.stack([count(k) for k in kinds], axis=1) / np.maximum(chars, 1)[:, None], chars


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """FEATURES of every line, the number of lines of each text, and the characters of each line (at least 1)."""
    by_text = [(t or "").split("\n") for t in texts]
    shares, chars = _shares("".join(f"{t or ''}\n" for t in texts).encode())
    n_lines = len(chars)
    own = np.zeros((n_lines, 8))
    at = 0
    for part in by_text:
        seen: set[str] = set()
        before = None
        for line in part:
            words = line.split()
            n = len(words)
            if n:
                same = sum(map(str.__eq__, words, words[1:]))
                own[at] = len(line) / n, math.log1p(n), 1 - len(set(words)) / n, same / n, words[-1][-1] in ".!?", 0, line in seen, line == before
                seen.add(line)
            else:
                own[at, 5] = 1
            before = line
            at += 1
    return np.hstack([shares, np.log1p(chars)[:, None], own]), np.array([len(p) for p in by_text]), np.maximum(chars, 1)


def with_neighbours(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A constant, each line's features, those of the lines before and after it, and whether there are such lines."""
    ends = np.cumsum(sizes)
    first, last = np.zeros(len(x), bool), np.zeros(len(x), bool)
    first[ends - sizes], last[ends - 1] = True, True
    before, after = np.roll(x, 1, axis=0), np.roll(x, -1, axis=0)
    before[first], after[last] = 0, 0
    return np.hstack([np.ones((len(x), 1)), x, before, after, ~first[:, None], ~last[:, None]])


@dataclass(frozen=True)
class Chain:
    """Means and scales of the features, weights for good against bad, and the weights of neighbours (bad-good, good-bad, good-good)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    moves: tuple[float, float, float]

    def emissions(self, features: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return np.clip(with_neighbours((features - self.mean) / self.scale, sizes) @ self.weights, -CLAMP, CLAMP)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """The length-weighted mean of the marginals of each text's lines."""
        features, sizes, chars = line_features(texts)
        good = marginals(self.emissions(features, sizes), sizes, self.moves)
        starts = np.cumsum(sizes) - sizes
        return np.add.reduceat(good * chars, starts) / np.add.reduceat(chars, starts)


def marginals(emissions: np.ndarray, sizes: np.ndarray, moves: tuple[float, float, float]) -> np.ndarray:
    """P(good) of every line, by forward and backward messages, each the logarithm of good against bad."""
    bad_good, good_bad, good_good = (math.exp(m) for m in moves)
    exp, log = math.exp, math.log
    e = emissions.tolist()
    forward, back = [0.0] * len(e), [0.0] * len(e)
    start = 0
    for size in sizes.tolist():
        end = start + size
        m = e[start]
        forward[start] = m
        for i in range(start + 1, end):
            good = exp(m)
            m = forward[i] = e[i] + log((bad_good + good_good * good) / (1 + good_bad * good))
        m = 0.0
        for i in range(end - 1, start, -1):
            good = exp(e[i] + m)
            m = back[i - 1] = log((good_bad + good_good * good) / (1 + bad_good * good))
        start = end
    return 1 / (1 + np.exp(-(np.array(forward) + np.array(back))))


def train(texts: list[str], labels: list[int], rounds: int = ROUNDS) -> Chain:
    """Fit the chain: every line of a text bears its label. Messages of all texts move together, a line place at a time."""
    width = 3 * len(FEATURES) + 3
    if not texts:
        return Chain(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(width), (0.0, 0.0, 0.0))
    features, sizes, _ = line_features(texts)
    mean, scale = features.mean(axis=0), np.maximum(features.std(axis=0), 1e-3)
    x = with_neighbours((features - mean) / scale, sizes)
    doc, starts = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes) - sizes
    place = np.arange(len(x)) - starts[doc]
    y = np.array(labels, float)[doc]
    # longest first, so that the texts which reach a place are the first ones
    rank = np.empty(len(sizes), int)
    rank[np.argsort(-sizes, kind="stable")] = np.arange(len(sizes))
    row, reach = rank[doc], [int((sizes > t).sum()) for t in range(sizes.max())]
    share = 1 / sizes[doc]  # each text weighs the same
    theta, steps = np.zeros(width + 3), [np.zeros(width + 3), np.zeros(width + 3)]
    pairs = place > 0
    pair_y = np.array([y, 1 - y, y])[:, pairs]  # lines of a text are alike: bad-good and good-bad never occur
    observed = np.array([0.0, 0.0, (pair_y[2] * share[pairs]).sum()])
    for step in range(1, rounds + 1):
        w, t = theta[:width], theta[width:]
        e = np.zeros((len(sizes), sizes.max()))
        e[row, place] = np.clip(x @ w, -CLAMP, CLAMP)
        forward, back = np.zeros_like(e), np.zeros_like(e)
        forward[:, 0] = e[:, 0]
        for k in range(1, sizes.max()):
            n = reach[k]
            m = forward[:n, k - 1]
            forward[:n, k] = e[:n, k] + np.logaddexp(t[0], t[2] + m) - np.logaddexp(0, t[1] + m)
        for k in range(sizes.max() - 1, 0, -1):
            n = reach[k]
            m = e[:n, k] + back[:n, k]
            back[:n, k - 1] = np.logaddexp(t[1], t[2] + m) - np.logaddexp(0, t[0] + m)
        good = 1 / (1 + np.exp(-(forward + back)[row, place]))
        a, b = forward[row[pairs], place[pairs] - 1], (e + back)[row[pairs], place[pairs]]
        joint = np.stack([t[0] + b, t[1] + a, t[2] + a + b])
        joint = np.exp(joint - np.logaddexp.reduce(np.vstack([joint, np.zeros((1, joint.shape[1]))])))
        slope = np.concatenate([x.T @ ((y - good) * share), observed - (joint * share[pairs]).sum(axis=1)]) / len(sizes) - PENALTY * theta
        # steps by the mean and the spread of past slopes
        steps[0] = 0.9 * steps[0] + 0.1 * slope
        steps[1] = 0.999 * steps[1] + 0.001 * slope**2
        theta = theta + RATE * (steps[0] / (1 - 0.9**step)) / (np.sqrt(steps[1] / (1 - 0.999**step)) + 1e-8)
    return Chain(mean, scale, theta[:width], tuple(theta[width:].tolist()))


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; ids that are null count as empty texts."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Chain:
    """Train on a bounded sample of the labelled rows that aren't held out."""
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    chosen = usable.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).distinct().orderBy(F.xxhash64("id"), "id", "y").limit(SAMPLE_ROWS)
    rows = docs.select(F.col(id_col).alias("id"), F.substring(F.coalesce(F.col(text_col), F.lit("")), 1, SAMPLE_CHARS).alias("text"))
    met = rows.join(F.broadcast(chosen), "id").orderBy(F.xxhash64("id"), "id", "y", "text").limit(SAMPLE_ROWS).select("text", "y").toArrow()
    return train(["\n".join(t.split("\n", SAMPLE_LINES)[:SAMPLE_LINES]) for t in met["text"].to_pylist()], met["y"].to_pylist())


def score(docs: DataFrame, chain: Chain, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of each text."""
    ship(docs.sparkSession)

    @F.arrow_udf("double")
    def scored(text: pa.Array) -> pa.Array:
        return pa.array(chain.score(text.to_pylist())) if len(text) else pa.array([], pa.float64())

    return docs.withColumn(name, scored(F.coalesce(F.col(text_col), F.lit(""))))
