"""The whole pipeline against an independent version in plain Python, on documents with planted cases."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import unicodedata
from collections import Counter

import public_tokenizers as P
import pytest

import corpus_pipeline
from saltmarsh.llm import mixing
from tests.llm.test_dedup import brute as near_groups
from tests.llm.test_dedup import passage
from tests.llm.test_native import WORD, fitted, metrics
from tests.llm.test_passages import brute as without_passages


def votes(text: str) -> tuple[int, ...]:
    n_words, chars, symbols, dup, repeats = metrics(text)
    if not n_words:
        return (0,) * 9
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    letter = lambda c: unicodedata.category(c).startswith("L")
    upper = sum(unicodedata.category(c) == "Lu" for c in text)
    marks, ended = len(re.findall(r"[!?.,;:]{2,}", text)), sum(bool(re.search(r"[.!?][\t \x0b-\r]*$", x)) for x in lines)
    letterless = sum(not any(map(letter, w)) for w in words)

    def vote(bad: bool, good: bool) -> int:
        return -1 if bad else 1 if good else 0

    size, distinct = chars / n_words, len(set(words)) / n_words
    return (
        vote(size < 3.6 or size > 7, 4.4 <= size <= 6),
        vote(symbols / n_words > 0.1, symbols == 0),
        vote(dup / len(lines) > 0.3, dup == 0 and len(lines) >= 2),
        vote(repeats / n_words > 0.2, repeats / n_words <= 0.02),
        vote(upper / chars > 0.25, upper / chars <= 0.03),
        vote(distinct < 0.5, distinct >= 0.7),
        vote(marks / n_words > 0.1, marks == 0),
        vote(ended / len(lines) < 0.7, ended / len(lines) > 0.95),
        vote(letterless / n_words > 0.2, letterless / n_words < 0.02),
    )


def good(rows):
    cast = {k: votes(t) for k, (_, t, _) in enumerate(rows)}
    chance = fitted(Counter(cast.values()), 9)
    out = []
    for k, row in enumerate(rows):
        n, _, _, _, repeats = metrics(row[1])
        if n >= 50 and 100 * repeats <= 50 * n and chance[cast[k]] >= 0.5:
            out.append(row)
    return out


def mixed(rows):
    """Copies of each row: shares by weight with water filled up to twice a source, then combs with one offset each."""
    words = [len(WORD.findall(t)) for _, t, _ in rows]
    sources = sorted({s for _, _, s in rows})
    size = {s: sum(n for n, r in zip(words, rows, strict=True) if r[2] == s) for s in sources}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}
    target, left = {}, 1.5 * sum(words)
    open_ = list(sources)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if 2 * size[s] <= level * weight[s]]
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2 * size[s] for s in full}
        left -= sum(2 * size[s] for s in full)
        open_ = [s for s in open_ if s not in full]

    def comb(chosen, rate, mark):
        offset = int(hashlib.md5(mark.encode()).hexdigest()[:8], 16) / 2**32
        return {k: int((rate * (n + 1) + offset) // 1 - (rate * n + offset) // 1) for n, k in enumerate(chosen)}

    def size_class(n):
        bits = max(1, n.bit_length())
        return bits * 16 + (n >> max(0, bits - 4))

    copies = {}
    for s in sources:
        mine = [k for k, r in enumerate(rows) if r[2] == s]
        least = {}
        for k in mine:
            least[size_class(words[k])] = min(words[k], least.get(size_class(words[k]), words[k]))
        giant = lambda k: mixing.GIANTS * least[size_class(words[k])] > size[s]  # noqa: B023, E731
        digest = lambda k: hashlib.md5(str(rows[k][0]).encode()).hexdigest()
        order = sorted(mine, key=lambda k: (size_class(words[k]), int(digest(k)[:8], 16) % 256, digest(k), rows[k][0]))
        first = comb([k for k in order if giant(k)], target[s] / size[s], f"0:giant:s{s}")
        rest = [k for k in order if not giant(k)]
        goal = target[s] - sum(n * words[k] for k, n in first.items())
        rate = min(2.0, max(0.0, goal / sum(words[k] for k in rest))) if any(words[k] for k in rest) else 0.0
        copies |= first | comb(rest, rate, f"0:s{s}")
    return [r for k, r in enumerate(rows) for _ in range(copies[k])]


def planted():
    r = random.Random(11)
    shared = [passage(9000 + k, 60) for k in range(3)]
    rows = []
    for k in range(240):
        lines = [passage(100 * k + j, r.randint(8, 30)) + "." for j in range(r.randint(4, 9))]
        if k % 7 == 0:
            lines.insert(2, shared[k % 3])
        if k % 11 == 0:
            lines = [" ".join(f"{w}$$$" for w in x.split()) for x in lines]
        if k % 13 == 0:
            lines = [lines[0]] * 12
        if k % 17 == 0:
            lines = [x.upper().replace(" ", "!! ") for x in lines]
        rows.append((k, "\n".join(lines), f"src{k % 5}"))
    base = passage(77, 200).split()
    for k in range(30):  # copies, exact and near
        words = list(base)
        for _ in range(k % 4):
            words[r.randrange(200)] = f"x{k}"
        rows.append((300 + k, " ".join(words), "src1"))
    rows += [(400, passage(5, 3000), "src2"), (401, "short", "src0"), (402, "", "src0")]
    return rows


def test_run_equals_plain_python(spark, tmp_path):
    rows = planted()
    spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    kept = good(rows)
    source = {i: s for i, _, s in kept}
    lines = without_passages([(i, t) for i, t, _ in kept])
    first = {i: least for i, _, least in near_groups(lines, 5)}
    alone = [(i, t, source[i]) for i, t in lines if first[i] == i]
    copies = mixed(alone)
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter((i, tuple(library.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest()) for i, t, _ in copies)
    got = Counter((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert len(rows) > len(kept) > len(alone) > 100
    assert got == want


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_a_stage_of_nothing_is_nothing(spark, stage):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert dict(corpus_pipeline.STAGES)[stage](spark, empty, "").collect() == []
