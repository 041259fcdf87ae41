"""Phrases, the line classifier and spelling variants against plain Python."""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from saltmarsh.llm import collocations, quality_crf, queries, spelling

DOCS = "doc_id long, text string, lang string, key string, score double, word string"


def rows(texts, lang="en"):
    return [(k, t, lang, "x", 1.0, "y") for k, t in enumerate(texts)]


# phrases


def pieces(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", text)]


def plain_counts(texts, most=3):
    found = Counter()
    for lang, text in texts:
        for w in pieces(text):
            for m in range(1, most + 1):
                found.update((lang, " ".join(w[i : i + m])) for i in range(len(w) - m + 1))
            found[lang, ""] += len(w)
    return found


def plain_mine(texts, least=10, most_rows=2000):
    f = plain_counts(texts)
    cand = {k: n for k, n in f.items() if len(k[1].split(" ")) >= 2 and n >= least}
    inside = defaultdict(int)
    for (lang, p), n in cand.items():
        w = p.split(" ")
        if len(w) == 3:
            for s in (w[:2], w[1:]):
                inside[lang, " ".join(s)] = max(inside[lang, " ".join(s)], n)
    out = defaultdict(list)
    for (lang, p), a in cand.items():
        if 100 * inside[lang, p] >= 50 * a and inside[lang, p]:
            continue
        w = p.split(" ")
        cuts = [(f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])], k) for k in range(1, len(w))]
        score, _, left, right = min((10**6 * a * a // (l * r), k, l, r) for l, r, k in cuts)
        out[lang].append((-score, -a, p.encode(), a, left, right))
    return sorted(
        (lang, k, p.decode(), a, left, right, f[lang, ""], -s)
        for lang, found in out.items()
        for k, (s, _, p, a, left, right) in enumerate(sorted(found)[:most_rows], 1)
    )


def counted(shard_texts, depth=3):
    shard, found = collocations.Shard(depth), Counter()
    tables = [t for lang, text in shard_texts for t in shard.add(lang.encode(), text.encode())]
    for lang, table in [*tables, *shard.flush()]:
        for phrase, n in zip(*(table[c].to_pylist() for c in ("phrase", "n")), strict=True):
            found[lang.decode(), phrase.decode()] += n
    return +found


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["en", "de"]), st.text("abAB .,\t\né", max_size=60)), max_size=6), st.integers(1, 4), st.integers(3, 40), st.integers(1, 9))
def test_automata_count_every_phrase(texts, depth, shard_words, slice_bytes):
    kept = collocations.SHARD_WORDS, collocations.SLICE_BYTES
    try:
        collocations.SHARD_WORDS, collocations.SLICE_BYTES = shard_words, slice_bytes
        assert counted(texts, depth) == +plain_counts(texts, depth)
    finally:
        collocations.SHARD_WORDS, collocations.SLICE_BYTES = kept


def test_states_are_classes_of_end_places():
    # "b" always follows "a", so both end at the same places and make one state, whose shortest phrase is "b"
    ids = np.array([0, 1, 2, 0, 3, 1, 2, 0, 1], np.int32)
    one, two, three = collocations.states(ids, 0, 3)
    assert one[2].tolist() == [3, 2, 1] and two[2].tolist() == [1, 2]
    first, parent, n, shortest = two
    assert (first.tolist(), parent.tolist(), shortest.tolist()) == ([3, 1], [0, 1], [2, 1])
    assert (three[0].tolist(), three[3].tolist()) == ([3], [3])


def test_phrases_match_plain_counts(spark):
    rng = random.Random(5)
    vocabulary = ["New", "York", "of", "the", "Émile", "a.b", "x", "y"]
    texts = [" ".join(rng.choices(vocabulary, weights=[5, 5, 9, 9, 2, 2, 1, 1], k=rng.randrange(60))) for _ in range(80)]
    texts += ["new york city"] * 12 + [None, "", " \t ", "one,two;three", "new york\ncity hall"] + ["the " * 3000]
    langs = [rng.choice(["en", "de", None]) for _ in texts]
    data = [(k, t, lang, "x", 1.0, "y") for k, (t, lang) in enumerate(zip(texts, langs, strict=True))]
    got = collocations.mine(spark.createDataFrame(data, DOCS).repartition(5)).collect()
    assert sorted(map(tuple, got)) == plain_mine([(lang or "und", t) for t, lang in zip(texts, langs, strict=True)])
    few = collocations.mine(spark.createDataFrame(data, DOCS), most=3).groupBy("lang").count().collect()
    assert {r["count"] for r in few} == {3}


def test_phrases_of_empty_tables(spark):
    for data in ([], rows([None, "", None])):
        assert collocations.mine(spark.createDataFrame(data, DOCS)).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    cases = [(10, 10, 10), (7, 9, 11), (10**13, 3 * 10**13 + 1, 5 * 10**13 + 7), (999_999_999_999, 10**15 - 1, 10**14 + 3)]
    df = spark.createDataFrame(cases, "a long, l long, r long")
    got = df.select("a", "l", "r", collocations._floor_score(df.a, df.l, df.r).alias("s")).collect()
    assert [r["s"] for r in got] == [10**6 * a * a // (l * r) for a, l, r in cases]


# the line classifier


def test_marginals_match_all_sequences():
    rng = np.random.default_rng(3)
    sizes, moves = np.array([1, 4, 6, 2]), (-0.7, -1.1, 0.9)
    e = rng.normal(size=sizes.sum()) * 2
    got, at = quality_crf.marginals(e, sizes, moves), 0
    for size in sizes:
        own, good, total = e[at : at + size], np.zeros(size), 0.0
        step = {(0, 0): 0.0, (0, 1): moves[0], (1, 0): moves[1], (1, 1): moves[2]}
        for y in itertools.product((0, 1), repeat=int(size)):
            p = math.exp(sum(a * b for a, b in zip(y, own, strict=True)) + sum(step[a] for a in itertools.pairwise(y)))
            total += p
            good += p * np.array(y)
        np.testing.assert_allclose(got[at : at + size], good / total, rtol=1e-9)
        at += size


def test_training_climbs_the_likelihood():
    texts = ["Good prose here, as it is.\nAnd more of it follows."] * 20 + ["### $$$ ###\n&&& ***"] * 20
    chain = quality_crf.train(texts, [1] * 20 + [0] * 20, rounds=60)
    good, bad = chain.score([texts[0], texts[-1]])
    assert good > 0.9 and bad < 0.1
    # a neighbour's look and label count: the same line scores lower among bad lines
    line = "Plain words stand here"
    alone, among = chain.score([line, f"### $$$ ###\n{line}\n&&& ***"])
    features, sizes, _ = quality_crf.line_features([f"### $$$ ###\n{line}\n&&& ***"])
    middle = quality_crf.marginals(chain.emissions(features, sizes), sizes, chain.moves)[1]
    assert middle < alone and among < alone


def test_classifier_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = queries.op12_quality_crf(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    met = got.join(labels, "doc_id").where("held_out").select("quality", "predicted").collect()
    assert len(met) > 50 and sum(r[0] == r[1] for r in met) >= 0.95 * len(met)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert got.count() == docs.count() and got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert {r["doc_id"] for r in got.where("held_out").collect()} == {r["doc_id"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}


def test_classifier_cases(spark):
    labels = spark.createDataFrame([(k, k % 2) for k in range(12)] + [(None, 1), (3, None), (5, 7)], "doc_id long, quality int")
    texts = ["### &&& $$$" if k % 2 == 0 else "Prose it is." for k in range(12)] + [None, "", "Prose it is.", "word " * 100_000, "\n" * 5000]
    docs = spark.createDataFrame(rows(texts), DOCS)
    got = {r["doc_id"]: r for r in quality_crf.score(docs, quality_crf.fit(docs, labels)).collect()}
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 and r["key"] == "x" for r in got.values())
    assert got[12]["score"] == got[13]["score"] and got[14]["score"] == got[1]["score"]
    none = quality_crf.fit(docs, labels.limit(0))
    assert {r["score"] for r in quality_crf.score(docs, none).collect()} == {0.5}
    assert quality_crf.score(docs.limit(0), none).count() == 0


# spelling


def plain_spelling(docs):
    n = Counter()
    for k, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
            n[word] += len(word) >= 7
    n = {w: c for w, c in n.items() if c >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near_of = {w: [v for v in n if v != w and near(w, v)] for w in n}
    form = {}
    for w, others in near_of.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near_of[w]), n.get(form[w])) for w in n)


def test_spelling_matches_plain_python(spark):
    rng = random.Random(11)
    stems = ["banananas", "bananana", "ananananas", "spelling", "speling", "spellings", "Émilienne", "emilienne", "émilienneß", "variants", "variant", "varriants"]
    texts = []
    for _ in range(300):
        word = rng.choice(stems)
        if rng.random() < 0.3:
            i = rng.randrange(len(word))
            word = word[:i] + rng.choice(["", rng.choice("abnsé"), word[i] * 2]) + word[i + 1 :]
        texts.append(f"{word} {word.upper()}x{rng.choice(stems)}, {rng.choice(stems)}")
    # a chain of forms: counts 2, 30, 400
    texts += ["chainaaa " * 2, "chainaab " * 30, "chainabb " * 400, "chainbbb " * 5000, None, "", "short words only", "z" * 50_000, "z" * 50_000]
    data = rows(texts) + [(None, "chainaab chainaab", None, "x", 1.0, "y")]
    got = sorted(map(tuple, spelling.group(spark.createDataFrame(data, DOCS)).collect()), key=lambda r: r[0])
    assert got == plain_spelling([(r[0], r[1]) for r in data])
    assert {r[2] for r in got if r[0].startswith("chaina")} == {"chainbbb"}


@pytest.mark.parametrize("texts", [[], [None, ""], ["aaaaaaa aaaaaaa"], ["abcdefg", "hijklmn"]])
def test_spelling_of_small_tables(spark, texts):
    got = sorted(map(tuple, spelling.group(spark.createDataFrame(rows(texts), DOCS)).collect()))
    assert got == plain_spelling(list(enumerate(texts)))
