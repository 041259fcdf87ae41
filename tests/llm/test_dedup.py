"""Operators 5 and 6 against brute force, and the cases their docstrings name."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np

from saltmarsh.llm import common, line_dedup, near_dedup


def passage(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


def test_passages_over_fifty_words_go_and_other_lines_stay(spark):
    shared = passage(0, 60)
    docs = [(k, f"{passage(100 + k, 12)}\n{shared}\n{passage(200 + k, 30)}") for k in range(6)]
    out = {r.doc_id: r for r in line_dedup.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert out[0].text == docs[0][1] and out[0].n_removed_lines == 0
    for k in range(1, 6):
        assert out[k].text == docs[k][1].replace(shared + "\n", "") and out[k].n_removed_lines == 1 and out[k].n_lines == 3


def test_boundaries_resist_shifts(spark):
    body = [passage(k, 9) for k in range(40)]
    docs = [(1, "\n".join(body)), (2, "\n".join([passage(99, 7), passage(98, 7), passage(97, 7), *body]))]
    out = {r.doc_id: r for r in line_dedup.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert out[1].n_removed_lines == 0 and out[2].n_removed_lines >= 30
    assert out[2].text.startswith(passage(99, 7))


def test_awkward_documents(awkward, empty):
    out = line_dedup.dedup(awkward).collect()
    assert len(out) == awkward.count() and line_dedup.dedup(empty).collect() == []
    assert all(r["hash"] == "hash!" and r["rest"] == "rest!" and r["texts"] == "texts!" for r in out)
    texts = {(r.doc_id, r.text) for r in awkward.collect()}
    assert all((r.doc_id, r.text) in texts for r in out if not r.n_removed_lines)
    assert [r.text for r in out if r.doc_id == 2] == [None]
    # the long line of document 5 stands once; the lines that repeat inside document 9 stay but for repeated chunks
    assert [r.n_removed_lines for r in out if r.doc_id == 5] == [0]


def brute(rows, width):
    def shingles(text):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(str.maketrans("\t\n\x0b\x0c\r", " " * 5)).split(" ")
        w = [x for x in w if x]
        return {tuple(w)} if 0 < len(w) < width else {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, len(s), least[find(k)]) for k, (i, s) in enumerate(sets))


def chain(n: int) -> list[tuple[int, str]]:
    """Each text is near the next, but the ends are not."""
    w = passage(5, 60 + 4 * n).split()
    return [(1000 - k, " ".join(w[4 * k : 4 * k + 60])) for k in range(n)]


def test_near_duplicates_equal_brute_force(spark):
    base = [passage(k, 50).split() for k in range(4)]
    rows = chain(12)
    for k in range(120):
        words = list(base[k % 4])
        for _ in range(k % 9):
            words[random.Random(k).randrange(50)] = f"x{k}"
        rows.append((k, " ".join(words).upper() if k % 5 == 0 else " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for width in (2, 5):
        got = near_dedup.group(docs, width).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, width)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_merged_lists_count_what_a_comparison_counts():
    r = np.random.default_rng(3)
    sketches = r.integers(0, 256, (400, near_dedup.COORDINATES), dtype=np.uint8)
    for k in range(300):  # near copies of row 0 of every degree, and values that all rows share
        same = r.permutation(near_dedup.COORDINATES)[: k % 65]
        sketches[100 + k, same] = sketches[0, same]
    sketches[:, :20] = 7
    lists = near_dedup._Lists(sketches)
    for i in (0, 5, 399):
        agree = (sketches == sketches[i]).sum(axis=1)
        want = np.flatnonzero(agree >= near_dedup.MATCHES)
        met, times = lists.collisions(sketches[i])
        assert met.tolist() == want.tolist() and times.tolist() == agree[want].tolist()


def test_hot_keys_are_joined_alike(spark, monkeypatch):
    rows = [(k % 3 if k % 4 else None, k) for k in range(300)] + [(9, 1000)]
    left = spark.createDataFrame(rows, "key long, v long")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (5, "c")], "key long, w string")
    want = {how: Counter(map(tuple, left.join(right, "key", how).collect())) for how in ("inner", "left")}
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    for how in want:
        assert Counter(map(tuple, common.join_skewed(left, right, "key", how).collect())) == want[how]


def test_a_common_passage_in_a_third_of_all_documents(spark):
    hot = passage(1, 40)
    rows = [(k, f"{hot} {passage(50 + k, 12 if k % 2 else 60)}") for k in range(150)] + [(1000 + k, passage(900 + k, 40)) for k in range(150)]
    got = near_dedup.group(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 2)


def test_near_duplicates_of_awkward_documents(awkward, empty):
    got = near_dedup.group(awkward, 2).collect()
    assert len(got) == awkward.count() and near_dedup.group(empty, 2).collect() == []
    by_id = {(r.doc_id, r.n_shingles): r for r in got}
    assert by_id[8, 5].component_id == 1 and not by_id[8, 5].kept
    assert by_id[2, 0].component_id == 2 and by_id[2, 0].kept and by_id[3, 0].kept
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
