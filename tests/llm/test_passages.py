"""Line dedup of whole repeated passages."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from saltmarsh.llm import line_dedup
from tests.llm.test_dedup import passage

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def stage(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    return sorted((r.doc_id, r.text) for r in corpus_pipeline.lines(spark, docs, "").collect())


def brute(rows):
    """The stage by plain Python; words are counted as text.split() does in ASCII."""
    rows = sorted(rows)
    seen, out = set(), []
    for doc_id, text in rows:
        lines = text.split("\n")
        words = [len(x.split()) for x in lines]
        gone, run = set(), []

        def close():
            if run and sum(words[i] for i in {*run, run[-1] + 1}) >= line_dedup.CHUNK_WORDS:
                gone.update({*run, run[-1] + 1})
            run.clear()

        for i, line in enumerate(lines):
            if words[i] >= line_dedup.LONG_WORDS and (line,) in seen:
                gone.add(i)
            seen.add((line,))
            if tuple(lines[i : i + 2]) in seen and i + 1 < len(lines):
                run.append(i)
            else:
                close()
            seen.add(tuple(lines[i : i + 2]))
        close()
        out.append((doc_id, "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return out


def planted(n_lines: int, n_words: int):
    """20 pairs of documents that share a passage between lines of their own."""
    rows, want = [], []
    for k in range(20):
        shared = [passage(10_000 + 100 * k + j, n_words) for j in range(n_lines)]
        for d in range(2):
            own = [passage(50_000 + 1000 * d + 10 * k + j, 11) for j in range(8)]
            rows.append((100 * d + k, "\n".join([*own[:4], *shared, *own[4:]])))
            want.append((100 * d + k, "\n".join([*own[:4], *([] if d else shared), *own[4:]])))
    return rows, sorted(want)


@pytest.mark.parametrize(("n_lines", "n_words"), [(2, 30), (3, 20), (4, 15), (5, 15), (6, 10), (8, 10)])
def test_passages_of_few_lines_go_to_their_edges(spark, n_lines, n_words):
    rows, want = planted(n_lines, n_words)
    assert stage(spark, rows) == want == brute(rows)


@pytest.mark.parametrize(("n_lines", "n_words"), [(20, 3), (12, 6)])
def test_blocks_of_short_lines_go_whole(spark, n_lines, n_words):
    rows, want = planted(n_lines, n_words)
    assert stage(spark, rows) == want == brute(rows)


def test_repeats_of_all_kinds_equal_brute_force(spark):
    r = random.Random(7)
    pool = [passage(k, r.choice([0, 1, 3, 8, 15, 49, 50, 60])) for k in range(60)]
    rows = []
    for k in range(150):
        lines = []
        while len(lines) < 25:
            at, n = r.randrange(len(pool)), r.choice([0, 1, 1, 2, 4, 7])
            lines += [passage(1000 + 100 * k + len(lines), 5), *pool[at : at + n]]
        rows.append((k, "\n".join(lines)))
    assert stage(spark, rows) == brute(rows)


def test_many_hashes_give_the_same_as_few(spark, monkeypatch):
    rows, want = planted(4, 15)
    monkeypatch.setattr(line_dedup, "BROADCAST_HASHES", 0)
    monkeypatch.setattr(line_dedup, "HOT", 3)
    hot = "\n".join(passage(k, 12) for k in range(3))
    rows = [(i, f"{t}\n{hot}") for i, t in rows]
    assert stage(spark, rows) == brute(rows)


def test_awkward_passages(awkward, empty):
    out = line_dedup.dedup_passages(awkward).collect()
    assert len(out) == awkward.count() and line_dedup.dedup_passages(empty).collect() == []
    assert all(r["hash"] == "hash!" and r["rest"] == "rest!" and r["texts"] == "texts!" for r in out)
    assert [(r.text, r.n_lines) for r in out if r.doc_id == 2] == [(None, 0)]
    assert [r.n_removed_lines for r in out if r.doc_id == 5] == [0]


def test_words_parted_by_tabs_count(spark):
    table = [passage(900 + j, 6).replace(" ", "\t") for j in range(5)]
    long = passage(990, 60).replace(" ", "\t")
    rows = [(k, "\n".join([passage(2000 + k, 9), *table, passage(3000 + k, 9), long, passage(4000 + k, 9)])) for k in range(3)]
    out = stage(spark, rows)
    assert out == brute(rows)
    assert out[1][1] == "\n".join(passage(n, 9) for n in (2001, 3001, 4001))
