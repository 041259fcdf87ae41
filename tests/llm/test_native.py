"""The operators made of DataFrame functions: 2, 3, 4, 7, 8 and 9."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from saltmarsh.llm import chat_format, mixing, quality_rules, queries, sharding, topk, url_filters

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_topk_with_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (0, [0.5, -0.25]), (1, [0.5, -0.25]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0])]
    rows += [(6, [0.25]), (7, []), (8, [-0.0003, 0.9]), (100, [1.0, 0.0])] + [(200 + k, [0.5, -0.25]) for k in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("class", F.lit("x")).withColumn("q", F.lit(1))
    got = sorted(map(tuple, topk.search(df, F.col("id") % 100 == 0).select("query_id", "rank", "vec_id", "score").collect()))
    whole = [(i, [math.floor(1024 * x) for x in v] + [0] * (2 - len(v))) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, v in {(q, tuple(v)) for q, v in whole if q % 100 == 0}:
        best = sorted({(-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q})[:10]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert got == sorted(want)
    assert topk.search(df.limit(0), F.col("id") % 100 == 0).collect() == []


@pytest.mark.parametrize("scale", [1, 2**24, 2**25])
def test_topk_whatever_the_size_of_the_numbers(spark, scale):
    rows = [(k, [float((k * 37 + j * 11) % 101 - 50) * scale / 1024 for j in range(6)]) for k in range(120)]
    got = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 50 == 0, k=3).collect()
    ints = {i: [math.floor(1024 * x) for x in v] for i, v in rows}
    for q in (0, 50, 100):
        want = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)[:3]
        assert [(-r.score, r.vec_id) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == want


def test_url_cases(spark):
    urls = {
        1: "http://a.EXAMPLE.org/es/x?q#f", 2: "http://example.org/en/12", 3: "http://example.org/en/2", 4: "https://example.org", 5: None, 6: "no scheme",
        7: "http://notexample.org/es/", 8: "x://com/de/", 9: "x://shop.com/fr/a://b", 10: "http://shop.com/de/", 11: "", 12: "://", 13: "http://org?/", 14: "http://a\nb.org/é",
    }
    pages = spark.createDataFrame([*urls.items(), (1, urls[1]), (None, None)], "page_id long, url string").withColumn("rule", F.lit("z")).withColumn("row", F.lit("z"))
    rules = spark.createDataFrame(queries.URL_RULES, "action string, rule string")
    got = url_filters.judge(pages, rules).collect()
    by = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert len(got) == len(urls) + 2
    assert by[1] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert by[2] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert by[3] == ("example.org", "/en/2", "org/", "allow")
    assert by[4] == ("example.org", "", None, "allow") and by[13] == ("org", "", None, "allow")
    assert by[5] == by[6] == by[11] == by[12] == by[None] == ("", "", None, "allow")
    assert by[7][2:] == ("org/", "allow") and by[8] == ("com", "/de/", "com/de/", "block")
    assert by[9] == ("shop.com", "/fr/a://b", "com/fr/", "allow") and by[10][2:] == ("com/de/", "block")
    assert by[14] == ("a\nb.org", "/é", "org/", "allow")
    assert url_filters.judge(pages.limit(0), rules).collect() == []
    assert {r.verdict for r in url_filters.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_mixing_of_awkward_documents(awkward, empty):
    got = mixing.mix(awkward).collect()
    assert len(got) == awkward.count() and mixing.mix(empty).collect() == []
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r.doc_id, len(WORD.findall(r.text or ""))) for r in awkward.collect())
    assert all(r.taken in (0, r.size, 2 * r.size) for r in got)
    carried = mixing.mix(awkward, carry=("doc_id", "text", "carried")).collect()
    assert Counter((r.doc_id, r.carried["text"], r.copies, r.carried["carried"]) for r in carried).total() == awkward.count()


def test_mix_comes_near_its_targets(spark, sf):
    rows = mixing.mix(spark.read.parquet(f"{sf.replace('0.001', '0.1')}/documents.parquet")).collect()
    taken, target, size = defaultdict(int), {}, sum(r.size for r in rows)
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert abs(sum(target.values()) - 1.5 * size) < 1e-6 * size
    assert max(abs(taken[s] - target[s]) / target[s] for s in target) < 0.02


def test_sharding(awkward, empty, spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for df in (docs, awkward, empty):
        got = sharding.shard(df).collect()
        texts = df.select("doc_id", "text").collect()
        crc = lambda t: zlib.crc32((t or "").encode())
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((r.doc_id, len((r.text or "").encode()) + 1, crc(r.text)) for r in texts)
        slots = defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
        counts = [len(slots[s]) for s in range(8)]
        assert max(counts) - min(counts) <= 1


def walked(points: dict[int, int], n_shards: int) -> Counter:
    """Rows by (point, shard): each point's rows go clockwise to the next shard with room, all points a step at a time."""
    owners = {}
    for shard in range(n_shards):
        for v in range(sharding.VNODES):
            owners.setdefault(zlib.crc32(f"shard {shard} node {v}".encode()) % sharding.POINTS, shard)
    ring = sorted(owners)
    total = sum(points.values())
    room = {s: total // n_shards + (s < total % n_shards) for s in range(n_shards)}
    met = {}
    for p in points:
        ahead = [owners[o] for o in ring if o >= p] + [owners[o] for o in ring if o < p]
        met[p] = list(dict.fromkeys(ahead))
    out, left = Counter(), dict(points)
    for step in range(n_shards):
        for p in sorted(left):
            shard = met[p][step]
            take = min(left[p], room[shard])
            room[shard] -= take
            left[p] -= take
            out[p, shard] += take
    return +out


@pytest.mark.parametrize("n_shards", [1, 3, 8])
def test_sharding_equals_a_walk_round_the_ring(spark, sf, awkward, n_shards):
    for df in (spark.read.parquet(f"{sf}/documents.parquet"), awkward):
        rows = df.withColumn("point", sharding.point_of("doc_id")).select("doc_id", "point").collect()
        at = {r.doc_id: r.point for r in rows}
        got = Counter((at[r.doc_id], r.shard) for r in sharding.shard(df, n_shards).collect())
        assert got == walked(Counter(r.point for r in rows), n_shards)


def test_one_more_shard_moves_little_more_than_its_share(spark):
    ids = spark.range(100_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    before, after = ({r.doc_id: r.shard for r in sharding.shard(ids, n).collect()} for n in (8, 9))
    assert sum(before[k] != after[k] for k in before) / len(before) < 0.2  # a ninth must move


def metrics(text):
    text = text or ""
    w = WORD.findall(text)
    n = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    hit = {k + j for k in range(len(w) - 2) if n[tuple(w[k : k + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_quality_metrics_equal_brute_force(spark, sf, awkward, empty):
    for df in (spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet"), awkward):
        got = quality_rules.judge(df.withColumn("text_again", F.col("text"))).collect()
        assert len(got) == df.count()
        for r in got:
            m = metrics(r.text_again)
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m
            failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
            assert r.base_failed == failed and not (failed and r.kept)
            assert r.kept == (not failed and r.p_good >= 0.5)
    assert quality_rules.judge(empty).collect() == []


def fitted(patterns: dict[tuple[int, ...], int], n: int):
    """P(good) of each pattern: a class for good and one a fault, fitted in plain Python."""
    first = [0.8] + [0.2 / n] * n, [[0.9 if c == r + 1 else 0.1 for r in range(n)] for c in range(n + 1)]
    share, bad = first

    def likely(votes):
        return [share[c] * math.prod(bad[c][r] if v < 0 else 1 - bad[c][r] for r, v in enumerate(votes) if v) for c in range(n + 1)]

    for _ in range(300):
        weight = {v: [x * k / sum(p) for x in p] for v, k in patterns.items() for p in [likely(v)]}
        sums = [sum(w[c] for w in weight.values()) for c in range(n + 1)]
        seen = lambda c, r, signs: sum(w[c] for v, w in weight.items() if v[r] in signs)  # noqa: B023, E731
        share = [(x + 10 * f) / (sum(sums) + 10) for x, f in zip(sums, first[0], strict=True)]
        bad = [[(seen(c, r, (-1,)) + 8 * first[1][c][r]) / (seen(c, r, (-1, 1)) + 8) for r in range(n)] for c in range(n + 1)]
    return {v: p[0] / sum(p) for v in patterns for p in [likely(v)]}


def test_quality_verdicts_equal_a_plain_fit_and_beat_all_must_pass(spark, sf):
    d = sf.replace("0.001", "0.1")
    judged = quality_rules.judge(spark.read.parquet(f"{d}/documents.parquet"), carry=["doc_id"])
    names = list(quality_rules.rules())
    rows = judged.select("*", *(c.alias(k) for k, c in quality_rules.rules().items())).collect()
    votes = [tuple(r[k] for k in names) for r in rows]
    want = fitted(Counter(votes), len(names))
    assert all(abs(r.p_good - want[v]) < 1e-6 for r, v in zip(rows, votes, strict=True))
    assert all(r.kept == (not r.base_failed and want[v] >= 0.5) for r, v in zip(rows, votes, strict=True))
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    told = [(r, v.count(-1)) for r, v in zip(rows, votes, strict=True) if r.doc_id in quality and not r.base_failed]
    right = sum(r.kept == (quality[r.doc_id] == 1) for r, _ in told)
    must_pass = sum((n == 0) == (quality[r.doc_id] == 1) for r, n in told)
    assert right >= must_pass and right / len(told) > 0.99
    one = Counter(r.kept for r, v in zip(rows, votes, strict=True) if v.count(-1) == 1 and not r.base_failed)
    assert one[True] and one[False]  # a single bad vote can be outvoted, and need not be
    print("one bad vote", one, "right", right, "all must pass", must_pass, "of", len(told))


def test_a_fault_is_believed_where_other_rules_confirm_it():
    """Rules a and b find one fault together, c finds another alone and errs on good documents too."""
    counts = {(1, 1, 1): 800, (-1, -1, 1): 90, (-1, 1, 1): 5, (1, 1, -1): 40, (0, 0, 0): 10, (-1, 0, 1): 8}
    model = quality_rules.expectation_maximisation(list(counts.items()), ["a", "b", "c"])
    want = fitted(counts, 3)
    assert want[-1, -1, 1] < 0.01 and want[0, 0, 0] > 0.5 and want[1, 1, 1] > 0.99
    assert model.accuracy() > 0.5 and abs(sum(model.shares) - 1) < 1e-9
    assert quality_rules.expectation_maximisation([], ["a"]).shares == (0.8, pytest.approx(0.2))


GOOD_TEXT = """The old mill stands beside a narrow river, and its wheel still turns in spring.
Farmers used to bring their grain there every autumn, long before the railway came.
Today visitors walk along the bank, drink coffee under tall chestnut trees and read about the history of milling.
Children feed ducks from a wooden bridge which volunteers repaired last summer.
On warm evenings musicians play in the yard until darkness falls."""
JUNK = "### $$$ %%% &&& *** " * 40
SMALL = {
    "one null text": ([None], [False]),
    "three empty texts": (["", "", ""], [False] * 3),
    "two junk documents": ([JUNK, JUNK], [False, False]),
    "one good document": ([GOOD_TEXT], [True]),
    "one pattern": ([GOOD_TEXT] * 7, [True] * 7),
    "good among junk": ([GOOD_TEXT, JUNK, JUNK, JUNK], [True, False, False, False]),
}


@pytest.mark.parametrize("case", SMALL)
def test_quality_of_small_tables(spark, case):
    texts, kept = SMALL[case]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.kept for r in quality_rules.judge(df).orderBy("doc_id").collect()] == kept


def test_a_fit_without_a_good_class_keeps_the_start_model():
    start = quality_rules.start_model(["a", "b"])
    assert quality_rules.expectation_maximisation([((0, 0), 50)], ["a", "b"]).accuracy() == pytest.approx(start.accuracy())
    against_all = quality_rules.expectation_maximisation([((-1, -1), 10**6)], ["a", "b"])
    assert against_all.accuracy() > 0.5
    assert against_all == start or against_all.shares[0] < 0.5


def test_planted_faults_move_the_posterior():
    """Where two rules find a fault together, their votes together are believed, and one without the other far less."""
    counts = {(1, 1): 900, (-1, -1): 90, (-1, 1): 3}
    model = quality_rules.expectation_maximisation(list(counts.items()), ["a", "b"])

    def p_good(votes):
        likely = [s * math.prod(b[r] if v < 0 else 1 - b[r] for r, v in enumerate(votes) if v) for s, b in zip(model.shares, model.bad, strict=True)]
        return likely[0] / sum(likely)

    assert p_good((-1, -1)) < 0.1 and p_good((1, 1)) > 0.95
    assert p_good((-1, 1)) > 10 * p_good((-1, -1))


def test_windows_by_counted_tokens(spark):
    """Turns of 100 tokens and 6 for their marks: spans of (1024 - 128) / 2 tokens take four, and one turn fits the history. Uncounted: a piece."""
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"t{k}", 100) for k in range(12)] + [(2, 0, "user", "x", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tokens long")
    out = chat_format.windows(df, tokens_col="tokens").orderBy("conv_id", "window").collect()
    assert [(r.conv_id, r.n_tokens, r.n_repeated) for r in out] == [(1, 424, 0), (1, 530, 1), (1, 530, 1), (2, 7, 0)]
    assert all(r.n_tokens <= chat_format.BUDGET for r in out)


def test_chat_round_trip(spark):
    rows = [
        (1, 0, "system", "be <|kind|>"), (1, 1, "user", "a\\b <|im_end|>\n<|im_start|>assistant"), (1, 2, "assistant", "\\s <\\| ok"),
        (2, 0, "user", None), (2, 1, "assistant", ""), (3, 0, None, "x" * 9000), (3, 1, "assistant", "y" * 9000), (3, 2, "assistant", "z"),
        (None, 0, "assistant", "no id"), (4, None, "assistant", "n"), (4, 0, "odd\nrole", "t"), (4, 0, "odd\nrole", "t"), (5, 0, "system", "alone"),
    ] + [(6, t, ("user", "assistant")[t % 2], f"{t} " * 90) for t in range(40)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(9))
    import hashlib

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    turns = defaultdict(list)
    for c, t, role, text in rows:
        turns[c].append((t is not None, t or 0, role or "", text or ""))
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.windows(conv)).collect()}
    assert set(got) == set(turns)
    for c, ts in turns.items():
        ts.sort()
        said = "".join(f"{r}\n{x}\n" for *_, r, x in ts)
        target = "".join(x for *_, r, x in ts if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (len(ts), sha(said), len(target), sha(target))
    windows = chat_format.windows(conv).where("conv_id = 6").collect()
    assert len(windows) > 2 and all(w.n_tokens <= chat_format.BUDGET for w in windows)
    assert chat_format.read_back(chat_format.windows(conv.limit(0))).collect() == []
