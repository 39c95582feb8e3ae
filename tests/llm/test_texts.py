"""Exact copies, near copies, repeated passages: against brute force and on odd rows."""

from __future__ import annotations

import hashlib
import random
import time
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from postfeed.llm import common, graph, minhash, substring
from postfeed.llm.exact_dedup import exact_duplicates
from postfeed.llm.minhash import near_duplicates
from postfeed.llm.substring import without_repeats

from odd_rows import ODD


def words(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def roots(nodes, links):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        up[high] = low
    return {n: top(n) for n in nodes}


def expected_copies(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").encode().lower()].append(doc_id)
    return sorted(
        (str(d), str(max((i for i in ids if i is not None), default=None)), len(ids), hashlib.sha256(key).hexdigest())
        for key, ids in groups.items() for d in ids
    )


def test_exact_copies_are_all_found(documents):
    got = exact_duplicates(documents).collect()
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == expected_copies(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_exact_copies_of_odd_rows(odd, nothing):
    got = exact_duplicates(odd).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == expected_copies((d, t) for d, t, _ in ODD)
    kept = defaultdict(int)
    for r in got:
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1}
    assert exact_duplicates(nothing).count() == 0


def test_texts_that_part_late(spark):
    """Texts that agree in all but the last byte, and one that ends where others go on, take every radix level."""
    base = "a" * 70_000
    rows = [(1, base + "b"), (2, base + "c"), (3, base), (4, base + "B"), (5, "a" * 64), (6, "A" * 64), (7, "a" * 63)]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (4, 2), 2: (2, 1), 3: (3, 1), 4: (4, 2), 5: (6, 2), 6: (6, 2), 7: (7, 1)}


def brute_near(rows):
    sets = {d: shingles(t) for d, t in rows}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return sets, roots(ids, links)


@pytest.mark.parametrize("block", [1024, 16])
def test_near_copies_are_those_of_brute_force(spark, documents, block):
    random.seed(5)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    base = [f"v{random.randint(0, 400)}" for _ in range(150)]
    # One large family of all degrees of likeness.
    for i in range(90):
        w = list(base)
        for _ in range(random.randint(0, 14)):
            w[random.randrange(len(w))] = f"x{random.randint(0, 9999)}"
        rows.append((100_000 + i, " ".join(w)))
    sets, want = brute_near(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), block=block).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {d: len(s) for d, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_copies_of_odd_rows(odd, nothing):
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_duplicates(odd).collect())
    long = len(shingles([t for d, t, _ in ODD if d == 6][0]))
    assert got == sorted([
        ("1", 2, "1", True), ("2", 2, "1", False), ("2", 2, "1", False), ("None", 2, "None", True), ("None", 0, "None", True),
        ("3", 0, "3", True), ("4", 0, "4", True), ("5", 0, "5", True), ("6", long, "6", True), ("7", long, "6", False),
        ("7", 3, "7", True), ("8", 1, "8", True), ("9", 1, "8", False), ("-5", 2, "-5", True),
    ])
    assert near_duplicates(nothing).count() == 0


def test_signature_of_a_set_does_not_depend_on_the_order():
    offsets, values = common.shingle_sets(np.array([0, 7, 9]), np.arange(9, dtype=np.uint64))
    assert list(np.diff(offsets)) == [3, 1]
    again = minhash.signatures(np.array([0, 3]), values[:3][::-1].copy())
    assert (minhash.signatures(offsets, values)[0] == again[0]).all()


def test_components(spark):
    random.seed(2)
    links = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 700)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    assert got == roots({n for pair in links for n in pair}, links)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def passages(text, n=50):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_small_tables_are_written_in_few_files(spark, tmp_path, monkeypatch):
    """Whatever the number of partitions of a shuffle; components of 200 pairs went to 64 files a table."""
    spark.range(400).selectExpr("id AS a", "id - id % 2 AS b").write.parquet(f"{tmp_path}/links")
    files, write = [], graph.written

    def counted(df, name):
        out = write(df, name)
        files.append((name, len(out.inputFiles())))
        return out

    monkeypatch.setattr(graph, "written", counted)
    links, cores = spark.read.parquet(f"{tmp_path}/links"), spark.sparkContext.defaultParallelism
    given = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.node: r.root for r in graph.components(links).collect()}
    finally:
        for k, v in given.items():
            spark.conf.set(k, v)
    assert got == {n: n - n % 2 for n in range(400)}
    assert len(files) > 3 and all(n <= cores for _, n in files), files


def test_a_large_table_keeps_its_partitions(spark, tmp_path, monkeypatch):
    spark.range(4000).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    monkeypatch.setattr(common, "FILE_BYTES", 64)
    assert common.few(rows.repartition(32)).rdd.getNumPartitions() == 32
    # Rows that no table holds have no size.
    assert common.few(spark.createDataFrame([(1,)] * 64, "id long").repartition(32)).rdd.getNumPartitions() == 32


def test_no_passage_of_fifty_words_is_left_twice(spark, documents):
    got = without_repeats(documents).collect()
    before = {r.doc_id: r.text for r in documents.collect()}
    seen = defaultdict(set)
    for r in got:
        for p in passages(r.text):
            seen[p].add(r.doc_id)
    assert not [p for p, ids in seen.items() if len(ids) > 1]
    # Every passage that there was is still somewhere, and untouched texts are as they were.
    assert all(r.text == before[r.doc_id] for r in got if not r.n_removed)
    assert all(len(words(r.text)) == r.n_words - r.n_removed for r in got)


def test_planted_passages(spark):
    random.seed(3)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = " ".join(random.choice(vocabulary) for _ in range(51))
    line = [random.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(12):
        w = [random.choice(vocabulary) for _ in range(150)]
        k = random.randint(0, 150)
        rows.append((i, " ".join([*w[:k], passage, *w[k:]])))
    near = list(line)
    near[30] = "changed"
    rows += [(50, "head of it\n" + " ".join(line)), (51, " ".join(near) + "\nand a tail"), (52, " ".join(random.choice(vocabulary) for _ in range(300)))]
    got = {r.doc_id: r for r in without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert passage in got[0].text and not [i for i in range(1, 12) if passage in got[i].text]
    assert all(51 <= got[i].n_removed <= 53 for i in range(1, 12))
    assert (got[50].n_removed, got[51].n_removed, got[51].text) == (0, 60, "and a tail")
    assert got[52].n_removed == 0 and got[0].n_removed == 0


def planted(changes, n=30):
    """Pairs of documents that share 60 words within one line, some of them changed in the second; then a short line in many."""
    rng = random.Random(5 + changes)
    fresh = lambda k: [f"w{rng.randrange(6000)}" for _ in range(k)]
    rows = []
    for i in range(n):
        shared = fresh(60)
        for copy in range(2):
            inner = list(shared)
            for k in rng.sample(range(5, 55), changes * copy):
                inner[k] = "changed"
            rows.append((i + 1000 * copy, " ".join(fresh(rng.randrange(20, 150)) + inner + fresh(rng.randrange(20, 150)))))
    line = " ".join(fresh(12))
    return rows + [(5000 + i, " ".join(fresh(40)) + f"\n{line}\n" + " ".join(fresh(40))) for i in range(n)], line


@pytest.mark.parametrize("changes", [0, 1])
def test_whole_passages_and_short_lines_go(spark, changes):
    rows, line = planted(changes)
    got = {r.doc_id: r for r in without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert sum(60 <= got[1000 + i].n_removed <= 62 for i in range(30)) >= (30 if not changes else 28)
    assert not any(got[i].n_removed for i in range(30))
    assert [line in got[5000 + i].text for i in range(30)] == [True] + [False] * 29


def test_every_cut_is_a_repeat(spark, documents):
    """Against brute force: words that go are a repeated line, or repeat an earlier place but for single words."""
    given = {r.doc_id: words(r.text) for r in documents.collect()}
    places = defaultdict(list)
    for d in sorted(given):
        for i in range(len(given[d]) - substring.PASSAGE + 1):
            places[tuple(given[d][i : i + substring.PASSAGE])].append((d, i))
    for r in without_repeats(documents).collect():
        for start, n in r.spans or ():
            run = given[r.doc_id][start : start + n]
            seen = [False] * n
            for i in range(n - substring.PASSAGE + 1):
                if any(p < (r.doc_id, start + i) for p in places[tuple(run[i : i + substring.PASSAGE])]):
                    seen[i : i + substring.PASSAGE] = [True] * substring.PASSAGE
            # Five words between changed ones repeat too, but are no passage of their own; alike lines differ in a quarter.
            assert sum(seen) >= 0.5 * n, (r.doc_id, start, n)


@pytest.mark.parametrize(
    "own, other, want",
    [("", "abc", 0), ("abc", "abc", 3), ("abcx", "abcy", 3), ("abxdefgh", "abydefgh", 8), ("abxdefg", "abydefg", 2), ("xabcde", "yabcde", 6), ("axbcdefy", "azbcdefg", 7)],
)
def test_growing_over_single_words(own, other, want):
    assert substring.grown(np.frombuffer(own.encode(), np.uint8), np.frombuffer(other.encode(), np.uint8)) == want


def test_repeats_of_odd_rows(odd, nothing):
    got = without_repeats(odd, keep=("source", "digest")).collect()
    assert len(got) == len(ODD)
    # The long text repeats itself and has a copy: about one round of its 977 words stays, in the first row.
    left = {(str(r["doc_id"]), r["n_words"]): r["n_words"] - r["n_removed"] for r in got}
    assert 977 <= left.pop(("6", 60_000)) < 1300 and left.pop(("7", 60_000)) < 50
    assert all(n == kept for (_, n), kept in left.items())
    assert sorted(str(r["__keep_0"]) for r in got) == sorted(str(s) for _, _, s in ODD) and {r["__keep_1"] for r in got} == {"clash"}
    assert without_repeats(nothing).count() == 0


@pytest.mark.parametrize(
    "text, spans, want",
    [
        ("a b c d", [(1, 2)], "a d"), ("a b\nc d\ne", [(2, 2)], "a b\ne"), ("a b c\nd", [(1, 2)], "a \nd"), ("a b", [(0, 2)], ""),
        ("é b\n\nc", [(0, 1), (0, 2)], "c"), ("a", [], "a"), ("a b c", [(0, 2), (1, 2)], ""),
    ],
)
def test_cutting_words(text, spans, want):
    assert substring.without_words(text, spans)[0] == want


def test_bands_reach_the_recall():
    assert 1 - (1 - 0.75**substring.BAND_ROWS) ** substring.BANDS >= substring.RECALL


def plain_runs(spans):
    """The runs of a text's repeats, one span after the other."""
    runs = []
    for span in sorted(spans, key=lambda s: (s["start"], -s["words"], s["first_doc"], s["first_print"], s["first_start"])):
        end = span["start"] + span["words"]
        if runs and span["start"] <= runs[-1][1]:
            runs[-1][2] |= span["line"]
            if end > runs[-1][1]:
                runs[-1][1], runs[-1][4] = end, span
        else:
            runs.append([span["start"], end, span["line"], span, span])
    return [(a, b - a, line, *(x[k] for k in substring._SPAN[5:8]), y["first_doc"], y["first_print"], y["first_start"] + y["first_words"]) for a, b, line, x, y in runs]


def test_runs_of_many_repeats_are_found_together():
    rng = np.random.default_rng(8)
    span = lambda: dict(zip(substring._SPAN[2:], (*map(int, rng.integers(0, [90, 30])), bool(rng.random() < 0.3), *map(int, rng.integers(0, [3, 2, 4, 20])))))
    texts = [[span() for _ in range(int(rng.integers(0, 9)))] for _ in range(2_000)]
    kinds = [pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    spans = pa.array(texts, pa.list_(pa.struct(list(zip(substring._SPAN[2:], kinds)))))
    batch = pa.record_batch([pa.array(range(2_000), pa.int64()), pa.array(range(5, 2_005), pa.int64()), spans], names=["doc", "print", "spans"])
    got = [tuple(r.values()) for part in substring._edges(iter([batch])) for r in part.to_pylist()]
    assert got == [(i, i + 5, *run) for i, own in enumerate(texts) for run in plain_runs(own)]
    # A part of a batch, and one without texts.
    assert [tuple(r.values()) for part in substring._edges(iter([batch.slice(40, 9), batch.slice(0, 0)])) for r in part.to_pylist()] == [r for r in got if 40 <= r[0] < 49]
    many = pa.Table.from_batches([batch] * 40).combine_chunks().to_batches()
    started = time.process_time()
    list(substring._edges(iter(many)))
    # A loop over all spans takes ten times as long.
    assert time.process_time() - started < 1.5


def test_words_are_cut_at_the_blanks_of_a_word_only():
    text = "a\x0bbb\x1cc \x85d\ne f  g"
    assert substring.without_words(text, [(1, 1)]) == ("a\x0b\x85d\ne f  g", 5, 1)
    assert substring.without_words(text, [(0, 1), (4, 1)]) == ("bb\x1cc \x85d\ne f  ", 5, 2)
