"""The classifier, class n-grams, vectors and URL templates."""

from __future__ import annotations

import math
import random
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from odd_rows import ODD, SF_DIR, extra
from postfeed.llm import brown, common, quality, urls, vectors
from postfeed.llm.common import min_labels
from postfeed.llm.graph import components
from postfeed.llm.queries import op1_url_filter
from postfeed.session import scratch_root


def words(text):
    return (text or "").encode().lower().split()


@pytest.fixture(scope="module")
def bigger(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def test_quality_on_held_out_rows(bigger, odd, nothing):
    documents, labels = bigger
    model = quality.train(documents, labels)
    rows = quality.score(documents, model).join(labels, "doc_id").where("held_out AND quality IS NOT NULL").collect()
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    assert len(rows) > 50 and right >= 0.97
    # Clean texts stay clean when they are made very long, all their chunks being looked at.
    clean = [r.text for r in documents.join(labels, "doc_id").where("quality = 1 AND crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0").orderBy("doc_id").collect()]
    assert (model.score(["\n".join(clean[k::3]).encode() for k in range(3)] + ["\n".join(clean * 4).encode()]) >= 0.9).all()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    # Equal texts get equal scores whatever their ids; odd rows are scored like others.
    got = quality.score(odd, model, keep=("source", "row")).collect()
    assert len(got) == len(ODD)
    by_text = {t: s for (_, t, _), s in zip(ODD, model.score([(t or "").encode() for _, t, _ in ODD]))}
    assert np.isfinite(list(by_text.values())).all()
    assert sum(r["doc_id"] is None and not r["held_out"] for r in got) == 2
    assert quality.score(nothing, model).count() == 0


def test_quality_without_labels(spark, documents, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(documents, quality.train(documents, none)).collect()} == {0.5}
    good = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int")
    assert {r.score for r in quality.score(documents, quality.train(documents, good)).collect()} == {1.0}
    assert quality.train(nothing, good).prior == 0.5


def test_a_sampled_text_is_taken_whole_or_not_at_all(bigger):
    documents, labels = bigger
    texts = {r.doc_id: (r.text or "").encode() for r in documents.collect()}
    for most in (quality.TRAIN_BYTES, 60_000):
        samples, said = quality.training_sample(documents, labels, rows=40, most_bytes=most)
        whole = {quality.chunk_matrix([t])[0].tobytes() for t in texts.values()}
        assert len(samples) == len(said) and said.count(0) and said.count(1) and max(said.count(0), said.count(1)) <= 40
        assert all(s.tobytes() in whole for s in samples)
        assert all(sum(int((s != 0).sum()) for s, v in zip(samples, said) if v == label) <= 1.3 * most for label in (0, 1))


def test_a_planted_sign_is_learnt(monkeypatch):
    """Marks that only bad texts have, in texts of one chunk and of several."""
    monkeypatch.setattr(quality, "STEPS", 200)
    good, bad = [b"abc def ghi " * k for k in (60, 200)], [b"abc### def%%% " * k for k in (60, 200)]
    model = quality.fit([quality.chunk_matrix([t])[0] for t in good + bad], [1, 1, 0, 0])
    assert (model.score(good) > 0.9).all() and (model.score(bad) < 0.1).all()


def test_held_out_labels_are_never_learnt_from(bigger):
    documents, labels = bigger
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.training_sample(documents, x) for x in (labels, flipped))
    assert a[1] == b[1] and all((x == y).all() for x, y in zip(a[0], b[0]))


def test_chunks_cover_the_whole_text():
    text = bytes(range(1, 256)) * 9
    rows, owner = quality.chunk_matrix([text, b"", b"ab"])
    step = quality.CHUNK - quality.OVERLAP
    seen = b"".join(bytes(r[:step]) for r in rows[owner == 0])
    assert text in seen + bytes(rows[owner == 0][-1][step:]) and list(np.bincount(owner)) == [int((owner == 0).sum()), 1, 1]


def test_scores_against_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    counts = Counter()
    for doc_id, text in rows:
        if zlib.crc32(str(doc_id).encode()) % 5 != 1:
            counts.update([*words(text), None])
    tokens, types = sum(counts.values()), len(counts)
    # A short list sends most words through the join, with the same result.
    for listed in (brown.FREQUENT, 3000):
        got = {r.doc_id: r for r in brown.scores(documents.repartition(3), frequent_words=listed).collect()}
        for doc_id, text in rows:
            said, r = [*words(text), None], got[doc_id]
            base = sum(math.log10((counts[w] + 0.5) / (tokens + 0.5 * (types + 1))) for w in said)
            assert math.isclose(r.base_score, base, rel_tol=1e-9)
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(said), sum(counts[w] > 0 for w in said), tokens)
            assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 1)
        if listed == brown.FREQUENT:
            full = got
        assert all(math.isclose(full[d].score, got[d].score, rel_tol=1e-9) for d in got)


def test_classes_beat_single_words_on_held_out_texts(bigger):
    rows = [r for r in brown.scores(bigger[0]).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_units_keep_to_the_classes_given():
    pairs = np.random.default_rng(1).poisson(0.4, (brown.UNITS, brown.UNITS))
    of = brown.exchange(pairs, sweeps=2)
    assert of[brown.END] == brown.CLASSES and (of[: brown.END] < brown.CLASSES).all()


@pytest.fixture
def fitted(spark, monkeypatch):
    """Scores of a small corpus with the class that the exchange gave each training word, from the operator itself."""
    rng, known = random.Random(3), {}
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in ("ing", "ed", "s", "x", "yz")]
    rows = [(i, " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(40)], k=rng.randrange(0, 60)))) for i in range(120)] + [(500 + i, "never Seen " + w) for i, w in enumerate(vocabulary)] + [(700, None)]
    real = brown.exchange_words
    real_exchange = brown.exchange

    def exchange_words(pairs, classed, k, **more):
        best = real(pairs, classed, k, **more)
        known["classes"], known["k"] = {r[0]: r[1] for r in best[0].collect()}, k
        return best

    def exchange(*args, **more):
        known["units"] = real_exchange(*args, **more)
        return known["units"]

    monkeypatch.setattr(brown, "exchange_words", exchange_words)
    monkeypatch.setattr(brown, "exchange", exchange)
    # Some words are in the list that travels, the others are joined.
    got = {r.doc_id: r for r in brown.scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), frequent_words=15).collect()}
    return rows, got, known


def brute_model(rows, known):
    """Class of a word, transitions and emissions, counted one by one."""
    texts = [(t or "").lower().split() for d, t in rows if brown.learns(d)]
    counts = Counter(w for t in texts for w in t)
    least = min(n for n in counts.values() if sum(m >= n for m in counts.values()) <= 15)
    listed = sorted((w for w, n in counts.items() if n >= least), key=lambda w: (-counts[w], w))
    assert 0 < len(listed) < len(counts)
    number = {w: i for i, w in enumerate(listed)} | {w: brown.TAIL | xxhash.xxh64_intdigest(w.encode()) >> 3 for w in counts if w not in listed}
    k = known["k"]
    of = lambda w: k - 1 if w is None else known["classes"][number[w]] if w in counts else int(known["units"][brown.ending(w.encode())])
    steps, size, types = Counter(), Counter({k - 1: len(texts)}), Counter({k - 1: 1})
    for w, n in counts.items():
        size[of(w)] += n
        types[of(w)] += 1
    # Training texts follow each other: the end of one is what the next begins after.
    for t in texts:
        for a, b in zip([None, *t], [*t, None]):
            steps[of(a), of(b)] += 1
    after = Counter()
    for (a, _), n in steps.items():
        after[a] += n
    move = lambda a, b: (steps[a, b] + brown.ADD_TRANSITION) / (after[a] + brown.ADD_TRANSITION * k)
    say = lambda c, n: (n + brown.ADD_WORD) / (size[c] + brown.ADD_WORD + brown.ADD_WORD * (types[c] - (c == k - 1)))
    return of, counts, move, say, k


def test_scores_are_those_of_a_plain_count(fitted):
    rows, got, known = fitted
    of, counts, move, say, k = brute_model(rows, known)
    for doc_id, text in rows:
        words, total, before = (text or "").lower().split(), 0.0, None
        for w in [*words, None]:
            total += math.log10(move(of(before), of(w)))
            if w is not None:
                total += math.log10(say(of(w), counts.get(w, 0)))
            before = w
        assert got[doc_id].score == pytest.approx(total, abs=1e-9), doc_id


def test_the_model_is_a_distribution(fitted):
    """After any class the classes, and within a class its words and one unknown word, have probability 1."""
    rows, _, known = fitted
    of, counts, move, say, k = brute_model(rows, known)
    for a in range(k):
        assert sum(move(a, b) for b in range(k)) == pytest.approx(1)
    for c in {of(w) for w in counts}:
        assert sum(say(c, n) for w, n in counts.items() if of(w) == c) + say(c, 0) == pytest.approx(1)


def test_exchange_finds_planted_classes():
    pairs = np.zeros((brown.UNITS, brown.UNITS))
    for u in range(60):
        for v in range(60):
            pairs[u, v] = 9 if (u % 2) != (v % 2) else 0
    of = brown.exchange(pairs, classes=2)
    assert len({int(of[u]) for u in range(0, 60, 2)}) == 1 and of[0] != of[1]


def test_rare_words_get_classes_of_their_own(spark):
    """Words of one ending that stand in turn in two kinds of place: the kind is told for each, however many there are."""
    rng = np.random.default_rng(5)
    sides = [[f"{side}{i}ing" for i in range(700)] for side in "ab"]
    rows = [(i, " ".join(rng.choice(sides[k % 2]) for k in range(200))) for i in range(300)]
    got = brown.scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), frequent_words=500).collect()
    mean = -sum(r.score for r in got) / sum(r.n_tokens for r in got)
    # 700 words are possible at a place; 1,400 for who does not know its kind.
    assert mean < math.log10(700) + 0.1


def test_classes_grow_with_the_vocabulary():
    assert [brown.classes_for(n) for n in (0, 64_000, 1_000_000, 8_000_000)] == [brown.CLASSES, brown.CLASSES, 100, 200]


def test_scores_of_odd_rows(odd, nothing):
    got = brown.scores(odd).collect()
    assert len(got) == len(ODD) and all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert sorted(r.n_tokens for r in got) == sorted(len(words(t)) + 1 for _, t, _ in ODD)
    assert brown.scores(nothing).count() == 0


def brute_vectors(rows):
    units = vectors.unit(np.array([v for _, v in rows], dtype=np.float64))
    linked = (units @ units.T >= vectors.COSINE) & ~np.eye(len(rows), dtype=bool)
    order = np.argsort([i for i, _ in rows], kind="stable")
    rank = np.empty(len(rows), int)
    rank[order] = np.arange(len(rows))
    a, b = np.nonzero(linked)
    labels = min_labels(len(rows), rank[a], rank[b])
    return {rows[k][0]: (int(linked[k].sum()), rows[order[labels[rank[k]]]][0]) for k in range(len(rows))}


@pytest.mark.parametrize("block", [2048, 40])
def test_vectors_against_brute_force(spark, block):
    embeddings = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in embeddings.collect()]
    rng = np.random.default_rng(3)
    centre = rng.normal(size=64)
    rows += [(10_000 + i, (centre * (1 + i) + rng.normal(0, 0.02 * (1 + i), 64)).tolist()) for i in range(150)]
    rows += [(20_000 + i, rows[0][1]) for i in range(30)]
    want = brute_vectors(rows)
    got = {r.vec_id: r for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5), block=block).collect()}
    links = sum(n for n, _ in want.values())
    assert sum(r.n_links for r in got.values()) / links >= 0.99
    assert all(r.n_links <= want[i][0] for i, r in got.items())
    assert sum(r.component_id == want[i][1] for i, r in got.items()) / len(want) >= 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


@pytest.mark.parametrize("kind", ["rank 3", "rank 6", "shared direction"])
def test_no_link_is_missed_in_spaces_with_a_main_direction(spark, monkeypatch, kind):
    """Against brute force with 30 cells or more; links point where the vectors spread, across borders too."""
    monkeypatch.setattr(vectors, "CELL", 100)
    rng = np.random.default_rng(8)
    if kind == "shared direction":
        near = rng.normal(size=(1500, 64))
        near = np.concatenate([near, near + 0.3 * np.linalg.norm(near, axis=1, keepdims=True) * vectors.unit(rng.normal(size=(1, 64)))])
    else:
        rank = int(kind[-1])
        near = rng.normal(size=(3000, rank)) @ rng.normal(size=(rank, 64))
    rows = [(i, v) for i, v in enumerate(near.tolist())]
    want = brute_vectors(rows)
    assert len(rows) // vectors.CELL >= 30 and sum(n for n, _ in want.values()) >= 1500
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want


def test_vectors_are_not_dealt_to_every_cell_they_visit(spark, monkeypatch):
    """Without a main direction a vector visits most cells, but it is shuffled and stored a few times only; then all goes."""
    monkeypatch.setattr(vectors, "CELL", 50)
    rng = np.random.default_rng(5)
    near = rng.normal(size=(2000, 64))
    rows = [(i, v) for i, v in enumerate(np.concatenate([near, near[:500] + rng.normal(0, 0.02, (500, 64))]).tolist())]
    embeddings = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    taken, held = [], []

    def path_taken(*args):
        taken.append(common_path(*args))
        return taken[-1]

    def files(folders):
        return {f: f.stat().st_size for top in folders for f in Path(top.removeprefix("file://")).rglob("*") if f.is_file()}

    def measured(links):
        held.append(sum(n for f, n in files([*taken, *local]).items() if f not in before))
        return components(links)

    common_path = common.scratch_path
    monkeypatch.setattr(common, "scratch_path", path_taken)
    local = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    before = set(files(local))
    monkeypatch.setattr(vectors, "components", measured)
    got = vectors.near_vectors(embeddings, block=100)
    want = brute_vectors(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got.collect()} == want
    assert sum(n > 0 for n, _ in want.values()) == 1000
    assert held[0] <= 4 * 8 * 64 * len(rows)
    assert [t.rsplit("/", 1)[1].rsplit("-", 1)[0] for t in taken if files([t])] == ["near-vectors"]


@pytest.mark.parametrize("block", [2048, 30])
def test_vectors_of_all_kinds_against_brute_force(spark, block):
    """Single and double precision, lengths beside one another, one dense group, ids that repeat."""
    rng = np.random.default_rng(6)
    dense = rng.normal(size=40) + rng.normal(0, 0.03, (150, 40))
    wide = np.concatenate([dense, rng.normal(size=(100, 40)), np.float32(rng.normal(size=(100, 40))), np.float32(dense[:50])])
    short = np.concatenate([rng.normal(size=(60, 3)), np.float32(rng.normal(size=(60, 3)))])
    rows = [(7 * i % 1009, v) for i, v in enumerate(wide.tolist())]
    other = [(2000 + i, v) for i, v in enumerate(short.tolist())]
    want = brute_vectors(rows) | brute_vectors(other)
    rows += other
    got = vectors.near_vectors(spark.createDataFrame(rows + rows[:10], "vec_id long, embedding array<double>").repartition(3), block=block).collect()
    assert len(got) == len(rows) + 10
    more = {i: n for i, (n, _) in want.items()}
    for i, v in rows[:10]:
        for k, u in rows:
            if len(u) == len(v) and (k == i or vectors.unit(np.array([u])) @ vectors.unit(np.array([v])).T >= vectors.COSINE):
                more[k] += 1
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (more[i], c) for i, (_, c) in want.items()}


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [3.0, 0.0]), (2, [3.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]),
            (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [1e300, 1e290]), (11, [-1.0, 0.0]), (12, [1e-300, 0.0])]
    df = extra(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in vectors.near_vectors(df).collect())
    group = [("1", 4, "1", True), ("2", 4, "1", False), ("2", 4, "1", False), ("10", 4, "1", False), ("12", 4, "1", False)]
    alone = [(str(i), 0, str(i), True) for i in (3, 4, 5, 6, 7, 8, 9, 11)] + [("None", 0, "None", True)]
    assert got == sorted(group + alone)
    assert vectors.near_vectors(df.limit(0)).count() == 0


URLS = [
    (1, "https://A.Org/x/1?q=/fr/"), (2, "http://www.example.org/es/9"), (3, "http://example.org/en/1"), (4, "http://example.org/en/2#/es/"), (5, "ftp://b.com/fr/"),
    (6, "x://b.COM/de/7"), (7, "http://notexample.org"), (8, None), (9, "no scheme"), (10, ""), (None, "http://x.net?://y/z"), (10, "http://org/"), (11, "http://h.net/a\nb"), (12, "a://b://c/d"),
]


def test_rules_and_parts(spark):
    df = extra(spark.createDataFrame(URLS, "page_id long, url string"))
    none = spark.createDataFrame([], "url string, label int")
    got = {(r.page_id, r.host): (r.path, r.rule, r.verdict) for r in urls.filter_urls(df, none).collect()}
    assert got == {
        (1, "a.org"): ("/x/1", "org/", "allow"), (2, "www.example.org"): ("/es/9", "example.org/es/", "block"), (3, "example.org"): ("/en/1", "example.org/en/1", "block"),
        (4, "example.org"): ("/en/2", "org/", "allow"), (5, "b.com"): ("/fr/", "com/fr/", "allow"), (6, "b.com"): ("/de/7", "com/de/", "block"),
        (7, "notexample.org"): ("", None, "allow"), (8, ""): ("", None, "allow"), (9, ""): ("", None, "allow"), (10, ""): ("", None, "allow"),
        (None, "x.net"): ("", None, "allow"), (10, "org"): ("/", "org/", "allow"), (11, "h.net"): ("/a\nb", None, "allow"), (12, "b:"): ("//c/d", None, "allow"),
    }
    assert urls.filter_urls(df.limit(0), none).count() == 0


def tree_by_hand(paths):
    """Templates of (host, form): [n, labels, good], node by node."""
    out = {}

    def divide(node, items, depth):
        # items: (key, segments, n, labels, good) with a segment at this depth
        labels, good = sum(i[3] for i in items), sum(i[4] for i in items)
        if labels < 2 * urls.MIN_LABELS or good in (0, labels):
            out.update({key: node + "/**" for key, *_ in items})
            return
        branches = {}
        for item in items:
            branches.setdefault(item[1][depth], []).append(item)
        steps = {}
        for segment, members in branches.items():
            n, told, right = (sum(m[k] for m in members) for k in (2, 3, 4))
            step = urls.STEPS * right // told if n >= urls.MIN_PAGES and told >= urls.MIN_LABELS else -1
            steps.setdefault(step, []).append((segment, told, right))
        groups, names = [], {}
        entries = [(sum(b[2] for b in of), sum(b[1] for b in of), step, of) for step, of in steps.items()]
        for right, told, step, of in sorted((e for e in entries if e[1] >= urls.MIN_LABELS), key=lambda e: (e[0] / e[1], e[2])):
            last = groups[-1] if groups else None
            if last:
                share = (last[0] + right) / (last[1] + told)
                error = (max(share * (1 - share), 1e-6) * (1 / last[1] + 1 / told)) ** 0.5
            if last and abs(last[0] / last[1] - right / told) <= urls.DIFFERENT * error:
                groups[-1] = (last[0] + right, last[1] + told, last[2] + of, last[3] | {step})
            else:
                groups.append((right, told, of, {step}))
        for k, (_, _, of, group) in enumerate(groups, 1):
            for segment, *_ in of:
                names[segment] = segment if len(of) == 1 and group != {-1} else "*" if len(groups) == 1 else f"({k})"
        below = {}
        for segment, members in branches.items():
            for m in members:
                name = f"{node}/{names.get(segment, '(other)')}"
                if len(m[1]) == depth + 1:
                    out[m[0]] = name
                else:
                    below.setdefault(name, []).append(m)
        for name, members in below.items():
            divide(name, members, depth + 1)

    hosts = {}
    for (host, form), sums in paths.items():
        if form:
            hosts.setdefault(host, []).append(((host, form), form[1:].split("/"), *sums))
        else:
            out[host, form] = ""
    for items in hosts.values():
        divide("", items, 0)
    return out


def sums_by_path(spark, pages, labels):
    """(host, form): [n, labels, good] of rows (id, url) and a label by url."""
    df = spark.createDataFrame([(url,) for _, url in pages], "url string")
    parts = df.select("url", urls.host_of(F.col("url")).alias("host"), urls.generalised(urls.path_of(F.col("url"))).alias("form")).collect()
    sums = {}
    for r in parts:
        label, entry = labels.get(r.url), sums.setdefault((r.host, r.form), [0, 0, 0])
        entry[0] += 1
        entry[1] += label is not None
        entry[2] += label or 0
    return sums


def random_urls(rng, n, deep=3):
    """Urls of a few hosts, some of whose branches are worse than others, one of them ``deep`` levels down."""
    pages, labels = [], {}
    for i in range(n):
        host = rng.choice(["a.net", "b.net", "c.net"], p=[0.6, 0.3, 0.1])
        kind = rng.choice(["news", "blog", "spam", "junk", "x(y", f"rare{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}"], p=[0.3, 0.2, 0.15, 0.15, 0.1, 0.1])
        rest = rng.choice(["", "/", f"/{i}", f"/{i}.html", f"/id-{i}-x-{i}/", "/deep" * deep + "/" + rng.choice(["good", "bad"])])
        url = f"http://{host}/{kind}{rest}"
        pages.append((i, url))
        bad = kind in ("spam", "junk") or rest.endswith("bad")
        if rng.random() < 0.6 and url not in labels:
            labels[url] = int(rng.random() < (0.15 if bad else 0.9))
    return pages, labels


def test_templates_are_those_of_a_tree_by_hand(spark):
    pages, labels = random_urls(np.random.default_rng(5), 1500, deep=33)
    sums = sums_by_path(spark, pages, labels)
    want = tree_by_hand(sums)
    df = spark.createDataFrame([(*key, *value) for key, value in sums.items()], "host string, form string, n long, labels long, good long")
    assert {(r.host, r.form): r.template for r in urls.templates(df).collect()} == want
    assert max(len(t.split("/")) for t in want.values()) > 33 and {"**", "(other)"} & {part for t in want.values() for part in t.split("/")}


def test_rejected_templates_are_worse_in_labels_kept_back(spark):
    pages, labels = random_urls(np.random.default_rng(6), 3000)
    learnt = {u: v for k, (u, v) in enumerate(labels.items()) if k % 3}
    kept_back = {u: v for u, v in labels.items() if u not in learnt}
    got = urls.filter_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(list(learnt.items()), "url string, label int")).collect()
    url_of, bad = dict(pages), [r for r in got if r.verdict == "block"]
    shares = [kept_back[url_of[r.page_id]] for r in bad if url_of[r.page_id] in kept_back]
    overall = sum(kept_back.values()) / len(kept_back)
    assert len(shares) > 50 and sum(shares) / len(shares) < overall / 2
    assert {r.path.split("/")[1] for r in bad} >= {"spam", "junk"}


def test_alike_branches_merge_while_a_third_stays(spark):
    sums = {("h.net", f"/{kind}/*"): (100, 50, good) for kind, good in (("a", 45), ("b", 46), ("c", 20), ("d", 21), ("e", 2))}
    df = spark.createDataFrame([(*key, *value) for key, value in sums.items()], "host string, form string, n long, labels long, good long")
    got = {r.form[1]: r.template for r in urls.templates(df).collect()}
    assert got == {"a": "/(3)/*", "b": "/(3)/*", "c": "/(2)/*", "d": "/(2)/*", "e": "/e/*"}


def test_impure_templates_go(spark):
    """Below one host a branch of bad pages stands apart, and two alike branches are one wildcard."""
    pages, labels = [], []
    for i in range(300):
        for kind, good in (("news", 1), ("blog", 1), ("spam", 0)):
            pages.append((len(pages), f"http://h.net/{kind}/{i}.html"))
            labels.append((pages[-1][1], good if i % 10 else 1 - good))
    got = urls.filter_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "url string, label int")).collect()
    seen = {(r.path.split("/")[1], r.template, r.verdict) for r in got}
    assert {v for k, _, v in seen if k == "spam"} == {"block"} and {v for k, _, v in seen if k != "spam"} == {"allow"}
    assert {t for k, t, _ in seen if k == "spam"} == {"/spam/*.html"}


def test_query_keeps_every_page(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    got = op1_url_filter(spark, SF_DIR).collect()
    assert sorted(r.page_id for r in got) == sorted(r.page_id for r in pages.collect())
    assert {r.verdict for r in got} <= {"allow", "block"}


def test_the_last_pass_of_the_exchange_counts_followers_only(spark, monkeypatch):
    k, seen, write = 5, [], brown.written_at

    def spied(df, name):
        made, path = write(df, name)
        if name == "profiles":
            rows = [np.frombuffer(r.seen, np.int64) for r in made.select("seen").collect()]
            seen.append(np.concatenate(rows))
        return made, path

    monkeypatch.setattr(brown, "written_at", spied)
    rng = np.random.default_rng(4)
    pairs = Counter((int(a), int(b)) for a, b in rng.integers(0, 40, (4_000, 2)))
    rows = spark.createDataFrame([(a, b, n) for (a, b), n in pairs.items()], "a long, b long, n long")
    classed = spark.createDataFrame([(i, i % (k - 1)) for i in range(40)] + [(brown.END_ID, k - 1)], "id long, class long")
    found, table = brown.exchange_words(rows, classed, k, sweeps=1)
    assert len(seen) == 2 and (seen[0] >= k).any() and not (seen[1] >= k).any()
    of = dict(found.collect())
    want = np.zeros((k, k), np.int64)
    for (a, b), n in pairs.items():
        want[of[a], of[b]] += n
    assert (table == want).all()


def test_classes_do_not_depend_on_the_buckets(spark):
    """Wide, listed and other words; pairs of every kind, counts beyond 16 bits and a word beside itself."""
    rng = np.random.default_rng(6)
    ids = [brown.END_ID, *range(60), *(brown.TAIL | int(x) for x in rng.integers(0, brown.TAIL, 60))]
    pairs = Counter((ids[a], ids[b]) for a, b in rng.integers(0, len(ids), (3_000, 2)))
    pairs[ids[40], ids[100]] += 70_000
    rows = spark.createDataFrame([(a, b, n) for (a, b), n in pairs.items()], "a long, b long, n long")
    k = 6
    first = {i: j % (k - 1) for j, i in enumerate(ids[1:])} | {brown.END_ID: k - 1}
    classed = spark.createDataFrame([*first.items()], "id long, class long")
    found = []
    for buckets in (1, 7):
        classes, table = brown.exchange_words(rows, classed, k, sweeps=2, buckets=buckets)
        found.append(dict(classes.collect()))
        assert set(found[-1]) == set(ids)
        want = np.zeros((k, k), np.int64)
        for (a, b), n in pairs.items():
            want[found[-1][a], found[-1][b]] += n
        assert (table == want).all()
    assert found[0] == found[1] != first


def test_pairs_travel_as_arrays(spark, monkeypatch):
    """No scratch table of the exchange has a row per pair of words, however many shuffle partitions there are."""
    sizes, write = {}, brown.written_at

    def spied(df, name):
        made, path = write(df, name)
        sizes[name] = max(sizes.get(name, 0), made.count())
        return made, path

    monkeypatch.setattr(brown, "written_at", spied)
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(80)) for _ in range(200)]
    pairs = {p for i, t in enumerate(texts) if brown.learns(i) for p in zip([None, *t.split()], [*t.split(), None])}
    assert len(pairs) > 10_000
    assert len(brown.scores(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(3), frequent_words=300).collect()) == 200
    assert max(sizes.values()) < 2_000, sizes


def test_exchange_holds_few_cells_at_a_time():
    rng = np.random.default_rng(5)
    k, sizes = 200, rng.integers(2, 8, 20_000)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    seen, n, own = rng.integers(0, 2 * k, offsets[-1]), rng.integers(1, 4, offsets[-1]), rng.integers(0, k - 1, len(sizes))
    table = rng.integers(50, 10_000, (k, k))
    tracemalloc.start()
    brown.best_classes(own, offsets, seen, n, table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25 << 20


def test_best_classes_are_those_of_a_plain_sum():
    """Words with few and with many neighbouring classes, alike and not, and a word that keeps its class."""
    rng = np.random.default_rng(7)
    k, sizes = 50, np.concatenate([rng.integers(1, 2 * brown.FEW_CELLS, 3_000), rng.integers(60, 90, 40)])
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    seen = np.concatenate([rng.choice(2 * k, size, replace=False) for size in sizes])
    n, own, table = rng.integers(1, 4, offsets[-1]), rng.integers(0, k, len(sizes)), rng.integers(200, 10_000, (k, k))
    got = brown.best_classes(own, offsets, seen, n, table)
    rows, cols, log = table.sum(axis=1), table.sum(axis=0), math.log
    for word in [*range(0, 3_000, 50), *range(3_000, 3_040, 5)]:
        cells = [(int(c), int(m)) for c, m in zip(seen[offsets[word] : offsets[word + 1]], n[offsets[word] : offsets[word + 1]])]
        size, gains = sum(m for c, m in cells if c < k), []
        for to in range(k):
            less = [(m, size) if to == own[word] else (0, 0) for _, m in cells]
            gain = sum(m * log((table[to, c] if c < k else table[c - k, to]) - out + brown.ADD_TRANSITION) for (c, m), (out, _) in zip(cells, less))
            out = size if to == own[word] else 0
            gains.append(gain - size * (log(rows[to] - out + brown.ADD_TRANSITION * k) + log(cols[to] - out + brown.ADD_WORD)))
        best = int(np.argmax(gains[: k - 1]))
        assert got[word] == (best if own[word] != k - 1 and gains[best] > gains[own[word]] + 1e-9 else own[word]), word


def test_words_are_cut_by_columns(monkeypatch):
    """Texts are cut and coded as arrays: no call for each word, and the words are those of a plain split."""
    rng = random.Random(9)
    marks = [" ", "  ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", "\x85", "\xa0", "\u2028", "\0", "a", "B", "Z", "\u00c9", "\u0130", "\U0001f600", "yz"]
    texts = [None, "", " ", *("".join(rng.choices(marks, k=rng.randrange(1, 30))) for _ in range(500))]
    want = [(t or "").encode().lower().split() for t in texts]
    monkeypatch.setattr(common._Codes, "__missing__", lambda self, key: pytest.fail("a call for each word"))
    for cut in (0, 1, 7):
        offsets, codes, words = common.lower_words(pa.array(texts).slice(cut))
        assert [[words[c] for c in codes[a:b]] for a, b in zip(offsets, offsets[1:])] == want[cut:]
        assert list(dict.fromkeys(w for t in want[cut:] for w in t)) == words
    assert common.split_words(common.joined_words(pa.array(words, pa.binary()))).to_pylist() == words
    assert common.split_words(b"").to_pylist() == [] and common.joined_words(pa.array([], pa.binary())) == b""


@pytest.mark.parametrize("most", [(400_000, 2_000_000, 64 << 20), (3, 50, 64 << 20), (400_000, 2_000_000, 30)])
def test_counts_and_pairs_do_not_depend_on_when_they_are_sent(monkeypatch, most):
    monkeypatch.setattr(brown, "SEND", most[0])
    monkeypatch.setattr(brown, "SEND_PAIRS", most[1])
    monkeypatch.setattr(brown, "SEND_BYTES", most[2])
    texts = [(i, " ".join(f"w{(i * k) % 37}" for k in range(1, 2 + i % 40)) if i % 9 else "") for i in range(60)]
    rows = []
    for at in range(0, 60, 4):
        offsets, codes, coded = common.lower_tokens(pa.array([t for _, t in texts[at : at + 4]]))
        rows.append({"ids": [i for i, _ in texts[at : at + 4]], "offsets": offsets.tobytes(), "codes": codes.astype(np.int32).tobytes(), "words": common.joined_words(coded)})
    batch = pa.RecordBatch.from_pylist(rows, pa.schema([("ids", pa.list_(pa.int64())), *((c, pa.binary()) for c in ("offsets", "codes", "words"))]))
    learnt = [words(t) for i, t in texts if brown.learns(i)]
    counts = Counter()
    for sent in brown._counted([batch]):
        counts.update(dict(zip(*(c.to_pylist() for c in sent.columns))))
    assert counts == Counter(w for t in learnt for w in t)
    listed = [f"w{i}".encode() for i in range(37)]
    frequent = SimpleNamespace(value=({w: i for i, w in enumerate(listed)}, np.ones(37, np.int64), np.zeros(37, np.int64)))
    pairs = Counter()
    for r in brown._rows(brown._pairs(frequent, 3)([batch])):
        kind = np.int32 if r["small"] else np.int64
        if r["side"] == 0:
            own, other = np.frombuffer(r["own"], kind), np.frombuffer(r["other"], kind)
            for x, y, n in zip(own.tolist(), other.tolist(), brown._widened(r["n"], len(own)).tolist()):
                pairs[x, y] += n
    number = lambda w: brown.END_ID if w is None else listed.index(w)
    assert pairs == Counter((number(x), number(y)) for t in learnt for x, y in zip([None, *t], [*t, None]))


def test_what_counted_the_vocabulary_is_gone_before_the_pairs(spark, monkeypatch):
    left, real = [], brown.exchange_words

    def exchange_words(*args, **more):
        left.extend(p.name for p in Path(scratch_root(spark), "postfeed").glob("vocabulary-*"))
        return real(*args, **more)

    monkeypatch.setattr(brown, "exchange_words", exchange_words)
    assert brown.scores(spark.createDataFrame([(1, "a b c a"), (2, None)], "doc_id long, text string")).count() == 2
    assert left == []
