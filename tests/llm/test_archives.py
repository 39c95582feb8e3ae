"""WARC archives, the filter audit and the Merkle manifest: against brute force, on broken files and on odd rows."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from postfeed.llm import filter_audit, merkle, warc
from postfeed.llm.oracles import llm_oracles
from postfeed.session import scratch_path

from odd_rows import ODD

PAGES = [
    (1, "http://a.example/1", "<p>one</p>"), (2, "http://a.example/2", "<p>one</p>"), (9, None, "<p>one</p>"), (3, "http://a.example/\r\nX: y", "é 漢"),
    (4, "http://a.example/4", None), (5, "http://a.example/5", ""), (5, "http://a.example/5", ""), (None, "http://a.example/n", "<p>one</p>"),
    (None, None, "only null"), (None, None, "only null"), (6, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (-7, "u", "x" * 300_000), (8, "u", "x" * 300_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return rows.withColumns({c: F.lit("clash") for c in ("digest", "archive", "of", "refers_to", "value", "n", "bytes")}).repartition(3)


def expected_pages(rows, least=0):
    groups = defaultdict(list)
    for page_id, _, html in rows:
        groups[(html or "").encode()].append(page_id)
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        last = max((i for i in groups[body] if i is not None), default=None)
        again = len(body) >= least and last is not None and page_id != last
        out.append((page_id, len(body), warc.base32_sha1(body), "revisit" if again else "response", last if again else None))
    return Counter(out)


@pytest.mark.parametrize("least", [0, 11])
def test_pages_come_back_from_the_archives(pages, least):
    got = warc.archived_pages(pages, least_bytes=least, archive_bytes=400)
    assert Counter(map(tuple, got.collect())) == expected_pages(PAGES, least)


def test_no_pages(pages):
    assert warc.archived_pages(pages.where("false")).count() == 0


def local_files(path):
    root = path.removeprefix("file:")
    found = [os.path.join(d, f) for d, _, files in os.walk(root) for f in files if f.startswith("part-")]
    return [(f, open(f, "rb").read()) for f in sorted(found)]


@pytest.fixture(scope="module")
def archives(spark, pages):
    path = scratch_path(spark, "warc-test")
    warc.write_pages(pages, path, archive_bytes=1000)
    return local_files(path)


def test_archives_are_gzip_members_with_whole_records(archives):
    ids = Counter()
    for _, data in archives:
        at = 0
        while at < len(data):
            unpacker = zlib.decompressobj(31)
            record = unpacker.decompress(data[at:])
            assert unpacker.eof and record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            ids[re.search(rb"WARC-Record-ID: <(.*?)>", record)[1]] += 1
            at = len(data) - len(unpacker.unused_data)
    assert sum(n for i, n in ids.items() if i.startswith(b"urn:x-page")) == len(PAGES)
    # A line break in a url starts no header.
    assert not any(b"\r\nX: y" in zlib.decompressobj(31).decompress(d) for _, d in archives)


def records(n, plain=False):
    rng = random.Random(n)
    made = [warc.page_record(i, f"http://h.example/{i}", bytes(rng.randrange(256) for _ in range(rng.choice([0, 30, 4000]))), "", None, "2024-01-01T00:00:00Z") for i in range(n)]
    made = [m.replace(b"WARC-Payload-Digest: sha1:\r\n", b"") for m in made]
    return made if plain else [warc.member(m) for m in made]


def tiles(found, size):
    """Whether records and gaps cover every byte once."""
    at = 0
    for f in sorted((f for f in found if f.length), key=lambda f: f.offset):
        if f.offset != at:
            return False
        at += f.length
    return at == size


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("seed", range(12))
def test_whole_records_are_found_behind_damage(plain, seed):
    """Bytes are changed, cut out or put in; every record without a damaged byte is found, at its place."""
    rng, made = random.Random(seed), records(30, plain)
    hit = set(rng.sample(range(30), 6))
    data, places = bytearray(), {}
    for i, m in enumerate(made):
        part = bytearray(m)
        if i in hit:
            kind, at = rng.choice(["change", "cut", "put", "front"]), rng.randrange(len(m))
            if kind == "change":
                part[at] ^= 1 << rng.randrange(8)
            elif kind == "cut":
                del part[at : at + 1 + rng.randrange(50)]
            elif kind == "put":
                part[at:at] = bytes(rng.randrange(256) for _ in range(20)) + warc.GZIP
            else:
                part[:12] = b"\0" * 12
        else:
            places[len(data)] = i
        data += part
    found = list(warc.salvage(bytes(data)))
    assert tiles(found, len(data))
    got = {f.offset: f for f in found if not f.reason}
    # A changed byte may leave a record as good as before (the time in a gzip head), never a false one.
    assert set(places) <= set(got)
    for at, i in places.items():
        assert got[at].headers["warc-record-id"] == f"<urn:x-page:{i}>" and got[at].length == len(made[i])
    assert any(f.reason for f in found)


def test_kinds_of_damage_are_named():
    whole, plain = records(3), records(3, plain=True)
    cut = whole[0] + whole[1][:-90]
    assert [(f.reason, f.offset, f.length) for f in warc.salvage(cut)] == [(None, 0, len(whole[0])), ("member is damaged", len(whole[0]), len(whole[1]) - 90)]
    # With only its checksum gone, a member's record is vouched for by its own digest.
    assert [(f.reason, f.length) for f in warc.salvage(whole[1][:-9])] == [(None, 0), ("member is damaged", len(whole[1]) - 9)]
    assert [f.reason for f in warc.salvage(plain[0].replace(b"200 OK", b"200 KO") + plain[1])] == ["block digest", None]
    assert [f.reason for f in warc.salvage(b"rubbish" + plain[1])] == ["no version line", None]
    assert [f.reason for f in warc.salvage(plain[0][:-10])] == ["cut off"]
    assert [f.reason for f in warc.salvage(plain[0].replace(b"Content-Length: ", b"Content-Length: x", 2))] == ["no length"]
    assert list(warc.salvage(b"")) == []


def test_a_damaged_member_gives_the_records_that_still_pass():
    packed = bytearray(warc.member(b"".join(records(20, plain=True))))
    later = records(1)[0]
    packed[len(packed) // 2] ^= 255
    found = list(warc.salvage(bytes(packed) + later))
    assert found[-1].offset == len(packed) and found[-1].reason is None
    rescued = [f.headers["warc-record-id"] for f in found if not f.reason and f.offset == 0]
    assert len(set(rescued)) == len(rescued) >= 15 and set(rescued) < {f"<urn:x-page:{i}>" for i in range(20)}
    assert [(f.offset, f.length) for f in found if f.reason] == [(0, len(packed))]


def test_broken_archives_are_read_on_the_cluster(spark, archives, tmp_path):
    for i, (_, data) in enumerate(archives):
        (tmp_path / f"part-{i}").write_bytes(b"\x1f\x8b\x08 not a member" + data + b"tail")
    (tmp_path / "part-empty").write_bytes(b"")
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert sum(r.kind == "record" and r.type != "warcinfo" for r in rows) == len(PAGES)
    assert Counter(r.reason for r in rows if r.kind == "gap") == {"member is damaged": len(archives), "no version line": len(archives)}


def test_payloads_are_the_pages(spark, pages):
    path = scratch_path(spark, "warc-test")
    warc.write_pages(pages, path)
    got = warc.read_archives(spark, path).where("type = 'response'").select("payload").collect()
    assert {bytes(r.payload) for r in got} == {(h or "").encode() for _, _, h in PAGES}


def test_a_member_ends_with_a_zero_byte_at_every_size():
    small = warc.member(b"x")
    assert small[-1] == 0 and warc.decoded(small, 0) == (len(small), b"x")
    big = b"\0" * (1 << 24)
    packed = warc.member(big, level=1)
    end, content = warc.decoded(packed, 0)
    assert packed[-1] == 0 and content == big and warc.decoded(packed, end) == (len(packed), b"")


# ---- filter audit ----


def masks_of(rows):
    """Per row of (doc_id, text, part, ...): the letters it fails."""
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    out = []
    for doc_id, text, *_ in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": doc_id is not None and first[t] < doc_id}
        out.append({k for k, v in fails.items() if v})
    return out


def expected_audit(rows, good, toxic):
    parts = defaultdict(list)
    for (doc_id, _, part), fails in zip(rows, masks_of(rows)):
        parts[part or ""].append((fails, doc_id in good, doc_id in toxic))
    out = {}
    for part, docs in parts.items():
        total, here = Counter(), {}
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone, left = [d for d in left if f in d[0]], [d for d in left if f not in d[0]]
                total[f] += len(gone)
                here["".join(order), step] = (len(left), len(gone), sum(f in d[0] for d in docs) - len(gone), sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone))
        out |= {(part, o, s): (*v, total[o[s - 1]]) for (o, s), v in here.items()}
    return out


def audited(df):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = df.collect()
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in names) for r in rows}
    assert len(got) == len(rows)
    return got


def test_audit_of_odd_rows(spark, odd, nothing):
    rows = [(d, t, s) for d, t, s in ODD]
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (2, 0, None), (None, 1, 1), (4, None, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")
    got = audited(filter_audit.audit_documents(odd, labels))
    assert got == expected_audit(rows, {1, 2}, {2, 4})
    assert audited(filter_audit.audit_documents(nothing, labels)) == {}
    assert audited(filter_audit.audit_documents(odd, labels.where("false"))) == expected_audit(rows, set(), set())


def test_audit_of_documents(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    said = labels.collect()
    want = expected_audit(rows, {r.doc_id for r in said if r.quality == 1}, {r.doc_id for r in said if r.toxic == 1})
    assert audited(filter_audit.audit_documents(documents, labels)) == want


@pytest.mark.parametrize("letters", ["A", "BA", "ABCD"])
def test_intervals_say_where_a_mask_goes(letters):
    """Every mask is removed once in every order, by its first failed filter."""
    n, by_rank = len(letters), filter_audit.orders(letters)
    seen = Counter()
    for mask, step, start, stop in filter_audit.intervals(letters):
        for rank in range(start, stop):
            order = [sorted(letters).index(x) for x in by_rank[rank]]
            assert step == 1 + next(k for k, i in enumerate(order) if mask >> i & 1)
            seen[mask, rank] += 1
    assert seen == {(m, r): 1 for m in range(1, 1 << n) for r in range(len(by_rank))}


def test_audit_takes_other_filters(spark):
    masks = spark.createDataFrame([("p", 0, 5), ("p", 1, 2), ("p", 3, 4), ("q", 0, 1)], "part string, mask int, n long")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in filter_audit.audit(masks, "XY").collect()}
    assert got["p", "XY", 1] == (5, 6, 0, 2, 8) and got["p", "YX", 2] == (5, 2, 4, 2, 8) and got["p", "YX", 1] == (7, 4, 0, 0, 4) and got["q", "XY", 2] == (1, 0, 0, 0, 0)
    with pytest.raises(ValueError):
        filter_audit.audit(masks, "XX")


# ---- Merkle manifest ----


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(*values):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes, arity):
    """Root and, per node, its siblings (before, after) on every level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = nodes[p - p % arity :][:arity]
            paths[i].append((run[: p % arity], run[p % arity + 1 :]))
            at[i] = p // arity
        nodes = [digest(*nodes[i : i + arity]) for i in range(0, len(nodes), arity)]
    return nodes[0], paths


def expected_proofs(rows, arity=3):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row, framed(*row)))
    keys = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = []
    for key in keys:
        groups[key].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        made.append(tree([leaf for _, leaf in groups[key]], arity))
    root, above = tree([r for r, _ in made], arity)
    out = Counter()
    for key, (subroot, paths), up in zip(keys, made, above):
        for (row, leaf), path in zip(groups[key], paths):
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None
            folded = framed(*row[:4], row[4].replace("\n", "")) if changed else leaf
            for left, right in path + up:
                folded = digest(*left, folded, *right)
            out[row[0], leaf, subroot, root, digest(*[s for pair in path + up for x in pair for s in x]), folded, folded == root] += 1
    return out


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_proofs_of_odd_rows(spark, odd, nothing, arity):
    rows = [(d, s, None if i % 4 else "en", i % 5 or None, (t and t + "\n\nx\n") if i % 3 else t) for i, (d, t, s) in enumerate(ODD * 3)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    df = df.withColumns({c: F.lit("clash") for c in ("g", "idx", "n", "key", "id", "digest", "left", "steps", "at", "part", "again", "root")})
    got = merkle.verified_documents(df, arity)
    assert Counter(map(tuple, got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())) == expected_proofs(rows, arity)
    assert merkle.verified_documents(nothing.withColumn("n_chars", F.lit(1))).count() == 0


def test_proof_of_a_lone_document(spark):
    df = spark.createDataFrame([(7, None, None, None, None)], "doc_id long, source string, lang string, n_chars long, text string")
    got = merkle.verified_documents(df).first()
    assert got.leaf == got.subroot == got.root == got.folded_root == framed(7, None, None, None, None) and got.proof_sha256 == digest()


def test_proofs_of_documents(documents):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in documents.collect()]
    got = merkle.verified_documents(documents).collect()
    assert Counter(tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in got) == expected_proofs(rows)
    assert {r.verified for r in got} == {True, False}


def test_new_operators_have_sql():
    assert {"op11_warc", "op12_filter_audit", "op13_merkle"} <= set(llm_oracles())
