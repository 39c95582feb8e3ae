"""Byte BPE, packing and token rollups."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from odd_rows import LONG, ODD
from postfeed.llm import bpe, packing, rollup
from postfeed.llm.queries import op2_packing, op8_token_counts
from postfeed.llm.tokenizers_public import load_ranks, rank_encoder, rank_encoding

public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def encoder():
    return bpe.PrefixEncoder(load_ranks(public.path("byte_bpe_50k.tiktoken")), public.PATTERN)


@pytest.fixture(scope="module")
def library():
    return rank_encoding(public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


HARD = ["", " ", "\n\n  a", "don't we'll 's", "a" * 3000, " " * 700 + "x", "漢字🙂ß\u0301", "\x00\x1c\x85\xa0\u200b", "x1y22z", "<|endoftext|>", "-" * 500, "é" * 999]


@pytest.mark.parametrize("text", HARD)
def test_encoding_is_the_library_s(encoder, library, text):
    ids = encoder.encode(text)
    assert ids == library.encode_ordinary(text)
    assert encoder.decode(ids) == text.encode()


def test_encoding_of_all_characters(encoder, library):
    every = "".join(chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000)
    for at in range(0, len(every), 4096):
        text = " x".join(every[at : at + 4096])
        assert encoder.encode(text) == library.encode_ordinary(text)


def test_ids_are_those_of_the_other_file_too(library, documents):
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    texts = [r.text for r in documents.collect()] + HARD
    assert [e.ids for e in other.encode_batch(texts, add_special_tokens=False)] == [library.encode_ordinary(t) for t in texts]


def test_packed_ids_are_those_of_the_json_file_as_it_is(spark, documents, tmp_path):
    from tokenizers import Tokenizer

    other, encode = Tokenizer.from_file(public.path("byte_bpe_50k.json")), rank_encoder(added="byte_bpe_50k.json")()
    literal = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x  <|endoftext|>  <|endoftext|\n", "<|endoftext|>" * 3000, "'<|endoftext|>s"]
    texts = [r.text for r in documents.collect()] + HARD + literal
    assert [e.ids for e in other.encode_batch(texts, add_special_tokens=False)] == [encode(t).tolist() for t in texts]
    docs = spark.createDataFrame(list(enumerate(literal)), "doc_id long, text string")
    docs.withColumn("lang", F.lit("")).withColumn("source", F.lit("")).withColumn("n_chars", F.lit(0)).write.parquet(f"{tmp_path}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)["packing"]
    for got in (op2_packing(spark, str(tmp_path)), stage(spark, docs, str(tmp_path))):
        rows = {(r.doc_id, r.start): (r.length, r.ids_crc32) for r in got.collect()}
        for doc_id, text in enumerate(literal):
            ids = np.array([*other.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
            mine = {start: v for (d, start), v in rows.items() if d == doc_id}
            assert sum(n for n, _ in mine.values()) == len(ids)
            assert all(crc == zlib.crc32(ids[start : start + n].tobytes()) for start, (n, crc) in mine.items())


def test_every_prefix_has_its_entry(encoder, library):
    data = "unbelievablyréal".encode()
    table = encoder.extend([], data)
    for end in range(1, len(data) + 1):
        assert encoder.word(data[:end], table[:end]) == [encoder.ranks[t] for t in encoder.merged(data[:end])]


def test_appends_and_edits_are_exact(encoder, library):
    random.seed(4)
    for _ in range(150):
        text = "".join(random.choice(["ab", " the", "'", "s", " ", "\n", "1", "é", "ing", "--"]) for _ in range(30))
        encoded = bpe.EncodedText(encoder, text)
        for _ in range(4):
            a = random.randint(0, len(text))
            b, new = min(len(text), a + random.randint(0, 4)), random.choice(["", " ", "x", "'s", "  ", "\n\n", "ée 12"])
            if random.random() < 0.4:
                text += new
                encoded.append(new)
            else:
                text = text[:a] + new + text[b:]
                encoded.edit(a, b, new)
            assert encoded.ids() == library.encode_ordinary(text)


def test_encode_decode_frames(spark, odd, nothing, library):
    make = bpe.prefix_encoder(public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    got = bpe.round_trip(odd, make).collect()
    want = [((d, len(i := library.encode_ordinary(t or ""))), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for d, t, _ in ODD]
    assert sorted(map(str, (((r.doc_id, r.n_tokens), r.ids_sha256, r.decoded_sha256) for r in got))) == sorted(map(str, want))
    back = bpe.decode_ids(bpe.encode_texts(odd, make), make).collect()
    assert sorted(bytes(r.bytes) for r in back) == sorted((t or "").encode() for _, t, _ in ODD)
    assert bpe.round_trip(nothing, make).count() == 0
    edits = spark.createDataFrame([(1, "the cat", None, None, " sat"), (2, "the cat", 4, 7, "dog"), (3, None, 0, None, "x")], "doc_id long, text string, start int, stop int, new string")
    assert {r.doc_id: r.ids for r in bpe.encode_edits(edits, make).collect()} == {1: library.encode_ordinary("the cat sat"), 2: library.encode_ordinary("the dog"), 3: library.encode_ordinary("x")}


def check_packing(rows, texts, library, sequence):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= sequence
    for doc_id, text in texts.items():
        ids, at = np.array([*library.encode_ordinary(text or ""), 0], "<u4"), 0
        own = sorted(pieces[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // sequence)))
        for r in own:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids) and all(r.length == sequence for r in own[1:])
    return len(sequences)


def test_packing_is_exact_and_tight(documents, library):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = packing.pack_documents(documents.repartition(6), rank_encoder()).collect()
    used = check_packing(rows, texts, library, packing.SEQUENCE)
    best = len(packing.best_fit([r.length for r in rows], packing.SEQUENCE)[2])
    assert used <= best * 1.02 + 1


def test_merge_rounds(spark, monkeypatch):
    """Many tasks with few items each need the tree."""
    random.seed(1)
    items = spark.createDataFrame([(i, 0, 0, random.randint(1, 100), 0) for i in range(3000)], packing._PIECES).repartition(40)
    monkeypatch.setattr(packing, "FAN_IN", 200)
    rows = packing.pack(items, 100, 2).collect()
    fill = defaultdict(int)
    for r in rows:
        fill[r.sequence_id] += r.length
    assert len(rows) == 3000 and max(fill.values()) <= 100
    # Bins are merged whole, so a few in a hundred more than without tasks.
    assert len(fill) <= 1.06 * sum(fill.values()) / 100 + 1


def test_packing_of_odd_rows(odd, nothing, library):
    rows = packing.pack_documents(odd, rank_encoder()).collect()
    tokens = sum(len(library.encode_ordinary(t or "")) + 1 for _, t, _ in ODD)
    assert sum(r.length for r in rows) == tokens and len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert packing.pack_documents(nothing, rank_encoder()).count() == 0


def test_best_fit():
    at, offset, fills = packing.best_fit([5, 7, 3, 5], 10)
    assert sorted(fills.tolist()) == [10, 10] and offset[1] == 0 and offset[2] == 7 and at[0] == at[3]


def test_rollup_is_delta_maintained(spark, tmp_path, odd, nothing):
    book = rollup.Rollup(spark, f"{tmp_path}/book")
    assert book.totals().count() == 0
    counted = rollup.token_counts(odd, {"t": lambda: str.split})
    got = lambda: {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in book.totals().collect()}
    book.commit("one", rollup.inserts(counted, "v1", "t"))
    want = defaultdict(lambda: [0, 0])
    for _, text, source in ODD:
        want[source, "clash", "v1"][0] += 1
        want[source, "clash", "v1"][1] += len((text or "").split())
    assert got() == {k: tuple(v) for k, v in want.items()}
    for _ in range(2):
        book.commit("two", rollup.deletes(counted.where("source = 'b'"), "v1", "t").unionByName(rollup.revisions(counted.where("source = 'x'"), "v1", "t", "doc_id")))
    del want["b", "clash", "v1"]
    want["x", "clash", "v1"][1] = 1
    assert got() == {k: tuple(v) for k, v in want.items()}
    book.commit("none", rollup.inserts(rollup.token_counts(nothing, {"t": lambda: str.split}), "v1", "t"))
    assert got() == {k: tuple(v) for k, v in want.items()}
    # Put together, the totals are the same and a batch is still known.
    book.tidy("tidy")
    book.commit("one", rollup.inserts(counted, "v1", "t"))
    assert got() == {k: tuple(v) for k, v in want.items()} and book.table.version().files == 1
    with pytest.raises(ValueError):
        book.commit("../x", rollup.inserts(counted, "v1", "t"))


def test_a_batch_that_breaks_off_is_not_counted(spark, tmp_path, odd, monkeypatch):
    book = rollup.Rollup(spark, f"{tmp_path}/book")
    counted = rollup.token_counts(odd, {"t": lambda: str.split})
    book.commit("one", rollup.inserts(counted, "v1", "t"))
    before = sorted(map(str, book.totals().collect()))
    monkeypatch.setattr(type(book.table), "_publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        book.commit("two", rollup.deletes(counted, "v1", "t"))
    monkeypatch.undo()
    assert sorted(map(str, book.totals().collect())) == before
    book.commit("two", rollup.deletes(counted, "v1", "t"))
    assert book.totals().count() == 0


def test_token_counts_query_against_brute_force(spark, documents, library):
    sf_dir = "/root/testdata/sf0.001"
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r.toxic == 1}
    multi = rank_encoding(public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN)
    want = defaultdict(lambda: [0, 0])
    for r in documents.collect():
        if r.doc_id not in toxic:
            for name, count in (("byte_bpe_50k", len(library.encode_ordinary(r.text.strip()))), ("byte_bpe_multi_50k", len(multi.encode_ordinary(r.text)))):
                want[r.source, r.lang, name][0] += 1
                want[r.source, r.lang, name][1] += count
    got = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in op8_token_counts(spark, sf_dir).collect()}
    assert got == {k: tuple(v) for k, v in want.items()}


def test_a_long_text_is_counted_whole(library):
    assert len(rank_encoder()()(LONG)) == len(library.encode_ordinary(LONG))
