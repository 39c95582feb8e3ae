"""Repeated passages, removed by paragraph MinHash banding.

A paragraph is a line of a text, or a passage of PASSAGE words that starts at an anchor. Anchors are the
smallest word-group hashes of every WINDOW neighbouring ones, so a passage that stands within the lines of
several documents starts its paragraphs at the same words in each. Passages meet on their digest. Lines
meet in bands of a MinHash signature, tuned for recall; those that meet are confirmed by the exact Jaccard
similarity of their shingles, and components of what is confirmed are clusters. Of each cluster the first
occurrence stays. All others grow on both sides, word by word, while the words are those beside the occurrence
they repeat; a single other word is passed if SHINGLE_WORDS equal ones follow it. What then is a line, or has
LEAST words, is cut out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postfeed.llm.common import SHINGLE_WORDS, SIMILARITY, binary, few, mix, ragged_binary, run_hashes, settled, slices, word_hashes, written
from postfeed.llm.graph import components
from postfeed.llm.minhash import PAYLOAD, family_links, signatures
from postfeed.operators.keyed import keyed_join

# Words of an anchored passage, and neighbouring word groups of which one is an anchor. A passage of
# PASSAGE + WINDOW - 1 = 35 words that repeats has a paragraph in common for certain; of one of 60 words with a
# changed word, one of the sides has.
PASSAGE, WINDOW = 12, 24

# Words from which a repeated passage within lines is cut, and the shortest line that is a paragraph of its own.
LEAST, LINE_WORDS = 22, 12

# Words beside a repeat that it may grow by on either side. Equal words that go on further have an anchor, and so a
# paragraph, of their own.
REACH = 48

# Coordinates in a band, and the share of similar pairs that should meet in one.
BAND_ROWS, RECALL = 2, 0.998

# Paragraphs that a task gathers before it folds repeats.
FOLD = 2_000_000

_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_UNITS = "digest long, doc long, print long, start int, words int, line boolean, again boolean, first_doc long, first_print long, first_start int, first_words int, bands binary"
_SPAN = ["doc", "print", "start", "words", "line", "first_doc", "first_print", "first_start", "first_words"]
_PLACES = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32())]))

# Repeats of one place from which they are spread over several tasks.
HOT_PLACE = 2_000

_RNG = np.random.default_rng(15)


def bands_for(similarity: float = SIMILARITY / 100, recall: float = RECALL, rows: int = BAND_ROWS) -> int:
    """The number of bands in which a pair of this similarity meets with the wanted probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


BANDS = bands_for()
_A = _RNG.integers(1, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64)


def band_keys(offsets: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The keys of each non-empty shingle run, one a band."""
    keys = np.zeros((len(offsets) - 1, BANDS), dtype=np.uint64)
    for k in range(BANDS * BAND_ROWS):
        low = np.minimum.reduceat(mix(values * _A[k] + _B[k]), offsets[:-1])
        keys[:, k // BAND_ROWS] = mix(keys[:, k // BAND_ROWS] * _A[0] + low + np.uint64(k // BAND_ROWS + 1))
    return keys


def anchors(groups: np.ndarray) -> np.ndarray:
    """Places of the smallest hash in every run of WINDOW; of equal ones the first."""
    if not len(groups):
        return np.empty(0, dtype=np.int64)
    if len(groups) < WINDOW:
        return np.array([int(groups.argmin())])
    view = np.lib.stride_tricks.sliding_window_view(groups, WINDOW)
    return np.unique(view.argmin(axis=1) + np.arange(len(view)))


def _paragraphs(part: pa.RecordBatch):
    """The paragraphs of a slice: digest, doc, print, start, words, line as arrays, and the bands of the lines."""
    flat, counts, lines = [], [], []
    for text in part.column("text").to_pylist():
        before, own = len(flat), []
        for line in (text or "").encode("utf-8", "surrogatepass").lower().split(b"\n"):
            words = line.split()
            if len(words) >= LINE_WORDS:
                own.append((len(flat) - before, len(words)))
            flat.extend(words)
        counts.append(len(flat) - before)
        lines.append(own)
    hashes = word_hashes(flat)
    groups = run_hashes(hashes, SHINGLE_WORDS)
    begins = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    starts, owners, line_at, line_owner, line_words = [], [], [], [], []
    for i, own in enumerate(lines):
        a, b = begins[i], begins[i + 1]
        places = anchors(groups[a : max(a, b - SHINGLE_WORDS + 1)])
        places = places[places + PASSAGE <= b - a]
        starts.append(places + a)
        owners.append(np.full(len(places), i))
        for start, words in own:
            line_at.append(a + start)
            line_owner.append(i)
            line_words.append(words)
    at = np.concatenate(starts) if starts else np.empty(0, np.int64)
    owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
    passages = run_hashes_at(hashes, at, PASSAGE)
    line_at, line_owner, line_words = (np.array(x, dtype=np.int64) for x in (line_at, line_owner, line_words))
    prints = np.fromiter((xxhash.xxh3_64_intdigest(hashes[s : s + n].tobytes()) for s, n in zip(line_at, line_words)), np.uint64, len(line_at))
    if len(line_at):
        sizes = line_words - SHINGLE_WORDS + 1
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        inside = np.repeat(line_at - offsets[:-1], sizes) + np.arange(offsets[-1])
        bands = band_keys(offsets, groups[inside])
    else:
        bands = np.zeros((0, BANDS), np.uint64)
    docs = part.column("doc").to_numpy(zero_copy_only=False)
    texts = part.column("print").to_numpy(zero_copy_only=False)
    every = np.concatenate([owner, line_owner])
    return (
        np.concatenate([passages, prints]).view(np.int64), docs[every], texts[every],
        (np.concatenate([at, line_at]) - begins[every]).astype(np.int32),
        np.concatenate([np.full(len(at), PASSAGE), line_words]).astype(np.int32),
        np.concatenate([np.zeros(len(at), bool), np.ones(len(line_at), bool)]),
    ), bands


def run_hashes_at(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    out = np.full(len(at), n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[at + i]
    return mix(out)


def _joined_repeats(columns: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Repeats of a task that lie on each other in a text, as they do in what they repeat, as one each."""
    order = np.lexsort((columns["start"], columns["first_start"] - columns["start"], columns["first_print"], columns["first_doc"], columns["print"], columns["doc"]))
    rows = {k: v[order] for k, v in columns.items()}
    end, n = rows["start"] + rows["words"], len(order)
    if not n:
        return rows
    shift = rows["first_start"] - rows["start"]
    apart = np.zeros(n, bool)
    apart[0] = True
    for column in (rows["doc"], rows["print"], rows["first_doc"], rows["first_print"], shift, rows["words"] == rows["first_words"]):
        apart[1:] |= column[1:] != column[:-1]
    apart[1:] |= rows["start"][1:] > end[:-1]
    heads = np.flatnonzero(apart)
    out = {k: v[heads] for k, v in rows.items()}
    out["words"] = (np.maximum.reduceat(end, heads) - out["start"]).astype(np.int32)
    out["first_words"] = out["words"].copy()
    out["line"] = np.logical_or.reduceat(rows["line"], heads)
    return out


def _units(batches):
    """Paragraphs of a task, with what it repeats already marked as again: only heads have to meet others."""
    held, bands, size = [], [], 0

    def folded():
        digest, doc, text, start, words, line = (np.concatenate(x) for x in zip(*held))
        keys = np.full(len(line), -1)
        keys[np.flatnonzero(line)] = np.arange(int(line.sum()))
        all_bands = np.concatenate(bands)
        order = np.lexsort((start, text, doc, digest))
        same = np.zeros(len(order), bool)
        same[1:] = digest[order][1:] == digest[order][:-1]
        first = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))] if len(order) else order
        twice = np.zeros(len(order), bool)
        twice[1:] = same[1:] & (doc[order][1:] == doc[order][:-1]) & (text[order][1:] == text[order][:-1]) & (start[order][1:] == start[order][:-1])
        heads, again = order[~same], order[same & ~twice]
        of = first[same & ~twice]
        repeats = _joined_repeats({
            "digest": digest[again], "doc": doc[again], "print": text[again], "start": start[again], "words": words[again], "line": line[again],
            "first_doc": doc[of], "first_print": text[of], "first_start": start[of], "first_words": words[of],
        })
        own = {"digest": digest, "doc": doc, "print": text, "start": start, "words": words, "line": line}
        row_bands = [all_bands[keys[i]].tobytes() if keys[i] >= 0 else None for i in heads.tolist()] + [None] * len(repeats["doc"])
        arrays = [pa.array(np.concatenate([v[heads], repeats[k]])) for k, v in own.items()]
        arrays.append(pa.array(np.arange(len(row_bands)) >= len(heads)))
        for k in ("first_doc", "first_print", "first_start", "first_words"):
            arrays.append(pa.concat_arrays([pa.nulls(len(heads), pa.from_numpy_dtype(repeats[k].dtype)), pa.array(repeats[k])]))
        return pa.record_batch([*arrays, pa.array(row_bands, pa.binary())], names=[*own, "again", "first_doc", "first_print", "first_start", "first_words", "bands"])

    for part in slices(batches):
        rows, keys = _paragraphs(part)
        held.append(rows)
        bands.append(keys)
        size += len(rows[0])
        if size > FOLD:
            yield folded()
            held, bands, size = [], [], 0
    if size:
        yield folded()


def _band_rows(batches):
    for batch in batches:
        keys = np.frombuffer(b"".join(batch.column("bands").to_pylist()), dtype=np.int64)
        yield pa.record_batch({"key": keys, "node": np.repeat(batch.column("node").to_numpy(zero_copy_only=False), BANDS)})


def _runs(columns: list[str]):
    """Rows sorted by their first column: marks whether a row has the first column of the row before, and that run's first row."""

    def run(batches):
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(columns))]
            key = rows[0]
            head = np.concatenate([[last is None or key[0] != last[0]], key[1:] != key[:-1]])
            at = np.maximum.accumulate(np.where(head, np.arange(len(key)), -1))
            firsts = [np.where(at >= 0, r[np.maximum(at, 0)], last[k] if last else 0).astype(r.dtype) for k, r in enumerate(rows)]
            last = [f[-1] for f in firsts]
            again = np.flatnonzero(~head)
            if len(again):
                yield pa.record_batch([pa.array(r[again]) for r in rows] + [pa.array(f[again]) for f in firsts[1:]], names=[*columns, *(f"first_{c}" for c in columns[1:])])

    return run


def repeated_spans(source: DataFrame) -> DataFrame:
    """Every paragraph that is not the first of its cluster: doc, print, start, words, line, and the same of an earlier one.

    ``source`` has doc, print (a hash of the text) and text. Words are counted from 0.
    """
    units = written(source.mapInArrow(_units, _UNITS), "units")
    lines = units.where("line AND NOT again")
    keyed = lines.select(F.col("digest").alias("node"), "bands").mapInArrow(_band_rows, "key long, node long")
    met = keyed.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_runs(["key", "node"]), "key long, node long, first_node long")
    pairs = written(few(met.where("node != first_node").select(F.col("first_node").alias("leader"), "node").distinct()), "met")
    family = written(few(pairs.unionByName(pairs.select("leader", F.col("leader").alias("node")).distinct())), "family")
    wanted = family.select(F.col("node").alias("digest")).distinct()
    places = lines.join(wanted, "digest", "left_semi").groupBy("digest").agg(F.min(F.struct("doc", "print", "start", "words")).alias("p"))
    asked = places.groupBy("p.doc", "p.print").agg(F.collect_list(F.struct("digest", "p.start", "p.words")).alias("asked"))
    # Both lists grow with the input, so they are merged with the texts at every size.
    payload = source.join(written(few(asked), "asked").hint("merge"), ["doc", "print"]).select("text", "asked").mapInArrow(_line_payload, PAYLOAD)
    payload = written(few(payload.dropDuplicates(["node"])), "payload")
    cluster = components(family_links(family, payload))

    heads = units.where("NOT again").select("digest", "doc", "print", "start", "words", "line")
    named = heads.join(cluster.where("node != root").withColumnRenamed("node", "digest"), "digest", "left")
    spots = named.select(F.coalesce("root", "digest").alias("cluster"), "doc", "print", "start", "words", "line")
    placed = spots.repartition("cluster").sortWithinPartitions("cluster", "doc", "print", "start")
    kinds = "cluster long, doc long, print long, start int, words int, line boolean, first_doc long, first_print long, first_start int, first_words int, first_line boolean"
    later = placed.mapInArrow(_runs(["cluster", "doc", "print", "start", "words", "line"]), kinds)
    later = later.where("doc != first_doc OR print != first_print OR start != first_start")
    return units.where("again").select(*_SPAN).unionByName(later.select(*_SPAN))


def _edges(batches):
    """The repeats of a text as runs without a gap, with the places of what they repeat before and behind them."""
    names = ["doc", "print", "start", "words", "line", "left_doc", "left_print", "left_at", "right_doc", "right_print", "right_at"]
    for batch in batches:
        lists = batch.column("spans")
        owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        rows = dict(zip(_SPAN[2:], (c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten())))
        order = np.lexsort((rows["first_start"], rows["first_print"], rows["first_doc"], -rows["words"], rows["start"], owner))
        owner, rows = owner[order], {k: v[order] for k, v in rows.items()}
        # Places in all texts behind one another: an end so far is never behind the start of the next text.
        base = owner << 32
        start, end = base + rows["start"], base + rows["start"] + rows["words"]
        so_far = np.maximum.accumulate(end)
        before = np.concatenate([[-1], so_far[:-1]])
        head = start > before
        left = np.flatnonzero(head)
        if not len(left):
            continue
        right = np.maximum.accumulate(np.where(head | (end > before), np.arange(len(end)), 0))[np.append(left[1:], len(end)) - 1]
        found = [
            *(batch.column(c).to_numpy(zero_copy_only=False)[owner[left]] for c in ("doc", "print")),
            rows["start"][left], (so_far[right] - start[left]).astype(np.int32), np.logical_or.reduceat(rows["line"], left),
            rows["first_doc"][left], rows["first_print"][left], rows["first_start"][left],
            rows["first_doc"][right], rows["first_print"][right], rows["first_start"][right] + rows["first_words"][right],
        ]
        yield pa.record_batch([pa.array(x) for x in found], names=names)


def _beside(words: list[bytes], at: int, right: bool) -> np.ndarray:
    """Hashes of up to REACH words behind a place, or before it, the nearest first."""
    near = words[at : at + REACH] if right else words[max(0, at - REACH) : at][::-1]
    return word_hashes(near).astype(np.uint32)


def _contexts(batches):
    for part in slices(batches):
        keys, found = [], []
        for text, asked in zip(part.column("text").to_pylist(), part.column("asked").to_pylist()):
            words = text.encode("utf-8", "surrogatepass").lower().split()
            for place in asked:
                keys.append(place["key"])
                found.append(_beside(words, place["at"], place["right"]).tobytes())
        yield pa.record_batch([pa.array(keys, pa.string()), pa.array(found, pa.binary())], names=["key", "beside"])


def with_contexts(spans: DataFrame, source: DataFrame) -> DataFrame:
    """``doc``, ``print`` and ``spans``: the runs of repeats of a text with the words beside what they repeat.

    Each place is looked up once, however many repeat it, and goes to them by a join that spreads hot places.
    """
    listed = spans.groupBy("doc", "print").agg(F.collect_list(F.struct(*_SPAN[2:])).alias("spans"))
    kinds = "doc long, print long, start int, words int, line boolean, left_doc long, left_print long, left_at int, right_doc long, right_print long, right_at int"
    runs = listed.mapInArrow(_edges, kinds)
    key = {side: F.concat_ws(":", F.lit(side), *[F.col(f"{side}_{c}").cast("string") for c in ("doc", "print", "at")]) for side in ("left", "right")}
    runs = runs.withColumns({"left": key["left"], "right": key["right"], "id": F.xxhash64("doc", "print", "start")})
    runs = written(few(runs), "runs")
    sides = [runs.select(F.col(f"{s}_doc").alias("doc"), F.col(f"{s}_print").alias("print"), F.col(f"{s}_at").alias("at"), F.lit(s == "right").alias("right"), F.col(s).alias("key")) for s in ("left", "right")]
    asked = sides[0].unionAll(sides[1]).distinct().groupBy("doc", "print").agg(F.collect_list(F.struct("key", "at", "right")).alias("asked"))
    # Rows that share an id and a text give the same words.
    found = source.join(written(few(asked), "places").hint("merge"), ["doc", "print"]).select("text", "asked").mapInArrow(_contexts, "key string, beside binary")
    found = written(few(found.dropDuplicates(["key"])), "beside")
    told = runs.select("doc", "print", "start", "words", "line", "left", "right", "id")
    for side in ("left", "right"):
        entries = found.where(F.col("key").startswith(side)).select(F.col("key").alias(side), F.col("beside").alias(f"{side}_words"))
        told = written(few(keyed_join(told, entries, side, "left", hot_rows=HOT_PLACE).drop(side)), f"told-{side}")
    return told.groupBy("doc", "print").agg(F.collect_list(F.struct("start", "words", "line", "left_words", "right_words")).alias("spans"))


def grown(own: np.ndarray, other: np.ndarray) -> int:
    """By how many words a repeat grows: to the last equal one, over single others that equal ones follow."""
    n = min(len(own), len(other))
    same = own[:n] == other[:n]
    at = 0
    while at < n:
        if same[at]:
            at += 1
        elif at + SHINGLE_WORDS < n and same[at + 1 : at + 1 + SHINGLE_WORDS].all():
            at += 1 + SHINGLE_WORDS
        else:
            break
    return at


def widened(words: list[bytes], spans: list[dict]) -> list[tuple[int, int]]:
    """The spans (start, words) to cut from a text: its runs of repeats, grown on both sides and joined where they meet."""
    out: list[list] = []
    for span in sorted(spans, key=lambda s: s["start"]):
        start, end = span["start"], span["start"] + span["words"]
        left, right = (np.frombuffer(span[k] or b"", dtype=np.uint32) for k in ("left_words", "right_words"))
        start -= grown(_beside(words, start, False), left)
        end += grown(_beside(words, end, True), right)
        if out and start <= out[-1][1]:
            out[-1] = [min(start, out[-1][0]), max(end, out[-1][1]), out[-1][2] or span["line"]]
        else:
            out.append([start, end, span["line"]])
    return [(a, b - a) for a, b, line in out if line or b - a >= LEAST]


def _line_payload(batches):
    for part in slices(batches):
        nodes, sets = [], []
        for text, asked in zip(part.column("text").to_pylist(), part.column("asked").to_pylist()):
            words = text.encode("utf-8", "surrogatepass").lower().split()
            hashes = word_hashes(words)
            for line in asked:
                nodes.append(line["digest"])
                sets.append(np.unique(run_hashes(hashes[line["start"] : line["start"] + line["words"]], SHINGLE_WORDS)))
        if nodes:
            offsets, values = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64), np.concatenate(sets)
            yield pa.record_batch([pa.array(nodes, pa.int64()), binary(signatures(offsets, values)), ragged_binary(offsets, values)], names=["node", "sign", "shingles"])


def without_words(text: str, spans: list[tuple[int, int]]) -> tuple[str, int, int]:
    """The text without the words of the spans (start, words), the words it had and the words that went.

    Blanks behind a cut go with it; a line end there stays, unless a line end is before the cut.
    """
    data = text.encode("utf-8", "surrogatepass")
    if not spans:
        return text, len(data.split()), 0
    # Where words begin and end: a blank on one side only.
    inner = np.concatenate([[False], ~_BLANK[np.frombuffer(data, np.uint8)], [False]])
    places = np.flatnonzero(inner[1:] != inner[:-1]).reshape(-1, 2)
    gone = np.zeros(len(places) + 1, dtype=np.int64)
    for start, words in spans:
        gone[min(start, len(places))] += 1
        gone[min(start + words, len(places))] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    if not gone.any():
        return text, len(places), 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    out, at = [], 0
    for a, b in zip(edges[::2], edges[1::2]):
        out.append(data[at : places[a][0]])
        at = places[b][0] if b < len(places) else len(data)
        before = b"".join(out[-2:])
        if b"\n" in data[places[b - 1][1] : at] and before and not before.endswith(b"\n"):
            out.append(b"\n")
    out.append(data[at:])
    return b"".join(out).decode("utf-8", "surrogatepass"), len(places), int(gone.sum())


def _cut(width: int):
    def run(batches):
        for part in slices(batches):
            texts, words, removed, places = [], [], [], []
            for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                cuts = widened(text.encode("utf-8", "surrogatepass").lower().split(), spans) if spans else []
                kept, n, gone = without_words(text or "", cuts)
                places.append([{"start": a, "words": b} for a, b in cuts] if spans else None)
                texts.append(None if text is None else kept)
                words.append(n)
                removed.append(gone)
            arrays = [part.column(i) for i in range(width)]
            names = [part.schema.names[i] for i in range(width)]
            yield pa.record_batch([*arrays, pa.array(texts, pa.string()), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(places, _PLACES)], names=[*names, "text", "n_words", "n_removed", "spans"])

    return run


def without_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``keep`` as __keep_0, ..., doc_id, text without repeated paragraphs, n_words, n_removed, spans.

    One row per row of ``documents``. The first occurrence of a cluster by id and place stays, all others
    are cut, in whatever documents they stand; a document may be left empty. Repeated lines of fewer than 12 words,
    and repeats within lines that are not 22 words long when grown, stay. Null and empty texts stay as they are. Rows with a null id are not compared and stay
    whole. Rows that share an id and a text are one occurrence and are cut alike; rows that share an id only
    are documents of their own. An empty table gives an empty result; extra columns are not looked at.
    """
    kept = [F.col(f"`{c}`").alias(f"__keep_{k}") for k, c in enumerate(keep)]
    rows = documents.select(*kept, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("print", F.xxhash64("text"))
    source = rows.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").alias("doc"), "print", "text")
    found = settled(documents.sparkSession, "spans", lambda: few(with_contexts(written(few(repeated_spans(source)), "repeats"), source)))
    spans = found.withColumnRenamed("doc", "doc_id")
    joined = rows.join(spans.hint("merge"), ["doc_id", "print"], "left")
    width = len(keep) + 1
    ordered = joined.select(*[f"__keep_{k}" for k in range(len(keep))], "doc_id", "text", "spans")
    kinds = [f"__keep_{k} {ordered.schema[k].dataType.simpleString()}" for k in range(len(keep))]
    return ordered.mapInArrow(_cut(width), ", ".join([*kinds, "doc_id long, text string, n_words long, n_removed long, spans array<struct<start:int,words:int>>"]))
