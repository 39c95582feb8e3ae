"""Language-model scoring with Brown class n-grams.

Words get classes by exchange clustering; a text's probability is the product of class transitions and of
each word's emission from its class. Counts come from all training texts. A first clustering of the most
frequent words and of groups by ending gives every word a class to start from; then each sweep counts, for every
training word, the classes beside it and moves the word to its best class. Frequent words travel to the tasks,
a list of bounded length. All other words are dealt to buckets: whoever needs their classes or counts, a bucket's
neighbour pairs or a slice of texts, asks the words' buckets once for each distinct word. Texts are cut into words
once; pairs, requests and answers travel as arrays, a row for each two buckets.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass
from itertools import groupby, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postfeed.llm.common import _Codes, forget, joined_words, lower_tokens, ragged_binary, settled, slices, split_words, word_hashes, written, written_at

# Remainder of crc32(id as text) modulo FOLDS that marks rows the model never learns from.
FOLDS, HELD_OUT = 5, 1

# The most frequent words, whose counts travel to the tasks; the rest is joined, whatever its number.
FREQUENT = 1 << 17

# Words that start with a class of their own choice, and groups by ending from which all other words start.
OWN, ENDINGS = 320, 191

# Least classes besides that of the text's end, sweeps of the exchange over the units and over all words, and
# what is added to counts.
CLASSES, SWEEPS, WORD_SWEEPS = 40, 6, 4
ADD_TRANSITION, ADD_WORD = 0.5, 0.5

# Cells of a product of word profiles and class table that a task holds: few enough for a core's cache.
CELLS = 1 << 16

# Neighbouring classes up to which words with equally many are summed together.
FEW_CELLS = 8

# Cells of words and classes in which a task folds neighbours at a time.
PROFILE_CELLS = 1 << 20

# Training words for which there is a bucket.
BUCKET_TOKENS = 1 << 20

# Distinct words that a task counts before it sends them on, and words whose pairs it counts; bytes of words for either.
SEND, SEND_PAIRS, SEND_BYTES = 400_000, 2_000_000, 64 << 20

# The most frequent words, and the end: their neighbours are too many for one bucket, so their pairs lie with the neighbour.
WIDE = 32

# Clustered units; the last is the end of a text, before its first word too.
UNITS = OWN + ENDINGS + 1
END = UNITS - 1

# Numbers of words: the place in the list, from TAIL on a hash of a word outside it, END_ID for the end.
# Lower numbers are cells of the units' table.
TAIL, END_ID = 1 << 61, -1


def learns(doc_id: int | None) -> bool:
    """Whether the row is a training row; a null id is."""
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % FOLDS != HELD_OUT


def ending(word: bytes) -> int:
    """The unit from which a word starts that has none by itself; words never trained on keep its class."""
    return OWN + xxhash.xxh64_intdigest(word[-3:]) % ENDINGS


def classes_for(types: int) -> int:
    """The number of classes besides that of the end, which grows with the vocabulary."""
    return max(CLASSES, round(types ** (1 / 3)))


CODED = "unit long, ids array<long>, offsets binary, codes binary, words binary"


def _coded(batches):
    """One row per slice of texts: its rows' ids, where each text starts, the code of each word and the coded words."""
    from pyspark import TaskContext

    unit = TaskContext.get().partitionId() << 33
    for part in slices(batches):
        offsets, codes, words = lower_tokens(part.column("text"))
        arrays = [pa.array([unit]), pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64()))]
        arrays += [pa.array([x], pa.binary()) for x in (offsets.tobytes(), codes.astype(np.int32).tobytes(), joined_words(words))]
        yield pa.record_batch(arrays, names=["unit", "ids", "offsets", "codes", "words"])
        unit += 1


def _rows(batches):
    for batch in batches:
        names, columns = batch.schema.names, batch.columns
        for i in range(batch.num_rows):
            yield {name: column[i].as_py() for name, column in zip(names, columns)}


def _texts(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and codes of a slice."""
    return np.frombuffer(row["offsets"], np.int64), np.frombuffer(row["codes"], np.int32).astype(np.int64)


def _trained(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Those of the training rows of a slice."""
    offsets, codes = _texts(row)
    mine, sizes = np.fromiter(map(learns, row["ids"]), bool, len(row["ids"])), np.diff(offsets)
    return np.concatenate([[0], np.cumsum(sizes[mine])]).astype(np.int64), codes[np.repeat(mine, sizes)]


def _counted(batches):
    def folded():
        coded = pa.concat_arrays(words).dictionary_encode()
        sums = np.bincount(coded.indices.to_numpy(zero_copy_only=False), weights=np.concatenate(counts), minlength=len(coded.dictionary))
        return coded.dictionary, sums.astype(np.int64)

    words, counts, size, held = [], [], 0, 0
    for row in _rows(batches):
        _, codes = _trained(row)
        n = np.bincount(codes)
        seen = np.flatnonzero(n)
        if len(seen):
            words.append(split_words(row["words"]).take(pa.array(seen)))
            counts.append(n[seen])
            size, held = size + len(seen), held + words[-1].nbytes
        if size > 3 * SEND or held > SEND_BYTES:
            word, n = folded()
            words, counts, size, held = [word], [n], len(word), word.nbytes
            if size > SEND or held > SEND_BYTES // 2:
                yield pa.record_batch([word, pa.array(n)], names=["word", "n"])
                words, counts, size, held = [], [], 0, 0
    if words:
        yield pa.record_batch([*map(pa.array, folded())], names=["word", "n"])


@dataclass
class Frequent:
    """The list that travels: per word its index; per index the count and unit."""

    index: dict[bytes, int]
    counts: np.ndarray
    units: np.ndarray

    def places(self, words: list[bytes]) -> np.ndarray:
        """Index of each word, -1 if it is not in the list."""
        return np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Index of each word and its unit."""
        at = self.places(words)
        unit = np.where(at >= 0, self.units[at] if len(self.units) else 0, 0)
        other, endings = np.flatnonzero(at < 0), _Codes()
        code = np.fromiter((endings[words[i][-3:]] for i in other.tolist()), np.int64, len(other))
        unit[other] = (OWN + (word_hashes(list(endings)) % np.uint64(ENDINGS)).astype(np.int64))[code]
        return at, unit

    def numbers(self, words: list[bytes], at: np.ndarray) -> np.ndarray:
        """The number of each word, given its index."""
        out, other = at.copy(), np.flatnonzero(at < 0)
        out[other] = TAIL | (word_hashes([words[i] for i in other.tolist()]) >> np.uint64(3)).astype(np.int64)
        return out


def _with_ends(offsets: np.ndarray, values: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values with an end after them, and the places of the ends."""
    ends = offsets[1:] + np.arange(len(offsets) - 1)
    out = np.empty(len(values) + len(ends), dtype=np.int64)
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner], out[ends] = values, end
    return out, ends


def _numbered(frequent):
    """Number, count and starting unit of each word."""

    def run(batches):
        table = Frequent(*frequent.value)
        for batch in batches:
            words = batch.column("word").to_pylist()
            at, unit = table.look_up(words)
            yield pa.record_batch({"id": table.numbers(words, at), "n": batch.column("n"), "unit": unit})

    return run


def _pairs(frequent, buckets: int):
    """Counts of neighbouring words by number, dealt to buckets."""

    def run(batches):
        table = Frequent(*frequent.value)

        def sent():
            # No word is empty; the end has code 0.
            coded = pa.concat_arrays(words).dictionary_encode()
            code, at, keys = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1, 0, []
            for (offsets, codes), mine in zip(texts, words):
                after, _ = _with_ends(offsets, code[at : at + len(mine)][codes], 0)
                keys.append(np.concatenate([[0], after[:-1]]) << 32 | after)
                at += len(mine)
            keys = np.sort(np.concatenate(keys))
            heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            n, keys = np.diff(np.append(heads, len(keys))), keys[heads]
            known = joined_words(coded.dictionary).split()
            number = np.concatenate([[END_ID], table.numbers(known, table.places(known))])
            yield from _blocks(number[keys >> 32], number[keys & 0xFFFFFFFF], n, buckets)

        texts, words, size, held = [], [], 0, 0
        for row in _rows(batches):
            offsets, codes = _trained(row)
            if len(offsets) > 1:
                texts.append((offsets, codes))
                words.append(split_words(row["words"]))
                size, held = size + len(codes) + len(offsets) - 1, held + words[-1].nbytes
            if size > SEND_PAIRS or held > SEND_BYTES:
                yield from sent()
                texts, words, size, held = [], [], 0, 0
        if texts:
            yield from sent()

    return run


def buckets_for(spark: SparkSession, tokens: int) -> int:
    """The number of buckets that words are dealt to, a few for each core and one for every BUCKET_TOKENS trained on."""
    return max(4 * spark.sparkContext.defaultParallelism, -(-tokens // BUCKET_TOKENS))


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


BLOCKS = "bucket int, side int, small boolean, own binary, other binary, n binary"


def _blocks(a: np.ndarray, b: np.ndarray, times: np.ndarray, buckets: int):
    """Pairs dealt to the buckets of both words: the word, its neighbour after (side 0) or before it (side 1), and the count."""
    for side, own, other in ((0, a, b), (1, b, a)):
        small = (own < TAIL) & (other < TAIL)
        key = np.where(own < WIDE, other, own) % buckets * 2 + small
        order = np.argsort(key.astype(np.uint16) if buckets < 1 << 15 else key, kind="stable")
        key, n = key[order], _narrow(times)[order]
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        ends = np.append(heads[1:], len(key))
        for listed, kind in ((0, np.int64), (1, np.int32)):
            mine = key[heads] % 2 == listed
            if mine.any():
                # Only numbers of listed words fit the smaller kind.
                at = np.repeat(mine, ends - heads)
                offsets = np.concatenate([[0], np.cumsum((ends - heads)[mine])]).astype(np.int64)
                k = int(mine.sum())
                arrays = [pa.array((key[heads][mine] // 2).astype(np.int32)), pa.array(np.full(k, side, np.int32)), pa.array([bool(listed)] * k)]
                arrays += [ragged_binary(offsets, own[order[at]].astype(kind)), ragged_binary(offsets, other[order[at]].astype(kind)), ragged_binary(offsets, n[at])]
                yield pa.record_batch(arrays, names=["bucket", "side", "small", "own", "other", "n"])


def _dealt(buckets: int):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from _blocks(*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "n")), buckets)

    return run


def _by_bucket(batches):
    """The rows of each bucket, from rows sorted by bucket."""
    for bucket, rows in groupby(_rows(batches), key=lambda row: row["bucket"]):
        yield bucket, list(rows)


def _narrow(n: np.ndarray) -> np.ndarray:
    """Counts in the smallest type that holds them all."""
    return n.astype(np.min_scalar_type(int(n.max(initial=0))))


def _widened(n: bytes, count: int) -> np.ndarray:
    return np.frombuffer(n, f"u{len(n) // max(1, count) or 1}").astype(np.int64)


def _joined(parts, kind=np.int64) -> np.ndarray:
    return np.concatenate([np.empty(0, kind), *[np.frombuffer(x, kind) for x in parts]])


def _requests(ids: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Where the answer for each of the sorted ids stands when answers come in the order of buckets; the ids of each bucket."""
    bucket = ids % buckets
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    return place, [(int(x[0] % buckets), x) for x in np.split(ids[order], cuts) if len(x)]


STATE = "asked boolean, bucket int, unit int, id binary, slot binary, size binary, code binary, n binary"


def _states(buckets: int, listed: int):
    """Per bucket the words it moves, with the neighbours of each, and the words whose classes it asks other buckets for.

    A slot is where a word's class stands: listed words by number after the end, then the answers of the buckets.
    """

    def run(batches):
        def sent(asked, bucket, unit, *arrays):
            values = [pa.array([x], t) for x, t in ((asked, pa.bool_()), (bucket, pa.int32()), (unit, pa.int32()))]
            values += [pa.array([x.tobytes()], pa.binary()) for x in arrays] + [pa.nulls(1, pa.binary())] * (5 - len(arrays))
            return pa.record_batch(values, names=["asked", "bucket", "unit", "id", "slot", "size", "code", "n"])

        for bucket, rows in _by_bucket(batches):
            ids = np.sort(_joined(r["own"] for r in rows if r["side"] < 0))
            rows = [r for r in rows if r["side"] >= 0]
            own, other = (np.concatenate([np.empty(0, np.int64), *[np.frombuffer(r[c], np.int32 if r["small"] else np.int64) for r in rows]]) for c in ("own", "other"))
            sizes = [len(r["other"]) // (4 if r["small"] else 8) for r in rows]
            n = np.concatenate([np.empty(0, np.int64), *[_widened(r["n"], size) for r, size in zip(rows, sizes)]])
            side = np.repeat(np.array([r["side"] for r in rows], np.int64), sizes)
            del rows
            far = other >= TAIL
            asked = _distinct(np.concatenate([ids[ids >= TAIL], other[far]]))
            place, requests = _requests(asked, buckets)

            def slots(x, far):
                out = x + 1
                out[far] = listed + 1 + place[np.searchsorted(asked, x[far])]  # noqa: B023
                return out

            code = slots(other, far) * 2 + side
            del other, side, far
            for wide in (False, True):
                mine = (own < WIDE) == wide
                words = _distinct(own[mine]) if wide else ids[ids >= WIDE]
                key = np.searchsorted(words, own[mine]) << 32 | code[mine]
                order = np.argsort(key)
                key = key[order]
                heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
                times = np.add.reduceat(n[mine][order], heads) if len(heads) else n[:0]
                key = key[heads]
                size = np.bincount(key >> 32, minlength=len(words))
                yield sent(False, bucket, -1 - wide, words, slots(words, words >= TAIL).astype(np.int32), size.astype(np.int64), (key & 0xFFFFFFFF).astype(np.int32), _narrow(times))
            for provider, x in requests:
                yield sent(True, provider, bucket, x)

    return run


ANSWERS = "bucket int, unit int, class binary"


def _answers(batches):
    """The classes of the words that each bucket was asked for; rows with unit -1 have its words and their classes."""
    for bucket, rows in _by_bucket(batches):
        own = [r for r in rows if r["unit"] < 0]
        ids, classes = _joined(r["id"] for r in own), _joined((r["class"] for r in own), np.int16)
        order = np.argsort(ids)
        ids, classes = ids[order], classes[order]
        for r in rows:
            if r["unit"] >= 0:
                found = classes[np.searchsorted(ids, np.frombuffer(r["id"], np.int64))]
                yield pa.record_batch([pa.array([r["unit"]], pa.int32()), pa.array([bucket], pa.int32()), pa.array([found.tobytes()], pa.binary())], names=["bucket", "unit", "class"])


PROFILES = "bucket int, wide boolean, id binary, class binary, size binary, seen binary, n binary"


def _profiles(known, k: int, sides: int):
    """Per bucket its words in chunks: the class each has, the classes beside it and their counts.

    A class after the word is itself, one before it has k added. Rows of wide words have a part of their neighbours.
    """

    def run(batches):
        for bucket, rows in _by_bucket(batches):
            answers = sorted((r for r in rows if r["class"] is not None), key=lambda r: r["unit"])
            classes = np.concatenate([known.value, _joined((r["class"] for r in answers), np.int16)]).astype(np.int64)
            for row in (r for r in rows if r["class"] is None):
                ids, own = np.frombuffer(row["id"], np.int64), classes[np.frombuffer(row["slot"], np.int32)]
                size, code = np.frombuffer(row["size"], np.int64), np.frombuffer(row["code"], np.int32)
                n = _widened(row["n"], len(code))
                offsets = np.concatenate([[0], np.cumsum(size)])
                # As many words as have PROFILE_CELLS cells.
                step = max(1, PROFILE_CELLS // (2 * k))
                for at in range(0, len(ids), step):
                    end = min(at + step, len(ids))
                    a, b = offsets[at], offsets[end]
                    word, part, times = np.repeat(np.arange(end - at), size[at:end]), code[a:b], n[a:b]
                    if sides == 1:
                        after = part % 2 == 0
                        word, part, times = word[after], part[after], times[after]
                    cells = np.bincount((word * 2 + part % 2) * k + classes[part >> 1], weights=times, minlength=(end - at) * 2 * k)
                    seen = np.flatnonzero(cells)
                    arrays = [ids[at:end], own[at:end], np.bincount(seen // (2 * k), minlength=end - at).astype(np.int64), seen % (2 * k), cells[seen].astype(np.int64)]
                    values = [pa.array([bucket], pa.int32()), pa.array([row["unit"] == -2])] + [pa.array([x.tobytes()], pa.binary()) for x in arrays]
                    yield pa.record_batch(values, names=["bucket", "wide", "id", "class", "size", "seen", "n"])

    return run


def _log_sum(x):
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Exchange clustering: the class of each unit, by the mutual information of neighbouring classes.

    Each unit in turn leaves its class for the one where the information is largest, until a sweep moves
    nothing. The end has the last class to itself.
    """
    counts = pairs.astype(np.float64)
    of = np.empty(UNITS, dtype=np.int64)
    by_count = np.argsort(-counts[:END].sum(axis=1), kind="stable")
    of[by_count] = np.arange(END) % classes
    of[END] = classes
    k = classes + 1
    table = np.zeros((k, k))
    np.add.at(table, (of[:, None], of[None, :]), counts)
    for _ in range(sweeps):
        moved = 0
        for u in by_count:
            out, into, own = np.bincount(of, weights=counts[u], minlength=k), np.bincount(of, weights=counts[:, u], minlength=k), counts[u, u]
            if not out.any() and not into.any():
                continue
            here = of[u]
            out[here] -= own
            into[here] -= own
            table[here] -= out
            table[:, here] -= into
            table[here, here] -= own
            rows, cols = table.sum(axis=1), table.sum(axis=0)
            gain = (_log_sum(table + out) - _log_sum(table)).sum(axis=1) + (_log_sum(table.T + into) - _log_sum(table.T)).sum(axis=1)
            diagonal = np.diag(table)
            gain += _log_sum(diagonal + out + into + own) + _log_sum(diagonal) - _log_sum(diagonal + out) - _log_sum(diagonal + into)
            gain -= _log_sum(rows + out.sum() + own) - _log_sum(rows) + _log_sum(cols + into.sum() + own) - _log_sum(cols)
            best = int(gain[:classes].argmax())
            moved += best != here
            of[u] = best
            table[best] += out
            table[:, best] += into
            table[best, best] += own
        if not moved:
            break
    return of


def _unpacked(row: dict):
    """Classes of the words, then offsets, classes beside them and counts."""
    own, size, seen, n = (np.frombuffer(row[c], np.int64) for c in ("class", "size", "seen", "n"))
    return own, np.concatenate([[0], np.cumsum(size)]).astype(np.int64), seen, n


def _table(k: int):
    """Cells of the class table, what follows the words of each class; below 0 those of wide words and classes beside them."""

    def run(batches):
        total, wide = np.zeros(k * k, dtype=np.int64), np.zeros((WIDE + 1) * 2 * k, dtype=np.int64)
        for row in _rows(batches):
            own, offsets, seen, n = _unpacked(row)
            after, size = seen < k, np.diff(offsets)
            cells = np.repeat(own, size)[after] * k + seen[after]
            total += np.bincount(cells, weights=n[after], minlength=k * k).astype(np.int64)
            if row["wide"]:
                cells = np.repeat(np.frombuffer(row["id"], np.int64) + 1, size) * 2 * k + seen
                wide += np.bincount(cells, weights=n, minlength=len(wide)).astype(np.int64)
        cells, more = np.flatnonzero(total), np.flatnonzero(wide)
        yield pa.record_batch({"cell": np.concatenate([cells, -1 - more]), "n": np.concatenate([total[cells], wide[more]])})

    return run


def information(table: np.ndarray) -> float:
    """What the likelihood of the training texts owes to the classes."""
    return float(_log_sum(table).sum() - _log_sum(table.sum(axis=1)).sum() - _log_sum(table.sum(axis=0)).sum())


def best_classes(own: np.ndarray, offsets: np.ndarray, seen: np.ndarray, n: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The class in which the neighbours of each word are likeliest; its own is measured without the word.

    ``seen`` is the class after the word, or len(table) plus the class before it.
    """
    if not len(seen):
        return own
    k = len(table)
    rows, cols = table.sum(axis=1), table.sum(axis=0)
    beside = np.log(np.concatenate([table.T, table]) + ADD_TRANSITION)
    divisor = np.log(rows + ADD_TRANSITION * k), np.log(cols + ADD_WORD)
    both = divisor[0] + divisor[1]
    # Sizes of the words, after and before: each of its tokens has one neighbour on either side.
    word = np.repeat(np.arange(len(own)), np.diff(offsets))
    size = np.bincount(word, weights=np.where(seen < k, n, 0), minlength=len(own))
    home = own[word]
    cell = np.where(seen < k, table[home, seen % k], table[seen % k, home])
    stay = np.bincount(word, weights=n * np.log(cell - n + ADD_TRANSITION), minlength=len(own))
    stay -= size * (np.log(np.maximum(rows[own] - size, 0) + ADD_TRANSITION * k) + np.log(np.maximum(cols[own] - size, 0) + ADD_WORD))
    best = own.copy()

    def choose(words, gain):
        gain -= size[words, None] * both
        gain[np.arange(len(words)), own[words]] = stay[words]
        # A word stays where nothing is better; the class of the end is no word's.
        to = gain[:, : k - 1].argmax(axis=1)
        moves = (own[words] != k - 1) & (gain[np.arange(len(words)), to] > stay[words] + 1e-9)
        best[words] = np.where(moves, to, own[words])

    # Two or three blocks are held at a time.
    sizes, step = np.diff(offsets), max(1, CELLS // (2 * k))
    # Words with as many neighbours each are summed a neighbour at a time, all at once.
    for neighbours in range(1, FEW_CELLS + 1):
        alike = np.flatnonzero(sizes == neighbours)
        for at in range(0, len(alike), step):
            words = alike[at : at + step]
            gain, more = None, None
            for cell in offsets[words] + np.arange(neighbours)[:, None]:
                cells = beside.take(seen[cell], axis=0)
                cells *= n[cell, None]
                # The first is added last, as in a sum of a slice.
                if gain is None:
                    gain = cells
                elif more is None:
                    more = cells
                else:
                    more += cells
            choose(words, gain if more is None else gain + more)
    rest = np.flatnonzero((sizes < 1) | (sizes > FEW_CELLS))
    ends = np.concatenate([[0], np.cumsum(sizes[rest])]).astype(np.int64)
    at = 0
    while at < len(rest):
        end = max(at + 1, int(np.searchsorted(ends, ends[at] + CELLS // k, side="right")) - 1)
        words = rest[at:end]
        cell = np.repeat(offsets[words] - ends[at:end], sizes[words]) + np.arange(ends[at], ends[end])
        cells = beside.take(seen[cell], axis=0)
        cells *= n[cell, None]
        choose(words, np.add.reduceat(cells, ends[at:end] - ends[at], axis=0))
        at = end
    return best


def _moved(table: np.ndarray):
    def run(batches):
        for row in _rows(batches):
            best = best_classes(*_unpacked(row), table)
            yield pa.record_batch([pa.array([row["bucket"]], pa.int32()), pa.array([row["id"]], pa.binary()), pa.array([best.astype(np.int16).tobytes()], pa.binary())], names=["bucket", "id", "class"])

    return run


def _unpacked_classes(listed_only: bool):
    def run(batches):
        for row in _rows(batches):
            ids, classes = np.frombuffer(row["id"], np.int64), np.frombuffer(row["class"], np.int16).astype(np.int64)
            mine = ids < TAIL if listed_only else np.ones(len(ids), bool)
            yield pa.record_batch({"id": ids[mine], "class": classes[mine]})

    return run


def _packed(columns: dict[str, type]):
    """The rows of each bucket as arrays, from rows sorted by bucket."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                bucket = batch.column("bucket").to_numpy(zero_copy_only=False)
                heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                offsets = np.append(heads, len(bucket)).astype(np.int64)
                arrays = [ragged_binary(offsets, batch.column(c).to_numpy(zero_copy_only=False).astype(kind)) for c, kind in columns.items()]
                yield pa.record_batch([pa.array(bucket[heads]), *arrays], names=["bucket", *columns])

    return run


def packed(rows: DataFrame, buckets: int, **columns: type) -> DataFrame:
    """Rows with an id as a row per bucket, or a few, with an array for each column."""
    bucket = F.pmod("id", F.lit(buckets)).cast("int").alias("bucket")
    dealt = rows.select(bucket, *columns).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_packed(columns), "bucket int, " + ", ".join(f"{c} binary" for c in columns))


def _sorted(parts: DataFrame) -> DataFrame:
    return parts.repartition("bucket").sortWithinPartitions("bucket")


def exchange_words(pairs: DataFrame, classed: DataFrame, k: int, sweeps: int = WORD_SWEEPS, buckets: int = 32) -> tuple[DataFrame, np.ndarray]:
    """Exchange over all words, from the classes given: id and class of each word, and the class table.

    ``pairs`` has the counts n of neighbouring words a and b, or blocks of them dealt to ``buckets``; ``classed``
    the id and class of every word and of the end. A sweep takes every word to its best class at once
    and counts if it raises the information; the first that does not ends the exchange.
    """
    spark = pairs.sparkSession
    # The list, bounded, and the end.
    near = classed.where(F.col("id") < TAIL).toArrow()
    near = dict(zip(near.column("id").to_pylist(), near.column("class").to_pylist()))
    listed = max(near, default=END_ID) + 1
    known = np.zeros(listed + 1, np.int16)
    for word, cls in near.items():
        known[word + 1] = cls
    classes, path = written_at(packed(classed, buckets, id=np.int64, **{"class": np.int16}), "classes")
    blocks = pairs if "bucket" in pairs.columns else pairs.mapInArrow(_dealt(buckets), BLOCKS)
    words = classes.select("bucket", F.lit(-1).alias("side"), F.col("id").alias("own"))
    state, state_path = written_at(_sorted(blocks.unionByName(words, allowMissingColumns=True)).mapInArrow(_states(buckets, listed), STATE), "state")
    forget(spark)
    asked = state.where("asked").select("bucket", "unit", "id")
    state = state.where("NOT asked").drop("asked")
    best = best_path = None
    for sweep in range(sweeps + 1):
        sent = spark.sparkContext.broadcast(known)
        answers = _sorted(asked.unionByName(classes.withColumn("unit", F.lit(-1)), allowMissingColumns=True)).mapInArrow(_answers, ANSWERS)
        # The table has what follows a word; what precedes it is needed to move on only.
        profiles = _sorted(state.unionByName(answers, allowMissingColumns=True)).mapInArrow(_profiles(sent, k, 2 if sweep < sweeps else 1), PROFILES)
        profiles, profiles_path = written_at(profiles, "profiles")
        # One sum per pair of classes, and per wide word and class beside it.
        cells = profiles.mapInArrow(_table(k), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        cell, n = cells.column("cell").to_numpy(), cells.column("n").to_numpy()
        table = np.zeros(k * k, dtype=np.int64)
        table[cell[cell >= 0]] = n[cell >= 0]
        table = table.reshape(k, k)
        if best is not None and information(table) <= information(best[2]):
            forget(spark, profiles_path, path)
            break
        former, best_path, best = best_path, path, (classes, known, table)
        if sweep < sweeps:
            classes, path = written_at(profiles.where("NOT wide").mapInArrow(_moved(table), "bucket int, id binary, class binary"), "classes")
            known = known.copy()
            near = classes.mapInArrow(_unpacked_classes(True), "id long, class long").toArrow()
            known[near.column("id").to_numpy() + 1] = near.column("class").to_numpy()
            # Wide words, in order.
            order = np.argsort(-1 - cell[cell < 0])
            wide, times = (-1 - cell[cell < 0])[order], n[cell < 0][order]
            words = _distinct(wide // (2 * k))
            offsets = np.append(np.searchsorted(wide // (2 * k), words), len(wide))
            known[words] = best_classes(known[words].astype(np.int64), offsets, wide % (2 * k), times, table)
        # No later sweep reads them.
        forget(spark, profiles_path, former)
    forget(spark, state_path)
    classes, known, table = best
    rows = classes.mapInArrow(_unpacked_classes(False), "id long, class long").where(F.col("id") >= WIDE)
    few = spark.createDataFrame([(i - 1, int(known[i])) for i in range(min(WIDE, listed) + 1)], "id long, class long")
    return rows.unionByName(few), table


@dataclass
class Model:
    """Classes of the listed words and of units, logarithms of the transitions and, per class, what a word's count is divided by."""

    listed: np.ndarray
    of: np.ndarray
    transitions: np.ndarray
    emission: np.ndarray
    tokens: int
    types: int
    ends: int

    def base(self, counts):
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.types + 1)))


def _wanted(table: Frequent, words: list[bytes], buckets: int):
    """Indices and units of the words; numbers of those outside the list, where their answers stand, and the requests."""
    at, unit = table.look_up(words)
    number = table.numbers(words, at)
    asked = _distinct(number[at < 0])
    place, requests = _requests(asked, buckets)
    return at, unit, place[np.searchsorted(asked, number[at < 0])], requests


def _asked(frequent, buckets: int):
    """The words outside the list of each slice of texts, by bucket, and counts of neighbouring units."""

    def run(batches):
        table, total = Frequent(*frequent.value), np.zeros(UNITS * UNITS, dtype=np.int64)
        names = ["bucket", "unit", "id", "cell", "n"]
        for row in _rows(batches):
            offsets, codes = _trained(row)
            _, unit, _, requests = _wanted(table, row["words"].split(), buckets)
            after, _ = _with_ends(offsets, unit[codes], END)
            total += np.bincount(np.concatenate([[END], after[:-1]])[: len(after)] * UNITS + after, minlength=UNITS * UNITS)
            if requests:
                k = len(requests)
                arrays = [pa.array([q for q, _ in requests], pa.int32()), pa.array([row["unit"]] * k, pa.int64()), pa.array([x.tobytes() for _, x in requests], pa.binary())]
                yield pa.record_batch([*arrays, pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], names=names)
        seen = np.flatnonzero(total)
        empty = [pa.nulls(len(seen), t) for t in (pa.int32(), pa.int64(), pa.binary())]
        yield pa.record_batch([*empty, pa.array(seen), pa.array(total[seen])], names=names)

    return run


def _said(batches):
    """Counts and classes of the words that each bucket was asked for; 0 and -1 for words never trained on."""
    for bucket, rows in _by_bucket(batches):
        own = [r for r in rows if r["unit"] is None]
        ids, n, classes = _joined(r["id"] for r in own), _joined(r["n"] for r in own), _joined((r["class"] for r in own), np.int16)
        order = np.argsort(ids)
        ids, n, classes = ids[order], np.append(n[order], 0), np.append(classes[order], np.int16(-1))
        known = np.append(ids, END_ID)
        for r in rows:
            if r["unit"] is not None:
                asked = np.frombuffer(r["id"], np.int64)
                at = np.searchsorted(ids, asked)
                at[known[at] != asked] = len(ids)
                arrays = [pa.array([x.tobytes()], pa.binary()) for x in (n[at], classes[at])]
                yield pa.record_batch([pa.array([r["unit"]], pa.int64()), pa.array([bucket], pa.int32()), *arrays], names=["unit", "bucket", "n", "class"])


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scored(frequent, model, buckets: int):
    """One row per document, from slices of texts and the answers for their words, sorted by unit."""

    def run(batches):
        table, m = Frequent(*frequent.value), model.value
        for _, rows in groupby(_rows(batches), key=lambda row: row["unit"]):
            rows = list(rows)
            row = next(r for r in rows if r["words"] is not None)
            answers = sorted((r for r in rows if r["words"] is None), key=lambda r: r["bucket"])
            (offsets, codes), words = _texts(row), row["words"].split()
            at, unit, place, _ = _wanted(table, words, buckets)
            listed = at >= 0
            counts, of = np.zeros(len(words), np.int64), m.of[unit].astype(np.int64)
            counts[listed], of[listed] = table.counts[at[listed]], m.listed[at[listed]]
            counts[~listed] = _joined(r["n"] for r in answers)[place]
            classes = _joined((r["class"] for r in answers), np.int16)[place]
            # Words never trained on have the class of their ending.
            of[~listed] = np.where(classes < 0, of[~listed], classes)
            emitted, base = np.log10((counts + ADD_WORD) / m.emission[of]), m.base(counts)
            ids, n = row["ids"], len(row["ids"])
            after, ends = _with_ends(offsets, of[codes], m.of[END])
            steps = m.transitions[np.concatenate([[m.of[END]], after[:-1]])[: len(after)], after]
            firsts = np.concatenate([[0], ends[:-1] + 1])[:n]
            owner = np.repeat(np.arange(n), np.diff(offsets))
            total = lambda v: np.bincount(owner, weights=v[codes], minlength=n) if len(codes) else np.zeros(n)  # noqa: E731, B023
            score = np.add.reduceat(steps, firsts) + total(emitted)
            known = total((counts > 0).astype(np.float64)).astype(np.int64) + (m.ends > 0)
            arrays = [pa.array(ids, pa.int64()), pa.array([not learns(d) for d in ids], pa.bool_()), *map(pa.array, (np.diff(offsets) + 1, known, np.full(n, m.tokens), total(base) + m.base(m.ends), score))]
            yield pa.record_batch(arrays, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def listed_from(vocabulary: DataFrame, most: int) -> int:
    """The count from which on there are at most ``most`` words, found from a histogram of bounded size."""
    step = F.floor(F.log2("n") * 16).cast("int").alias("step")
    steps = vocabulary.groupBy(step).agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("words")).collect()
    total, least = 0, 1 << 62
    for row in sorted(steps, key=lambda r: -r["step"]):
        total += row["words"]
        if total > most:
            break
        least = row["least"]
    return least


def scores(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent_words: int = FREQUENT) -> DataFrame:
    """One row per row of ``documents``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are words, A-Z lower-cased, then one end. Rows whose crc32(id as text) leaves 1 modulo 5 are held
    out. base_score adds log10((c + 0.5) / (N + 0.5 * (V + 1))) over the tokens; score is the class model's
    log10 probability of the text, 10 ** (-score / n_tokens) its perplexity. Null text is empty and has its
    end only; a null id is a training row. Rows that share an id are rows of their own. Without training rows
    every count is 0. An empty table gives an empty result; other columns are not looked at.
    """
    source = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return settled(documents.sparkSession, "scores", lambda: _scores(source, frequent_words))


def _scores(source: DataFrame, frequent_words: int) -> DataFrame:
    spark = source.sparkSession
    coded = written(source.mapInArrow(_coded, CODED), "coded")
    vocabulary, path = written_at(coded.mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    trained = F.col("doc_id").isNull() | (F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != HELD_OUT)
    ends = source.where(trained).count()
    words, types = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    least = listed_from(vocabulary, frequent_words)
    # A list of frequent_words entries at most, all tasks together.
    top = sorted(vocabulary.where(F.col("n") >= least).collect(), key=lambda r: (-r["n"], bytes(r["word"])))
    listed = [bytes(r["word"]) for r in top]
    units = np.array([i if i < OWN else ending(w) for i, w in enumerate(listed)], dtype=np.int64)
    frequent = spark.sparkContext.broadcast(({w: i for i, w in enumerate(listed)}, np.array([r["n"] for r in top], dtype=np.int64), units))
    buckets = buckets_for(spark, int(words))
    asked = written(coded.mapInArrow(_asked(frequent, buckets), "bucket int, unit long, id binary, cell long, n long"), "asked")
    # UNITS * UNITS sums at most.
    summed = asked.where("bucket IS NULL").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells = np.zeros(UNITS * UNITS, dtype=np.int64)
    cells[summed.column("cell").to_numpy()] = summed.column("n").to_numpy()
    classes = classes_for(int(types))
    of = exchange(cells.reshape(UNITS, UNITS), classes)
    k = classes + 1
    numbered = written(vocabulary.mapInArrow(_numbered(frequent), "id long, n long, unit long"), "numbered")
    # Nothing reads it any more, nor what was shuffled to count it.
    forget(spark, path)
    start = F.element_at(F.array(*[F.lit(int(c)) for c in of]), (F.col("unit") + 1).cast("int")).cast("long")
    the_end = spark.createDataFrame([(END_ID, classes)], "id long, class long")
    pairs = coded.mapInArrow(_pairs(frequent, buckets), BLOCKS)
    classed, steps = exchange_words(pairs, numbered.select("id", start.alias("class")).unionByName(the_end), k, buckets=buckets)
    transitions = np.log10((steps + ADD_TRANSITION) / (steps.sum(axis=1, keepdims=True) + ADD_TRANSITION * k))
    # Every training token follows one, so a class has as many as its column.
    emission = steps.sum(axis=0) + ADD_WORD
    for cls, different in classed.where(F.col("id") != END_ID).groupBy("class").count().collect():
        emission[cls] += ADD_WORD * different
    mine = np.zeros(len(listed), dtype=np.int64)
    for i, cls in classed.where((F.col("id") >= 0) & (F.col("id") < TAIL)).collect():
        mine[i] = cls
    model = spark.sparkContext.broadcast(Model(mine, of, transitions, emission, int(words) + ends, int(types) + (ends > 0), ends))
    tail = numbered.where(F.col("id") >= TAIL).select("id", "n").join(classed, "id")
    told = asked.where("bucket IS NOT NULL").select("bucket", "unit", "id").unionByName(packed(tail, buckets, id=np.int64, n=np.int64, **{"class": np.int16}), allowMissingColumns=True)
    said = _sorted(told).mapInArrow(_said, "unit long, bucket int, n binary, class binary")
    parts = coded.unionByName(said, allowMissingColumns=True).repartition("unit").sortWithinPartitions("unit")
    return parts.mapInArrow(_scored(frequent, model, buckets), SCORED)
