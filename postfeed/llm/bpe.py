"""Byte-level BPE encoding and decoding by prefix dynamic programming.

The encoding of a byte string is a chain of tokens whose neighbours are all compatible: the
merges, run on the bytes of two neighbours alone, give back these two tokens. Exactly one token can
end each prefix of the string. The table of these last tokens gives the encoding of every
prefix, so appended bytes only add entries, and an edit changes entries from its place on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postfeed.llm.common import slices
from postfeed.llm.tokenizers_public import load_ranks

# Matches and token pairs that a task remembers; beyond that it starts anew. Results do not depend on it.
REMEMBERED = 500_000

# Bytes up to which every part of a match is looked up, without asking first whether a token ends so.
SHORT = 12


class PrefixEncoder:
    """Encodes single pattern matches of a text by the ranks of their byte pairs."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.split = regex.compile(pattern)
        self.tokens = dict(zip(ranks.values(), ranks))
        # Every longer part of a token that ends it, to stop early in long matches.
        self.tails = {token[n:] for token in ranks for n in range(len(token) - SHORT)}
        self._fits: dict[tuple[bytes, bytes], bool] = {}
        self._edges: dict[tuple[bytes, int], list[tuple[bytes, int]]] = {}
        self._words: dict[str, list[int]] = {}

    def merged(self, data: bytes, stop: int = 1) -> list[bytes]:
        """The merges run step by step, the lowest rank first, then the leftmost, down to ``stop`` parts."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > stop:
            rank, i = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """What stands at one end of a token while it is merged from bytes (side 0: its start, 1: its end).

        Each entry has the rank at which a longer part takes its place; nothing replaces the token itself.
        """
        known = self._edges.get((token, side))
        if known is None:
            if len(token) == 1:
                known = [(token, 1 << 60)]
            else:
                inner = self.merged(token, 2)[-side]
                grown = self.ranks[token]
                known = [*self.edge(inner, side)[:-1], (inner, grown), (token, 1 << 60)]
            self._edges[token, side] = known
        return known

    def fits(self, left: bytes, right: bytes) -> bool:
        """Whether the merges of both tokens' bytes together end in these two tokens.

        They do unless at some time the part that ends the left one and the part that starts the right one
        merge before either grows. Of equal ranks the merge further to the left comes first.
        """
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) > REMEMBERED:
                self._fits.clear()
            known = True
            for a, until_a in self.edge(left, 1):
                for b, until_b in self.edge(right, 0):
                    rank = self.ranks.get(a + b)
                    if rank is not None and rank < until_a and rank <= until_b:
                        known = False
            self._fits[left, right] = known
        return known

    def extend(self, table: list[bytes], data: bytes) -> list[bytes]:
        """Completes the prefix table of ``data``; ``table`` holds the entries of its first prefixes.

        Entry i is the one token that can end the first i + 1 bytes: it is compatible with the entry of
        the prefix before it.
        """
        ranks, tails, known = self.ranks, self.tails, self._fits
        for end in range(len(table) + 1, len(data) + 1):
            first = max(0, end - SHORT)
            if first:
                while first and data[first - 1 : end] in tails:
                    first -= 1
            for start in range(first, end):
                token = data[start:end]
                if token in ranks:
                    if not start:
                        break
                    pair = (table[start - 1], token)
                    if known[pair] if pair in known else self.fits(*pair):
                        break
            table.append(token)
        return table

    def word(self, data: bytes, table: list[bytes] | None = None) -> list[int]:
        """Ids of one match. A match that is a token is this token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        table, ids, end = self.extend([] if table is None else table, data), [], len(data)
        while end:
            token = table[end - 1]
            ids.append(self.ranks[token])
            end -= len(token)
        return ids[::-1]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text. Matches not seen before are learnt in order, so each shares the prefix table of
        the one before it as far as both agree."""
        known, split = self._words, self.split.findall
        found = [split(text) for text in texts]
        if len(known) > REMEMBERED:
            known.clear()
        unseen = set().union(*found).difference(known)
        table, before = [], b""
        for data, match in sorted((match.encode("utf-8", "surrogatepass"), match) for match in unseen):
            same = 0
            for same, (a, b) in enumerate(zip(data, before)):
                if a != b:
                    break
            else:
                same = min(len(data), len(before))
            table, before = table[:same], data
            known[match] = self.word(data, table)
            before = data[: len(table)]
        out = []
        for matches in found:
            ids = []
            for match in matches:
                ids += known[match]
            out.append(ids)
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class EncodedText:
    """A text with the place and the prefix table of each match, for appends and edits."""

    def __init__(self, encoder: PrefixEncoder, text: str = ""):
        self.encoder, self.text, self.starts, self.tables = encoder, "", [], []
        self.append(text)

    def _scan(self, at: int, text: str, old: dict[int, int], shift: int) -> tuple[list, list, int | None]:
        """Matches from ``at`` on until one starts where an unchanged old one did; that old one's index."""
        starts, tables = [], []
        for match in self.encoder.split.finditer(text, at):
            k = old.get(match.start() - shift)
            if k is not None:
                return starts, tables, k
            starts.append(match.start())
            tables.append(self.encoder.extend([], match.group().encode("utf-8", "surrogatepass")))
        return starts, tables, None

    def append(self, more: str) -> None:
        """Only the last match can change, and its table keeps the entries of the bytes it had."""
        if not more:
            return
        at = self.starts[-1] if self.starts else 0
        had = self.tables[-1] if self.starts else []
        del self.starts[-1:], self.tables[-1:]
        text = self.text + more
        for match in self.encoder.split.finditer(text, at):
            data = match.group().encode("utf-8", "surrogatepass")
            self.starts.append(match.start())
            self.tables.append(self.encoder.extend(had[: len(data)], data))
            had = []
        self.text = text

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replaces characters; matches before the edit and, once they line up again, after it are kept."""
        from bisect import bisect_left

        text, shift = self.text[:start] + new + self.text[stop:], len(new) - (stop - start)
        first = max(0, bisect_left(self.starts, start) - 1)
        at = self.starts[first] if self.starts else 0
        old = {s: k for k, s in enumerate(self.starts) if s >= stop}
        starts, tables, k = self._scan(at, text, old, shift)
        tail = slice(k, None) if k is not None else slice(0, 0)
        self.starts = self.starts[:first] + starts + [s + shift for s in self.starts[tail]]
        self.tables = self.tables[:first] + tables + self.tables[tail]
        self.text = text

    def ids(self) -> list[int]:
        ends = [*self.starts[1:], len(self.text)]
        pieces = (self.text[a:b].encode("utf-8", "surrogatepass") for a, b in zip(self.starts, ends))
        return [i for data, table in zip(pieces, self.tables) for i in self.encoder.word(data, table)]


def prefix_encoder(ranks_path: str, pattern: str) -> Callable[[], PrefixEncoder]:
    """A factory that builds the encoder once per task."""
    return lambda: PrefixEncoder(load_ranks(ranks_path), pattern)


def encode_texts(df: DataFrame, encoder: Callable[[], PrefixEncoder], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of each row's whole text.

    Null text is empty and has no ids. Rows with null or repeated ids are rows like any other, an empty
    table gives an empty result, and columns besides the two are not looked at.
    """

    def run(batches):
        encode = encoder().encode_all
        for part in slices(batches):
            ids = encode([t or "" for t in part.column(1).to_pylist()])
            yield pa.record_batch([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return _narrow(df, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(df: DataFrame, encoder: Callable[[], PrefixEncoder], id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id`` and the decoded ``bytes``; null ids decode to no bytes."""

    def run(batches):
        decode = encoder().decode
        for batch in batches:
            data = [decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(data, pa.binary())], names=["doc_id", "bytes"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, bytes binary")


def encode_edits(df: DataFrame, encoder: Callable[[], PrefixEncoder], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` of texts after an edit: columns ``start``, ``stop`` (characters) and ``new``.

    A null ``start`` appends; only the matches near the edit are encoded anew.
    """

    def run(batches):
        built = encoder()
        for batch in batches:
            out = []
            for text, start, stop, new in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
                encoded = EncodedText(built, text or "")
                if start is None:
                    encoded.append(new or "")
                else:
                    encoded.edit(start, start if stop is None else stop, new or "")
                out.append(encoded.ids())
            yield pa.record_batch([batch.column(0), pa.array(out, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col("start").cast("int"), F.col("stop").cast("int"), F.col("new").cast("string"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def round_trip(df: DataFrame, encoder: Callable[[], PrefixEncoder], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text encoded and decoded: doc_id, n_tokens, ids_sha256, decoded_sha256.

    The digests are lowercase hex of the ids as little-endian unsigned 32-bit integers, and of the
    decoded bytes. Null text is empty. Ids do not leave the task, so nothing is shuffled.
    """

    def run(batches):
        built = encoder()
        for part in slices(batches):
            counts, of_ids, of_bytes = [], [], []
            for ids in built.encode_all([t or "" for t in part.column(1).to_pylist()]):
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest())
                of_bytes.append(hashlib.sha256(built.decode(ids)).hexdigest())
            yield pa.record_batch([part.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _narrow(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _narrow(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
