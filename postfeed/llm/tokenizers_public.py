"""Encoders of the installed vocabularies, built once per task from a path that is a parameter."""

from __future__ import annotations

import base64
import json


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def load_added(path: str) -> dict[str, int]:
    """The added tokens of a JSON file, which stand for themselves wherever a text has them."""
    with open(path, encoding="utf-8") as file:
        return {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}


def rank_encoding(path: str, pattern: str, added: dict[str, int] | None = None):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens=added or {})


def rank_encoder(name: str = "byte_bpe_50k.tiktoken", prepare=None, added: str | None = None):
    """A factory of text -> ids by a rank file. ``prepare`` changes texts first; the added tokens of the JSON file
    ``added`` are found in texts, without it they are ordinary text."""

    def build():
        import public_tokenizers as public

        encoding = rank_encoding(public.path(name), public.PATTERN, load_added(public.path(added)) if added else None)
        return lambda text: encoding.encode_to_numpy(prepare(text) if prepare else text, allowed_special="all", disallowed_special=())

    return build
