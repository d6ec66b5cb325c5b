"""Public tokenizers, loaded once per worker process."""

from __future__ import annotations

import base64
from functools import lru_cache

import public_tokenizers


@lru_cache(maxsize=4)
def ranks(name: str) -> dict[bytes, int]:
    """The ranks of a .tiktoken vocabulary file."""
    with open(public_tokenizers.path(name), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def tiktoken_encoding(name: str):
    import tiktoken
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(name), special_tokens={})


@lru_cache(maxsize=4)
def encoding_of(name: str):
    """tiktoken's encoding of a byte-level tokenizers file: the ranks beside it, and the file's added tokens."""
    import json

    import tiktoken
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        added = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
    own = {token: rank for token, rank in ranks(name.removesuffix(".json") + ".tiktoken").items() if rank not in added.values()}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=own, special_tokens=added)


@lru_cache(maxsize=4)
def hf_tokenizer(name: str):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(name))
