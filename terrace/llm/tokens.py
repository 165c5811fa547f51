"""Token ids of the public byte-level vocabulary, on the executors."""

from __future__ import annotations

import base64
import json
import os


def ranks_path() -> str:
    """The default vocabulary, as ranks: the same ids as ``byte_bpe_50k.json``, five times as fast to apply."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens(path: str) -> dict[str, int]:
    """The tokens that the vocabulary has beside its ranks: those that the ``.json`` of the same name lists, if there is one."""
    described = os.path.splitext(path)[0] + ".json"
    if not os.path.exists(described):
        return {}
    with open(described, encoding="utf-8") as file:
        found = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in found):
        raise ValueError(f"{described} has added tokens that are not plain strings")
    return {t["content"]: t["id"] for t in found}


def encoder(path: str):
    """Text to token ids by a file of ranks; loaded once per worker process.

    As in the library that the vocabulary is from, a text is cut at the added tokens, each of which is one id, and
    what lies between is encoded by the ranks.
    """
    import sys

    kept = sys.__dict__.setdefault("_encoders", {})  # outlives the function, which workers unpickle per task
    if path not in kept:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        added = added_tokens(path)
        encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)

        def encode(text: str) -> list[int]:
            # The search for added tokens costs more than telling that a text has none.
            return encoding.encode(text, allowed_special="all") if any(t in text for t in added) else encoding.encode_ordinary(text)

        kept[path] = encode
    return kept[path]
