"""Token ids of a byte-level BPE file, as its own library gives them, at the speed of a rank table.

The merges and the split pattern of a ``tokenizers`` byte-level file fit a
rank table of ``tiktoken``, which encodes several times faster. The table is
derived from the file itself. That both agree on every character of Unicode is
tested with the installed releases. Texts whose runs of blanks are too
long for the matcher of the rank table go to ``tokenizers``, and so do all texts of a
file that does not say that it works in this way.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache

# the pattern of byte-level BPE files that name no other
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of() -> dict[str, int]:
    """Bytes by the printable characters that stand for them in the file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def by_ranks(spec: dict) -> bool:
    """Whether a file's ids follow from its ranks: no normaliser, the usual split, merges in the order of the ids."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or spec.get("post_processor") or model["type"] != "BPE" or model.get("byte_fallback"):
        return False
    if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return False
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        return False
    if any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] for x in spec["added_tokens"]):
        return False
    joined = [("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model["merges"]]
    ids = [model["vocab"].get(m, -1) for m in joined]
    special = {x["content"] for x in spec["added_tokens"]}
    letters = [v for k, v in model["vocab"].items() if len(k) == 1]
    return (
        all(x < y for x, y in zip(ids, ids[1:], strict=False))
        and (not ids or ids[0] > max(letters))
        and len(letters) == 256
        and len(ids) + 256 == sum(k not in special for k in model["vocab"])
    )


@lru_cache(maxsize=2)
def _library(path: str, special: bool = True):
    """The file's own library; loaded only if some text needs it."""
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    slow.no_truncation()
    slow.no_padding()
    slow.encode_special_tokens = not special
    return slow


@lru_cache(maxsize=4)
def encoder(path: str, special: bool = True) -> Callable[[list[str]], list[list[int]]]:
    """Texts to ids, without special tokens added; special strings inside texts become their ids, or ordinary ones if not ``special``."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)

    def by_library(text: str) -> list[int]:
        return _library(path, special).encode(text, add_special_tokens=False).ids

    if not by_ranks(spec):
        return lambda texts: [by_library(t) for t in texts]
    byte_of = _byte_of()
    names = {x["content"]: x["id"] for x in spec["added_tokens"]}
    vocabulary = {bytes(byte_of[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in names}
    fast = tiktoken.Encoding("derived", pat_str=_PATTERN, mergeable_ranks=vocabulary, special_tokens=names)
    allowed = set(names) if special else set()

    def encoded(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special=allowed, disallowed_special=())
        except ValueError:  # a run of blanks too long for its matcher
            return by_library(text)

    return lambda texts: [encoded(t) for t in texts]
