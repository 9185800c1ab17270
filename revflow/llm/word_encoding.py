"""Token ids of a lower-casing word BPE file, as its own library gives them, at the speed of a table of words.

Such a file normalises a text (NFC, lower case), splits it into words by a pattern
and encodes each word on its own. So the ids of a word never depend on its neighbours: the
library encodes a word once, and a bounded table keeps the result. Texts with characters
on which the editions of Unicode of the two matchers may differ, or with the
file's special strings, go to the library whole, and so does every text of a file that
normalises or splits in another way. That both agree on every other character is tested.

A new word is encoded by a rank table of ``tiktoken`` in which the byte 0xFF, which UTF-8 never uses,
stands for the end of a word. That table joins any two neighbours whose bytes together are a token, the file only
the two that it names. Both are the same if every token, on its own, is
encoded as itself by the file's merges: neighbours that make up a token within a word have come about
as they would have on their own. This is checked when a file is opened; other files encode new words by the library.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np

from revflow.llm.encoding import _byte_of

_LONGEST = 64  # longer ones are not kept
# blocks whose characters no edition of Unicode since 10 has changed, without the controls that only Python takes for blanks
_SETTLED = r"\x00-\x1b\x20-՗‐-⁞₠-₿←-⇿─-╿　-〾ぁ-ゖ゠-ヾ一-鿕가-힣\U0001f300-\U0001f64f"

# How the file says that it normalises and splits.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = {"behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}


def _expected(spec: dict) -> str | None:
    """The pattern of words, if the file works as described above."""
    split, level = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}])[:2]
    model = spec["model"]
    plain = (
        (spec.get("normalizer") or {}).get("normalizers") == _NORMALIZER
        and split.get("type") == "Split"
        and all(split.get(k) == v for k, v in _SPLIT.items())
        and all(level.get(k) == v for k, v in _BYTES.items())
        and model["type"] == "BPE"
        and not model.get("dropout")
        and not spec.get("post_processor")
    )
    return split["pattern"].get("Regex") if plain and array("I").itemsize == 4 and sys.byteorder == "little" else None


def _on_its_own(symbols: list[str], rank: dict[tuple[str, str], int]) -> list[str]:
    """What the merges make of the symbols of one token."""
    while len(symbols) > 1:
        best = min(range(len(symbols) - 1), key=lambda i: rank.get((symbols[i], symbols[i + 1]), len(rank)))
        if (symbols[best], symbols[best + 1]) not in rank:
            break
        symbols = [*symbols[:best], symbols[best] + symbols[best + 1], *symbols[best + 2 :]]
    return symbols


def _ranked(spec: dict, end: str) -> Callable[[str], bytes] | None:
    """A word to its ids by ranks; None for a file whose merges do not follow from the tokens they make."""
    import tiktoken

    byte_of, model = _byte_of(), spec["model"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    rank = {m: i for i, m in enumerate(merges)}
    made = ["".join(m) for m in merges]
    if end != "</w>" or len(set(made)) < len(merges) or any(len(m) != 2 or m[0] + m[1] not in model["vocab"] for m in merges):
        return None

    def letters(token: str) -> list[str]:
        last = token.endswith(end) and len(token) > len(end)
        own = list(token[: -len(end)] if last else token)
        return [*own[:-1], own[-1] + end] if last else own

    if any(set("".join(letters(t)).replace(end, "")) - byte_of.keys() or len(_on_its_own(letters(t), rank)) > 1 for t in made):
        return None

    def raw(token: str) -> bytes:
        return b"".join(bytes([byte_of[x[0]]]) + (b"\xff" if len(x) > 1 else b"") for x in letters(token))

    ranks = {bytes([b]): b for b in range(256)} | {bytes([b, 255]): 256 + b for b in range(256)}
    ranks |= {raw(t): 512 + i for i, t in enumerate(made)}
    ids = [0] * len(ranks)
    for character, b in byte_of.items():
        if character not in model["vocab"] or character + end not in model["vocab"]:
            return None
        ids[b], ids[256 + b] = model["vocab"][character], model["vocab"][character + end]
    ids[512:] = [model["vocab"][t] for t in made]
    core = getattr(tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={}), "_core_bpe", None)
    one = getattr(core, "encode_single_piece", None)
    return one and (lambda word: array("I", [ids[i] for i in one(word.encode() + b"\xff")]).tobytes())


class _Table(dict):
    """Results of a function of short strings; emptied when it is full."""

    def __init__(self, of: Callable[[str], bytes], most: int):
        super().__init__()
        self.of, self.most = of, most

    def __missing__(self, key: str) -> bytes:
        ids = self.of(key)
        if len(key) <= _LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[key] = ids
        return ids


@lru_cache(maxsize=2)
def word_encoder(path: str) -> Callable[[str], bytes]:
    """A text to its ids, little-endian unsigned 32-bit, without special tokens added; special strings inside texts become their ids."""
    from tokenizers import Tokenizer

    import regex

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()

    def whole(text: str) -> bytes:
        return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    pattern = _expected(spec)
    if pattern is None:
        return whole
    words = regex.compile(pattern).findall
    special = "|".join(regex.escape(x["content"]) for x in spec["added_tokens"])
    unsettled = regex.compile(f"[^{_SETTLED}]" + (f"|{special}" if special else "")).search
    character = {b: c for c, b in _byte_of().items()}
    model = library.model

    def by_library(word: str) -> bytes:
        # the printable characters of ASCII stand for themselves
        own = word if word.isascii() and word.isprintable() else "".join(map(character.__getitem__, word.encode()))
        return array("I", [t.id for t in model.tokenize(own)]).tobytes()

    of_word = _ranked(spec, model.end_of_word_suffix) or by_library
    known = _Table(of_word, 1 << 16)

    def of_run(run: str) -> bytes:
        # letters alone are one word, which needs no second table
        return of_word(run) if run.isalpha() else b"".join(map(known.__getitem__, words(run)))

    runs = _Table(of_run, 1 << 18)  # a run without blanks is made of whole words, and most runs return

    def encode(text: str) -> bytes:
        if not text.isascii():
            if unsettled(text):
                return whole(text)
            # every capital sigma alone, where Python looks at its neighbours
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        elif unsettled(text):
            return whole(text)
        return b"".join(map(runs.__getitem__, text.lower().split()))

    return encode
