"""Token ids of vocabularies whose words end in ``</w>``: lower case, white space left out.

The vocabulary's own rules are those of its file: compose, lower, then stretches of
letters, single numbers, stretches of other characters, and the short English endings after
an apostrophe; within each of them pairs merge by rank. Texts of Latin and Cyrillic
characters are cut by array operations and merged by a rank table; any other text goes
through the tokenizers library, with the same ids.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np

_SPACE, _LETTER, _NUMBER, _OTHER, _ALIEN = range(5)
_ENDINGS = {"s": 1, "t": 1, "m": 1, "d": 1, "re": 2, "ve": 2, "ll": 2}  # fixed values of the vocabulary
_UP_TO = 0x530


def _kinds() -> np.ndarray:
    """Kind of every code point below ``_UP_TO``; marks, controls that could be taken for ours, and Greek (final sigma) are alien."""
    kinds = np.full(_UP_TO, _ALIEN, np.uint8)
    for i in [*range(1, 0x300), *range(0x400, 0x482), *range(0x48A, _UP_TO)]:
        category = unicodedata.category(chr(i))
        if chr(i) in "\t\n\x0b\x0c\r \x85\xa0":
            kinds[i] = _SPACE
        elif category != "Cn":
            kinds[i] = _LETTER if category[0] == "L" else _NUMBER if category[0] == "N" else _OTHER
    return kinds


_KIND = _kinds()


def pieces_marked(text: str) -> str | None:
    """The lower-cased text without white space, with U+0000 behind every piece; None where a character isn't covered."""
    if text.isascii():
        codec, width, kinds = "ascii", np.uint8, _KIND[:128]
    else:
        codec, width, kinds = "utf-16-le", np.uint16, _KIND
    points = np.frombuffer(text.lower().encode(codec, "surrogatepass"), width)
    if not len(points):
        return ""
    if points.max() >= len(kinds):
        return None
    kind = kinds.take(points)
    if kind.max() == _ALIEN:
        return None
    ends = np.ones(len(kind), bool)
    ends[:-1] = (kind[1:] != kind[:-1]) | (kind[:-1] == _NUMBER)
    ends &= kind != _SPACE
    quotes = np.flatnonzero(points == 39)
    for at in quotes[(quotes == 0) | (kind[quotes - 1] != _OTHER)].tolist() if len(quotes) else ():
        after = points[at + 1 : at + 3].tolist()
        size = max((_ENDINGS.get("".join(map(chr, after[:n])), 0) for n in (1, 2)), default=0)
        if size:
            ends[at], ends[at + size] = False, True
    times = (kind != _SPACE).view(np.uint8) + ends
    out = np.repeat(points, times)
    out[np.cumsum(times, dtype=np.int32)[ends] - 1] = 0
    return out.tobytes().decode(codec)


@lru_cache(maxsize=2)
def word_encoder(path: str, most: int = 1 << 18) -> Callable[[str], bytes]:
    """Text -> little-endian unsigned 32-bit ids of the vocabulary file at ``path``.

    No rule looks across an ASCII white space: it composes with no other character and no
    piece holds one. So a long text is cut at one every ``most`` characters or so. Special
    tokens' strings give their ids, as the vocabulary file says.
    """
    import tiktoken
    from tokenizers import Tokenizer

    from .packing import byte_letters

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters, suffix = byte_letters(), spec["model"]["end_of_word_suffix"]
    special = [t["content"] for t in spec["added_tokens"]]
    ranks = {}
    for word, rank in spec["model"]["vocab"].items():
        if word not in special:
            stem = word.removesuffix(suffix)
            ranks[bytes(letters[c] for c in stem) + (b"\0" if stem != word else b"")] = rank
    merges = tiktoken.Encoding("words", pat_str="[^\\x00]+\\x00", mergeable_ranks=ranks, special_tokens={})
    library, space = Tokenizer.from_file(path), re.compile("[ \t-\r]")
    odd = re.compile("[^\x01-˿Ѐ-ԯ]").search

    def part(text: str) -> bytes:
        marked = None if (not text.isascii() and odd(text)) or any(s in text for s in special) else pieces_marked(text)
        ids = library.encode(text, add_special_tokens=False).ids if marked is None else merges.encode_ordinary(marked)
        return np.asarray(ids, "<u4").tobytes()

    def encode(text: str) -> bytes:
        if len(text) <= most:
            return part(text)
        out, at = [], 0
        while at < len(text):
            cut = space.search(text, at + most)
            end = cut.end() if cut else len(text)
            out.append(part(text[at:end]))
            at = end
        return b"".join(out)

    return encode
