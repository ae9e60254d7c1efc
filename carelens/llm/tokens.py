"""Token ids of whole texts, made inside Python workers by public tokenizers.

``TextEncoder`` gives exactly the ids that ``Tokenizer.encode(text,
add_special_tokens=False)`` gives.  For the tokenizers whose words never reach
across white space (a word-end vocabulary that drops white space) it encodes
each distinct word once and keeps the most common ones: natural text repeats
its words, and encoding is the dear part.  Other tokenizers encode whole texts.
"""

from __future__ import annotations

import json
import re
import struct

_BLANK = re.compile("[ \t\n\x0b\x0c\r]+")
# Characters that str.split() takes for blanks and the tokenizer does not.
_ODD_BLANK = re.compile("[\x1c-\x1f]")
# A word of plain Latin letters, closed by plain punctuation: two tokens' worth
# of pre-tokenizing whose result is known.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:|]*)")


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others for the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in own}
    for b in range(256):
        table.setdefault(b, chr(256 + len(table) - len(own)))
    return table


class TextEncoder:
    """``keep``: how many distinct words, and how many distinct lower-case pieces
    of words, are remembered (about 200 bytes each)."""

    def __init__(self, path: str, keep: int = 500_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keep = keep
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.by_word = _drops_blanks(json.loads(self.tokenizer.to_str()))
        self._letters = _byte_letters()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not self.by_word:
            return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        parts = _BLANK.split(text) if _ODD_BLANK.search(text) else text.split()
        found = list(map(self.known.get, parts))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = self._word(parts[i])
        return b"".join(found)

    def _word(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            plain = _PLAIN.fullmatch(word)
            if plain:
                ids = self._merge(plain[1].lower()) + (self._merge(plain[2]) if plain[2] else b"")
            else:
                ids = _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
            if len(self.known) < self.keep:
                self.known[word] = ids
        return ids

    def _merge(self, piece: str) -> bytes:
        """One pre-token through the tokenizer's own BPE model."""
        ids = self.pieces.get(piece)
        if ids is None:
            letters = piece.encode().decode("latin-1").translate(self._letters)
            ids = _packed([t.id for t in self.tokenizer.model.tokenize(letters)])
            if len(self.pieces) < self.keep:
                self.pieces[piece] = ids
        return ids


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _drops_blanks(spec: dict) -> bool:
    """Whether words are encoded apart: blanks are collapsed, text lower-cased
    and composed, and only runs of letters, single digits and runs of other
    signs are kept, as byte-level BPE with a word end."""
    normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        normal == ["NFC", "Replace", "Lowercase"]
        and [p["type"] for p in pre] == ["Split", "ByteLevel"]
        and pre[0]["behavior"] == "Removed" and pre[0]["invert"]
        and pre[0]["pattern"] == {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}
        and not pre[1]["add_prefix_space"]
        and spec["model"]["type"] == "BPE" and bool(spec["model"].get("end_of_word_suffix")))
