"""Token ids by the tokenizers library, for whole texts, with repeated words looked up."""

from __future__ import annotations

import json
import os
import struct
import unicodedata
from functools import lru_cache

import regex

from assayer.llm.bpe import byte_symbols

#: Words, and pieces, that a worker remembers in each of two generations: a bound on memory, not on the input.
REMEMBERED_WORDS, REMEMBERED_PIECES = 450_000, 300_000
#: Words of these characters only are split here; all versions of Unicode in use class them alike. Other words are
#: left to the library as a whole.
PLAIN = regex.compile(r"[\x21-\x7e¡-įı-ɏ]*")

#: Marks that follow words and never join their pieces.
MARKS = frozenset(".,;:!?")


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


#: Of few ids, which most pieces have.
PACK = tuple(struct.Struct(f"<{n}I").pack for n in range(16))


class _Remembered(dict):
    """A dictionary that works out what is missing. When full it ages; of the aged, only what is asked for stays."""

    def __init__(self, work_out, most: int):
        super().__init__()
        self.work_out, self.most, self.aged = work_out, most, {}

    def __missing__(self, key: str) -> bytes:
        found = self.aged.get(key)
        if found is None:
            found = self.work_out(key)
        if len(self) >= self.most:
            self.aged = dict(self)
            self.clear()
        self[key] = found
        return found


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, without special tokens being added.

    Where a tokenizer composes, lower-cases and drops white space, the ids of a text are those of its parts between
    blanks, one after another. Then only words not seen before go to the library: plain ones piece by piece to its
    model, after the lower-casing and splitting that the file asks for, others to the whole tokenizer. Tokenizers of
    other kinds get every text whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        with open(path, encoding="utf-8") as file:
            self.split = _lower_case_split(json.load(file))
        added = [regex.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(added) or r"(?!)")
        self.symbols = byte_symbols()
        self.words, self.pieces = _Remembered(self._word, REMEMBERED_WORDS), _Remembered(self._piece, REMEMBERED_PIECES)

    def _whole(self, text: str) -> bytes:
        return packed(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def _piece(self, piece: str) -> bytes:
        """The ids of one pre-token, by the library's model."""
        shown = piece if piece.isascii() else "".join([self.symbols[b] for b in piece.encode()])
        tokens = self.model.tokenize(shown)
        return PACK[len(tokens)](*[t.id for t in tokens]) if len(tokens) < len(PACK) else packed([t.id for t in tokens])

    def _word(self, word: str) -> bytes:
        if not word:
            return b""
        if word.isascii():
            # Letters, or letters and one mark at the end, are one piece and two.
            if word.isalpha():
                return self.pieces[word.lower()]
            if word[-1] in MARKS and word[:-1].isalpha():
                return self.pieces[word[:-1].lower()] + self.pieces[word[-1]]
        if not PLAIN.fullmatch(word) or not word.isalnum() and self.special.search(word):
            return self._whole(word)
        lower = (word if word.isascii() else unicodedata.normalize("NFC", word)).lower()
        return b"".join(map(self.pieces.__getitem__, self.split.findall(lower)))

    def encode(self, text: str) -> bytes:
        """The ids of a text, as bytes."""
        if self.split is None:
            return self._whole(text)
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


def _lower_case_split(spec: dict) -> regex.Pattern | None:
    """The split pattern of a tokenizer file that composes, lower-cases and drops white space; else None."""
    try:
        steps = spec["normalizer"]["normalizers"]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        lowers = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": r"\s+"}
        drops = split["behavior"] == "Removed" and split["invert"] and not level["add_prefix_space"] and not level["use_regex"]
        return regex.compile(split["pattern"]["Regex"]) if lowers and drops and level["type"] == "ByteLevel" else None
    except (KeyError, TypeError, ValueError):
        return None


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)
