"""Token ids of whole texts, by the tokenizers library, remembered per word.

Both vocabularies used here cut a text into pieces that do not depend on what stands beyond the
white space around them, so the ids of a text are those of its words in a row. A text is cut at
single blanks only; a run of blanks or line breaks stays with what is around it and goes through
the whole tokenizer. Each distinct word is encoded once per worker and kept in tables whose bytes
are bounded, all of a worker's together; words of letters go to the library's BPE model directly,
whatever else through the whole tokenizer. A tokenizer of another make is used on whole texts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Bytes of words and ids that a worker remembers, in all its tables together. Each encoder has
# two: when the newer ones are half of it, they take the place of the older, which are dropped.
REMEMBERED = 96 << 20
# Longest word that is remembered.
LONGEST = 200
# Letters whose lower case and composed form depend on nothing but themselves.
_LATIN = re.compile("[A-Za-zªµºÀ-ÖØ-öø-į]+")
# Bytes of text that are encoded at a time.
CHUNK = 4 << 20
_DOUBLE = re.compile(r"\s\s|\A\s|\s\Z")
# The same for Arrow, whose \s is ASCII, and the mark put before a text's first word.
_MARK = "\x01"
# Put before a full stop or comma behind a word, so that it is told apart from the word, and
# texts in which one has another sign beside it, which is left together.
_STOP = "\x02"
_SIGNS = r"(?:\A|[^\p{L}\p{N}])[.,]|[.,][^\s\p{L}\p{N}]"
_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ODD = rf"[\x01\x02]|{_BLANK}{_BLANK}|\A{_BLANK}|{_BLANK}\z"
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable characters stand for themselves, other bytes for 256 and up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


def _unstable() -> str:
    """Letters whose composed lower case is not letters alone: punctuation behind them joins their marks.

    Found by the rule over the planes that hold letters with a canonical decomposition.
    """
    found = []
    for code in (*range(0x80, 0xD800), *range(0xE000, 0x10000), *range(0x1D000, 0x1D400), *range(0x11000, 0x12000)):
        c = chr(code)
        if c.isalpha() and not unicodedata.normalize("NFC", c).lower().isalpha():
            found.append(c)
    return "".join(found)


_UNSTABLE_LETTERS = _unstable()
_UNSTABLE = re.compile(f"[{_UNSTABLE_LETTERS}]")


def joined(lines: pa.Array, ids_of: Callable[[np.ndarray], list[bytes]], dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts cut at every blank, and where each text's end; ``ids_of`` gives those of distinct words."""
    words = pc.split_pattern(lines, " ")
    found = words.flatten().dictionary_encode()
    ids = ids_of(found.dictionary.to_numpy(zero_copy_only=False))
    lens = np.fromiter(map(len, ids), np.int32, len(ids)) // dtype.itemsize
    flat = np.frombuffer(b"".join(ids), dtype)
    index = found.indices.to_numpy()
    counts = lens[index]
    ends = np.cumsum(counts)
    first = (np.cumsum(lens) - lens)[index] - (ends - counts)
    place = np.repeat(first.astype(np.int32 if ends.size and ends[-1] < 1 << 31 else np.int64), counts)
    place += np.arange(len(place), dtype=place.dtype)
    return flat[place], np.concatenate(([0], ends))[words.offsets.to_numpy()[1:] - words.offsets[0].as_py()]


class Encoder(dict):
    """``encode(text)`` gives the ids as bytes, ``width`` little-endian bytes each.

    ``lead`` is put before each word looked up. Without ``specials``, the strings of special tokens
    are plain text.
    """

    def __init__(self, path: str, specials: bool = True) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.older: dict[str, bytes] = {}
        self.lead = ""
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not specials
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.width = 2 if self.tokenizer.get_vocab_size(True) <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.letters = _byte_letters()
        pre, norm = made["pre_tokenizer"] or {}, made["normalizer"]
        steps = [s["type"] for s in (norm or {}).get("normalizers", [])]
        simple_tokens = not any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in made["added_tokens"])
        self.kind = "text"
        if simple_tokens and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] \
                and norm is None:
            self.kind = "spaced"
        elif simple_tokens and steps == ["NFC", "Replace", "Lowercase"] and made["model"]["end_of_word_suffix"] \
                and [p["type"] for p in pre.get("pretokenizers", [])] == ["Split", "ByteLevel"]:
            self.kind = "words"
        # Words behind a space, without it.
        self.plain = self.spaced = self
        Encoder.made.append(self)
        if self.kind == "spaced":
            self.spaced = self._behind_space()

    # The encoders of this worker, and the bytes in their newer tables.
    made: list[Encoder] = []
    held = 0

    def _behind_space(self) -> Encoder:
        """The table of words behind a space, with the same tokenizer: a vocabulary is held once."""
        other = Encoder.__new__(Encoder)
        other.__dict__.update(self.__dict__, older={}, lead=" ", plain=self, spaced=other)
        Encoder.made.append(other)
        return other

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.kind == "words":
            return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))
        if self.kind == "spaced" and _MARK not in text and _STOP not in text:
            first, rest = self.__getitem__, self.spaced.__getitem__
            lines = [_BETWEEN.split(text)] if _DOUBLE.search(text) else [x.split(" ") for x in text.split("\n")]
            return first("\n").join([first(w[0]) + b"".join(map(rest, w[1:])) for w in lines])
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    @staticmethod
    def _apart(lines: pa.Array, mark: str) -> pa.Array:
        """A blank before stops and commas, where that leaves the words as they are."""
        apart = pc.replace_substring(pc.replace_substring(lines, ".", f" {mark}."), ",", f" {mark},")
        return pc.if_else(pc.match_substring_regex(lines, _SIGNS), lines, apart)

    def encode_many(self, texts: pa.Array, spaced: bool = False, chunk: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of consecutive texts and where each text's end, a chunk of texts at a time.

        Words are told apart by Arrow, so that only the distinct words of a chunk are looked up.
        With ``spaced``, each text is encoded with a blank before it.
        """
        texts = texts.fill_null("")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            done = sizes[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(sizes, done + chunk, side="right")))
            yield self._chunk(texts.slice(at, stop - at), spaced)
            at = stop

    def _chunk(self, texts: pa.Array, spaced: bool = False) -> tuple[np.ndarray, np.ndarray]:
        odd = np.zeros(len(texts), bool)
        if self.kind == "words":
            odd = pc.match_substring_regex(texts, f"[{_UNSTABLE_LETTERS}]").to_numpy(zero_copy_only=False)
            kept = pc.if_else(pa.array(odd), "", texts)
            lines = self._apart(pc.replace_substring(kept, "\n", " "), "")
        elif self.kind == "spaced":
            odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
            odd |= pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            kept = pc.if_else(pa.array(odd), "", texts)
            lines = kept if spaced else pc.binary_join_element_wise(pa.scalar(_MARK), kept, "")
            lines = self._apart(lines, _STOP)
        else:
            odd[:] = True
            lines = pc.if_else(pa.array(odd), "", texts)
        out, stops = joined(lines, lambda words: list(map(self.spaced.__getitem__, words)), self.dtype)
        if odd.any():
            parts = np.split(out, stops[:-1])
            for i in np.flatnonzero(odd).tolist():
                parts[i] = np.frombuffer(self.encode(" " * spaced + texts[i].as_py()), self.dtype)
            out, stops = np.concatenate(parts), np.cumsum([len(p) for p in parts])
        return out, stops

    def _pack(self, ids: list[int]) -> bytes:
        packed = array("H" if self.width == 2 else "I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None and self.lead:
            if word[:1] == _MARK:
                return self._lines(self.plain, word[1:])
            if word[:1] == _STOP and word != _STOP:
                return self._lines(self.plain, word[1:])
            if "\n" in word and not _DOUBLE.search(word):
                return self._lines(self, word)
        if ids is None:
            core = word.rstrip(punctuation)
            if len(core) < len(word) and core.isalpha() and not _UNSTABLE.search(core):
                ids = self[core] + self.plain[word[len(core):]]
            else:
                ids = self._pack(self._ids(self.lead + word))
        if len(word) <= LONGEST:
            self._remember(word, ids)
        return ids

    def _remember(self, word: str, ids: bytes) -> None:
        if Encoder.held > REMEMBERED // 2:
            for each in Encoder.made:
                each.older = dict(each)
                each.clear()
            Encoder.held = 0
        self[word] = ids
        Encoder.held += 2 * len(word) + len(ids) + 190

    def _lines(self, table: Encoder, word: str) -> bytes:
        """A first word from ``table``, and those behind line breaks, each between two other signs."""
        first, *rest = word.split("\n")
        return self.plain["\n"].join([table[first], *map(self.plain.__getitem__, rest)])

    def _ids(self, word: str) -> list[int]:
        body = word[1:] if word[:1] == " " else word
        if self.kind == "words":
            plain = _LATIN.fullmatch(word)
            body = word.lower()
        else:
            plain = self.kind == "spaced" and body.isalpha()
        if not plain:
            return self.tokenizer.encode(word, add_special_tokens=False).ids if word else []
        if not body.isascii():
            body = body.encode().decode("latin-1").translate(self.letters)
        if word[:1] == " ":
            body = self.letters[32] + body
        return [t.id for t in self.model.tokenize(body)]


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, specials: bool = True) -> Encoder:
    """The worker's encoder of a vocabulary file; it outlives the task."""
    if (path, specials) not in _ENCODERS:
        _ENCODERS[path, specials] = Encoder(path, specials=specials)
    return _ENCODERS[path, specials]
