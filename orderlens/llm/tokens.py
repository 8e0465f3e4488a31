"""Public tokenizers in tasks: same ids as encoding whole texts, with a memory of words."""

from __future__ import annotations

import os
import unicodedata
from array import array
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from orderlens.llm.text import KEPT

#: Words a worker remembers (about 200 bytes each): the latest half of them, and the half before.
REMEMBERED = 800_000
#: White space other than single blanks and line feeds inside, and what may be a special string.
_IRREGULAR = ["  ", "\n\n", " \n", "\n ", "<|", "\x00", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")]
#: Byte-level pre-tokenizers write printable bytes as the characters of that number, others from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = dict(zip((b for b in range(256) if b not in _PRINTED), map(chr, range(256, 512))))


def definition(path: str) -> str:
    """A tokenizer's file, to be sent along to the tasks (1 to 2 MB)."""
    return Path(path).read_text(encoding="utf-8")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    ``blanks`` says what the tokenizer does with a blank or line feed between two other characters:
    "dropped" (words are independent) or "leading" (a blank belongs to the next word, a line feed is a
    piece of its own). In both cases the pre-tokenizer never joins what stands on its two sides, so words
    can be encoded one by one. Texts with other white space or special strings are encoded whole.
    """

    def __init__(self, text: str, blanks: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(text)
        self.tokenize = self.tokenizer.model.tokenize
        self.blanks, self.half = blanks, remembered // 2
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def alone(self, word: str) -> bytes | None:
        """Ids of a word of letters, perhaps after a blank, straight from the model; None for others.

        The pre-tokenizers keep letters together, and map bytes to characters in the way of ``_BYTES``.
        """
        if self.blanks == "dropped":
            if not (_simple(word) and unicodedata.is_normalized("NFC", word)):
                return None
            word = word.lower()
        if not word.removeprefix(" " if self.blanks == "leading" else "").isalpha():
            return None
        mapped = word.encode().decode("latin-1").translate(_BYTES)
        return array("I", [t.id for t in self.tokenize(mapped)]).tobytes()

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def words(self, texts: list[str]) -> pa.ListArray:
        """Parts of each text that are encoded independently."""
        if self.blanks == "dropped":  # such tokenizers lower the case; equal words are then found more often
            texts = [t.lower() if t.isascii() else t for t in texts]
        column = pa.array(texts, pa.large_string())
        # A full stop or comma between a letter and white space is a piece of its own.
        column = pc.replace_substring_regex(column, r"(\pL)([.,][ \n])", "\\1\x00\\2")
        if self.blanks == "dropped":
            column = pc.replace_substring(pc.replace_substring(column, "\n", "\x00"), " ", "\x00")
            return pc.split_pattern(column, "\x00")
        column = pc.replace_substring(column, "\n", "\x00\n\x00")
        return pc.split_pattern(pc.replace_substring(column, " ", "\x00 "), "\x00")

    def lookup(self, words: list[str]) -> list[bytes]:
        """Ids of different words; new ones are encoded and remembered.

        A full memory becomes the older one, and what it has is moved up when it is asked for, so
        frequent words are never forgotten.
        """
        found = list(map(self.known.get, words))
        missing = [k for k, x in enumerate(found) if x is None]
        new = []
        for k in missing:
            found[k] = self.older.get(words[k])
            if found[k] is None:
                found[k] = self.alone(words[k]) if words[k] else b""
                if found[k] is None:
                    new.append(k)
        for k, ids in zip(new, self.whole([words[k] for k in new])):
            found[k] = ids
        self.known.update((words[k], found[k]) for k in missing)
        if len(self.known) > self.half:
            self.known, self.older = {}, self.known
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; null and empty texts have none.

        Each different word of the batch is looked up once; numpy puts the texts together again.
        """
        odd = [bool(t) and irregular(t) for t in texts]
        cut = self.words(["" if o or not t else t for t, o in zip(texts, odd)])
        coded = cut.flatten().dictionary_encode()
        ids = self.lookup(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        starts = np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy()
        n = sizes[codes]
        ends = np.cumsum(n)
        every = flat[np.repeat(starts[codes] - (ends - n), n) + np.arange(n.sum())]
        bounds = np.concatenate([[0], ends])[cut.offsets.to_numpy()].tolist()
        rest = iter(self.whole([t for t, o in zip(texts, odd) if o]))
        return [next(rest) if o else every[a:b].tobytes() for o, a, b in zip(odd, bounds, bounds[1:])]


def _simple(word: str) -> bool:
    """Lower-casing letter by letter and as a whole agree; true for Latin letters."""
    return max(word) < "\u0250"


def irregular(text: str) -> bool:
    return text[0].isspace() or text[-1].isspace() or any(s in text for s in _IRREGULAR)


def encoder(text: str, blanks: str, remembered: int = REMEMBERED) -> Encoder:
    """The worker's encoder; its memory lasts from task to task, until a task without one."""
    key = (hash(text), blanks, remembered)
    if key not in KEPT:
        KEPT.clear()
        KEPT[key] = Encoder(text, blanks, remembered)
    return KEPT[key]
