"""Token ids of whole texts by a public word-level BPE, each word encoded once.

The tokenizer drops white space, so a text's ids are those of its white-space
separated chunks in a row. Chunks are looked up in a bounded table; new ones
go to the tokenizer, plain words in one call and everything else one by one
through its full pipeline.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
from tokenizers import Tokenizer

CACHE_WORDS = 200_000
GROUP_WORDS = 100_000
_SIZE_BITS = 24
_SIZES = (1 << _SIZE_BITS) - 1
# A word of Latin-1 letters with ASCII punctuation behind it. Such letters are
# already composed and have one lower-case form each, so the normalizer does
# to them what str.lower() does. No apostrophes: they join letters behind them.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


class WordIds(dict):
    """Row of each chunk of bytes; its ids are a slice of one flat array."""

    def __init__(self, text: str):
        super().__init__()
        self.full = Tokenizer.from_str(text)
        self.full.encode_special_tokens = True  # their strings in a text are ordinary text
        plain = json.loads(text)
        self.suffix = plain["model"].get("end_of_word_suffix") or ""
        self.quick = bool(self.suffix)
        plain["normalizer"], plain["post_processor"], plain["added_tokens"] = None, None, []
        plain["pre_tokenizer"] = {"type": "WhitespaceSplit"}
        self.words = Tokenizer.from_str(json.dumps(plain)) if self.quick else None
        # Spaces part the words and stay; no word holds one.
        self.letters = _byte_letters() | {32: " "}
        size = max(self.full.get_vocab().values()) + 1
        self.final = np.zeros(size, bool)
        self.final[[i for w, i in self.full.get_vocab().items() if self.suffix and w.endswith(self.suffix)]] = True
        self.base: dict[str, int] = {}
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.base.clear()
        self.new: list[bytes] = []
        # Ids of all words in a row; a word's code is its start there and its size.
        self.flat, self.codes = array("I"), array("q")

    def __missing__(self, chunk: bytes) -> int:
        self[chunk] = at = len(self)
        self.new.append(chunk)
        return at

    def _add(self, ids: list[int]) -> int:
        code = (len(self.flat) << _SIZE_BITS) | len(ids)
        self.flat.extend(ids)
        return code

    def _encode_words(self, words: list[str]) -> None:
        for at in range(0, len(words), 2000):
            some = words[at : at + 2000]
            mapped = " ".join(some).encode().decode("latin-1").translate(self.letters)
            ids = np.array(self.words.encode_batch_fast([mapped], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.final[ids]) + 1
            assert len(ends) == len(some), "a word did not end where the tokenizer ends it"
            starts = np.concatenate([[0], ends[:-1]])
            codes = (starts + len(self.flat) << _SIZE_BITS) | (ends - starts)
            self.flat.frombytes(ids.tobytes())
            self.base.update(zip(some, codes.tolist()))

    def settle(self) -> None:
        """Encode the chunks met since the last call."""
        words, tails = [], []
        for chunk in self.new:
            text = chunk.decode("utf-8", "replace")
            tail = ""
            if not (self.quick and text.isascii() and text.isalpha()):
                match = _PLAIN.fullmatch(text) if self.quick else None
                text, tail = (match[1], match[2]) if match else (None, text)
            words.append(None if text is None else text.lower())
            tails.append(tail)
        self._encode_words(sorted(set(words).difference(self.base, (None,))))
        rest = sorted(set(tails).difference(("",)))
        others = dict(zip(rest, (e.ids for e in self.full.encode_batch_fast(rest, add_special_tokens=False))))
        for word, tail in zip(words, tails):
            if word is None:
                self.codes.append(self._add(others[tail]))
            elif not tail:
                self.codes.append(self.base[word])
            else:
                code = self.base[word]
                start, size = code >> _SIZE_BITS, code & _SIZES
                self.codes.append(self._add([*self.flat[start : start + size], *others[tail]]))
        self.new = []

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Ids of each text, in order, as unsigned 32-bit integers."""
        if len(self) > CACHE_WORDS:  # calls of few words each fill the table too
            self.reset()
        held: list[list[np.ndarray]] = []
        n = 0
        for text in texts:
            chunks = text.split()
            rows = np.fromiter(map(self.__getitem__, chunks), np.int64, len(chunks))
            held.append(rows)
            n += len(chunks)
            if n >= GROUP_WORDS:
                yield from self._gathered(held)
                held, n = [], 0
                if len(self) > CACHE_WORDS:
                    self.reset()
        yield from self._gathered(held)

    def _gathered(self, held: list[np.ndarray]) -> Iterator[np.ndarray]:
        self.settle()
        flat, codes = np.array(self.flat, np.uint32), np.array(self.codes, np.int64)
        starts, sizes = codes >> _SIZE_BITS, codes & _SIZES
        for rows in held:
            own = sizes[rows]
            ends = np.cumsum(own)
            total = int(ends[-1]) if len(ends) else 0
            yield flat[np.repeat(starts[rows] - ends + own, own) + np.arange(total)]
