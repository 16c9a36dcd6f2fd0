"""Encoding word by word inside tasks.

The tokenizer's pre-tokenizer never joins text across ASCII white space, and its
special tokens hold none, so the ids of a text are those of its words
(``[^\\x20\\x09-\\x0D]+``) one after the other.

Of a tokenizer that lower-cases and never joins a letter to other signs, a plain
word, letters of ASCII or U+00C0 to U+023F with ASCII marks after them, has
the ids of its lower-cased core and then those of the marks: no letter of these
combines with another.  Cores recur more often than words, so fewer are encoded,
and their pairs are merged for many words at a time in arrays (``Merges``).  All
other words, and all words of other tokenizers, are handed to the ``tokenizers``
library as they stand.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: Words a worker remembers at most; beyond it, it starts over.
CACHE_WORDS = 1 << 20
#: Core and marks of a plain word, UTF-8: letters of U+00C0 to U+023F, which begin with
#: bytes C3 to C8; the signs of multiplication and division are none, and the dotted
#: capital I is left out, as its lower case is a letter and a mark.
_PLAIN = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|[\xc5-\xc8][\x80-\xbf])+)([!-&(-/:;=?@[-`{}~]*)")
#: Symbols of one array program.
_ROOM = 1 << 21


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The letter a byte-level vocabulary has for each byte: printable bytes stand for
    themselves, the others are numbered on from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Merges:
    """Pair merging of many words at once.  A round merges in every word its pair of
    lowest rank, the first of equal ones, until no word has a pair that is merged."""

    def __init__(self, model: dict):
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters])
        self.last = np.array([vocab[c + suffix] for c in letters])
        self.size = len(vocab)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs])
        order = np.argsort(key)
        self.key, self.rank = key[order], order
        self.merged = np.array([vocab[a + b] for a, b in pairs])
        self.none = len(pairs)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        own = left.astype("int64") * self.size + right
        at = np.minimum(np.searchsorted(self.key, own), len(self.key) - 1)
        return np.where((self.key[at] == own) & (left >= 0) & (right >= 0), self.rank[at], self.none).astype("int32")

    def encode(self, words: list[bytes], dtype) -> list[bytes]:
        """Packed ids of each word, whose bytes are those of one piece."""
        out: list = [None] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        at = 0
        while at < len(order):
            end, width = at + 1, len(words[order[at]])
            while end < len(order) and (end - at + 1) * len(words[order[end]]) <= _ROOM and len(words[order[end]]) <= width + 4:
                end += 1
            ids = self._encode([words[i] for i in order[at:end]])
            ends = (np.cumsum((ids >= 0).sum(axis=1)) * dtype.itemsize).tolist()
            packed, start = ids[ids >= 0].astype(dtype).tobytes(), 0
            for i, stop in zip(order[at:end], ends, strict=True):
                out[i] = packed[start:stop]
                start = stop
            at = end
        return out

    def _encode(self, words: list[bytes]) -> np.ndarray:
        """A row of ids for each word, filled up with -1."""
        size = np.array([len(w) for w in words])
        width = int(size.max())
        held = np.arange(width) < size[:, None]
        ids = np.full((len(words), width + 1), -1, dtype="int32")       # the last column stays empty
        ids[:, :-1][held] = self.inner[np.frombuffer(b"".join(words), dtype="u1")]
        ids[np.arange(len(words)), size - 1] = self.last[[w[-1] for w in words]]
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        left = np.arange(len(words))            # words that may have a pair to merge
        columns = np.arange(width)
        while len(left):
            at = ranks[left].argmin(axis=1)
            best = ranks[left, at]
            more = best < self.none
            left, at, best = left[more], at[more], best[more]
            if not len(left):
                break
            take = columns + (columns > at[:, None])
            row = np.take_along_axis(ids[left], take, axis=1)
            row[np.arange(len(left)), at] = self.merged[best]
            ids[left, :-1] = row
            ids[left, -1] = -1
            ranks[left] = np.take_along_axis(np.pad(ranks[left], ((0, 0), (0, 1)), constant_values=self.none), take, axis=1)
            ranks[left, at] = self._ranks(ids[left, at], ids[left, at + 1])
            some = at > 0
            ranks[left[some], at[some] - 1] = self._ranks(ids[left[some], at[some] - 1], ids[left[some], at[some]])
        return ids


class WordCodec:
    """Ids of words as packed little-endian unsigned numbers."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.size = self.tok.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.cache: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {}
        self.merges = _merges(path)
        self.cache_words = cache_words
        self._pieces = self._numbers = None

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word; only its parts are remembered."""
        if self.merges is None:
            return self._encode(words)
        heads, rests = [], []
        for w in words:
            m = _PLAIN.fullmatch(w)
            heads.append(m[1].lower() if m else b"")
            rests.append(m[2] if m else w)
        cores, others = set(heads), set(rests)
        if len(self.parts) + len(cores) + len(others) > self.cache_words:
            self.parts.clear()
        self.parts[b""] = b""
        new = list(cores.difference(self.parts))
        pieces = [core if core.isascii() else core.decode().lower().encode() for core in new]
        self.parts.update(zip(new, self.merges.encode(pieces, self.dtype), strict=True))
        rest = list(others.difference(self.parts))
        self.parts.update(zip(rest, self._encode(rest), strict=True))
        get = self.parts.__getitem__
        return [get(a) + get(b) for a, b in zip(heads, rests, strict=True)]

    def _encode(self, words: list[bytes]) -> list[bytes]:
        found = self.tok.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in found]

    def learn(self, words: set[bytes]) -> None:
        new = list(words.difference(self.cache))
        if len(self.cache) + len(new) > self.cache_words:
            self.cache.clear()
            new = list(words)
        for i in range(0, len(new), 50_000):
            part = new[i:i + 50_000]
            self.cache.update(zip(part, self.encode_words(part), strict=True))

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; the words that are new to the worker are encoded together."""
        split = [t.encode("utf-8", "replace").split() for t in texts]
        self.learn(set().union(*split))
        get = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(get, words)), dtype=self.dtype) for words in split]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_texts([text])[0]

    def pieces(self) -> list[str]:
        """The piece of each id."""
        if self._pieces is None:
            self._pieces = [self.tok.id_to_token(i) or "" for i in range(self.size)]
        return self._pieces

    def numbers(self) -> list[str]:
        """Each id in decimal."""
        if self._numbers is None:
            self._numbers = [str(i) for i in range(self.size)]
        return self._numbers


#: Fixed value: the pattern that separates letters, digits and other signs.
_SEPARATES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _merges(path: str) -> Merges | None:
    """The merges of a tokenizer whose plain words may be divided, else none."""
    with open(path, encoding="utf-8") as f:
        parts = json.load(f)
    normal = [x.get("type") for x in (parts.get("normalizer") or {}).get("normalizers", [])]
    first = ((parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    model = parts.get("model") or {}
    known = normal == ["NFC", "Replace", "Lowercase"] and (first.get("pattern") or {}).get("Regex") == _SEPARATES
    plain = model.get("type") == "BPE" and model.get("end_of_word_suffix") and not any(
        model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    return Merges(model) if known and plain else None


_CODECS: dict[str, WordCodec] = {}


def codec(path: str) -> WordCodec:
    """This worker's codec; it lives as long as the worker process."""
    if path not in _CODECS:
        _CODECS[path] = WordCodec(path)
    return _CODECS[path]
