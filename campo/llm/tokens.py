"""Whole texts to token ids with a public tokenizer, a chunk at a time.

Both vocabularies cut a text at spaces (a space starts a word or is dropped),
so a text's ids are those of its space-separated chunks side by side.  Chunks
repeat a lot: their ids are kept in a bounded table of the worker.  Chunks of
letters go straight to the tokenizer's merge model, all others through the
tokenizer; texts where a chunk ends in white space are encoded in one piece.
A vocabulary that drops spaces and case reads all white space alike: its texts
are cut at any of it, many at a time, and the words not known yet go to the
merge model together.
"""

from __future__ import annotations

import codecs
import string
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KEPT_CHUNKS = 1_000_000
AT_ONCE = 8 << 20     #: bytes of texts cut at a time
WORDS_A_CALL = 4096   #: words a call of the merge model
_tokenizers: dict = {}

#: Pre-tokenizer patterns of the two kinds of vocabulary (fixed values).
SPACED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""


def _printable() -> str:
    """Byte-level vocabularies write bytes as printable characters: a printable
    Latin-1 byte as itself, the n-th other byte as code point 256 + n."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return "".join(chr(b if b in plain else next(rest)) for b in range(256))


class Pieces(dict):
    """Pre-token -> ids as bytes, a bounded number of them."""

    def __init__(self, ids):
        super().__init__()
        self.ids = ids

    def __missing__(self, piece: str) -> bytes:
        if len(self) > KEPT_CHUNKS // 8:
            self.clear()
        out = self[piece] = self.ids(piece)
        return out


class Chunks(dict):
    """Chunk -> ids as bytes (little-endian); None where it can't stand alone."""

    def __init__(self, path: str, code: str, spaced: bool, fold: bool):
        import regex
        from tokenizers import Tokenizer
        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.model, self.code = self.whole.model, code
        self.lead, self.fold, self.table = " " if spaced else "", fold, _printable()
        self.start = self.table[ord(" ")]
        self.pieces = regex.compile(SPACED if spaced else PLAIN).findall
        self.known = Pieces(lambda piece: self._bytes(self._as_read(piece)))

    def _bytes(self, piece: str) -> bytes:
        """Ids of one pre-token, written as the vocabulary reads it."""
        return array(self.code, [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _as_read(self, piece: str) -> str:
        return codecs.charmap_decode(piece.encode(), "strict", self.table)[0]

    def chunk(self, part: str, lead: str = "") -> bytes:
        if part.isascii():
            if part.isalpha():  # a byte of these is read as itself
                return self._bytes((self.start if lead else "") + (part.lower() if self.fold else part))
            simple = "<|" not in part
        else:
            # Latin text up to U+017F is composed already, and all libraries agree
            # on its case and classes; other chunks go through the tokenizer
            simple = max(part) < "ƀ" and "İ" not in part and "<|" not in part
            if simple and part.isalpha():
                return self._bytes(self._as_read(lead + (part.lower() if self.fold else part)))
        if simple and (part.isprintable() or part.replace("\n", "").isprintable()):
            return b"".join(map(self.known.__getitem__, self.pieces(lead + (part.lower() if self.fold else part))))
        return array(self.code, self.whole.encode(lead + part, add_special_tokens=False).ids).tobytes()

    def __missing__(self, part: str):
        if len(self) > KEPT_CHUNKS:
            self.clear()
        out = None if not part or part[-1].isspace() else self.chunk(part, self.lead)
        self[part] = out
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as bytes."""
        parts = text.split(" ")
        try:
            if len(parts) > 1 and not parts[0][-1:].isspace():
                first = self.chunk(parts[0]) if parts[0] else b""
                inner = b"".join(map(self.__getitem__, parts[1:-1]))
                last = self.chunk(parts[-1], self.lead) if parts[-1] or self.lead else b""
                return first + inner + last
        except TypeError:  # a chunk that can't stand alone
            pass
        return array(self.code, self.whole.encode(text, add_special_tokens=False).ids).tobytes()


def _latin(word: str) -> bool:
    return word.isascii() or max(word) < "ƀ" and "İ" not in word


class Words(Chunks):
    """Chunks between blanks and line ends, for a vocabulary that drops white
    space and folds case: any chunk can stand alone."""

    def __init__(self, *args):
        from tokenizers import Tokenizer, pre_tokenizers
        super().__init__(*args)
        self.bare = Tokenizer(self.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.lines = self.table[:10] + "\n" + self.table[11:]  # words of one string stay on their lines
        tokens, suffix = self.whole.get_vocab(with_added_tokens=False), self.model.end_of_word_suffix
        self.last = np.zeros(max(tokens.values()) + 1, bool)  # ids that end a word
        self.last[[i for t, i in tokens.items() if suffix and t.endswith(suffix)]] = True

    def __missing__(self, part: str) -> bytes:
        word = part.rstrip(string.punctuation)
        if word != part and word.isalpha() and _latin(word) and word in self:  # the rest is one pre-token
            out = self[word] + self.known[part[len(word):]]
        else:
            out = self.chunk(part)
        self[part] = out
        return out

    def learn(self, parts: list[str]) -> None:
        """Take up the words that new ``parts`` begin with, if they are of Latin
        letters in lower case."""
        words = {p.rstrip(string.punctuation) for p in parts}
        words = [w for w in words if w not in self and w.isalpha() and w.islower() and _latin(w)]
        for k in range(0, len(words), WORDS_A_CALL):
            some = words[k:k + WORDS_A_CALL]
            read = codecs.charmap_decode("\n".join(some).encode(), "strict", self.lines)[0]
            ids = np.array(self.bare.encode(read, add_special_tokens=False).ids, self.code)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(some):  # else one at a time
                raw, ends = ids.tobytes(), (ends * ids.itemsize).tolist()
                self.update(zip(some, [raw[a:b] for a, b in zip([0, *ends], ends)]))

    def encode_all(self, texts: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end``, and their number a text."""
        # of Latin letters a chunk is looked up in lower case; marks would join with others than capitals
        kept = pc.match_substring_regex(texts, r"[^\x00-\x{24F}]|<\|")
        texts = pc.if_else(kept, texts, pc.ascii_lower(texts))
        for blank in "\t\r\n":
            texts = pc.replace_substring(texts, blank, " ")
        cut = pc.split_pattern(texts, " ")
        found = pc.dictionary_encode(cut.flatten())
        parts = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self) > KEPT_CHUNKS:
            self.clear()
        self.learn([p for p in parts if p not in self])
        table = pa.array([*map(self.__getitem__, parts), end], pa.large_binary())
        ends = cut.offsets.to_numpy()[1:]
        ids = table.take(pa.array(np.insert(found.indices.to_numpy(), ends, len(parts))))
        _, offsets, raw = ids.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(ids) + 1) // len(end)
        counts = np.diff(offsets[ends + np.arange(1, len(ends) + 1)], prepend=0)
        return np.frombuffer(raw, self.code, offsets[-1]), counts

    def batches(self, texts: pa.Array, end: bytes):
        """:meth:`encode_all` for one run of rows after the other."""
        after = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
        first = 0
        while first < len(texts):
            begin = after[first - 1] if first else 0
            stop = max(first + 1, int(np.searchsorted(after, begin + AT_ONCE, "right")))
            yield (first, *self.encode_all(texts.slice(first, stop - first), end))
            first = stop


def chunks(path: str, code: str = "I", spaced: bool = True, fold: bool = False) -> Chunks:
    """The worker's encoder for a tokenizer file.  ``code``: array type of an
    id; ``spaced``: a space starts the next word's token (else it is dropped);
    ``fold``: lower case only."""
    key = (path, code, spaced, fold)
    if key not in _tokenizers:
        _tokenizers[key] = (Words if fold and not spaced else Chunks)(*key)
    return _tokenizers[key]
