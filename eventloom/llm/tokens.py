"""Token ids of public tokenizer files, piece by piece.

Byte-pair merges never cross a pre-token, so the ids of a text are those of its pre-tokens in a row. Texts of
characters below U+0180 are cut by an equivalent pattern and each distinct pre-token is encoded once; any other
text, and any that holds NUL or a special string, goes to the ``tokenizers`` library as it is. Many texts of a word file
are cut at once, by the kinds of their characters.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa

# The pre-token patterns of the two files, for characters below U+0180.
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
_NUMBER = "0-9\xb2\xb3\xb9\xbc\xbd\xbe"
_SPACE = "\\t-\\r \x85\xa0"
_PARTS = "'s|'t|'re|'ve|'m|'ll|'d"
BYTE_PATTERN = f"{_PARTS}| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
WORD_PATTERN = f"{_PARTS}|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+"
# Characters whose handling the patterns above do not cover (U+0130 changes length in lower case).
_OTHER = "[\x00İƀ-\U0010ffff]"
_END_OF_WORD = "</w>"


def _byte_of_char() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies, reversed."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


_SPACES, _LETTERS, _NUMBERS, _OTHERS, _ODD_ONES = range(5)


def _kinds() -> np.ndarray:
    """The kind of each character below U+0180, by the patterns above, and of all others."""
    plain = "".join(map(chr, range(0x180)))
    kinds = np.full(0x181, _OTHERS, np.uint8)
    for kind, chars in ((_SPACES, _SPACE), (_LETTERS, _LETTER), (_NUMBERS, _NUMBER)):
        kinds[[m.start() for m in re.finditer(f"[{chars}]", plain)]] = kind
    kinds[[0, 0x130, 0x180]] = _ODD_ONES
    return kinds


_KINDS = _kinds()
# The characters below U+0180 in lower case, white space as blanks, and above nine bits the kind of each.
_CHARS = np.array([ord(chr(i).lower()[0]) for i in range(0x180)] + [0], "<u2")
_CHARS[_KINDS == _SPACES] = ord(" ")
_CHARS |= _KINDS.astype("<u2") << 9


def _starts(low: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of a word file start. ``low`` is in lower case and ends in two characters that are no letters."""
    starts = kinds != _SPACES
    starts[1:] &= (kinds[1:] != kinds[:-1]) | (kinds[1:] == _NUMBERS)
    # 's, 't, 'm, 'd, 're, 've, 'll are one where the apostrophe starts a pre-token.
    marks = np.flatnonzero((low[:-2] == ord("'")) & starts[:-2])
    after, then = low[marks + 1], low[marks + 2]
    pairs = [(after == ord(x)) & (then == ord(y)) for x, y in ("re", "ve", "ll")]
    for length, found in ((2, np.isin(after, [ord(c) for c in "stmd"])), (3, np.logical_or.reduce(pairs))):
        mark = marks[found]
        starts[mark + 1] = False
        starts[mark + length] = kinds[mark + length] != _SPACES
    return starts


class PieceEncoder:
    """Ids of a tokenizer file as little-endian unsigned 32-bit bytes, with a bounded cache of pre-tokens.

    ``limit`` bounds the cache; a full cache is emptied and fills again.
    """

    def __init__(self, path: str, limit: int = 500_000) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        vocab = spec["model"]["vocab"]
        self._specials = [t["content"] for t in spec["added_tokens"]]
        specials = [re.escape(t) for t in self._specials]
        self.words = any(t.endswith(_END_OF_WORD) for t in vocab)
        self._pattern = WORD_PATTERN if self.words else BYTE_PATTERN
        self._find = re.compile(self._pattern).findall
        self._odd = re.compile("|".join([_OTHER, *specials])).search
        byte = _byte_of_char()
        ranks = {}
        # Ids follow merge order, so they serve as ranks. NUL marks the end of a word, or parts two pre-tokens.
        for token, i in vocab.items():
            end = self.words and token.endswith(_END_OF_WORD)
            body = token.removesuffix(_END_OF_WORD) if end else token
            ranks[bytes(byte[c] for c in body) + b"\0" * end] = i
        self._nul = ranks[b"\0"]
        self._coder = tiktoken.Encoding(
            "pieces", pat_str="[^\\x00]+\\x00" if self.words else "[^\\x00]+|\\x00", mergeable_ranks=ranks, special_tokens={}
        )
        self._limit = limit
        self.cache: dict[str, bytes] = {}
        self._forget()

    def odd(self, text: str) -> bool:
        return self._odd(text) is not None

    def split(self, text: str) -> list[str]:
        """Pre-tokens of a text for which ``odd`` is false."""
        return self._find(text.lower() if self.words else text)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pre-tokens that ``split`` made."""
        if not pieces:
            return []
        ids = np.array(self._coder.encode_ordinary("\0".join(pieces) + "\0"), "<u4")
        if self.words:
            ends = np.flatnonzero(self._ends()[ids]) + 1
            starts = np.concatenate(([0], ends[:-1]))
        else:
            ends = np.flatnonzero(ids == self._nul)
            starts = np.concatenate(([0], ends[:-1] + 1))
        raw = ids.tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]

    def _ends(self) -> np.ndarray:
        """True at the ids that close a word."""
        if not hasattr(self, "_closing"):
            vocab = self.library.get_vocab(with_added_tokens=False)
            self._closing = np.zeros(max(vocab.values()) + 1, bool)
            self._closing[[i for t, i in vocab.items() if t.endswith(_END_OF_WORD)]] = True
        return self._closing

    def by_library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """All ids of a text, without added special tokens."""
        if self._odd(text):
            return self.by_library(text)
        pieces = self.split(text)
        try:
            return b"".join(map(self.cache.__getitem__, pieces))
        except KeyError:
            if len(self.cache) > self._limit:
                self.cache.clear()
            new = [p for p in dict.fromkeys(pieces) if p not in self.cache]
            self.cache.update(zip(new, self.encode_pieces(new)))
            return b"".join(map(self.cache.__getitem__, pieces))

    def _forget(self) -> None:
        """Empty the store of pre-tokens of many texts: the place and length of each one's ids in one array."""
        self._known: dict[bytes, int] = {}
        self._ids, self._at, self._length = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _numbers(self, pieces: np.ndarray) -> np.ndarray:
        """Numbers of distinct pre-tokens in UTF-16, blanks after them or not; new ones are encoded together."""
        numbers = np.fromiter(map(self._known.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            some, known = pieces[new].tolist(), len(self._known)
            coded = self.encode_pieces([p.rstrip(" ") for p in b"\0\0".join(some).decode("utf-16-le").split("\0")])
            lengths = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
            self._at = np.concatenate((self._at, len(self._ids) + np.cumsum(lengths) - lengths))
            self._length = np.concatenate((self._length, lengths))
            self._ids = np.concatenate((self._ids, np.frombuffer(b"".join(coded), "<u4")))
            numbers[new] = np.arange(known, known + len(new))
            self._known.update(zip(some, range(known, known + len(new))))
        return numbers

    def ids_of(self, texts: list[str]) -> list[bytes]:
        """``ids`` of many texts."""
        if not self.words or not texts:
            return [self.ids(t) for t in texts]
        if len(self._known) > self._limit:
            self._forget()
        text = np.frombuffer("\n".join([*texts, "\n"]).encode("utf-32-le"), "<u4")
        ends = np.cumsum([len(t) + 1 for t in texts])
        chars = _CHARS.take(text, mode="clip")
        low, kinds = chars & 0x1FF, (chars >> 9).astype(np.uint8)
        odd = {int(i) for i in np.searchsorted(ends, np.flatnonzero(kinds == _ODD_ONES), "right")}
        odd.update(i for i, t in enumerate(texts) if any(map(t.__contains__, self._specials)))
        for i in odd:
            kinds[ends[i] - len(texts[i]) - 1 : ends[i]], low[ends[i] - len(texts[i]) - 1 : ends[i]] = _SPACES, ord(" ")
        # Each pre-token with the blanks after it.
        begins = np.flatnonzero(_starts(low, kinds))
        offsets = np.append(begins, len(low)) * 2
        pieces = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(low)])
        pieces = pieces.dictionary_encode()
        numbers = self._numbers(pieces.dictionary.to_numpy(zero_copy_only=False)).take(pieces.indices.to_numpy())
        lengths = self._length.take(numbers)
        after = np.cumsum(lengths)
        raw = self._ids.take(np.repeat(self._at.take(numbers) - after + lengths, lengths) + np.arange(lengths.sum())).tobytes()
        # Ids before the end of each text.
        after = np.append(0, after)[np.searchsorted(begins, ends)] * 4
        return [self.by_library(t) if i in odd else raw[a:b] for i, (t, a, b) in enumerate(zip(texts, [0, *after[:-1].tolist()], after.tolist()))]

    def library_pieces(self, text: str) -> list[str]:
        """Pre-tokens of any text by the library's own rules, special strings as pieces of their own.

        Only for files whose normalizer is empty: pieces are slices of the text.
        """
        out, at = [], 0
        spans = [m.span() for m in re.finditer("|".join(re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()), text)]
        for a, b in [*spans, (len(text), len(text))]:
            part = text[at:a]
            if part:
                out += [part[x:y] for _, (x, y) in self.library.pre_tokenizer.pre_tokenize_str(part)]
            if b > a:
                out.append(text[a:b])
            at = b
        return out

    def piece_lengths(self, pieces: list[str]) -> list[int]:
        """Number of ids of each pre-token, whatever its characters."""
        plain = [p for p in pieces if not self._odd(p)]
        known = dict(zip(plain, (len(x) // 4 for x in self.encode_pieces(plain))))
        return [known[p] if p in known else len(self.library.encode(p, add_special_tokens=False).ids) for p in pieces]


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> PieceEncoder:
    """The encoder of a file that all tasks of one Python worker share."""
    return PieceEncoder(path)
