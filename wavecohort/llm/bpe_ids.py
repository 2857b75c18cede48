"""Byte-level BPE ids of whole texts, through the tokenizers library.

The library's ids of a text are the ids of its pre-tokens, one after the
other. Texts repeat their pre-tokens, so a worker has the library encode each
distinct one once and joins the ids; only the cutting is done here, by the
pre-tokenizer's published pattern. A text that holds a special-token string
or a character that the two pattern engines may class differently goes to
the library whole.
"""

from __future__ import annotations

import re
import zlib

import numpy as np

from .common import worker_cache

# Fixed value: the byte-level pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def written_out(letter: str, number: str, space: str) -> str:
    return f"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"


# The same for texts up to U+024F, U+00FF and U+007F, with the classes written
# out; the standard library's engine takes half the time, and less for fewer
# characters.
LATIN_PATTERN = written_out("A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0")
BYTE_PATTERN = written_out("A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0")
ASCII_PATTERN = written_out("A-Za-z", "0-9", r"\t-\r ")
NOT_BYTE, NOT_LATIN = "[^\u0000-\u00FF]", "[^\u0000-\u024F]"
# Blocks in which the library's pattern engine and regex class every code
# point alike (Latin to Cyrillic, punctuation, CJK, Hangul, pictographs). Texts
# with other characters, which may be too new for one engine, go to the
# library whole.
UNSURE = "[^\u0000-\u0557\u2000-\u206F\u3000-\u9FFF\uAC00-\uD7A3\U0001F300-\U0001FAFF]"

# Byte-level models name a byte that isn't printable by a character from U+0100 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_NAMES = np.arange(256, dtype="<u2")
BYTE_NAMES[[b for b in range(256) if b not in PRINTABLE]] = np.arange(256, 512 - len(PRINTABLE))
NEW_LINE = chr(BYTE_NAMES[10])


def byte_names(text: str) -> str:
    return BYTE_NAMES[np.frombuffer(text.encode(), dtype=np.uint8)].tobytes().decode("utf-16-le")


class Spelled(dict):
    """piece -> its code, for the pieces a worker has met; the ids of the piece
    with code c are ``flat[starts[c]:starts[c] + lengths[c]]``.

    Asking for a new piece gives it a code; ``learn`` finds the ids of all new
    ones. ``keep`` bounds the pieces: beyond it ``trim`` forgets the rare ones,
    which changes codes and the speed and never the ids."""

    def __init__(self, keep: int, kind: str):
        super().__init__()
        self.keep, self.kind = keep, kind
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.words: list = []
        self.flat = np.zeros(0, dtype=self.kind)
        self.starts, self.lengths = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.met = np.zeros(0, dtype=np.int32)  # calls of ``spell`` since the last trim that each was in

    def trim(self) -> None:
        """Beyond ``keep`` pieces, only those stay that were spelled in two calls
        since the last time, the most frequent half of ``keep`` at most. All
        pieces must have been learned."""
        if len(self.words) <= self.keep:
            return
        stay = np.argsort(-self.met, kind="stable")[: self.keep // 2]
        stay = stay[self.met[stay] > 1]
        words, lengths = [self.words[i] for i in stay.tolist()], self.lengths[stay]
        flat = np.frombuffer(b"".join(self.spell(stay, np.array([len(stay)]))), dtype=self.kind)
        self.forget()
        self.update(zip(words, range(len(words))))
        self.words, self.flat = words, flat
        self.lengths, self.starts, self.met = lengths, np.cumsum(lengths) - lengths, np.zeros(len(words), dtype=np.int32)

    def __missing__(self, word) -> int:
        code = self[word] = len(self.words)
        self.words.append(word)
        return code

    def codes(self, pieces: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, pieces), dtype=np.int64, count=len(pieces))

    def ids_of(self, pieces: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each piece's start, how many each has) of new pieces."""
        raise NotImplementedError

    def learn(self) -> None:
        """The ids of the pieces met since the last call."""
        flat, starts, lengths = self.ids_of(self.words[len(self.starts) :])
        self.starts = extended(self.starts, len(self.flat) + starts)
        self.flat = extended(self.flat, flat)
        self.lengths = extended(self.lengths, lengths)
        self.met = extended(self.met, np.zeros(len(lengths), dtype=np.int32))

    def spell(self, codes: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The ids of texts of ``counts`` pieces each, laid end to end."""
        self.met[codes] += 1
        lengths = self.lengths[codes]
        ends = np.cumsum(lengths)
        index = np.arange(ends[-1] if len(ends) else 0)
        index += np.repeat(self.starts[codes] - ends + lengths, lengths)
        raw, cuts = self.flat[index].tobytes(), np.append(0, np.append(0, ends)[np.cumsum(counts)])
        width = self.flat.itemsize
        return [raw[a * width : b * width] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def extended(kept: np.ndarray, more: np.ndarray) -> np.ndarray:
    """``kept`` and ``more`` end to end, within the spare room of the array
    that ``kept`` is a view of, or in one with room for half as much again."""
    base, n = kept.base, len(kept) + len(more)
    if not isinstance(base, np.ndarray) or len(base) < n:
        base = np.empty(n + n // 2, dtype=kept.dtype)
        base[: len(kept)] = kept
    base[len(kept) : n] = more
    return base[:n]


class PieceCache(Spelled):
    """Ids (little-endian uint32) of the pre-tokens met by a worker."""

    def __init__(self, path: str, keep: int = 500_000):
        super().__init__(keep, "<u4")
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.ascii, self.byte = re.compile(ASCII_PATTERN).findall, re.compile(BYTE_PATTERN).findall
        self.latin, self.other = re.compile(LATIN_PATTERN).findall, regex.compile(PATTERN).findall
        self.not_byte, self.not_latin, self.unsure = (re.compile(p).search for p in (NOT_BYTE, NOT_LATIN, UNSURE))
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # the same model, for pre-tokens that are written in the names of their
        # bytes; a space, which is no byte's name, stands between them
        self.named = Tokenizer.from_file(path)
        self.named.pre_tokenizer = CharDelimiterSplit(" ")
        vocab = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.spaced[[i for t, i in vocab.items() if t.startswith("Ġ")]] = True

    def _library(self, texts: list[str], tokenizer=None) -> list[bytes]:
        got = (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in got]

    def spelled(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pre-tokens of one space and other characters, end to
        end, and where each one's start: an id whose token starts with a space
        starts the next one. The characters are no white space."""
        # lists of a few hundred stay in the processor's cache while the library cuts and merges them;
        # one a call, or it would start threads beside those of the other workers
        ids = []
        for a in range(0, len(pieces), 200):
            ids += self._library([byte_names("\n".join(pieces[a : a + 200])).replace(NEW_LINE, " ")], self.named)
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        return flat, np.flatnonzero(self.spaced[flat])

    def ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pre-tokens of one space and other characters are encoded many at
        a time."""
        together = np.array([p[0] == " " and not p.isspace() for p in pieces], dtype=bool)
        starts, lengths = np.zeros(len(pieces), dtype=np.int64), np.zeros(len(pieces), dtype=np.int64)
        flat, starts[together] = self.spelled([p for p, t in zip(pieces, together.tolist()) if t])
        lengths[together] = np.diff(starts[together], append=len(flat))
        rest = self._library([byte_names(p) for p, t in zip(pieces, together.tolist()) if not t], self.named)
        lengths[~together] = [len(ids) // 4 for ids in rest]
        starts[~together] = len(flat) + np.cumsum(lengths[~together]) - lengths[~together]
        return np.concatenate([flat, np.frombuffer(b"".join(rest), dtype="<u4")]), starts, lengths

    def cut(self, text: str) -> list[str] | None:
        """A text's pre-tokens; None where the library must cut it."""
        if any(s in text for s in self.special):
            return None
        if text.isascii():
            return self.ascii(text)
        if not self.not_byte(text):
            return self.byte(text)
        if not self.not_latin(text):
            return self.latin(text)
        return None if self.unsure(text) else self.other(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, concatenated as little-endian uint32."""
        self.trim()
        out: list[bytes] = [b""] * len(texts)
        whole, cut = [], []
        for i, text in enumerate(texts):
            pieces = self.cut(text)
            if pieces is None:
                whole.append(i)
            else:
                cut.append((i, self.codes(pieces)))
        self.learn()
        for i, ids in zip(whole, self._library([texts[i] for i in whole])):
            out[i] = ids
        if cut:
            laid = np.concatenate([codes for _, codes in cut])
            for (i, _), ids in zip(cut, self.spell(laid, np.array([len(codes) for _, codes in cut]))):
                out[i] = ids
        return out


def piece_cache(path: str) -> PieceCache:
    return worker_cache("bpe:" + path, lambda: PieceCache(path))


def blocks(texts, limit: int = 1_000_000):
    """Slices (from, to) of a list of texts of at most ``limit`` characters,
    one text at least, so that a batch of long texts stays small in memory."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def encode_documents(texts, path: str, end_id: int = 0):
    """Yields each text's ids (uint32 array, little endian) with ``end_id``
    after them; a null text counts as empty."""
    end = np.array([end_id], dtype="<u4").tobytes()
    cache = piece_cache(path)
    texts = [t or "" for t in texts]
    for a, b in blocks(texts):
        for ids in cache.encode(texts[a:b]):
            yield np.frombuffer(ids + end, dtype="<u4")


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))
