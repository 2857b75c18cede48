"""SentencePiece encoding and decoding by suffix-array matching.

The texts of a batch are joined into one text and indexed by a suffix array.
Every piece of the vocabulary is looked up by binary search, which gives the
range of suffixes that start with it, hence all its occurrences: the edges of
a lattice over text positions. The edges are sorted by position and relaxed
from left to right.

The models at hand are byte-pair models, whose encoding isn't the path of the
best total score but the result of merging the best-ranked neighbours first.
It is still a path that relaxation finds: an encoding's prefixes are
encodings, so each position keeps one edge that ends there, and an edge may
follow another exactly if no merge would cross the border between the two
pieces. Whether one would follows from the two pieces alone: their symbols at
the border, as they grow from characters, compete with the joint piece by
rank, left before right.

No piece holds certain neighbouring characters (a letter and the space mark
of the next word, most marks after letters), so no edge crosses there. Words
are cut at such borders, and a batch's text is made of its distinct parts.
All parts are relaxed together, one position after the other.

Characters without a piece become byte pieces. Decoding joins the pieces and
bytes, turns marks into spaces and drops the one put before the text.

Defined results: null and empty texts encode to nothing and decode to the
empty text; the mark itself (U+2581) in a text counts as a space, as in the
library; malformed byte pieces decode to U+FFFD; repeated rows are encoded
each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe_ids import blocks
from .common import text_batches, worker_cache

MARK = "▁"
_ODD = re.compile(f"{MARK}|  | \\Z")
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
NEVER = 1 << 40
SLOTS = 1 << 20
BLOCK = 2_000_000  # characters that are indexed together, which bounds a worker's memory


class Model:
    """The pieces of a byte-pair SentencePiece model and how they grow."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(size)]
        self.names = names
        self.special = {i for i in range(size) if sp.is_control(i) or sp.is_unknown(i)}
        self.byte_of = {i: int(names[i][3:5], 16) for i in range(size) if sp.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        self.piece_id = {names[i]: i for i in range(size) if i not in self.special and i not in self.byte_of}
        # merge order: best score first
        self.rank = {p: -sp.get_score(i) for p, i in self.piece_id.items()}
        self.unknown = sp.unk_id()
        self.dummy_prefix = bool(sp.encode("a") != sp.encode("") and names[sp.encode("a")[0]].startswith(MARK))
        self.longest = max(map(len, self.piece_id))
        self.pieces = sorted(self.piece_id)
        self.split: dict[str, tuple[str, str]] = {}
        self.spines: dict[str, tuple[list, list]] = {}
        # what each id decodes to; unknown as in the library
        self.raw = [n.replace(MARK, " ").encode() for n in names]
        for i in self.special:
            self.raw[i] = " \u2047 ".encode() if i == self.unknown else b""
        for i, b in self.byte_of.items():
            self.raw[i] = bytes([b])
        self.pairs: dict[int, bool] = {}
        # the pairs met last, each in a slot that its number gives: twice the number, and one if it fits
        self.met = np.full(SLOTS, -1, dtype=np.int64)
        self.lengths = np.fromiter(map(len, self.pieces), dtype=np.int64, count=len(self.pieces))
        self.ids = np.array([self.piece_id[p] for p in self.pieces], dtype="<i4")
        self.is_character = np.zeros(sys.maxunicode + 1, dtype=bool)
        self.is_character[[ord(p) for p in self.pieces if len(p) == 1]] = True
        inside = {(ord(a), ord(b)) for p in self.pieces for a, b in zip(p, p[1:])}
        # characters by number, those that no piece holds beside another 0
        self.number = np.zeros(sys.maxunicode + 1, dtype=np.int32)
        beside = sorted({c for pair in inside for c in pair})
        self.number[beside] = np.arange(1, len(beside) + 1)
        # the neighbours as bits of a table: a row for the first, a bit for the second
        self.neighbours = np.zeros((len(beside) + 1, len(beside) // 8 + 1), dtype=np.uint8)
        if inside:
            first, second = self.number[np.array(sorted(inside)).T]
            np.bitwise_or.at(self.neighbours, (first, second >> 3), (1 << (second & 7)).astype(np.uint8))

    def last_merge(self, piece: str) -> tuple[str, str]:
        """The two symbols whose merge makes the piece, found by merging its
        characters in order of rank, left before right."""
        found = self.split.get(piece)
        if found is None:
            symbols = list(piece)
            while len(symbols) > 2:
                ranks = [self.rank.get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
                best = min(ranks)
                if best == NEVER:
                    raise ValueError(f"piece {piece!r} isn't reached by merges")
                k = ranks.index(best)
                symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
            found = self.split[piece] = (symbols[0], symbols[1])
        return found

    def spine(self, piece: str) -> tuple[list, list]:
        """The symbols at the piece's left and right border as it grows from
        characters, each with the rank of the merge that absorbs it."""
        found = self.spines.get(piece)
        if found is None:
            found = []
            for side in (0, 1):
                steps, symbol, until = [], piece, NEVER
                while True:
                    steps.append((symbol, until))
                    if len(symbol) == 1:
                        break
                    until = self.rank[symbol]
                    symbol = self.last_merge(symbol)[side]
                found.append(steps[::-1])
            self.spines[piece] = found = (found[0], found[1])
        return found

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the encoding of the two pieces' text is the two pieces: no
        merge across their border comes before both have grown."""
        us, vs = self.spine(self.pieces[left])[1], self.spine(self.pieces[right])[0]
        i = j = 0
        while True:
            (u, u_until), (v, v_until) = us[i], vs[j]
            joint = self.rank.get(u + v, NEVER)
            # of equal ranks the one further left goes first
            if joint < u_until and joint <= v_until and joint < NEVER:
                return False
            if u_until == v_until == NEVER:
                return True
            if u_until <= v_until:
                i += 1
            else:
                j += 1

    def holds(self, codes: np.ndarray) -> np.ndarray:
        """Whether a piece holds each character of ``codes`` and the one after
        it as neighbours."""
        number = self.number[codes]
        second = number[1:]
        return (self.neighbours[number[:-1], second >> 3] >> (second & 7)) & 1 > 0

    def follows(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``may_follow`` of many pairs; met pairs are kept."""
        if len(self.pairs) > 500_000:
            self.pairs.clear()
        pairs, size = self.pairs, len(self.pieces)
        keys = left * size + right
        slot = (keys * 0x9E3779B1 >> 12) % SLOTS
        met = self.met[slot]
        new = np.flatnonzero(met >> 1 != keys)
        if len(new):
            some, place = np.unique(keys[new], return_inverse=True)
            found = [pairs.get(k) for k in some.tolist()]
            for n, k in enumerate(some.tolist()):
                if found[n] is None:
                    found[n] = pairs[k] = self.may_follow(k // size, k % size)
            met[new] = 2 * keys[new] + np.array(found, dtype=np.int64)[place]
            self.met[slot[new]] = met[new]
        return met & 1 > 0


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` (code points) ordered by their first ``depth``
    characters at least. The first order is by three characters, which fit
    into one integer; each further one, by pairs of ranks, doubles the length."""
    key, length = text << 42, 3
    key[:-1] |= text[1:] << 21
    key[:-2] |= text[2:]
    while True:
        order = np.argsort(key)
        if length >= depth:
            return order
        ordered = key[order]
        rank = np.empty_like(key)
        rank[order] = np.cumsum(np.concatenate([[1], ordered[1:] != ordered[:-1]]))
        key = rank * (len(text) + 1)
        key[:-length] += rank[length:]
        length *= 2


def _bound(text, order, low, high, offset, wanted, right: bool):
    """Binary search, for many ranges of the suffix array at once, for the
    first suffix whose character at ``offset`` is not below (or is above)
    ``wanted``."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        at = order[middle] + offset
        here = text[np.minimum(at, len(text) - 1)]
        here = np.where(at < len(text), here, -1)
        goes_right = here <= wanted[open_] if right else here < wanted[open_]
        low[open_[goes_right]] = middle[goes_right] + 1
        high[open_[~goes_right]] = middle[~goes_right]


def occurrences(text: np.ndarray, order: np.ndarray, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The range of the suffix array that each piece starts."""
    low, high = np.zeros(len(pieces), dtype=np.int64), np.full(len(pieces), len(text), dtype=np.int64)
    lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    codes = np.zeros((len(pieces), int(lengths.max())), dtype=np.int64)
    flat = np.frombuffer("".join(pieces).encode("utf-32-le"), dtype="<u4")
    codes[np.arange(codes.shape[1])[None, :] < lengths[:, None]] = flat
    for offset in range(codes.shape[1]):
        live = np.flatnonzero((lengths > offset) & (low < high))
        if not len(live):
            break
        args = text, order, low[live], high[live], offset, codes[live, offset]
        low[live], high[live] = _bound(*args, right=False), _bound(*args, right=True)
    return low, high


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int64)


def cut_words(words: list[str], model: Model) -> tuple[list[str], list[int]]:
    """The words' parts, one after the other, cut between characters that no
    piece holds as neighbours, and where each word's end in this list."""
    joined = "".join(words)
    codes = code_points(joined)
    border = np.ones(len(codes) + 1, dtype=bool)
    border[1:-1] = ~model.holds(codes)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
    border[ends] = True
    cuts = np.flatnonzero(border)
    word_ends = np.searchsorted(cuts, ends).tolist()
    cuts = cuts.tolist()
    return [joined[a:b] for a, b in zip(cuts, cuts[1:])], word_ends


def encode_parts(parts: list[str], model: Model) -> list[bytes]:
    """The ids (little-endian int32) of texts, each encoded by itself."""
    if not parts:
        return []
    # a null character inside a part has no piece; here it also separates
    text = code_points("\0" + "\0".join(parts) + "\0")
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    first = np.cumsum(sizes + 1) - sizes  # where each part starts
    order = suffix_array(text, model.longest)
    low, high = occurrences(text, order, model.pieces)
    count = high - low
    used = np.flatnonzero(count)
    piece = np.repeat(used, count[used])
    rows = np.arange(len(piece)) - np.repeat(np.cumsum(count[used]) - count[used], count[used])
    start = order[np.repeat(low[used], count[used]) + rows]
    # a character without a piece is an edge of its own, piece -1
    begins = np.append(0, np.repeat(first, sizes + 1))  # of the part at each place
    inside = np.ones(len(text), dtype=bool)
    inside[first - 1] = inside[-1] = False
    lone = np.flatnonzero(inside & ~model.is_character[text])
    start, piece = np.concatenate([start, lone]), np.concatenate([piece, np.full(len(lone), -1)])
    end = start + np.where(piece < 0, 1, model.lengths[piece])
    depth = end - begins[start]
    # few different depths: a radix sort where they fit 16 bits
    small = int(depth.max(initial=0)) < 1 << 16
    by_depth = np.argsort(depth.astype(np.uint16) if small else depth, kind="stable")
    start, end, piece, depth = start[by_depth], end[by_depth], piece[by_depth], depth[by_depth]
    # the piece that ends the encoding of each prefix, and where it starts;
    # -1 at a part's start and after a lone character, where anything follows
    last, came = np.full(len(text) + 1, -1), np.zeros(len(text) + 1, dtype=np.int64)
    stops = np.searchsorted(depth, np.arange(1, int(depth.max(initial=0)) + 2))
    for a, b in zip(stops, stops[1:]):
        s, e, p = start[a:b], end[a:b], piece[a:b]
        before = last[s]
        fits = (before < 0) | (p < 0)
        asked = np.flatnonzero(~fits)
        fits[asked] = model.follows(before[asked], p[asked])
        last[e[fits]], came[e[fits]] = p[fits], s[fits]
    # back from the end of every part
    at, part, found = first + sizes, np.arange(len(parts)), []
    while len(at):
        found.append((part, at, last[at]))
        at = came[at]
        on = at > first[part]
        at, part = at[on], part[on]
    part, at, piece = (np.concatenate(x) for x in zip(*found))
    by_place = np.lexsort((at, part))
    part, at, piece = part[by_place], at[by_place], piece[by_place]
    raw = model.ids[piece].tobytes()
    ends = np.searchsorted(part, np.arange(len(parts)), side="right").tolist()
    out = [raw[4 * a : 4 * b] for a, b in zip([0, *ends], ends)]
    for n in np.unique(part[piece < 0]).tolist():
        a, b = ends[n - 1] if n else 0, ends[n]
        ids: list[int] = []
        for q, e in zip(piece[a:b].tolist(), at[a:b].tolist()):
            if q < 0:
                ids += [model.byte_id.get(x, model.unknown) for x in chr(int(text[e - 1])).encode()]
            else:
                ids.append(int(model.ids[q]))
        out[n] = np.array(ids, dtype="<i4").tobytes()
    return out


class Encoder:
    """A worker's model and the ids of the words it has met; bounded."""

    def __init__(self, path: str, keep: int = 250_000):
        self.model, self.keep = Model(path), keep
        self.ids: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def cut(self, text: str) -> list[str]:
        """The words of a text: each starts with its marks."""
        if _ODD.search(text) or not self.model.dummy_prefix:
            marked = text.replace(" ", MARK)
            return _WORDS.findall(MARK + marked if self.model.dummy_prefix else marked)
        return [MARK + w for w in text.split(" ")] if text[0] != " " else _WORDS.findall(MARK + text.replace(" ", MARK))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.ids) > self.keep:
            self.ids, self.parts = {}, {}
        cut = [self.cut(t) if t else [] for t in texts]
        new = set()
        for words in cut:
            new.update(words)
        new = list(new.difference(self.ids))
        if new:
            made_of, ends = cut_words(new, self.model)
            need = list(set(made_of).difference(self.parts))
            self.parts.update(zip(need, encode_parts(need, self.model)))
            found = list(map(self.parts.__getitem__, made_of))
            cuts = zip([0, *ends], ends)
            self.ids.update(zip(new, [found[a] if b == a + 1 else b"".join(found[a:b]) for a, b in cuts]))
        get = self.ids.__getitem__
        return [np.frombuffer(b"".join(map(get, words)), dtype="<i4") for words in cut]


def decode(ids: np.ndarray, model: Model) -> str:
    """The text of ids: pieces and bytes joined, marks as spaces, without the
    space put before the text."""
    ids = ids.tolist()
    raw = b"".join(map(model.raw.__getitem__, ids))
    if model.dummy_prefix and raw.startswith(b" "):
        before = next(i for i in ids if model.raw[i])
        if before != model.unknown and before not in model.byte_of:
            raw = raw[1:]
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode(errors="replace")


def encoder(path: str) -> Encoder:
    return worker_cache("sentencepiece:" + path, lambda: Encoder(path))


def _both(texts: Iterator[pd.Series], path: str) -> Iterator[pd.DataFrame]:
    own = encoder(path)
    for series in texts:
        plain = [t or "" for t in series]
        ids = [x for a, b in blocks(plain, BLOCK) for x in own.encode(plain[a:b])]
        yield pd.DataFrame({"ids": pd.Series(ids, dtype="object"), "decoded": [decode(x, own.model) for x in ids]})


def encode_column(text: Column, path: str) -> Column:
    """The ids of each text (array<int>)."""

    @F.pandas_udf("array<int>")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoder(path)
        for series in texts:
            plain = [t or "" for t in series]
            yield pd.Series([ids for a, b in blocks(plain, BLOCK) for ids in own.encode(plain[a:b])], dtype="object")

    return encode(text)


def decode_column(ids: Column, path: str) -> Column:
    """The text of each array of ids."""

    @F.pandas_udf("string")
    def decoded(arrays: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = encoder(path).model
        for series in arrays:
            yield pd.Series([decode(np.asarray(a), model) if a is not None else "" for a in series], dtype="object")

    return decoded(ids)


def round_trip_column(text: Column, path: str) -> Column:
    """Struct of a text's ids and of what they decode to, by one worker."""

    @F.pandas_udf("ids array<int>, decoded string")
    def both(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from _both(texts, path)

    return both(text)


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, text, ids, decoded of every document."""
    text_batches(docs.sparkSession, 1000)
    done = docs.select("doc_id", "text", round_trip_column(F.col("text"), path).alias("_r"))
    return done.select("doc_id", "text", F.col("_r.ids").alias("ids"), F.col("_r.decoded").alias("decoded"))
