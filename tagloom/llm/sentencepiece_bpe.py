"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is cut into words that no merge can cross. All new words of a chunk are
encoded together: their symbols lie in one flat array, each round finds every
word's best pair with a segmented minimum, merges its occurrences in all words
at once, from the left, and closes the gaps, until no word has a pair left.

Edge cases: a null text counts as empty; an empty text has no ids; characters
outside the vocabulary become their UTF-8 bytes (byte fallback).
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, mapped

NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
SPACE = "▁"
NO_PAIR = np.int32(2**31 - 1)
#: Encoded words in each half of a worker's cache, and the longest of them.
CACHE_WORDS = 150_000
CACHE_CHARS = 32


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, raw[at : at + n]
        at += n


class PieceModel:
    """A SentencePiece BPE model file: pieces, merges and normaliser flags."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            raw = f.read()
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        self.dummy_prefix, squeeze, charsmap, algorithm = True, True, b"", 1
        for number, value in _fields(raw):
            if number == 1:
                one = dict(_fields(value))
                self.pieces.append(one[1].decode())
                scores.append(struct.unpack("<f", one[2])[0] if 2 in one else 0.0)
                self.kinds.append(one.get(3, NORMAL))
            elif number == 2:
                algorithm = dict(_fields(value)).get(3, 1)
            elif number == 3:
                spec = dict(_fields(value))
                charsmap, self.dummy_prefix, squeeze = spec.get(2, b""), bool(spec.get(3, 1)), bool(spec.get(4, 1))
        if charsmap or squeeze or algorithm != 2 or BYTE not in self.kinds or USER_DEFINED in self.kinds:
            raise ValueError("only BPE models with byte fallback, the identity normaliser and no user-defined pieces are supported")
        if any(k == NORMAL and SPACE in p.lstrip(SPACE) for p, k in zip(self.pieces, self.kinds, strict=True)):
            raise ValueError("pieces must not span words")
        self.size = len(self.pieces)
        normal = [i for i, k in enumerate(self.kinds) if k == NORMAL]
        self.unknown = self.kinds.index(UNKNOWN)
        self.byte_ids = np.zeros(256, np.int32)
        for i, k in enumerate(self.kinds):
            if k == BYTE:
                self.byte_ids[int(self.pieces[i][1:-1], 16)] = i
        self.symbol = {self.pieces[i]: i for i in normal}
        # Characters that occur only within longer pieces get symbols of their own above the vocabulary.
        for c in sorted({c for i in normal for c in self.pieces[i]} - self.symbol.keys()):
            self.symbol[c] = self.size + sum(v >= self.size for v in self.symbol.values())
        self.symbols = max(self.symbol.values()) + 1
        self.dead = self.symbols  # any other character
        by_rank = sorted((i for i in normal if len(self.pieces[i]) > 1), key=lambda i: (-scores[i], i))
        self.rank_id = np.array(by_rank, np.int32)
        pairs: dict[tuple[int, int], int] = {}
        for rank, i in enumerate(by_rank):
            p = self.pieces[i]
            for k in range(1, len(p)):
                left, right = self.symbol.get(p[:k]), self.symbol.get(p[k:])
                if left is not None and right is not None:
                    pairs[left, right] = rank
        self._hash_table(pairs)
        self.char_symbol = np.full(0x110000, self.dead, np.int32)
        for p, i in self.symbol.items():
            if len(p) == 1:
                self.char_symbol[ord(p)] = i
        self.piece_bytes = [self._bytes_of(i) for i in range(self.size)]
        inner = {c for i in normal if len(self.pieces[i]) > 1 for c in self.pieces[i]}
        alone = "".join(re.escape(chr(c)) for c in range(32) if chr(c) not in inner)
        self.words = re.compile(f"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+|[{alone}]" if alone else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    def _bytes_of(self, i: int) -> bytes:
        if self.kinds[i] == BYTE:
            return bytes([int(self.pieces[i][1:-1], 16)])
        if self.kinds[i] == CONTROL:
            return b""
        if self.kinds[i] == UNKNOWN:
            return " ⁇ ".encode()
        return self.pieces[i].replace(SPACE, " ").encode()

    def _hash_table(self, pairs: dict[tuple[int, int], int]) -> None:
        """Open addressing over pair keys, probed for whole arrays at a time."""
        keys = np.array([a * (self.symbols + 1) + b for a, b in pairs], np.int64)
        ranks = np.array(list(pairs.values()), np.int32)
        self.bits = max(10, int(len(keys) * 4).bit_length())
        self.slot_key, self.slot_rank = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NO_PAIR, np.int32)
        slots = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.slot_key[slots[left]] < 0]
            self.slot_key[slots[free]] = keys[free]  # of several for one slot the last stays
            placed = self.slot_key[slots[left]] == keys[left]
            self.slot_rank[slots[left[placed]]] = ranks[left[placed]]
            left = left[~placed]
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of symbols, NO_PAIR where they don't merge."""
        keys = left.astype(np.int64) * (self.symbols + 1) + right
        slots = self._slot(keys)
        found = self.slot_key[slots]
        out = np.where(found == keys, self.slot_rank[slots], NO_PAIR)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
            found = self.slot_key[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.slot_rank[slots[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def merge_rounds(self, words: list[str]) -> list[list[int]]:
        """Ids of each word (not empty)."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        symbols, word = self.char_symbol[points], np.repeat(np.arange(len(words)), lengths)
        place = np.arange(len(points))
        rank = np.full(len(points), NO_PAIR, np.int32)
        if len(points) > 1:
            rank[:-1] = np.where(word[1:] == word[:-1], self.rank(symbols[:-1], symbols[1:]), NO_PAIR)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(word):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.concatenate((starts, [len(word)])))
            best_here = np.repeat(best, sizes)
            if (over := best_here == NO_PAIR).any():
                done.append((word[over], symbols[over], place[over]))
                symbols, word, place, rank, best_here = (x[~over] for x in (symbols, word, place, rank, best_here))
                if not len(word):
                    break
            at = self._together(np.flatnonzero(rank == best_here), symbols, word, rank)
            symbols[at] = self.rank_id[rank[at]]
            kept = np.ones(len(word), bool)
            kept[at + 1] = False
            at = at - np.arange(len(at))  # each merge before it has closed one gap
            symbols, word, place, rank = symbols[kept], word[kept], place[kept], rank[kept]
            rank[at] = NO_PAIR
            right = at[at + 1 < len(word)]
            right = right[word[right + 1] == word[right]]
            rank[right] = self.rank(symbols[right], symbols[right + 1])
            left = at[at > 0] - 1
            left = left[word[left + 1] == word[left]]
            rank[left] = self.rank(symbols[left], symbols[left + 1])
        word, symbols, place = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.lexsort((place, word))
        word, symbols, place = word[order], symbols[order], place[order]
        ends = np.searchsorted(word, np.arange(len(words)), "right")
        flat, odd = symbols.tolist(), symbols >= self.size
        out, start = [], 0
        bad = np.add.reduceat(odd, np.concatenate(([0], ends[:-1]))) if odd.any() else np.zeros(len(words), int)
        for k, end in enumerate(ends.tolist()):
            ids = flat[start:end]
            if bad[k]:
                ids = [j for i, p in zip(ids, place[start:end].tolist(), strict=True) for j in ([i] if i < self.size else self.byte_ids[list(chr(points[p]).encode())].tolist())]
            out.append(ids)
            start = end
        return out

    def _together(self, at: np.ndarray, symbols: np.ndarray, word: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Of the places of each word's best pair those that merge in one round, from the left.

        Places that overlap the one before are passed over. One merge after the other would go on with the same pair as
        long as no merge makes a better one; so the first that does is the last of its word in this round.
        """
        heads = np.concatenate(([True], at[1:] != at[:-1] + 1))
        number = np.arange(len(at))
        at = at[(number - np.maximum.accumulate(np.where(heads, number, 0))) % 2 == 0]
        made, mine = self.rank_id[rank[at]], word[at]
        first = np.concatenate(([True], mine[1:] != mine[:-1]))
        if first.all():
            return at
        # Neighbours as they are when all merges further left are done.
        before, after = np.maximum(at - 1, 0), np.minimum(at + 2, len(word) - 1)
        touching = np.concatenate(([False], at[1:] == at[:-1] + 2))
        left = np.where(touching, np.concatenate((made[:1], made[:-1])), symbols[before])
        better = (at > 0) & (word[before] == mine) & (self.rank(left, made) < rank[at])
        better |= (at + 2 < len(word)) & (word[after] == mine) & (self.rank(made, symbols[after]) < rank[at])
        if not better.any():
            return at
        passed = np.cumsum(better) - better
        return at[passed == passed[first][np.cumsum(first) - 1]]

    def cut(self, text: str) -> list[str]:
        if not text:
            return []
        return self.words.findall((SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE))

    def encode_words(self, words: list[str]) -> list[list[int]]:
        return self.merge_rounds(words) if words else []

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text, without begin or end ids."""
        return [i for ids in self.encode_words(self.cut(text or "")) for i in ids]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces and bytes joined, the dummy space at the start taken off."""
        text = b"".join(map(self.piece_bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


_models: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model of a path, read once in each process."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


class Codec:
    """Encodes texts in chunks; words seen before come from a bounded cache of two halves, of which the younger keeps what is met again."""

    def __init__(self, path: str):
        self.model = model(path)
        self.young: dict[str, tuple[str, str]] = {}
        self.old: dict[str, tuple[str, str]] = {}

    def encoded(self, words: set[str]) -> dict[str, tuple[str, str]]:
        """(ids joined by commas, their text) of each word."""
        m, out, new = self.model, {}, []
        young, old = self.young, self.old
        for w in words:
            if (found := young.get(w)) is None and (found := old.get(w)) is not None:
                young[w] = found  # met again: stays
            if found is None:
                new.append(w)
            else:
                out[w] = found
        for w, ids in zip(new, m.encode_words(new), strict=True):
            out[w] = made = (",".join(map(str, ids)), b"".join(map(m.piece_bytes.__getitem__, ids)).decode("utf-8", "replace"))
            if len(w) <= CACHE_CHARS and len(young) < CACHE_WORDS:
                young[w] = made
        if len(young) >= CACHE_WORDS:
            self.young, self.old = {}, young
        return out

    def both_ways(self, texts: list[str | None]) -> Iterator[tuple[str, str]]:
        """(ids joined by commas, text decoded from these ids) of each text."""
        for start, end in chunks(texts):
            cut = [self.model.cut(t or "") for t in texts[start:end]]
            known = self.encoded({w for words in cut for w in words})
            for words in cut:
                found = [known[w] for w in words]
                text = "".join([x[1] for x in found])
                if self.model.dummy_prefix and text.startswith(" "):
                    text = text[1:]
                yield ",".join([x[0] for x in found]), text


def encode_column(df: DataFrame, path: str, text: str = "text", ids: str = "token_ids", decoded: str | None = None) -> DataFrame:
    """df with the ids of ``text`` (array of int) and, if named, the text decoded from them; other columns stay. New columns must not clash."""
    from pyspark.sql import types as T

    if {ids, decoded} & set(df.columns):
        raise ValueError("the new columns clash with columns of df")
    schema = T.StructType([*df.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))] + [T.StructField(decoded, T.StringType())] * bool(decoded))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for b in batches:
            made = list(codec.both_ways(b.column(b.schema.get_field_index(text)).to_pylist()))
            columns = [*b.columns, pa.array([[int(x) for x in i.split(",")] if i else [] for i, _ in made], pa.list_(pa.int32()))]
            if decoded:
                columns.append(pa.array([t for _, t in made], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    return df.transform(mapped, run, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document, read off its encoding and decoding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for b in batches:
            n, ids_hash, text_hash = [], [], []
            for ids, text in codec.both_ways(b.column(1).to_pylist()):
                n.append(ids.count(",") + 1 if ids else 0)
                ids_hash.append(hashlib.sha256(ids.encode()).hexdigest())
                text_hash.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return picked.transform(mapped, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
