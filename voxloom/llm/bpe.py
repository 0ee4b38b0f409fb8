"""Byte-level BPE, encoding and decoding with a public vocabulary file.

A word's adjacent pairs are the leaves of a segment tree; each holds the rank of its
merge. The root is the lowest rank, leftmost among equals, so a merge is read off the
root and changes three leaves. That keeps a word of a million bytes at a million
logarithmic steps. Short words, nearly all there are, are merged side by side: the
trees of many words are the rows of a matrix, and a step takes one merge in each.
"""

from __future__ import annotations

import json
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import checked, kept_by_worker, with_columns

#: The pattern that cuts texts into words is part of the vocabulary's format.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Words whose ids a worker remembers; beyond that it starts anew.
REMEMBERED = 600_000
#: Bytes up to which words are merged side by side, and words merged at once.
SHORT = 64
SIDE_BY_SIDE = 8192
#: Slots of the table of pairs, as a power of two.
TABLE_BITS = 18
#: No merge.
_NONE = 1 << 62


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next free one."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(free)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and special texts of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        model = content["model"]
        ids, letters = model["vocab"], byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.of_byte = [ids[c] for c in letters]
        #: The rank of each pair, and the token that a pair of that rank becomes.
        self.rank_of: dict[tuple[int, int], int] = {}
        self.becomes: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank_of[ids[left], ids[right]] = rank
            self.becomes.append(ids[left + right])
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        size = 1 + max(chain(ids.values(), self.special.values()))
        self.bytes_of = [b""] * size
        for token, i in ids.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token)
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        self._tabulate()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None

    def _tabulate(self) -> None:
        """The ranks of pairs as an open hash table in arrays."""
        self.byte_tokens = np.array(self.of_byte, dtype=np.int64)
        self.merged = np.array([*self.becomes, -1], dtype=np.int64)
        self.table_pairs = np.full(1 << TABLE_BITS, -1, dtype=np.int64)
        self.table_ranks = np.zeros(1 << TABLE_BITS, dtype=np.int64)
        pairs = np.array([a << 32 | b for a, b in self.rank_of], dtype=np.int64)
        for slot, pair, rank in zip(_slots(pairs).tolist(), pairs, self.rank_of.values(), strict=True):
            while self.table_pairs[slot] >= 0:
                slot = (slot + 1) % len(self.table_pairs)
            self.table_pairs[slot], self.table_ranks[slot] = pair, rank

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` where there is none; negative tokens have none."""
        pairs = left << 32 | right
        found = np.full(len(pairs), _NONE, dtype=np.int64)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        slots = _slots(pairs[at])
        while len(at):
            there = self.table_pairs[slots]
            hit = there == pairs[at]
            found[at[hit]] = self.table_ranks[slots[hit]]
            on = ~hit & (there >= 0)
            at, slots = at[on], (slots[on] + 1) % len(self.table_pairs)
        return found

    def words(self, data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of words, one after the other, and how many each has."""
        sizes = np.array([len(d) for d in data], dtype=np.int64)
        counts = np.zeros(len(data), dtype=np.int64)
        merged = []
        for i in np.flatnonzero(sizes > SHORT).tolist():
            tokens = np.array(self.word(data[i]))
            counts[i] = len(tokens)
            merged.append(([i], tokens))
        short = np.flatnonzero(sizes <= SHORT)
        # Words of like size share a matrix, whose tree has a power of two of leaves.
        leaves = 1 << np.ceil(np.log2(np.maximum(sizes[short] - 1, 1))).astype(int)
        for width in np.unique(leaves).tolist():
            group = short[leaves == width]
            for s in range(0, len(group), SIDE_BY_SIDE):
                part = group[s : s + SIDE_BY_SIDE]
                tokens = self._side_by_side([data[i] for i in part.tolist()], width)
                kept = tokens >= 0
                counts[part] = kept.sum(axis=1)
                merged.append((part, tokens[kept]))
        starts = np.cumsum(counts) - counts
        result = np.empty(int(counts.sum()), dtype=np.int64)
        for part, tokens in merged:
            result[_spans(starts[part], counts[part])] = tokens
        return result, counts

    def _side_by_side(self, data: list[bytes], width: int) -> np.ndarray:
        """Tokens of words of at most ``width`` + 1 bytes, a row each; -1 is no token."""
        n, columns = len(data), width + 1
        padded = b"".join([d.ljust(columns, b"\0") for d in data])
        size = np.array([len(d) for d in data])
        token = self.byte_tokens[np.frombuffer(padded, dtype=np.uint8)].reshape(n, columns)
        token[np.arange(columns) >= size[:, None]] = -1
        # A leaf is rank and position in one number, so that ties fall to the left.
        tree = np.full((n, 2 * width), _NONE, dtype=np.int64)
        rank = self.ranks(token[:, :-1].ravel(), token[:, 1:].ravel()).reshape(n, width)
        tree[:, width:] = np.where(rank == _NONE, _NONE, rank * columns + np.arange(width))
        level = width
        while level > 1:
            level //= 2
            tree[:, level : 2 * level] = np.minimum(
                tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2]
            )
        after = np.tile(np.arange(1, columns + 1), (n, 1))
        before = np.tile(np.arange(-1, columns - 1), (n, 1))
        flat_tree, flat_token, flat_after, flat_before = (x.reshape(-1) for x in (tree, token, after, before))

        def put(row: np.ndarray, place: np.ndarray, value: np.ndarray) -> None:
            node = row * (2 * width)
            place = place + width
            flat_tree[node + place] = value
            for _ in range(width.bit_length() - 1):
                # The parent is the lesser of the node and its sibling.
                value = np.minimum(value, flat_tree[node + (place ^ 1)])
                place = place >> 1
                flat_tree[node + place] = value

        live = np.flatnonzero(tree[:, 1] != _NONE)
        while len(live):
            best, i = np.divmod(flat_tree[live * (2 * width) + 1], columns)
            base = live * columns
            j, h = flat_after[base + i], flat_before[base + i]
            k = flat_after[base + j]
            new = self.merged[best]
            flat_token[base + i] = new
            flat_token[base + j] = -1
            flat_after[base + i] = k
            inner = k < size[live]
            flat_before[(base + k)[inner]] = i[inner]
            right = np.where(inner, flat_token[base + np.where(inner, k, 0)], -1)
            left = np.where(h >= 0, flat_token[base + np.maximum(h, 0)], -1)
            ranks = self.ranks(np.concatenate([new, left]), np.concatenate([right, new]))
            own, around = np.split(ranks, 2)
            leaf = j < width
            put(live[leaf], j[leaf], np.full(int(leaf.sum()), _NONE))
            put(live, i, np.where(own == _NONE, _NONE, own * columns + i))
            held = h >= 0
            put(live[held], h[held], np.where(around == _NONE, _NONE, around * columns + h)[held])
            live = live[flat_tree[live * (2 * width) + 1] != _NONE]
        return token

    def word(self, data: bytes) -> list[int]:
        """Tokens of one word."""
        token = [self.of_byte[b] for b in data]
        n = len(token)
        if n < 2:
            return token
        rank_of, becomes = self.rank_of.get, self.becomes
        width = 1 << (n - 2).bit_length()
        # A leaf is rank and position in one number, so that ties fall to the left.
        ranks = map(rank_of, zip(token, token[1:], strict=False))
        leaves = [_NONE if r is None else r * n + i for i, r in enumerate(ranks)]
        tree = [_NONE] * width + leaves + [_NONE] * (width - n + 1)
        for k in range(width - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (root := tree[1]) != _NONE:
            rank, i = divmod(root, n)
            j, h = after[i], before[i]
            k = after[j]
            new = token[i] = becomes[rank]
            token[j] = -1
            after[i] = k
            changed = []
            if k < n:
                before[k] = i
                changed.append((j, None))
                changed.append((i, rank_of((new, token[k]))))
            else:
                changed.append((i, None))
            if h >= 0:
                changed.append((h, rank_of((token[h], new))))
            for p, r in changed:
                value = _NONE if r is None else r * n + p
                p += width
                tree[p] = value
                while p > 1:
                    # The parent is the lesser of the node and its sibling.
                    other = tree[p ^ 1]
                    if other < value:
                        value = other
                    p >>= 1
                    if tree[p] == value:
                        break
                    tree[p] = value
        return [t for t in token if t >= 0]


def _slots(pairs: np.ndarray) -> np.ndarray:
    mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


class Encoder:
    """Encodes texts, remembering words by number."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED):
        self.vocabulary, self.remembered = vocabulary, remembered
        self._forget()

    def _forget(self) -> None:
        # Special texts are never words of a text, so they can be entries like words.
        special = self.vocabulary.special
        self.number = {text: i for i, text in enumerate(special)}
        self.tokens = np.array([*special.values()], dtype=np.int32)
        self.counts = np.ones(len(special), dtype=np.int64)

    def _learn(self, words: list[str]) -> None:
        if len(self.number) + len(words) > self.remembered:
            self._forget()
        first = len(self.number)
        self.number.update(zip(words, range(first, first + len(words)), strict=True))
        tokens, counts = self.vocabulary.words([w.encode() for w in words])
        self.tokens = np.concatenate([self.tokens, tokens.astype(np.int32)])
        self.counts = np.concatenate([self.counts, counts])

    def _words(self, text: str) -> list[str]:
        v = self.vocabulary
        if not v.cut:
            return WORDS.findall(text)
        found = []
        for part in v.cut.split(text):
            found += [part] if part in v.special else WORDS.findall(part)
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of texts, one after the other, and how many each has."""
        words = [self._words(t) for t in texts]
        get = self.number.get
        numbers = [get(w) for w in chain.from_iterable(words)]
        if None in numbers:
            # In the order met; if memory is full, all words of the batch are learned anew.
            new = dict.fromkeys(w for w, i in zip(chain.from_iterable(words), numbers, strict=True) if i is None)
            if len(self.number) + len(new) > self.remembered:
                self._forget()
                known = self.number
                new = dict.fromkeys(w for w in chain.from_iterable(words) if w not in known)
            self._learn(list(new))
            get = self.number.__getitem__
            numbers = [get(w) for w in chain.from_iterable(words)]
        numbers = np.array(numbers, dtype=np.int64)
        counts = self.counts[numbers]
        starts = (np.cumsum(self.counts) - self.counts)[numbers]
        tokens = self.tokens[_spans(starts, counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])
        per_text = np.cumsum([len(w) for w in words]) if words else np.empty(0, dtype=np.int64)
        return tokens, np.diff(ends[per_text], prepend=0)


def _spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of all spans, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - ends + counts, counts)


def encode(text: Column, path: str) -> Column:
    """Token ids of each text, as an array of int; null is the empty text.

    ``path`` names the vocabulary file, which every worker can read. Special texts
    within a text become their own ids. Texts are encoded whole.
    """

    def apply(texts: pa.Array) -> pa.Array:
        encoder = kept_by_worker(f"encoder {path}", lambda: Encoder(Vocabulary(path)))
        tokens, counts = encoder.encode([t or "" for t in texts.to_pylist()])
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens))

    apply.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(apply, "array<int>")(text)


def decode(ids: Column, path: str) -> Column:
    """Texts of token ids, special ones included; null ids give the empty text.

    Bytes that are no UTF-8, as between the tokens of one letter, become U+FFFD. An
    id that the vocabulary does not have is an error.
    """
    def apply(lists: pa.Array) -> pa.Array:
        content, sizes = kept_by_worker(f"bytes of {path}", lambda: _bytes_of(path))
        ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(sizes):
            raise ValueError("token ids that the vocabulary does not have")
        counts = sizes[ids]
        data = content[_spans((np.cumsum(sizes) - sizes)[ids], counts)].tobytes()
        ends = np.concatenate([[0], np.cumsum(counts)])
        rows = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        ends = ends[np.concatenate([[0], rows])].tolist()
        texts = [data[s:e].decode("utf-8", "replace") for s, e in pairwise(ends)]
        return pa.array(texts, type=pa.string())

    apply.__annotations__ = {"lists": pa.Array, "return": pa.Array}
    return F.arrow_udf(apply, "string")(ids)


def _bytes_of(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens, one after the other, and how many each has."""
    tokens = Vocabulary(path).bytes_of
    return np.frombuffer(b"".join(tokens), dtype=np.uint8), np.array([len(t) for t in tokens], dtype=np.int64)


def round_trip(df: DataFrame, text_column: str, path: str) -> DataFrame:
    """``df`` with ``ids`` and ``decoded``, which replace columns of these names."""
    checked(df, text_column)
    df = df.withColumn("_llm_ids", encode(F.col(f"`{text_column}`"), path))
    ids = F.col("_llm_ids")
    return with_columns(df, {"ids": ids, "decoded": decode(ids, path)}).drop("_llm_ids")
