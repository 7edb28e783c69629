"""BPE encoding with an index of pair occurrences, and decoding.

A tokenizer file with word ends (vocabulary and merges) is read on the driver and sent to
the tasks as arrays.  A task cuts its texts into words, looks up those it has met before
and encodes all new words of a chunk together: the index maps each pair's rank to all its
positions in the chunk; active ranks are applied in ascending order, each to all its
positions at once, and only the lists of pairs beside a merge are updated.

That order gives each word the tokens of merging it on its own as long as no merge makes
a symbol that a pair of lower rank uses; ``load`` refuses other files.

Defined cases: null and empty texts have no tokens; null and repeated ``doc_id`` are kept,
one output row for each input row; other columns are ignored; memory is bounded by a chunk
of texts, or by the longest text, and a word table of ``KNOWN_WORDS``.  Words are told apart
by 64-bit hashes: of letters and their places, and BLAKE2 for more than 64 letters.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from plaudit.llm.chunks import LONG_WORD, released, text_chunks, texts_of, word_digest

KNOWN_WORDS = 1_000_000
WORDS_AT_ONCE = 300_000  # new words in one pair index
BLOCK_BYTES = 4_000_000  # text whose new words are encoded together
ROW_CHARS = 250_000  # text cut into words at once
END = "</w>"
SHIFT = 20  # bits for the right symbol of a pair
BLANK, LETTER, ALONE, SIGN, UNSEEN = range(5)

# The tokenizer's white space, and the endings that an apostrophe takes along.
SPACE = {9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@dataclass(frozen=True)
class Rules:
    tokens: list[str]
    byte_ids: np.ndarray  # of a byte inside a word
    end_ids: np.ndarray  # of a word's last byte
    pairs: np.ndarray  # ascending left << SHIFT | right
    ranks: np.ndarray  # of `pairs`
    made: np.ndarray  # symbol by rank
    specials: dict[str, int]


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself, or a letter past the first 256."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(shown))
    return [letters[b] for b in range(256)]


def load(path: str) -> Rules:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    if model["type"] != "BPE" or model["end_of_word_suffix"] != END:
        raise ValueError("expected a BPE tokenizer with word ends")
    vocab = model["vocab"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    made_at = {a + b: rank for rank, (a, b) in enumerate(merges)}
    late = any(made_at.get(symbol, -1) > rank for rank, pair in enumerate(merges) for symbol in pair)
    if late or len(made_at) < len(merges):
        raise ValueError("merges of this file do not go in ascending order")
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [""] * (1 + max([*vocab.values(), *specials.values()]))
    for token, i in [*vocab.items(), *specials.items()]:
        tokens[i] = token
    pairs = np.array([vocab[a] << SHIFT | vocab[b] for a, b in merges], dtype=np.int64)
    order = np.argsort(pairs)
    letters = byte_letters()
    return Rules(
        tokens,
        np.array([vocab[c] for c in letters], dtype=np.int32),
        np.array([vocab[c + END] for c in letters], dtype=np.int32),
        pairs[order],
        order.astype(np.int32),
        np.array([vocab[a + b] for a, b in merges], dtype=np.int32),
        specials,
    )


class PairIndex:
    """Symbols of many words in one row of positions, and the positions of each pair."""

    def __init__(self, rules: Rules, words: list[bytes]):
        self.rules = rules
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        self.ends = np.cumsum(lengths)
        size = len(data)
        self.symbol = rules.byte_ids[data]
        self.symbol[self.ends - 1] = rules.end_ids[data[self.ends - 1]]
        self.next = np.arange(1, size + 1, dtype=np.int32)
        self.next[self.ends - 1] = -1
        self.prev = np.arange(-1, size - 1, dtype=np.int32)
        self.prev[self.ends - lengths] = -1
        self.alive = np.ones(size, dtype=bool)
        self.merged = np.zeros(size, dtype=bool)
        self.rank = np.full(size, -1, dtype=np.int32)
        self.lists: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self._enter(np.flatnonzero(self.next >= 0).astype(np.int32))

    def _enter(self, positions: np.ndarray) -> None:
        """Look up the pairs that now begin at ``positions`` and list them by rank."""
        rules = self.rules
        key = self.symbol[positions].astype(np.int64) << SHIFT | self.symbol[self.next[positions]]
        at = np.searchsorted(rules.pairs, key)
        at[at == len(rules.pairs)] = 0
        rank = np.where(rules.pairs[at] == key, rules.ranks[at], -1)
        self.rank[positions] = rank
        known = rank >= 0
        positions, rank = positions[known], rank[known]
        if not len(rank):
            return
        order = np.argsort(rank, kind="stable")
        positions, rank = positions[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        starts = [0, *cuts.tolist(), len(rank)]
        for r, start, end in zip(rank[starts[:-1]].tolist(), starts, starts[1:]):
            if r in self.lists:
                self.lists[r].append(positions[start:end])
            else:
                self.lists[r] = [positions[start:end]]
                heapq.heappush(self.active, r)

    def _apart(self, positions: np.ndarray) -> np.ndarray:
        """Of a pair of equal symbols: every other occurrence in a row of them, from the left."""
        kept, last = [], -1
        for p in positions.tolist():
            if p != last:
                kept.append(p)
                last = self.next[p]
        return np.array(kept, dtype=positions.dtype)

    def apply(self) -> None:
        while self.active:
            r = heapq.heappop(self.active)
            found = self.lists.pop(r)
            at = np.sort(np.concatenate(found)) if len(found) > 1 else found[0]
            at = at[self.alive[at] & (self.rank[at] == r)]
            at = at[np.diff(at, prepend=-1) > 0]
            if not len(at):
                continue
            right = self.next[at]
            if self.symbol[at[0]] == self.symbol[right[0]]:
                at = self._apart(at)
                right = self.next[at]
            after = self.next[right]
            self.symbol[at] = self.rules.made[r]
            self.alive[right] = False
            self.next[at] = after
            self.rank[at] = -1
            follows = after >= 0
            self.prev[after[follows]] = at[follows]
            left = self.prev[at]
            # in a row of merges the pair left of one is the pair right of another
            self.merged[at] = True
            left = left[(left >= 0) & ~self.merged[left]]
            self.merged[at] = False
            self._enter(np.concatenate([left, at[follows]]))

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are left, and how many of them each word has."""
        left = np.cumsum(self.alive)
        return self.symbol[self.alive], np.diff(left[self.ends - 1], prepend=0)


class WordCutter:
    """Cuts a row of texts into words without making a string of each: the words of the
    tokenizer's pattern as (start, end, 64-bit hash)."""

    def __init__(self, specials: dict[str, int]):
        codes = np.arange(sys.maxunicode + 1, dtype=np.uint64)
        mixed = codes * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        self.mixed = mixed ^ (mixed >> np.uint64(32))
        self.kind = np.full(len(codes), UNSEEN, dtype=np.uint8)
        # a number for each place of a word
        self.place = np.random.default_rng(7).integers(0, 1 << 64, LONG_WORD, dtype=np.uint64)
        # a lone surrogate, which no text holds, stands for a special token
        self.stand_in = {token: chr(0xD800 + n) for n, token in enumerate(specials)}
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True))) or r"(?!)")

    def plain(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        # letter by letter: a capital sigma at a word's end is an ordinary one
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def normal(self, text: str) -> str:
        if not any(token in text for token in self.stand_in):
            return self.plain(text)
        parts, at = [], 0
        for m in self.special.finditer(text):
            parts += [self.plain(text[at : m.start()]), self.stand_in[m[0]]]
            at = m.end()
        return "".join(parts) + self.plain(text[at:])

    def _kinds(self, codes: np.ndarray) -> np.ndarray:
        seen = np.zeros(len(self.kind), dtype=bool)
        seen[codes] = True
        for code in np.flatnonzero(seen & (self.kind == UNSEEN)).tolist():
            group = unicodedata.category(chr(code))[0]
            alone = group == "N" or 0xD800 <= code < 0xE000
            self.kind[code] = BLANK if code in SPACE else ALONE if alone else LETTER if group == "L" else SIGN
        return self.kind[codes]

    def hashes(self, codes: np.ndarray, starts: np.ndarray, blank: np.ndarray) -> np.ndarray:
        within = np.arange(len(codes)) - np.repeat(starts, np.diff(starts, append=len(codes)))
        np.minimum(within, LONG_WORD - 1, out=within)
        terms = self.mixed[codes] ^ self.place[within]
        terms *= np.uint64(0x9FB21C651E98DF25)
        terms ^= terms >> np.uint64(28)
        terms[blank] = 0
        return np.add.reduceat(terms, starts)

    def cut(self, joined: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self._kinds(codes)
        before = np.concatenate([[BLANK], kind[:-1]])
        blank = kind == BLANK
        start = ~blank & ((kind != before) | (kind == ALONE))
        self._contract(codes, kind, start)
        starts = np.flatnonzero(start)
        if not len(starts):
            return starts, starts, starts.astype(np.uint64)
        lead = starts[0]
        hashes = self.hashes(codes[lead:], starts - lead, blank[lead:])
        blanks = np.concatenate([[0], np.cumsum(blank)])
        following = np.append(starts[1:], len(codes))
        ends = following - (blanks[following] - blanks[starts])
        for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
            hashes[i] = word_digest(codes[starts[i] : ends[i]].tobytes())
        return starts, ends, hashes

    @staticmethod
    def _contract(codes: np.ndarray, kind: np.ndarray, start: np.ndarray) -> None:
        """An apostrophe that opens a word takes one of the endings along."""
        at = np.flatnonzero(start[:-1] & (codes[:-1] == ord("'")))
        for ending in CONTRACTIONS:
            here = at[at + len(ending) < len(codes)]
            for n, letter in enumerate(ending, 1):
                here = here[codes[here + n] == ord(letter)]
            start[here + 1] = False
            after = here + 1 + len(ending)
            after = after[after < len(codes)]
            start[after[kind[after] == LETTER]] = True


class Encoder:
    """Encodes blocks of texts; remembers words, by hash, up to a bound."""

    def __init__(self, rules: Rules):
        self.rules = rules
        self.cutter = WordCutter(rules.specials)
        self._forget()

    def _forget(self) -> None:
        self.known = pd.Index(np.zeros(0, np.uint64))
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.symbols = np.zeros(0, np.int32)
        ids = np.array(list(self.rules.specials.values()), np.int32)
        if len(ids):
            _, _, hashes = self.cutter.cut("".join(self.cutter.stand_in.values()))
            self._learn(hashes, ids, np.ones(len(ids), np.int64))

    def _learn(self, hashes: np.ndarray, symbols: np.ndarray, lengths: np.ndarray) -> None:
        self.known = pd.Index(np.concatenate([self.known.to_numpy(), hashes]))
        self.start = np.concatenate([self.start, len(self.symbols) + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.symbols = np.concatenate([self.symbols, symbols])

    def _rows(self, texts: list[str]) -> Iterator[list[str]]:
        """Stretches of normalised texts of bounded size."""
        row, size = [], 0
        for text in texts:
            row.append(self.cutter.normal(text))
            size += len(text) + 1
            if size >= ROW_CHARS:
                yield row
                row, size = [], 0
        if row:
            yield row

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For stretches of the texts in order: all ids in a row, and the number of each text's."""
        rows, cuts = [], []
        for row in self._rows(texts):
            joined = "\n".join(row)
            starts, ends, hashes = self.cutter.cut(joined)
            text_ends = np.cumsum(np.fromiter(map(len, row), np.int64, len(row)) + 1)
            words = np.diff(np.searchsorted(starts, text_ends), prepend=0)
            rows.append(joined)
            cuts.append((starts.astype(np.int32), ends.astype(np.int32), hashes, words))
        codes, distinct = pd.factorize(np.concatenate([cut[2] for cut in cuts]) if cuts else np.zeros(0, np.uint64))
        at = self.known.get_indexer(distinct)
        if len(self.known) + np.count_nonzero(at < 0) > KNOWN_WORDS:
            self._forget()
            at = self.known.get_indexer(distinct)
        new = np.flatnonzero(at < 0)
        first = np.zeros(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        bounds = np.concatenate([[0], np.cumsum([len(cut[0]) for cut in cuts], dtype=np.int64)])
        for block in np.array_split(new, max(1, -(-len(new) // WORDS_AT_ONCE))):
            if not len(block):
                continue
            which = np.searchsorted(bounds, first[block], side="right") - 1
            words = []
            for n, place in zip(which.tolist(), (first[block] - bounds[which]).tolist()):
                words.append(rows[n][cuts[n][0][place] : cuts[n][1][place]].encode())
            index = PairIndex(self.rules, words)
            index.apply()
            at[block] = len(self.known) + np.arange(len(block))
            self._learn(distinct[block], *index.result())
        for n, (_, _, _, words) in enumerate(cuts):
            place = at[codes[bounds[n] : bounds[n + 1]]]
            lengths = self.length[place]
            before = np.concatenate([[0], np.cumsum(lengths)])
            ids = self.symbols[np.repeat(self.start[place] - before[:-1], lengths) + np.arange(before[-1])]
            yield ids, np.diff(before[np.cumsum(words)], prepend=0)


def decode_ids(tokens: np.ndarray, ids: np.ndarray) -> str:
    """Tokens joined by blanks, as the library decodes for a file without a decoder."""
    return " ".join(tokens[ids].tolist())


def encoded_chunks(batches: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Stretches of the batches with all their ids and the offset at which each row's begin."""
    encoder = Encoder(rules)
    for batch in batches:
        for block in text_chunks(batch, most=BLOCK_BYTES):
            at = 0
            for ids, counts in encoder.encode(texts_of(block)):
                yield block.slice(at, len(counts)), ids, np.concatenate([[0], np.cumsum(counts)])
                at += len(counts)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` of each whole text."""
    rules = load(path)

    def run(batches):
        for chunk, ids, offsets in encoded_chunks(batches, rules):
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), lists], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(released(run), f"doc_id {_id_type(docs)}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and the decoded ``text`` of ``ids``."""
    names = load(path).tokens

    def run(batches):
        tokens = np.array(names, dtype=object)
        for batch in batches:
            lists = batch.column("ids").to_pylist()
            texts = [decode_ids(tokens, np.array(ids or [], dtype=np.int64)) for ids in lists]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(released(run), f"doc_id {_id_type(encoded)}, text string")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """Count and digests of each text's ids and of what they decode to, made in one pass."""
    rules = load(path)

    def run(batches):
        tokens = np.array(rules.tokens, dtype=object)
        for chunk, ids, offsets in encoded_chunks(batches, rules):
            parts = [ids[a:b] for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id"),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array([hashlib.sha256(part.astype("<u4").tobytes()).hexdigest() for part in parts], pa.string()),
                    pa.array([hashlib.sha256(decode_ids(tokens, part).encode()).hexdigest() for part in parts], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        released(run), f"doc_id {_id_type(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _id_type(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()
