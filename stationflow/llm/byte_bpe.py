"""Byte-level BPE: whole texts to ids and back, merged in rounds over many words at once."""

from __future__ import annotations

import heapq
import json
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from stationflow.llm.common import appended
from stationflow.llm.packing import REMEMBERED_WORDS, _byte_letters

# Fixed value: how byte-level tokenizers of this kind split a text into words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

#: A character outside these blocks may be a letter or number to one Unicode version and not to
#: another; a text that holds one is split by the tokenizer library's own splitter.
UNSETTLED = re.compile(r"[^\u0000-\u052f\u2000-\u206f\u20a0-\u2bff\u3000-\u9fff\uac00-\ud7a3]")

#: Rounds in which each word merges its lowest pair. Words that are not done then are long; they go
#: on pair by pair over linked symbols, where a round costs no more than what it merges.
ROUNDS = 48

NONE = np.iinfo(np.int32).max


class ByteBPE:
    """A byte-level BPE model from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splitter = spec["model"], spec.get("pre_tokenizer") or {}
        plain = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
        odd = [model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")]
        odd += [spec.get("normalizer"), *[t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")]]
        if not plain or any(odd):
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        self.path, self.splitter, vocab = path, None, model["vocab"]
        letters = _byte_letters()
        self.byte_ids = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([vocab[m[i]] for m in merges], np.int64) for i in (0, 1))
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.base = max(vocab.values()) + 1
        born = np.full(self.base, -1)
        born[self.merged] = np.arange(len(merges))
        if np.any(np.maximum(born[left], born[right]) >= np.arange(len(merges))):
            raise ValueError(f"{path} merges symbols before it makes them")
        keys = left * self.base + right
        self.ranks = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.ranks]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.known: dict[str, bytes] = {}
        self.former: dict[str, bytes] = {}

        bytes_of = {letter: bytes([b]) for b, letter in letters.items()}
        tokens = {i: b"".join(bytes_of[c] for c in token) for token, i in vocab.items()}
        tokens |= {i: content.encode() for content, i in self.added.items()}
        table = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.token_sizes = np.array([len(t) for t in table], np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.token_bytes = np.frombuffer(b"".join(table), np.uint8)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols by binary search over the sorted pair keys, or NONE."""
        wanted = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit numbers."""
        sizes = np.array([len(w) for w in words], np.int64)
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done = []
        for _ in range(ROUNDS):
            if not len(word):
                break
            rank = np.full(len(word), NONE, np.int32)
            inside = np.flatnonzero(word[1:] == word[:-1])
            rank[inside] = self.pair_ranks(symbols[inside], symbols[inside + 1])
            heads = np.flatnonzero(np.diff(word, prepend=-1))
            lowest = np.minimum.reduceat(rank, heads)
            counts = np.diff(np.append(heads, len(word)))
            ready = np.repeat(lowest == NONE, counts)
            done.append((word[ready], symbols[ready]))
            chosen = np.flatnonzero((rank == np.repeat(lowest, counts)) & (rank != NONE))
            chosen = self.apart(chosen, np.append(-2, chosen[:-1]) == chosen - 1)
            symbols[chosen] = self.merged[rank[chosen]]
            keep = ~ready
            keep[chosen + 1] = False
            word, symbols = word[keep], symbols[keep]
        if len(word):
            done.append(self.merge_linked(word, symbols))
        word, symbols = (np.concatenate([d[i] for d in done]) if done else np.zeros(0, np.int64) for i in (0, 1))
        order = np.argsort(word, kind="stable")
        ends = 4 * np.cumsum(np.bincount(word, minlength=len(words)))
        data = symbols[order].astype("<u4").tobytes()
        return [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    @staticmethod
    def apart(chosen: np.ndarray, touches: np.ndarray) -> np.ndarray:
        """Of chosen pairs, in order, every second in each chain of pairs that touch the last one."""
        if not touches.any():
            return chosen
        heads = np.flatnonzero(~touches)
        place = np.arange(len(chosen)) - np.repeat(heads, np.diff(np.append(heads, len(chosen))))
        return chosen[place % 2 == 0]

    def merge_linked(self, word: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge what is left of all words, one pair of symbols a round in the order of ranks. A
        merge only makes pairs of higher rank, so that order is each word's own."""
        n = len(word)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[np.append(np.flatnonzero(np.diff(word)), n - 1)] = n
        before[np.append(0, np.flatnonzero(np.diff(word)) + 1)] = -1
        live, waiting, queue = np.ones(n, bool), defaultdict(list), []

        def enqueue(left: np.ndarray) -> None:
            left = left[after[left] < n]
            rank = self.pair_ranks(symbols[left], symbols[after[left]])
            order = np.argsort(rank, kind="stable")
            left, rank = left[order], rank[order]
            heads = np.flatnonzero(np.diff(rank, prepend=-1))
            for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(rank)]):
                if rank[a] != NONE:
                    if int(rank[a]) not in waiting:
                        heapq.heappush(queue, int(rank[a]))
                    waiting[int(rank[a])].append(left[a:b])

        enqueue(np.arange(n))
        while queue:
            rank = heapq.heappop(queue)
            left = np.unique(np.concatenate(waiting.pop(rank)))
            left = left[live[left]]
            left = left[after[left] < n]
            left = left[self.pair_ranks(symbols[left], symbols[after[left]]) == rank]
            left = self.apart(left, np.append(n, after[left[:-1]])[: len(left)] == left)
            gone = after[left]
            symbols[left], live[gone], after[left] = self.merged[rank], False, after[gone]
            following = left[after[left] < n]
            before[after[following]] = following
            enqueue(np.unique(np.concatenate([left, before[left][before[left] >= 0]])))
        return word[live], symbols[live]

    def split(self, text: str) -> list[str]:
        if text.isascii() or not UNSETTLED.search(text):
            return WORDS.findall(text)
        if self.splitter is None:
            from tokenizers import Tokenizer

            self.splitter = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit numbers; an added token's string is its id."""
        parts: list[list[str | bytes]] = []
        for text in texts:
            found: list[str | bytes] = []
            for i, piece in enumerate(self.special.split(text) if self.special else [text]):
                found += [np.array([self.added[piece]], "<u4").tobytes()] if i % 2 else self.split(piece)
            parts.append(found)
        if len(self.known) > REMEMBERED_WORDS:
            self.known, self.former = {}, self.known
        new = []
        for w in set().union(*parts).difference(self.known):
            if isinstance(w, bytes):
                continue
            if w in self.former:
                self.known[w] = self.former[w]
            else:
                new.append(w)
        self.known.update(zip(new, self.merge_words([w.encode() for w in new])))
        return [b"".join([w if isinstance(w, bytes) else self.known[w] for w in found]) for found in parts]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The text of each of some lists of ids; an id that no token has stands for nothing."""
        usable = (ids >= 0) & (ids < len(self.token_sizes))
        sizes = np.where(usable, self.token_sizes[np.where(usable, ids, 0)], 0)
        ends = np.cumsum(sizes)
        at = np.repeat(self.token_starts[np.where(usable, ids, 0)] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        data, cuts = self.token_bytes[at].tobytes(), np.append(0, ends)[bounds].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:])]


_MODELS: dict[str, ByteBPE] = {}


def byte_bpe(path: str) -> ByteBPE:
    """One for each Python worker and path."""
    if path not in _MODELS:
        _MODELS[path] = ByteBPE(path)
    return _MODELS[path]


def encode(docs: DataFrame, tokenizer: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add the ids of each whole text as an array ``out``.

    The words of a step of texts that are not remembered lie in one flat array of symbols; in each
    round every word merges its pair of lowest rank, all ranks found by one binary search. A worker
    remembers some 300,000 words in two generations and holds one step of texts, or one longer text;
    a word of n bytes costs about n log n.

    A null or empty text has no ids; the string of an added token is that token. Repeated rows are
    treated alike, an empty table gives no rows, other columns stay and one called ``out`` is
    replaced. Invalid UTF-8 is read with replacement characters. The file must be reachable under
    the same path by every worker."""

    def ids(texts: pa.Array) -> pa.Array:
        found = byte_bpe(tokenizer).encode([(t or b"").decode("utf-8", "replace") for t in texts.to_pylist()])
        bounds = np.cumsum([0, *[len(f) // 4 for f in found]])
        flat = np.frombuffer(b"".join(found), "<u4").astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))

    return appended(docs, out, "array<int>", ids, F.col(f"`{text}`").cast("binary"))


def decode(docs: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of each list of ids as ``out``, added tokens as their strings, bytes that are no
    UTF-8 as replacement characters.

    A null list is null, an empty one an empty text; null ids and ids without a token stand for
    nothing. Repeated rows are treated alike, an empty table gives no rows; other columns stay, one
    called ``out`` is replaced."""

    def texts(lists: pa.Array) -> pa.Array:
        offsets = lists.offsets.to_numpy()
        flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).fill_null(-1).to_numpy(zero_copy_only=False)
        found = byte_bpe(tokenizer).decode(flat.astype(np.int64), offsets - offsets[0])
        return pa.array(found, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))

    return appended(docs, out, "string", texts, F.col(f"`{ids}`"))
