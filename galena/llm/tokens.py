"""Encoding by a public byte-level BPE vocabulary: propose greedily, verify pairs, repair only what fails."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The pattern that splits text into words before merging; a fixed value of the vocabulary.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = os.environ.get("GALENA_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
_kept: dict[str, "Encoder"] = {}


class Encoder:
    """A rank file's encoder. The rank of a token is its id and the order in which it was merged.

    A word's encoding is right if every adjacent pair of tokens is: if merging the bytes of the pair gives these two
    tokens. So a greedy longest-match proposal is tested pair by pair, all pairs of all words in one go, and merging
    in rank order is done only for words with a pair that fails."""

    def __init__(self, path: str):
        self.ranks: dict[bytes, int] = {}
        with open(path, "rb") as f:
            for line in f:
                if line.strip():
                    token, rank = line.split()
                    self.ranks[base64.b64decode(token)] = int(rank)
        self.longest = max(map(len, self.ranks))
        n = max(self.ranks.values()) + 1
        # the two tokens that were merged into each token; of a single byte the token itself
        self.left, self.right = np.arange(n), np.arange(n)
        pairs = {}
        for token, rank in self.ranks.items():
            if len(token) > 1:
                a, b = self._merge(token, rank)
                self.left[rank], self.right[rank] = a, b
                pairs[(a << 32) | b] = rank
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.words: dict[str, np.ndarray] = {}

    def _merge(self, word: bytes, below: int) -> list[int]:
        """Exact merging of the bytes by ranks less than below."""
        ids = [self.ranks[word[i : i + 1]] for i in range(len(word))]
        texts = [word[i : i + 1] for i in range(len(word))]
        if len(word) > 200:
            return self._merge_long(texts, below)
        while len(texts) > 1:
            best, at = below, -1
            for i in range(len(texts) - 1):
                r = self.ranks.get(texts[i] + texts[i + 1], below)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            texts[at : at + 2] = [texts[at] + texts[at + 1]]
            ids[at : at + 2] = [best]
        return ids

    def _merge_long(self, texts: list[bytes], below: int) -> list[int]:
        """The same with a heap over a linked list, for words of any length."""
        import heapq

        n = len(texts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def push(i: int) -> None:
            j = after[i]
            if j < n and (r := self.ranks.get(texts[i] + texts[j], below)) < below:
                heapq.heappush(heap, (r, i, len(texts[i]), len(texts[j])))

        for i in range(n - 1):
            push(i)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if len(texts[i]) != a or j >= n or len(texts[j]) != b:
                continue
            texts[i] += texts[j]
            texts[j] = b""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [self.ranks[t] for t in texts if t]

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether merging would keep each pair of tokens as it is: undoing merges on both sides of the seam, from the
        latest, no earlier merge across the seam may exist."""
        ok = np.ones(len(first), bool)
        rest = np.arange(len(first))
        a, b = first.copy(), second.copy()
        limit = np.full(len(first), np.iinfo(np.int64).max)
        while len(rest):
            key = (a << 32) | b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            wrong = (self.pair_keys[at] == key) & (self.pair_ranks[at] < limit)
            ok[rest[wrong]] = False
            rest, a, b, limit = (x[~wrong] for x in (rest, a, b, limit))
            # undo the later of the two merges next to the seam; of equal tokens the right one was made last
            newer = a > b
            small_a, small_b = self.right[a] == a, self.left[b] == b
            over = small_a & small_b
            take_a = np.where(newer, ~small_a, small_b) & ~over
            take_b = ~take_a & ~over
            limit = np.where(take_a, a, np.where(take_b, b + 1, limit))
            a, b = np.where(take_a, self.right[a], a), np.where(take_b, self.left[b], b)
            keep = ~over
            rest, a, b, limit = (x[keep] for x in (rest, a, b, limit))
        return ok

    def learn(self, words: list[str]) -> None:
        """Adds the encodings of words not met before."""
        if len(self.words) > 400_000:  # memory only: a word met again is encoded again
            self.words.clear()
        fresh = [w for w in words if w not in self.words]
        ranks, flat, counts, raw = self.ranks, [], [], []
        for w in fresh:
            b = w.encode("utf-8", "surrogatepass")
            raw.append(b)
            whole = ranks.get(b)
            if whole is not None:
                flat.append(whole)
                counts.append(1)
                continue
            i, n, k = 0, len(b), 0
            while i < n:
                for j in range(min(n, i + self.longest), i, -1):
                    r = ranks.get(b[i:j])
                    if r is not None:
                        flat.append(r)
                        k += 1
                        i = j
                        break
            counts.append(k)
        ids, counts = np.array(flat, np.int64), np.array(counts, np.int64)
        ends = np.cumsum(counts)
        inner = np.ones(len(ids), bool)
        inner[ends - 1] = False
        seam = np.flatnonzero(inner)
        owner = np.repeat(np.arange(len(fresh)), counts)
        bad = np.zeros(len(fresh), bool)
        if len(seam):
            bad[owner[seam[~self.compatible(ids[seam], ids[seam + 1])]]] = True
        ids = ids.astype(np.int32)
        top = len(ranks) + 1 << 1
        for w, b, s, e, wrong in zip(fresh, raw, (ends - counts).tolist(), ends.tolist(), bad.tolist()):
            self.words[w] = np.array(self._merge(b, top), np.int32) if wrong else ids[s:e].copy()

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets of the texts); none for null and empty texts."""
        split = regex.compile(WORDS).findall
        parts, sizes = [], np.zeros(len(texts), np.int64)
        at, start = 0, 0
        out = []
        while start < len(texts):
            words, ends, chars, stop = [], [], 0, start
            while stop < len(texts) and chars < 4_000_000:
                t = texts[stop]
                if t:
                    words += split(t)
                    chars += len(t)
                ends.append(len(words))
                stop += 1
            self.learn(list(dict.fromkeys(words)))
            known = self.words
            got = [known[w] for w in words]
            n = np.array([len(g) for g in got], np.int64)
            total = np.concatenate([[0], np.cumsum(n)])
            edge = total[np.array([0, *ends])]
            sizes[start:stop] = np.diff(edge)
            if got:
                out.append(np.concatenate(got))
            start = stop
        return (np.concatenate(out) if out else np.zeros(0, np.int32)), np.concatenate([[0], np.cumsum(sizes)])


def encoder(path: str) -> Encoder:
    """The encoder of a file, kept in the Python worker."""
    if path not in _kept:
        _kept[path] = Encoder(path)
    return _kept[path]


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids): the token ids of each text by a byte-level BPE rank file, without special tokens (their strings
    are ordinary text). Null and empty texts give an empty list. One row per row, repeated rows included, whole texts
    whatever their length; other columns don't matter. The vocabulary file must exist at the same path on every
    executor. Words met before are looked up; the table of words is bounded and only saves time."""
    schema = df.select(F.col(key)).schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(vocabulary)
        for b in batches:
            ids, offsets = e.encode(b.column(1).to_pylist())
            start = 0
            while start < b.num_rows:  # lists of at most some 64 MB a batch
                stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + 16_000_000, "right")) - 1)
                lists = pa.ListArray.from_arrays(pa.array((offsets[start : stop + 1] - offsets[start]).astype(np.int32)), pa.array(ids[offsets[start] : offsets[stop]]))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, stop - start), lists], [key, "ids"])
                start = stop

    return df.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, n_tokens) by the same encoding, without handing the ids on."""
    schema = df.select(F.col(key)).schema.add("n_tokens", T.IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(vocabulary)
        for b in batches:
            _, offsets = e.encode(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(offsets).astype(np.int32))], [key, "n_tokens"])

    return df.select(F.col(key), F.col(text)).mapInArrow(run, schema)
