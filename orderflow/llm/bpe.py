"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the rest by merges from a heap."""

from __future__ import annotations

import base64
import gc
import hashlib
import heapq
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession

from orderflow.llm.base import extended, kept, mix, pieces, table

#: Pre-tokens whose ids a worker remembers, about (230 bytes each); beyond it the older half of them is forgotten.
REMEMBERED = 3 << 17
#: Bytes of text that a task holds at once, or one document.
PIECE_BYTES = 2 << 20


class PerfectHash:
    """A minimal perfect hash of byte strings to their numbers (hash, displace, compare).

    Keys fall into buckets of four on average. Largest first, a bucket gets the first displacement that moves
    all its keys to free slots; a bucket of one key names its slot. There are as many slots as keys, and a lookup
    compares the one key that can be there, so strings outside the set are told apart for certain.
    """

    def __init__(self, numbers: dict[bytes, int]):
        self.size, self.buckets = len(numbers), max(1, len(numbers) // 4)
        groups: dict[int, list[tuple[int, bytes]]] = {}
        for key in numbers:
            value = xxhash.xxh3_64_intdigest(key)
            groups.setdefault(value % self.buckets, []).append((value, key))
        self.moves = np.zeros(self.buckets, dtype=np.int64)
        self.keys: list[bytes | None] = [None] * self.size
        free = np.ones(self.size, dtype=bool)
        tries = np.arange(512, dtype=np.uint64)[:, None]
        size = np.uint64(self.size or 1)
        for bucket, members in sorted(groups.items(), key=lambda g: (-len(g[1]), g[0])):
            if len(members) == 1:
                break
            values = np.array([value for value, _ in members], dtype=np.uint64)
            start = 0
            while True:
                slots = mix(values ^ (tries + np.uint64(start))) % size
                fits = free[slots].all(axis=1)
                found = next((i for i in np.flatnonzero(fits) if len(set(slots[i].tolist())) == len(members)), None)
                if found is not None:
                    break
                start += len(tries)
            self.moves[bucket] = start + int(found)
            for slot, (_, key) in zip(slots[found].tolist(), members, strict=True):
                self.keys[slot] = key
                free[slot] = False
        rest = iter(np.flatnonzero(free).tolist())
        for bucket, members in sorted(groups.items()):
            if len(members) == 1:
                slot = next(rest)
                self.keys[slot], self.moves[bucket] = members[0][1], -slot - 1
        self.numbers = [numbers[k] if k is not None else -1 for k in self.keys]

    def get_all(self, keys: list[bytes]) -> list[int]:
        """The number of each key, or -1 if it is not in the set."""
        if not self.size or not keys:
            return [-1] * len(keys)
        values = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
        moves = self.moves[(values % np.uint64(self.buckets)).astype(np.int64)]
        moved = mix(values ^ moves.astype(np.uint64)) % np.uint64(self.size)
        slots = np.where(moves < 0, -moves - 1, moved.astype(np.int64)).tolist()
        own, numbers = self.keys, self.numbers
        return [numbers[s] if own[s] == k else -1 for s, k in zip(slots, keys, strict=True)]

    def get(self, key: bytes) -> int:
        return self.get_all([key])[0]


def ranks_of(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _odd_characters() -> str:
    """A class of the characters whose kind Python's ``re`` and the Unicode properties tell differently."""
    odd = [c for c in range(0x10000) if unicodedata.category(chr(c)) in ("Nl", "No", "Cn", "Cs") or 0x1C <= c <= 0x1F]
    cuts = [i for i in range(1, len(odd)) if odd[i] != odd[i - 1] + 1]
    runs = [(odd[a], odd[b - 1]) for a, b in zip([0, *cuts], [*cuts, len(odd)], strict=True)]
    return "[" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs) + "\\U00010000-\\U0010ffff]"


def splitter(pattern: str):
    """A function that splits a text into the matches of ``pattern``.

    The standard ``re`` is twice as fast as ``regex`` but knows no Unicode properties. Where a text holds only
    characters on which its classes agree with them, the pattern is run in that form.
    """
    exact = regex.compile(pattern).findall
    quick = (pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]")
             .replace(r"\p{N}", r"\d"))
    if "\\p" in quick:
        return exact
    quick, odd = re.compile(quick).findall, re.compile(_odd_characters()).search
    return lambda text: exact(text) if odd(text) else quick(text)


class Codec:
    """Encodes and decodes texts by a table of ranks, each match of ``pattern`` by itself, without special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.find = splitter(pattern)
        self.whole = PerfectHash(ranks)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.text_of = {rank: str(rank) for rank in self.bytes_of}
        self.single = [ranks[bytes([b])] for b in range(256)]
        #: One number object per id, which all remembered ids share.
        self.number = {rank: rank for rank in self.bytes_of}
        #: Rank of each pair of tokens that can merge: by the left id, then by the right one.
        self.after: dict[int, dict[int, int]] = {rank: {} for rank in self.bytes_of}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                if token[:i] in ranks and token[i:] in ranks:
                    self.after[ranks[token[:i]]][ranks[token[i:]]] = rank
        #: The same for pairs of bytes.
        self.byte_after = [{b: self.after[self.single[a]][self.single[b]] for b in range(256) if self.single[b] in self.after[self.single[a]]}
                           for a in range(256)]
        self.new: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of a pre-token outside the vocabulary.

        Bytes form a linked list; a heap holds rank and place of neighbours that can merge, lowest rank and then
        leftmost first. An entry whose neighbours have another rank by now is passed over. n bytes take
        O(n log n).
        """
        heap, end, left = [], len(word), word[0]
        for i in range(1, end):
            right = word[i]
            if (rank := self.byte_after[left].get(right)) is not None:
                heap.append(rank << 32 | i - 1)
            left = right
        ids = [self.single[b] for b in word]
        heapq.heapify(heap)
        after, before, rank_of = list(range(1, end + 1)), list(range(-1, end)), self.after
        pop, push, replace = heapq.heappop, heapq.heappush, heapq.heapreplace
        while heap:
            entry = heap[0]
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            j = after[i]
            if j >= end or ids[i] < 0 or rank_of[ids[i]].get(ids[j]) != rank:
                pop(heap)
                continue
            ids[i], ids[j] = rank, -1
            k = after[i] = after[j]
            taken = False  # the entry's place in the heap goes to the first new one
            if k < end:
                before[k] = i
                if (more := rank_of[rank].get(ids[k])) is not None:
                    replace(heap, more << 32 | i)
                    taken = True
            h = before[i]
            if h >= 0 and (more := rank_of[ids[h]].get(rank)) is not None:
                (push if taken else replace)(heap, more << 32 | h)
                taken = True
            if not taken:
                pop(heap)
        number = self.number
        return tuple([number[x] for x in ids if x >= 0])

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts; each distinct pre-token is looked up or merged once, those met lately are remembered."""
        found = [self.find(text) for text in texts]
        known, old = self.new, self.old
        fresh = []
        for p in set(chain.from_iterable(found)).difference(known):
            if (ids := old.get(p)) is None:
                fresh.append(p)
            else:
                known[p] = ids
        words = [p.encode() for p in fresh]
        for p, word, rank in zip(fresh, words, self.whole.get_all(words), strict=True):
            known[p] = (self.number[rank],) if rank >= 0 else self.merge(word)
        get = known.__getitem__
        result = [list(chain.from_iterable(map(get, f))) for f in found]
        if len(known) >= REMEMBERED // 2:
            # Long pre-tokens are few and large, so they are not kept.
            self.new, self.old = {}, {p: ids for p, ids in known.items() if len(p) <= 64}
        return result

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def encoded(docs: DataFrame, path: str, pattern: str, column: str = "text", digests: bool = False) -> DataFrame:
    """``docs`` with the token ids of ``column`` as ``ids`` and the bytes that they decode to as ``decoded``.

    With ``digests``, instead: ``n_tokens``, ``ids_sha256`` of the decimal ids joined by commas, and
    ``decoded_sha256``; the ids are then never held as rows. ``path`` is the vocabulary's file, read on the driver; its
    size (a megabyte) bounds what is broadcast. Null is encoded as an empty text, which has no tokens. Rows are
    encoded one by one, so copies, hot sources and very long texts change nothing; an empty table gives an empty
    one. ``docs`` must not have columns of the names added. Spark strings are valid UTF-8.
    """
    added = {"n_tokens", "ids_sha256", "decoded_sha256"} if digests else {"ids", "decoded"}
    if clash := added & set(docs.columns):
        raise ValueError(f"columns of these names are there already: {sorted(clash)}")
    ranks = docs.sparkSession.sparkContext.broadcast(ranks_of(path))
    names = docs.columns

    def rows(batches):
        own = kept(f"codec {path} {pattern}", lambda: Codec(ranks.value, pattern))
        gc.disable()  # what is remembered holds no cycles, and walking it again and again takes a tenth of the time
        for batch in pieces(batches, PIECE_BYTES, column):
            ids = own.encode_all([t or "" for t in batch.column(column).to_pylist()])
            decoded = [own.decode(x) for x in ids]
            if digests:
                sums = [hashlib.sha256(",".join(map(own.text_of.__getitem__, x)).encode()).hexdigest() for x in ids]
                extra = [pa.array([len(x) for x in ids], pa.int64()), pa.array(sums, pa.string()),
                         pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string())]
                keep = [n for n in names if n != column]
            else:
                extra, keep = [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.binary())], names
            labels = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in keep], *extra], names=[*keep, *labels])

    extra = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded binary"
    return docs.mapInArrow(rows, extended(docs.drop(column).schema if digests else docs.schema, extra))


def vocabulary() -> tuple[str, str]:
    """The multilingual vocabulary's file and the pattern that goes with it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op9_two_tier_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return encoded(docs, *vocabulary(), digests=True)
