"""Byte-level BPE: encoding with a queue of merge ranks over a linked list of symbols, and decoding.

A text is cut at special tokens, then into words by the vocabulary's pattern. In a word, every
adjacent pair with a merge rank enters a priority queue; the lowest rank is merged first, the
symbol list is relinked and new pairs are queued. Entries whose symbols have changed meanwhile
are stale and skipped. Decoding concatenates the byte strings of the ids.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from operator import itemgetter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlab.llm.common import pieces, process_cache, share, small_batches

# Fixed values of the byte-level alphabet and the word pattern.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
# The same words where all characters are below U+0100; the standard library is faster there.
LETTER, NUMBER, BLANK = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
LATIN_PATTERN = (
    rf"(?: [{LETTER}]|[{LETTER}])[{LETTER}]*+|'(?:[stmd]|re|ve|ll)| ?[^{BLANK}{LETTER}{NUMBER}]++| ?[{NUMBER}]++"
    rf"|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"
)
BEYOND_LATIN = re.compile("[^\x00-\xff]").search
# Words whose ids a worker remembers; beyond it the memory is cleared, not the result.
REMEMBERED = 700_000


class Vocabulary:
    """Ids, merge ranks and special tokens of a byte-level BPE vocabulary (JSON text)."""

    def __init__(self, content: str):
        spec = json.loads(content)
        other = iter(range(256, 512))
        letter = {b: chr(b) if b in set(PRINTABLE) else chr(next(other)) for b in range(256)}
        byte = {c: b for b, c in letter.items()}
        ids = spec["model"]["vocab"]
        self.first = [ids[letter[b]] for b in range(256)]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.ranks = {ids[a] << 20 | ids[b]: rank for rank, (a, b) in enumerate(merges)}
        self.merged = [ids[a + b] for a, b in merges]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            self.strings[i] = bytes(byte[c] for c in token)
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.find, self.find_latin = regex.compile(PATTERN).findall, re.compile(LATIN_PATTERN).findall
        self.known = Remembered(self)

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word. A queue entry is a merge rank and the place of its left symbol."""
        ids = [self.first[b] for b in word]
        n = len(ids)
        if n == 1:
            return ids
        rank_of, merged = self.ranks.get, self.merged
        width = n.bit_length()
        place = (1 << width) - 1
        queue = [r << width | i for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := rank_of(a << 20 | b)) is not None]
        heapify(queue)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        ids.append(-1)
        while queue:
            entry = heappop(queue)
            i, rank = entry & place, entry >> width
            j = after[i]
            if ids[i] < 0 or rank_of(ids[i] << 20 | ids[j]) != rank:
                continue  # stale: one of the two symbols has changed
            new = ids[i] = merged[rank]
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of(new << 20 | ids[k])) is not None:
                    heappush(queue, r << width | i)
            h = before[i]
            if h >= 0 and (r := rank_of(ids[h] << 20 | new)) is not None:
                heappush(queue, r << width | h)
        return [i for i in ids if i >= 0]

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        words = self.known.__getitem__
        find = self.find if BEYOND_LATIN(text) else self.find_latin
        if not self.cut or not self.cut.search(text):
            return b"".join(map(words, find(text)))
        parts = self.cut.split(text)
        return b"".join(b"".join(map(words, find(p))) if k % 2 == 0 else little([self.special[p]]) for k, p in enumerate(parts))

    def decode(self, ids: bytes) -> str:
        places = memoryview(ids).cast("I").tolist()
        found = itemgetter(*places)(self.strings) if len(places) > 1 else [self.strings[i] for i in places]
        return b"".join(found).decode("utf-8", "replace")


def little(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Remembered(dict):
    """Ids of words already seen, filled by the merge queue."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> bytes:
        ids = little(self.vocabulary.merge(word.encode()))
        if len(word) <= 64:
            self[word] = ids
        return ids


def encode(docs: DataFrame, vocabulary_path: str, text: str = "text", keep_ids: bool = True) -> DataFrame:
    """All columns of ``docs`` but the text, with the text's encoding.

    Adds ``n_tokens`` long, ``ids`` array<int> (if ``keep_ids``), ``ids_sha256`` and
    ``decoded_sha256`` (hex). A NULL text counts as empty: no ids, digests of nothing. Repeated
    rows stay repeated; other columns pass through, except that columns named like the new ones
    are replaced. An empty table gives an empty result with the same columns.
    """
    small_batches(docs.sparkSession)
    with open(vocabulary_path, encoding="utf-8") as f:
        content = f.read()
    shared = share(docs.sparkSession, content, "bpe")
    new = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if keep_ids else [])]
    kept = [c for c in docs.columns if c != text and c not in new]
    source = docs.select(*(f"`{c}`" for c in kept), F.coalesce(f"`{text}`", F.lit("")).alias("text") if text in docs.columns else F.lit("").alias("text"))
    kinds = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in kept)
    schema = f"{kinds}{', ' if kept else ''}n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = process_cache("bpe")
        if vocabulary_path not in cache:
            cache[vocabulary_path] = Vocabulary(shared())
        vocabulary = cache[vocabulary_path]
        for batch in pieces(batches):
            n, a, b, ids = [], [], [], []
            for value in batch.column(batch.num_columns - 1).to_pylist():
                code = vocabulary.encode(value)
                n.append(len(code) // 4)
                a.append(hashlib.sha256(code).hexdigest())
                b.append(hashlib.sha256(vocabulary.decode(code).encode()).hexdigest())
                if keep_ids:
                    ids.append(memoryview(code).cast("i").tolist())
            columns = [*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, [*kept, *new[:3], *new[3:]])

    return source.mapInArrow(run, schema)
