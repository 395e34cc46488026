"""Benchmark passages in training text: a BM25 index of the test items, searched by every training passage.

The inverted index holds the items; its posting lists are cut into blocks with the largest
impact of each. Impacts are BM25 weights divided by the item's score against itself, so 1 means
that a passage holds all of an item. Every passage of every document (overlapping windows that
hold any item whole) is a query. A bound from the rarer terms of all passages of a slice at once
rules most of them out; the others run block-max WAND, which returns every item at or above the
threshold. A retrieved item counts when the passage overlaps both its question and its answer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlab.llm.common import U, Words, pieces, share, small_batches

K1, B = 1.2, 0.75
THRESHOLD = 0.6
# Most of an item's score that may come from terms the first bound leaves out.
LEFT_OUT = 0.2
OVERLAP = 0.5
BLOCK = 16
MIN_WORDS = 5
# Items of one index; a larger benchmark is searched index by index, each over all documents.
ITEMS_PER_INDEX = 20_000


@dataclass
class Posting:
    items: list[int]
    impacts: list[float]
    ends: list[int]  # last item of each block
    tops: list[float]  # largest impact of each block
    top: float


class Index:
    """Inverted index of items given as (id, word hashes, words of the question)."""

    def __init__(self, items: list[tuple[int, np.ndarray, int]]):
        self.ids = [i for i, _, _ in items]
        self.words = [w for _, w, _ in items]
        self.split = [q for _, _, q in items]
        self.longest = max(map(len, self.words))
        n, mean = len(items), float(np.mean(list(map(len, self.words))))
        held: dict[int, list[tuple[int, float]]] = {}
        counted = [np.unique(w, return_counts=True) for w in self.words]
        spread: dict[int, int] = {}
        for terms, _ in counted:
            for t in terms.tolist():
                spread[t] = spread.get(t, 0) + 1
        for i, (terms, tf) in enumerate(counted):
            idf = np.array([np.log(1 + (n - spread[t] + 0.5) / (spread[t] + 0.5)) for t in terms.tolist()])
            impact = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(self.words[i]) / mean))
            for t, w in zip(terms.tolist(), (impact / impact.sum()).tolist()):
                held.setdefault(t, []).append((i, w))
        self.postings = {}
        for t, entries in held.items():
            cuts = [entries[k : k + BLOCK] for k in range(0, len(entries), BLOCK)]
            tops = [max(w for _, w in c) for c in cuts]
            self.postings[t] = Posting([i for i, _ in entries], [w for _, w in entries], [c[-1][0] for c in cuts], tops, max(tops))
        # Terms from the most widespread on are left to the exact search while they make up little of any item.
        rest, common = np.zeros(n), set()
        for t in sorted(held, key=lambda t: (-len(held[t]), t)):
            reach = max(rest[i] + w for i, w in held[t])
            if reach < LEFT_OUT:
                common.add(t)
                for i, w in held[t]:
                    rest[i] += w
        self.rest = rest
        self.rare = np.array(sorted(t for t in held if t not in common), U)
        lists = [self.postings[int(t)] for t in self.rare.tolist()]
        self.sizes = np.array([len(p.items) for p in lists], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.flat_items = np.array([i for p in lists for i in p.items], np.int64)
        self.flat_impacts = np.array([w for p in lists for w in p.impacts])
        self.low = np.zeros(1 << 16, bool)
        self.low[(self.rare & U(0xFFFF)).astype(np.int64)] = True

    def promising(self, hashes: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Cells (half windows) that with the next one may hold an item at the threshold, by the rare terms."""
        near = np.flatnonzero(self.low[(hashes & U(0xFFFF)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.rare, hashes[near]), len(self.rare) - 1)
        hit = self.rare[place] == hashes[near]
        seen = np.unique(cells[near[hit]] * np.int64(len(self.rare)) + place[hit])
        cell, term = seen // len(self.rare), seen % len(self.rare)
        sizes = self.sizes[term]
        at = np.repeat(self.begins[term] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        n = np.int64(len(self.ids))
        key, back = np.unique(np.repeat(cell, sizes) * n + self.flat_items[at], return_inverse=True)
        score = np.bincount(back, self.flat_impacts[at], len(key))
        after = np.minimum(np.searchsorted(key, key + n), max(len(key) - 1, 0))
        both = score + np.where(key[after] == key + n, score[after], 0.0) if len(key) else score
        ok = both + self.rest[key % n] >= THRESHOLD - 1e-9
        cells = key[ok] // n
        alone = score + self.rest[key % n] >= THRESHOLD - 1e-9
        return np.unique(np.r_[cells, key[alone] // n - 1])

    def retrieve(self, terms: set[int], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """Items whose score is at least the threshold, by block-max WAND."""
        lists = [[self.postings[t], 0] for t in sorted(terms) if t in self.postings]
        out = []
        floor = threshold - 1e-9
        while True:
            lists = [c for c in lists if c[1] < len(c[0].items)]
            lists.sort(key=lambda c: c[0].items[c[1]])
            bound, pivot = 0.0, -1
            for k, (p, _) in enumerate(lists):
                bound += p.top
                if bound >= floor:
                    pivot = k
                    break
            if pivot < 0:
                return out
            item = lists[pivot][0].items[lists[pivot][1]]
            while pivot + 1 < len(lists) and lists[pivot + 1][0].items[lists[pivot + 1][1]] == item:
                pivot += 1
            bound, ends = 0.0, []
            for p, at in lists[: pivot + 1]:
                block = at // BLOCK
                while block < len(p.ends) and p.ends[block] < item:
                    block += 1
                if block < len(p.ends):
                    bound += p.tops[block]
                    ends.append(p.ends[block])
            if bound >= floor:
                if lists[0][0].items[lists[0][1]] == item:
                    score = 0.0
                    for c in lists[: pivot + 1]:
                        score += c[0].impacts[c[1]]
                        c[1] += 1
                    if score >= floor:
                        out.append((item, score))
                    continue
                target = item
            else:  # no item up to the end of the blocks can reach it
                target = min(ends) + 1
                if pivot + 1 < len(lists):
                    target = min(target, lists[pivot + 1][0].items[lists[pivot + 1][1]])
            for c in lists[: pivot + 1]:
                items = c[0].items
                while c[1] < len(items) and items[c[1]] < target:
                    c[1] += 1

    def overlaps(self, item: int, window: np.ndarray) -> tuple[float, float]:
        """Shares of the question's and of the answer's word triples that the passage holds in order."""
        words, cut = self.words[item], self.split[item]
        held = {n: set(_grams(window, n)) for n in {min(3, cut), min(3, len(words) - cut)}}
        shares = []
        for part in (words[:cut], words[cut:]):
            mine = set(_grams(part, min(3, len(part))))
            shares.append(len(mine & held[min(3, len(part))]) / len(mine))
        return shares[0], shares[1]


def _grams(words: np.ndarray, n: int) -> list[tuple[int, ...]]:
    w = words.tolist()
    return list(zip(*(w[k:] for k in range(n))))


def question_words(text: str) -> int:
    """Words of an item that are its question: all lines but the last, else all sentences but the last, else two thirds."""
    n = len(text.split())
    for cut in (r"\n(?=[^\n]*\S[^\n]*$)", r"(?<=[.?!])\s+(?=[^.?!]*\S[^.?!]*[.?!]?\s*$)"):
        if m := re.search(cut, text.strip()):
            first = len(text.strip()[: m.start()].split())
            if n // 4 <= first <= n - 2 and first >= 2:
                return first
    return max(1, min(n - 1, 2 * n // 3))


def indexes(benchmark: DataFrame, id: str = "item_id", text: str = "text") -> Iterator[Index]:
    """Indexes of ITEMS_PER_INDEX items each. Items of fewer than MIN_WORDS words say too little and are not indexed."""
    items = benchmark.select(F.col(f"`{id}`").cast("bigint"), F.col(f"`{text}`")).where(f"`{id}` is not null and `{text}` is not null").orderBy(f"`{id}`", f"`{text}`")
    part: list[tuple[int, np.ndarray, int]] = []
    for key, value in items.toLocalIterator():
        words = Words(pa.array([value])).hashes
        if len(words) >= MIN_WORDS:
            part.append((key, words, question_words(value)))
        if len(part) == ITEMS_PER_INDEX:
            yield Index(part)
            part = []
    if part:
        yield Index(part)


HIT = "struct<item_id:bigint,first_word:bigint,last_word:bigint,score:double,question:double,answer:double>"


def _found(index: Index, column: pa.Array) -> list[list[tuple]]:
    words = Words(column)
    hashes, count = words.hashes, words.last - words.first
    stride = index.longest
    # Cells of one row follow each other, with a gap of one between rows.
    per_row = -(-count // stride) + 1
    first_cell = np.cumsum(per_row) - per_row + 1
    row = np.repeat(np.arange(len(count)), count)
    cells = first_cell[row] + (np.arange(len(hashes)) - words.first[row]) // stride
    out: list[list[tuple]] = [[] for _ in count]
    best: dict[tuple[int, int], tuple] = {}
    for cell in index.promising(hashes, cells).tolist() if len(hashes) else []:
        r = int(np.searchsorted(first_cell, cell + 1, "right")) - 1
        at = max(cell - int(first_cell[r]), 0) * stride
        a = int(words.first[r]) + at
        b = min(a + 2 * stride, int(words.last[r]))
        if a >= b:
            continue
        window = hashes[a:b]
        terms = set(window.tolist())
        for item, score in index.retrieve(terms):
            question, answer = index.overlaps(item, window)
            if question >= OVERLAP and answer >= OVERLAP:
                hit = (min(score, 1.0), question, answer, -at)
                if best.get((r, item), (-1,)) < hit:
                    best[r, item] = hit
                    best[r, item, "span"] = at, at + (b - a)
    for key, hit in best.items():
        if len(key) == 2:
            a, b = best[*key, "span"]
            out[key[0]].append((index.ids[key[1]], a, b, hit[0], hit[1], hit[2]))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``hits``: the benchmark items each whole text holds, with passage, score and overlaps.

    ``hits`` is an array of struct (item_id, first_word, last_word, score, question, answer), one
    entry per item, its best passage, by item; empty if none, also for a NULL or empty text and
    for an empty benchmark. Items with a NULL id or text, or under MIN_WORDS words, are not
    indexed. Repeated rows get equal hits; other columns pass through, one already named ``hits``
    is replaced. An empty table stays empty.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kept = [c for c in docs.columns if c != "hits"]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    out = docs.select(*(f"`{c}`" for c in kept), F.array().cast(f"array<{HIT}>").alias("hits"))
    for index in indexes(benchmark):
        shared = share(spark, index, "decontaminate")
        names = [f.split(":")[0] for f in HIT[7:-1].split(",")]

        def run(batches: Iterator[pa.RecordBatch], shared=shared, names=names) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, text):
                found = _found(shared(), batch.column(text))
                if any(found):
                    earlier = batch.column("hits").to_pylist()
                    rows = [sorted([*map(lambda h: tuple(h.values()), e), *f]) for e, f in zip(earlier, found)]
                    hits = pa.array([[dict(zip(names, h)) for h in r] for r in rows], batch.schema.field("hits").type)
                    batch = batch.set_column(batch.schema.get_field_index("hits"), batch.schema.field("hits"), hits)
                yield batch

        out = out.mapInArrow(run, f"{fields}, hits array<{HIT}>")
    return out
