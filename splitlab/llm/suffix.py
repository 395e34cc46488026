"""Removal of repeated byte strings: prefix-free parsing, a dictionary of phrases, its suffix array.

A byte is removed when it lies in a string of LENGTH bytes that also starts in a document with a
smaller id. A rolling hash over GRAM bytes sets triggers: the places whose hash is least among the
grams of some LENGTH-byte string. The choice depends on those bytes alone, so equal strings have
their trigger at the same place, and every string of LENGTH bytes has one. A trigger's phrase is
the text under all strings that chose it.

1. Triggers that occur in one document only cannot be part of a repeat and go; few are left.
2. The phrases of the others, by name (a 64-bit hash), form the parse of each document. A trigger
   that always has the same phrase needs no text: all its strings start in the phrase's documents.
3. The phrases of triggers with several, at the edges of repeats, form the dictionary, once each.
   All suffixes of its phrases are sorted by their first LENGTH bytes; in that order equal strings
   are neighbours, and the least document of each follows from the phrases' least documents.
4. The parse brings the verdicts back to the places in each document, where they are united.

Dictionary and parse are dealt to tasks by trigger hash, which equal strings share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlab.llm.common import (
    BUCKETS_PER_TASK, SIX, U, dealt, from_six_bytes, groups, keyed_by_text, mix, near_ids, packed, packed_schema, pieces, six_bytes, small_batches,
    unpacked_docs, utf8, with_base,
)

LENGTH = 50
GRAM = 20
SPREAD = LENGTH - GRAM + 1  # grams in a string
WIDEST = LENGTH + SPREAD - 1  # longest phrase


def _slide(x: np.ndarray, pick, width: int) -> np.ndarray:
    """pick (minimum or maximum) over every ``width`` neighbours; width - 1 values fewer."""
    size = 1
    while size * 2 <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    return pick(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def short(keys: np.ndarray) -> np.ndarray:
    """The 48 bits of trigger hashes by which they are dealt."""
    return keys & U((1 << 48) - 1)


class Triggers:
    """Trigger places and hashes of the rows of a text column, and the least hash of each string."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        self.data, self.offsets = data, offsets
        self.at = np.zeros(0, np.int64)
        if n < LENGTH:
            return
        room = np.zeros(n + GRAM, np.uint8)
        room[:n] = data
        word = np.ndarray((n + GRAM - 7,), "<u8", room.tobytes(), strides=(1,))
        parts = (word[k : k + n - GRAM + 1] for k in (*range(0, GRAM - 8, 8), GRAM - 8))
        h = np.zeros(n - GRAM + 1, U)
        for part in parts:
            h = mix((h + part) * U(0x9E3779B97F4A7C15))
        h |= U(1)
        least = _slide(h, np.minimum, SPREAD)
        inside = np.zeros(len(least), bool)  # strings that lie in one row
        for a, b in zip(offsets[:-1], offsets[1:]):
            inside[a : max(b - LENGTH + 1, a)] = True
        least = np.where(inside, least, U(0))
        reach = np.zeros(len(least) + 2 * (SPREAD - 1), U)
        reach[SPREAD - 1 : SPREAD - 1 + len(least)] = least
        self.at = np.flatnonzero(_slide(reach, np.maximum, SPREAD) == h)
        self.keys = h[self.at]
        self.least = reach  # of the string that starts at p: least[p + SPREAD - 1]
        self.row = np.searchsorted(offsets, self.at, "right") - 1

    def strings(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last start of the strings that chose each of these triggers."""
        at, key = self.at[some], self.keys[some]
        first, last = np.full(len(at), np.iinfo(np.int64).max), np.full(len(at), -1)
        for back in range(SPREAD):
            chose = self.least[at - back + SPREAD - 1] == key
            first = np.where(chose, at - back, first)
            last = np.where(chose & (last < 0), at - back, last)
        return first, last


def _shared_triggers(work: DataFrame, n_tasks: int) -> DataFrame:
    """(doc_id, keys): triggers of each document that other documents have too."""
    n_buckets = n_tasks * BUCKETS_PER_TASK

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in near_ids(batches):
            found = Triggers(*utf8(batch.column("text")))
            if len(found.at):
                ids = batch.column("doc_id").to_numpy()
                order = np.lexsort((found.row, found.keys))
                key, row = found.keys[order], found.row[order]
                once = np.r_[True, (key[1:] != key[:-1]) | (row[1:] != row[:-1])]
                doc = (ids[row[once]] - ids.min()).astype(np.uint32)
                yield with_base(packed(short(key[once]), n_buckets, {"key": six_bytes(key[once]), "doc": doc}), int(ids.min()))

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if all_ := unpacked_docs(batches, {"key": SIX, "doc": np.uint32}):
            key = from_six_bytes(all_["key"])
            order = np.lexsort((all_["doc"], key))
            key, doc = key[order], all_["doc"][order]
            begins, sizes = groups(key)
            kept = np.repeat(doc[begins] != doc[begins + sizes - 1], sizes)
            yield pa.RecordBatch.from_arrays([pa.array(doc[kept]), pa.array(key[kept].view(np.int64))], ["doc_id", "key"])

    sent = dealt(work.mapInArrow(emit, packed_schema("key", "doc") + ", base bigint"), n_tasks)
    return sent.mapInArrow(several, "doc_id bigint, key bigint").groupBy("doc_id").agg(F.collect_set("key").alias("keys"))


def _chosen(batch: pa.RecordBatch, column: str) -> tuple[Triggers, np.ndarray]:
    """Triggers of the rows' texts, and the places of those whose short hash is in the row's list."""
    found = Triggers(*utf8(batch.column("text")))
    if not len(found.at):
        return found, np.zeros(0, np.int64)
    lists = batch.column(column)
    keys = lists.flatten().to_numpy().view(U)
    # a lookup of (row, key): the row is mixed into the key
    apart = U(0xD1342543DE82EF95)
    known = np.sort(mix(keys + np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())).astype(U) * apart))
    asked = mix(short(found.keys) + found.row.astype(U) * apart)
    if not len(known):
        return found, np.zeros(0, np.int64)
    return found, np.flatnonzero(known[np.minimum(np.searchsorted(known, asked), len(known) - 1)] == asked)


def _phrases(found: Triggers, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts of the triggers' phrases (padded, the size in the last byte), their names, and first bytes."""
    first, last = found.strings(some)
    size = last - first + LENGTH
    room = np.r_[found.data, np.zeros(WIDEST, np.uint8)]
    text = np.zeros((len(some), 88), np.uint8)
    text[:, :WIDEST] = room[first[:, None] + np.arange(WIDEST)]
    text[:, :WIDEST][np.arange(WIDEST) >= size[:, None]] = 0
    text[:, WIDEST] = size
    name = np.zeros(len(text), U)
    for k, part in enumerate(text.view("<u8").T):
        name += mix(part + U(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * U(2 * k + 3)
    return np.ascontiguousarray(text[:, : WIDEST + 1]), name, first


def _sifted(parsed: DataFrame, n_tasks: int) -> DataFrame:
    """(doc_id, runs, keys): bytes under phrases that a smaller document has, where the trigger has one phrase; the other triggers."""
    n_buckets = n_tasks * BUCKETS_PER_TASK

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in near_ids(batches):
            found, some = _chosen(batch, "keys")
            if len(some):
                ids = batch.column("doc_id").to_numpy()
                text, name, first = _phrases(found, some)
                row = found.row[some]
                columns = {"key": six_bytes(found.keys[some]), "name": name, "doc": (ids[row] - ids.min()).astype(np.uint32)}
                columns |= {"place": (first - found.offsets[row]).astype(np.uint32), "size": text[:, WIDEST]}
                yield with_base(packed(short(found.keys[some]), n_buckets, columns), int(ids.min()))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_ = unpacked_docs(batches, {"key": SIX, "name": U, "doc": np.uint32, "place": np.uint32, "size": np.uint8})
        if not all_:
            return
        key = from_six_bytes(all_["key"])
        order = np.lexsort((all_["doc"], all_["name"], key))
        key, name, doc = key[order], all_["name"][order], all_["doc"][order]
        begins, sizes = groups(key)
        single = np.repeat(name[begins] == name[begins + sizes - 1], sizes)
        gone = single & (doc > np.repeat(doc[begins], sizes))
        start = all_["place"][order][gone].astype(np.int64)
        once = ~single & np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]
        columns = [np.r_[doc[gone], doc[once]], np.r_[start, np.full(once.sum(), -1)], np.r_[start + all_["size"][order][gone], key[once].view(np.int64)]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "start", "rest"])

    names = ("key", "name", "doc", "place", "size")
    sent = dealt(parsed.mapInArrow(emit, packed_schema(*names) + ", base bigint"), n_tasks)
    rows = sent.mapInArrow(sift, "doc_id bigint, start bigint, rest bigint").where("doc_id is not null")
    return rows.groupBy("doc_id").agg(F.collect_list(F.struct("start", "rest")).alias("sifted"))


def _repeats(parsed: DataFrame, n_tasks: int) -> DataFrame:
    """(doc_id, start, end): runs of bytes under strings that a smaller document has, of triggers with several phrases."""
    n_buckets = n_tasks * BUCKETS_PER_TASK
    phrase = np.dtype((np.void, WIDEST + 1))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in near_ids(batches):
            found, some = _chosen(batch, "keys")
            if not len(some):
                continue
            ids = batch.column("doc_id").to_numpy()
            text, name, first = _phrases(found, some)
            text = text.view(phrase).ravel()
            key, row = short(found.keys[some]), found.row[some]
            doc = (ids[row] - ids.min()).astype(np.uint32)
            place = (first - found.offsets[row]).astype(np.uint32)
            none = {"name": name[:0], "text": text[:0], "of": name[:0], "doc": doc[:0], "place": place[:0]}
            base = int(ids.min())
            yield with_base(packed(key, n_buckets, none | {"of": name, "doc": doc, "place": place}), base)
            _, once = np.unique(name, return_index=True)
            yield with_base(packed(key[once], n_buckets, none | {"name": name[once], "text": text[once]}), base)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches) if (batches := [b for b in batches if b.num_rows]) else None
        for bucket in pc.unique(held["bucket"]).to_pylist() if held is not None else ():  # equal strings share a bucket
            yield from judged(held.filter(pc.equal(held["bucket"], bucket)).to_batches())

    def judged(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_ = unpacked_docs(batches, {"name": U, "text": phrase, "of": U, "doc": np.uint32, "place": np.uint32})
        if not all_ or not len(all_["of"]):
            return
        names, once = np.unique(all_["name"], return_index=True)
        text = all_["text"][once].view(np.uint8).reshape(-1, WIDEST + 1)
        size = text[:, WIDEST].astype(np.int64)
        of = np.searchsorted(names, all_["of"])
        least = np.full(len(names), np.iinfo(np.int64).max)
        np.minimum.at(least, of, all_["doc"])
        # The suffixes of the dictionary's phrases that are long enough, in the order of their first LENGTH bytes.
        owner = [np.flatnonzero(size >= LENGTH + j) for j in range(SPREAD)]
        shift = np.concatenate([np.full(len(o), j) for j, o in enumerate(owner)])
        strings = np.zeros((len(shift), 56), np.uint8)
        at = 0
        for j, o in enumerate(owner):
            strings[at : at + len(o), :LENGTH] = text[o, j : j + LENGTH]
            at += len(o)
        owner = np.concatenate(owner)
        columns = strings.view("<u8")
        order = np.lexsort(columns.T)
        same = np.r_[False, (columns[order[1:]] == columns[order[:-1]]).all(1)] if len(order) else np.zeros(0, bool)
        begins = np.flatnonzero(~same)
        first = np.minimum.reduceat(least[owner[order]], begins)
        verdict = np.full((len(names), SPREAD), np.iinfo(np.int64).max)
        verdict[owner[order], shift[order]] = np.repeat(first, np.diff(np.r_[begins, len(order)]))
        step = 200_000
        for a in range(0, len(of), step):
            gone = np.zeros((len(of[a : a + step]), SPREAD + 2), np.int8)
            gone[:, 1:-1] = verdict[of[a : a + step]] < all_["doc"][a : a + step, None]
            edge = np.diff(gone, axis=1)
            row, start = np.nonzero(edge == 1)
            _, end = np.nonzero(edge == -1)
            place = all_["place"][a : a + step][row].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(all_["doc"][a : a + step][row]), pa.array(place + start), pa.array(place + end - 1 + LENGTH)], ["doc_id", "start", "end"]
            )

    names = ("name", "text", "of", "doc", "place")
    sent = dealt(parsed.mapInArrow(emit, packed_schema(*names) + ", base bigint"), n_tasks)
    return sent.mapInArrow(judge, "doc_id bigint, start bigint, end bigint")


def spans(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: removed runs of bytes and the text without them.

    A document whose whole text a smaller id has is removed as one run if it has LENGTH bytes.
    A NULL or empty text has no bytes; shorter ones keep all. Rows with a NULL id keep all and
    take from nobody. Rows repeated under one id do not remove each other; if their texts differ,
    each loses what is repeated in any of them, as far as it reaches. Other columns are ignored;
    an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    rows, firsts, nameless, n_tasks = keyed_by_text(docs, text, id)
    work = rows.join(firsts, "doc_id").where(F.array_contains("firsts", F.col("digest")))
    sifted = _sifted(work.join(_shared_triggers(work, n_tasks), "doc_id"), n_tasks)
    edges = work.join(sifted, "doc_id").select("doc_id", "text", "digest", F.expr("transform(filter(sifted, x -> x.start < 0), x -> x.rest)").alias("keys"))
    found = _repeats(edges, n_tasks).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    whole = F.expr("transform(filter(sifted, x -> x.start >= 0), x -> named_struct('start', x.start, 'end', x.rest))")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    judged = rows.join(firsts, "doc_id", "left").join(sifted, "doc_id", "left").join(found, "doc_id", "left").select(
        "doc_id", "text", (~F.coalesce(F.array_contains("firsts", F.col("digest")), F.lit(False))).alias("copy"),
        F.concat(F.coalesce(whole, none), F.coalesce("found", none)).alias("found"), "digest",
    )
    judged = judged.union(nameless.select("doc_id", "text", F.lit(False), none, F.lit("")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            runs, kept, sizes = [], [], []
            for value, copy, found in zip(batch.column("text").to_pylist(), batch.column("copy").to_pylist(), batch.column("found").to_pylist()):
                raw = value.encode()
                sizes.append(len(raw))
                if copy:
                    mine = [(0, len(raw))] if len(raw) >= LENGTH else []
                else:
                    mine = []
                    for a, b in sorted((f["start"], min(f["end"], len(raw))) for f in found or ()):
                        if mine and a <= mine[-1][1]:
                            mine[-1] = mine[-1][0], max(b, mine[-1][1])
                        elif a < b:
                            mine.append((a, b))
                runs.append([{"start": a, "end": b} for a, b in mine])
                edges = [0, *(x for run in mine for x in run), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(runs, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"]
            )

    return judged.mapInArrow(cut, "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
