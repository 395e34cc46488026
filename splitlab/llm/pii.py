"""Personal data: fixed forms, and the terms that give protected entities away.

The fixed forms (e-mail, IP, card and phone numbers) are found by pattern; their values are the
protected entities. Over the whole corpus it is counted in how many documents each word occurs,
and in how many it stands within CONTEXT words of each entity. The share of a word's documents
that name one entity near it estimates P(entity | word): how much the word alone discloses. A
word that stands near an entity in at least SEEN documents is generalised where that share reaches
GENERALISE and removed where it reaches REMOVE, wherever it stands. Documents with the same text
count once, in both numbers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlab.llm.common import BUCKETS_PER_TASK, U, Words, dealt, groups, mix, packed, packed_schema, pieces, share, slices, small_batches, unpacked

CONTEXT, SEEN = 8, 3
GENERALISE, REMOVE = 0.5, 0.9
#: Disclosing words that one pass looks for; more take more passes.
WORDS_PER_PASS = 500_000
KINDS = ("email", "ip", "card", "phone", "term", "removed")
MARKS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]", "[TERM]", "")

# The forms asked for. A run of characters that cannot match from its first one cannot match later either.
LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"[{LOCAL}]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
EMAIL_HERE, EMAIL_LATER = re.compile(EMAIL), re.compile(rf"(?<![{LOCAL}]){EMAIL}")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def fixed(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed forms, in order; matches that fail their test are dropped."""
    out = []
    if "@" in text:
        at = 0
        while m := EMAIL_HERE.match(text, at) or EMAIL_LATER.search(text, at):
            out.append((m.start(), 0, m.end()))
            at = m.end()
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p) <= 3 and int(p) <= 255 for p in (q.lstrip("0") or "0" for q in m[0].split("."))):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(DIGIT.findall(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _entity(text: str, span: tuple[int, int, int]) -> str:
    start, kind, end = span
    return f"{kind}:" + (re.sub("[^0-9]", "", text[start:end]) if kind > 1 else text[start:end].lower())


def disclosing(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, share, entities): hashes of the words that disclose an entity, by the counts of all documents."""
    source = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    n_tasks = slices(source)
    source = source.distinct()
    n_buckets = n_tasks * BUCKETS_PER_TASK
    kinds = {"word": U, "n": np.int64, "near": U, "entity": np.int64, "met": np.int64}

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = {name: np.zeros(0, kind) for name, kind in kinds.items()}
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def counted():
            word = np.concatenate([w for w, _ in held])
            order = np.argsort(word, kind="stable")
            begins, _ = groups(word[order])
            n = np.add.reduceat(np.concatenate([n for _, n in held])[order], begins)
            held[:] = [(word[order][begins], n)]

        for batch in pieces(batches):
            words = Words(batch.column("text"))
            rows = np.repeat(np.arange(len(words.first)), words.last - words.first)
            order = np.lexsort((rows, words.hashes))
            h, r = words.hashes[order], rows[order]
            if not len(h):
                continue
            once = np.r_[True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])]
            word, n = np.unique(h[once], return_counts=True)
            held.append((word, n.astype(np.int64)))
            if len(held) >= 8:
                counted()
                if len(held[0][0]) > 1_500_000:
                    yield packed(held[0][0], n_buckets, none | {"word": held[0][0], "n": held[0][1]})
                    held.clear()
            near = []
            for i, value in enumerate(batch.column("text").to_pylist()):
                for span in fixed(value):
                    first = len(WORD.findall(value[: span[0]])) - int(span[0] > 0 and bool(WORD.match(value[span[0] - 1])))
                    last = first + len(WORD.findall(value[span[0] : span[2]])) - 1
                    mine = words.hashes[words.first[i] : words.last[i]]
                    around = np.unique(np.r_[mine[max(first - CONTEXT, 0) : max(first, 0)], mine[last + 1 : last + 1 + CONTEXT]])
                    entity = mix(np.array([hash_text(_entity(value, span))], U)).view(np.int64)[0]
                    near += [(w, entity, i) for w in around]
            if near:
                met = Counter((w, entity) for w, entity, _ in set(near))
                word = np.array([w for w, _ in met], U)
                yield packed(word, n_buckets, none | {"near": word, "entity": np.array([e for _, e in met], np.int64), "met": np.array(list(met.values()), np.int64)})
        if held:
            counted()
            yield packed(held[0][0], n_buckets, none | {"word": held[0][0], "n": held[0][1]})

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_ = unpacked(batches, kinds)
        if not all_ or not len(all_["near"]):
            return
        order = np.argsort(all_["word"], kind="stable")
        word = all_["word"][order]
        begins, _ = groups(word)
        word, documents = word[begins], np.add.reduceat(all_["n"][order], begins)
        order = np.lexsort((all_["entity"], all_["near"]))
        near, entity, met = (all_[name][order] for name in ("near", "entity", "met"))
        pair = np.flatnonzero(np.r_[True, (near[1:] != near[:-1]) | (entity[1:] != entity[:-1])])
        together = np.add.reduceat(met, pair)
        share = together / documents[np.searchsorted(word, near[pair])]
        told = (together >= SEEN) & (share >= GENERALISE)
        columns = [pa.array(near[pair][told].view(np.int64)), pa.array(share[told])]
        yield pa.RecordBatch.from_arrays(columns, ["word", "share"])

    sent = dealt(source.mapInArrow(emit, packed_schema(*kinds)), n_tasks)
    return sent.mapInArrow(weigh, "word bigint, share double").groupBy("word").agg(F.max("share").alias("share"), F.count("*").alias("entities"))


def hash_text(value: str) -> int:
    """A 64-bit FNV-1a hash."""
    h = 0xCBF29CE484222325
    for b in value.encode():
        h = (h ^ b) * 0x100000001B3 & (1 << 64) - 1
    return h


FOUND = "array<struct<start:int,kind:int,end:int>>"


def find(docs: DataFrame, text: str = "text", words: DataFrame | None = None) -> DataFrame:
    """``docs`` with ``personal``: array<struct<start, kind, end>> in code points, ends exclusive, by start.

    ``kind`` counts from 0 in KINDS. Fixed forms always stay; a disclosing word is added as "term"
    or "removed" where no fixed form overlaps it. A NULL or empty text has none. Repeated rows get
    equal spans; a column already named ``personal`` is replaced, others pass through. An empty
    table stays empty. ``words`` are those of another corpus; by default ``docs`` is counted itself.
    """
    spark = docs.sparkSession
    small_batches(spark)
    words = disclosing(docs, text) if words is None else words
    kept = [c for c in docs.columns if c != "personal"]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    out = docs.select(*(f"`{c}`" for c in kept), F.lit(None).cast(FOUND).alias("personal"))

    def passes() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        part: list[tuple[int, float]] = []
        done = False
        for row in words.orderBy("word").toLocalIterator():
            part.append((row["word"], row["share"]))
            if len(part) == WORDS_PER_PASS:
                yield np.array([w for w, _ in part], np.int64), np.array([s for _, s in part])
                part, done = [], True
        if part or not done:
            yield np.array([w for w, _ in part], np.int64), np.array([s for _, s in part])

    for known in passes():
        shared = share(spark, known, "pii")

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            told, shares = shared()
            for batch in pieces(batches, text):
                column = batch.column(text)
                values, earlier = column.to_pylist(), batch.column("personal").to_pylist()
                rows = []
                for value, before in zip(values, earlier):
                    spans = fixed(value) if value and before is None else [tuple(x.values()) for x in before or ()]
                    rows.append(spans)
                if len(told):
                    found = Words(column)
                    signed = found.hashes.view(np.int64)
                    place = np.minimum(np.searchsorted(told, signed), len(told) - 1)
                    for k in np.flatnonzero(told[place] == signed).tolist():
                        i = int(np.searchsorted(found.last, k, "right"))
                        raw = values[i].encode()
                        a = len(raw[: found.starts[k]].decode())
                        b = a + len(raw[found.starts[k] : found.ends[k]].decode())
                        if not any(s < b and a < e for s, _, e in rows[i]):
                            rows[i].append((a, 5 if shares[place[k]] >= REMOVE else 4, b))
                spans = [[dict(zip(("start", "kind", "end"), s)) for s in sorted(r)] for r in rows]
                field = batch.schema.field("personal")
                yield batch.set_column(batch.schema.get_field_index("personal"), field, pa.array(spans, field.type))

        out = out.mapInArrow(run, f"{fields}, personal {FOUND}")
    return out


def sanitise(docs: DataFrame, text: str = "text", words: DataFrame | None = None) -> DataFrame:
    """``docs`` with fixed forms masked, disclosing words generalised to a mark or removed."""
    found = find(docs, text, words)
    marks = "array(" + ", ".join(f"'{m}'" for m in MARKS) + ")"
    masked = F.expr(
        f"""aggregate(personal, named_struct('at', 0, 'out', ''),
            (acc, x) -> named_struct('at', greatest(acc.at, x.end),
                'out', if(x.start >= acc.at, concat(acc.out, substr(`{text}`, acc.at + 1, x.start - acc.at), {marks}[x.kind]), acc.out)),
            acc -> concat(acc.out, substr(`{text}`, acc.at + 1)))"""
    )
    return found.withColumn(text, F.when(F.size("personal") > 0, masked).otherwise(F.col(f"`{text}`"))).select(*(f"`{c}`" for c in docs.columns))
