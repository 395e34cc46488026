"""Set-similarity join on word shingles by vertical partitioning, and its components.

A document's set is its distinct 5-word shingles. All shingles have one global order: first the
rare ones by hash, then those that many documents hold, by how many. Two sets with Jaccard of at
least 0.8 share a shingle among the first fifth of either in that order (prefix filter), so only
documents that meet in such a list are compared. The order is cut into fragments; of each pair
the common shingles are counted fragment by fragment and the counts summed.

Links are wanted for components, so a list is not expanded into pairs. First every member is
compared with one leader of its lists, the set with the list's shingle earliest; equal sets need
no comparison. Then come rounds: lists whose members still lie in different components name
leaders anew, one for the members whose sets have a like sketch, and members outside their leader's
component are compared with it, so a round costs at most one comparison an entry and components merge from many sides.
Where few pairs are left there are no rounds. What rounds leave over are
lists of sets that are alike and yet not linked. Only these give all pairs between components that
have not been compared and pass the length, position and parity bounds, one document for each
set: no link is missed, and a group of k linked copies costs about k comparisons a round. The pairs of a list meet by bands of
size and in blocks of members, each cell a key of its own. The parity bound rules out most pairs of
edited copies below 0.8 inside the join, before they become rows: a set folds into PARITY bits, each
the parity of the shingles that fall on it, so two sets differ in at least as many shingles as
their folds differ in bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlab.llm.common import (
    BUCKETS_PER_TASK, SIX, U, Words, broadcast_if_few, dealt, from_six_bytes, groups, list_column, mix, near_ids, packed, packed_schema,
    pieces, process_cache, six_bytes, slices, small_batches, stored, unpacked, unpacked_docs, with_base,
)
from splitlab.llm.components import components

# A shingle counts as common beyond this many documents; at most COMMON_KEPT of them, the most frequent, are moved to the end of the order.
COMMON = 16
COMMON_KEPT = 200_000
# A list that has more members in one task is cut: the task's members form a list of their own, whose leader joins the shared one.
LIST_PART = 64
FRAGMENTS = 4
# Rounds of leaders at most; they only save comparisons, the pairs between components come after them in any case.
ROUNDS = 2
# No rounds where the mixed lists hold at most so many pairs between components: all of them are met at once.
FEW_PAIRS = 50_000
# Bits of a sketch at most.
SKETCH = 16
# Folds that may be broadcast: 16 MB.
FOLDS_SENT = 200_000
# Members of a list, of one band of sizes, that meet in one cell.
BLOCK = 512
# Bits a set folds into, 64 in a column; more bits rule out more pairs of large sets.
PARITY = 512
FOLDS = [f"fold{i}" for i in range(PARITY // 64)]
_CLASS_BITS = U(58)
# Sizes of a link are within 0.8 of each other, and behind its first common shingle both sets have room for the overlap it needs.
SIZES = "5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)"
BOUNDS = SIZES + " and 9 * least(n_a - place_a, n_b - place_b) >= 4 * (n_a + n_b)"

# The sets of a link differ in at most a ninth of their summed sizes; a fold may be NULL and then rules out nothing.
PARITY_BOUND = "coalesce(9 * (" + " + ".join(f"bit_count({f}_a ^ {f}_b)" for f in FOLDS) + ") <= n_a + n_b, true)"


def _least_overlap(n):
    """Shingles that a set of n must share with any set it links to: ceil(0.8 n)."""
    return (4 * n + 4) // 5


def short(keys: np.ndarray) -> np.ndarray:
    """The 48 bits by which shingles are dealt and listed; a rare clash adds a comparison, not a link."""
    return keys & U((1 << 48) - 1)


class Sets:
    """Sorted keys (order class and hash) of each row's distinct shingles, of a column of texts."""

    def __init__(self, column: pa.Array, common: tuple[np.ndarray, np.ndarray] | None = None):
        process_cache("jaccard")  # nothing is remembered here, nor of the operators before
        shingles, begins, ends = Words(column).shingles()
        keys = shingles >> U(6)
        if common is not None and len(common[0]):
            place = np.minimum(np.searchsorted(common[0], short(keys)), len(common[0]) - 1)
            keys = np.where(common[0][place] == short(keys), keys | common[1][place] << _CLASS_BITS, keys)
        self.keys = [np.unique(keys[a:b]) for a, b in zip(begins, ends)]


def _prefix(keys: np.ndarray) -> np.ndarray:
    return keys[: len(keys) - _least_overlap(len(keys)) + 1] if len(keys) else keys


def _common(docs: DataFrame, n_tasks: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys in more than COMMON first fifths by hash, sorted, with order classes by their counts (all documents count)."""
    n_buckets = n_tasks * BUCKETS_PER_TASK

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            keys = [short(_prefix(k)) for k in Sets(batch.column("text")).keys]
            keys, counts = np.unique(np.concatenate(keys), return_counts=True)
            yield packed(keys, n_buckets, {"key": six_bytes(keys), "n": np.minimum(counts, 65535).astype(np.uint16)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if all_ := unpacked(batches, {"key": SIX, "n": np.uint16}):
            keys = from_six_bytes(all_["key"])
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            begins, _ = groups(keys)
            counts = np.add.reduceat(all_["n"][order].astype(np.int64), begins)
            often = counts > COMMON
            yield pa.RecordBatch.from_arrays([pa.array(keys[begins][often].view(np.int64)), pa.array(counts[often])], ["key", "n"])

    counted = dealt(docs.select("text").mapInArrow(emit, packed_schema("key", "n")), n_tasks).mapInArrow(add, "key bigint, n bigint")
    top = counted.orderBy(F.desc("n"), "key").limit(COMMON_KEPT).toArrow()
    keys, n = top["key"].to_numpy().view(U), top["n"].to_numpy()
    order = np.argsort(keys)
    classes = np.minimum(1 + np.log2(n / COMMON).astype(np.int64), 31).astype(U)
    return keys[order], classes[order]


def _digest(keys: np.ndarray) -> int:
    """One number for a set: equal for equal sets, and signed 64 bits wide."""
    if not len(keys):
        return 0
    with np.errstate(over="ignore"):
        return int((mix(keys ^ U(0x5851F42D4C957F2D)).sum(dtype=U) * U(0x2545F4914F6CDD1D) + U(len(keys))).view(np.int64))


def _folds(sets: list[np.ndarray]) -> np.ndarray:
    """One row of PARITY bits for each set, as signed 64-bit numbers."""
    rows = np.repeat(np.arange(len(sets)), list(map(len, sets)))
    bits = (np.concatenate(sets) >> U(7)).astype(np.int64) % PARITY
    odd = np.bincount(rows * PARITY + bits, minlength=len(sets) * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(len(sets), len(FOLDS))


def _facts(docs: DataFrame) -> DataFrame:
    """doc_id, set number, size and folds of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = Sets(batch.column("text")).keys
            columns = [batch.column("doc_id"), pa.array(list(map(_digest, sets)), pa.int64()), pa.array(list(map(len, sets)), pa.int64())]
            columns += [pa.array(fold) for fold in _folds(sets).T]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "set", "n", *FOLDS])

    return docs.mapInArrow(run, "doc_id bigint, set bigint, n bigint, " + ", ".join(f"{f} bigint" for f in FOLDS))


# Marks the leader of a cut list in the shared one.
CUT = 0xFFFF


def _lists(docs: DataFrame, common, n_tasks: int) -> DataFrame:
    """(doc_id, key, place, n, leader, leader_place, leader_n): entries of the lists with several documents.

    The lists are those of the first fifths of the sets. An entry that has nobody of a like size in its list goes.
    """
    n_buckets = n_tasks * BUCKETS_PER_TASK

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in near_ids(batches):
            sets = Sets(batch.column("text"), common.value).keys
            prefixes = [short(_prefix(k)) for k in sets]
            size = np.array(list(map(len, prefixes)))
            key = np.concatenate(prefixes)
            if not len(key):
                continue
            ids = batch.column("doc_id").to_numpy()
            place = np.arange(len(key)) - np.repeat(np.cumsum(size) - size, size)
            order = np.lexsort((place, key))
            key, place = key[order], place[order].astype(np.uint32)
            doc = np.repeat(ids - ids.min(), size)[order].astype(np.uint32)
            n = np.repeat(np.array(list(map(len, sets))), size)[order].astype(np.uint32)
            begins, sizes = groups(key)
            cut = np.repeat(sizes > LIST_PART, sizes)
            shared = ~cut
            shared[begins] = True
            own = int(mix(np.array([ids.min()], np.int64).view(U))[0]) % (CUT - 1) + 1
            for some, part in ((shared, np.where(cut, CUT, 0)), (cut, np.full(len(key), own))):
                if some.any():
                    columns = {"key": six_bytes(key[some]), "doc": doc[some], "place": place[some], "n": n[some], "part": part[some].astype(np.uint16)}
                    salt = np.where(part[some] == CUT, 0, part[some]).astype(U)
                    yield with_base(packed(key[some] + (salt << U(48)), n_buckets, columns), int(ids.min()))

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_ = unpacked_docs(batches, {"key": SIX, "doc": np.uint32, "place": np.uint32, "n": np.uint32, "part": np.uint16})
        if not all_:
            return
        part = all_["part"]
        key = from_six_bytes(all_["key"]) + (np.where(part == CUT, 0, part).astype(U) << U(48))
        order = np.lexsort((all_["n"], key))
        k, n = key[order], all_["n"][order].astype(np.int64)
        next_to = (k[1:] == k[:-1]) & (4 * n[1:] <= 5 * n[:-1])
        like = np.zeros(len(key), bool)
        like[order] = np.r_[next_to, False] | np.r_[False, next_to]
        order = np.lexsort((all_["doc"], all_["place"], key))
        key, doc, place, n, part, like = key[order], all_["doc"][order], all_["place"][order].astype(np.int32), all_["n"][order].astype(np.int64), part[order], like[order]
        begins, sizes = groups(key)
        wide = np.repeat(np.maximum.reduceat(part, begins) > 0, sizes)
        first = np.repeat(begins, sizes)
        kept = wide | like
        columns = [doc, short(key).view(np.int64), place, n, doc[first], place[first], n[first]]
        yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in columns], ["doc_id", "key", "place", "n", "leader", "leader_place", "leader_n"])

    sent = dealt(docs.mapInArrow(emit, packed_schema("key", "doc", "place", "n", "part") + ", base bigint"), n_tasks)
    return sent.mapInArrow(lead, "doc_id bigint, key bigint, place int, n bigint, leader bigint, leader_place int, leader_n bigint")


def _segments(docs: DataFrame, wanted: DataFrame, common, unique: bool) -> DataFrame:
    """(doc_id, fragment, keys) of the wanted documents: their sets, cut at the pivots of the global order; ``unique`` if no id repeats."""
    step = (1 << 58) // FRAGMENTS
    pivots = np.array([step * i for i in range(1, FRAGMENTS)], U)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = Sets(batch.column("text"), common.value).keys
            sizes = np.concatenate([np.diff(np.r_[0, np.searchsorted(k, pivots), len(k)]) for k in sets])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("doc_id").to_numpy(), FRAGMENTS)), pa.array(np.tile(np.arange(FRAGMENTS, dtype=np.int32), len(sets))),
                 list_column(np.concatenate(sets).view(np.int64), np.cumsum(sizes), pa.int64())],
                ["doc_id", "fragment", "keys"],
            )

    found = docs.join(broadcast_if_few(wanted), "doc_id").select("doc_id", "text").mapInArrow(run, "doc_id bigint, fragment int, keys array<bigint>")
    return stored(found if unique else found.dropDuplicates(["doc_id", "fragment"]))


def _links(pairs: DataFrame, docs: DataFrame, common, unique: bool) -> DataFrame:
    """Pairs (a, b) whose partial overlaps, counted fragment by fragment, sum to a link."""
    wanted = stored(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    segments = _segments(docs, wanted, common, unique)
    one = segments.select(F.col("doc_id").alias("b"), "fragment", F.col("keys").alias("of_b"))
    two = segments.select(F.col("doc_id").alias("a"), "fragment", F.col("keys").alias("of_a"))
    parts = pairs.join(one, "b").join(two, ["a", "fragment"]).select(
        "a", "b", F.size(F.array_intersect("of_a", "of_b")).alias("common"), F.size("of_a").alias("n_a"), F.size("of_b").alias("n_b")
    )
    summed = parts.groupBy("a", "b").agg(*(F.sum(c).alias(c) for c in ("common", "n_a", "n_b")))
    return stored(summed.where("100 * common >= 80 * (n_a + n_b - common)").select("a", "b"))


def _rooted(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, doc_id, place, n, root)."""
    rooted = broadcast_if_few(roots.select(F.col("node").alias("doc_id"), "root"))
    return lists.select("key", "doc_id", "place", "n").join(rooted, "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))


def _mixed(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, doc_id, place, n, root) of the lists whose members lie in several components, written."""
    entries = _rooted(lists, roots)
    mixed = entries.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    return stored(entries.join(mixed, "key", "left_semi"))


def _few_pairs(mixed: DataFrame) -> bool:
    """Whether lists hold at most FEW_PAIRS pairs of members in different components; the pairs are counted, not made."""
    members = mixed.groupBy("key", "root").agg(F.count("*").cast("double").alias("c"))
    pairs = members.groupBy("key").agg(((F.sum("c") * F.sum("c") - F.sum(F.col("c") * F.col("c"))) / 2).alias("p"))
    return (pairs.agg(F.sum("p")).first()[0] or 0) <= FEW_PAIRS


def _folded(sets: DataFrame) -> DataFrame:
    one_set = F.min("set") == F.max("set")  # an id with several texts has no fold
    return sets.groupBy("doc_id").agg(F.max("n").alias("n"), *(F.when(one_set, F.min(f)).alias(f) for f in FOLDS))


def _sided(entries: DataFrame, side: str, *columns: str) -> DataFrame:
    return entries.select(*(F.col(c).alias(f"{c}_{side}") for c in ("doc_id", "n", "root", "place")), *columns)


def _led(lists: DataFrame, roots: DataFrame, folds: DataFrame, turn: int) -> DataFrame:
    """Pairs of a mixed list's members with a leader, in different components and within the bounds.

    A list has a leader for each of its sketches, some bits of the fold that changes with the round: near copies have
    few odd shingles between them and mostly agree, members that only share a passage do not.
    """
    sketch = folds.select("doc_id", F.coalesce(FOLDS[turn], F.lit(0)).alias("fold"))
    # Of the fold's bits so many that linked sets of this size agree in them half of the time.
    bits = F.least(F.lit(SKETCH), F.floor(F.lit(0.69 * PARITY) / (F.col("n") * 2 / 9))).cast("int")
    kin = F.col("fold").bitwiseAND(F.expr("shiftleft(1L, bits) - 1"))
    entries = _rooted(lists, roots).join(broadcast_if_few(sketch), "doc_id").withColumn("bits", bits).withColumn("kin", kin).drop("fold")
    names, group = ("doc_id", "n", "root", "place"), ("key", "bits", "kin")
    leaders = entries.groupBy(*group).agg(F.min_by(F.struct(*names), F.struct(F.xxhash64("doc_id", "key", F.lit(turn)), "doc_id")).alias("l"))
    leaders = leaders.select(*group, *(F.col(f"l.{c}").alias(f"{c}_a") for c in names))
    met = _sided(entries, "b", *group).join(leaders, list(group)).where("root_a <> root_b").where(SIZES)
    # Wherever they meet, a pair may be compared: the bound on places, which holds in a pair's first list, is for pairs that must be.
    met = met.select(F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b")).distinct()
    sized = folds.select("doc_id", "n", *FOLDS)
    for side in "ab":
        met = met.join(sized.select(F.col("doc_id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("n", *FOLDS))), side)
    return met.where(PARITY_BOUND).select("a", "b")


def _between(mixed: DataFrame, folds: DataFrame) -> DataFrame:
    """Pairs of documents in different components that meet in a mixed list and pass the bounds."""
    # Sizes of a link are within a factor of 5/4, so its bands are the same or neighbours.
    band = F.floor(F.log(1.25, "n") + 1e-9).cast("int")
    entries = mixed.withColumn("band", band)
    blocks = entries.groupBy("key", "band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).where("blocks > 1")
    blocks = broadcast_if_few(stored(blocks))
    known = folds.drop("n").join(entries.select("doc_id").distinct(), "doc_id", "left_semi")
    full = entries.join(broadcast_if_few(stored(known), FOLDS_SENT), "doc_id")
    own = full.join(blocks, ["key", "band"], "left").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.coalesce("blocks", F.lit(1))).cast("int"))
    folds_of = {side: [F.col(f).alias(f"{f}_{side}") for f in FOLDS] for side in "ab"}
    # A member comes to all blocks of its own band and of the next one, where smaller bands wait for larger ones.
    waiting = _sided(own, "a", "key", "band", "block", *folds_of["a"])
    reach = full.select("*", F.explode(F.array("band", F.col("band") - 1)).alias("to")).join(blocks.withColumnRenamed("band", "to"), ["key", "to"], "left")
    coming = reach.withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    coming = _sided(coming, "b", "key", F.col("to").alias("band"), "block", F.col("band").alias("own"), *folds_of["b"])
    met = waiting.join(coming, ["key", "band", "block"]).where("root_a <> root_b and (own > band or doc_id_a < doc_id_b)").where(BOUNDS).where(PARITY_BOUND)
    return met.select(F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b")).distinct()


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after more links: only the components that they join are worked on."""
    def root_of(side: str) -> DataFrame:
        return roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))

    between = links.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left")
    between = between.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    more = stored(components(between)).withColumnsRenamed({"node": "old", "root": "new"})
    moved = roots.join(broadcast_if_few(more), F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root"))
    fresh = more.join(roots, F.col("old") == F.col("node"), "left_anti").select(F.col("old").alias("node"), F.col("new").alias("root"))
    return stored(moved.union(fresh))


def similar(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    Two documents link when 100 * |intersection| >= 80 * |union| of their shingle sets; a
    component's id is its least doc_id. A text of fewer than five words has its whole sequence as
    one shingle; a NULL or empty text has none and links with nothing, not even another empty one.
    Repeated rows give repeated result rows. A row with a NULL id links with nothing and has a NULL
    component. Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    source = docs.select(F.col(f"`{id}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    n_tasks = slices(source)
    common = spark.sparkContext.broadcast(_common(source, n_tasks))
    facts = stored(_facts(source))
    sets = facts.where("doc_id is not null and n > 0")
    firsts = sets.groupBy("set").agg(F.min("doc_id").alias("b"))
    equal = stored(sets.join(firsts, "set").where("doc_id <> b").select(F.col("doc_id").alias("a"), "b"))
    # One document stands for each set.
    named = source.where("doc_id is not null").join(broadcast_if_few(equal.select(F.col("a").alias("doc_id"))), "doc_id", "left_anti")
    lists = stored(_lists(named, common, n_tasks))
    bound = BOUNDS.replace("n_a", "n").replace("n_b", "leader_n").replace("place_a", "place").replace("place_b", "leader_place")
    met = lists.where("doc_id <> leader").where(bound).groupBy("doc_id", "leader").agg(F.count("*").alias("c"))
    pairs = stored(met.groupBy(F.col("doc_id").alias("b")).agg(F.max_by("leader", F.struct("c", F.negative("leader"))).alias("a")))
    unique = facts.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()
    links = _links(pairs, named, common, unique).union(equal)
    roots = stored(components(links))
    folds = stored(_folded(sets))
    mixed = _mixed(lists, roots)
    rounds = 0 if _few_pairs(mixed) else ROUNDS
    lists = mixed.drop("root")
    done = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    for turn in range(rounds + 1):
        last = turn == rounds
        if last:
            met = _between(_mixed(lists, roots) if rounds else mixed, folds)
        else:
            met = _led(lists, roots, folds, turn)
        more = stored(met.join(done, ["a", "b"], "left_anti"))
        if more.isEmpty():
            if last:
                break
            continue
        links = _links(more, named, common, unique)
        if not links.isEmpty():
            roots = _merged(roots, links)
        done = done.union(more)
    rooted = roots.select(F.col("node").alias("doc_id"), "root")
    return facts.join(rooted, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id"))
