"""Merkle manifest, hard negatives and mixing against plain versions, and on awkward tables."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from splitlab.llm import merkle, mix, negatives

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, rank int, path string, grp string"
EXTRA = ("kept", 1, "kept", "kept")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def climb(nodes, at):
    """Subroot of the nodes and the siblings on the way of node ``at``."""
    way = []
    while len(nodes) > 1:
        run = at // 16 * 16
        way.append((nodes[run:at], nodes[at + 1 : run + 16]))
        nodes, at = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)], at // 16
    return nodes[0], way


def plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    subroots = {g: climb([leaf_of(r) for r in groups[g]], 0)[0] for g in names}
    out = []
    for k, g in enumerate(names):
        root, top = climb(list(subroots.values()), k)
        leaves = [leaf_of(r) for r in groups[g]]
        for i, r in enumerate(groups[g]):
            way = climb(leaves, i)[1] + top
            h = leaves[i]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4])
                h = leaf_of((*r[:4], lower))
            for left, right in way:
                h = sha("".join(left) + h + "".join(right))
            proof = sha("".join("".join(a + b) for a, b in way))
            out.append((r[0], leaves[i], subroots[g], root, proof, h, h == root))
    return out


def manifest_of(spark, rows):
    frame = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)
    return [tuple(r) for r in merkle.manifest(frame, F.crc32(F.col("doc_id").cast("string")) % 5 == 0).collect()]


def by_text(rows):
    return sorted(rows, key=str)


def test_manifest_equals_plain_trees(spark):
    rows = [(i, f"s{i % 40}" if i % 3 else "hot", None if i % 7 == 0 else "en", i if i % 5 else None, f"Text ÄB {i}" * (i % 4)) for i in range(1, 1500)]
    rows += [(5000 + i, None, "en", 1, None) for i in range(17)] + [(None, "hot", None, None, None), (7, "S", None, None, ""), (8, "é", "x", -3, "A" * 100_000)]
    rows += [rows[4]] * 20  # repeated rows are leaves of their own
    got = manifest_of(spark, rows)
    assert by_text(got) == by_text(plain_manifest(rows))
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 16, 17])
def test_manifest_of_small_tables(spark, n):
    rows = [(i, "one", "en", 1, f"B{i}") for i in range(n)]
    assert by_text(manifest_of(spark, rows)) == by_text(plain_manifest(rows))


def test_manifest_of_no_rows(spark):
    out = merkle.manifest(spark.createDataFrame([], SCHEMA))
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and not out.collect()


@pytest.mark.parametrize("largest,width", [(3, 1), (300, 64), (2**20, 300), (2**24, 64)])
def test_residue_product_is_exact(largest, width):
    rng = np.random.default_rng(largest)
    a, b = (rng.integers(-largest, largest + 1, (20, width)) for _ in "ab")
    a[0], b[0] = largest, -largest
    want = (a.astype(object) @ b.T.astype(object)).astype(np.int64)
    primes = negatives._primes(2 * width * largest**2 + 2)
    assert (negatives.product(negatives.Residues(a, primes)[:], negatives.Residues(b, primes)[:], primes) == want).all()


def plain_negatives(rows, k=5, m=3):
    """rows: (id, label, integer vector), one per id."""
    out = []
    for a, la, va in rows:
        if a % 50:
            continue
        score = {b: int(np.dot(va, vb)) for b, _, vb in rows}
        same = sorted((b for b, lb, _ in rows if lb == la and b != a), key=lambda b: (-score[b], b))[:k]
        for p in same:
            fit = sorted((b for b, lb, _ in rows if lb != la and 50 * score[p] <= 100 * score[b] <= 95 * score[p]), key=lambda b: (-score[b], b))[:m]
            out += [(a, p, r, b, score[p], score[b]) for r, b in enumerate(fit, 1)]
    return sorted(out)


V = "vec_id bigint, label int, embedding array<double>, id string, positives string, block int"


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "kept", "kept", 0) for r in rows], V)
    return sorted(map(tuple, negatives.hard_negatives(frame, F.col("id") % 50 == 0, **options).collect()))


@pytest.mark.parametrize("shard_rows,block", [(10_000, 1000), (90, 4)])
def test_negatives_equal_plain_search(spark, shard_rows, block):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(0, 1, (700, 3)) * 4) / 8  # many ties
    x[100:160] = x[100]
    rows = [(i, int(rng.integers(0, 3)), v.tolist()) for i, v in enumerate(x)]
    want = plain_negatives([(i, label, [int(np.floor(256 * c)) for c in v]) for i, label, v in rows])
    odd = [(1000, None, [1.0, 1.0, 1.0]), (None, 1, [1.0, 1.0, 1.0]), (1050, 1, None), (1100, 1, [1.0, None, 1.0]), (1150, 1, [float("nan"), 1.0, 1.0]),
           (1200, 1, [float("inf"), 1.0, 1.0]), (1250, 1, []), (1300, 1, [1.0]), (1350, 1, [1e300, 0.0, 0.0]), rows[50], rows[51]]
    assert want and mined(spark, rows + odd, shard_rows=shard_rows, anchor_block=block) == want


def test_negatives_without_partners(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, 0, [1.0])]) == [] and mined(spark, [(50, 0, [1.0])]) == []
    assert mined(spark, [(50, 0, [1.0]), (51, 0, [1.0])]) == []
    # Fewer positives and negatives than asked for; large components.
    rows = [(0, 0, [1e4, 0.0]), (1, 0, [1e4, 1.0]), (2, 1, [6e3, 0.0]), (3, 1, [-6e3, 0.0])]
    assert mined(spark, rows) == [(0, 1, 1, 2, 2560000 * 2560000, 2560000 * 1536000)]


M = "doc_id bigint, source string, text string, size int, h0 string, s string, target string"


def mixture(spark, rows):
    return [tuple(r) for r in mix.mixed(spark.createDataFrame([(*r, 0, "kept", "kept", "kept") for r in rows], M)).collect()]


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    limited = set()
    while True:
        free = [s for s in names if s not in limited]
        left, w = sum(sizes.values()) - sum(3 * sizes[s] for s in limited), sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / w > 3 * sizes[s]}
        if not over:
            return {s: float(3 * sizes[s]) if s in limited else left * weight[s] / w for s in names}
        limited |= over


def check_mixture(rows, got):
    size = lambda t: len(__import__("re").findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((i, size(t)) for i, _, t in rows) == Counter((r[0], r[1]) for r in got)
    sizes = Counter()
    for _, s, t in rows:
        sizes[s] += size(t)
    want = plain_targets(sizes)
    by_share = defaultdict(list)
    for i, n, whole, target, taken in got:
        assert taken in (0, n, 2 * n, 3 * n)
        by_share[whole, round(target, 6)].append((n, taken))
    for s, t in want.items():
        if sizes[s]:
            assert (sizes[s], round(t, 6)) in by_share
    for (_, target), held in by_share.items():
        copies = sum(1 for s, t in want.items() if (sizes[s], round(t, 6)) == (_, target))
        assert abs(sum(t for _, t in held) - copies * target) <= copies * max(n for n, _ in held) / 2 + 1e-6


def test_mixture_meets_targets(spark):
    rng = np.random.default_rng(11)
    names = [None, "a", "b", "ä", "tiny", "z", "zz"]
    rows = [(i, names[int(rng.integers(0, 7)) if i % 3 else 2], "w " * int(rng.integers(0, 60))) for i in range(3000)]
    rows = [r for r in rows if r[1] != "tiny"] + [(9000, "tiny", "one two"), (9001, "tiny", None), (None, "a", "no id"), (9002, "z", "x " * 20_000), (9003, "none", "")]
    rows += [(9004, "b", "same words again " * 5)] * 400  # one row repeated
    got = mixture(spark, rows)
    check_mixture(rows, got)
    assert Counter(got) == Counter(mixture(spark, rows[::-1])), "order and layout of the rows do not matter"


def test_mixture_of_repeated_rows_only(spark):
    rows = [(1, "a", "five words in this text")] * 1000 + [(2, "b", "x")] * 700 + [(3, "c", "y z")] * 10
    check_mixture(rows, mixture(spark, rows))


def test_mixture_of_many_sources(spark):
    rows = [(i, f"s{i % 9000:05d}", "w " * (i % 17 + 1)) for i in range(18_000)]
    check_mixture(rows, mixture(spark, rows))


def test_mixture_without_words(spark):
    assert mixture(spark, []) == []
    assert mixture(spark, [(1, "a", None), (2, None, " \n")]) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
