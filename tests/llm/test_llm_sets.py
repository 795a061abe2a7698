"""Operators on whole data sets: manifest, whitening and sharding, against brute force."""

import hashlib
import itertools
import zlib
from collections import Counter
from fractions import Fraction
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.llm import manifest, sharding, whitening
from salescope.session import fresh

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, leaf string, root string,"
    " path string, tree string, digest string, uid long, shard string, slot string, part int, names string"
)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ---- manifest ----


def slow_leaf(doc_id, text, lang, source, n_chars):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])


def slow_tree(digests):
    """The root and every leaf's siblings, level by level."""
    nodes = [(d, [n]) for n, d in enumerate(digests)]
    paths = [[] for _ in digests]
    while len(nodes) > 1:
        above = []
        for k in range(0, len(nodes), 3):
            run = nodes[k : k + 3]
            for at, (_, leaves) in enumerate(run):
                left, right = ["".join(d for d, _ in part) for part in (run[:at], run[at + 1 :])]
                for n in leaves:
                    paths[n].append((left, right))
            above.append((sha(*[d for d, _ in run]), [n for _, leaves in run for n in leaves]))
        nodes = above
    return nodes[0][0], paths


def slow_manifest(rows, tamper):
    """Sorted ``(doc_id, leaf, subroot, root, proof, folded, verified)``."""
    trees = {}
    for r in rows:
        trees.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, slow_leaf(*r), slow_leaf(*tamper(r)), r[0]))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    found = {}
    for name in names:
        trees[name].sort(key=lambda x: x[:3])
        found[name] = slow_tree([x[2] for x in trees[name]])
    root, ways = slow_tree([found[name][0] for name in names]) if names else (None, [])
    out = []
    for name, way in zip(names, ways):
        subroot, paths = found[name]
        for (_, _, leaf, folded, doc_id), path in zip(trees[name], paths):
            for left, right in path + way:
                folded = sha(left, folded, right)
            proof = sha(*[left + right for left, right in path + way])
            out.append((doc_id, leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def cut(r):
    odd = r[0] is None or zlib.crc32(str(r[0]).encode()) % 2
    return r if odd or r[1] is None else (r[0], r[1].replace("\n", ""), *r[2:])


def check_manifest(frame):
    rows = [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in frame.collect()]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    claimed = manifest.leaf(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    found = manifest.manifest(frame, claimed)
    proof = manifest.proof_digest(F.col("path")).alias("proof")
    got = found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified").collect()
    assert sorted(map(tuple, got), key=str) == slow_manifest(rows, cut)
    return got


def doc(n, source, text="a\nb", lang="en"):
    return (n, text, lang, source, 3 if text else None, *["x"] * 5, 1, "x", "x", 1, "x")


# Tree sizes around the powers of three and beyond one block; names that sort by bytes.
SIZES = {"a": 1, "b": 2, "c": 3, "d": 4, "e": 9, "f": 10, "g": 80, "h": 81, "i": 82, "j": 243, "k": 250, "": 5, None: 30, "é": 7, "Z": 28}


def test_manifest_of_trees_of_all_shapes(spark):
    rows = [doc(1000 * t + 7 * n % 997, s, None if n % 11 == 3 else f"line {n}\n\nü{n % 5}") for t, (s, k) in enumerate(SIZES.items()) for n in range(k)]
    rows += [doc(None, s, t) for s in ("a", None) for t in (None, "", "x\ny")]
    rows += [doc(5, "a"), doc(5, "a"), doc(5, "a", "other"), doc(6, "é", lang=None), doc(8, "k", "long\n" * 30_000)]
    found = check_manifest(spark.createDataFrame(rows, SCHEMA).repartition(5))
    verdicts = Counter((r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0, r.verified) for r in found)
    assert verdicts[False, False] == 0 and verdicts[True, False] > 0 and verdicts[True, True] > 0


@pytest.mark.parametrize("sources", [1, 3, 100])
def test_manifest_of_lone_leaves(spark, sources):
    check_manifest(spark.createDataFrame([doc(n, f"s{n}") for n in range(sources)], SCHEMA))


def test_manifest_of_nothing_and_default_claims(spark, small):
    assert manifest.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert manifest.manifest(docs).filter("NOT verified OR verified IS NULL OR leaf <> claimed").isEmpty()


def test_proofs_are_about_their_row(spark):
    """A leaf does not fold to the root along another leaf's path, nor along a changed one."""
    found = manifest.manifest(spark.createDataFrame([doc(n, "s") for n in range(30)], SCHEMA)).collect()
    assert len({(r.subroot, r.root) for r in found}) == 1

    def folded(leaf, path):
        for left, right in path:
            leaf = sha(left, leaf, right)
        return leaf

    for a, b in itertools.product(found[:8], found):
        assert (folded(a.leaf, b.path) == a.root) == (a.doc_id == b.doc_id)


# ---- whitening ----


def slow_whitening(rows, wanted=4):
    """Per row ``(n, deviation, whitened, explained)`` by numpy's own eigenvalues."""
    out = []
    for length in {len(x) for _, x in rows}:
        own = [(i, x) for i, x in rows if len(x) == length]
        unique = sorted({tuple(x) for _, x in own})
        n, sums = len(unique), [sum(c) for c in zip(*unique)]

        def away(x):
            return [float(Fraction(n * c - s, n)) for c, s in zip(x, sums)]

        # Singular values of the vectors themselves, which keep the digits that the covariance loses.
        centred = np.array([away(x) for x in unique])
        _, spread, vectors = np.linalg.svd(centred, full_matrices=True)
        values = np.r_[spread**2 / n, np.zeros(length)][: min(wanted, length)]
        trace = (centred**2).sum() / n
        for i, x in own:
            deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
            out.append((i, n, deviation, vectors[:wanted] @ away(x), values, trace))
    return out


def check_whitening(spark, rows, usable):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, x string, length int")
    found = {}
    for r in whitening.whiten(frame.repartition(3)).collect():
        found.setdefault(r.vec_id, {})[r.component] = r
    whole = [(i, [int(np.floor(256 * c)) for c in v]) for i, v in rows if i in usable]
    assert set(found) == {i for i, x in whole}
    for i, n, deviation, projected, values, trace in slow_whitening(whole):
        assert sorted(found[i]) == list(range(1, len(values) + 1))
        for k, e in enumerate(values):
            r = found[i][k + 1]
            assert r.n == n and r.deviation == (deviation if deviation < 2**63 else None)
            if e <= 1e-25 * max(trace, 1.0):
                assert r.whitened is None and r.explained == (0.0 if trace else None)
                continue
            assert abs(r.whitened) == pytest.approx(abs(projected[k]) / np.sqrt(e), rel=1e-5, abs=1e-5)
            assert r.explained == pytest.approx(e / trace, rel=1e-9)
            assert r.identity_error < 1e-6
    return found


def test_whitening_against_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(90, 7)) @ np.diag([5, 3, 2, 1, 0.5, 0.2, 0.1]) @ rng.normal(size=(7, 7))
    rows = [(n, [float(c) for c in v]) for n, v in enumerate(base)]
    rows += [(200 + n, rows[3][1]) for n in range(50)] + [(300, [-0.0] * 7), (301, [1e9] * 7)]
    rows += [(400 + n, [float(c) for c in rng.normal(size=2)]) for n in range(9)]
    rows += [(500, [1.5]), (501, [2.5]), (502, [1.0, 2.0, 3.0]), (503, [1.0, 2.0, 3.0])]
    usable = {i for i, _ in rows}
    rows += [(900, None), (901, [None] + [1.0] * 6), (902, [float("nan")] * 7), (903, [float("inf")] * 7), (904, [])]
    found = check_whitening(spark, rows, usable)
    # One sign for all rows, and copies are equal.
    assert len({tuple(r.whitened for _, r in sorted(found[i].items())) for i in (3, *range(200, 250))}) == 1
    assert all(r.whitened is None and r.explained is None for r in found[502].values())


def test_whitening_of_rank_deficient_and_wide_sums(spark):
    check_whitening(spark, [(n, [float(n), 2.0 * n, 0.0, 1.0, 0.0]) for n in range(20)], set(range(20)))
    check_whitening(spark, [(n, [float(n) * 1e13, float(n * n % 7)]) for n in range(40)], set(range(40)))


def test_whitening_of_embeddings(spark, small):
    vectors = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in vectors.collect()]
    check_whitening(spark, rows, {i for i, _ in rows})


def test_whitening_of_nothing(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(None, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).count() == 0
    lone = whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0])], schema)).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened) for r in lone] == [(None, k, 1, 0, None) for k in (1, 2)]


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_divide_and_conquer_against_eigh(n):
    rng = np.random.default_rng(n)
    basis, _ = np.linalg.qr(rng.normal(size=(n, n)))
    spectra = [
        rng.random(n),
        np.zeros(n),
        np.ones(n),
        np.r_[np.ones(n // 2), np.zeros(n - n // 2)],
        10.0 ** -np.arange(n).clip(0, 17),
        1e12 + np.arange(n),
        np.arange(n) - n / 2,
        np.r_[[3.0] * (n // 3), [3.0 + 1e-10] * (n - n // 3)],
    ]
    for spectrum in spectra:
        a = (basis * spectrum) @ basis.T
        a = (a + a.T) / 2
        values, rows = whitening.components(a, n)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], rtol=1e-12, atol=1e-12 * max(1, np.abs(a).max()))
        assert np.abs(rows @ rows.T - np.eye(n)).max() < 1e-12
        assert np.abs(a @ rows.T - rows.T * values).max() <= 1e-12 * max(1, np.abs(a).max())
        best, _ = whitening.components(a, 3)
        assert np.allclose(best, values[:3], rtol=1e-12, atol=1e-12 * max(1, np.abs(a).max()))


def test_polar_factor():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(20, 20))
    a = a + a.T
    u = whitening.polar(a)
    assert np.abs(u @ u - np.eye(20)).max() < 1e-13
    assert np.linalg.eigvalsh(u @ a).min() > -1e-12


# ---- shards ----


def check_shards(frame, shards, **options):
    rows = sharding.shard(frame, shards, **options).collect()
    total = frame.count()
    assert len(rows) == total
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    for s in range(shards):
        assert sorted(slots.pop(s, [])) == list(range(total // shards + (s < total % shards)))
    assert not slots
    return rows


@pytest.mark.parametrize("shards, rows, parts", [(16, 1000, 7), (16, 16, 3), (16, 5, 4), (1, 50, 3), (3, 1, 1), (7, 333, 20), (50, 120, 40)])
def test_shards_of_exact_sizes(spark, shards, rows, parts):
    frame = spark.range(rows, numPartitions=parts).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'copy', NULL) AS text", "'x' AS shard", "1 AS slot", "2 AS part", "3 AS uid", "4 AS cuts", "5 AS place")
    found = check_shards(frame, shards)
    assert sorted(r.doc_id for r in found) == list(range(rows))
    assert found[0].asDict().keys() == {*frame.columns}
    assert all((r.text == "copy") == (r.doc_id % 3 == 0) and r.cuts == 4 for r in found)


def test_shards_of_nothing_and_of_equal_rows(spark):
    assert sharding.shard(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    check_shards(spark.createDataFrame([(None, None)] * 100, "doc_id long, text string"), 16)


def test_matrix_adds_up_and_repeats_itself(spark):
    rows = spark.range(5000, numPartitions=9).selectExpr("shiftright(monotonically_increasing_id(), 33) AS part", "monotonically_increasing_id() AS uid")
    first = {r.part: r.cuts for r in sharding.communication_matrix(rows, 16).collect()}
    again = {r.part: r.cuts for r in sharding.communication_matrix(rows, 16).collect()}
    other = {r.part: r.cuts for r in sharding.communication_matrix(rows, 16, seed=7).collect()}
    assert first == again != other
    sent = np.array([np.diff([0, *first[p]]) for p in sorted(first)])
    assert (sent >= 0).all() and sent.sum() == 5000
    assert sorted(sent.sum(axis=0)) == [312] * 8 + [313] * 8
    assert [r.n for r in rows.groupBy("part").count().withColumnRenamed("count", "n").orderBy("part").collect()] == list(sent.sum(axis=1))


def test_counts_follow_the_hypergeometric_law(spark):
    """Every partition's 6 rows reach 3 shards as 6 balls drawn from an urn with as many of each colour."""
    rows = spark.range(6 * 400).selectExpr("CAST(id DIV 6 AS INT) AS part", "shiftleft(id DIV 6, 33) + id % 6 AS uid")
    sent = np.array([np.diff([0, *r.cuts]) for r in sharding.communication_matrix(rows, 3).collect()])
    assert sent.sum(axis=0).tolist() == [800] * 3 and (sent.sum(axis=1) == 6).all()
    for shard in range(3):
        seen = np.bincount(sent[:, shard], minlength=7)
        law = [400 * comb(800, k) * comb(1600, 6 - k) / comb(2400, 6) for k in range(7)]
        assert sum((s - e) ** 2 / e for s, e in zip(seen[:5], law[:5])) < 20
    assert np.corrcoef(sent.T)[0, 1] == pytest.approx(-0.5, abs=0.15)


def test_shuffle_is_uniform(spark):
    """Where a row lands says nothing about where it was: shard, slot and order of rows are independent."""
    frame = spark.range(16_000, numPartitions=8).withColumnRenamed("id", "doc_id")
    rows = check_shards(frame, 16)
    ids = np.array([r.doc_id for r in rows])
    shard, slot = np.array([r.shard for r in rows]), np.array([r.slot for r in rows])
    for a, b in [(ids // 2000, shard), (ids // 2000, slot // 125), (ids % 10, shard), (shard, slot * 0 + ids % 7)]:
        table = np.zeros((a.max() + 1, b.max() + 1))
        np.add.at(table, (a, b), 1)
        expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / table.sum()
        freedom = (table.shape[0] - 1) * (table.shape[1] - 1)
        chi = ((table - expected) ** 2 / expected).sum()
        assert abs(chi - freedom) < 5 * np.sqrt(2 * freedom)
    order = ids[np.lexsort((slot, shard))]
    assert abs(np.corrcoef(order[1:], order[:-1])[0, 1]) < 0.04


def test_sharding_runs_no_python(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "source")
    found = sharding.shard(docs)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_shards_are_written_in_order(spark):
    path = fresh(spark, "shards")
    sharding.write(spark.range(100, numPartitions=3).withColumnRenamed("id", "doc_id"), path, 4)
    found = spark.read.parquet(path)
    assert Counter(r.shard for r in found.collect()) == {s: 25 for s in range(4)}
