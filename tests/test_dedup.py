"""The ordered scan and near-duplicate search against sequential models."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwright.operators import dedup, neardup, ranking


def apart(a, b):
    return bin((a ^ b) & (2**64 - 1)).count("1")


def scan(rows, distance=None):
    """rows: (ord, scope, source, image, hash) in order."""
    kept, seen = [], {}
    for o, scope, s, i, h in rows:
        sources, images, hashes = seen.setdefault(scope, (set(), set(), []))
        if (s and s in sources) or (i and i in images):
            continue
        if distance is not None and any(apart(h, x) <= distance for x in hashes):
            continue
        sources.add(s)
        images.add(i)
        hashes.append(h)
        kept.append(o)
    return kept


def random_rows(seed, n, keys, scopes=3):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) - 2**63 for _ in range(max(n // 10, 1))]
    rows = []
    for o in range(n):
        h = rng.choice(base)
        for _ in range(rng.randrange(8)):
            h ^= 1 << rng.randrange(63)
        s = rng.choice(["", f"s{rng.randrange(keys)}"]) if rng.random() < 0.1 else f"s{rng.randrange(keys)}"
        i = "" if rng.random() < 0.05 else f"i{rng.randrange(keys)}"
        rows.append((o, f"c{rng.randrange(scopes)}", s, i, h))
    return rows


def frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, "ord long, c string, s string, i string, h long").repartition(parts)


def kept_ords(df):
    return sorted(r.ord for r in df.select("ord").collect())


def test_dropped_rows_do_not_block(spark):
    rows = [(1, "c", "s1", "i1", 0), (2, "c", "s1", "i2", 0), (3, "c", "s2", "i2", 0)]
    assert kept_ords(dedup.keep_rows(frame(spark, rows), ["s", "i"], ["c"])) == [1, 3]


@pytest.mark.parametrize("seed,parts", [(1, 1), (1, 7), (2, 3), (3, 5)])
def test_url_scan_equals_model(spark, seed, parts):
    rows = random_rows(seed, 800, 150)
    assert kept_ords(dedup.keep_rows(frame(spark, rows, parts), ["s", "i"], ["c"])) == scan(rows)


def test_blank_can_be_a_key(spark):
    rows = [(1, "c", "s1", "", 0), (2, "c", "s2", "", 0), (3, "c", "s3", "i", 0)]
    df = frame(spark, rows)
    assert kept_ords(dedup.keep_rows(df, ["s", "i"], ["c"])) == [1, 2, 3]
    assert kept_ords(dedup.keep_rows(df, ["s", "i"], ["c"], blank_is_key=True)) == [1, 3]


def test_long_chain_is_followed_by_doubling(spark):
    rows = [(o, "c", f"s{o // 2}", f"i{(o + 1) // 2}", 0) for o in range(5000)]
    assert kept_ords(dedup.keep_rows(frame(spark, rows), ["s", "i"], ["c"])) == scan(rows)


def test_hot_key_holding_a_third(spark):
    rng = random.Random(9)
    rows = [
        (o, "c", "hot" if o % 3 == 0 else f"s{rng.randrange(900)}", f"i{rng.randrange(2000)}", 0) for o in range(3000)
    ]
    assert kept_ords(dedup.keep_rows(frame(spark, rows), ["s", "i"], ["c"])) == scan(rows)


@pytest.mark.parametrize("kw", [{}, {"first_step": 40}])
def test_hash_scan_equals_model(spark, kw):
    rows = [(o, c, s, "", h) for o, c, s, _, h in random_rows(4, 400, 200, scopes=2)]
    nodes = frame(spark, rows).select("ord", "c", F.nullif("s", F.lit("")).alias("s"), "h")
    assert kept_ords(dedup.keep_greedy(nodes, ["s"], ["c"], near="h", **kw)) == scan(rows, 5)


def test_hash_shared_by_a_third_of_the_rows(spark):
    rng = random.Random(3)
    hot = rng.getrandbits(62)
    rows = [(o, "c", f"s{o}", "", hot if o % 3 == 0 else rng.getrandbits(62)) for o in range(1500)]
    nodes = frame(spark, rows).select("ord", "c", "s", "h")
    assert kept_ords(dedup.keep_greedy(nodes, ["s"], ["c"], near="h")) == scan(rows, 5)


def test_first_by_key_keeps_blank_keys(spark):
    rows = [(1, "c", "", "a", 0), (2, "c", "", "a", 0), (3, "c", "x", "a", 0), (4, "c", "x", "b", 0)]
    assert kept_ords(dedup.keep_first_by(frame(spark, rows), ["s"])) == [1, 2, 3]


def clustered(seed, n, fixed_bytes=0):
    """Hashes of which a third share their low bytes."""
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        h = rng.getrandbits(64)
        if len(out) % 3 == 0 and fixed_bytes:
            h = (h >> (8 * fixed_bytes)) << (8 * fixed_bytes)
        for _ in range(rng.randrange(3)):
            out.add(h - 2**63)
            h ^= 1 << rng.randrange(64)
        out.add(h - 2**63)
    return sorted(out)[:n]


@pytest.mark.parametrize("bucket,fixed", [(4096, 0), (30, 0), (10, 2), (2, 3)])
def test_near_pairs_equal_brute_force(spark, bucket, fixed):
    hashes = clustered(11, 300, fixed)
    df = spark.createDataFrame([(h,) for h in hashes], "h long")
    got = sorted((r.h, r.other) for r in neardup.near_pairs(df, bucket_rows=bucket).collect())
    assert got == sorted((a, b) for a in hashes for b in hashes if a != b and apart(a, b) <= 5)


def test_near_pairs_between_two_sets(spark):
    hashes = clustered(12, 200)
    left, right = hashes[:120], hashes[80:]
    frames = [spark.createDataFrame([(h,) for h in part], "h long") for part in (left, right)]
    got = sorted((r.h, r.other) for r in neardup.near_pairs(*frames, bucket_rows=20).collect())
    assert got == sorted((a, b) for a in left for b in right if a != b and apart(a, b) <= 5)


def test_distance_limit(spark):
    with pytest.raises(ValueError):
        neardup.near_pairs(spark.createDataFrame([(1,)], "h long"), max_distance=6)


def test_first_near(spark):
    rows = [(1, 0), (2, 0), (3, 0b111), (4, 2**40 - 1), (5, 0b11111111)]
    df = spark.createDataFrame(rows, "ord long, h long")
    got = sorted((r.ord, r.near_ord) for r in neardup.first_near(df).collect())
    assert got == [(2, 1), (3, 1), (5, 3)]


@pytest.mark.parametrize("shifts", [(18, 36), (3, 6), (2,)])
def test_positions_with_sparse_orders(spark, shifts):
    rng = random.Random(1)
    orders = sorted(rng.sample(range(10**6), 500))
    rows = [(o, f"c{n % 3}") for n, o in enumerate(orders)]
    df = spark.createDataFrame(rows, "ord long, c string").repartition(5)
    got = {r.ord: (r.pos, r.n) for r in ranking.with_position(df, "ord", ["c"], total="n", shifts=shifts).collect()}
    counts, totals = {}, {}
    for _, c in rows:
        totals[c] = totals.get(c, 0) + 1
    for o, c in rows:
        counts[c] = counts.get(c, 0) + 1
        assert got[o] == (counts[c], totals[c])


@pytest.mark.parametrize("n,wanted", [(10, (8, 1, 1)), (9, (7, 0, 2)), (1, (0, 0, 1)), (57, (45, 5, 7))])
def test_split_counts(spark, n, wanted):
    df = spark.range(n).select(F.col("id").alias("ord"), F.lit("c").alias("category"), F.lit("same").alias("public_id"))
    rows = ranking.split_sets(df, 42, ["category"], ["public_id"]).groupBy("split").count().collect()
    counts = {r["split"]: r["count"] for r in rows}
    assert tuple(counts.get(s, 0) for s in ("train", "valid", "test")) == wanted


def test_last_page_is_short(spark):
    df = spark.range(51).withColumnRenamed("id", "ord")
    assert kept_ords(ranking.page_of(df, 3, 25)) == [50]


def test_near_pairs_where_five_bytes_are_constant(spark):
    """A third of the hashes differ only in three bytes: half bytes must split them."""
    rng = random.Random(21)
    hashes = set()
    while len(hashes) < 300:
        h = rng.getrandbits(24) << 20 if len(hashes) % 3 == 0 else rng.getrandbits(63)
        hashes |= {h, h ^ (1 << rng.randrange(20, 44))}
    hashes = sorted(hashes)
    df = spark.createDataFrame([(h,) for h in hashes], "h long")
    got = sorted((r.h, r.other) for r in neardup.near_pairs(df, bucket_rows=4).collect())
    assert got == sorted((a, b) for a in hashes for b in hashes if a != b and apart(a, b) <= 5)


def first_near_of(rows):
    """(place, place of the first earlier near hash), by brute force."""
    rows = sorted(rows)
    h, place = np.array([r[1] for r in rows], dtype=np.int64).view(np.uint64), [r[0] for r in rows]
    hits = ((i, np.flatnonzero(np.bitwise_count(h[:i] ^ h[i]) <= 5)) for i in range(len(h)))
    return sorted((place[i], place[found[0]]) for i, found in hits if len(found))


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def around(rng, center, n):
    """Different hashes within three bits of one."""
    found = set()
    while len(found) < n:
        h = center
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            h ^= 1 << bit
        found.add(h)
    return list(found)


def test_first_near_equals_brute_force_where_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(neardup, "HELD", 200)  # buckets dealt out to several tasks
    rng = random.Random(31)
    hashes = [rng.getrandbits(64) for _ in range(800)]
    hashes += [h ^ (1 << rng.randrange(64)) for h in hashes[:100]] + [(0xABCDEF << 40) | rng.getrandbits(40) for _ in range(700)]
    hashes += around(rng, rng.getrandbits(64), 900) + hashes[:40]
    rows = [(n, signed(h)) for n, h in enumerate(hashes)]
    df = spark.createDataFrame([*rows, (9999, None)], "ord long, h long").repartition(4)
    got = sorted((r.ord, r.near_ord) for r in neardup.first_near(df, bucket_rows=64).collect())
    assert got == first_near_of(rows)


def test_a_dense_cluster_that_arrives_last_makes_no_pairs(spark, monkeypatch):
    rng, written, write = random.Random(32), [], neardup.materialise
    monkeypatch.setattr(neardup, "materialise", lambda df, label: written.append(write(df, label)) or written[-1])
    hashes = [rng.getrandbits(64) for _ in range(3000)] + around(rng, rng.getrandbits(64), 40_000)
    rows = [(n, signed(h)) for n, h in enumerate(hashes)]
    got = sorted((r.ord, r.near_ord) for r in neardup.first_near(spark.createDataFrame(rows, "ord long, h long")).collect())
    assert got == first_near_of(rows)
    assert sum(df.count() for df in written) < 60 * len(rows)
