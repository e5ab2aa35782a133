"""SimHash groups against all pairs, bounded buckets, and components against union-find."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from tripflow.llm import simhash
from tripflow.operators.components import components


def plain(text):
    """The fingerprint, bit by bit."""
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def roots(nodes, pairs):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def grouped(fps, bits=3):
    return roots(fps, [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= bits])


def test_fingerprint_is_spark_xxhash(spark):
    for s in ("", "a b c", "é中 x"):
        assert spark.range(1).select(F.xxhash64(F.lit(s))).first()[0] & (2**64 - 1) == xxhash.xxh64_intdigest(s.encode(), seed=42)
    for t in (None, "", "a", "A b", "ÀB c D e", "x y z " * 40):
        assert simhash.fingerprint_of(t) == plain(t)


def test_components_of_documents(frame):
    rnd = random.Random(5)
    base = [" ".join(rnd.choice(("of", "the", "re", "tion", "and")) + str(rnd.randint(0, 9)) for _ in range(n)) for n in (300, 40, 12, 5, 2)]
    rows = list(ODD)
    for i in range(150):
        w = rnd.choice(base).split()
        for _ in range(rnd.randint(0, 2)):
            w[rnd.randrange(len(w))] = "X" + str(rnd.randint(0, 99))
        rows.append((100 + i, " ".join(w), "s"))
    got = simhash.with_component(frame(rows)).collect()
    assert len(got) == len(rows)
    fps = sorted({plain(t) for _, t, *_ in rows})
    root = grouped(fps)
    low = defaultdict(list)
    for i, t, *_ in rows:
        if i is not None:
            low[root[plain(t)]].append(i)
    want = sorted((str(i), f"{plain(t):016x}", str(min(low[root[plain(t)]], default=None))) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    kept = simhash.keep_one(frame(rows))
    assert kept.columns == frame([]).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(min(v, default=None)) for v in (low[r] for r in set(root.values())))
    assert simhash.with_component(frame([])).count() == 0 and simhash.keep_one(frame([])).count() == 0
    assert simhash.keep_one(frame([(1, "a b"), (1, "a b"), (None, "c"), (None, "c")])).count() == 2


@pytest.mark.parametrize("seed", range(2))
def test_links_past_a_full_bucket(spark, seed):
    """Thousands of fingerprints that share halves: buckets above the bound are cut again."""
    rnd = random.Random(seed)
    half = rnd.getrandbits(32)
    fps = {(half << 32) | rnd.getrandbits(13) << rnd.choice((0, 9, 19)) for _ in range(2600)}
    fps |= {rnd.getrandbits(32) << 32 | half for _ in range(2300)}
    for x in list(fps)[:600]:
        fps.add(x ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)))
    fps = sorted(fps)
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    d = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(5)
    edges = simhash.links(d, bucket=2048)
    got = [(e.a & (2**64 - 1), e.b & (2**64 - 1)) for e in edges.collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in got)
    arr, up = np.array(fps, dtype=np.uint64), []
    for i in range(len(arr)):
        near = np.flatnonzero(np.bitwise_count(arr[:i] ^ arr[i]) <= 3)
        up += [(fps[i], fps[j]) for j in near]
    assert roots(fps, got) == roots(fps, up)
    assert len(got) <= 64 * len(fps)


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(rnd.randint(2000, 2400), rnd.randint(2000, 2400)) for _ in range(150)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    nodes = {x for e in edges for x in e}
    want = {n: r for n, r in roots(nodes, edges).items() if any(n in e and e[0] != e[1] for e in edges)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
