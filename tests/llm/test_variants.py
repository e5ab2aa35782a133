"""MinHash near-dedup, whitening and spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import ODD
from tests.llm.test_simhash import roots
from tripflow.llm import minhash, spelling, whitening

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# --- 11 ------------------------------------------------------------------------------------------


def plain_set(text):
    w = WORD.findall(lower(text))
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} or ({tuple(w)} if w else set())


def plain_components(rows, percent=85):
    sets = [plain_set(t) for _, t, *_ in rows]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            k = len(a & sets[j])
            if a and 100 * k >= percent * (len(a) + len(sets[j]) - k):
                links.append((i, j))
    root = roots(range(len(rows)), links)
    ids = defaultdict(list)
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            ids[root[i]].append(d)
    low = [min(ids[root[i]], default=None) for i in range(len(rows))]
    return sorted((str(d), len(s), str(c if s else d), (d == c) if s else True) for (d, *_), s, c in zip(rows, sets, low))


def answer(frame):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in frame.collect())


def family(rnd, n, length, first):
    """Edited copies of one text, each from the original or from an earlier copy, so that chains arise."""
    texts = [[f"w{rnd.randint(0, 400)}" for _ in range(length)]]
    while len(texts) < n:
        w = list(rnd.choice(texts[:20]))
        for _ in range(rnd.randint(0, length // 30)):
            w[rnd.randrange(len(w))] = f"e{rnd.randint(0, 10**6)}"
        texts.append(w)
    return [(first + i, " ".join(w), "s") for i, w in enumerate(texts)]


def test_minhash_against_all_pairs(frame):
    rnd = random.Random(3)
    rows = list(ODD) + family(rnd, 120, 150, 100) + family(rnd, 60, 45, 400) + family(rnd, 40, 9, 600)
    rnd.shuffle(rows)
    made = minhash.near_duplicates(frame(rows))
    assert made.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert answer(made) == plain_components(rows)
    assert minhash.near_duplicates(frame([])).count() == 0
    assert answer(minhash.near_duplicates(frame([(1, None), (2, ""), (2, " ")]))) == [("1", 0, "1", True), ("2", 0, "2", True), ("2", 0, "2", True)]


def test_minhash_cells_and_full_buckets(frame, monkeypatch):
    """Families and buckets far beyond their bounds give the same components."""
    rnd = random.Random(8)
    rows = family(rnd, 220, 90, 0) + family(rnd, 90, 60, 1000)
    for name, value in (("BUCKET", 12), ("CELL", 16), ("CELL_HASHES", 2000)):
        monkeypatch.setattr(minhash, name, value)
    assert answer(minhash.near_duplicates(frame(rows))) == plain_components(rows)


def test_minhash_threshold_is_exact(frame):
    """Sets of 20 and 17 to 20 shingles: 17 of 20 link, 16 of 20 do not."""
    w = [f"t{i}" for i in range(22)]
    rows = [(1, " ".join(w)), (2, " ".join(w[:19])), (3, " ".join(w[:18])), (4, " ".join(["X"] + w[1:])), (5, " ".join(w).upper())]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(rows)).collect()}
    assert got[2] == 1 and got[5] == 1 and got[4] == 1
    assert [answer(minhash.near_duplicates(frame(rows)))] == [plain_components(rows)]


def test_posterior_bounds():
    """The pruning rule against a numeric posterior with a uniform prior."""
    grid = (np.arange(200_000) + 0.5) / 200_000
    for i, least in enumerate(minhash.fewest_matches(85, 1e-6)):
        k = (i + 1) * minhash.BATCH

        def tail(m, k=k):
            like = grid**m * (1 - grid) ** (k - m)
            return like[grid >= 0.85].sum() / like.sum()

        assert tail(least) >= 1e-6 * 0.99 and (least == 0 or tail(least - 1) < 1e-6 * 1.01)


# --- 12 ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("low, high", [(-3, 4), (0, 1), (-(2**40), 2**40), (-(2**61), 2**61), (7, 8)])
def test_cross_products(low, high):
    v = np.random.default_rng(1).integers(low, high, (131, 4))
    assert (whitening.cross_products(v) == v.T.astype(object) @ v.astype(object)).all()
    assert (whitening.cross_products(v[:0]) == 0).all()


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, n string").repartition(3)


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(4)
    a = (rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6)) + 3).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(a)] + [(None, a[0].tolist()), (7, a[7].tolist())]
    bad = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] + [0.0] * 5), (904, [1.0]), (905, [])]
    got = whitening.whitened(vectors(spark, rows + bad), components=4).toPandas()
    x = np.floor(64 * np.array([v for _, v in rows], dtype=np.float64)) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    off = x - s / n
    values, comps = np.linalg.eigh(off.T @ off / n)
    values, comps = values[::-1], comps[:, ::-1]
    want = off @ comps / np.sqrt(values)
    assert len(got) == 4 * n and set(got.n) == {n} and got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    exact = {i: sum((n * int(v) - int(t)) ** 2 for v, t in zip(r, s)) for i, r in enumerate(x)}
    for c in range(1, 5):
        part = got[got.component == c]
        assert np.allclose(part.explained, values[c - 1] / values.sum(), rtol=1e-9)
        mine = {(-1 if np.isnan(i) else int(i)): w for i, w in zip(part.vec_id, part.whitened)}
        sign = np.sign(mine[0] * want[0, c - 1])
        assert all(abs(mine[i] * sign - want[i, c - 1]) < 1e-8 for i in range(300))
    deviations = got[got.component == 1].dropna(subset="vec_id").drop_duplicates("vec_id").set_index("vec_id").deviation
    assert all(deviations[i] == exact[i] for i in range(300))
    assert got.vec_id.isna().sum() == 4 and (got.vec_id == 7).sum() == 8


def test_whitening_edges(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3, [(1, [])]):
        made = whitening.whitened(vectors(spark, rows))
        assert made.count() == 0 and made.columns[:2] == ["vec_id", "component"]
    # One dimension without spread: one component; a deviation beyond a long is null.
    flat = whitening.whitened(vectors(spark, [(i, [float(i), 5.0]) for i in range(10)])).toPandas()
    assert set(flat.component) == {1} and flat.explained[0] == 1.0
    wide = whitening.whitened(vectors(spark, [(i, [float(i) * 2.0**40]) for i in range(9)])).toPandas()
    assert wide.deviation.isna().any() and wide.identity_error[0] < 1e-9


# --- 13 ------------------------------------------------------------------------------------------


def plain_variants(rows):
    counts = Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower(t)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def one(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = max(a, b, key=len), min(a, b, key=len)
        return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))

    near = {w: [x for x in words if one(w, x)] for w in words}
    best = {w: min(near[w], key=lambda x: (-words[x], x), default=None) for w in words}
    form = {w: b if b and words[b] >= 2 * words[w] else None for w, b in best.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words}


def noisy_rows(rnd, n):
    base = ["letter", "lettre", "aaaaaa", "königreich", "Straße", "naïveté", "abcde", "x" * 70, "thing", "things", "thingss"]
    out = []
    for i in range(n):
        words = []
        for _ in range(60):
            w = list(rnd.choice(base))
            if rnd.random() < 0.4:
                at = rnd.randrange(len(w))
                w[at:at + rnd.randint(0, 1)] = rnd.choice(["", "a", "é", "z", "E"])
            words.append("".join(w))
        out.append((i if i % 9 else None, rnd.choice([" ", "1", "\n", "-"]).join(words), "s"))
    return out


@pytest.mark.parametrize("cell", [spelling.CELL, 3])
def test_variants_against_all_pairs(frame, cell):
    """Also with subtrees of three words at most, cut by all prefix groups and by hash."""
    rnd = random.Random(6)
    rows = noisy_rows(rnd, 90) + list(ODD) + [(5000 + i, "y" * 300 + " " + "y" * 299 + " " + "y" * 299, "s") for i in range(3)]
    rows += [(6000, "chainone " * 40 + "chaintwo " * 3 + "chainonx " * 12 + "chaintnx " + "chainoyx " * 5, "s")]
    made = spelling.variants(frame(rows), cell=cell)
    assert made.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in made.collect()]
    assert len(got) == len(set(got)) and set(got) == plain_variants(rows)
    assert any(f and r != f for _, f, r, *_ in got)


def test_variants_of_nothing(frame):
    for rows in ([], [(1, None)], [(1, ""), (2, "abcde abcde")]):
        assert spelling.variants(frame(rows)).count() == 0


def test_walk_spends_one_surplus_and_one_deficit():
    rng = np.random.default_rng(2)
    q, w = rng.integers(0, 3, (200, 5)).astype(np.uint8), rng.integers(0, 3, (150, 5)).astype(np.uint8)
    spent = rng.integers(0, 2, (200, 2))
    got = sorted((int(a), int(b)) for x, y in spelling.walk(q, spent, w) for a, b in zip(x, y))
    off = q[:, None].astype(int) - w[None].astype(int)
    plus, minus = np.maximum(off, 0).sum(axis=2), np.maximum(-off, 0).sum(axis=2)
    want = np.argwhere((plus + spent[:, :1] <= 1) & (minus + spent[:, 1:] <= 1))
    assert got == sorted(map(tuple, want.tolist()))
