"""Exact dedup, sharding, mixing and line dedup against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import LONG, ODD
from tripflow.llm import exact_dedup, line_dedup, mixing, sharding, stages
from tripflow.llm.common import bucket_number, bucket_of, permuted, permuted_back

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 12, 100, 997, 4096])
def test_permutation_is_one_and_has_an_inverse(spark, n):
    d = spark.range(n).withColumn("p", permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3)))
    rows = d.withColumn("back", permuted_back(F.col("p"), F.lit(n).cast("long"), F.lit(3))).collect()
    assert sorted(r.p for r in rows) == list(range(n)) and all(r.back == r.id for r in rows)


def test_bucket_of(spark):
    for bounds in ([], [5], [1, 5, 9, 9, 30, 41, 50], list(range(0, 170, 10))):
        rows = spark.range(-3, 190).select("id", bucket_of(F.col("id"), bounds).alias("b")).collect()
        assert all(r.b == bucket_number(r.id, bounds) == sum(x < r.id for x in bounds) for r in rows)


def test_exact_groups(frame, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FIRST", 2)
    monkeypatch.setattr(exact_dedup, "GROWTH", 3)
    rows = [*ODD, (11, "prefix shared one", "s"), (12, "prefix shared two", "s"), (13, "prefix shared one", "s"), (13, "prefix shared one", "s")]
    got = exact_dedup.exact_groups(frame(rows)).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    want = Counter()
    for text, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        sha, kept = hashlib.sha256(text.encode()).hexdigest(), 0
        for i in sorted(ids, key=lambda i: i != top):
            want[(i, top, len(ids), kept == 0, sha)] += 1
            kept = 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == want
    assert exact_dedup.exact_groups(frame([])).count() == 0


def test_shards(frame):
    rows = ODD * 5
    for _ in range(2):
        got = sharding.shard_rows(frame(rows), shards=4).collect()
        per = defaultdict(list)
        for r in got:
            per[r.shard].append(r.slot)
        assert all(sorted(v) == list(range(len(v))) for v in per.values())
        assert max(map(len, per.values())) - min(map(len, per.values())) <= 1
        want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
        seen = Counter((r.doc_id, r.text_crc32, r.shard, r.slot) for r in got)
        if _:
            assert seen == first
        first = seen
    back = sharding.shard_rows(frame(rows), shards=4)
    back = back.withColumn("again", sharding.row_number_at(F.col("shard"), F.col("slot"), len(rows), 7, 4))
    assert back.filter("again <> row_number").count() == 0
    assert sharding.shard_rows(frame([]), shards=4).count() == 0


def fill(sizes, weights=(5, 2, 1), share=1.5):
    """Targets by sharing the excess again until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    out, open_, left = {}, set(order), share * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > 2 * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in open_}
        out |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    return out


def test_mix(spark, frame):
    rows = [*ODD, *[(100 + i, " ".join(f"{i}_{k}" for k in range(i % 40)), f"s{i % 7}") for i in range(200)]]
    mix = mixing.Mix(frame(rows), block_words=8, shard_slots=16)
    got = mix.taken().collect()
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(WORDS.findall(t or ""))
    target = fill(dict(sizes))
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((i, s, len(WORDS.findall(t or ""))) for i, t, s in rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 3)
    again = mixing.Mix(frame(rows[::-1]), block_words=8, shard_slots=16)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert Counter(tuple(r) for r in again.taken().collect()) == Counter(tuple(r) for r in got)
    counts = mixing.shard_counts(mix.draws).groupBy("shard").agg(F.sum("slots").alias("n")).collect()
    assert all(r.n == 16 for r in counts if r.shard < max(c.shard for c in counts))
    blocks = mix.blocks().collect()
    assert len(blocks) == mix.draws.count() and all(1 <= len(b.words) <= 8 for b in blocks)
    text_words = Counter(w for b in blocks for w in b.words)
    docs = mix.documents().collect()
    assert Counter(w for d in docs for w in d.text.split(" ")) == text_words
    assert sum(text_words.values()) == sum(taken.values()) and all(d.n_chars == len(d.text) and d.size == "x" for d in docs)
    assert mixing.Mix(frame([])).taken().count() == 0 and mixing.Mix(frame([(1, None), (2, " ")])).taken().count() == 2


def test_mix_keeps_the_layout(spark, frame):
    rows = [(i, f"  def f{i}(x):\n\tif x:\n" + "".join(f"\t\ta{i}_{k} = {k}  # n\r\n" for k in range(i % 23)) + "\n", f"s{i % 3}") for i in range(60)]
    rows += [(100, "a\n b", "s1"), (101, "\tc d", "s1"), (101, "\tc d", "s1")]
    mix = mixing.Mix(frame(rows), block_words=8, shard_slots=16)
    taken = Counter()
    for r in mix.taken().collect():
        taken[r.doc_id] += r.taken
    parts = defaultdict(list)
    for r in mix.ranges.collect():
        parts[r.id].append((r["pass"], r.start, r.skip, r.n))
    got, kinds = {r.doc_id: r for r in mix.documents(layout=True).collect()}, Counter()
    assert set(got) == {i for i in taken if taken[i]}
    for i, t, _ in rows:
        if i not in got:
            continue
        ends = [m.span() for m in WORDS.finditer(t)]
        want, last = "", None
        for at, (_, _, skip, n) in enumerate(sorted(parts[i])):
            a = 0 if skip == 0 else ends[skip - 1][1]
            piece = t[a:len(t) if skip + n == len(ends) else ends[skip + n - 1][1]]
            piece = piece.lstrip() if at == 0 and skip else piece
            want += (" " if want and not want[-1].isspace() and not piece[0].isspace() else "") + piece
        assert got[i].text == want and got[i].n_chars == len(want)
        if taken[i] == len(ends) and len({p[0] for p in parts[i]}) == 1:
            kinds["whole"] += 1
            assert want == t
        kinds["twice"] += want == t + t
    assert kinds["whole"] and kinds["twice"]
    assert any("\n\t" in r.text for r in stages.mix_sources(spark, frame(rows), "").collect())


def test_targets_of_a_source_per_document(spark, frame):
    """As many sources as documents: right targets, and no task that ranks or sums them all."""
    rows = [(i, " ".join("w" * (1 + i % 3) for _ in range(i * 37 % 101)), f"u{i * 7919 % 1009}") for i in range(600)] + [(700, "a b", None)]
    conf = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        t = mixing.targets(mixing.sized(frame(rows)), block_words=8)
        got = sorted(t.withColumn("task", F.spark_partition_id()).collect(), key=lambda r: r.rank)
        empty = mixing.targets(mixing.sized(frame([]))).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(Counter(r.task for r in got).values()) <= len(got) / 2 and empty == 0
    sizes = {s: len(WORDS.findall(t)) for _, t, s in rows}
    assert [r.source for r in got] == sorted(sizes, key=lambda s: (s is None, s or "")) and [r["rank"] for r in got] == list(range(len(got)))
    target, first = fill(sizes), 0
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 and r.first_slot == first
        first += r.slots


def brute_lines(rows, min_sites):
    sites, first = defaultdict(set), {}
    key = lambda i, t, p: (i is None, i or 0, t, p)
    for i, t, s in rows:
        for p, line in enumerate((t or "").split("\n")):
            line = line.strip(" \t\x0b\x0c\r\n")
            if line:
                sites[line].add(s)
                first[line] = min(first.get(line, key(i, t, p)), key(i, t, p))
    out = []
    for i, t, s in rows:
        kept = [x for p, x in enumerate((t or "").split("\n")) if len(sites[x.strip(" \t\x0b\x0c\r\n")]) < min_sites or first[x.strip(" \t\x0b\x0c\r\n")] == key(i, t, p)]
        out.append((i, "\n".join(kept) if t is not None else None))
    return Counter(out)


def test_line_dedup(frame):
    rows = list(ODD)
    for i in range(60):
        rows.append((50 + i, f"own line number {i}\n  the shared footer here \nshort\nseen on few {i % 30}\nthe shared footer here", f"s{i % 9}" if i % 10 else None))
    # One id, eight texts on eight sites, none first by hash alone; and the same without an id.
    rows += [(i, f"{c} comes first\nfooter of one id {i}\nx", f"t{k}") for i in (900, None) for k, c in enumerate("hbgadcfe")]
    for sites in (2, 3, 5):
        got = line_dedup.drop_spread_lines(frame(rows), min_sites=sites)
        assert got.columns == frame([]).columns
        assert Counter((r.doc_id, r.text) for r in got.collect()) == brute_lines(rows, sites)
    assert line_dedup.drop_spread_lines(frame([])).count() == 0


def test_mix_keeps_the_sources_of_one_text_apart(frame):
    """One id and text on six sources: each row gives what its own source is to give."""
    rows = [(1, " ".join(f"w{i}" for i in range(24)), f"s{k}") for k in range(6)] + [(1, " ".join(f"w{i}" for i in range(24)), "s0")]
    mix = mixing.Mix(frame(rows), block_words=4)
    want = {r.source: round(r.target) for r in mix.sources.collect()}
    got = {r.source: len(WORDS.findall(r.text)) for r in mix.documents().collect()}
    assert len(want) == 6 and got == {s: n for s, n in want.items() if n}


def test_names_with_a_backtick(spark):
    d = spark.createDataFrame([(i, "a b c\nshared line here", f"s{i}", i) for i in range(8)], "doc_id long, text string, source string, `od``d name` int")
    assert line_dedup.drop_spread_lines(d).columns == d.columns and mixing.Mix(d).documents().columns == d.columns


def test_line_dedup_sites_by_the_hundred(frame):
    """Estimates far from and near the threshold agree with exact counts."""
    rows = [(n * 1000 + k, f"line on sites {n}\nmine {n} {k} x", f"s{k}") for n in (90, 98, 99, 100, 101, 102, 110, 140) for k in range(n)]
    got = line_dedup.drop_spread_lines(frame(rows), min_sites=100)
    left = Counter(re.search(r"sites (\d+)", r.text)[1] for r in got.collect() if "sites" in r.text)
    assert left == {"90": 90, "98": 98, "99": 99, "100": 1, "101": 1, "102": 1, "110": 1, "140": 1}


def test_line_dedup_stage_takes_lines_of_any_length(spark, frame):
    """The pipeline's stage exempts no line for having few words, nor a script without spaces."""
    rows = [(i, f"Les.\nRead more\n利用規約とプライバシーポリシーに同意します\nown{i}\n\nfew {i % 4}", f"s{i % 6}") for i in range(12)]
    rows += [(100, "few 0", "s0"), (101, None, "s1")]
    got = stages.drop_spread_lines(spark, frame(rows), "").collect()
    assert Counter((r.doc_id, r.text) for r in got) == brute_lines(rows, line_dedup.MIN_SITES)
    assert sum("Les." in (r.text or "") for r in got) == 1
