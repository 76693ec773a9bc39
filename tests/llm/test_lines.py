from __future__ import annotations

from random import Random

import pytest
from pyspark.sql import functions as F

from quillstack.llm import line_dedup as L
from quillstack.llm.common import load
from quillstack.llm.components import components


def shingles(line):
    units = line.encode("utf-16-be")
    n = max(len(units) // 2 - L.SHINGLE, 0) + 1
    return frozenset(units[2 * i : 2 * i + 2 * L.SHINGLE] for i in range(n))


def firsts(rows):
    """The first line of each line's component, by comparing all pairs of lines."""
    lines = [(d, i, x) for d, t in sorted(rows, key=lambda r: r[0]) for i, x in enumerate((t or "").split("\n")) if x.strip(" \t\n\r\x0b\x0c")]
    kinds = list(dict.fromkeys(x for _, _, x in lines))
    sets = {x: shingles(x) for x in kinds}
    head = {x: x for x in kinds}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for a in range(len(kinds)):
        for b in range(a + 1, len(kinds)):
            s, t = sets[kinds[a]], sets[kinds[b]]
            if 80 * max(len(s), len(t)) <= 100 * min(len(s), len(t)) and 100 * len(s & t) >= 80 * len(s | t):
                head[find(kinds[b])] = find(kinds[a])
    first = {}
    for d, i, x in lines:
        first.setdefault(find(x), (d, i))
    return {(d, i): first[find(x)] for d, i, x in lines}


def test_recall(spark):
    """Nearly all lines of a sample of documents get the first line that all pairs give, and none a wrong one."""
    docs = load(spark, "/root/testdata/sf0.01", "documents").where("doc_id < 260")
    want = firsts([(r.doc_id, r.text) for r in docs.collect()])
    got = {(r.doc_id, r.line_no): (r.first_doc_id, r.first_line_no) for r in L.lines(docs).collect()}
    assert set(got) == set(want)
    copies = [k for k in want if want[k] != k]
    assert sum(got[k] == want[k] for k in copies) >= 0.95 * len(copies)
    assert all(want[got[k]] == want[k] for k in got)


def test_threshold(make):
    """Of pairs of lines 0.80 to 0.85 alike, nearly all are found."""
    r = Random(11)
    some = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    rows = []
    while len(rows) < 2400:
        a = some(200)
        b = a[:180] + some(r.randint(10, 25))
        s, t = shingles(a), shingles(b)
        if 80 * len(s | t) <= 100 * len(s & t) < 85 * len(s | t):
            rows += [(len(rows), a), (len(rows) + 1, b)]
    got = {r.doc_id: r.first_doc_id for r in L.lines(make(rows)).collect()}
    assert sum(got[i + 1] == i for i in range(0, len(rows), 2)) >= 0.99 * len(rows) / 2


def families(count, seed=5):
    """Lines of one template, each of `count` variants 0.70 to 0.79 alike to the others, with a near copy."""
    r = Random(seed)
    some = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    template = some(400)
    kinds = [template + some(60) for _ in range(count)]
    return [(i, t) for i, t in enumerate(kinds)] + [(1000 + i, t[:-3] + some(3)) for i, t in enumerate(kinds)]


@pytest.mark.parametrize("count", [40, 250])
def test_crowded(make, count):
    """In buckets of many variants, each variant's near copies are found."""
    rows = families(count)
    want = firsts(rows)
    assert len(set(want.values())) == count
    got = {(r.doc_id, r.line_no): (r.first_doc_id, r.first_line_no) for r in L.lines(make(rows)).collect()}
    assert sum(got[k] == want[k] for k in want) >= 0.99 * len(want)
    assert all(want[got[k]] == want[k] for k in got)


def test_sketches(spark):
    """Sketches rule out unlike lines, and hardly any pair at the threshold."""
    r = Random(17)
    some = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    rows = []
    for k in range(1200):
        a = some(300)
        rows.append((k, a, a[: 300 - (33 if k % 2 else 50)] + some(33 if k % 2 else 50)))
    df = spark.createDataFrame(rows, "k long, x string, y string")
    sides = [L.prefixed(L.sketches(df.select(F.col("k").alias("key"), F.col(c).alias("line"))), f"{c}_").withColumnRenamed(f"{c}_key", "k") for c in "xy"]
    out = df.join(sides[0], "k").join(sides[1], "k").select("k", L.hopeful("x_", "y_", 80).alias("ok")).collect()
    assert sum(o.ok for o in out if o.k % 2) >= 594
    assert sum(o.ok for o in out if o.k % 2 == 0) <= 30


def test_blocks(spark):
    """Pairs by blocks are all pairs of a bucket's different components, once each."""
    rows = [(b, k, 1, 0, 0, k // 3, 50) for b in (1, 2) for k in range(50)]
    named = spark.createDataFrame(rows, "bucket long, key long, shingles int, v0 long, v1 long, component long, m long")
    got = sorted((r.bucket, *sorted((r.x_key, r.y_key))) for r in L.in_blocks(named, F.col("x_key") + F.col("y_key") >= 20, block=7).collect())
    assert got == [(b, i, j) for b in (1, 2) for i in range(50) for j in range(i + 1, 50) if i // 3 != j // 3 and i + j >= 20]
    assert L.pairs_left(named) == 2 * sum(i // 3 != j // 3 for i in range(50) for j in range(i))
    some = L.in_blocks(named, F.col("x_key") + F.col("y_key") >= 90, "left_semi", 7).select("bucket", "x_key").distinct().collect()
    assert sorted(map(tuple, some)) == [(b, k) for b in (1, 2) for k in range(41, 50)]


def test_dedup(make):
    base = "the quick brown fox jumps over the lazy dog near the old stone dam by the river side"
    near = base.replace("lazy", "lazi")
    docs = make([(1, base + "\nunique one"), (2, near + "\n\nunique two"), (3, base), (4, ""), (5, None), (6, "tiny\ntiny"), (7, "unique two" + "\n" + base)])
    out = {r.doc_id: (r.text, r.n_chars) for r in L.dedup(docs).collect()}
    assert out == {1: (base + "\nunique one", len(base) + 11), 2: ("\nunique two", 11), 4: ("", 0), 5: (None, None), 6: ("tiny", 4)}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_shuffle(make, monkeypatch):
    """dedup shuffles each text once, for the join and the choice among repeated rows alike."""
    docs = make([(1, "a b\nc"), (None, "x")])
    found = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.lit(0).cast("long").alias("line_no"), F.col("doc_id").isNull().alias("kept"))
    monkeypatch.setattr(L, "lines", lambda docs, **options: found)
    text = plan(L.dedup(docs))
    assert "Exchange" not in text[text.index("Window") : text.index("Join")]
    row = text[text.index("struct(") : text.index(" AS row")]
    assert "n_chars" in row and "text" not in row


def test_sketch_sets(spark):
    """Sketches deal lines by key once and collect no sets; their sizes are those of the sets of hashes."""
    rows = [(k, "abcdefghij" * k + "xyz") for k in range(6)]
    out = L.sketches(spark.createDataFrame(rows, "key long, line string"))
    assert "collect_set" not in plan(out)
    assert plan(out).count("Exchange") == 1
    assert {r.key: r.size for r in out.collect()} == {k: len(shingles(x)) for k, x in rows}


def test_text_hashed_once(make):
    """A text is hashed below the generator of its lines, not again for each line."""
    text = plan(L.line_rows(make([(1, "a b\nc"), (2, None)])))
    assert "xxhash64(text" not in text[: text.index("Generate")].replace(" ", "")
    assert "xxhash64(text" in text[text.index("Generate") :].replace(" ", "")


def test_sets_in_rows(spark):
    """Different shingles are taken within a line's row, in compiled code: no grouping by shingle, no array_distinct in a lambda."""
    rows = [(1, "abababababababababab"), (2, "short"), (3, "x\U0001f600" * 9), (4, "")]
    df = spark.createDataFrame(rows, "key long, line string")
    assert plan(L.sketches(df)).count("HashAggregate") == 2
    sets = df.select("key", L.shingle_set(F.col("line")).alias("s"))
    assert "array_distinct" not in plan(sets)[plan(sets).index("lambdafunction") :]
    assert {r.key: (len(r.s), len(set(r.s))) for r in sets.collect()} == {k: (len(shingles(x)),) * 2 for k, x in rows}


def test_buckets(spark):
    """Classes that share a band with another, once a bucket, with one shuffle; equal to counting all pairs."""
    rows = [(k, [k // 2, 100 + k % 3, 200 + k]) for k in range(7)]
    out = L.met_in_buckets(spark.createDataFrame(rows, "key long, bands array<long>"))
    assert plan(out).count("Exchange") == 1
    count = {b: sum(b in bands for _, bands in rows) for _, bands in rows for b in bands}
    assert sorted((r.bucket, r.key, r.m) for r in out.collect()) == sorted((b, k, count[b]) for k, bands in rows for b in bands if count[b] > 1)


def test_twos(spark):
    """Buckets of two unlike classes go by a window over the rows as they lie; others stay whole."""
    near = lambda v: v ^ 0b1 ^ 0b1 << 8
    v = 0x01_02_03_04_05_06_07
    rows = [(1, 10, 100, v, v), (1, 11, 100, near(v), v), (2, 12, 100, v, v), (2, 13, 39, v, v), (3, 14, 100, v, 0), (3, 15, 100, ~v & L.SEVENS, L.SEVENS)]
    rows += [(4, 16 + k, 100, v * k & L.SEVENS, k) for k in range(3)] + [(5, 20, 100, v, v)]
    signed = spark.createDataFrame([(k, n, x, y, [b]) for b, k, n, x, y in rows], "key long, shingles int, v0 long, v1 long, bands array<long>")
    out = L.without_unlike_twos(L.met_in_buckets(signed), 80, 7)
    assert plan(out).count("Exchange") == 1 and "Join" not in plan(out)
    assert sorted((r.bucket, r.key, r.m) for r in out.collect()) == [(1, 10, 2), (1, 11, 2), (4, 16, 3), (4, 17, 3), (4, 18, 3)]


def test_lanes(spark):
    """A signature holds the least and the greatest flipped hash of each mask; its aggregates share no expression."""
    rows = [(k, "the quick brown fox jumps over"[: 4 + 3 * k]) for k in range(9)]
    out = L.signatures(spark.createDataFrame(rows, "key long, line string"))
    text = plan(out)
    assert "greatest" not in text[text.index("partial_") :].split("]")[0]
    hashes = {r.key: r.s for r in spark.createDataFrame(rows, "key long, line string").select("key", L.shingle_set(F.col("line")).alias("s")).collect()}
    for r in out.collect():
        assert [r[f"s{j}"] for j in range(14)] == [f(h ^ m for h in hashes[r.key]) for m in L.MASKS for f in (min, max)]


def test_blank_lines(make):
    """Lines of ASCII white space alone have no key, found without a pattern."""
    docs = make([(1, " \t\x0b\f\r\n\n x\n\x1c\n\u00a0\n\u3000 \n\x00\nx ")])
    assert "RLIKE" not in plan(L.line_rows(docs))
    assert [r.key is None for r in L.line_rows(docs).orderBy("line_no").collect()] == [True, True, False, False, False, False, False, False]


def test_repeated_rows(make):
    """Of equal rows one stays, with its text but for lines that no copy keeps."""
    base = "the quick brown fox jumps over the lazy dog near the old stone dam by the river side"
    two = "tiny\n\n" + base + "\ntiny"
    docs = make([(1, "another line of text here\nsecond"), (2, two), (2, two), (2, two), (3, None), (3, None), (None, "x y z\nof none"), (None, "x y z\nof none")])
    out = sorted(((r.doc_id, r.text) for r in L.dedup(docs).collect()), key=str)
    assert out == [(1, "another line of text here\nsecond"), (2, "tiny\n\n" + base), (3, None), (3, None), (None, "x y z\nof none")]


def test_odd(odd, none):
    out = L.dedup(odd)
    assert out.columns == odd.columns
    assert out.where("doc_id = 1").count() <= 1
    assert L.dedup(none).count() == 0
    assert L.lines(none).count() == 0


def test_components(spark):
    r = Random(8)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(50)] + [(None, 1)]
    head = {}

    def find(x):
        head.setdefault(x, x)
        while head[x] != x:
            x = head[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            head[b] = a
    want = {x: find(x) for x in head}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {x.node: x.component for x in got} == want
    assert len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def named_rows(seed):
    """Rows (bucket, key, shingles, v0, v1, component, led, rank, m) of classes in three buckets and one of a single class."""
    r = Random(seed)
    rows = [(b, k, 50, k, b, r.choice([k, k // 4]), r.random() < 0.3, (r.randrange(4) << 32) | k) for b in (1, 2, 3) for k in r.sample(range(40), 9)] + [(4, 7, 50, 7, 4, 7, False, 7)]
    size = {b: sum(x[0] == b for x in rows) for b in (1, 2, 3, 4)}
    return [(*x, size[x[0]]) for x in rows]


NAMED = "bucket long, key long, shingles int, v0 long, v1 long, component long, led boolean, rank long, m long"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_leaders(spark, seed):
    """Classes meet the leader of their bucket, and buckets of one component go, as a plain loop finds, with one shuffle by bucket."""
    rows = named_rows(seed)
    named = spark.createDataFrame(rows, NAMED)
    merged = {k: k % 3 for k in range(0, 40, 2)}
    links = spark.createDataFrame(list(merged.items()), "key long, component long")
    lead = {}
    for b, k, *_, component, led, rank, _m in rows:
        if not led:
            lead[b] = max(lead.get(b, (-1,)), (rank, k, component))
    met = L.with_leaders(named)
    assert plan(met).count("Exchange") == 1 and "Join" not in plan(met)
    want = sorted((k, lead[b][1]) for b, k, *_, component, led, rank, _m in rows if not led and component != lead[b][2])
    assert sorted((x.x_key, x.y_key) for x in met.collect()) == want
    for first in (True, False):
        now = {}
        for b, k, *_, component, led, rank, _m in rows:
            if not (first and b in lead and k == lead[b][1]):
                now.setdefault(b, []).append((k, merged.get(k, component), led))
        own = {x[1]: x[5] for x in rows if x[1] not in merged}
        head = {b: merged.get(k, own.get(k, component)) for b, (_, k, component) in lead.items()}
        want = sorted((b, k, c, led or head.get(b) == c) for b, x in now.items() if len({c for _, c, _ in x}) > 1 for k, c, led in x)
        out = L.still_open(named, links, first)
        assert plan(out).count("hashpartitioning(bucket") == 1
        assert sorted((x.bucket, x.key, x.component, x.led) for x in out.collect()) == want


def test_candidates(spark):
    """Classes close to another one of their bucket, counted anew; buckets of two take no part in the join."""
    rows = [(1, 10, 2), (1, 11, 2), (2, 12, 4), (2, 13, 4), (2, 30, 4), (2, 60, 4), (3, 14, 3), (3, 34, 3), (3, 54, 3)]
    met = spark.createDataFrame([(b, k, 50, k, k, k, k, m) for b, k, m in rows], "bucket long, key long, shingles int, v0 long, v1 long, component long, rank long, m long")
    out = L.with_candidates(met, F.abs(F.col("x_key") - F.col("y_key")) < 5)
    assert out.columns == met.columns
    assert sorted((x.bucket, x.key, x.m) for x in out.collect()) == [(1, 10, 2), (1, 11, 2), (2, 12, 2), (2, 13, 2)]
    text = plan(out)
    assert "(m" in text[text.index("Join") :] and "> 2)" in text


def test_rounds_deal_once(make, monkeypatch):
    """A round deals the rows of buckets once for its pairs and once for what is left of them."""
    plans, write = [], L.materialize
    monkeypatch.setattr(L, "materialize", lambda df, name: plans.append((name, plan(df))) or write(df, name))
    assert L.lines(make(families(5))).where("kept").count() == 5
    names = [name for name, _ in plans]
    first = names.index("pairs")
    assert plans[first][1].count("hashpartitioning(bucket") == 1
    assert [text.count("hashpartitioning(bucket") for name, text in plans if name == "named"] == [1] * names.count("named")


def test_sketch_is_one_column(spark):
    """A sketch is one array of longs, so that a join's condition need not read them all for each pair."""
    out = L.sketches(spark.createDataFrame([(1, "the quick brown fox")], "key long, line string"))
    assert out.columns == ["key", "size", "odd"]
    assert [len(x.odd) for x in out.collect()] == [L.ODD]


def test_joined_by(spark):
    """Components linked by further pairs are those of all pairs at once."""
    r = Random(3)
    for n in (0, 12, 60):
        old = [(r.randrange(80), r.randrange(80)) for _ in range(40)]
        new = [(r.randrange(120), r.randrange(120)) for _ in range(n)]
        some = lambda pairs: spark.createDataFrame(pairs, "a long, b long")
        merged = components(some(old)).withColumnRenamed("node", "key")
        got = L.joined_by(merged, some(new)).collect()
        want = {x.node: x.component for x in components(some(old + new)).collect()}
        assert {x.key: x.component for x in got} == want and len(got) == len(want)


def test_repeated_shingles(spark):
    """Lines that repeat shingles are judged by their sets, as far as the numbers of shingles don't suffice; no set is taken before."""
    r = Random(4)
    lines = ["ab" * n + tail for n in (6, 30, 90) for tail in ("", "cdefgh", "xyz")] + ["".join(r.choice("ab") for _ in range(40)) for _ in range(6)]
    lines += [x[:-1] for x in lines] + ["a long line of words that has no repeated shingle at all", "a long line of words that has no repeated shingle at al"]
    texts = spark.createDataFrame(list(enumerate(lines)), "key long, line string")
    pairs = [(i, j) for i in range(len(lines)) for j in range(i + 1, len(lines))]
    out = L.verified(spark.createDataFrame(pairs, "a long, b long"), texts, 80)
    assert "array_distinct" not in plan(out)
    sets = [shingles(x) for x in lines]
    assert sorted(map(tuple, out.collect())) == [(i, j) for i, j in pairs if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
