import hashlib
import random

from pyspark.sql import functions as F

from propensity.llm import bottomk as B

SCHEMA = "doc_id bigint, text string, th bigint, kid int, sketch string"


def shingles(t):
    w = (t or "").encode().lower().split()
    return {b" ".join(w[i:i + 5]) for i in range(len(w) - 4)} or ({b" ".join(w)} if w else set())


def likeness(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def edit(t, nxt):
    t, h = t or "", len(t or "") // 2
    return t[:len(t) - h] + (nxt or "")[:h]


def check(rows, got, tolerance=0.2):
    order = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, (d, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        r, e = by[d], edit(t, nxt)
        assert r.n_chars == len(t or "") and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest(), d
        assert abs(r.near_edited - likeness(t, e)) <= tolerance and abs(r.near_next - likeness(t, nxt)) <= tolerance, d
    prints = {}
    for d, t in rows:
        assert prints.setdefault(t or "", by[d].fingerprint) == by[d].fingerprint


def query(spark, rows, tmp_path, extra=()):
    from propensity.llm.queries import QUERIES
    d = str(tmp_path)
    spark.createDataFrame([(i, t, 1, 2, "x") for i, t in [*rows, *extra]], SCHEMA).repartition(4).write.parquet(f"{d}/documents.parquet")
    return QUERIES["op6_fingerprints"](spark, d).collect()


def test_against_brute_force(spark, tmp_path):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)] + ["É", "漢字", "A"]
    rows = []
    for i in range(80):
        n = rng.choice([0, 1, 3, 6, 50, 400])
        rows.append((i * 7, rng.choice(rows)[1] if rows and rng.random() < 0.2 else " ".join(rng.choices(words, k=n))))
    rows += [(10_000, None), (10_001, ""), (10_002, "long text " * 9000), (-5, "last\nof\tall A b")]
    got = query(spark, rows, tmp_path)
    check(rows, got)
    small = {d for d, t in rows if len(shingles(t)) < 60}
    order = sorted(rows, key=lambda r: -r[0])
    for i, (d, t) in enumerate(order):  # small sets fit the sketch: the likeness is exact
        e = edit(t, order[(i + 1) % len(order)][1])
        if d in small and len(shingles(e)) < 60:
            assert abs(next(r for r in got if r.doc_id == d).near_edited - likeness(t, e)) < 1e-12


def test_repeated_rows_and_null_ids(spark, tmp_path):
    rows = [(3, "a b c d e f g"), (2, "x y z"), (1, "q r s t u v")]
    got = query(spark, rows, tmp_path, extra=[rows[0], (None, "no id")])
    assert sorted(str(r.doc_id) for r in got) == ["1", "2", "3", "3", "None"]
    one = [r for r in got if r.doc_id == 3]
    assert one[0] == one[1] and one[0].edited_sha256 == hashlib.sha256(edit(rows[0][1], "x y z").encode()).hexdigest()
    last = next(r for r in got if r.doc_id is None)
    assert last.edited_sha256 == hashlib.sha256(edit("no id", rows[0][1]).encode()).hexdigest()


def test_merge_counts_and_containment(spark):
    text = " ".join(f"t{i}" for i in range(4000))
    part = " ".join(f"t{i}" for i in range(1000))
    df = spark.createDataFrame([(text, part)], "a string, b string").select(
        B.sketch(F.col("a")).alias("a"), B.sketch(F.col("b")).alias("b"))
    r = df.select(B.distinct_shingles(F.col("a")).alias("n"), B.containment(F.col("b"), F.col("a")).alias("c"),
                  B.resemblance(F.col("a"), F.col("b")).alias("r"), (B.merge(F.col("a"), F.col("b")) == F.col("a")).alias("m")).first()
    assert abs(r.n / 3996 - 1) < 0.3 and r.c > 0.7 and abs(r.r - 0.25) < 0.15 and r.m
    parts = spark.createDataFrame([(1, " ".join(f"t{i}" for i in range(a, a + 504))) for a in range(0, 4000, 500)], "g int, t string")
    whole = B.merged(parts.select("g", B.sketch(F.col("t")).alias("sketch")), ["g"]).first().sketch
    want = spark.createDataFrame([(" ".join(f"t{i}" for i in range(0, 4004)),)], "t string").select(B.sketch(F.col("t")).alias("s")).first().s
    assert whole == want


def test_empty(spark, tmp_path):
    assert query(spark, [], tmp_path) == []
    assert B.sketches(spark.createDataFrame([(1, None, 0, 0, "")], SCHEMA)).first().n_distinct == 0.0
