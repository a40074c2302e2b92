import random

from pyspark.sql import functions as F

from qanat.operators.snapshots import consecutive, delivered_changes, keep_snapshots, snapshot_changes, version_changes

DOCS = "id string, source_id string, version string, metadata struct<status: string>, key string"
ARTICLES = "id string, document_id string, article_number string, text_ar string, text_en string, digest string"


def changes(spark, docs, articles):
    d = spark.createDataFrame([(i, s, v, (st,), "x") for i, s, v, st in docs], DOCS)
    a = spark.createDataFrame([(*r, "x") for r in articles], ARTICLES)
    return {tuple(r) for r in version_changes(a, d).collect()}


def test_kinds_spellings_and_order(spark):
    docs = [("d1", "s", "v1", "success"), ("d3", "s", "V03 ", "success"), ("d2", "s", "v2", "deleted"), ("d10", "s", "v10", "success"), ("e", "t", None, "success")]
    rows = [
        ("1", "d1", "5", "نص", ""), ("2", "d1", "ar_1", "على", ""), ("3", "d1", "7", "", "old"), ("4", "d1", None, "x", ""),
        ("5", "d3", "٠٥ ", "نص", ""), ("6", "d3", "AR_1", "علی", ""), ("7", "d3", "7", "", "new"), ("8", "d3", "7", "", "new"), ("9", "d2", "99", "x", ""),
        ("a", "d10", "5", "نصّ", ""),
        ("b", "e", "1", "x", ""), ("c", "nowhere", "1", "x", ""), ("d", None, "1", "x", ""),
    ]
    assert changes(spark, docs, rows) == {("d3", "7", "changed"), ("d10", "5", "changed"), ("d10", "ar_1", "removed"), ("d10", "7", "removed")}


def test_empty_tables(spark):
    assert changes(spark, [], []) == set()
    assert changes(spark, [("d1", "s", "v1", None)], []) == set()


def test_against_brute_force(spark):
    rng = random.Random(3)
    snaps = [(f"s{g}-{n}", f"s{g}", n) for g in range(4) for n in sorted(rng.sample(range(1, 12), 5))]
    rows = [(s, str(k), rng.choice("ab")) for s, g, n in snaps for k in range(200 if g == "s0" else 20) if rng.random() < 0.7]
    wanted = set()
    for g in range(4):
        own = [s for s, group, _ in snaps if group == f"s{g}"]
        for a, b in zip(own, own[1:]):
            old, new = ({k: d for s, k, d in rows if s == x} for x in (a, b))
            wanted |= {(b, k, "added" if k not in old else "removed" if k not in new else "changed") for k in old.keys() | new.keys() if old.get(k) != new.get(k)}
    order = consecutive(spark.createDataFrame(snaps, "id string, source string, n int"), "source", F.col("n"), "id")
    got = snapshot_changes(spark.createDataFrame(rows, "snapshot_id string, key string, digest string"), order)
    assert {tuple(r) for r in got.collect()} == wanted


def test_kept_ranges_give_what_all_history_gives(spark, tmp_path):
    rng = random.Random(5)
    snaps = [(f"s{n}", g, n) for g in ("a", "b") for n in range(1 if g == "a" else 11, 6 if g == "a" else 14)]
    rows = [(s, str(k), rng.choice("xy")) for s, _, _ in snaps for k in range(40) if rng.random() < 0.7]
    frame = lambda some: spark.createDataFrame(some, "snapshot_id string, key string, digest string")
    order = consecutive(spark.createDataFrame(snaps, "id string, source string, n int"), "source", F.col("n"), "id")
    late = {"s3", "s13"}  # one between two kept ones, one behind the last
    keep_snapshots(frame([r for r in rows if r[0] not in late]), str(tmp_path / "kept"))
    wanted = {tuple(r) for r in snapshot_changes(frame(rows), order).collect() if r["snapshot_id"] in {"s3", "s4", "s13"}}
    got = delivered_changes(frame([r for r in rows if r[0] in late]), order, str(tmp_path / "kept"))
    assert {tuple(r) for r in got.collect()} == wanted and len({s for s, _, _ in wanted}) == 3
    assert delivered_changes(frame([]), order, str(tmp_path / "kept")).count() == 0
