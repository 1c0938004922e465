"""The store of seen hashes against a set, and the files that are read."""
import hashlib

import pytest
from pyspark.sql import functions as F

from newsops.sources import seen


def hashes(spark, values):
    return spark.createDataFrame([(v,) for v in values], "hash string")


def md5(x):
    return hashlib.md5(str(x).encode()).hexdigest()


@pytest.fixture
def store(spark, tmp_path):
    path = str(tmp_path / "seen")
    have = set()
    for run, some in enumerate((range(0, 3000), range(2500, 4000), range(0, 10), range(9000, 9004))):
        new = {md5(x) for x in some}
        assert seen.append(hashes(spark, [*new, *list(new)[:5], None]), path, f"r{run}", file_rows=100) == len(new - have)
        have |= new
    return path, have


def test_store_equals_a_set(spark, store):
    path, have = store
    files = seen.manifest(spark, path)
    assert files.agg(F.sum("n")).first()[0] == len(have) == 4004
    assert files.where("substring(low, 1, 2) <> prefix or substring(high, 1, 2) <> prefix or n > 100").count() == 0
    asked = [md5(x) for x in (*range(100, 160), *range(50_000, 50_060))]
    assert {r[0] for r in seen.seen_among(hashes(spark, asked), path).collect()} == set(asked) & have
    rows = spark.createDataFrame([(i, h) for i, h in enumerate([*asked, None, asked[0]])], "i long, hash string")
    left = {r["i"] for r in seen.drop_seen(rows, path).collect()}
    assert left == {i for i, h in enumerate([*asked, None, asked[0]]) if h not in have}


def test_a_run_reads_only_files_that_may_hold_its_hashes(spark, store):
    path, have = store
    total = seen.manifest(spark, path).count()
    old, new = [md5(x) for x in (7, 2600, 9001)], [md5(x) for x in range(70_000, 70_200)]
    assert 3 <= seen.candidates(hashes(spark, old), path).count() <= 4 < total / 50
    assert seen.candidates(hashes(spark, new), path).count() <= 12  # one hash in a hundred, some four hundred places
    read = seen.seen_among(hashes(spark, old), path).inputFiles()
    assert len([f for f in read if "/data/" in f]) <= 4


def test_runs_that_come_again_or_die_add_nothing(spark, store, monkeypatch):
    path, have = store
    assert seen.append(hashes(spark, [md5("x")]), path, "r1") == 0
    monkeypatch.setattr(seen, "materialise", lambda df, name: df if name != "seen-manifest" else (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        seen.append(hashes(spark, [md5("y")]), path, "r9")
    monkeypatch.undo()
    assert seen.seen_among(hashes(spark, [md5("x"), md5("y")]), path).count() == 0
    assert seen.append(hashes(spark, [md5("y")]), path, "r9") == 1
    assert seen.append(hashes(spark, [md5("y"), md5(1)]), path, "r10") == 0


def test_absent_store(spark, tmp_path):
    assert seen.seen_among(hashes(spark, ["ab"]), str(tmp_path / "none")).count() == 0
    assert seen.drop_seen(hashes(spark, ["ab", None]), str(tmp_path / "none")).count() == 2


def test_a_batch_asks_the_store_once(spark, tmp_path, monkeypatch):
    """What the store lacks is told by drop_seen; append doesn't look it up again."""
    from newsops.sources import seen
    from newsops.streaming import stream

    ask, asked = seen.seen_among, []
    monkeypatch.setattr(seen, "seen_among", lambda *a, **k: asked.append(1) or ask(*a, **k))
    feed, out, store, state = (str(tmp_path / n) for n in ("feed", "out", "store", "state"))
    for k, titles in enumerate([["a", "b", "a"], ["b", "c"]]):
        spark.createDataFrame([(10 * k + i, t) for i, t in enumerate(titles)], "seq bigint, title string").write.mode("append").parquet(feed)
        rows = stream.article_stream(spark, feed, "seq bigint, title string", "parquet")
        stream.run_available(stream.store_dedup(rows, out, store, state))
    got = stream.read_batches(spark, out, "seq bigint, title string, hash string")
    assert sorted((r["seq"], r["title"]) for r in got.collect()) == [(0, "a"), (1, "b"), (11, "c")]
    assert len(asked) == 2 and seen.manifest(spark, store).agg({"n": "sum"}).first()[0] == 3
