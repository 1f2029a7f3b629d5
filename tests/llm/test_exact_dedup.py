import hashlib
import random

from pyspark.sql import functions as F

from civicflow.llm import exact_dedup as ed
from civicflow.session import scratch_path


def normal(text):
    return "".join(c for c in (text or "") if c not in "\t\n\x0b\x0c\r ")


def brute(rows):
    """(doc_id, keep_id, group_size, text_sha256) of every row, and the number of rows kept."""
    groups = {}
    for r in rows:
        groups.setdefault(normal(r[1]), []).append(r)
    keep = {k: min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0] for k, g in groups.items()}
    return [(r[0], keep[k], len(groups[k]), hashlib.sha256(k.encode()).hexdigest()) for r in rows for k in [normal(r[1])]], len(groups)


def check(got, rows):
    want, n_kept = brute(rows)
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=key) == sorted(want, key=key)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == n_kept == len({r["text_sha256"] for r in kept}) and all(r["doc_id"] == r["keep_id"] for r in kept)


def corpus(seed=1):
    rng = random.Random(seed)
    texts = [None, "", " ", "\n\t\x0b\x0c\r", "a b", "ab", "a b", "a\x1cb", "a\x85b", "é 😀", "é😀", "a\x00b", "x " * 50_000, "x" * 50_000]
    texts += ["".join(rng.choice("ab \n") for _ in range(rng.randint(0, 5))) for _ in range(300)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(5, "a b", "en", "s", 0), (5, "a b", "en", "s", 0), (None, "a  b", "en", "s", 0), (None, "only null", None, None, None)]
    rng.shuffle(rows)
    return rows


def test_against_brute_force(spark, docs, monkeypatch):
    rows = corpus()
    for share in (1000, 5):  # all groups joined, or the large ones broadcast
        monkeypatch.setattr(ed, "HOT_SHARE", share)
        check(ed.deduplicated(docs(rows)).collect(), rows)


def test_hot_text_and_clashing_columns(spark, docs):
    rows = [(i, "the same  text" if i % 2 else f"text {i // 4}", "en", "s", 0) for i in range(4000)]
    df = docs(rows).withColumns({c: F.lit(1) for c in ("digest", "uid", "keep_id", "kept", "copies", "batch")})
    check(ed.deduplicated(df).collect(), rows)


def test_empty_table(spark, docs):
    got = ed.deduplicated(docs([]))
    assert got.count() == 0 and got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_batches_keep_what_the_index_holds(spark, docs):
    index = ed.DigestIndex.create(spark, scratch_path(spark, "index"), 4)
    first = [(1, "a", "en", "s", 0), (2, "b", "en", "s", 0), (3, " b", "en", "s", 0)]
    second = [(0, "a  ", "en", "s", 0), (4, "c", "en", "s", 0), (5, "c ", "en", "s", 0)]
    state = lambda df: sorted((r["doc_id"], r["keep_id"], r["known"], r["group_size"], r["kept"]) for r in df.collect())
    assert state(index.add(docs(first), "one")) == [(1, 1, False, 1, True), (2, 3, False, 2, False), (3, 3, False, 2, True)]
    want = [(0, 1, True, 1, False), (4, 5, False, 2, False), (5, 5, False, 2, True)]
    assert state(index.add(docs(second), "two")) == want
    again = ed.DigestIndex.open(spark, index.root)
    assert again.buckets == 4 and again.entries().count() == 3
    assert state(again.add(docs(second), "two")) == want  # a repeated batch finds its own entries
    assert again.entries().count() == 3
    assert state(again.add(docs([]), "none")) == [] and again.entries().count() == 3


def test_a_batch_cut_short_is_completed(spark, docs):
    index = ed.DigestIndex.create(spark, scratch_path(spark, "index"), 4)
    rows = [(i, f"text {i % 40}", "en", "s", 0) for i in range(80)]
    groups = ed.grouped(ed.digests(docs(rows)))
    index.append(index.new_groups(groups.where("own_id < 17")), "one")  # the driver is lost after a part
    got = index.add(docs(rows), "one").withColumn("text_sha256", F.lower(F.hex("digest"))).collect()
    check(got, rows)
    assert index.entries().count() == 40


def test_compaction_keeps_the_entries(spark, docs):
    index = ed.DigestIndex.create(spark, scratch_path(spark, "index"), 2)
    for i in range(3):
        index.add(docs([(10 * i + j, f"t {i} {j}", "en", "s", 0) for j in range(5)]), f"b{i}").count()
    new = index.compacted(scratch_path(spark, "index"))
    assert sorted(map(str, new.entries().collect())) == sorted(map(str, index.entries().collect()))
    assert len(new.entries().inputFiles()) <= 2 < len(index.entries().inputFiles())
    assert {r["known"] for r in new.add(docs([(99, "t00", "en", "s", 0)]), "b9").collect()} == {True}


def test_index_is_merged_in_place(spark, docs):
    """Anti-join by sort-merge; the index side is neither shuffled nor broadcast."""
    index = ed.DigestIndex.create(spark, scratch_path(spark, "index"), 6)
    index.add(docs([(i, f"t {i}", "en", "s", 0) for i in range(50)]), "one").count()
    groups = ed.grouped(ed.digests(docs([(i, f"t {i}", "en", "s", 0) for i in range(60)])))
    new = index.new_groups(groups)
    assert new.count() == 10
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Bucketed: true" in plan and "SelectedBucketsCount: 6 out of 6" in plan
    final = plan[plan.index("LeftAnti"):].split("Initial Plan")[0]
    scan = final.splitlines()[[i for i, x in enumerate(final.splitlines()) if "Bucketed: true" in x][0]]
    above = final[:final.index(scan)].splitlines()
    assert not any("Exchange" in x for x in above[-3:])
    before = set(index.entries().inputFiles())
    index.append(new, "two")
    assert 1 <= len(set(index.entries().inputFiles()) - before) <= 6  # a file a bucket at most
