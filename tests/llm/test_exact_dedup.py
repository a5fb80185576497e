import hashlib

import pytest

from gatewright.llm import exact_dedup as op

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, keep_id STRING, digest INT"


def norm(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def rows(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "x", 1) for i, t in pairs], SCHEMA)


def test_against_brute_force(spark):
    pairs = [(1, "Ab"), (2, "aB"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, "x" * 200_000), (8, "X" * 200_000), (9, "ab ")]
    found = {r.doc_id: r for r in op.exact_dedup(rows(spark, pairs)).collect()}
    assert len(found) == len(pairs)
    for i, t in pairs:
        group = [j for j, u in pairs if norm(u) == norm(t)]
        assert (found[i].keep_id, found[i].group_size, found[i].kept) == (max(group), len(group), i == max(group))
        assert found[i].text_sha256 == hashlib.sha256(norm(t).encode()).hexdigest()


def test_repeated_rows_and_null_ids_leave_one(spark):
    out = op.drop_exact_copies(rows(spark, [(1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b")]))
    assert sorted((r.doc_id, r.text) for r in out.collect() if r.doc_id) == [(1, "a")]
    assert out.count() == 2 and out.columns == SCHEMA.replace(",", "").split()[::2]


def test_later_batch_is_anti_joined(spark):
    index = op.DigestIndex.create(spark, buckets=3)
    op.exact_dedup(rows(spark, [(5, "a"), (6, "b")]), index, "first")
    second = {r.doc_id: r for r in op.exact_dedup(rows(spark, [(9, "A"), (10, "c"), (11, "c")]), index, "second").collect()}
    assert not second[9].kept and second[9].keep_id == 5
    assert second[11].kept and not second[10].kept
    assert index.table().count() == 3


def answers(frame):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in frame.collect())


def test_an_index_is_opened_again_by_its_path(spark, tmp_path):
    path = str(tmp_path / "index")
    first = op.DigestIndex.create(spark, path=path, buckets=3)
    op.exact_dedup(rows(spark, [(5, "a"), (6, "b")]), first, "first").collect()
    spark.sql(f"DROP TABLE {first.name}")  # a session that never heard of the table
    other = spark.newSession()
    again = op.DigestIndex.create(other, path=path)
    assert (again.buckets, again.table().count()) == (3, 2)
    found = answers(op.exact_dedup(rows(other, [(9, "A"), (10, "c")]), again, "second"))
    assert found == [(9, 5, 1, False), (10, 10, 1, True)]
    assert op.DigestIndex.create(spark, name=again.name, path=path).table().count() == 3
    with pytest.raises(ValueError):
        op.DigestIndex.create(spark, path=path, buckets=4)


def test_a_batch_added_again_changes_nothing(spark, tmp_path):
    index = op.DigestIndex.create(spark, path=str(tmp_path / "index"), buckets=2)
    op.exact_dedup(rows(spark, [(1, "x")]), index, "0").collect()
    pairs = [(5, "a"), (6, "A"), (6, "a"), (7, "x"), (None, "n"), (None, "N")]
    first = [sorted(map(repr, op.exact_dedup(rows(spark, some).repartition(parts), index, "1").collect())) for some, parts in ((pairs, 1), (pairs[::-1], 3))]
    assert first[0] == first[1] and index.table().count() == 3
    kept = [sorted(map(repr, op.drop_exact_copies(rows(spark, pairs), index, "1").select("doc_id").collect())) for _ in "ab"]
    assert kept[0] == kept[1] and len(kept[0]) == 2


def test_columns_with_any_name(spark):
    names = ["__row", "__digest", "__batch", "row", "digest", "batch", "doc", "best", "own", "keep_id"]
    frame = spark.createDataFrame([(1, "a", *names), (2, "A", *names)], "doc_id BIGINT, text STRING, " + ", ".join(f"`{n}` STRING" for n in names))
    out = op.drop_exact_copies(frame)
    assert out.columns == frame.columns and [tuple(r) for r in out.collect()] == [(2, "A", *names)]
    assert answers(op.exact_dedup(frame)) == [(1, 2, 2, False), (2, 2, 2, True)]


@pytest.mark.parametrize("pairs", [[], [(1, None)]])
def test_tiny(spark, pairs):
    assert op.exact_dedup(rows(spark, pairs)).count() == len(pairs)
    assert op.drop_exact_copies(rows(spark, pairs)).count() == len(pairs)


def test_no_python_and_index_not_shuffled(spark):
    index = op.DigestIndex.create(spark, buckets=3)
    batch = op.digested(rows(spark, [(1, "a")]), "0")
    index.add(batch)
    plan = op.verdicts(batch, index)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
