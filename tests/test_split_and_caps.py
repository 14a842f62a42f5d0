"""O1, O2, A1, L1-L3: exact split and caps."""

import pytest
from pyspark.sql import functions as F

from chatmill.operators.ordinal import head_cap, mix_caps, prefix_cap, scan_with_position, with_ordinal
from chatmill.operators.split import exact_split, label_split, seeded_shuffle, split_counts, val_count
from chatmill.session import scratch_path


def test_val_count_python_doubles():
    assert val_count(100, 0.29) == 28
    assert val_count(38244, 0.02) == 764
    assert val_count(38244, 0.0) == 0
    assert val_count(0, 0.5) == 0
    with pytest.raises(ValueError):
        val_count(10, 1.0)


def _keys(spark, n, parts):
    return spark.range(n).repartition(parts).select(F.format_string("k%06d", "id").alias("rec_key"))


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_exact_split_is_exact_and_partition_independent(spark, parts):
    df = exact_split(_keys(spark, 5000, parts), 0.02, 42)
    val = sorted(r.rec_key for r in df.where("split = 'val'").collect())
    assert len(val) == 100
    assert df.count() == 5000
    # equal to a full sort by (shuffle key, rec_key)
    full = [r.rec_key for r in seeded_shuffle(_keys(spark, 5000, 1), 42).orderBy("shuffle_key", "rec_key").limit(100).collect()]
    assert val == sorted(full)


def test_split_zero_and_empty(spark):
    assert exact_split(_keys(spark, 50, 2), 0.0).where("split = 'val'").count() == 0
    empty = exact_split(_keys(spark, 0, 1), 0.3)
    assert empty.count() == 0
    c = split_counts(exact_split(_keys(spark, 100, 4), 0.29)).first()
    assert (c.num_total, c.num_train, c.num_val) == (100, 72, 28)


def test_deep_refinement_matches_sort(spark, monkeypatch):
    import chatmill.operators.split as S
    monkeypatch.setattr(S, "_EXACT_LIMIT", 3)       # force several histogram levels
    df = S.exact_split(_keys(spark, 3000, 5), 0.1, 7)
    val = sorted(r.rec_key for r in df.where("split = 'val'").collect())
    full = sorted(r.rec_key for r in seeded_shuffle(_keys(spark, 3000, 1), 7).orderBy("shuffle_key", "rec_key").limit(300).collect())
    assert val == full


def _multi_file(spark, sizes):
    path = scratch_path(spark, "ordinal")
    start = 0
    for i, n in enumerate(sizes):
        spark.range(start, start + n).coalesce(1).write.mode("append").parquet(path)
        start += n
    return path


def test_ordinal_follows_file_order(spark):
    path = _multi_file(spark, [5, 300, 17, 1000])
    df = with_ordinal(scan_with_position(spark, path))
    rows = df.select("id", "ordinal").collect()
    # files are named in write order, so ids were written in ordinal order per file name
    files = sorted({r for r in scan_with_position(spark, path).select("_src_file").distinct().toPandas()["_src_file"]})
    assert sorted(r.ordinal for r in rows) == list(range(len(rows)))
    by_file = scan_with_position(spark, path).toPandas()
    expected = []
    for f in files:
        expected += by_file[by_file["_src_file"] == f]["id"].tolist()
    got = [r.id for r in sorted(rows, key=lambda r: r.ordinal)]
    assert got == expected


def test_prefix_cap_counts_after_selection(spark):
    path = _multi_file(spark, [40, 60])
    df = scan_with_position(spark, path).where(F.col("id") % 2 == 0)
    capped = prefix_cap(df, 7).collect()
    assert len(capped) == 7
    assert prefix_cap(df, 10_000).count() == 50
    with pytest.raises(ValueError):
        prefix_cap(df, 0)


def test_head_cap_falsy_means_none(spark):
    path = _multi_file(spark, [30])
    df = with_ordinal(scan_with_position(spark, path))
    assert head_cap(df, None).count() == 30
    assert head_cap(df, 0).count() == 30
    assert head_cap(df, 500).count() == 30
    assert head_cap(df, 4).count() == 4


def test_mix_caps():
    assert mix_caps(20000) == {"squad": 20000, "squad_v2": 10000, "trivia_qa": 10000}
    assert mix_caps(1) == {"squad": 1, "squad_v2": 1, "trivia_qa": 1}
    with pytest.raises(ValueError):
        mix_caps(0)


def test_cap_counts_raw_rows_before_filters(spark):
    """Trap 3: the cap takes the first N raw rows, then filters drop some."""
    from chatmill.operators import records as R
    from chatmill.sources import tables
    from conftest import SF_SMALL
    n = 12
    raw = tables.span_qa(spark, SF_SMALL).orderBy(F.split("rec_key", ":")[1].cast("long"),
                                                   F.split("rec_key", ":")[2].cast("long")).limit(n)
    expected = R.filter_span_qa(raw).count()
    got = R.span_qa_records(tables.span_qa(spark, SF_SMALL, cap=n)).count()
    assert got == expected < n


def _ordered_split(df, n_val):
    """The rows that a sort by key takes, as (key, how many)."""
    from collections import Counter
    rows = seeded_shuffle(df, 42).orderBy(F.col("shuffle_key").asc_nulls_first(), F.col("rec_key").asc_nulls_first()).select("rec_key").limit(n_val).collect()
    return Counter(r.rec_key for r in rows)


def test_one_key_over_a_million_distinct_rows(spark, monkeypatch):
    """Selection goes on through the bits of the rows' hashes; no pass brings more than 4,096 counts to the driver."""
    import chatmill.operators.split as S
    passes, histogram, walk = [], S._histogram, S._walk

    def counted(rows, digit):
        out = histogram(rows, digit)
        passes.append(len(out))
        return out
    monkeypatch.setattr(S, "_histogram", counted)
    df = spark.range(1_000_000).select(F.lit("one").alias("rec_key"), "id")
    out = exact_split(df, 0.3).groupBy("split").agg(F.count("*").alias("n"), F.countDistinct("id").alias("d")).collect()
    assert {r.split: (r.n, r.d) for r in out} == {"val": (300_000, 300_000), "train": (700_000, 700_000)}
    assert len(passes) >= 6 and max(passes) <= 4_096 and walk is S._walk


def test_null_keys_are_the_first_bucket(spark):
    rows = [(None, i % 7) for i in range(50)] + [(f"k{i}", i) for i in range(150)]
    df = spark.createDataFrame(rows, "rec_key string, v int").repartition(3)
    for fraction in (0.0, 0.1, 0.25, 0.4, 0.995):
        out = exact_split(df, fraction)
        n_val = val_count(200, fraction)
        from collections import Counter
        assert Counter(r.rec_key for r in out.where("split = 'val'").collect()) == _ordered_split(df, n_val)
        assert out.count() == 200 and set(out.columns) == {"rec_key", "v", "shuffle_key", "split"}


def test_equal_rows_are_counted(spark):
    df = spark.range(900).repartition(5).select(F.when(F.col("id") < 600, "same").otherwise(F.concat(F.lit("k"), "id")).alias("rec_key"),
                                                F.when(F.col("id") < 600, F.lit(0)).otherwise(F.col("id")).alias("v"))
    for fraction in (0.2, 0.5, 0.7, 0.9):
        assert exact_split(df, fraction).where("split = 'val'").count() == val_count(900, fraction)
    nulls = spark.range(40).select(F.lit(None).cast("string").alias("rec_key"), F.lit(1).alias("v"))
    assert exact_split(nulls, 0.25).where("split = 'val'").count() == 10


def test_keys_page_by_page(spark, monkeypatch):
    import chatmill.operators.split as S
    monkeypatch.setattr(S, "_EXACT_LIMIT", 4)
    rows = [(0, None)] + [(0, f"k{i:02d}") for i in range(30) for _ in range(1 + i % 2)]
    df = spark.createDataFrame(rows, "shuffle_key long, rec_key string")
    for n in (1, 2, 5, 17, 40):
        h, k, size, at = S._walk(df, ["shuffle_key", "rec_key"], n)
        ordered = sorted((r[1] for r in rows), key=lambda x: (x is not None, x or ""))
        assert (h, k) == (0, ordered[n - 1]) and size == ordered.count(k) and at == n - ordered.index(k)
