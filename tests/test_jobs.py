from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import kindred as kd
from reference_scores import SCORERS

CFG = kd.MatchConfig(
    left_id_col="id", right_id_col="id", left_extra_cols=("id",), right_extra_cols=("id",), score_threshold=60.0, top_n=2
)


@pytest.fixture(scope="module")
def data(spark):
    left = spark.createDataFrame(
        [
            (1, "Crédit Agricole", "France", "L1 | L2"),
            (2, 'Banque "Nord", Réunion', "Réunion", "L3"),
            (3, "Credit Agricole", "France", "L9"),
            (4, "LCL", "France", "L4"),
            (5, "Zenith", "Viet Nam", None),
            (6, "Crédit Agricole", "France", "L1 | L2"),
        ],
        "id bigint, institution_name string, country_name string, lei string",
    )
    right = spark.createDataFrame(
        [
            (1, "Credit Agricole SA", "France", "L1|L2"),
            (2, "Banque Nord", "France", "L3"),
            (3, "Credit Lyonnais", "France", "L4"),
            (4, "Agricole", "France", None),
            (5, "Zenith Bank", "Vietnam", "L7"),
        ],
        "id bigint, SP_ENTITY_NAME string, SP_COUNTRY_NAME string, SP_LEI string",
    )
    return left, right


def test_validation_summary(spark, data):
    result = kd.match(*data, CFG)
    rows = {r.lei_match: r for r in kd.validate_lei_scores(result).collect()}
    assert rows[True].n == 2 and rows[True].min_score == rows[True].max_score
    assert kd.validate_lei_scores(result.limit(0)).count() == 0
    plain = spark.range(3)
    assert kd.validate_lei_scores(plain) is plain


def test_truth_counts_agree_with_lists(data):
    pairs = kd.truth_pairs(*data, CFG)
    assert sorted((r.left_id, r.right_id) for r in pairs.collect()) == [(1, 1), (2, 2), (4, 3), (6, 1)]
    groups = kd.truth_groups(*data, CFG)
    assert groups.agg(F.sum("n_pairs")).first()[0] == 4
    misses = kd.truth_misses(*data, CFG).collect()
    assert {(r.left_id, r.right_id): r.miss_reason for r in misses} == {
        (2, 2): "country_mismatch", (4, 3): "low_fuzzy_score",
    }
    counts = {r.miss_reason: r.n for r in kd.miss_reasons(*data, CFG).collect()}
    assert counts == {"country_mismatch": 1, "low_fuzzy_score": 1}
    relaxed = replace(CFG, relax_country=True)
    assert {r.miss_reason: r.n for r in kd.miss_reasons(*data, relaxed).collect()} == {"low_fuzzy_score": 1}
    with pytest.raises(ValueError):
        kd.truth_pairs(*data, replace(CFG, left_id_col=None))


def test_compare_scorers(data):
    pairs = [(r.left_key, r.right_key) for r in kd.truth_pairs(*data, CFG).collect()]
    got = {r.scorer: r for r in kd.compare_scorers(kd.truth_groups(*data, CFG), 80.0).collect()}
    for scorer in kd.SCORERS:
        scores = [SCORERS[scorer](*p) for p in pairs]
        assert got[scorer].n_pairs == len(pairs)
        assert got[scorer].n_at_cut == sum(s >= 80 for s in scores)
        assert got[scorer].mean_score == pytest.approx(sum(scores) / len(scores), abs=0.006)


def test_summaries(data):
    relaxed = replace(CFG, relax_country=True)
    result = kd.match(*data, relaxed)
    row = kd.run_summary(result, relaxed).first()
    assert row.n_pairs == row.n_strict + row.n_relaxed == result.count()
    assert row.n_left_entities == result.select("left_institution_name", "left_country_name").distinct().count()
    assert tuple(kd.input_summary(*data, CFG).first()) == (6, 5, 2)
    counts = {r.country_key: r.n_pairs for r in kd.candidate_counts(*data, CFG).collect()}
    assert counts == {"france": 16, "vietnam": 1}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_job(spark, data, tmp_path, fmt):
    left, right = data
    kd.write_table(left, str(tmp_path / "left.csv"), "csv")
    assert kd.write_table(right, str(tmp_path / "right"), "parquet") == 5
    again = kd.read_table(spark, str(tmp_path / "left.csv"))
    assert dict(again.dtypes)["id"] == "string"
    assert sorted(r.institution_name for r in again.collect()) == sorted(r.institution_name for r in left.collect())
    report = kd.run_job(
        spark, str(tmp_path / "left.csv"), str(tmp_path / "right"), CFG, str(tmp_path / "deep" / "out"), fmt,
        validate_lei=True,
    )
    want = kd.match(left, right, CFG)
    assert report.rows == want.count() == report.summary.first().n_pairs
    assert report.validation.count() == 2
    assert report.preview.columns == [
        "left_institution_name", "left_country_name", "left_lei", "right_SP_ENTITY_NAME", "right_SP_LEI",
        "fuzzy_score", "lei_match", "match_rank",
    ]
    stored = kd.read_table(spark, str(tmp_path / "deep" / "out"), fmt)
    assert stored.columns == want.columns and stored.count() == report.rows


def test_formats_are_checked(spark, data, tmp_path):
    for call in (
        lambda: kd.write_table(data[0], str(tmp_path / "x"), "excel"),
        lambda: kd.read_table(spark, str(tmp_path / "x"), "json"),
        lambda: kd.run_job(spark, "a", "b", CFG, str(tmp_path / "x"), "excel"),
    ):
        with pytest.raises(ValueError, match="unknown format"):
            call()


def test_schema_and_positions(spark, data, tmp_path):
    listed = kd.schema_of(data[0]).collect()
    assert [tuple(r) for r in listed] == [
        ("id", "bigint"), ("institution_name", "string"), ("country_name", "string"), ("lei", "string"),
    ]
    path = str(tmp_path / "ordered")
    data[1].coalesce(1).orderBy("id").write.parquet(path)
    read = kd.read_table(spark, path, position=True)
    assert [r.id for r in read.orderBy("row_position").collect()] == [1, 2, 3, 4, 5]
    cfg = replace(CFG, right_id_col="row_position")
    assert kd.match(data[0], read, cfg).count() == kd.match(*data, CFG).count()


def test_job_breaks_ties_by_file_order(spark, tmp_path):
    """Rows that tie keep the order of the file, not of their content."""
    left = spark.createDataFrame([("Alpha Bank", "France", None)], "institution_name string, country_name string, lei string")
    names = [f"Alpha Bank {c}" for c in "zyxwvuts"]
    right = spark.createDataFrame([(n, "France", None) for n in names], "SP_ENTITY_NAME string, SP_COUNTRY_NAME string, SP_LEI string")
    left.write.parquet(str(tmp_path / "l"))
    right.coalesce(1).write.parquet(str(tmp_path / "r"))
    cfg = kd.MatchConfig(top_n=3, scorer="token_set_ratio")
    report = kd.run_job(spark, str(tmp_path / "l"), str(tmp_path / "r"), cfg, str(tmp_path / "out"))
    assert report.rows == 3
    got = kd.read_table(spark, str(tmp_path / "out")).orderBy("match_rank").collect()
    assert [r.right_SP_ENTITY_NAME for r in got] == names[:3]
    kd.run_job(spark, str(tmp_path / "l"), str(tmp_path / "r"), cfg, str(tmp_path / "o2"), right_filter="SP_ENTITY_NAME > 'Alpha Bank w'")
    got = kd.read_table(spark, str(tmp_path / "o2")).orderBy("match_rank").collect()
    assert [r.right_SP_ENTITY_NAME for r in got] == names[:3]


def test_csv_is_split(spark, tmp_path):
    spark.range(200_000).selectExpr("id", "repeat('x', 20) as name").coalesce(1).write.option("header", True).csv(str(tmp_path / "big"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        assert kd.read_table(spark, str(tmp_path / "big"), "csv").rdd.getNumPartitions() > 3
        assert kd.read_table(spark, str(tmp_path / "big"), "csv", multi_line=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
