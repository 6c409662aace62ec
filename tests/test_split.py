from pyspark.sql import functions as F

from spanlake.operators.split import (
    clean_periods,
    reject_reason_counts,
    rejected_periods,
    valid_periods,
)

ROWS = [
    (1, "202001", "202003"),
    (2, None, "202003"),
    (3, None, "bad"),
    (4, "bad", None),
    (5, None, None),
    (6, "202005", "202001"),
    (7, "202001\n", "202003"),
    (8, "    ", "202003"),
    (9, "\t202001", "202003"),
    (10, "000001", "000002"),
    (11, "202013", "202103"),
    (12, "202001", None),
    (13, "  202001 ", "202001"),
]

FROM_FORMAT = "TU_THANG sai format YYYYMM"
TO_FORMAT = "DEN_THANG sai format YYYYMM"


def _clean(spark):
    df = spark.createDataFrame(ROWS, "id int, TU_THANG string, DEN_THANG string")
    return clean_periods(df, salary=None)


def _reasons(df):
    return {r["id"]: r["REJECT_REASON"] for r in df.collect()}


def test_every_row_is_valid_or_rejected_with_a_reason(spark):
    clean = _clean(spark)
    valid = {r["id"] for r in valid_periods(clean).collect()}
    assert valid == {1, 10, 13}
    assert _reasons(rejected_periods(clean)) == {
        2: "TU_THANG NULL",
        3: "TU_THANG NULL",
        4: FROM_FORMAT,
        5: "TU_THANG NULL",
        6: "TU_THANG > DEN_THANG",
        7: FROM_FORMAT,
        8: FROM_FORMAT,
        9: FROM_FORMAT,
        11: FROM_FORMAT,
        12: "DEN_THANG NULL",
    }


def test_without_unknown_only_refuted_rows_are_rejected(spark):
    assert _reasons(rejected_periods(_clean(spark), unknown=False)) == {
        3: TO_FORMAT,
        4: FROM_FORMAT,
        6: "TU_THANG > DEN_THANG",
        7: FROM_FORMAT,
        8: FROM_FORMAT,
        9: FROM_FORMAT,
        11: FROM_FORMAT,
    }


def test_reason_counts(spark):
    counts = {r[0]: r[1] for r in reject_reason_counts(rejected_periods(_clean(spark))).collect()}
    assert sum(counts.values()) == len(ROWS) - 3
    assert counts[FROM_FORMAT] == 5


def test_salary_text_becomes_double_or_null(spark):
    df = spark.createDataFrame(
        [("202001", "202001", "1.5"), ("202001", "202001", "oops"), ("202001", "202001", None)],
        "TU_THANG string, DEN_THANG string, MUC_LUONG string",
    )
    assert [r["MUC_LUONG"] for r in clean_periods(df).collect()] == [1.5, None, None]


def test_input_order_is_irrelevant(spark):
    clean = _clean(spark)
    shuffled = clean.repartition(5, "id").orderBy(F.col("id").desc())
    assert _reasons(rejected_periods(shuffled)) == _reasons(rejected_periods(clean))
