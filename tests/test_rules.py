"""Rules, cleaning and scalar functions on edge rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from purseflow.functions import scalar as fn
from purseflow.operators import rules

COLUMNS = "ordinal bigint, txn_id string, user_id string, merchant string, category string, " \
    "amount string, status string, wallet_type string, timestamp string, date string"


def row(ordinal, txn_id="TXN00000001", user_id="U0001", category="Food", amount="10.00",
        status="SUCCESS", timestamp="2023-01-05 10:00:00"):
    return (ordinal, txn_id, user_id, "Amazon", category, amount, status, "PayWallet", timestamp, "2023-01-05")


def table(spark, *rows_):
    return spark.createDataFrame(list(rows_), COLUMNS)


def test_a_thoroughly_bad_row_breaks_all_six_rules(spark):
    bad = table(spark, row(1, "BAD1", "XX", "Gambling", "-50", "DONE", "not-a-date"))
    assert rules.check(bad, rules.validator_rules()).first().errors == [
        "txn_id must match TXNxxxxxxxx",
        "user_id must match Uxxxx",
        "amount -50.0 outside [1.0, 1000000.0]",
        "unknown status: DONE",
        "unknown category: Gambling",
        "timestamp must be YYYY-MM-DD HH:MM:SS",
    ]


def test_nulls_break_every_rule(spark):
    empty = table(spark, (1, None, None, None, None, None, None, None, None, None))
    assert len(rules.check(empty, rules.constraint_rules()).first().errors) == 5
    assert rules.summary(empty, rules.validator_rules()).first().invalid == 1


def test_summary_of_no_rows(spark):
    got = rules.summary(table(spark, row(1)).where("false"), rules.validator_rules()).first()
    assert (got.total, got.valid, got.invalid, got.valid_pct) == (0, 0, 0, 0.0)


@pytest.mark.parametrize("amount, broken", [
    ("1", []), ("0.99", ["amount_range"]), ("1000000", []), ("1000000.01", ["amount_range"]),
    ("1e3", []), ("", ["amount_type"]), ("1.2.3", ["amount_type"]), ("12 ", []),
])
def test_amount_bounds(spark, amount, broken):
    one = table(spark, row(1, amount=amount))
    assert rules.check(one, rules.amount_rules(rules.MAX_AMOUNT)).first().errors == broken


def test_status_is_checked_before_tidying_in_the_batch_but_after_it_in_cleaning(spark):
    one = table(spark, row(1, status=" success "))
    assert rules.check(one, rules.process_rules()).first().errors == ["bad_status"]
    tidy = rules.tidy(one).first()
    assert (tidy.status, tidy.reasons) == ("SUCCESS", [])


def test_an_id_counts_as_seen_even_if_its_first_row_is_rejected(spark):
    got = rules.tidy(table(
        spark, row(1, amount=""), row(2), row(3), row(4, txn_id=" TXN00000009"), row(5, txn_id="TXN00000009 ")
    )).orderBy("ordinal").collect()
    assert [r.reasons for r in got] == [
        ["invalid amount"], ["duplicate txn_id"], ["duplicate txn_id"], [], ["duplicate txn_id"]
    ]


def test_reject_reasons_keep_rule_order(spark):
    got = rules.tidy(table(spark, row(1), row(2, category="Gambling", amount="0", status="done"))).where("ordinal = 2")
    assert got.first().reasons == [
        "duplicate txn_id", "non-positive amount", "unknown status 'DONE'", "unknown category 'Gambling'"
    ]


def test_split_is_complementary(spark):
    rows_ = table(spark, row(1), row(2, status="x"), row(3, amount="0"))
    valid, invalid = rules.split(rows_, rules.constraint_rules())
    assert [r.ordinal for r in valid.collect()] == [1]
    assert sorted((r.ordinal, tuple(r.errors)) for r in invalid.collect()) == [
        (2, ("bad_status",)), (3, ("amount_range",))
    ]


def test_gate(spark):
    good = [row(i, f"TXN{i:08d}") for i in range(9)]
    rules.require_quality(table(spark, *good, row(10, amount="0")))
    with pytest.raises(ValueError, match="only 80.0%"):
        rules.require_quality(table(spark, *good[:8], row(10, amount="0"), row(11, "X1")))


@pytest.mark.parametrize("raw, value, valid", [
    ("1299.5", "1299.50", True), ("Rs. 1,299.50", "0.00", False), ("INR 1,299.50", "1299.50", True),
    (".", "0.00", False), ("", "0.00", False), ("-50", "50.00", True), ("1.2.3", "0.00", False), ("abc", "0.00", False),
])
def test_parse_amount(spark, raw, value, valid):
    got = spark.createDataFrame([(raw,)], "a string").select(fn.parse_amount(F.col("a")).alias("p")).first().p
    assert (got.value, got.currency, got.valid) == (Decimal(value), "INR", valid)


@pytest.mark.parametrize("text, want", [
    ("  PhonePe Payment!  ", "phonepe_payment"), ("a !", "a_"), ("Über  Café\tNo. 5", "über_café_no_5"),
    ("!!", ""), ("x y", "x_y"),
])
def test_slug(spark, text, want):
    assert spark.createDataFrame([(text,)], "s string").select(fn.slug(F.col("s"))).first()[0] == want


def test_log_line(spark):
    lines = [("[2023-01-02 03:00:00] TXN00000007 PROCESSED amount=700 status=SUCCESS",), ("noise",)]
    got = spark.createDataFrame(lines, "l string").select(fn.parse_log_line(F.col("l")).alias("p")).collect()
    assert (str(got[0].p.ts), got[0].p.txn_id, got[0].p.amount, got[0].p.status) == (
        "2023-01-02 03:00:00", "TXN00000007", Decimal("700.00"), "SUCCESS")
    assert got[1].p.ts is None and got[1].p.amount is None


def test_codes_keep_long_numbers(spark):
    got = spark.range(1).select(fn.txn_code(F.lit(7)), fn.txn_code(F.lit(1234567890)), fn.user_code(F.lit(12345))).first()
    assert tuple(got) == ("TXN00000007", "TXN1234567890", "U12345")


def test_ratio_rounds_half_up_exactly(spark):
    got = spark.range(1).select(
        fn.ratio(F.lit(Decimal("10.01")), F.lit(2)),
        fn.ratio(F.lit(Decimal("1.00")), F.lit(0)),
        fn.percent(F.lit(1), F.lit(3)),
    ).first()
    assert tuple(got) == (5.01, None, 33.33)


def test_constant_column_scales_to_zero(spark):
    import purseflow.plans.relations as relations
    from purseflow.sources import tables

    same = spark.createDataFrame([(1, 5.0), (2, 5.0)], "event_id bigint, amount double")
    original, tables.ev = tables.ev, lambda *_: same
    try:
        assert {r.scaled for r in relations.norm_minmax(spark, "").collect()} == {0.0}
        assert {r.z for r in relations.norm_zscore(spark, "").collect()} == {0.0}
    finally:
        tables.ev = original


def test_missing_labels_are_rejected_with_their_message(spark):
    one = table(spark, row(1, category=None, status=None))
    assert rules.check(one, rules.validator_rules()).first().errors == ["unknown status: ", "unknown category: "]
    assert rules.tidy(one).first().reasons == ["unknown status ''", "unknown category ''"]
    assert rules.check(one, rules.process_rules()).first().errors == ["bad_status", "bad_category"]


def test_all_six_messages_of_an_empty_row(spark):
    empty = table(spark, (1, None, None, None, None, None, None, None, None, None))
    assert len(rules.check(empty, rules.validator_rules()).first().errors) == 6


def test_ids_that_outgrow_their_width_are_well_formed(spark):
    wide = table(spark, row(1, txn_id="TXN123456789", user_id="U12345"))
    assert rules.check(wide, rules.constraint_rules()).first().errors == []
