from datetime import date

from tests.conftest import by_key

from acctrisk.operators import quality

ACCOUNTS = "account_id long, account_name string, arr long, contract_end_date date, plan_tier string"
END = date(2026, 5, 1)
TODAY = date(2026, 4, 10)


def warnings(report):
    row = report.first()
    assert row.is_valid and row.errors == []
    return " | ".join(row.warnings)


def test_duplicates_keep_the_first_row(frame):
    df = frame(ACCOUNTS + ", ingest_order long", (1001, "B", 2, END, "Growth", 2),
               (1001, "A", 1, END, "Growth", 1), (1002, "C", 3, END, "Growth", 3))
    clean, report = quality.validate_accounts(df, TODAY)
    assert {k: r.account_name for k, r in by_key(clean).items()} == {1001: "A", 1002: "C"}
    assert "Duplicate account IDs found: 1" in warnings(report)
    assert (report.first().rows_before, report.first().rows_after) == (3, 2)
    assert by_key(quality.duplicate_ids(df))[1001].surplus_rows == 1


def test_negative_arr_becomes_zero(frame):
    clean, report = quality.validate_accounts(
        frame(ACCOUNTS, (1, None, -5000, date(2024, 1, 1), "Gold")), TODAY)
    assert clean.first().arr == 0
    text = warnings(report)
    assert "1 accounts have negative ARR" in text and "1 accounts have zero ARR" in text
    assert "missing account_name" in text and "stale data" in text
    assert "Unknown plan tiers" in text


def test_clean_accounts_have_no_warnings(frame):
    _, report = quality.validate_accounts(frame(ACCOUNTS, (1, "A", 5, END, "Scale")), TODAY)
    assert warnings(report) == ""


def test_missing_columns_are_errors(frame):
    df = frame("account_id long", (1,))
    same, report = quality.validate_accounts(df, TODAY)
    row = report.first()
    assert same is df and not row.is_valid
    assert "Missing required column: plan_tier" in row.errors and len(row.errors) == 4
    for check in (quality.validate_usage, quality.validate_tickets, quality.validate_nps):
        assert not check(df)[1].first().is_valid


def test_nps_is_clamped_without_comment_column(frame):
    clean, report = quality.validate_nps(frame("account_id long, score long", (1, 15), (2, -3)))
    assert {k: r.score for k, r in by_key(clean).items()} == {1: 10, 2: 0}
    assert warnings(report) == "2 NPS scores outside 0-10 range. Clamping."


def test_nps_duplicates_and_empty_comments_are_counted_and_kept(frame):
    df = frame("account_id long, score long, verbatim_comment string",
               (1, 5, ""), (1, 6, "x"), (2, 7, ""))
    clean, report = quality.validate_nps(df)
    assert clean.count() == 3
    assert warnings(report).startswith("1 duplicate NPS responses")
    assert "2 NPS responses have no comment" in warnings(report)


def test_usage_checks(frame):
    df = frame("account_id long, month string, api_calls long, active_users long, "
               "sdk_version string", (1, "2025-01", -100, 5, "v4.1.0"),
               (1, "2025-02", 20_000_000, 5, None), (1, "2025-02", 1, 5, "beta"))
    clean, report = quality.validate_usage(df)
    assert sorted(r.api_calls for r in clean.collect()) == [0, 1, 20_000_000]
    text = warnings(report)
    for part in ("1 rows have negative api_calls", "1 rows have api_calls > 10M",
                 "2 rows have invalid SDK", "1 accounts have < 3 months"):
        assert part in text


def test_ticket_checks(frame):
    df = frame("account_id long, priority string, status string, resolution_time_hours double",
               (1, "P5", "Open", -1.0), (2, None, "Resolved", 721.0), (3, "P1", "Closed", None))
    text = warnings(quality.validate_tickets(df)[1])
    for part in ("Unknown priority values: 2", "Unknown status values: 1",
                 "1 tickets have negative resolution", "1 tickets have resolution > 30 days"):
        assert part in text
    accounts = frame(ACCOUNTS, (1, "A", 1, END, None))
    found = quality.unknown_values(accounts, df).collect()
    assert {(r.field, r.value) for r in found} == {
        ("plan_tier", None), ("priority", "P5"), ("priority", None), ("status", "Resolved")}


def test_orphans(frame):
    accounts = frame("account_id long", (1,), (2,))
    facts = frame("account_id long", *[(i,) for i in [1, 9, 9, None, 8, 7, None, 6, 5, 4]])
    row = quality.orphan_report({"usage": facts}, accounts).first()
    assert (row.n_orphans, row.smallest_ids) == (6, "4, 5, 6, 7, 8")
    assert quality.cross_reference_report({"nps": accounts}, accounts).count() == 0


def test_validate_all(frame):
    accounts = frame(ACCOUNTS, (1, "A", 1, END, "Scale"))
    usage = frame("account_id long, month string, api_calls long, active_users long, "
                  "sdk_version string", (2, "1", 1, 1, "v4.1.0"))
    tickets = frame("account_id long, priority string, status string", (1, "P1", "Open"))
    nps = frame("account_id long, score long", (1, 5))
    data, report = quality.validate_all(accounts, usage, tickets, nps, TODAY)
    assert set(data) == {"accounts", "usage", "tickets", "nps"}
    assert {r.source for r in report.collect()} == {
        "accounts.csv", "usage_metrics.csv", "support_tickets.csv", "nps_responses.csv",
        "usage (cross-ref)"}


def test_orphans_of_several_sources_in_one_pass(frame):
    accounts = frame("account_id long", *[(i,) for i in range(100)])
    many = frame("account_id long", *[(i % 3000,) for i in range(6000)], (None,))
    none = frame("account_id long", (1,), (2,), (None,))
    few = frame("account_id long", (500,), (-3,), (500,))
    rows = {r.source: (r.n_orphans, r.smallest_ids) for r in quality.orphan_report(
        {"many": many, "none": none, "few": few}, accounts).collect()}
    assert rows == {"many": (2900, "100, 101, 102, 103, 104"), "none": (0, ""),
                    "few": (2, "-3, 500")}


def test_the_report_reads_each_fact_source_once(spark, frame, tmp_path):
    """One scan per fact source, orphans included."""
    tables = {
        "usage": frame("account_id long, month string, api_calls long, active_users long, "
                       "sdk_version string",
                       *[(i % 9, f"2025-0{m}", 5 - m, 1, "v4.1.0") for i in range(9) for m in (1, 2)],
                       (None, "2025-01", 1, -1, "x")),
        "tickets": frame("account_id long, priority string, status string",
                         *[(i % 7, "P1", "Odd") for i in range(20)]),
        "nps": frame("account_id long, score long, verbatim_comment string",
                     (1, 20, ""), (1, 3, "x"), (77, 5, "y"), (None, 5, "z"))}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    accounts = frame(ACCOUNTS, *[(i, f"A{i}", 5, END, "Scale") for i in range(5)])
    _, report = quality.validate_all(accounts, as_of=TODAY, **tables)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == len(tables)
    rows = {r.source: r for r in report.collect()}
    assert rows["usage (cross-ref)"].warnings == [
        "4 account IDs in usage not found in accounts.csv: [5, 6, 7, 8]..."]
    assert rows["tickets (cross-ref)"].warnings == [
        "2 account IDs in tickets not found in accounts.csv: [5, 6]..."]
    assert rows["nps (cross-ref)"].warnings == [
        "1 account IDs in nps not found in accounts.csv: [77]..."]
    nps = [r for s, r in rows.items() if "nps" in s and "cross" not in s][0]
    assert nps.rows_before == 4 and len(nps.warnings) == 3
    # the same as the checks of each source by itself
    for check, name in ((quality.validate_usage, "usage"), (quality.validate_tickets, "tickets"),
                        (quality.validate_nps, "nps")):
        alone = check(tables[name])[1].first()
        assert rows[alone.source] == alone


def test_sources_without_a_column_are_still_held_against_the_accounts(frame):
    accounts = frame(ACCOUNTS, (1, "A", 5, END, "Scale"))
    _, report = quality.validate_usage(frame("account_id long", (1,), (8,)), accounts)
    rows = {r.source: r for r in report.collect()}
    assert rows["usage (cross-ref)"].warnings[0].startswith("1 account IDs in usage")
    assert len(rows) == 2 and not rows["usage_metrics.csv"].is_valid
    _, report = quality.validate_nps(frame("score long", (1,)), accounts)
    assert [r.is_valid for r in report.collect()] == [False]
