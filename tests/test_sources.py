import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tests.conftest import by_key

from acctrisk.functions.lineage import materialise, shared_folder
from acctrisk.operators import annotate, notes, quality, scoring
from acctrisk.plans import pipeline
from acctrisk.sources import exports, files


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "accounts.csv").write_text(
        "account_id,account_name,arr,contract_end_date,plan_tier,industry,csm_name,region\n"
        '1001,"Acme, Inc",21000,2026-05-25,Starter,Media,Ann,NA\n'
        "1002,Other,5000,2026-06-01 00:00:00,Scale,Retail,Bob,EU\n"
        "1001,Again,1,2026-05-25,Starter,Media,Ann,NA\n")
    usage = ["account_id,month,api_calls,content_entries_created,active_users,"
             "workflows_triggered,sdk_version"]
    usage += [f"1001,2026-0{m},{100 - 20 * m},10,3,4,v3.2.0" for m in (1, 2, 3)]
    (tmp_path / "usage_metrics.csv").write_text("\n".join(usage) + "\n")
    (tmp_path / "support_tickets.csv").write_text(
        "ticket_id,account_id,created_date,priority,status,resolution_time_hours\n"
        "T1,1001,2026-04-01,P1,Open,\nT2,1001,2026-01-01,P3,Closed,12.5\n"
        "T3,1002,2026-01-01,P3,Closed,soon\n")
    (tmp_path / "nps_responses.csv").write_text(
        'account_id,score,verbatim_comment\n1001,3,"Slow, and ""buggy""\nin two lines"\n1002,9,\n')
    (tmp_path / "csm_notes.txt").write_text(
        "=== CSM notes\n\n---\n4/5 acct 1002 - x\n---\n04/03 Other\n---\n")
    (tmp_path / "changelog.md").write_text("### v4.3.0 — May 1, 2026\n- ⚠️ v1 is deprecated\n")
    return str(tmp_path)


def test_load_all(spark, folder):
    data = files.load_all(spark, folder)
    accounts = data.accounts.collect()
    assert accounts[0].account_name == "Acme, Inc"
    assert accounts[1].contract_end_date == date(2026, 6, 1)
    assert [r.resolution_time_hours for r in data.tickets.collect()] == [None, 12.5, None]
    assert [r.verbatim_comment for r in data.nps.collect()] == [
        'Slow, and "buggy"\nin two lines', ""]
    found = data.notes.orderBy("note_idx").collect()  # rows have no order of their own
    assert [(r.note_idx, r.account_id, r.account_name) for r in found] == [
        (1, 1002, ""), (2, None, "Other")]
    assert data.changelog.first().category == "deprecation"


def test_bad_and_missing_ids_stop_the_read(spark, tmp_path):
    for value in ("abc", ""):
        path = tmp_path / f"nps{value}.csv"
        path.write_text(f"account_id,score,verbatim_comment\n{value},5,x\n")
        with pytest.raises(Exception):
            files.load_nps_responses(spark, str(path)).collect()


def test_file_order_decides_the_first_of_duplicates(spark, folder):
    accounts = files.load_accounts(spark, f"{folder}/accounts.csv", ordered=True)
    clean, _ = quality.validate_accounts(accounts, date(2026, 4, 10))
    assert by_key(clean)[1001].account_name == "Acme, Inc"


def test_pipeline_end_to_end(spark, folder, tmp_path):
    data = files.load_all(spark, folder, ordered=True)
    result = pipeline.run(data, str(tmp_path / "out"))
    risk = by_key(result.risk)
    assert set(risk) == {1001, 1002}
    assert risk[1001].sdk_version == "v3.2.0" and risk[1001].nps_risk_score == 0.899
    assert risk[1002].engagement_risk_score == 0.3  # no usage
    assert "Duplicate account IDs" in str(result.report.collect())
    out = Path(tmp_path / "out")
    csv = "".join(p.read_text() for p in sorted((out / "risk_scored_accounts").glob("*.csv")))
    assert csv.startswith("account_id,account_name,arr,plan_tier") and '"Acme, Inc"' in csv
    detail = spark.read.options(header=True, multiLine=True, escape='"').csv(
        str(out / "detailed_signals"))
    assert "risk_explanation" not in detail.columns and detail.count() == 2
    briefings = [json.loads(line) for p in (out / "account_briefings").glob("*.json")
                 for line in p.read_text().splitlines()]
    assert {b["account_id"] for b in briefings} == {1001, 1002}
    assert {"risk_tier", "risk_score", "arr", "explanation"} <= set(briefings[0])
    report = json.loads("".join(p.read_text() for p in (out / "insights").glob("*.txt")))
    assert report["summary"]["total_accounts_analyzed"] == 2


def test_fused_scoring_equals_stand_alone_operators(spark, folder):
    from acctrisk.operators import signals
    data = files.load_all(spark, folder)
    accounts = quality.validate_accounts(data.accounts, date(2026, 4, 10))[0]
    fused = pipeline.score_dataset(pipeline.Dataset(accounts, data.usage, data.tickets, data.nps))
    plain = scoring.composite_risk(
        accounts, signals.usage_signals(data.usage), signals.ticket_signals(data.tickets),
        signals.nps_signals(data.nps), None, signals.sdk_risk(data.usage),
        signals.engagement_signals(data.usage, accounts))
    assert sorted(map(str, fused.select(sorted(plain.columns)).collect())) == sorted(
        map(str, plain.select(sorted(plain.columns)).collect()))


def test_files_with_other_headers_stop_the_read(spark, tmp_path):
    folder = tmp_path / "nps"
    folder.mkdir()
    (folder / "a.csv").write_text("account_id,score,verbatim_comment\n1,9,good\n")
    (folder / "b.csv").write_text("account_id,score,verbatim_comment\n2,3,bad\n")
    assert files.load_nps_responses(spark, str(folder)).count() == 2
    (folder / "c.csv").write_text("score,account_id,verbatim_comment\n3,500,bad\n")
    with pytest.raises(Exception, match="CSV header"):
        files.load_nps_responses(spark, str(folder)).collect()


def test_note_files_of_any_line_end_keep_their_notes_apart(spark, frame, tmp_path):
    """Two files number their notes alike; external findings meet the note of their own file."""
    folder = tmp_path / "notes"
    folder.mkdir()
    for name, end in (("a.txt", "\r\n"), ("b.txt", "\n"), ("c.txt", "\r")):
        blocks = [f"{name} first", "-" * 40, f"{name} second", "line two", "-" * 40, f"{name} third"]
        (folder / name).write_bytes(end.join(blocks).encode())
    notes = files.load_notes(spark, str(folder))
    rows = {(r.file.rsplit("/", 1)[1], r.note_idx): r.raw_text for r in notes.collect()}
    assert rows == {(f, i + 1): f"{f} {t}" for f in ("a.txt", "b.txt", "c.txt")
                    for i, t in enumerate(("first", "second\nline two", "third"))}
    external = notes.select(
        "file", "note_idx", F.lit(7).cast("long").alias("account_id"),
        F.concat("raw_text", F.lit("!")).alias("account_name"),
        F.lit("").alias("date_str"), F.lit("").alias("csm_name"))
    found = annotate.note_entities(notes, external).collect()
    assert all(r.account_name == rows[r.file.rsplit("/", 1)[1], r.note_idx] + "!" for r in found)
    with pytest.raises(ValueError):
        annotate.note_entities(notes, external.drop("file"))


def test_run_uses_notes_entities_and_the_analysis(spark, folder):
    data = files.load_all(spark, folder)
    first = data.notes.select("file", "note_idx").orderBy("note_idx").first()
    entities = data.notes.select("file", "note_idx").withColumns({
        "account_id": F.when(F.col("note_idx") == first.note_idx, F.lit(1001).cast("long")),
        "account_name": F.lit(""), "date_str": F.lit("2026-01-01"), "csm_name": F.lit("Kim")})

    def analyse(batch):
        out = batch[["account_id"]].copy()
        out["seq"] = 1
        out["response_json"] = '{"sentiment": "negative", "risk_score": 0.9}'
        return out

    result = pipeline.run(data, entities=entities, analyse=analyse)
    assert {r.csm_name for r in result.notes.collect()} == {"Kim"}
    texts = by_key(result.notes_by_account)
    assert 1001 in texts and texts[1001].n_notes >= 1
    risk = by_key(result.risk)
    assert risk[1001].csm_sentiment == "negative"
    assert "ingest_order" not in result.risk.columns


def test_materialise_writes_to_the_shared_folder(spark):
    df = materialise(spark.range(5))
    assert df.count() == 5
    assert df.inputFiles()[0].removeprefix("file:").removeprefix("//").startswith(
        shared_folder(spark))


def test_csv_keeps_blanks_and_quotes(spark, tmp_path):
    text = ' a "b", \n c '
    exports.write_csv(spark.createDataFrame([(1, text)], "i int, t string"), str(tmp_path / "x"))
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(
        str(tmp_path / "x"))
    assert back.first().t == text
