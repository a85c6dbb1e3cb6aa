"""Files whose records span lines, read in many small splits, against whole-file readers."""

import random

import pytest
from pyspark.sql import functions as F

from acctrisk import fixed
from acctrisk.operators import notes
from acctrisk.sources import files, records

NPS = "account_id long, score long, verbatim_comment string"


@pytest.fixture
def small_splits(spark):
    """File splits of a few hundred bytes, each in a task of its own."""
    settings = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "300"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def cells(rng):
    parts = ["a", "é", '"', "\n", "\r\n", ",", " ", "x" * 40, "\n\n", "---", ""]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(12)))


def write_survey(path, rng, rows, end="\n", first=0, extra=""):
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write("account_id,score,verbatim_comment" + end)
        for i in range(first, first + rows):
            text = cells(rng)
            if rng.random() < 0.5 or any(c in text for c in '",\n\r') or text.strip() != text:
                text = '"' + text.replace('"', '""') + '"'
            f.write(f"{i},{i % 11},{text}{end}")
        f.write(extra)


def whole(spark, path):
    df = spark.read.schema(NPS).options(
        header=True, escape='"', multiLine=True, mode="FAILFAST").csv(path)
    return df.withColumn("verbatim_comment", F.coalesce("verbatim_comment", F.lit("")))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_survey_file_is_read_by_several_tasks_like_the_whole_file(spark, tmp_path, small_splits):
    path = str(tmp_path / "nps.csv")
    long = "9001,5,\"" + "line\n" * 500 + '"\n\n\n9002,1,last'
    write_survey(path, random.Random(1), 400, extra=long)
    got = files.load_nps_responses(spark, path)
    assert rows_of(got) == rows_of(whole(spark, path))
    assert records.lines_of(spark, path).rdd.getNumPartitions() > 20


def test_survey_folder_with_other_line_ends(spark, tmp_path, small_splits):
    folder = tmp_path / "nps"
    folder.mkdir()
    rng = random.Random(2)
    write_survey(folder / "a.csv", rng, 60)
    write_survey(folder / "b.csv", rng, 60, "\r\n", 100)
    write_survey(folder / "c.csv", rng, 0)
    assert rows_of(files.load_nps_responses(spark, str(folder))) == rows_of(
        whole(spark, str(folder)))
    (folder / "d.csv").write_text("score,account_id,verbatim_comment\n3,500,bad\n")
    with pytest.raises(Exception, match="header"):
        files.load_nps_responses(spark, str(folder)).collect()


def test_bad_cells_stop_the_read(spark, tmp_path):
    for i, line in enumerate(("x,3,bad id", ",3,no id", '1,2,"a",too many')):
        path = tmp_path / f"{i}.csv"
        path.write_text(f"account_id,score,verbatim_comment\n{line}\n")
        with pytest.raises(Exception):
            files.load_nps_responses(spark, str(path)).collect()


def test_accounts_that_span_lines_keep_their_order(spark, tmp_path, small_splits):
    path = tmp_path / "accounts.csv"
    path.write_text("account_id,account_name,arr,contract_end_date,plan_tier,industry,csm_name,region\n"
                    + "".join(f'{i % 7},"Name\n{i}",5,2026-06-01,Scale,X,Y,Z\n' for i in range(80)))
    df = files.load_accounts(spark, str(path), ordered=True, multi_line=True)
    rows = [r.account_name for r in df.orderBy("ingest_order").collect()]
    assert rows == [f"Name\n{i}" for i in range(80)]


def text_files(folder, rng, line, n_files=3, lines=120):
    folder.mkdir()
    for i in range(n_files):
        end = ("\n", "\r\n", "\r")[i % 3]
        body = end.join(line(rng) for _ in range(rng.randrange(1, lines))) + end
        (folder / f"{i}.txt").write_bytes((body + "the end").encode())
    (folder / "empty.txt").write_bytes(b"")
    return str(folder)


@pytest.mark.parametrize("strip_banner", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_notes_in_splits_equal_notes_of_whole_files(
        spark, tmp_path, small_splits, seed, strip_banner):
    """Separators in runs, at the start of files and on both sides of every cut."""
    def line(rng):
        return rng.choice(["---", "---", "-----", "--", "", " --- ", "acct 1234 - Acme call",
                           "=== CSM banner", "text " * 12, "Mar 3 - Größe Corp."])
    path = text_files(tmp_path / "notes", random.Random(seed), line)
    expected = notes.extract_entities(
        notes.split_notes(files.read_texts(spark, path), strip_banner=strip_banner))
    got = files.load_notes(spark, path, strip_banner)
    assert got.columns == expected.columns
    assert rows_of(got) == rows_of(expected)


def test_a_run_of_separators_over_many_splits(spark, tmp_path, small_splits):
    for n in (400, 401):
        path = tmp_path / f"{n}.txt"
        path.write_text("---\n" * n + "text\n" + "---\n" * n + "end")
        expected = notes.split_notes(files.read_texts(spark, str(path)))
        got = files.load_notes(spark, str(path)).select("file", "note_idx", "raw_text")
        assert rows_of(got) == rows_of(expected.select("file", "note_idx", "raw_text"))


def test_one_note_larger_than_a_split(spark, tmp_path, small_splits):
    path = tmp_path / "notes.txt"
    path.write_text("first\n---\n" + "long line\n" * 2000 + "---\nlast\n")
    rows = {r.note_idx: r.raw_text for r in files.load_notes(spark, str(path)).collect()}
    assert rows == {1: "first", 2: ("long line\n" * 2000).strip(), 3: "last"}


@pytest.mark.parametrize("seed", [3, 4])
def test_changelog_in_splits_equals_whole_files(spark, tmp_path, small_splits, seed):
    def line(rng):
        n = rng.randrange(9)
        return rng.choice([
            f"### v{n}.0.1 — May {n}, 2001", f"### v{n}.2 - soon", "### Upcoming — v9.9.9",
            "### version notes", f"#### v{n}.7 - deeper", "plain", "",
            "- 🔴 SDK v4.2.0+ changes the response envelope", "- ⚠️ SDK v3.x sunset after May 1, 2002",
            f"- Fixed: hole (CVE-2001-{n}). Update.", "- 🔴 BREAKING line"])
    path = text_files(tmp_path / "logs", random.Random(seed), line)
    expected = notes.parse_changelog(files.read_texts(spark, path)).drop("file")
    got = files.load_changelog(spark, path)
    assert got.columns == expected.columns
    assert rows_of(got) == rows_of(expected)


def test_separator_is_that_of_whole_texts():
    assert fixed.NOTE_SEPARATOR == r"\n---+\n"
