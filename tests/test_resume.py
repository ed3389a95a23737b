"""Runs that go on from where others ended: tails of the log, finished documents, packed files."""

import json

import pytest
from pyspark.sql import functions as F

from factloom import cli
from factloom.operators import audit
from factloom.plans.extract import earlier, tails_of, write
from factloom.sources import files, sinks


class Found:
    """What ``write`` needs of an extraction, made of a few rows."""

    def __init__(self, spark, values):
        rows = [(d, i, "p", v) for d, vs in values.items() for i, v in enumerate(vs)]
        self.scored = spark.createDataFrame(rows, "document_id string, record_index int, path string, value string").withColumn("status", F.lit("VALIDATED"))
        self.queue = self.injections = self.skipped = self.scored.select("document_id", "path")

    def documents(self, masked=False):
        return self.scored.groupBy("document_id").agg(F.to_json(F.collect_list("value")).alias("json"))

    def sidecars(self):
        return self.documents()

    def audit_log(self, timestamp=None, log=None, ends=None):
        events = self.scored.withColumn("event", F.lit("FIELD_VALIDATED")).withColumn("timestamp", F.lit("t"))
        return audit.append(events, ["record_index", "value"], log, ends)


def test_a_run_reads_tails_and_not_the_log(spark, tmp_path):
    folder = tmp_path / "out"
    first = write(Found(spark, {"d": ["a", "b"], "e": ["c"]}), str(folder))
    second = write(Found(spark, {"d": ["x"] * 3}), str(folder))
    for run in (first, second):  # no entry of an earlier run can be read
        (folder / "audit" / f"run={run}").rename(tmp_path / run)
    third = write(Found(spark, {"d": ["y"], "e": ["z"], "f": ["w"]}), str(folder))
    for run in (first, second):
        (tmp_path / run).rename(folder / "audit" / f"run={run}")
    log = earlier(spark, str(folder))
    assert {r.document_id: (r.entries, r.intact, r.gap) for r in audit.verify(log).collect()} == {"d": (6, True, None), "e": (2, True, None), "f": (1, True, None)}
    assert {r.document_id: r.sequence for r in tails_of(spark, str(folder)).collect()} == {"d": 5, "e": 1, "f": 0}
    assert len({first, second, third}) == 3


def test_verified_from_a_tail_as_from_the_beginning(spark, tmp_path):
    folder = str(tmp_path / "out")
    first = write(Found(spark, {"d": ["a", "b"], "e": ["c"]}), folder)
    ends = spark.createDataFrame(tails_of(spark, folder).collect())
    write(Found(spark, {"d": ["x"] * 3, "f": ["u", "v"]}), folder)
    log = earlier(spark, folder)
    later = {r.document_id: (r.entries, r.intact, r.gap) for r in audit.verify(log, ends).collect()}
    assert later == {"d": (3, True, None), "f": (2, True, None)}
    new = earlier(spark, folder, first)  # the other run's entries alone will do
    assert {r.document_id: (r.entries, r.intact) for r in audit.verify(new, ends).collect()} == {"d": (3, True), "f": (2, True)}
    forged = log.withColumn("outcome", F.when((F.col("document_id") == "d") & (F.col("sequence") == 3), "FAILED").otherwise(F.col("outcome")))
    for since in (None, ends):
        r = audit.verify(forged, since).where("document_id = 'd'").first()
        assert not r.intact and r.failed_sequence == 3 and r.reason == "hash_differs"
    cut_out = log.where("not (document_id = 'd' and sequence = 2)")
    assert [audit.verify(cut_out, since).where("document_id = 'd'").first().gap for since in (None, ends)] == [2, 2]


def test_a_run_that_was_cut_off_is_completed(spark, tmp_path):
    import shutil

    folder = tmp_path / "out"
    one, two = Found(spark, {"d": ["a", "b"]}), Found(spark, {"d": ["c"]})
    run = write(one, str(folder))
    shutil.rmtree(folder / "tails" / f"run={run}")  # entries are there, tails are not
    write(two, str(folder))
    before = earlier(spark, str(folder)).count()
    write(one, str(folder))  # both again: nothing is added
    write(two, str(folder))
    verdict = audit.verify(earlier(spark, str(folder))).first()
    assert verdict.entries == before == 3 and verdict.intact and verdict.gap is None
    (folder / "audit" / f"run={run}" / "_SUCCESS").unlink()  # cut off while entries were written: they do not count
    assert audit.tails(earlier(spark, str(folder))).first().sequence == 2


HEAD = "Market|Currency|Agent BIC|Account"
ROWS = ["France|EUR|BNPAFRPP|0012345678", "Germany|EUR|DEUTDEFF|0087654321", "Japan|JPY|BOTKJPJT|0055512345", "Canada|CAD|ROYCCAT2|0099911122"]


def test_the_command_line_does_no_work_twice(spark, tmp_path, capsys):
    here = tmp_path / "in"
    here.mkdir()
    (here / "a.pdf").write_text("%PDF-\n" + "\n".join([HEAD, *ROWS]))
    (here / "bad.pdf").write_text("no such file")
    args = ["--input-dir", str(here), "--port", "tests.ports:PORT", "--output-dir", str(tmp_path / "out"), "--packed"]
    assert cli.main(args) == 0
    done = [r.document_id for r in files.finished(spark, str(tmp_path / "out")).collect()]
    assert len(done) == 1 and done[0].startswith("a-")
    assert cli.main(args) == 0 and "nothing new" in capsys.readouterr().err
    (here / "again.pdf").write_text("%PDF-\n" + "\n".join([HEAD, *reversed(ROWS)]))
    assert cli.main(args) == 0
    runs = sorted((tmp_path / "out" / "documents").glob("run=*"))
    assert len(runs) == 2 and files.finished(spark, str(tmp_path / "out")).count() == 2
    found = [r for run in runs for r in sinks.read_packed(spark, str(run), done).collect()]
    assert len(found) == 1 and [r["account"]["value"] for r in json.loads(found[0].json)["settlementInstructionRecords"]] == [r.split("|")[3] for r in ROWS]


def test_many_documents_in_few_files(spark, tmp_path):
    docs = spark.range(100_000).select(F.format_string("é%07d", "id").alias("document_id"), F.concat(F.lit('{"a":\n  "ü'), F.repeat(F.lit("x"), (F.col("id") % 40).cast("int")), F.lit('"}')).alias("json"))
    sinks.write_packed(docs, str(tmp_path / "p"), target=200_000)
    names = [p for p in (tmp_path / "p" / "data").iterdir() if p.name.startswith("part-")]
    assert 5 < len(names) < 50
    wanted = ["é0000000", "é0099999", "é0050123", "none"]
    got = {r.document_id: json.loads(r.json) for r in sinks.read_packed(spark, str(tmp_path / "p"), wanted).collect()}
    assert got == {d: {"a": "ü" + "x" * (int(d[1:]) % 40)} for d in wanted[:3]}
    index = spark.read.parquet(str(tmp_path / "p" / "index"))
    assert index.count() == 100_000 and sinks.read_packed(spark, str(tmp_path / "p"), ["none"]).count() == 0
    sinks.write_packed(docs.where("false"), str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q" / "index")).count() == 0


def test_too_many_patterns_are_refused(spark, tmp_path):
    (tmp_path / "p.yaml").write_text("FR:\n" + "  - x\n" * files.MAX_PATTERN_LINES)
    with pytest.raises(ValueError, match="more than"):
        files.account_patterns(spark, str(tmp_path / "p.yaml"))
    (tmp_path / "q.yaml").write_text("FR:\n" + "  - x\n" * (files.MAX_PATTERN_LINES - 1))
    assert len(files.account_patterns(spark, str(tmp_path / "q.yaml"))["FR"]) == files.MAX_PATTERN_LINES - 1
