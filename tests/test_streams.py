"""Streams on temporary folders, each run twice to prove that nothing is handled twice."""

import base64
import glob
import json
import os

import pytest
from pyspark.sql import DataFrame, functions as F

from ratesheet.operators.staging import stage_transform
from ratesheet.plans import views
from ratesheet.sources import pages, sinks, storage, tables
from ratesheet.streaming import arrivals, topics


def page(path, numbers):
    rows = [{"ndc": f"{n:05d}-01", "effective_date": "2024-01-05"} for n in numbers]
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps({"page_number": 1, "data": {"results": rows}}, indent=2))


def finish(*queries):
    for q in queries:
        q.awaitTermination(120)
        assert q.exception() is None


def staged(spark, out):
    return sorted(r.ndc for r in tables.read_staging(spark, out).collect())


def arrive(spark, tmp_path, **options):
    root, out, bad, done = (str(tmp_path / d) for d in ("bucket", "staging", "bad", "done"))
    finish(arrivals.stage_arrivals(spark, root, out, bad, done, str(tmp_path / "chk"), **options))
    return out, bad, arrivals.archive_handled(spark, root, done, str(tmp_path / "journal"))


def test_arrivals(spark, tmp_path):
    raw, processed = tmp_path / "bucket/drug_data/raw", tmp_path / "bucket/drug_data/processed"
    page(raw / "a.json", [1, 2])
    page(raw / "deep/none.json", [])
    page(raw / "named otherwise.dat", [5])
    page(tmp_path / "bucket/drug_data/other/x.json", [9])
    (raw / "notes.txt").write_text("no page")
    (raw / "broken.json").write_text('{"page_number": 1, "data": ')
    for _ in range(2):
        out, bad, _ = arrive(spark, tmp_path)
        assert staged(spark, out) == ["0000101", "0000201", "0000501"]
        rows = {os.path.basename(r.file_path): r.body for r in spark.read.parquet(bad).collect()}
        assert rows == {"notes.txt": "no page", "broken.json": '{"page_number": 1, "data": '}
    names = {str(f.relative_to(processed)) for f in processed.rglob("*") if f.is_file() and f.name[0] != "."}
    assert names == {"a.json", "deep/none.json", "named otherwise.dat", "notes.txt", "broken.json"}
    assert not [f for f in raw.rglob("*") if f.is_file() and f.name[0] != "."]
    page(raw / "b.json", [3])
    out, _, moved = arrive(spark, tmp_path)
    assert moved == 1 and staged(spark, out) == ["0000101", "0000201", "0000301", "0000501"]


def test_batches_of_few_files(spark, tmp_path):
    for n in range(5):
        page(tmp_path / f"bucket/drug_data/raw/{n}.json", [n])
    out, _, moved = arrive(spark, tmp_path, files_per_batch=2)
    assert moved == 5 and len(staged(spark, out)) == 5
    assert len(glob.glob(f"{out}/load_id=*")) == 3


def test_a_broken_move_is_finished_later(spark, tmp_path, monkeypatch):
    """Some files are moved and no journal is written: the next run moves the rest, and enters all."""
    raw, processed = tmp_path / "bucket/drug_data/raw", tmp_path / "bucket/drug_data/processed"
    for n in range(7):
        page(raw / f"{n}.json", [n])

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(arrivals, "moved", broken)
        with pytest.raises(OSError):
            arrive(spark, tmp_path)
    (processed).mkdir(parents=True)
    for n in range(3):
        (raw / f"{n}.json").rename(processed / f"{n}.json")
    out, _, moved = arrive(spark, tmp_path)
    assert moved == 4 and len(staged(spark, out)) == 7
    assert {f.name for f in processed.glob("*.json")} == {f"{n}.json" for n in range(7)}
    journal = spark.read.parquet(str(tmp_path / "journal"))
    assert sorted(r.moved for r in journal.collect()) == [False] * 3 + [True] * 4
    # A file of the same name that comes later is not in question: names in the journal are done.
    assert arrive(spark, tmp_path)[2] == 0
    assert spark.read.parquet(str(tmp_path / "journal")).count() == 7


def test_a_landing_appears_at_once(spark, tmp_path):
    """A repeated landing replaces itself; one that fails leaves no file where readers look."""
    rows = spark.createDataFrame([(f"p{k}.json", f'{{"page_number": {k}}}') for k in range(40)], "file_name string, body string")
    path = f"{tmp_path}/files"
    for _ in range(2):
        assert sinks.land_pages(rows.repartition(4), path, landing="monday") == 40
    assert sorted(f.name for f in (tmp_path / "files/monday").iterdir()) == sorted(f"p{k}.json" for k in range(40))
    wrong = rows.withColumn("body", F.when(F.col("file_name") == "p7.json", F.raise_error(F.lit("x"))).otherwise("b"))
    with pytest.raises(Exception, match="x"):
        sinks.land_pages(wrong.repartition(4), path, landing="tuesday")
    assert not (tmp_path / "files/tuesday").exists()
    assert pages.read_pages(spark, path).count() == 40


def test_landed_pages_arrive(spark, tmp_path, sf_dir):
    """What the landing sink writes is what the arrival job reads, record by record."""
    found = views.pages(spark, sf_dir)
    landed = sinks.land_pages(found, f"{tmp_path}/bucket/drug_data/raw")
    out, bad, moved = arrive(spark, tmp_path)
    assert moved == landed == found.count()
    want = stage_transform(views.nadac_raw(spark, sf_dir))
    got = tables.read_staging(spark, out)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert spark.read.parquet(bad).count() == 0


def test_stored_pages_are_packed_and_their_shuffles_go(spark, sf_dir, monkeypatch):
    """The page files that the registered queries land are packed, arrive and are archived under their
    names; shuffle files of a stored table go with its write."""
    monkeypatch.setattr(views, "_written", {})
    seen = []
    views.stored(spark, sf_dir, "probe", lambda p: seen.append(spark.conf.get(storage.CLEAN_UP)))
    assert seen == ["true"] != [spark.conf.get(storage.CLEAN_UP)]
    bucket = views.arrived_path(spark, sf_dir).rsplit("/", 1)[0] + "/bucket"
    files = [f for f in glob.glob(f"{bucket}/**/*", recursive=True) if os.path.isfile(f) and "/processed/" in f]
    assert len(files) == views.pages(spark, sf_dir).count() and all(f.endswith(".json.gz") for f in files)


def message(**fields):
    return base64.b64encode(json.dumps(fields).encode()).decode()


GOOD = dict(sensor_id="pump/4", timestamp="2022-07-30T04:15:00Z", temperature=17.0, humidity=51, location="well")


@pytest.fixture
def topic(tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()
    lines = [
        message(**GOOD),
        message(**{**GOOD, "temperature": 101}),
        message(**{**GOOD, "temperature": "hot"}),
        message(**{**GOOD, "temperature": "19.5"}),
        message(**{**GOOD, "timestamp": "30 July, early"}),
        message(sensor_id="s2", temperature=None),
        "!!!",
    ]
    (folder / "1.txt").write_text("\n".join(lines) + "\n")
    return folder


MISSING = [f"Missing required field: {c}" for c in ("sensor_id", "timestamp", "temperature")]


def test_routing(spark, tmp_path, topic):
    valid, bad, chk = (str(tmp_path / d) for d in ("valid", "bad", "chk"))

    def run():
        finish(topics.route_messages(spark, str(topic), valid, bad, chk))
        good = [json.loads(base64.b64decode(r.value)) for r in spark.read.text(valid).collect()]
        errors = [json.loads(r.value) for r in spark.read.text(bad).collect()]
        return good, errors

    for _ in range(2):
        good, errors = run()
        # A temperature that is no number is not range-checked; a time is there in any form.
        assert sorted(str(g["temperature"]) for g in good) == ["17.0", "17.0", "19.5", "hot"]
        want = [
            {"original_data": {**GOOD, "temperature": 101}, "errors": ["Temperature out of valid range (-50 to 100)"], "timestamp": GOOD["timestamp"]},
            {"original_data": {"sensor_id": "s2", "temperature": None}, "errors": MISSING[1:], "timestamp": None},
            {"original_data": "!!!", "errors": MISSING, "timestamp": None},
        ]
        assert sorted(errors, key=str) == sorted(want, key=str)
    (topic / "2.txt").write_text(message(**GOOD) + "\n")
    assert len(run()[0]) == 5


def test_two_subscribers(spark, tmp_path, topic):
    table, bad, archive, chk = (str(tmp_path / d) for d in ("table", "bad", "archive", "chk"))
    for _ in range(2):
        finish(*topics.process_and_archive(spark, str(topic), table, bad, archive, chk))
        rows = tables.read_processed_sensor(spark, table).collect()
        assert {(r.quality_score, r.anomaly_detected) for r in rows} == {(0.95, False)}
        got = sorted(str(r.avg_temperature) for r in rows)
        assert got == ["101.0", "17.0", "17.0", "19.5", "None", "None"]
        assert [json.loads(r.value)["original_data"] for r in spark.read.text(bad).collect()] == ["!!!"]
        assert spark.read.parquet(archive).count() == 7


def test_alerts(spark, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    lines = [message(), message(type="disk", message="full", severity="high")]
    (topic / "1.txt").write_text("\n".join(lines) + "\n")
    out, chk = str(tmp_path / "alerts"), str(tmp_path / "chk")
    for _ in range(2):
        finish(topics.alert_messages(spark, str(topic), out, chk))
        assert sorted(r.line for r in spark.read.parquet(out).collect()) == [
            "NOTIFICATION [HIGH]: disk - full",
            "NOTIFICATION [INFO]: general - No message provided",
        ]


def test_a_batch_is_not_held_as_text(spark, tmp_path, monkeypatch):
    """Records, broken texts and handled names come from one pass that keeps no page; it leaves nothing."""
    raw = tmp_path / "bucket" / "drug_data" / "raw"
    raw.mkdir(parents=True)
    (raw / "a.json").write_text('{"data": {"results": [{"ndc": "1"}, {"ndc": "2"}, null]}}')
    (raw / "b.json").write_text('{"data": {"results": []}}')
    (raw / "c.json").write_text('{"data": {"results": [')
    monkeypatch.setattr(DataFrame, "persist", None)
    places = [f"{tmp_path}/{name}" for name in ("staging", "quarantine", "handled", "checkpoint")]
    arrivals.stage_arrivals(spark, f"{tmp_path}/bucket", *places).awaitTermination()
    assert sorted(r.ndc for r in spark.read.parquet(places[0]).collect()) == ["1", "2"]
    assert spark.read.parquet(places[1]).count() == 1 and spark.read.parquet(places[2]).count() == 3
    assert not list((tmp_path / "staging").glob("_incoming/*"))
