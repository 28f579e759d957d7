"""Page numbering, page files, payload shapes."""

import collections
import json
import os

from pyspark.sql import functions as F

from ratesheet import schemas
from ratesheet.operators import paging
from ratesheet.operators.staging import conform, empty_staging, stage_transform
from ratesheet.sources import pages, sinks

def at():
    return F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")


def records(spark, n, copies=0):
    """``n`` different records and ``copies`` more of the first."""
    rows = [(f"DRUG {i}", str(i)) for i in range(n)] + [("DRUG 0", "0")] * copies
    return conform(spark.createDataFrame(rows, "ndc_description string, ndc string")).select(
        *[F.col(c).cast("string") for c in schemas.STAGING_COLUMNS]
    )


def test_pages_are_full_and_lose_nothing(spark):
    df = records(spark, 40, copies=61)
    found = paging.page_envelopes(df, schemas.STAGING_COLUMNS, at(), page_size=10).orderBy("page_number").collect()
    assert [r.page_number for r in found] == list(range(1, 12))
    assert [r.records_count for r in found] == [10] * 10 + [1]
    bodies = [json.loads(r.body) for r in found]
    assert [len(b["data"]["results"]) for b in bodies] == [10] * 10 + [1]
    counted = collections.Counter(x["ndc"] for b in bodies for x in b["data"]["results"])
    assert counted["0"] == 62 and len(counted) == 40 and sum(counted.values()) == 101
    assert [b["offset"] for b in bodies] == [10 * i for i in range(11)]
    assert all(r.file_size_bytes == len(r.body.encode()) for r in found)
    totals = paging.page_totals(paging.page_envelopes(df, schemas.STAGING_COLUMNS, at(), 10)).first()
    assert tuple(totals) == (11, 101, 11)


def test_numbers_come_without_texts(spark):
    """The exchanges that count and number hold no record; fewer slots give the same pages."""
    df = records(spark, 40, copies=61)
    few = paging.page_envelopes(df, schemas.STAGING_COLUMNS, at(), 10, slot_digits=1).drop("file_name")
    many = paging.page_envelopes(df, schemas.STAGING_COLUMNS, at(), 10, slot_digits=3).drop("file_name")
    assert few.exceptAll(many).count() == 0 and few.count() == 11
    runs = paging.numbered_runs(df, schemas.STAGING_COLUMNS)
    tree = runs._jdf.queryExecution().executedPlan().toString()
    counting = [line for line in tree.split("\n") if "hashpartitioning(slot" in line or "hashpartitioning(sort_key" in line]
    assert len(counting) >= 3 and tree.count("any_value") + tree.count("first(record") == 2


def test_page_files_round_trip(spark, tmp_path):
    envelopes = paging.page_envelopes(records(spark, 25), schemas.STAGING_COLUMNS, at(), 10)
    assert sinks.land_pages(envelopes, f"{tmp_path}/files") == 3
    names = sorted(f.name for f in (tmp_path / "files").rglob("*.json"))
    assert [n for n in names if n.endswith(".json")] == [
        f"medicaid_drug_data_page_{n:04d}_20240102_030405.json" for n in (1, 2, 3)
    ]
    sinks.land_page_lines(envelopes, f"{tmp_path}/lines")
    for path, whole in ((f"{tmp_path}/files", True), (f"{tmp_path}/lines", False)):
        found = pages.extract_records(pages.read_pages(spark, path, whole_file=whole))
        assert sorted(int(r.ndc) for r in found.collect()) == list(range(25))


def test_packed_pages_are_small_and_read_back(spark, tmp_path):
    """Packed page files and lines hold the same pages in a fraction of the bytes; a repeat writes the same."""
    size = lambda folder: sum(f.stat().st_size for f in (tmp_path / folder).rglob("*") if f.suffix != ".crc")
    envelopes = paging.page_envelopes(records(spark, 2000), schemas.STAGING_COLUMNS, at(), 500)
    for kind in ("plain", "packed"):
        assert sinks.land_pages(envelopes, f"{tmp_path}/files_{kind}", landing="l", packed=kind == "packed") == 4
        sinks.land_page_lines(envelopes, f"{tmp_path}/lines_{kind}", packed=kind == "packed")
        for place, whole in (("files", True), ("lines", False)):
            found = pages.extract_records(pages.read_pages(spark, f"{tmp_path}/{place}_{kind}", whole_file=whole))
            assert sorted(int(r.ndc) for r in found.collect()) == list(range(2000))
    assert 5 * size("files_packed") < size("files_plain") and 5 * size("lines_packed") < size("lines_plain")
    names = {f.name for f in (tmp_path / "files_plain/l").iterdir()}
    assert {f.name for f in (tmp_path / "files_packed/l").iterdir()} == {f"{n}.gz" for n in names}
    first = {f.name: f.read_bytes() for f in (tmp_path / "files_packed/l").iterdir()}
    sinks.land_pages(envelopes, f"{tmp_path}/files_packed", landing="l", packed=True)
    assert {f.name: f.read_bytes() for f in (tmp_path / "files_packed/l").iterdir()} == first


def test_payload_shapes(spark, tmp_path):
    rec = [{"ndc": "1", "extra": 5, "otc": None}, {"ndc": 2}]
    cases = {
        "data": ({"data": {"results": rec}}, 2),
        "raw": ({"raw_response": {"results": rec}}, 2),
        "top": ({"results": rec}, 2),
        "data_first": ({"data": {"results": []}, "results": rec}, 0),
        "no_results_key": ({"data": {"n": 1}, "results": rec}, 0),
        "null_results": ({"data": {"results": None}, "results": rec}, 2),
        "data_is_list": ({"data": rec}, 0),
        "data_is_list_top": ({"data": rec, "results": rec}, 2),
        "nothing": ({"a": 1}, 0),
    }
    for name, (payload, _) in cases.items():
        (tmp_path / f"{name}.json").write_text(json.dumps({"source": name, **payload}, indent=2))
    found = pages.extract_records(pages.read_pages(spark, str(tmp_path)), "source")
    counts = collections.Counter(r.source for r in found.collect())
    assert {n: counts[n] for n in cases} == {n: c for n, (_, c) in cases.items()}
    assert {r.ndc for r in found.collect()} == {"1", "2"}
    assert found.columns == ["source", *schemas.STAGING_COLUMNS]


def test_reply_shapes(spark):
    rec = [{"ndc": "1"}, {"ndc": "2"}]
    cases = {
        "list": (rec, 2),
        "results": ({"results": rec, "data": rec + rec}, 2),
        "data": ({"data": rec}, 2),
        "records": ({"records": rec}, 2),
        "empty_results_hide_data": ({"results": [], "data": rec}, 0),
        "null_results_items": ({"results": None, "items": [], "rows": rec}, 2),
        "fallback": ({"content": rec}, 2),
        "object_ends_search": ({"data": {"x": 1}, "items": rec}, 0),
        "empty_object": ({"data": {}, "items": rec}, 2),
    }
    df = spark.createDataFrame([(n, json.dumps(p)) for n, (p, _) in cases.items()], "name string, body string")
    counts = collections.Counter(r.name for r in pages.locate_records(df, "body", "name").collect())
    assert {n: counts[n] for n in cases} == {n: c for n, (_, c) in cases.items()}


def test_only_raw(spark, tmp_path):
    for folder in ("drug_data/raw", "drug_data/other"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "a.json").write_text(json.dumps({"source": folder}))
    df = pages.read_pages(spark, f"{tmp_path}/drug_data/*/*.json")
    assert [r.source for r in pages.only_raw(df, str(tmp_path)).select("source").collect()] == ["drug_data/raw"]
    # An archive that keeps the whole old path inside is not below the prefix.
    kept = tmp_path / "archive/drug_data/raw"
    kept.mkdir(parents=True)
    (kept / "a.json").write_text("{}")
    archived = pages.read_pages(spark, str(kept))
    assert pages.only_raw(archived, str(tmp_path)).count() == 0
    assert pages.only_raw(archived, f"{tmp_path}/archive").count() == 1


def test_stage_and_conform(spark):
    assert empty_staging(spark).schema == schemas.STAGING and empty_staging(spark).count() == 0
    raw = spark.createDataFrame(
        [("0-1", "1/5/2024", "x"), (" - ", "2024-01-05", "y"), (None, None, "z")],
        "ndc string, effective_date string, extra string",
    )
    staged = stage_transform(raw)
    assert staged.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.STAGING.fields]
    assert [(r.ndc, str(r.effective_date)) for r in staged.collect()] == [("01", "2024-01-05")]


def test_texts_move_once(spark):
    """Blocks of whole pages, pages at their edges and pages of one record: nothing is lost or placed elsewhere."""
    df = records(spark, 900, copies=61)
    rows = df.select(paging.record_json(schemas.STAGING_COLUMNS).alias("r"), F.md5("r").alias("k")).orderBy("k").collect()
    for heavy in (20, 10_000):
        made = paging.page_contents(df, schemas.STAGING_COLUMNS, 10, heavy=heavy)
        pages_ = {p.page_number: (p.records_count, json.loads(p.records)) for p in made.collect()}
        whole = [json.loads(r.r) for r in rows]
        assert pages_ == {i // 10 + 1: (len(whole[i : i + 10]), whole[i : i + 10]) for i in range(0, len(whole), 10)}
    runs = paging.block_runs(df, schemas.STAGING_COLUMNS, 4, 200, 20)
    moved = [r for r in runs.select("block", "block_start", "block_end").distinct().collect()]
    assert len(moved) > 3 and all(r.block_end - r.block_start > 100 for r in moved[:-1])
    # Most pages lie inside their block: their texts go nowhere else.
    inside = sum(r.block_end // 10 - -(-r.block_start // 10) for r in moved)
    assert inside >= 0.7 * len(pages_)


def test_pages_are_stored_in_small_groups(spark, tmp_path):
    """A row group of a table of pages is not a hundred pages long, and the bodies are not in it."""
    import pyarrow.parquet as pq

    parts = spark.range(0, 40, 1, 1).select(
        "id", F.repeat(F.sha2(F.col("id").cast("string"), 512), 16384).alias("records")
    )
    sinks.write_pages(parts, f"{tmp_path}/pages")
    (file,) = [pq.ParquetFile(f) for f in (tmp_path / "pages").glob("*.parquet")]
    assert file.metadata.num_rows == 40 and file.metadata.num_row_groups == 5
    envelopes = paging.page_parts(records(spark, 25), schemas.STAGING_COLUMNS, at(), 10)
    assert "body" not in envelopes.columns
    made = paging.page_envelopes(records(spark, 25), schemas.STAGING_COLUMNS, at(), 10)
    assert made.exceptAll(paging.with_bodies(envelopes)).isEmpty()
