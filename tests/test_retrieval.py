"""Vector search against brute force, on small fixtures."""

import uuid

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import DataFrame, functions as F

from ratesheet.operators import documents, retrieval, vector_blocks
from ratesheet.operators.conversation import conversation_context


def brute_force(ids, vectors, question_ids, questions, k, skip_self):
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = np.round(unit(questions) @ unit(vectors).T, 6) + 0.0
    hits = set()
    for q, row in zip(question_ids, scores):
        order = sorted((-s, i) for s, i in zip(row, ids) if not (skip_self and i == q))
        hits |= {(q, i, -s, rank) for rank, (s, i) in enumerate(order[:k], 1)}
    return hits


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    points = np.round(rng.normal(size=(400, 8)), 1)
    points[:130] = points[0]  # a third of all vectors are copies
    return points


def frame(spark, points, name):
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, f"{name} long, vector array<float>")


def as_set(df):
    return {(r.question_id, r.id, r.similarity, r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("skip_self", [False, True])
def test_scan_and_blocks_match_brute_force(spark, points, skip_self):
    vectors = frame(spark, points, "id")
    questions = vectors.withColumnRenamed("id", "question_id")  # one and the same table
    ids = list(range(len(points)))
    expected = brute_force(ids, points.astype(np.float32).astype(float), ids, points.astype(np.float32).astype(float), 5, skip_self)
    assert as_set(retrieval.topk(vectors, questions, 5, skip_self)) == expected
    assert as_set(retrieval.topk(vectors, questions, 5, skip_self, block_bytes=8_000)) == expected


@pytest.mark.parametrize("skip_self", [False, True])
def test_ten_blocks_in_one_scan(spark, points, tmp_path, skip_self, monkeypatch):
    """Ten blocks of questions and several of vectors: one scan, and no question in the driver."""
    frame(spark, points, "id").coalesce(2).write.parquet(f"{tmp_path}/vectors")
    vectors = spark.read.parquet(f"{tmp_path}/vectors")
    questions = frame(spark, points, "question_id")
    monkeypatch.setattr(DataFrame, "toPandas", None)
    hits = retrieval.topk(vectors, questions, 5, skip_self, block_bytes=40 * 8 * 8)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan
    ids = list(range(len(points)))
    p = points.astype(np.float32).astype(float)
    assert as_set(hits) == brute_force(ids, p, ids, p, 5, skip_self)


def test_coarse_scores_decide_nothing(spark):
    """Vectors closer to each other than single precision can tell."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=300)
    points = base + rng.normal(size=(200, 300)) * np.geomspace(1e-9, 1e-2, 200)[:, None]
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    vectors = spark.createDataFrame(rows, "id long, vector array<double>")
    ids = list(range(200))
    expected = brute_force(ids, points, ids[:20], points[:20], 7, False)
    asked = vectors.where("id < 20").withColumnRenamed("id", "question_id")
    assert as_set(retrieval.topk(vectors, asked, 7)) == expected


@pytest.mark.parametrize("skip_self", [False, True])
def test_index_is_exact_or_close(spark, points, tmp_path, skip_self):
    vectors, questions = frame(spark, points, "id"), frame(spark, points, "question_id")
    ids = list(range(len(points)))
    p = points.astype(np.float32).astype(float)
    expected = brute_force(ids, p, ids, p, 5, skip_self)
    path = str(tmp_path / "index")
    retrieval.build_index(vectors, path, n_lists=12, block_rows=20)
    assert as_set(retrieval.search_index(spark, path, questions, 5, skip_self=skip_self)) == expected
    close = as_set(retrieval.search_index(spark, path, questions, 5, n_probe=8, skip_self=skip_self))
    recall = len({h[:2] for h in close} & {h[:2] for h in expected}) / len(expected)
    assert 0.9 <= recall <= 1.0


def test_index_lists_are_cut_and_bounded(spark, points, tmp_path):
    path = str(tmp_path / "index")
    retrieval.build_index(frame(spark, points, "id"), path, n_lists=12, block_rows=20)
    manifest = spark.read.parquet(f"{path}/manifest").collect()
    assert sum(r.n for r in manifest) == len(points) and max(r.n for r in manifest) <= 20
    centres = {r.cell: np.array(r.centre) for r in spark.read.parquet(f"{path}/centres").collect()}
    for r in manifest:
        block = vector_blocks.read_block(f"{path}/blocks/{r.path}")
        angle = np.arccos(np.clip(vector_blocks.units(block.rows) @ centres[r.cell], -1, 1))
        assert abs(angle.min() - r.low) < 1e-4 and abs(angle.max() - r.high) < 1e-4
    with pytest.raises(ValueError):
        retrieval.build_index(frame(spark, points, "id"), path, n_lists=2_000_000)


def test_index_opens_only_blocks_that_can_matter(spark, points, tmp_path):
    """Blocks that a search must not need are taken away."""
    path = str(tmp_path / "index")
    retrieval.build_index(frame(spark, points, "id"), path, n_lists=12, block_rows=20)
    one = frame(spark, points[200:201], "question_id")
    nearest = as_set(retrieval.search_index(spark, path, one, 3, n_probe=1))
    cell = next(
        r.cell
        for r in spark.read.parquet(f"{path}/manifest").collect()
        if {h[1] for h in nearest} & set(vector_blocks.read_block(f"{path}/blocks/{r.path}").ids)
    )
    for r in spark.read.parquet(f"{path}/manifest").collect():
        if r.cell != cell:
            (tmp_path / "index" / "blocks" / r.path).unlink()
    assert as_set(retrieval.search_index(spark, path, one, 3, n_probe=1)) == nearest


def test_unsound_vectors_are_set_aside(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [1.0]), (3, [0.0, 1.0, 0.0]), (4, [None, 1.0]), (5, [0.0, 1.0])]
    vectors = spark.createDataFrame(rows, "id long, vector array<float>")
    asked = spark.createDataFrame([(0, [0.0, 2.0])], "question_id long, vector array<float>")
    got = {(r.id, r.similarity) for r in retrieval.topk(vectors, asked, 5).collect()}
    assert got == {(5, 1.0), (0, 0.0)}
    assert {r.id for r in retrieval.unsound_vectors(vectors, 2).collect()} == {1, 2, 3, 4}


def test_embedder_is_called_once_a_text_in_batches(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def counting(texts):
        (log / uuid.uuid4().hex).write_text("\n".join(texts))
        return np.array([[len(t), 1.0] for t in texts])

    asked = spark.createDataFrame([(i, f"words {i}") for i in range(20)], "question_id int, text string")
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(50)], "id int, vector array<double>")
    embedded = retrieval.embed(asked, "text", counting, batch_size=3)
    assert retrieval.topk(vectors, embedded, 2).count() == 40
    calls = [f.read_text().split("\n") for f in log.iterdir()]
    assert sum(map(len, calls)) == 20 and max(map(len, calls)) <= 3


def test_words_of_every_script_count():
    matrix = retrieval.hashed_words(["Größe größe", "цена", "", "цена лекарства"])
    assert matrix.sum(axis=1).tolist() == [2.0, 1.0, 0.0, 2.0]
    assert matrix[1] @ matrix[3] >= 1.0


def test_fewer_vectors_than_k(spark):
    vectors = frame(spark, np.eye(3), "id")
    asked = frame(spark, np.array([[1.0, 1.0, 0.0]]), "question_id")
    got = retrieval.topk(vectors, asked, 5).orderBy("rank").collect()
    assert [(r.id, r.similarity) for r in got] == [(0, 0.707107), (1, 0.707107), (2, 0.0)]
    assert retrieval.topk(vectors, asked.limit(0), 5).count() == 0


def test_store_search_and_prompt(spark, tmp_path):
    rows = [
        (str(i), f"DRUG{i}", "TABLET" if i % 2 else None, 0.5 * i, f"DRUG{i} 5 MG", "EA")
        for i in range(1, 30)
    ] * 3
    typed = spark.createDataFrame(
        rows, "ndc string, drug_name string, drug_form string, nadac_per_unit double, ndc_description string, pricing_unit string"
    ).withColumns({c: F.lit(None).cast("string") for c in (
        "drug_strength", "effective_date", "classification_for_rate_setting", "otc", "pharmacy_type_indicator",
        "explanation_code", "explanation_code_description", "corresponding_generic_drug_nadac_per_unit")})
    path = str(tmp_path / "store")
    retrieval.build_store(documents.doc_metadata(typed), path)
    store = retrieval.load_store(spark, path)
    assert store.count() == 87 == store.select("doc_id").distinct().count()
    asked = retrieval.question_table(spark, ["drug7 drug7?", "drug9 {context}"])
    hits = retrieval.search(store, asked, 3)
    assert hits.select("question_id", "rank").distinct().count() == hits.count() == 6
    first = {r.question_id: r.drug_name for r in hits.where("rank = 1").collect()}
    assert first == {0: "DRUG7", 1: "DRUG9"}
    prompts = {r.question_id: r.prompt for r in retrieval.prompts(hits, asked).collect()}
    assert prompts[1].count("Drug Name: ") == 3 and "Question: drug9 {context}\n" in prompts[1]
    assert "Drug Name: DRUG9\nNDC Code: 9\nForm: TABLET\nPrice per Unit: $4.50\nPricing Unit: EA" in prompts[1]
    assert retrieval.within_price(hits, 0, 0).count() == 6
    assert retrieval.within_price(hits, 1.0, None).count() < 6
    assert [r.similarity_score for r in retrieval.sources(hits).collect()]


def test_prices_beyond_two_decimals_are_rows_of_their_own(spark, tmp_path):
    """The text shows two decimals, so these rows share it; each is one entry, with one rank."""
    rows = [("7", "SALVE", "", price, "", "s", "SALVE 2 MG", "GM", "the same text") for price in (0.02104, 0.02409, 0.02409)]
    columns = "ndc string, drug_name string, drug_form string, price double, effective_date string, source string, ndc_description string, pricing_unit string, text string"
    path = str(tmp_path / "store")
    retrieval.build_store(spark.createDataFrame(rows, columns), path)
    hits = retrieval.search(retrieval.load_store(spark, path), retrieval.question_table(spark, ["same"]), 5)
    assert sorted((r["rank"], r.price) for r in hits.collect()) == [(1, 0.02104), (2, 0.02409), (3, 0.02409)]


def test_searcher_equals_search(spark, tmp_path):
    """The resident searcher, the table search and brute force agree; many hits are joined."""
    rows = [(str(i), float(i % 7), f"word{i % 13} colour{i % 5} size{i}" if i % 9 else None) for i in range(200)]
    documents_ = spark.createDataFrame(rows, "ndc string, price double, text string")
    path = str(tmp_path / "store")
    retrieval.build_store(documents_, path)
    texts = ["word3 colour2", "size17 word4", "nothing alike"]
    searcher = retrieval.Searcher(spark, path)
    told = lambda df: sorted((r.question_id, r["rank"], r.ndc, r.doc_id, r.similarity) for r in df.collect())
    table = retrieval.search(retrieval.load_store(spark, path), retrieval.question_table(spark, texts), 4)
    assert told(searcher.ask(texts, 4)) == told(table) and len(told(table)) == 12
    assert len(told(searcher.ask(texts, 190))) == 570
    assert searcher.ask([], 4).count() == 0


def test_second_build_embeds_only_new_texts(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def counting(texts):
        (log / uuid.uuid4().hex).write_text("\n".join(texts))
        return retrieval.hashed_words(texts)

    def build(n):
        rows = [(str(i % 10), float(i), f"text {i % n}") for i in range(60)]
        df = spark.createDataFrame(rows, "ndc string, price double, text string")
        path = str(tmp_path / f"store{n}-{uuid.uuid4().hex}")
        retrieval.build_store(df, path, counting, cache=str(tmp_path / "cache"))
        called = [line for f in log.iterdir() for line in f.read_text().split("\n")]
        store = retrieval.load_store(spark, path)
        assert store.count() == 60 == store.select("doc_id").distinct().count()
        expected = {f"text {k}": retrieval.hashed_words([f"text {k}"])[0].tolist() for k in range(n)}
        assert all(list(r.vector) == expected[r.text] for r in store.collect())
        return sorted(called)

    first = sorted(f"text {k}" for k in range(12))
    assert build(12) == first
    assert build(12) == first
    assert build(15) == sorted(f"text {k}" for k in range(15))


def test_store_build_leaves_the_store_alone(spark, tmp_path, monkeypatch):
    """Without a cache of the caller's a vector is written with its document and nowhere aside."""
    made = []
    monkeypatch.setattr(retrieval, "shared_dir", lambda spark, *parts: made.append(parts[-1]) or str(tmp_path / uuid.uuid4().hex / parts[-1]))
    rows = [(str(i), float(i % 7), f"word{i % 13} size{i}") for i in range(200)]
    retrieval.build_store(spark.createDataFrame(rows, "ndc string, price double, text string"), str(tmp_path / "store"))
    assert made == ["hot_texts"]
    store = retrieval.load_store(spark, str(tmp_path / "store"))
    assert {tuple(r.vector) for r in store.where("ndc = '7'").collect()} == {tuple(retrieval.hashed_words(["word7 size7"])[0])}
    hits = retrieval.search(store, retrieval.question_table(spark, ["word3", "size9"]), 3)
    assert made[1:] == ["questions", "hits"] and hits.count() == 6


def test_hot_texts_are_shared_by_tasks(spark, tmp_path):
    """Texts of many rows, rows with copies, null and empty texts: the same entries however they are dealt."""
    rows = [(f"n{i % 3}" if i % 5 else None, float(i % 4), ("same", None, "", f"other {i}")[i % 4 if i % 7 else 0]) for i in range(300)]
    df = spark.createDataFrame(rows, "ndc string, price double, text string").repartition(5)
    told = []
    for hot in (10_000, 20):
        retrieval.build_store(df, str(tmp_path / f"{hot}"), hot=hot)
        store = retrieval.load_store(spark, str(tmp_path / f"{hot}"))
        told.append(sorted(str(r) for r in store.select("ndc", "price", "text", "doc_id", "vector").collect()))
        assert store.select("doc_id").distinct().count() == 300
        assert all(f.doc_id == sorted(f.doc_id) for f in store.groupBy("_metadata.file_path").agg(F.collect_list("doc_id").alias("doc_id")).collect())
    assert told[0] == told[1]


def test_criteria_text():
    assert retrieval.criteria_text() == "all drugs"
    assert retrieval.criteria_text("SALVE", max_price=3) == "Drug name: SALVE Price under $3"
    assert retrieval.criteria_text(max_price=0, min_price=2.5) == "Price over $2.5"


def test_route_line_needs_its_column(spark):
    columns = [
        "drug_name", "ndc", "drug_strength", "drug_form", "nadac_per_unit", "pricing_unit", "effective_date",
        "classification_for_rate_setting", "otc", "pharmacy_type_indicator", "explanation_code",
        "explanation_code_description", "corresponding_generic_drug_nadac_per_unit",
    ]
    values = ["A", "1", "5", "TABLET", "1.005", "EA", "2024-01-05", "B", "Y", "C", "1", "note", "$2"]
    df = spark.createDataFrame([tuple(values)], columns)
    lines = df.select(documents.drug_document(df)).first()[0].split("\n")
    # A generic price that is no number has no line.
    assert lines == [
        "Drug Name: A", "NDC Code: 1", "Strength: 5", "Form: TABLET", f"Price per Unit: ${1.005:.2f}", "Pricing Unit: EA",
        "Effective Date: 2024-01-05", "Classification: Brand Name", "Type: Over-the-counter",
        "Available at: Community pharmacy", "Explanation Code: 1", "Note: note",
    ]
    routed = df.withColumn("drug_route", F.lit("ORAL"))
    assert "Route of Administration: ORAL" in routed.select(documents.drug_document(routed)).first()[0]


def test_long_conversation(spark):
    """Context across block borders, with repeated deliveries, against plain Python."""
    turns = [(1, t, "user" if t % 2 == 0 else "assistant", f"text {t}") for t in range(300)]
    df = spark.createDataFrame(turns + turns[:100] * 5, "conv_id long, turn long, role string, text string")
    for history in (None, 8, 100):
        got = {r.turn: r.context for r in conversation_context(df, history).collect()}
        first = 0 if history is None else history
        expected = {
            t: "\n".join(f"{r}: {x}" for _, n, r, x in turns[max(0, t - first) if history else 0 : t])
            for t in range(300)
        }
        assert got == expected


def test_turn_numbers_with_gaps_and_ties(spark):
    numbers = [0, 10, 20, 500, 500, 90_000]
    turns = [(1, n, "user", f"text {k}") for k, n in enumerate(numbers)] + [(2, 7, "user", None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.text): (r.n_context_turns, r.context.split("\n")) for r in conversation_context(df).collect()}
    assert got[1, "text 5"] == (5, [f"user: text {k}" for k in range(5)])
    assert got[1, "text 3"] == got[1, "text 4"] == (3, [f"user: text {k}" for k in range(3)])
    assert got[2, None] == (0, [""])
    last = {r.text: r.context.split("\n") for r in conversation_context(df, history=2).collect()}
    assert last["text 5"] == ["user: text 2", "user: text 3", "user: text 4"]


def test_blocks_are_packed(tmp_path):
    """Vectors that are mostly zeros take little room, and come back as they were."""
    rows = np.zeros((4096, 256), dtype=np.float32)
    rows[np.arange(4096), np.arange(4096) % 256] = np.arange(4096)
    ids = pa.array([f"id{i}" for i in range(4096)])
    name = vector_blocks.write_block(tmp_path.as_uri(), ids, rows)
    assert (tmp_path / name).stat().st_size < rows.nbytes / 8
    block = vector_blocks.read_block(f"{tmp_path.as_uri()}/{name}")
    assert (block.rows == rows).all() and list(block.ids) == ids.to_pylist()


def test_exact_scores_in_parts(monkeypatch):
    """Pairs scored a few at a time give the scores of one go."""
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(60, 8))
    block = vector_blocks.Block(np.arange(60), rows, vector_blocks.lengths_of(rows))
    asked = vector_blocks.Questions(np.arange(60), vector_blocks.units(rows), np.full(60, -2.0))
    whole = vector_blocks.best(asked, block, 5, True)
    monkeypatch.setattr(vector_blocks, "EXACT_PAIRS", 7)
    for a, b in zip(whole, vector_blocks.best(asked, block, 5, True)):
        assert (a == b).all()
