"""Tokens, packing, rollups and the pipeline."""

import itertools
import zlib

import numpy as np
import plain
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ratesheet.llm import license_scan, packing, quality_rules, token_counts
from ratesheet.llm.tokens import Encoder, vocabulary

ODD = [
    "", " ", "a", " a", "a ", "  a  b ", "a\n b", "a \nb", "tab\t x", "it's we'll  O'x", "x" * 300, "é ñ 日本 語",
    "<|endoftext|> end", "1234 5!? #", "\r\n\r\n x", "a b c", "smörgås " * 40, "\x1c y \x85 z",
]


def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def test_ids_are_those_of_the_tokenizer(docs, monkeypatch):
    monkeypatch.setattr("ratesheet.llm.tokens.CHUNK_CACHE", 500)
    ours, theirs = Encoder(vocabulary()), tokenizer()
    for text in [*ODD, *[r.text for r in docs.select("text").collect()]]:
        want = theirs.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ours.ids(text), dtype="<u4").tolist() == want
    assert ours.ids(None) == b""


def checked(packed, docs, capacity):
    """Pieces rebuild every document's ids and fill sequences without gaps; the sequences used."""
    theirs = tokenizer()
    rows = sorted(packed.collect(), key=lambda r: (str(r.doc_id), r.piece))
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert {r.doc_id for r in rows} == set(texts)
    ids = {i: [*theirs.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts.items()}
    at: dict = {}
    for r in rows:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4").tobytes()
        assert zlib.crc32(part) == r.ids_crc32 and 0 < r.length <= capacity
        assert r.piece == 0 or r.length == capacity
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in at.values():
        places.sort()
        assert [a for a, _ in places] == np.cumsum([0, *[n for _, n in places[:-1]]]).tolist()
        assert sum(n for _, n in places) <= capacity
    return len(at), sum(r.length for r in rows)


def test_packing_round_trip(docs, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 40)
    used, ids = checked(packing.pack_documents(docs), docs, 1024)
    assert used <= 1.02 * ids / 1024 + 2


def test_packing_edge_cases(edge, empty, clashing):
    known = clashing.where("doc_id is not null").dropDuplicates(["doc_id"])
    checked(packing.pack_documents(known, capacity=64), known, 64)
    packed = packing.pack_documents(edge)
    assert packed.where("piece = 0").count() == edge.count()
    assert packing.pack_documents(empty).count() == 0


def test_plans_use_up_any_histogram():
    rng = np.random.default_rng(6)
    shapes = [
        rng.integers(1, 129, 3_000), np.full(1_000, 3), np.array([128]), np.array([], dtype=int),
        np.repeat([64, 43, 42, 1], [7, 5, 5, 900]), np.clip(rng.lognormal(3.5, 0.8, 5_000).astype(int), 1, 128),
    ]
    for lengths in shapes:
        counts = np.bincount(lengths, minlength=129)
        plan = packing.plan(counts, 128)
        done = np.zeros_like(counts)
        for parts, repeats in plan:
            assert sum(a * b for a, b in parts) <= 128 and repeats > 0
            for length, many in parts:
                done[length] += many * repeats
        assert (done == counts).all()
        fewest = max(-(-lengths.sum() // 128), (lengths > 64).sum())
        assert sum(r for _, r in plan) <= 1.03 * fewest + 2


def test_fit_is_exact_where_patterns_fit():
    counts = np.zeros(101, dtype=np.int64)
    counts[[60, 40, 50, 30, 20]] = 10, 10, 6, 4, 4
    repeats = packing.fit_repeats(counts, 100)
    used = np.zeros(101)
    for pattern, x in repeats:
        assert sum(pattern) == 100 and x > 0
        for v in pattern:
            used[v] += x
    assert np.abs(used - counts)[1:].max() < 0.01


def test_rollup_follows_the_documents(spark, docs, tmp_path):
    """Totals after inserts, revisions and deletes, some repeated, are those of what is left."""
    table, theirs = str(tmp_path / "rollup"), tokenizer()
    named = docs.withColumn("text", F.when(F.col("doc_id") % 9 > 0, F.col("text")))
    states = token_counts.counted(named, "v1").persist()
    some = states.where("doc_id % 4 = 0")
    shorter = named.where("doc_id % 4 = 0").withColumns({"text": F.substring("text", 1, 50), "source": F.lit(None).cast("string")})
    revised = token_counts.counted(shorter, "v1")
    gone = states.where("doc_id % 4 = 1")
    for name, deltas in (
        ("1", token_counts.inserts(states)), ("2", token_counts.revisions(some, revised)),
        ("3", token_counts.deletes(gone)), ("2", token_counts.revisions(some, revised)),
    ):
        token_counts.commit(deltas, table, name)
    want: dict = {}
    left = named.where("doc_id % 4 > 1").unionByName(shorter)
    for r in left.collect():
        total = want.setdefault((r.source, r.lang, "v1"), [0, 0, 0])
        text = r.text or ""
        for k, n in enumerate((1, len(theirs.encode(text, add_special_tokens=False).ids), len(text))):
            total[k] += n
    got = {(r.source, r.lang, r.version): [r.n_docs, r.n_tokens, r.n_chars] for r in token_counts.totals(spark, table).collect()}
    assert got == want


def test_a_batch_counts_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    """Totals between the two halves of a commit, and of a fold, with folded batches sent again."""
    table = str(tmp_path / "rollup")
    rows = lambda n: spark.createDataFrame([("s", "en", "v", 1, n, 3 * n)], token_counts.TABLE)
    total = lambda: [r.n_tokens for r in token_counts.totals(spark, table).collect()]
    assert total() == []
    for k in range(4):
        token_counts.commit(rows(10**k), table, f"b{k}")
    assert total() == [1111]
    seen = []
    publish = token_counts.storage.publish

    def watched(spark_, made, target):
        seen.append(total())
        publish(spark_, made, target)
        seen.append(total())

    monkeypatch.setattr(token_counts.storage, "publish", watched)
    token_counts.commit(rows(5000), table, "b3")  # a repeated batch, counted anew
    assert seen == [[1111], [5111]]
    seen.clear()
    with monkeypatch.context() as patch:  # ends before the old folders are removed
        patch.setattr(token_counts.storage, "remove", lambda *_: 0)
        first = token_counts.fold(spark, table, ["b0", "b1", "missing"])
    assert seen == [[5111], [5111]] and total() == [5111]
    token_counts.commit(rows(1), table, "b0")
    assert total() == [5111]
    assert token_counts.fold(spark, table, [first, "b2"]) and total() == [5111]
    token_counts.commit(rows(10), table, "b1")
    assert total() == [5111] and token_counts.fold(spark, table, ["b0", "b1", "b2"]) is None


def test_rollup_edge_cases(spark, edge, empty, clashing, tmp_path):
    for name, frame in (("edge", edge), ("empty", empty), ("clashing", clashing)):
        token_counts.commit(token_counts.inserts(token_counts.counted(frame, "v1")), str(tmp_path / name), "a-1")
    totals = token_counts.totals(spark, str(tmp_path / "edge")).agg(F.sum("n_docs")).first()[0]
    assert totals == edge.count()
    assert token_counts.totals(spark, str(tmp_path / "empty")).count() == 0


def test_pipeline_stage_by_stage(spark, docs, sf_dir):
    """Every stage hands on the columns of documents and does what its operator says."""
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "minhash_near_dedup", "decontamination", "packing",
    ]
    now, sizes = docs, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.written(stage(spark, now, sf_dir), "stage")
        assert now.columns == docs.columns
        sizes.append(now.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.4 * sizes[0]
    failed = quality_rules.judged(now.join(docs.select("doc_id", F.col("text").alias("t")), "doc_id").withColumn("text", F.col("t")), None)
    assert failed.where("base_failed").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, now, sf_dir)
    checked(last, now, 1024)
    run = corpus_pipeline.run(spark, sf_dir)
    assert run.exceptAll(last).count() == 0 and run.count() == last.count()


def near_classes(texts: dict[int, str]) -> dict[int, int]:
    """Smallest id reachable over a Jaccard similarity of 0.8 or more on five-word shingles."""
    sets = {}
    for k, text in texts.items():
        words = plain.spark_words(license_scan.lower_ascii(text))
        width = min(5, len(words))
        sets[k] = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()
    links = [
        (a, b)
        for a, b in itertools.combinations(sorted(k for k in sets if sets[k]), 2)
        if 100 * (met := len(sets[a] & sets[b])) >= 80 * (len(sets[a]) + len(sets[b]) - met)
    ]
    return plain.components(sorted(sets), links)


def test_pipeline_stages_against_plain(spark, docs, sf_dir):
    """Each stage on its own input, against plain statements of what it decides."""
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in now.collect()}
        now = corpus_pipeline.written(stage(spark, now, sf_dir), "stage")
        after = {r.doc_id: r for r in now.collect()}
        assert set(after) <= set(before)
        assert all(r.n_chars == len(r.text) for r in after.values() if r.text is not None)
        if name != "line_dedup":
            assert all(tuple(r) == tuple(before[k]) for k, r in after.items())
        if name == "quality_rules":
            for r in after.values():
                counts = plain.quality_counts(r.text)
                assert counts["n_words"] >= 50 and counts["n_repeat_words"] * 2 <= counts["n_words"]
        elif name == "line_dedup":
            lines = [n for r in after.values() for x in r.text.split("\n") if (n := plain.normal_line(x))]
            assert len(lines) == len(set(lines))
            first = {}
            for k in sorted(before):
                for x in before[k].text.split("\n"):
                    first.setdefault(plain.normal_line(x), k)
            for k, r in after.items():
                old = iter(before[k].text.split("\n"))
                assert all(x in old for x in r.text.split("\n"))  # in their order
                assert all(first[n] == k for x in r.text.split("\n") if (n := plain.normal_line(x)))
        elif name == "minhash_near_dedup":
            classes = near_classes({k: r.text or "" for k, r in before.items()})
            assert set(after) == {k for k in before if classes[k] == k}
        else:
            found = {d for d, *_ in plain.containment([(k, r.text) for k, r in before.items()], items)}
            assert set(after) == set(before) - found


def test_pipeline_of_an_empty_table(spark, empty, sf_dir):
    now = empty
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf_dir)
    assert now.count() == 0
