"""Line dedup, MinHash near-duplicates, components: against plain versions."""

import os
import random
from collections import Counter
from pathlib import Path

import duckdb
import plain
from oracle import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
from ratesheet.llm import expected, graph, line_dedup, minhash_dedup, queries
from ratesheet.llm.common import dropped, with_maybe, written


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (3, 2)]
    edges += [tuple(rng.sample(range(200, 300), 2)) for _ in range(60)]
    want = plain.components({n for e in edges if e[0] != e[1] for n in e}, edges)
    got = graph.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r.node: r.component for r in got.collect()} == want
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_linking_buckets_misses_no_link(spark):
    """Links that leaders don't see: nodes are linked if they differ by one or two."""
    rng = random.Random(2)
    nodes = rng.sample(range(1, 400), 150)
    members = [(key, n, 0, 10, 5, n % 3) for n in nodes for key in (n // 50, 1_000 + (n + 25) // 50)]
    frame = spark.createDataFrame(members, "key bigint, node bigint, low bigint, high bigint, size bigint, apart bigint")
    got = graph.linked_components(frame, lambda pairs: pairs.where("b - a <= 2"))
    links = [(a, b) for a in nodes for b in nodes if 0 < b - a <= 2 and (a // 50 == b // 50 or (a + 25) // 50 == (b + 25) // 50)]
    want = plain.components(nodes, links)
    assert {r.node: r.component for r in got.collect()} == {
        n: c for n, c in want.items() if Counter(want.values())[c] > 1
    }


def test_bitmap_passes_all_keys(spark):
    df = spark.range(20_000).withColumn("v", F.when(F.col("id") % 7 > 0, F.col("id")))
    keys = spark.range(0, 20_000, 10).withColumnRenamed("id", "k")
    flagged = with_maybe(df, "v", keys)
    assert flagged.count() == 20_000
    assert flagged.where("v % 10 = 0 and not _maybe").count() == 0
    assert flagged.where("v is null and _maybe").count() == 0
    assert flagged.where("v % 10 <> 0 and _maybe").count() < 200


def test_near_duplicates_match_sql(spark, sf_dir):
    ours = queries.QUERIES["op9_minhash_dedup"](spark, sf_dir)
    assert difference(ours, connect(sf_dir).execute(expected.NEAR_DUPLICATES)) is None


def _family(copies: int, edits: int):
    """A family of near copies, each with so many words changed; and a plain text."""
    rng = random.Random(edits)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    rows = []
    for k in range(copies):
        words = list(base)
        for at in rng.sample(range(120), k % (edits + 1)):
            words[at] = f"x{k}y{at}"
        rows.append((k, " ".join(words)))
    return [*rows, (copies, "nothing like the others at all in here")]


def test_large_family_of_copies(spark, tmp_path):
    rows = _family(150, 6)
    ours = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert difference(ours, con.execute(expected.NEAR_DUPLICATES)) is None
    assert ours.where("not kept").count() > 20


def test_pipeline_stage_links_from_eighty_percent(spark, sf_dir):
    """Pairs between 0.80 and 0.85 lose their second document, pairs below 0.80 keep both."""
    rng = random.Random(9)
    rows, gone = [], set()
    for k in range(40):
        words = [f"w{rng.randrange(1 << 30)}" for _ in range(104)]
        changed = list(words)
        for j in range(k % 4):  # each takes five of 100 shingles: 100, 90.5, 81.8 and 73.9 percent
            changed[20 + 30 * j] = f"x{k}y{j}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(changed))]
        if k % 4 < 3:
            gone.add(2 * k + 1)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()}
    assert kept == {i for i, _ in rows} - gone


def test_near_duplicates_of_edge_cases(edge, empty, clashing):
    got = minhash_dedup.near_duplicates(edge)
    rows = {(r.doc_id, r.n_shingles): r for r in got.collect()}
    assert got.count() == edge.count()
    assert rows[1, 0].kept and rows[2, 0].component_id == 2 and rows[3, 0].n_shingles == 0
    assert [rows[i, rows_n].component_id for i, rows_n in sorted(k for k in rows if k[0] in (4, 5, 10))] == [4, 4, 4]
    assert all(r.kept and r.component_id is None for k, r in rows.items() if k[0] is None)
    assert minhash_dedup.near_duplicates(empty).count() == 0
    kept = minhash_dedup.keep_first(clashing)
    assert kept.columns == clashing.columns
    assert {5, 10}.isdisjoint({r.doc_id for r in kept.collect()})


def test_line_dedup_against_plain(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = plain.line_dedup(rows)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text_md5) for r in line_dedup.summary(docs).collect()}
    assert got == want


def test_fuzzy_lines_against_plain(spark):
    """Lines with a few letters changed, families of them, and lines that only share words."""
    rng = random.Random(11)
    rows = []
    for k in range(60):
        base = [f"word{rng.randrange(500)}" for _ in range(60)] if k % 6 == 0 else base  # noqa: F821
        words = list(base)
        if k % 6 > 1:
            words[rng.randrange(60)] += "s"
        if k % 6 == 5:
            rng.shuffle(words)
        rows.append((k, f"Head {k}\n{' '.join(words)}.\n- - -"))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text_md5) for r in line_dedup.summary(frame).collect()}
    assert got == plain.line_dedup(rows)
    assert sum(v[1] for v in got.values()) > 5


def _edited(rng, text, edits):
    """The text with so many letters changed, added or taken out."""
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        out[at : at + rng.randrange(2)] = rng.choice(["", "q", "zq"])
    return "".join(out)


def test_edit_similarity_alone_links_lines(spark):
    """Against edit distances of each line and its changed copy (other lines are random), no bit bound."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghijklmnoprstuvw", k=rng.randrange(2, 9)))
    rows, sizes = [], {}
    for n in (4, 6, 10, 20, 30, 60):
        for _ in range(40):
            words = [word() for _ in range(n)]
            changed = list(words)
            for at in rng.sample(range(n), max(1, n // 10)):
                changed[at] = _edited(rng, changed[at], 1)
            for w in (words, changed):
                sizes[len(rows)] = n
                rows.append((len(rows), " ".join(w)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    norms = [plain.normal_line(t) for _, t in rows]
    links = []
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            longer = max(len(norms[i]), len(norms[j]))
            if j == i + 1 or sizes[i] == sizes[j] == 4:
                if plain.edit_distance(norms[i], norms[j]) * 5 <= longer:
                    links.append((i, j))
    want = {i for i, c in plain.components(range(len(rows)), links).items() if c != i}
    got = {r.doc_id for r in line_dedup.summary(frame, bits=None).where("n_removed > 0").collect()}
    assert got <= want
    for n in set(sizes.values()):
        due = {i for i in want if sizes[i] == n}
        assert len(due) > 30 and len(got & due) >= (0.85 if n == 4 else 0.95) * len(due), (n, len(due), len(got & due))


def test_line_dedup_of_edge_cases(edge, empty, clashing):
    rows = [(r.doc_id, r.n_lines, r.n_removed) for r in line_dedup.summary(edge).collect()]
    assert len(rows) == edge.count()
    by_id = {i: (n, gone) for i, n, gone in rows if i is not None}
    assert by_id[1] == (0, 0) and by_id[2] == (1, 0) and by_id[3] == (3, 0)
    assert by_id[5][1] == by_id[5][0] == 12
    assert all(gone == 0 for i, _, gone in rows if i is None)
    assert line_dedup.summary(empty).count() == 0
    out = line_dedup.without_repeats(clashing)
    assert out.columns == clashing.columns and out.schema == clashing.schema
    kept = {r.doc_id for r in line_dedup.keep_first(clashing).collect()}
    assert {1, 2, 3, 4, 8} <= kept and {5, 10}.isdisjoint(kept)


def test_line_dedup_runs_in_the_jvm_only(docs):
    plan = line_dedup.summary(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def _shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {str(f) for d in folders for f in Path(d).rglob("shuffle_*.data")}


def test_written_tables_leave_no_shuffle_files_and_only_they_are_dropped(spark, tmp_path):
    before = _shuffle_files(spark)
    table = written(spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert _shuffle_files(spark) <= before
    assert table.count() == 7
    spark.range(5).write.parquet(str(tmp_path / "given"))
    given = spark.read.parquet(str(tmp_path / "given"))
    files = [f.removeprefix("file://") for f in table.inputFiles()]
    dropped(given, table)
    assert given.count() == 5
    assert not any(os.path.exists(f) for f in files)


def test_line_dedup_keeps_no_table_that_is_done_with(spark, monkeypatch):
    """The key lists and what finding links took are gone once the groups are written."""
    rng = random.Random(3)
    rows = [(k, f"{' '.join(f'w{rng.randrange(900)}' for _ in range(20))} number{k}") for k in range(30)]
    rows += [(100 + k, text + "s") for k, text in rows]
    files = {}

    def noted(df, name):
        table = written(df, name)
        files.setdefault(name, []).extend(f.removeprefix("file://") for f in table.inputFiles())
        return table

    for module in (line_dedup, graph):
        monkeypatch.setattr(module, "written", noted)
    groups = line_dedup.line_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), bits=None)
    assert {n for n, found in files.items() if any(map(os.path.exists, found))} == {"line_groups"}
    assert groups.where("kept").count() == 30 and groups.count() == 60


def test_parts_of_the_pairs_find_the_same_links(spark, monkeypatch):
    """However many parts the pairs between components are made in: the components of all links."""
    draw = random.Random(5)
    # Nodes of one key are linked if their numbers share the last digit; most keys hold several such groups.
    nodes = [(k, node) for node in range(1, 400) for k in {draw.randrange(40), draw.randrange(40), 41}]
    rows = [(k, node, 1, 1, 1, 0) for k, node in nodes]
    members = spark.createDataFrame(rows, "key long, node long, low long, high long, size long, apart int")
    linked = lambda pairs: pairs.where("a % 10 = b % 10")
    names, told = [], []
    kept = graph.written
    monkeypatch.setattr(graph, "written", lambda df, name: names.append(name) or kept(df, name))
    for at_once in (graph.PAIRS_AT_ONCE, 1):
        names.clear()
        monkeypatch.setattr(graph, "PAIRS_AT_ONCE", at_once)
        told.append((sorted(map(tuple, graph.linked_components(members, linked).collect())), names.count("links")))
    want = sorted((node, (node - 1) % 10 + 1) for node in range(1, 400))
    assert told[0][0] == told[1][0] == want
    assert told[0][1] == 2 and told[1][1] > 3


def test_pieces_bound_the_distance(spark):
    """Pieces never come below the edit distance, know most links of long lines, and decide none wrongly."""
    draw = random.Random(8)
    rows = []
    for k in range(60):
        line = "".join(draw.choice("abcdefgh äö日") for _ in range(draw.randrange(130, 700)))
        other = "".join(c if draw.random() > k % 12 / 40 else draw.choice(["", "x", c + "y"]) for c in line)
        rows += [(line, other), (line, line[::-1]), (line[:80], other[:80])]
    df = spark.createDataFrame(rows, "a string, b string")
    a, b = F.col("a"), F.col("b")
    longer = F.greatest(F.length(a), F.length(b))
    most = F.floor(longer * (100 - line_dedup.PERCENT) / 100)
    got = df.select(
        line_dedup._at_most(a, b).alias("bound"), F.levenshtein(a, b).alias("d"), most.alias("most"),
        line_dedup._similar(a, b).alias("similar"),
    ).collect()
    assert all(r.bound >= r.d and r.similar == (r.d <= r.most) for r in got)
    links = [r for r in got if r.d <= r.most and r.most > 24]
    assert sum(r.bound <= r.most for r in links) > 0.8 * len(links) > 0
