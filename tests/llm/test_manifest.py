"""The Merkle manifest against a plain version: order, levels, proofs, repeated and odd rows."""

import hashlib
import zlib

from oracle import connect, difference
from pyspark.sql import functions as F

from ratesheet.llm import merkle_manifest
from ratesheet.llm.queries import ORACLE_SQL, QUERIES

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def digest(*parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row) -> str:
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([digest(*low[k : k + 3]) for k in range(0, len(low), 3)])
    return levels


def way(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    steps = []
    for low in levels[:-1]:
        start = at - at % 3
        steps.append(("".join(low[start:at]), "".join(low[at + 1 : start + 3])))
        at //= 3
    return steps


def plain(rows: list[tuple]) -> list[tuple]:
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[name] = tree([leaf(r) for r in groups[name]])
    top = tree([trees[name][-1][0] for name in names])
    out = []
    for k, name in enumerate(names):
        for at, row in enumerate(groups[name]):
            steps = way(trees[name], at) + way(top, k)
            told = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                told = (*row[:4], row[4].replace("\n", ""))
            fold = leaf(told)
            for left, right in steps:
                fold = digest(left, fold, right)
            proof = digest(*[left + right for left, right in steps])
            root = top[-1][0]
            out.append((row[0], leaf(row), trees[name][-1][0], root, proof, fold, fold == root))
    return sorted(out, key=repr)


def ours(df) -> list[tuple]:
    return sorted(map(tuple, merkle_manifest.audited(df).collect()), key=repr)


def test_equals_sql(spark, sf_dir):
    sql = connect(sf_dir).execute(ORACLE_SQL["op12_merkle_manifest"])
    assert difference(QUERIES["op12_merkle_manifest"](spark, sf_dir), sql) is None


def test_edge_rows_against_plain(edge, clashing):
    rows = [tuple(r) for r in edge.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    expected = plain(rows)
    assert ours(edge) == expected
    assert ours(clashing) == expected


def test_empty_table(empty):
    assert ours(empty) == []
    assert merkle_manifest.manifest(empty).count() == 0


def test_ids_of_any_size_and_names_in_byte_order(spark):
    ids = [0, 1, 511, 512, 513, -1, -512, -513, 2**62, -(2**63), 2**63 - 1, 2**31, None]
    names = ["b", "a", "", "-", ":", "é", "z", "\U0001f600", "￮", None]
    rows = [(i, s, "en", k, f"{s}\n{i}") for k, i in enumerate(ids) for s in names]
    assert ours(spark.createDataFrame(rows, SCHEMA).repartition(5)) == plain(rows)


def test_levels_of_small_trees(spark):
    """Sources of one leaf, of full and of broken runs; then fewer sources, down to one."""
    sizes = [1, 2, 3, 4, 9, 10, 28]
    rows = [(k * 7, f"s{n:02d}", None, 1, "a\nb") for n in sizes for k in range(n)]
    assert ours(spark.createDataFrame(rows, SCHEMA)) == plain(rows)
    for some in ([(5, "s", None, 1, "a\nb")], rows[:3]):
        assert ours(spark.createDataFrame(some, SCHEMA)) == plain(some)


def test_hot_ids_and_copies(spark):
    """A third of the rows share an id, some of them all their fields."""
    rows = [(k, "hot", "en", 1, f"t{k}") for k in range(60)]
    rows += [(7, "hot", "en", 1, f"other {k % 11}\n") for k in range(40)]
    rows += [(None, "hot", None, None, f"none {k % 3}") for k in range(20)]
    assert ours(spark.createDataFrame(rows, SCHEMA).repartition(7)) == plain(rows)


def test_many_slot_arrays(spark, monkeypatch):
    """With runs of nine, 700 leaves take four rounds; the result is the same."""
    rows = [(k * k - 900, "s" if k % 3 else "t", "en", k, f"text\n{k}") for k in range(700)]
    monkeypatch.setattr(merkle_manifest, "RUN_LEVELS", 2)
    monkeypatch.setattr(merkle_manifest, "RUN", 9)
    assert ours(spark.createDataFrame(rows, SCHEMA).repartition(4)) == plain(rows)


def test_manifest_gives_slots_and_proofs(spark):
    rows = [(k, "ab"[k % 2], "en", k, f"text {k}") for k in range(40)]
    found = merkle_manifest.manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.source, r.slot, r.doc_id) for r in found) == sorted(("ab"[k % 2], k // 2, k) for k in range(40))
    for r in found:
        node = r.leaf
        for left, right in r.proof:
            node = digest(left, node, right)
        assert node == r.root


def test_no_python_in_the_plan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    blocks = merkle_manifest.bitmaps(docs)
    assert "text" not in str(blocks.inputFiles()) and blocks.select(F.sum("ones")).first()[0] == docs.count()
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan and "Python" not in plan
