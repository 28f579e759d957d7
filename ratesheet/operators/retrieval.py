"""Vector search: embedding hook, exact top-k, clustered index, resident searcher, prompts.

Similarities are rounded to six places before ranking and ties go to the smaller id, so a
result does not depend on summation order. No operator here emits question x vector pairs, and
no question set passes the driver: tasks walk through files of questions or vectors
(``vector_blocks``) and pass on at most ``k`` rows per question.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ratesheet import fixed_values as fv
from ratesheet.functions.vectors import dot, normalise
from ratesheet.operators import vector_blocks as vb
from ratesheet.session import shared_dir
from ratesheet.sources import storage

#: Bytes of vectors, and of questions, that a task holds at a time.
BLOCK_BYTES = 64 << 20
#: Bytes of the questions that a task takes through an index: it holds some ten arrays of this size.
ASKED_BYTES = 16 << 20
#: Vectors of a matrix block of a store or an index.
BLOCK_ROWS = 16384
DEFAULT_DIM = 256
BOUND_SLACK = 1e-5
#: Texts an embedder gets at once, unless the caller says otherwise.
EMBED_BATCH = 256
#: Rows with one text from which on several tasks share them.
HOT_ROWS = 10_000
#: Groups that the hits of one question are merged in before the final merge.
MERGE_WAYS = 32
#: Largest table of centres, in bytes: every task holds it.
MAX_CENTRE_BYTES = 64 << 20
#: Hits whose documents are looked up by their ids on the scan; more are joined.
LOOKUP_IDS = 500

# The task functions below travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Embedder = Callable[[list[str]], np.ndarray]


# --- embedding hook --------------------------------------------------------------------


def hashed_words(texts: list[str], dim: int = DEFAULT_DIM) -> np.ndarray:
    """Offline default embedder: word counts by hash bucket, words of any script. Scoring
    normalises. All words of the batch are counted together."""
    words = pd.Series(texts, dtype=object).str.lower().str.findall(r"[^\W_]+").explode().dropna()
    numbers, known = pd.factorize(words)
    buckets = [int(hashlib.md5(w.encode()).hexdigest()[:4], 16) % dim for w in known]
    cells = words.index.to_numpy() * dim + np.array(buckets, dtype=np.int64)[numbers]
    return np.bincount(cells, minlength=len(texts) * dim).reshape(len(texts), dim).astype(float)


def embed(
    df: DataFrame,
    text_col: str = "text",
    embedder: Embedder = hashed_words,
    batch_size: int = EMBED_BATCH,
) -> DataFrame:
    """Add a ``vector`` column. ``embedder`` maps a list of texts to a matrix; a hosted or
    local model plugs in here and gets at most ``batch_size`` texts a call."""
    schema = T.StructType(
        df.schema.fields + [T.StructField("vector", T.ArrayType(T.FloatType()), True)]
    )

    def add_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, batch_size):
                part = batch.slice(low, batch_size)
                texts = ["" if t is None else t for t in part.column(text_col).to_pylist()]
                matrix = np.ascontiguousarray(embedder(texts), dtype=np.float32)
                offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
                vectors = pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, vectors], [*part.schema.names, "vector"]
                )

    return df.mapInArrow(add_vectors, schema)


def _whole(dim: int) -> Column:
    sound = F.col("vector").isNotNull() & (F.size("vector") == dim)
    return F.coalesce(sound & ~F.exists("vector", lambda x: x.isNull()), F.lit(False))


def sound_vectors(vectors: DataFrame, dim: int) -> DataFrame:
    """Rows whose vector is there, ``dim`` long and without nulls."""
    return vectors.where(_whole(dim))


def unsound_vectors(vectors: DataFrame, dim: int) -> DataFrame:
    """The other rows, for quarantine."""
    return vectors.where(~_whole(dim))


# --- merging ---------------------------------------------------------------------------


def _hit_schema(question_id: T.DataType, vector_id: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("question_id", question_id),
            T.StructField("id", vector_id),
            T.StructField("similarity", T.DoubleType()),
        ]
    )


def _keep_best(hits: DataFrame, k: int) -> DataFrame:
    """Final ``k`` per question, merged in two levels: a question's hits come from every task
    that met it, and no group holds more than ``k`` rows of each task it merges."""

    def best(df: DataFrame, *groups: str) -> DataFrame:
        order = Window.partitionBy(*groups).orderBy(F.desc("similarity"), "id")
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    dealt = hits.withColumn("_way", F.spark_partition_id() % MERGE_WAYS)
    return best(best(dealt, "question_id", "_way").drop("rank", "_way"), "question_id")


# --- exact search ----------------------------------------------------------------------


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that it is evaluated once."""
    path = shared_dir(df.sparkSession, name)
    with storage.freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _asked(questions: DataFrame, *more: str) -> tuple[str, int]:
    """Folder of the questions in the shared folder, and how long their vectors are.

    They are evaluated once, into files of even size, and measured on the way.
    """
    measured = Observation("questions")
    path = shared_dir(questions.sparkSession, "questions")
    rows = questions.select("question_id", "vector", *more).hint("rebalance")
    rows.observe(measured, F.max(F.size("vector")).alias("dim")).write.parquet(path)
    return path, measured.get["dim"] or 0


def topk(
    vectors: DataFrame,
    questions: DataFrame,
    k: int = 5,
    skip_self: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Exact ``k`` nearest ``vectors(id, vector)`` of each ``questions(question_id, vector)``.

    The vectors are scanned once, unshuffled, whatever the number of questions: a task holds at
    most about ``block_bytes`` of them and walks through the question files, as much at a time,
    keeping ``k`` hits a question. Vectors that are null, of another length or hold nulls are no
    candidates; see ``unsound_vectors`` for them. Questions like that get no hits.
    """
    spark = vectors.sparkSession
    schema = _hit_schema(questions.schema["question_id"].dataType, vectors.schema["id"].dataType)
    path, dim = _asked(questions)
    if not dim:
        return _keep_best(spark.createDataFrame([], schema), k)
    files, hit_schema = storage.data_files(spark, path), to_arrow_schema(schema)
    at_once = max(1, block_bytes // (8 * dim))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, held = [], [], 0
        for batch in chain(batches, [None]):
            if batch is not None and batch.num_rows:
                ids.append(batch.column("id").to_numpy(zero_copy_only=False))
                rows.append(vb.matrix_of(batch.column("vector"), dim)[0])
                held += rows[-1].nbytes
            if held and (batch is None or held >= block_bytes):
                matrix = np.concatenate(rows)
                block = vb.Block(np.concatenate(ids), matrix, vb.lengths_of(matrix))
                ids, rows, held = [], [], 0
                for asked in vb.question_blocks(files, dim, at_once):
                    heaps = vb.Heaps(asked, k)
                    heaps.add(block, skip_self)
                    if (hits := heaps.hits(hit_schema)) is not None:
                        yield hits

    sound = sound_vectors(vectors.select("id", "vector"), dim)
    return _keep_best(sound.mapInArrow(walk, schema), k)


# --- matrix blocks ---------------------------------------------------------------------


def _write_blocks(rows: DataFrame, folder: str, block_rows: int) -> None:
    """Lays out ``rows(id, vector, cell, angle)``, in their order, as matrix blocks below ``folder``.

    A block ends where the cell changes, or when it is full. The manifest, one file a task, is what
    makes the blocks part of the table: a task that is lost and repeated leaves blocks that no
    manifest names.
    """
    base = storage.qualified(rows.sparkSession, f"{folder}/blocks")

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            angles = table.column("angle").to_numpy()
            ids = table.column("id").combine_chunks()
            lists = table.column("vector").combine_chunks()
            matrix = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
            row = {
                "path": vb.write_block(base, ids, matrix), "cell": table.column("cell")[0].as_py(),
                "n": len(ids), "low": float(angles.min()), "high": float(angles.max()),
            }
            held.clear()
            return pa.RecordBatch.from_pylist([row], schema=manifest)

        for batch in batches:
            cells = batch.column("cell").to_numpy()
            cuts = [0, *(np.flatnonzero(cells[1:] != cells[:-1]) + 1), len(cells)]
            for low, high in zip(cuts, cuts[1:]):
                while low < high:
                    room = block_rows - sum(map(len, held))
                    if held and (room <= 0 or held[0].column("cell")[0].as_py() != cells[low]):
                        yield flush()
                        room = block_rows
                    part = batch.slice(low, min(room, high - low))
                    held.append(part)
                    low += len(part)
        if held:
            yield flush()

    manifest = to_arrow_schema(T._parse_datatype_string(vb.MANIFEST))
    laid = rows.select("id", "vector", "cell", "angle").mapInArrow(lay, vb.MANIFEST)
    laid.write.mode("overwrite").parquet(f"{folder}/manifest")


# --- clustered index -------------------------------------------------------------------


def unit_vectors(df: DataFrame) -> DataFrame:
    return df.withColumn("vector", normalise(F.col("vector")))


def _angle(cosine: Column) -> Column:
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))


def build_index(
    vectors: DataFrame,
    path: str,
    n_lists: int = 100,
    seed: int = 1,
    train_share: float = 1.0,
    block_rows: int = BLOCK_ROWS // 16,
) -> None:
    """Write ``vectors(id, vector)`` as lists around k-means centres, with a centre table.

    The centres are fitted on all vectors, or on the share of them that the caller names, chosen
    by the hash of the id. A list is ordered by the angle to its centre and cut into sub-lists of
    ``block_rows`` vectors, each a matrix block with its smallest and widest angle; together with
    a question's own angle these bound how similar any vector in it can be. Ranges of (list,
    angle, id) deal out the rows, so a list, or an angle, with a large share of all vectors is
    laid out by several tasks. Unsound vectors are left out. Centres must fit ``MAX_CENTRE_BYTES``.
    """
    spark = vectors.sparkSession
    dim = vectors.agg(F.max(F.size("vector"))).first()[0] or 0
    if n_lists * dim * 8 > MAX_CENTRE_BYTES:
        raise ValueError(f"{n_lists} lists of {dim} numbers exceed {MAX_CENTRE_BYTES} bytes")
    unit = unit_vectors(sound_vectors(vectors, dim)).withColumn("features", array_to_vector("vector"))
    hashed = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1_000_000))
    training = unit.where(hashed < train_share * 1_000_000).select("features").persist()
    model = KMeans(k=n_lists, seed=seed, maxIter=10, featuresCol="features").fit(training)
    training.unpersist()
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    centre_table = unit_vectors(
        spark.createDataFrame(centres, "cell int, vector array<double>")
    ).withColumnRenamed("vector", "centre")
    centre_table.coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")
    vectors.select("id").limit(0).write.mode("overwrite").parquet(f"{path}/ids")  # their type
    angle = _angle(dot(F.col("vector"), F.col("centre")))
    listed = (
        model.transform(unit)
        .select("id", "vector", F.col("prediction").alias("cell"))
        .join(F.broadcast(centre_table), "cell")
        .select("id", "vector", "cell", angle.alias("angle"))
    )
    # Kept, so that the sample for the ranges does not assign all vectors a second time.
    placed = _kept(listed, "listed").repartitionByRange("cell", "angle", "id")
    _write_blocks(placed.sortWithinPartitions("cell", "angle", "id"), path, block_rows)


def search_index(
    spark: SparkSession,
    path: str,
    questions: DataFrame,
    k: int = 5,
    n_probe: int | None = None,
    skip_self: bool = False,
) -> DataFrame:
    """Top-k from a stored index.

    With ``n_probe`` only the nearest lists are read: fast and approximate. Without it the
    result is exact: the nearest list of each question gives a first k-th similarity, and then
    every sub-list whose bound still reaches that similarity is read as well. Tasks hold some
    blocks each and walk through the question files; neither side is copied for the other.
    """
    if n_probe is not None:
        return _keep_best(_visit(spark, path, questions, k, skip_self, 0, n_probe), k)
    first = _kept(_keep_best(_visit(spark, path, questions, k, skip_self, 0, 1), k).drop("rank"), "first_round")
    reached = (
        first.groupBy("question_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min("similarity").alias("lowest"))
        .select("question_id", F.when(F.col("n") == k, F.col("lowest")).alias("floor"))
    )
    floors = questions.join(reached, "question_id", "left").select(
        "question_id", "vector", F.coalesce("floor", F.lit(-2.0)).alias("floor")
    )
    rest = _visit(spark, path, floors, k, skip_self, 1, None)
    return _keep_best(first.unionByName(rest), k)


def _visit(
    spark: SparkSession, path: str, questions: DataFrame, k: int, skip_self: bool, first: int, last: int | None
) -> DataFrame:
    """Hits in the lists that rank from ``first`` to before ``last`` by nearness to a question,
    in sub-lists whose bound reaches the question's ``floor`` (if it has one)."""
    manifest = spark.read.schema(vb.MANIFEST).parquet(f"{path}/manifest")
    centres = sorted(spark.read.parquet(f"{path}/centres").collect())  # MAX_CENTRE_BYTES at most
    matrix = np.array([c["centre"] for c in centres])
    dim = matrix.shape[1]
    asked_path, _ = _asked(questions, *(["floor"] if "floor" in questions.columns else []))
    files = storage.data_files(spark, asked_path)
    base = storage.qualified(spark, f"{path}/blocks")
    id_type = spark.read.parquet(f"{path}/ids").schema["id"].dataType
    schema = _hit_schema(questions.schema["question_id"].dataType, id_type)
    hit_schema = to_arrow_schema(schema)
    at_once = max(1, ASKED_BYTES // (8 * max(dim, len(centres))))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [row for batch in batches for row in batch.to_pylist()]
        for asked in vb.question_blocks(files, dim, at_once) if held else ():
            angle = np.arccos(np.clip(asked.units @ matrix.T, -1.0, 1.0))
            place = np.argsort(np.argsort(angle, axis=1, kind="stable"), axis=1)
            heaps = vb.Heaps(asked, k)
            for row in held:
                own = angle[:, row["cell"]]
                gap = np.maximum(np.maximum(own - row["high"], row["low"] - own), 0.0)
                nth = place[:, row["cell"]]
                wanted = (nth >= first) & (nth < (last or len(centres)))
                wanted &= np.cos(gap) + BOUND_SLACK >= heaps.floor
                if wanted.any():
                    heaps.add(vb.read_block(f"{base}/{row['path']}"), skip_self, np.flatnonzero(wanted))
            if (hits := heaps.hits(hit_schema)) is not None:
                yield hits

    return manifest.mapInArrow(visit, schema)


# --- questions, sources, prompts -------------------------------------------------------


def question_table(
    spark: SparkSession, texts: list[str], embedder: Embedder = hashed_words
) -> DataFrame:
    """Questions typed in by the caller, with id and vector. A table of questions goes
    through ``embed`` instead."""
    matrix = embedder(texts)
    rows = [(n, text, [float(x) for x in v]) for n, (text, v) in enumerate(zip(texts, matrix))]
    return spark.createDataFrame(rows, "question_id int, question string, vector array<float>")


def criteria_text(
    drug_name: str | None = None,
    drug_form: str | None = None,
    max_price: float | None = None,
    min_price: float | None = None,
) -> str:
    """Search text of the given criteria. The wording."""
    parts = [
        (drug_name, f"Drug name: {drug_name}"),
        (drug_form, f"Form: {drug_form}"),
        (max_price, f"Price under ${max_price}"),
        (min_price, f"Price over ${min_price}"),
    ]
    return " ".join(words for value, words in parts if value) or fv.EMPTY_CRITERIA


def build_store(
    documents: DataFrame,
    path: str,
    embedder: Embedder = hashed_words,
    batch_size: int = EMBED_BATCH,
    cache: str | None = None,
    hot: int = HOT_ROWS,
) -> None:
    """Embed and write documents, one entry for each row, ordered by ``doc_id`` in each file.

    Rows move once, without vector, to the task of their text, which numbers them and embeds the text
    once. A text of ``hot`` rows or more is spread over several tasks, one for each ``hot`` rows, that
    embed it once each; equal rows of it move as one line. The table ``cache``, which outlives the
    build, keeps vectors by the 128-bit hash of their text: a text that is in it is not embedded again.
    ``doc_id`` is a hash of the text columns and a number that tells rows apart which agree in all of
    them, by price and then by copy. The vectors are also laid out as matrix blocks for ``Searcher``.
    """
    spark, columns = documents.sparkSession, documents.columns
    body = [c for c in columns if c != "price"]
    text = F.md5(F.coalesce("text", F.lit("")))
    key = F.md5(F.concat_ws("\n", *[F.coalesce(c, F.lit("")) for c in body]))
    spread = documents.groupBy(text.alias("_text")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= hot)
    # One row for each ``hot`` rows at most, so the broadcasts are bounded.
    spread = _kept(spread.select("_text", F.expr(f"_n div {hot} + 1").alias("_ways")), "hot_texts")
    alone = [F.lit(n).cast("bigint").alias(c) for c, n in (("_copies", 1), ("_way", 0))]
    rows = documents.select(*columns, *alone)
    if not spread.isEmpty():
        both = documents.withColumn("_text", text).join(F.broadcast(spread), "_text", "left")
        equal = both.where("_ways is not null").groupBy(*columns, "_ways").agg(F.count(F.lit(1)).alias("_copies"))
        shared = equal.select(*columns, "_copies", F.pmod(F.xxhash64(key), "_ways").alias("_way"))
        rows = both.where("_ways is null").select(*columns, *alone).unionByName(shared)
    known = _known_vectors(spark, cache)
    if known is not None:
        rows = rows.join(known, text == F.col("_text"), "left").drop("_text")
    # As many parts as the cluster is set to: vectors make rows ten times as long behind the shuffle, and
    # the hashes are made again there.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, text, F.col("_way")).withColumns(
        {"_text": text, "_key": key, "_row": F.md5(F.to_json(F.struct(*body)))}
    )
    before = Window.partitionBy("_text", "_way", "_key").orderBy("price", "_row").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("_copies").over(before), F.lit(0))
    one_text = Window.partitionBy("_text", "_way")
    again = F.min("_key").over(one_text) != F.max("_key").over(one_text)
    doc_id = F.concat_ws("-", "_key", F.lpad(F.col("_copy").cast("string"), 12, "0"))
    placed = (
        dealt.withColumns({"_first": first, "_again": again})
        .withColumn("_copy", F.explode(F.sequence("_first", F.col("_first") + F.col("_copies") - 1)))
        .select(*columns, doc_id.alias("doc_id"), "_again", *(["vector"] if known is not None else []))
        .sortWithinPartitions("doc_id")  # without the vectors, which make rows several times as long
    )
    laid = _embed_once(placed, embedder, batch_size)
    with storage.freed_shuffles(spark):
        laid.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/documents")
    if cache is not None:
        _keep_vectors(load_store(spark, path), known, cache)
    rows = load_store(spark, path).select(
        F.col("doc_id").alias("id"), "vector", F.lit(0).alias("cell"), F.lit(0.0).alias("angle")
    )
    _write_blocks(rows, path, BLOCK_ROWS)


def _embed_once(df: DataFrame, embedder: Embedder, batch_size: int) -> DataFrame:
    """``df`` with ``vector`` as its last column; a task embeds a text once, if rows that are equal in it
    follow each other or have ``_again`` set. Rows that have a vector keep it."""
    names = [c for c in df.columns if c not in ("vector", "_again")]
    vector = T.StructField("vector", T.ArrayType(T.FloatType()), True)
    schema = T.StructType([*df.select(*names).schema.fields, vector])

    def add_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        last: dict[str, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            numbers, distinct = pd.factorize(np.array(texts, dtype=object))
            firsts = np.unique(numbers, return_index=True)[1].tolist()
            found = [held.get(t, last.get(t)) for t in distinct]
            if "vector" in batch.schema.names:
                given = batch.column("vector")
                found = [given[k].values.to_numpy() if given[k].is_valid else v for k, v in zip(firsts, found)]
            fresh = [k for k, v in enumerate(found) if v is None]
            for low in range(0, len(fresh), batch_size):
                part = fresh[low : low + batch_size]
                matrix = np.asarray(embedder([distinct[k] for k in part]), dtype=np.float32)
                for k, row in zip(part, matrix):
                    found[k] = row
            again = batch.column("_again")
            held.update({distinct[n]: found[n].copy() for n, k in enumerate(firsts) if again[k].as_py()})
            last = {texts[-1]: found[numbers[-1]].copy()}
            matrix = np.stack(found)[numbers]
            offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
            vectors = pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], vectors], [*names, "vector"])

    return df.mapInArrow(add_vectors, schema)


CACHE_SCHEMA = "_text string, vector array<float>"


def _known_vectors(spark: SparkSession, cache: str | None) -> DataFrame | None:
    """(_text, vector) of the cache; None if there is none yet. Two builds at once may both have
    embedded a text: one of its vectors counts."""
    if cache is None or not storage.folders(spark, cache):
        return None
    return spark.read.schema(CACHE_SCHEMA).parquet(cache).select("_text", "vector").dropDuplicates(["_text"])


def _keep_vectors(store: DataFrame, known: DataFrame | None, cache: str) -> None:
    """Adds the vectors of a store to the cache, those that it does not have."""
    texts = store.select(F.md5(F.coalesce("text", F.lit(""))).alias("_text"), "vector").dropDuplicates(["_text"])
    if known is not None:
        texts = texts.join(known.select("_text"), "_text", "left_anti")
    fresh = _kept(texts, "fresh_vectors")
    if not fresh.isEmpty():
        with storage.freed_shuffles(store.sparkSession):
            fresh.write.parquet(f"{cache}/load_id={uuid.uuid4().hex}")


def load_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/documents")


def search(store: DataFrame, questions: DataFrame, k: int = 5) -> DataFrame:
    """Stored documents of the ``k`` best hits of each question of a table.

    The ranking reads ids and vectors only; the documents of the hits are joined by id. The hits are
    made first, so that few of them go to the documents and not these to them.
    """
    hits = _kept(topk(store.select(F.col("doc_id").alias("id"), "vector"), questions, k), "hits")
    return store.drop("vector").join(hits.withColumnRenamed("id", "doc_id"), "doc_id")


class Searcher:
    """Answers questions typed in by a caller over a built store.

    The matrix blocks are listed once; a search is one pass over them (mapped into memory where the
    store lies on a mounted file system), with the questions in the task closure, one merge, and a
    lookup of the hits' documents by id on the scan.
    """

    def __init__(self, spark: SparkSession, path: str, embedder: Embedder = hashed_words):
        self.spark, self.embedder = spark, embedder
        self.store = load_store(spark, path).drop("vector")
        self.manifest = spark.read.schema(vb.MANIFEST).parquet(f"{path}/manifest")
        self.base = storage.qualified(spark, f"{path}/blocks")

    def rank(self, texts: list[str], k: int = 5) -> DataFrame:
        """(question_id, id, similarity, rank); questions are numbered from 0."""
        base, schema = self.base, _hit_schema(T.IntegerType(), T.StringType())
        hit_schema, units = to_arrow_schema(schema), vb.units(np.asarray(self.embedder(texts), dtype=np.float32))
        asked = vb.Questions(np.arange(len(texts), dtype=np.int32), units, np.full(len(texts), -2.0))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            heaps = vb.Heaps(asked, k)
            for batch in batches:
                for name in batch.column("path").to_pylist():
                    heaps.add(vb.read_block(f"{base}/{name}"), False)
            if (hits := heaps.hits(hit_schema)) is not None:
                yield hits

        order = Window.partitionBy("question_id").orderBy(F.desc("similarity"), "id")
        found = self.manifest.select("path").mapInArrow(score, schema)
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def ask(self, texts: list[str], k: int = 5) -> DataFrame:
        """Stored documents of the ``k`` best hits of each question, with similarity and rank."""
        ranked = self.rank(texts, k)
        if len(texts) * k > LOOKUP_IDS:
            return self.store.join(ranked.withColumnRenamed("id", "doc_id"), "doc_id")
        hits = self.spark.createDataFrame(ranked.collect(), ranked.schema).withColumnRenamed("id", "doc_id")
        wanted = sorted({row["doc_id"] for row in hits.select("doc_id").collect()})
        by_id = reduce(Column.__or__, [F.col("doc_id") == i for i in wanted], F.lit(False))
        return self.store.where(by_id).join(F.broadcast(hits), "doc_id")


def within_price(hits: DataFrame, max_price: float | None, min_price: float | None) -> DataFrame:
    """Price bounds applied after retrieval; a bound of zero or none is no bound."""
    if max_price:
        hits = hits.where(F.col("price") <= max_price)
    if min_price:
        hits = hits.where(F.col("price") >= min_price)
    return hits


def sources(hits: DataFrame) -> DataFrame:
    """Source records of an answer, with defaults."""
    return hits.select(
        "question_id",
        "rank",
        F.coalesce("ndc", F.lit("")).alias("ndc"),
        F.coalesce("ndc_description", F.lit("")).alias("ndc_description"),
        "drug_name",
        F.col("price").alias("nadac_per_unit"),
        "pricing_unit",
        F.coalesce("similarity", F.lit(0.0)).alias("similarity_score"),
    )


def prompts(hits: DataFrame, questions: DataFrame) -> DataFrame:
    """The ``k`` documents of each question in rank order, filled into the prompt."""
    context = F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"]),
        fv.CONTEXT_SEPARATOR,
    )
    before, rest = fv.PROMPT_TEMPLATE.split("{context}")
    middle, after = rest.split("{question}")
    return (
        hits.groupBy("question_id")
        .agg(context.alias("context"), F.count(F.lit(1)).alias("num_sources"))
        .join(questions.select("question_id", "question"), "question_id")
        .select(
            "question_id",
            "question",
            "num_sources",
            F.concat(
                F.lit(before), "context", F.lit(middle), "question", F.lit(after)
            ).alias("prompt"),
        )
    )


def recall_at_k(hits: DataFrame, labels: DataFrame, k: int) -> DataFrame:
    """Mean share of each question's ``k`` hits that carry the question's label."""
    of_question = labels.select(F.col("id").alias("question_id"), F.col("label").alias("wanted"))
    per_question = (
        hits.join(of_question, "question_id")
        .join(labels, "id")
        .groupBy("question_id")
        .agg((F.count_if(F.col("label") == F.col("wanted")) / F.lit(float(k))).alias("share"))
    )
    return per_question.agg(
        F.lit(k).alias("k"),
        F.count(F.lit(1)).alias("n_questions"),
        F.round(F.avg("share"), 6).alias("recall"),
    )
