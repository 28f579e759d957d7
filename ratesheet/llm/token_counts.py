"""Token counts kept by deltas: signed rows change additive totals, batch by batch.

A change says that a document came (``insert``), went (``delete``) or was counted anew
(``revise``: its old state leaves, its new state enters). Each becomes signed rows; a batch's rows
are summed by (source, lang, version), written aside and published as the batch's own folder with
one move, so a reader sees a batch whole or not at all. A batch that is committed twice counts once,
in any order; reading totals never touches a text.

``fold`` sums old batches into one and names them in it, published with the same move. Batches that
a fold names no longer count, whether their folders are gone yet or not, and a folded batch that is
committed again changes nothing. So what totals read stays small however many batches there were.

Null source, lang or version are groups of their own. A null or empty text counts as one document
of no tokens. Repeated rows count as often as they occur. No changes, no rows; no batches, no totals.
Columns other than the named ones are ignored.
"""

from __future__ import annotations

import re
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratesheet.llm.common import over_texts
from ratesheet.llm.tokens import encoder, vocabulary
from ratesheet.sources import storage

#: Folders of batches, and where a fold names those it has summed up.
_BATCH, _NAMES = "batch_id=", "_names"
GROUP = ["source", "lang", "version"]
MEASURES = ["n_docs", "n_tokens", "n_chars"]
TABLE = "source string, lang string, version string, n_docs bigint, n_tokens bigint, n_chars bigint"


def counted(docs: DataFrame, version: str, tokenizer: str | None = None, extra_ids: int = 0) -> DataFrame:
    """State of each document: (doc_id, source, lang, version, n_docs, n_tokens, n_chars).

    ``extra_ids`` are ids a tokenizer version adds to every document, such as an end mark.
    """
    path = vocabulary(tokenizer)

    def count(batch: pd.DataFrame) -> pd.DataFrame:
        ids_of, texts = encoder(path).ids, batch.pop("text").fillna("")
        return batch.astype({"doc_id": "Int64"}).assign(
            version=version,
            n_docs=1,
            n_tokens=[len(ids_of(t)) // 4 + extra_ids for t in texts],
            n_chars=[len(t) for t in texts],
        )

    return over_texts(docs, ["doc_id", "source", "lang", "text"], "doc_id bigint, " + TABLE, count)


def signed(states: DataFrame, sign: int) -> DataFrame:
    """The rows that bring the states in (sign 1) or take them out (sign -1)."""
    return states.select(*GROUP, *[(F.col(c) * sign).alias(c) for c in MEASURES])


def inserts(states: DataFrame) -> DataFrame:
    return signed(states, 1)


def deletes(states: DataFrame) -> DataFrame:
    return signed(states, -1)


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Old states out, new states in; what did not change cancels out."""
    return deletes(before).unionByName(inserts(after))


def _sums(rows: DataFrame) -> list[Column]:
    return [F.sum(c).cast("bigint").alias(c) for c in MEASURES]


def _batches(spark: SparkSession, table: str) -> list[str]:
    found = [name.removeprefix(_BATCH) for name, _ in storage.folders(spark, table) if name.startswith(_BATCH)]
    return sorted(found)


def _folded(spark: SparkSession, table: str) -> set[str]:
    """The batches that folds have summed up."""
    places = [f"{table}/{_BATCH}{b}/{_NAMES}" for b in _batches(spark, table)]
    places = [p for p in places if storage.exists(spark, p)]
    if not places:
        return set()
    return {r.batch_id for r in spark.read.schema("batch_id string").parquet(*places).collect()}


def _publish(deltas: DataFrame, table: str, batch_id: str, named: list[str]) -> None:
    spark, made = deltas.sparkSession, f"{table}/_incoming/{batch_id}"
    summed = deltas.groupBy(*GROUP).agg(*_sums(deltas))
    summed.where(" or ".join(f"{c} <> 0" for c in MEASURES)).write.mode("overwrite").parquet(made)
    if named:
        rows = spark.createDataFrame([(b,) for b in named], "batch_id string")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{made}/{_NAMES}")
    storage.publish(spark, made, f"{table}/{_BATCH}{batch_id}")


def commit(deltas: DataFrame, table: str, batch_id: str) -> None:
    """Publishes a batch's sums as its own part of ``table``. Safe to repeat."""
    if not re.fullmatch(r"[A-Za-z0-9-]+", batch_id):
        raise ValueError(f"not a batch id: {batch_id!r}")
    if batch_id not in _folded(deltas.sparkSession, table):
        _publish(deltas, table, batch_id, [])


def fold(spark: SparkSession, table: str, batches: list[str]) -> str | None:
    """Sums the batches named into one; its id. Those that are not there are passed over.

    Folds may be folded again. One that breaks off before the move has done nothing; one that
    breaks off after it leaves folders that count no more.
    """
    gone = _folded(spark, table)
    old = [b for b in _batches(spark, table) if b in set(batches) - gone]
    if not old:
        return None
    places = [f"{table}/{_BATCH}{b}" for b in old]
    rows = spark.read.schema(TABLE).parquet(*places)
    batch_id = f"fold-{uuid.uuid4().hex}"
    _publish(rows, table, batch_id, sorted({*old, *gone}))
    storage.remove(spark, places)
    return batch_id


def totals(spark: SparkSession, table: str) -> DataFrame:
    """Sums over all committed batches; groups whose documents have all gone are left out."""
    gone = _folded(spark, table)
    places = [f"{table}/{_BATCH}{b}" for b in _batches(spark, table) if b not in gone]
    rows = spark.read.schema(TABLE).parquet(*places) if places else spark.createDataFrame([], TABLE)
    return rows.groupBy(*GROUP).agg(*_sums(rows)).where("n_docs <> 0 or n_tokens <> 0")
