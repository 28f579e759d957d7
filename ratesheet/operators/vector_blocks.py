"""Vectors and questions as files that tasks open by themselves, and the scoring kernel.

Questions stay in Parquet files in the shared folder; a scan task walks through them block by block,
so no question passes the driver and no vector is copied for a block. Vectors of a store or an index
are laid out once as matrix blocks (packed Arrow files with ids, rows and lengths) named by a manifest
table. Blocks on a mounted file system are mapped into memory, so the pages of those in use stay in
the machine's cache between searches; each is unpacked by the task that scores it.

Files are opened with ``pyarrow.fs``: the shared folder and the tables must be on a file system
that it knows (mounted folders, HDFS, S3, GCS).
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import cloudpickle

# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PLACES = 6
#: Cells of a score matrix that are computed at once.
SCORE_CELLS = 1 << 22
#: Pairs that are scored again at once.
EXACT_PAIRS = 1 << 14
#: How far a single-precision similarity may be from the exact one.
COARSE_SLACK = 1e-4
#: More candidates than this many times ``k`` a question: the whole slice is scored exactly.
CROWDED = 8
MANIFEST = "path string, cell int, n bigint, low double, high double"


# --- files -----------------------------------------------------------------------------


def _opened(uri: str):
    files, path = pyarrow.fs.FileSystem.from_uri(uri)
    if isinstance(files, pyarrow.fs.LocalFileSystem):
        return pa.memory_map(path)
    return files.open_input_file(path)


def matrix_of(lists: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the lists that are ``dim`` long without nulls, and which these are."""
    lengths = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    sound = lengths == dim
    if flat.null_count or not sound.all():
        kept = [v.as_py() if ok else None for v, ok in zip(lists, sound)]
        sound = np.array([v is not None and None not in v for v in kept], dtype=bool)
        rows = [v for v, ok in zip(kept, sound) if ok]
        return np.array(rows, dtype=np.float64).reshape(len(rows), dim), sound
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim), sound


@dataclass
class Questions:
    """A block of questions: ids, unit rows, and the lowest similarity still wanted of each."""

    ids: np.ndarray
    units: np.ndarray
    floor: np.ndarray


def question_blocks(files: list[str], dim: int, rows: int) -> Iterator[Questions]:
    """The questions of the files, at most ``rows`` at a time; those without a sound vector go."""
    for uri in files:
        source = pq.ParquetFile(_opened(uri))
        names = [n for n in ("question_id", "vector", "floor") if n in source.schema_arrow.names]
        for batch in source.iter_batches(batch_size=rows, columns=names):
            matrix, sound = matrix_of(batch.column("vector"), dim)
            if not len(matrix):
                continue
            ids = batch.column("question_id").to_numpy(zero_copy_only=False)[sound]
            floor = np.full(len(ids), -2.0)
            if "floor" in names:
                floor = batch.column("floor").to_numpy(zero_copy_only=False)[sound]
            yield Questions(ids, units(matrix), floor)


@dataclass
class Block:
    """Vectors with their ids and lengths."""

    ids: np.ndarray
    rows: np.ndarray
    lengths: np.ndarray


def write_block(folder: str, ids: pa.Array, rows: np.ndarray) -> str:
    """Writes one block under a name of its own; the name. A repeated task writes another file,
    which no manifest names."""
    files, base = pyarrow.fs.FileSystem.from_uri(folder)
    files.create_dir(base, recursive=True)
    name = f"{uuid.uuid4().hex}.arrow"
    flat = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1])
    batch = pa.RecordBatch.from_arrays([ids, flat, pa.array(lengths_of(rows))], ["id", "vector", "length"])
    packed = pa.ipc.IpcWriteOptions(compression="zstd")
    with files.open_output_stream(f"{base}/{name}") as out, pa.ipc.new_file(out, batch.schema, options=packed) as writer:
        writer.write_batch(batch)
    return name


def read_block(uri: str) -> Block:
    batch = pa.ipc.open_file(_opened(uri)).get_batch(0)
    lists = batch.column("vector")
    rows = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
    lengths = batch.column("length").to_numpy(zero_copy_only=False)
    return Block(batch.column("id").to_numpy(zero_copy_only=False), rows, lengths)


# --- scoring ---------------------------------------------------------------------------


def lengths_of(matrix: np.ndarray) -> np.ndarray:
    """Row lengths in double precision; a zero row counts as length one and stays zero."""
    lengths = np.sqrt(np.einsum("ij,ij->i", matrix, matrix, dtype=np.float64))
    return np.where(lengths > 0, lengths, 1.0)


def units(matrix: np.ndarray) -> np.ndarray:
    matrix = np.asarray(matrix, dtype=np.float64)
    return matrix / lengths_of(matrix)[:, None]


def sortable(ids: np.ndarray) -> np.ndarray:
    return ids.astype(str) if ids.dtype == object else ids


def trim(question: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best entries of each question, ties by smaller id."""
    order = np.lexsort((sortable(ids), -scores, question))
    ranked = question[order]
    starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[place < k]


def _exact(unit: np.ndarray, block: Block, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    dots = np.empty(len(q))
    for low in range(0, len(q), EXACT_PAIRS):
        some = slice(low, low + EXACT_PAIRS)
        dots[some] = np.einsum("ij,ij->i", unit[q[some]], block.rows[v[some]].astype(np.float64))
    return np.round(dots / block.lengths[v], PLACES) + 0.0


def best(asked: Questions, block: Block, k: int, skip_self: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(question position, vector position, similarity) of the ``k`` best per question.

    A slice of questions is scored in single precision; what may be among the best, or reach the
    question's floor, is scored again exactly. Where that is most of a slice (a block of copies),
    all of it is scored exactly.
    """
    step = max(1, SCORE_CELLS // max(1, len(block.ids)))
    coarse_rows = block.rows.astype(np.float32, copy=False)
    scale = (1.0 / block.lengths).astype(np.float32)
    found = []
    for low in range(0, len(asked.ids), step):
        unit, floor = asked.units[low : low + step], asked.floor[low : low + step]
        scores = (unit.astype(np.float32) @ coarse_rows.T) * scale
        own = asked.ids[low : low + step, None] == block.ids[None, :] if skip_self else None
        if skip_self:
            scores[own] = -np.inf
        cut = floor - COARSE_SLACK
        if len(block.ids) > k:
            cut = np.maximum(cut, np.partition(scores, -k, axis=1)[:, -k] - COARSE_SLACK)
        q, v = np.nonzero(scores >= np.maximum(cut, -1.5)[:, None])
        if len(q) > CROWDED * k * len(unit):
            scores = np.round((unit @ block.rows.T.astype(np.float64)) / block.lengths, PLACES) + 0.0
            if skip_self:
                scores[own] = -np.inf
            cut = np.maximum(floor, -1.5)
            if len(block.ids) > k:
                cut = np.maximum(cut, np.partition(scores, -k, axis=1)[:, -k])
            q, v = np.nonzero(scores >= cut[:, None])
            s = scores[q, v]
        else:
            s = _exact(unit, block, q, v)
        if len(q):
            keep = trim(q, block.ids[v], s, k)
            keep = keep[s[keep] >= floor[q[keep]]]
            found.append((q[keep] + low, v[keep], s[keep]))
    if not found:
        return np.empty(0, dtype=int), np.empty(0, dtype=int), np.empty(0)
    return tuple(np.concatenate(columns) for columns in zip(*found))


class Heaps:
    """The ``k`` best hits of each question of a block so far; its floors rise with them."""

    def __init__(self, asked: Questions, k: int):
        self.asked, self.k = asked, k
        self.floor = asked.floor.copy()
        self.q, self.s = np.empty(0, dtype=int), np.empty(0)
        self.ids: np.ndarray | None = None

    def add(self, block: Block, skip_self: bool, some: np.ndarray | None = None) -> None:
        """Scores a block against the questions, or those at the positions ``some``."""
        at = np.arange(len(self.asked.ids)) if some is None else some
        part = Questions(self.asked.ids[at], self.asked.units[at], self.floor[at])
        q, v, s = best(part, block, self.k, skip_self)
        if not len(q):
            return
        ids = block.ids[v]
        self.q, self.s = np.concatenate([self.q, at[q]]), np.concatenate([self.s, s])
        self.ids = ids if self.ids is None else np.concatenate([self.ids, ids])
        keep = trim(self.q, self.ids, self.s, self.k)
        self.q, self.ids, self.s = self.q[keep], self.ids[keep], self.s[keep]
        full = np.bincount(self.q, minlength=len(self.floor)) == self.k
        lowest = np.full(len(self.floor), np.inf)
        np.minimum.at(lowest, self.q, self.s)
        self.floor[full] = np.maximum(self.floor[full], lowest[full])

    def hits(self, schema: pa.Schema) -> pa.RecordBatch | None:
        if self.ids is None:
            return None
        columns = [self.asked.ids[self.q], self.ids, self.s]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
