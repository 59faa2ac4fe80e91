"""Samples as numpy arrays: batch by batch to a caller, or by tasks into files for trainers."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class SequenceBatch:
    inputs: np.ndarray  # (batch, steps, features of a step)
    targets: np.ndarray  # (batch, 3)
    weights: np.ndarray  # (batch, 1)
    mask: np.ndarray  # (batch, steps), all ones
    grids: np.ndarray | None  # (batch, 3, height, width)


def batches(samples: DataFrame, steps: int, rows: int = 1024, grid_shape: tuple[int, int] | None = None) -> Iterator[SequenceBatch]:
    """Stream batches to the caller; one partition at a time is held.

    Inputs of different lengths, or that steps don't divide, and grids on some rows only are errors.
    """
    cols = ["input", "target", "sample_weight"] + (["grid"] if "grid" in samples.columns else [])
    held: list = []
    for row in samples.select(*cols).toLocalIterator(prefetchPartitions=True):
        held.append(row)
        if len(held) == rows:
            yield to_batch(held, steps, grid_shape)
            held = []
    if held:
        yield to_batch(held, steps, grid_shape)


def to_batch(rows: list, steps: int, grid_shape: tuple[int, int] | None = None) -> SequenceBatch:
    lengths = {len(r["input"]) for r in rows}
    if len(lengths) != 1 or (n := lengths.pop()) % steps:
        raise ValueError("inputs have different lengths, or steps don't divide them")
    grids = [r["grid"] if "grid" in r else None for r in rows]
    if any(g is None for g in grids) != all(g is None for g in grids):
        raise ValueError("some samples have a grid and some have none")
    made = None if grids[0] is None else np.array(grids, np.float32).reshape(len(rows), 3, *grid_shape)
    return SequenceBatch(
        np.array([r["input"] for r in rows], np.float32).reshape(len(rows), steps, n // steps),
        np.array([r["target"] for r in rows], np.float32),
        np.array([[r["sample_weight"]] for r in rows], np.float32),
        np.ones((len(rows), steps), np.float32),
        made,
    )


def flat_tensors(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets and weights of rows, without the shape of steps."""
    b = to_batch(rows, 1)
    return b.inputs[:, 0, :], b.targets, b.weights


INDEX = "file string, batch bigint, rows bigint, width bigint, grid bigint"


def _fixed(column: pa.Array, width: int) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(column.flatten().cast(pa.float32()), width)


def _tensor_batch(b: pa.Table, steps: int, grid_size: int | None, meta: dict[str, str]) -> tuple[pa.RecordBatch, int, int]:
    """Rows as fixed-shape columns, with the widths of inputs and grids; the same errors as ``to_batch``."""
    b = b.combine_chunks()
    columns = {c: b.column(c).chunk(0) for c in b.column_names}
    lengths = pc.unique(pc.list_value_length(columns["input"])).to_pylist()
    if len(lengths) != 1 or lengths[0] is None or lengths[0] % steps:
        raise ValueError("inputs have different lengths, or steps don't divide them")
    arrays = {"input": _fixed(columns["input"], lengths[0]), "target": _fixed(columns["target"], 3), "weight": columns["sample_weight"].cast(pa.float32())}
    missing = columns["grid"].null_count if "grid" in columns else b.num_rows
    if 0 < missing < b.num_rows:
        raise ValueError("some samples have a grid and some have none")
    if not missing:
        if grid_size is None or set(pc.unique(pc.list_value_length(columns["grid"])).to_pylist()) != {grid_size}:
            raise ValueError("grids don't have the given shape")
        arrays["grid"] = _fixed(columns["grid"], grid_size)
    schema = pa.schema([(n, a.type) for n, a in arrays.items()], metadata=meta)
    return pa.RecordBatch.from_arrays(list(arrays.values()), schema=schema), lengths[0], 0 if missing else grid_size


def write_tensors(samples: DataFrame, path: str, steps: int, rows: int = 1024, grid_shape: tuple[int, int] | None = None) -> DataFrame:
    """Samples as Arrow files of fixed-shape batches, written by tasks, and an index of their batches, which is returned.

    A file has one partition's batches of ``rows`` samples (the last may be shorter), so a trainer
    maps it into memory and takes any batch.  Only files of finished tasks get into the index;
    what a lost task left is never read.  Inputs of different lengths, lengths that steps don't divide, and
    grids on some rows only are errors, also between files.  ``path`` is a folder that pyarrow's
    file systems know and all executors share.
    """
    from ..sources.logsource import _system

    size = None if grid_shape is None else 3 * grid_shape[0] * grid_shape[1]
    meta = {"steps": str(steps), "grid": json.dumps(grid_shape)}
    columns = ["input", "target", "sample_weight"] + (["grid"] if "grid" in samples.columns else [])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _system(path)
        name = f"part-{uuid.uuid4().hex}.arrow"
        found: list[tuple] = []
        sink = out = None
        held: list[pa.RecordBatch] = []
        n = 0

        def cut(k: int) -> None:
            nonlocal sink, out, held, n
            table = pa.Table.from_batches(held)
            batch, width, grid = _tensor_batch(table.slice(0, k), steps, size, meta)
            if out is None:
                system.create_dir(folder, recursive=True)
                sink = system.open_output_stream(f"{folder}/{name}")
                out = pa.ipc.new_file(sink, batch.schema)
            elif out_schema[0] != batch.schema:
                raise ValueError("inputs have different lengths, or some samples have a grid and some have none")
            out_schema[:] = [batch.schema]
            out.write_batch(batch)
            found.append((name, len(found), k, width, grid))
            held = table.slice(k).to_batches()
            n -= k

        out_schema: list[pa.Schema] = []
        for b in batches:
            held.append(b)
            n += b.num_rows
            while n >= rows:
                cut(rows)
        if n:
            cut(n)
        if out is not None:
            out.close()
            sink.close()
            yield pa.RecordBatch.from_pylist([dict(zip(("file", "batch", "rows", "width", "grid"), f)) for f in found])

    samples.select(*columns).mapInArrow(work, INDEX).write.mode("overwrite").parquet(f"{path}/index")
    index = samples.sparkSession.read.schema(INDEX).parquet(f"{path}/index")
    spread = index.agg(F.min("width").alias("a"), F.max("width").alias("b"), F.min("grid").alias("c"), F.max("grid").alias("d")).first()
    if spread["a"] != spread["b"]:
        raise ValueError("inputs have different lengths, or steps don't divide them")
    if spread["c"] != spread["d"]:
        raise ValueError("some samples have a grid and some have none")
    return index


class TensorFiles:
    """What ``write_tensors`` wrote, for a trainer without Spark: any batch, in order or shuffled."""

    def __init__(self, path: str):
        import pyarrow.parquet as pq

        from ..sources.logsource import _system

        self.system, self.folder = _system(path)
        index = pq.read_table(f"{self.folder}/index", filesystem=self.system).to_pylist()
        self.index = sorted(((r["file"], r["batch"], r["rows"]) for r in index))
        self._open: tuple[str, pa.ipc.RecordBatchFileReader] | None = None

    def __len__(self) -> int:
        return len(self.index)

    @property
    def rows(self) -> int:
        return sum(n for *_, n in self.index)

    def batch(self, k: int) -> SequenceBatch:
        file, place, n = self.index[k]
        if self._open is None or self._open[0] != file:
            self._open = (file, pa.ipc.open_file(self.system.open_input_file(f"{self.folder}/{file}")))
        b = self._open[1].get_batch(place)
        steps, grid = int(b.schema.metadata[b"steps"]), json.loads(b.schema.metadata[b"grid"])
        flat = lambda c: b.column(c).flatten().to_numpy()
        inputs = flat("input")
        return SequenceBatch(
            inputs.reshape(n, steps, len(inputs) // n // steps), flat("target").reshape(n, 3), b.column("weight").to_numpy().reshape(n, 1),
            np.ones((n, steps), np.float32), flat("grid").reshape(n, 3, *grid) if "grid" in b.schema.names else None,
        )

    def batches(self, seed: int | None = None) -> Iterator[SequenceBatch]:
        """Every batch once; with a seed, files and their batches in an order of that seed."""
        order = list(range(len(self)))
        if seed is not None:
            r = np.random.default_rng(seed)
            key = {f: r.random() for f in sorted({f for f, *_ in self.index})}
            within = r.random(len(order))
            order.sort(key=lambda k: (key[self.index[k][0]], within[k]))
        for k in order:
            yield self.batch(k)
