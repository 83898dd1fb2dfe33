"""Mini-batch training in which all workers take the same step.

One global order of batches per epoch, as a single machine would go through
them.  Every worker adds up the gradient of its own rows of a batch, all workers
exchange their sums, and each makes the same update, so the result does not
depend on how many there are.  A barrier stage starts the workers together; its
own gather takes a second each time, so the sums go through small files in the
shared scratch folder, and by the gather only where workers can't open it.
"""

import base64
import hashlib
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions import dense
from tidemill.functions.hashing import as_list
from tidemill.functions.optimizers import make_optimizer
from tidemill.operators.augment import DRAWS, warp_images, with_draws
from tidemill.operators.train import LOSS_OUTPUT, FitState, _history, _log
from tidemill.plans.permute import Permutation
from tidemill.plans.ranking import dealt_ranks
from tidemill.plans.scratch import scratch_dir
from tidemill.plans.shared import file_system, remove_folder

METRICS = ["n", "loss", "correct", "val_n", "val_loss", "val_correct"]
RESULT = f"worker int, {', '.join(f'{m} double' for m in METRICS)}, digest string, params array<double>"


@dataclass(frozen=True)
class Augmentation:
    """Images of the training side are drawn anew each epoch: the parameters of ``augment_plan`` with seed 'seed:epoch', variant 0."""

    height: int
    width: int
    channels: int = 1
    ranges: dict | None = None


class _Rows:
    """A worker's sorted stream of rows, taken batch of training rows by batch."""

    COLUMNS = ("_pos", "_rank", "_x", "_y")

    def __init__(self, batches: Iterator[pa.RecordBatch], images: Augmentation | None):
        self.batches, self.images, self.held = batches, images, None

    def _next(self) -> bool:
        """Reads on; False at the end."""
        for b in self.batches:
            if b.num_rows:
                x = dense.matrix(b.column("_x"))
                if self.images:
                    shape = (len(x), self.images.height, self.images.width, self.images.channels)
                    if x.shape[1] != shape[1] * shape[2] * shape[3]:
                        raise ValueError(f"an image is not {shape[1]} x {shape[2]} x {shape[3]}")
                    draws = {d: b.column(d).to_numpy(zero_copy_only=False) for d in DRAWS}
                    x = warp_images(x.reshape(shape), draws).reshape(len(x), -1)
                fresh = [b.column("_pos").to_numpy(zero_copy_only=False), b.column("_rank").to_numpy(), x, b.column("_y").to_numpy()]
                self.held = fresh if self.held is None else [np.concatenate([h, f]) for h, f in zip(self.held, fresh)]
                return True
        return False

    def before(self, position: int):
        """Rows up to a position of the order: rank, x, y; None if this worker has none."""
        while self.held is None or self.held[0][-1] < position:
            if not self._next():
                break
        if self.held is None:
            return None
        cut = int(np.searchsorted(self.held[0], position))
        taken, self.held = [h[:cut] for h in self.held], [h[cut:] for h in self.held]
        if not len(self.held[0]):
            self.held = None
        return taken[1:] if cut else None

    def rest(self):
        """What is left, part by part."""
        while self.held is not None or self._next():
            held, self.held = self.held, None
            yield held[1:]


class FolderExchange:
    """All-gather by files: each worker writes its sums under the step's number and waits for the others'.

    A worker that has all sums of a step knows that all have read those of the
    step before, and removes its own.  A repeated stage has a folder of its own.
    """

    LONGEST_WAIT = 0.02

    def __init__(self, folder: str, context: BarrierTaskContext):
        self.files, base = file_system(folder)
        # The first worker's word, so a repeated stage agrees on a new folder.
        self.base = f"{base}/{context.allGather(uuid.uuid4().hex)[0]}"
        self.worker, self.workers, self.step = context.partitionId(), len(context.getTaskInfos()), 0
        self.files.create_dir(self.base, recursive=True)

    def gather(self, sums: np.ndarray) -> list[np.ndarray]:
        name, self.step = f"{self.base}/{self.step}", self.step + 1
        with self.files.open_output_stream(f"{name}-{self.worker}.part") as out:
            out.write(sums.tobytes())
        self.files.move(f"{name}-{self.worker}.part", f"{name}-{self.worker}")
        found = [sums if other == self.worker else self._wait(f"{name}-{other}") for other in range(self.workers)]
        if self.step > 1:
            self.files.delete_file(f"{self.base}/{self.step - 2}-{self.worker}")
        return found

    def _wait(self, name: str) -> np.ndarray:
        pause = 0.0002
        while True:
            try:
                with self.files.open_input_file(name) as f:
                    return np.frombuffer(f.read())
            except FileNotFoundError:  # a failed worker ends the whole stage, and this wait with it
                time.sleep(pause)
                pause = min(2 * pause, self.LONGEST_WAIT)


class BarrierExchange:
    """All-gather by the barrier's own means, a second per step."""

    def __init__(self, context: BarrierTaskContext):
        self.context = context

    def gather(self, sums: np.ndarray) -> list[np.ndarray]:
        return [np.frombuffer(base64.b64decode(m)) for m in self.context.allGather(base64.b64encode(sums.tobytes()).decode())]


def fit_synchronous(
    df: DataFrame, key, features, target: str, hidden: list[int], loss: str, epochs: int, outputs: int = 1,
    optimizer="adam", batch: int = 32, dropout: float = 0.0, seed: int = 42, workers: int | None = None,
    split: str | None = None, validation: str = "validation", initial: FitState | None = None,
    schedule: Callable[[int, float], float] | None = None, drop_remainder: bool = False, augment: Augmentation | None = None, exchange: str = "folder",
) -> tuple[FitState, DataFrame]:
    """A fully connected network, or with no hidden layer a logistic or linear unit, by synchronous mini-batches.

    ``features`` is an array column or a list of numeric columns.  The training
    rows are ranked once, by one shuffle that also deals them over the workers;
    an epoch's order is a keyed permutation of the ranks, and a worker sorts
    its own rows by it, on disk if need be.  A step waits for all workers, so
    they must run at the same time: ``workers`` may not exceed the task slots.
    ``exchange`` is 'folder' (below ``spark.checkpoint.dir``, which workers must
    be able to open) or 'barrier'.  A lost worker makes all repeat the epoch
    from its first weights.

    ``batch`` is the size over all workers; the last batch of an epoch may be
    smaller, or is left out with ``drop_remainder``.  Dropout and
    ``augment`` draw by (seed, epoch, row).  Training loss and accuracy are
    those before each update, validation those after the epoch.  Rows without
    a complete vector or a target take no part; ``key`` must identify a row.
    """
    spark = df.sparkSession
    slots_free = spark.sparkContext.defaultParallelism
    workers = workers or min(8, slots_free)
    if workers > slots_free:
        raise ValueError(f"{workers} workers must run at once, but there are {slots_free} task slots")
    output, rule, keys = LOSS_OUTPUT[loss], make_optimizer(optimizer), as_list(key)
    vector = F.col(features).cast("array<double>") if isinstance(features, str) else F.array(*[F.col(c).cast("double") for c in features])
    side = F.coalesce(F.col(split) == validation, F.lit(False)) if split else F.lit(False)
    rows = df.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], side.alias("_val"), vector.alias("_x"), F.col(target).cast("double").alias("_y"))
    rows = rows.where(F.col("_x").isNotNull() & F.col("_y").isNotNull() & ~F.exists("_x", lambda v: v.isNull()))
    names = [f"_key{i}" for i in range(len(keys))]
    folder = scratch_dir(spark, "gradients") if exchange == "folder" else None
    data = dealt_ranks(rows, names, workers, ~F.col("_val"), seed, "_rank").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total = data.agg(F.count_if(~F.col("_val")).alias("n"), F.max(F.size("_x")).alias("width")).first()
        if not total.n:
            raise ValueError("no training row has both a vector and a target")
        widths = initial.widths if initial else [total.width, *hidden, outputs]
        state = initial or FitState(dense.glorot(widths, seed), rule.slots(dense.sizes(widths)), 0, widths, output)
        rate = rule.lr if state.lr is None else state.lr
        history = []
        for epoch in range(state.epoch, state.epoch + epochs):
            rate = schedule(epoch, rate) if schedule else rate
            placed = Permutation(total.n, f"{seed}:{epoch}").apply(data.withColumn("_turn", F.when(~F.col("_val"), F.col("_rank"))), "_turn", "_pos")
            columns = list(_Rows.COLUMNS)
            if augment:
                placed = with_draws(placed.withColumnsRenamed(dict(zip(names, keys))), keys, F.lit(0), augment.ranges, f"{seed}:{epoch}", ~F.col("_val"))
                columns += DRAWS
            # Validation rows have no place in the order and come last.
            ordered = placed.sortWithinPartitions(F.asc_nulls_last("_pos")).select(*columns).withColumn("_pos", F.coalesce("_pos", F.lit(total.n)))
            state, row = _epoch(ordered, state, rule, rate, epoch, total.n, batch, dropout, seed, drop_remainder, bool(split), augment, folder)
            history.append(row)
            _log(spark, [row])
    finally:
        data.unpersist()
        if folder:
            files, path = file_system(folder)
            remove_folder(files, path)
    return state, _history(spark, history)


def _epoch(ordered: DataFrame, state: FitState, rule, rate: float, epoch: int, n: int, batch: int, dropout: float, seed: int, drop_remainder: bool, judged: bool, images, folder: str | None) -> tuple[FitState, tuple]:
    """One barrier job: the new state and the history row."""
    steps = n // batch if drop_remainder else -(-n // batch)
    start_w, start_slots, start_step, widths, output = state.weights, state.slots, state.step, state.widths, state.output

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        worker, rows, w, slots = context.partitionId(), _Rows(batches, images), start_w, start_slots
        exchange = FolderExchange(folder, context) if folder else BarrierExchange(context)
        done = dict.fromkeys(METRICS, 0.0)
        for step in range(steps):
            own = rows.before(min(n, (step + 1) * batch))
            sums = np.zeros(3 + len(w))
            if own is not None:
                rank, x, y = own
                g, part, right = dense.gradient(w, widths, x, y, output, dropout, dense.RowDraws(seed, epoch, rank))
                sums = np.concatenate([[len(y), part, right], g * len(y)])
            # Added in worker order, so every worker gets the very same sum.
            added = sum(exchange.gather(sums))
            done["n"], done["loss"], done["correct"] = done["n"] + added[0], done["loss"] + added[1], done["correct"] + added[2]
            w, slots = rule.update(w, added[3:] / added[0], slots, start_step + step + 1, rate)
        if judged:
            if steps * batch < n:
                rows.before(n)
            layers = dense.unpack(w, widths)
            for _, x, y in rows.rest():
                part, right = dense.row_losses(dense.predict(layers, x, output), y, output)
                done["val_n"], done["val_loss"], done["val_correct"] = done["val_n"] + len(y), done["val_loss"] + part, done["val_correct"] + right
        params = np.concatenate([w, slots.ravel()])
        columns = [pa.array([worker], pa.int32()), *[pa.array([float(done[m])]) for m in METRICS], pa.array([hashlib.md5(params.tobytes()).hexdigest()])]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([params if worker == 0 else None], pa.list_(pa.float64()))], names=["worker", *METRICS, "digest", "params"])

    results = sorted(ordered.mapInArrow(work, RESULT, barrier=True).collect(), key=lambda r: r.worker)
    if len({r.digest for r in results}) != 1:
        raise RuntimeError("workers ended an epoch with different weights")
    first, size = results[0], len(start_w)
    params = np.array(first.params)
    val_n, val_loss, val_correct = (sum(r[m] for r in results) for m in METRICS[3:])
    classify = output != "linear"
    row = (
        epoch, float(rate), first.loss / first.n if first.n else None, val_loss / val_n if val_n else None,
        first.correct / first.n if classify and first.n else None, val_correct / val_n if classify and val_n else None,
    )
    return FitState(params[:size], params[size:].reshape(start_slots.shape), start_step + steps, widths, output, epoch + 1, rate), row
