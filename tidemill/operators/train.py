"""Model fitting: data stays distributed, weights and summed statistics return.

Each pass over the data is one aggregation.  The histories have the columns
``epoch, lr, loss, val_loss, accuracy, val_accuracy``; a training loss is taken
before the epoch's updates, a validation loss after them.
"""

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import dense
from tidemill.functions.hashing import as_list, digest, u32
from tidemill.functions.losses import binary_cross_entropy
from tidemill.functions.optimizers import Optimizer, make_optimizer
from tidemill.operators import track
from tidemill.plans.iterate import kept

HISTORY = "epoch int, lr double, loss double, val_loss double, accuracy double, val_accuracy double"


@dataclass
class FitState:
    """Weights plus what the update rule remembers, so training can go on."""

    weights: np.ndarray
    slots: np.ndarray
    step: int = 0
    widths: list[int] = field(default_factory=list)
    output: str = "linear"
    epoch: int = 0
    lr: float | None = None
    losses: list[float] = field(default_factory=list)
    converged: bool | None = None

    @property
    def layers(self) -> dense.Layers:
        return dense.unpack(self.weights, self.widths)


def save_state(spark: SparkSession, state: FitState, path: str) -> None:
    row = (state.weights.tolist(), state.slots.tolist(), state.step, list(state.widths), state.output, state.epoch, state.lr, list(state.losses), state.converged)
    schema = "weights array<double>, slots array<array<double>>, step long, widths array<int>, output string, epoch long, lr double, losses array<double>, converged boolean"
    spark.createDataFrame([row], schema).write.mode("overwrite").parquet(path)


def load_state(spark: SparkSession, path: str) -> FitState:
    row = spark.read.parquet(path).first()
    return FitState(np.array(row.weights), np.array(row.slots), row.step, list(row.widths), row.output, row.epoch, row.lr, list(row.losses), row.converged)


def _history(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, HISTORY)


def _log(spark: SparkSession, rows: list[tuple]) -> None:
    """Rows of a history to the active run, if there is one."""
    if rows and track.is_active():
        track.report(_history(spark, rows))


def fit_line(df: DataFrame, x: str, y: str, by: str | None = None) -> DataFrame:
    """Least-squares slope, intercept and r2, overall or per group, in one aggregate."""
    stats = [
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"),
    ]
    return df.groupBy(by).agg(*stats) if by else df.agg(*stats)


def doubling_time(df: DataFrame, x: str, y: str, by: str | None = None) -> DataFrame:
    """ln 2 over the slope of ln(y) on x; negative for a halving."""
    logged = df.where(F.col(y) > 0).withColumn("_log_y", F.ln(y))
    return fit_line(logged, x, "_log_y", by).withColumn("doubling_time", F.try_divide(F.lit(math.log(2.0)), F.col("slope")))


def _moments(df: DataFrame, features: list[str], target: str, split: str | None, validation: str) -> dict[bool, tuple]:
    """Row count, X'X, X'y and y'y per side, from one aggregate of products.

    Many features are multiplied as matrices, an Arrow batch at a time: a task
    hands on one Gram matrix per side, and matrices are added by position.
    """
    columns = {**{c: F.col(c).cast("double") for c in features}, "_one": F.lit(1.0), "_y": F.col(target).cast("double")}
    names = list(columns)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    side = (F.col(split) == validation) if split else F.lit(False)
    # Rows with a missing value take no part, or sums and counts would not fit.
    complete = df.select(side.alias("_val"), *[c.alias(n) for n, c in columns.items()]).dropna()
    d = len(features) + 1
    if d > NATIVE_PRODUCTS:
        partial = complete.mapInArrow(_gram, "_val boolean, pos int, s double")
        added = partial.groupBy("_val", "pos").agg(F.sum("s").alias("s")).toArrow()  # d x d numbers per side
        where, pos, s = (added.column(c).to_numpy() for c in ("_val", "pos", "s"))
        grams = {}
        for v in set(where.tolist()):
            full = np.zeros(len(names) ** 2)
            full[pos[where == v]] = s[where == v]
            full = full.reshape(len(names), len(names))
            grams[v] = (full[d - 1, d - 1], full[:d, :d], full[:d, d], full[d, d])
        return grams
    sums = (
        complete.groupBy("_val")
        .agg(*[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"s{i}_{j}") for i, j in pairs])
    )
    result = {}
    for row in sums.collect():  # two rows
        full = np.zeros((len(names), len(names)))
        for i, j in pairs:
            full[i, j] = full[j, i] = row[f"s{i}_{j}"]
        result[row["_val"]] = (full[d - 1, d - 1], full[:d, :d], full[:d, d], full[d, d])
    return result


#: Up to so many columns products are native sums in one aggregate; both ways give the same sums.
NATIVE_PRODUCTS = 16


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One Gram matrix of all columns per side of a task's rows, as (side, position, sum)."""
    sums: dict[bool, np.ndarray] = {}
    for batch in batches:
        x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]], axis=1)
        side = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
        for v in np.unique(side).tolist():
            rows = x[side == v]
            sums[v] = sums.get(v, 0.0) + rows.T @ rows
    for v, full in sums.items():
        n = full.size
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, v)), pa.array(np.arange(n, dtype=np.int32)), pa.array(full.ravel())], names=["_val", "pos", "s"])


def fit_linear_gd(
    df: DataFrame, features, target: str, epochs: int, steps: int | None = None, optimizer=None,
    schedule: Callable[[int, float], float] | None = None, split: str | None = None, validation: str = "validation",
    initial: FitState | None = None,
) -> tuple[FitState, DataFrame]:
    """Full-batch gradient descent on the mean squared error.

    The loss and its gradient depend on the data only through X'X, X'y and
    y'y, so one aggregation serves every epoch.  ``schedule(epoch, lr)`` sets
    the rate; ``steps`` per epoch defaults to ceil(n / 32).  Many momentum
    steps at one rate are one linear map, applied by repeated squaring.
    """
    features = as_list(features)
    rule = make_optimizer(optimizer or Optimizer("sgd", 0.001, 0.9))
    sides = _moments(df, features, target, split, validation)
    if False not in sides:
        raise ValueError("the training side has no complete row")
    n, xx, xy, yy = sides[False]
    steps = steps or math.ceil(n / 32)
    d = len(features) + 1
    state = initial or FitState(np.zeros(d), rule.slots(d), 0, [d - 1, 1], "linear")
    w, slots, step, lr = state.weights, state.slots, state.step, rule.lr if state.lr is None else state.lr

    def mse(side, w):
        m, a, b, c = sides[side]
        return float((w @ a @ w - 2 * w @ b + c) / m)

    rows = []
    try:
        for epoch in range(state.epoch, state.epoch + epochs):
            lr = schedule(epoch, lr) if schedule else lr
            if rule.name == "sgd" and steps > STEPS_ONE_BY_ONE:
                w, velocity, loss = _momentum_steps(sides[False], w, slots[0], steps, lr, rule.momentum)
                slots, step = np.stack([velocity]), step + steps
            else:
                losses = []
                for _ in range(steps):
                    losses.append(mse(False, w))
                    step += 1
                    w, slots = rule.update(w, 2.0 / n * (xx @ w - xy), slots, step, lr)
                loss = sum(losses) / len(losses)
            rows.append((epoch, float(lr), loss, mse(True, w) if True in sides else None, None, None))
    finally:  # epochs are mere arithmetic here, so they are logged together
        _log(df.sparkSession, rows)
    return FitState(w, slots, step, state.widths, "linear", state.epoch + epochs, lr), _history(df.sparkSession, rows)


#: Beyond so many steps per epoch the linear map is cheaper; both ways give the same weights.
STEPS_ONE_BY_ONE = 64


def _momentum_steps(side: tuple, w: np.ndarray, velocity: np.ndarray, steps: int, lr: float, momentum: float) -> tuple:
    """Weights and velocity after ``steps`` updates, and the mean of the losses before each.

    An update maps (w, v, 1) linearly and a loss is a quadratic form of it, so
    powers of the map and sums of forms are doubled along the bits of ``steps``.
    """
    n, xx, xy, yy = side
    d = len(w)
    pull, push, one = 2.0 * lr / n * xx, 2.0 * lr / n * xy[:, None], np.eye(d)
    last = np.r_[np.zeros(2 * d), 1.0][None]
    update = np.block([[one - pull, momentum * one, push], [-pull, momentum * one, push]])
    update = np.concatenate([update, last])
    form = np.zeros((2 * d + 1, 2 * d + 1))
    form[:d, :d], form[:d, -1], form[-1, :d], form[-1, -1] = xx / n, -xy / n, -xy / n, yy / n
    power, total = np.eye(2 * d + 1), np.zeros_like(form)
    for bit in bin(steps)[2:]:
        total, power = total + power.T @ total @ power, power @ power
        if bit == "1":
            total, power = form + update.T @ total @ update, power @ update
    z = np.r_[w, velocity, 1.0]
    end = power @ z
    return end[:d], end[d:2 * d], float(z @ total @ z) / steps


def fit_logistic(
    df: DataFrame, features, label: str, epochs: int, optimizer="adam", schedule: Callable[[int, float], float] | None = None,
    split: str | None = None, validation: str = "validation", initial: FitState | None = None,
) -> tuple[FitState, DataFrame]:
    """A sigmoid unit fitted by full-batch cross-entropy gradients.

    Gradient, loss and accuracy of both sides come from one native aggregate
    per epoch over a persisted, column-pruned frame.
    """
    features = as_list(features)
    rule = make_optimizer(optimizer)
    d = len(features) + 1
    state = initial or FitState(np.zeros(d), rule.slots(d), 0, [d - 1, 1], "sigmoid")
    w, slots, step, lr = state.weights, state.slots, state.step, rule.lr if state.lr is None else state.lr
    held_out = (F.col(split) == validation).cast("double") if split else F.lit(0.0)
    columns = {"_v": held_out, "_y": F.col(label).cast("double"), **{f"_x{j}": F.col(c).cast("double") for j, c in enumerate(features)}}
    # Rows with a missing value take no part; the coalesce only tells the
    # code generator so, which spares a null test per term and row.
    complete = df.select(*[c.alias(n) for n, c in columns.items()]).dropna()
    pruned = complete.select(*[F.coalesce(n, F.lit(0.0)).alias(n) for n in columns])

    # Weights enter as a one-row subquery, so every epoch has the same plan and
    # compiled code.  One ungrouped aggregate with 0/1 masks costs half of
    # grouping by side.
    z = F.get("_w", F.lit(d - 1))
    for j in range(d - 1):
        z = z + F.get("_w", F.lit(j)) * F.col(f"_x{j}")
    probability = 1.0 / (1.0 + F.exp(-z))
    training = 1.0 - F.col("_v")
    per_row = {
        "_loss": binary_cross_entropy(F.col("_y"), F.col("_p")),
        "_hit": ((F.col("_p") > 0.5).cast("double") == F.col("_y")).cast("double"),
        "_e": (F.col("_p") - F.col("_y")) * training,
    }
    sums = {"n": F.sum(training), "loss": F.sum(F.col("_loss") * training), "hit": F.sum(F.col("_hit") * training)}
    if split:
        sums.update(val_n=F.sum("_v"), val_loss=F.sum(F.col("_loss") * F.col("_v")), val_hit=F.sum(F.col("_hit") * F.col("_v")))
    sums.update({f"g{j}": F.sum(F.col("_e") * F.col(f"_x{j}")) for j in range(d - 1)})
    sums[f"g{d - 1}"] = F.sum("_e")
    totals = [value.alias(name) for name, value in sums.items()]

    def evaluate(data: DataFrame, w: np.ndarray) -> tuple:
        """(loss, accuracy) of both sides and the training gradient, from one row of sums."""
        weights = df.sparkSession.createDataFrame(pa.table({"w": [w.tolist()]}), "w array<double>")
        scored = data.withColumn("_w", weights.scalar()).withColumn("_p", probability).withColumns(per_row)
        r = scored.agg(*totals).first()
        if not r["n"]:
            raise ValueError("the training side has no complete row")
        train = (r["loss"] / r["n"], r["hit"] / r["n"])
        val = (r["val_loss"] / r["val_n"], r["val_hit"] / r["val_n"]) if split and r["val_n"] else (None, None)
        return train, val, np.array([r[f"g{j}"] for j in range(d)]) / r["n"]

    rows = []
    with kept(pruned, source=df) as data:
        now = evaluate(data, w)
        for epoch in range(state.epoch, last := state.epoch + epochs):
            lr = schedule(epoch, lr) if schedule else lr
            (loss, accuracy), _, gradient = now
            step += 1
            w, slots = rule.update(w, gradient, slots, step, lr)
            if epoch + 1 < last or split:
                now = evaluate(data, w)
            val_loss, val_accuracy = now[1] if split else (None, None)
            rows.append((epoch, float(lr), loss, val_loss, accuracy, val_accuracy))
            _log(df.sparkSession, rows[-1:])
    return FitState(w, slots, step, state.widths, "sigmoid", state.epoch + epochs, lr), _history(df.sparkSession, rows)


def fit_softmax_head(df: DataFrame, features: str, label: str, classes: int, max_iter: int = 30, reg: float = 0.0) -> FitState:
    """Multinomial logistic layer on frozen array features, by Spark ML's L-BFGS.

    The state tells how the fit ended: ``losses`` before each iteration and at
    the end, ``epoch`` iterations, and ``converged`` if they stopped by
    themselves, not at ``max_iter``.
    """
    data = df.select(array_to_vector(F.col(features).cast("array<double>")).alias("features"), F.col(label).cast("double").alias("label"))
    # Without the family's own class statistics a missing class would shrink the output.
    model = LogisticRegression(family="multinomial", maxIter=max_iter, regParam=reg).fit(data)
    matrix, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    w = np.zeros((matrix.shape[1], classes))
    b = np.full(classes, -1e3)  # a class never seen gets no probability
    w[:, :matrix.shape[0]], b[:matrix.shape[0]] = matrix.T, bias
    b[~np.isfinite(b)] = -1e3
    losses = [float(x) for x in model.summary.objectiveHistory]
    done = len(losses) - 1
    _log(df.sparkSession, [(i, None, loss, None, None, None) for i, loss in enumerate(losses[:-1])])
    return FitState(dense.pack([(w, b)]), np.zeros((0, w.size + classes)), done, [w.shape[0], classes], "softmax", done, None, losses, done < max_iter)


def softmax_history(spark: SparkSession, state: FitState) -> DataFrame:
    """The training loss before each iteration of ``fit_softmax_head``, in the columns of the other histories."""
    return _history(spark, [(i, None, loss, None, None, None) for i, loss in enumerate(state.losses[:-1])])


DRIVER_DOUBLES = 4_000_000
LOSS_OUTPUT = {"mse": "linear", "binary_ce": "sigmoid", "sparse_ce": "softmax"}
BUCKET_RESULT = "bucket long, n double, steps double, loss double, correct double, val_n double, val_loss double, val_correct double, params array<double>"


def _average(result: DataFrame, length: int) -> np.ndarray:
    """Row-count weighted mean of the buckets' vectors, summed in bucket order.

    Small results are averaged on the driver; large ones position by position
    on the cluster, where a position has one value per bucket.
    """
    counts = result.select("bucket", "n").orderBy("bucket").collect()  # one row per bucket
    total = sum(r.n for r in counts)
    if len(counts) * length <= DRIVER_DOUBLES:
        table = result.select("bucket", "n", "params").toArrow()
        order = np.argsort(table["bucket"].to_numpy())
        params = table["params"].combine_chunks().flatten().to_numpy().reshape(-1, length)[order]
        mean = np.zeros(length)
        for n, vector in zip(table["n"].to_numpy()[order], params):
            mean += n / total * vector
        return mean
    positions = result.select("bucket", "n", F.posexplode("params").alias("pos", "v")).groupBy("pos")
    parts = positions.agg(F.array_sort(F.collect_list(F.struct("bucket", "n", "v"))).alias("parts"))
    summed = parts.select("pos", F.aggregate("parts", F.lit(0.0), lambda acc, p: acc + p.n / F.lit(total) * p.v).alias("v"))
    table = summed.toArrow()
    mean = np.zeros(length)
    mean[table["pos"].to_numpy()] = table["v"].to_numpy()
    return mean


def fit_dense(
    df: DataFrame, key, features: str, target: str, hidden: list[int], loss: str, epochs: int, outputs: int = 1,
    optimizer="adam", batch: int = 32, dropout: float = 0.0, seed: int = 42, buckets: int = 8,
    split: str | None = None, validation: str = "validation", initial: FitState | None = None,
    schedule: Callable[[int, float], float] | None = None, drop_remainder: bool = False,
) -> tuple[FitState, DataFrame]:
    """Fully connected network by parallel SGD with averaging (Zinkevich et al. 2010).

    Rows are hashed into buckets once; every epoch each bucket runs its own
    mini-batches from the common weights and the results are averaged by row
    count.  Buckets stream through a worker batch by batch, so their size is
    not bound by its memory.  ``buckets`` is part of the model, as is the batch
    size: it is how many workers train side by side, without an upper bound.
    Each epoch goes through a bucket in a new order drawn from (seed, epoch,
    key).  With ``drop_remainder`` a bucket's last, partial batch is left out
    of that epoch.  Rows without vector or target take no part.  ``key`` must
    identify a row.
    """
    spark = df.sparkSession
    output = LOSS_OUTPUT[loss]
    rule = make_optimizer(optimizer)
    keys = as_list(key)
    side = (F.col(split) == validation) if split else F.lit(False)
    data = (
        df.select(
            (u32(seed, *keys) % buckets).cast("int").alias("_bucket"), *keys, side.alias("_val"), F.col(features).cast("array<double>").alias("_x"), F.col(target).cast("double").alias("_y"),
        )
        .where("_x IS NOT NULL AND _y IS NOT NULL").repartitionById(buckets, "_bucket")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    one = data.select(F.size("_x")).first()
    if one is None:
        raise ValueError("no row has both a vector and a target")
    width = one[0]
    widths = initial.widths if initial else [width, *hidden, outputs]
    size = dense.sizes(widths)
    state = initial or FitState(dense.glorot(widths, seed), rule.slots(size), 0, widths, output)

    def run_epoch(epoch: int, state: FitState, lr: float, train: bool) -> DataFrame:
        start_w, start_slots, start_step = state.weights, state.slots, state.step

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """One partition is one bucket: mini-batches across its Arrow batches, then one row of results."""
            w, slots, rng, bucket = start_w, start_slots, None, None
            done = {"n": 0, "steps": 0, "loss": 0.0, "correct": 0.0, "val_n": 0, "val_loss": 0.0, "val_correct": 0.0}

            def train_on(x, y):
                nonlocal w, slots
                g, part, right = dense.gradient(w, widths, x, y, output, dropout, rng)
                done["steps"] += 1
                w, slots = rule.update(w, g, slots, start_step + done["steps"], lr)
                done["n"] += len(y)
                done["loss"] += part
                done["correct"] += right

            for b in batches:
                if not b.num_rows:
                    continue
                x = dense.matrix(b.column("_x"))
                y, val = b.column("_y").to_numpy(), b.column("_val").to_numpy(zero_copy_only=False)
                if bucket is None:
                    bucket = b.column("_bucket")[0].as_py()
                    rng = np.random.default_rng([seed, epoch, bucket])
                    rest_x, rest_y = np.zeros((0, x.shape[1])), np.zeros(0)
                if val.any():
                    # Judged by the weights the previous epoch ended with.
                    part, right = dense.row_losses(dense.predict(dense.unpack(start_w, widths), x[val], output), y[val], output)
                    done["val_n"] += int(val.sum())
                    done["val_loss"] += part
                    done["val_correct"] += right
                if train:
                    xs, ys = np.concatenate([rest_x, x[~val]]), np.concatenate([rest_y, y[~val]])
                    whole = len(ys) // batch * batch
                    for at in range(0, whole, batch):
                        train_on(xs[at:at + batch], ys[at:at + batch])
                    rest_x, rest_y = xs[whole:], ys[whole:]
            if bucket is None:
                return
            if train and len(rest_y) and not drop_remainder:
                train_on(rest_x, rest_y)
            params = np.concatenate([w, slots.ravel()]) if train else np.zeros(0)
            columns = [pa.array([bucket], pa.int64()), *[pa.array([float(v)]) for v in done.values()], pa.array([params], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", *done, "params"])

        ordered = data.sortWithinPartitions(digest(f"{seed}:{epoch}", *keys), *keys).select("_bucket", "_val", "_x", "_y")
        return ordered.mapInArrow(work, BUCKET_RESULT)

    metrics = ["n", "steps", "loss", "correct", "val_n", "val_loss", "val_correct"]
    rows, val_rows, lr = [], [], rule.lr if state.lr is None else state.lr
    first = state.epoch
    classify = output != "linear"
    try:
        for epoch in range(first, first + epochs + 1):
            train = epoch < first + epochs
            if not train and not split:
                break
            lr = schedule(epoch, lr) if schedule and train else lr
            result = run_epoch(epoch, state, lr, train).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                table = result.select("bucket", *metrics).toArrow().sort_by("bucket")
                n, steps, loss_sum, correct, val_n, val_loss, val_correct = (math.fsum(table[m].to_pylist()) for m in metrics)
                if split:
                    val_rows.append((val_loss / val_n, val_correct / val_n if classify else None) if val_n else (None, None))
                    if rows:  # these are judged by the weights of the epoch before, whose row is whole now
                        _log(spark, [_whole(rows[-1], val_rows[-1])])
                if train:
                    mean = _average(result, size + state.slots.size)
                    taken = max(1, round(steps / max(1, table.num_rows)))
                    state = FitState(mean[:size], mean[size:].reshape(state.slots.shape), state.step + taken, widths, output, epoch + 1, lr)
                    rows.append((epoch, float(lr), loss_sum / n if n else None, correct / n if classify and n else None))
                    if not split:
                        _log(spark, [_whole(rows[-1], (None, None))])
            finally:
                result.unpersist()
    finally:
        data.unpersist()
    return state, _history(spark, [_whole(row, val_rows[i + 1] if split else (None, None)) for i, row in enumerate(rows)])


def _whole(row: tuple, judged: tuple) -> tuple:
    epoch, rate, loss, accuracy = row
    return epoch, rate, loss, judged[0], accuracy, judged[1]


def resume(fit: Callable, state: FitState, df: DataFrame, *args, **options) -> tuple[FitState, DataFrame]:
    """Continue a fit from saved weights and update-rule state, on new data if wanted."""
    return fit(df, *args, initial=state, **options)
