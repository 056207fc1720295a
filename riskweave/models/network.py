"""Feed-forward network: gradients added up over all rows by Spark, Adam on the driver; all folds learn in one pass."""

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskweave.models.boosting import matrix
from riskweave.session import packed, tasks_for, written

SCALE = 1 << 20  # sums of a task are added as whole multiples of 1 / SCALE, so that their order does not matter
EXTRA = 4  # after the gradient: training loss and rows, held-out loss and rows


@dataclasses.dataclass
class Settings:
    hidden: tuple = (32, 16)
    penalty: float = 0.1  # L2 on weights, over a batch of `batch` rows
    batch: int = 200
    rate: float = 0.01
    steps: int = 500
    held: float = 0.2  # share of the rows that judge when to stop
    patience: int = 10
    least: float = 1e-4
    seed: int = 42


def shapes(width, s):
    sizes = (width, *s.hidden, 1)
    return list(zip(sizes, sizes[1:]))


def start(width, s):
    """Uniform weights bounded by sqrt(6 / (inputs + outputs)) as one vector, layer by layer, biases after weights."""
    rng, parts = np.random.default_rng(s.seed), []
    for a, b in shapes(width, s):
        bound = np.sqrt(6 / (a + b))
        parts += [rng.uniform(-bound, bound, a * b), rng.uniform(-bound, bound, b)]
    return np.concatenate(parts)


def layers(theta, width, s):
    at = 0
    for a, b in shapes(width, s):
        yield theta[at:at + a * b].reshape(a, b), theta[at + a * b:at + a * b + b]
        at += a * b + b


def forward(theta, x, s):
    """Outputs of every layer, the last one a margin; units are max(0, .)."""
    outs, net = [x], list(layers(theta, x.shape[1], s))
    for i, (w, b) in enumerate(net):
        z = outs[-1] @ w + b
        outs.append(np.maximum(z, 0) if i < len(net) - 1 else z)
    return outs


def losses(margin, y):
    return np.logaddexp(0, margin) - y * margin


def gradient(theta, x, y, s):
    """Sum over rows of the gradient of the loss, and the sum of losses, without penalty."""
    outs, net = forward(theta, x, s), list(layers(theta, x.shape[1], s))
    margin = outs[-1][:, 0]
    back, parts = (1 / (1 + np.exp(-margin)) - y)[:, None], []
    for i in range(len(net) - 1, -1, -1):
        parts = [(outs[i].T @ back).ravel(), back.sum(axis=0), *parts]
        if i:
            back = (back @ net[i][0].T) * (outs[i] > 0)
    return np.concatenate(parts), losses(margin, y).sum()


def is_weight(width, s):
    return np.concatenate([np.repeat([1.0, 0.0], [a * b, b]) for a, b in shapes(width, s)])


@dataclasses.dataclass
class Network:
    thetas: list
    means: np.ndarray  # by model and input
    scales: np.ndarray
    history: list  # by step, (training loss, held-out loss) of every model
    settings: Settings

    def margins(self, x, model=0):
        return forward(self.thetas[model], (x - self.means[model]) / self.scales[model], self.settings)[-1][:, 0]


def moments(flat, width, folds):
    """Mean and population deviation of every input over the rows that each model sees; 1 where it does not vary."""
    stats = flat.groupBy("_fold").agg(
        F.count("*"), *[F.avg(F.get("_x", F.lit(i))) for i in range(width)],
        *[F.var_pop(F.get("_x", F.lit(i))) for i in range(width)]).collect()
    fold, n = (np.array([r[i] for r in stats]) for i in (0, 1))
    mean, var = (np.array([list(r)[a:a + width] for r in stats], dtype=float) for a in (2, 2 + width))
    means, scales = np.zeros((folds, width)), np.ones((folds, width))
    for m in range(folds):
        use = fold != m
        if use.any():
            share = (n[use] / n[use].sum())[:, None]
            means[m] = (share * mean[use]).sum(axis=0)
            spread = np.sqrt((share * (var[use] + (mean[use] - means[m]) ** 2)).sum(axis=0))
            scales[m] = np.where(spread > 0, spread, 1.0)
    return means, scales


def fit(df, key, label="label", fold=None, folds=1, settings=None):
    """Network on standardised `features`; with `fold`, one model per fold, fitted on the rows of the others.

    A step is one job: every task adds up the gradients of its rows for all models, Spark adds the tasks, and what comes to
    the driver has a size fixed by models and weights. A hash of the key holds rows back to judge each step; a model
    stops after `patience` steps without a loss lower by `least` and keeps its best weights. Where no row is held
    back, the training loss judges. Empty input gives the weights of the start. Null features are not allowed.
    """
    s, spark = settings or Settings(), df.sparkSession
    held = F.pmod(F.xxhash64(F.lit(s.seed), *key), F.lit(10_000)) < int(s.held * 10_000)
    flat = written(spark, df.select(
        F.col(label).cast("double").alias("_y"), held.alias("_held"),
        (F.col(fold) if fold else F.lit(-1)).cast("int").alias("_fold"),
        vector_to_array("features").alias("_x")), "network-rows")
    n, width = flat.agg(F.count("*"), F.coalesce(F.max(F.size("_x")), F.lit(0))).first()
    flat, alone = written(spark, packed(flat, n, 8 * width), "network-packed"), tasks_for(n, 8 * width) == 1
    means, scales = moments(flat, width, folds)
    thetas = np.array([start(width, s)] * folds)
    size, decay = thetas.shape[1], is_weight(width, s)

    def sums(now, live):
        def run(batches):
            total = np.zeros((folds, size + EXTRA))
            for batch in batches:
                x = matrix(batch.column("_x"), width).astype(float)
                y, f, out = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_y", "_fold", "_held"))
                for m in live:
                    z = (x - means[m]) / scales[m]
                    learn, judge = (f != m) & ~out, (f != m) & out
                    grad, loss = gradient(now[m], z[learn], y[learn], s)
                    other = losses(forward(now[m], z[judge], s)[-1][:, 0], y[judge]).sum()
                    total[m] += np.concatenate([grad, [loss, learn.sum(), other, judge.sum()]])
            m, at = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(m, pa.int32()), pa.array(at, pa.int32()), pa.array(np.rint(total[m, at] * SCALE).astype(np.int64))],
                names=["model", "at", "v"])

        parts = flat.mapInArrow(run, "model int, at int, v bigint")  # one task's sums need no shuffle
        got = (parts if alone else parts.groupBy("model", "at").agg(F.sum("v").alias("v"))).toPandas()
        total = np.zeros((folds, size + EXTRA))
        np.add.at(total, (got["model"].to_numpy(), got["at"].to_numpy()), got["v"].to_numpy())
        return total / SCALE

    best, best_loss, waited, history = thetas.copy(), np.full(folds, np.inf), np.zeros(folds, dtype=int), []
    first, second = np.zeros_like(thetas), np.zeros_like(thetas)
    live = list(range(folds))
    for step in range(1, s.steps + 1):
        total = sums(thetas, live)
        seen = []
        for m in list(live):
            loss, n, other, judges = total[m, size:]
            if not n:
                live.remove(m)
                continue
            loss, judged = loss / n, (other / judges if judges else loss / n)
            seen.append((m, loss, judged))
            waited[m] = 0 if judged < best_loss[m] - s.least else waited[m] + 1
            if judged < best_loss[m]:
                best_loss[m], best[m] = judged, thetas[m]
            if waited[m] >= s.patience:
                live.remove(m)
                continue
            grad = total[m, :size] / n + s.penalty / min(s.batch, n) * thetas[m] * decay
            first[m] = .9 * first[m] + .1 * grad
            second[m] = .999 * second[m] + .001 * grad ** 2
            thetas[m] -= s.rate * (first[m] / (1 - .9 ** step)) / (np.sqrt(second[m] / (1 - .999 ** step)) + 1e-8)
        history.append(seen)
        if not live:
            break
    return Network(list(best), means, scales, history, s)
