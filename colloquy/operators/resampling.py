"""Resampling: bootstrap intervals without gathering a group."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The distribution function of a Poisson number of mean 1.
POISSON = (0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582)


def poisson_times(keys: np.ndarray, draws: int) -> np.ndarray:
    """How often each row takes part in each draw: Poisson numbers of mean 1 from hashes of the row's key and the draw."""
    z = keys.view(np.uint64)[:, None] + (np.arange(1, draws + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    u = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    return np.searchsorted(np.array(POISSON), u, side="right")


def poisson_bootstrap(rows: DataFrame, group: str, ident: str, value: str, draws: int = 2000, level: float = 0.95) -> DataFrame:
    """(group, mean, low, high): every row takes part in each draw as often as a Poisson number of mean 1 says.

    The numbers come from hashes of the row and the draw, so that the interval is the same in every run. Tasks
    sum their rows by group and draw before anything is shuffled, so no group meets one task and no row is multiplied.
    Rows without a value take no part; a null group is a group.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                codes = part.column(0).dictionary_encode()
                names = codes.dictionary.to_pylist()
                at = codes.indices.fill_null(len(names)).to_numpy()
                times = poisson_times(part.column(1).to_numpy(), draws)
                member = (np.arange(len(names) + 1)[:, None] == at[None, :]).astype(np.float64)
                weight, total = member @ times, member @ (times * part.column(2).to_numpy()[:, None])
                for k in np.unique(at):
                    name = names[k] if k < len(names) else None
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * draws, pa.string()), pa.array(np.arange(draws)), pa.array(total[k]), pa.array(weight[k])], names=["g", "draw", "v", "t"]
                    )

    known = rows.where(F.col(value).isNotNull())
    keyed = known.select(F.col(group).cast("string").alias("g"), F.xxhash64(ident).alias("k"), F.col(value).cast("double").alias("v"))
    summed = keyed.mapInArrow(run, "g string, draw long, v double, t double").groupBy("g", "draw").agg(F.sum("v").alias("v"), F.sum("t").alias("t"))
    weighted = summed.select(F.col("g").alias("_g"), (F.col("v") / F.nullif("t", F.lit(0.0))).alias("m"))
    tail = (1 - level) / 2
    ends = weighted.groupBy("_g").agg(F.percentile("m", tail).alias("low"), F.percentile("m", 1 - tail).alias("high"))
    means = known.groupBy(group).agg(F.avg(value).alias("mean"))
    met = means.join(ends, F.col(group).cast("string").eqNullSafe(F.col("_g")))
    return met.select(group, F.round("mean", 6).alias("mean"), F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))
