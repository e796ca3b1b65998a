"""Normal equations for per-symbol least squares.

The inputs of all fits come out of a window over ``symbol``, so Spark has dealt them by symbol already:

1. ``solve_gram`` adds up, symbol by symbol, the packed upper triangle of X'X, X'y, y'y and n over
   Arrow batches of its rows (never all at once) and solves the small system where it stands. Only
   the solution leaves the task: the packed sums of a few hundred unknowns are larger than the rows
   behind them and would be most of the shuffle. Systems of a few unknowns use built-in sums
   (``gram_by_sums``), combined before the shuffle.
2. ``solver``: a small k×k solve on equilibrated equations (ridge penalty optional).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def packed_sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The upper triangle of X'X, then X'y, then y'y."""
    return np.concatenate([(x.T @ x)[np.triu_indices(x.shape[1])], x.T @ y, [y @ y]])


def solve_gram(df: DataFrame, solve_one: Callable, schema: str) -> DataFrame:
    """``(symbol, …)`` from rows ``(symbol, x array<double>, y)``: the rest of a row is
    ``solve_one(symbol, n, packed sums)``. Takes no exchange where the rows are dealt by symbol."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        symbol, n, g = None, 0, 0.0
        for pdf in batches:
            if len(pdf):
                symbol, n = pdf["symbol"].iloc[0], n + len(pdf)
                g = g + packed_sums(np.vstack(pdf["x"].to_numpy()).astype(float), pdf["y"].to_numpy(dtype=float))
        if n:
            yield pd.DataFrame([(symbol, *solve_one(symbol, n, g))], columns=names)

    names = [f.split()[0] for f in schema.split(", ")]
    return df.where(F.col("symbol").isNotNull()).select("symbol", "x", "y").groupBy("symbol").applyInPandas(run, schema)


def gram_by_sums(df: DataFrame, k: int, x: str = "x", y: str = "y") -> DataFrame:
    """The packed sums of a small system (k of a few) by built-in aggregates, without Python."""
    cols = [F.element_at(x, i + 1) for i in range(k)]
    terms = [cols[i] * cols[j] for i in range(k) for j in range(i, k)] + [c * F.col(y) for c in cols] + [F.col(y) * F.col(y)]
    sums = df.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), *[F.sum(t).alias(f"s{i}") for i, t in enumerate(terms)])
    return sums.select("symbol", "n", F.array(*[f"s{i}" for i in range(len(terms))]).alias("g"))


def scaled_lstsq(a: np.ndarray, b: np.ndarray, means: np.ndarray | None = None) -> np.ndarray:
    """Minimum-norm solution of the normal equations a·beta = b with rows and columns divided
    by their standard deviations first, so that no column is cut off for its unit alone.

    A column without variance (relative to its mean, where given) gets coefficient 0.
    """
    d = np.sqrt(np.maximum(np.diag(a), 0.0))
    floor = 0.0 if means is None else 1e-10 * np.abs(means)
    live = d > floor
    beta = np.zeros(len(b))
    if live.any():
        s = d[live]
        m, c = a[np.ix_(live, live)] / np.outer(s, s), b[live] / s
        try:  # a system far from singular needs no singular values
            regular = np.diag(np.linalg.cholesky(m)).min() > 1e-3
        except np.linalg.LinAlgError:
            regular = False
        beta[live] = (np.linalg.solve(m, c) if regular else np.linalg.lstsq(m, c, rcond=None)[0]) / s
    return beta


SOLUTION = "symbol string, n_train long, coef array<double>, sigma double, error string"


def unpacked(g: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """X'X, X'y and y'y."""
    m = k * (k + 1) // 2
    a = np.zeros((k, k))
    a[np.triu_indices(k)] = g[:m]
    return a + np.triu(a, 1).T, g[m:m + k], float(g[m + k])


def solver(k: int, penalty: list[float] | None = None, min_rows: int | None = None) -> Callable:
    """(n, coef, sigma, error) from packed sums by ridge/OLS. ``penalty[i]`` adds to X'X[i,i].

    Rank-deficient systems take the minimum-norm solution (a constant column
    gets coefficient 0). ``sigma`` is the residual standard deviation.
    """
    pen = np.zeros(k) if penalty is None else np.asarray(penalty, dtype=float)
    need = (k + 1) if min_rows is None else min_rows

    def one(_symbol, n, g):
        if n < need:
            return int(n), None, None, f"insufficient rows: {int(n)} < {need}"
        a, b, yy = unpacked(np.asarray(g, dtype=float), k)
        beta = scaled_lstsq(a + np.diag(pen), b)
        rss = max(yy - 2 * beta @ b + beta @ a @ beta, 0.0)
        return int(n), beta.tolist(), float(np.sqrt(rss / max(n - k, 1))), None

    return one


def solve(gram: DataFrame, k: int, penalty: list[float] | None = None, min_rows: int | None = None) -> DataFrame:
    """``solver`` on a table of packed sums ``(symbol, n, g)``."""
    one = solver(k, penalty, min_rows)

    def fn(batches):
        for pdf in batches:
            yield pd.DataFrame([(s, *one(s, n, g)) for s, n, g in zip(pdf["symbol"], pdf["n"], pdf["g"])],
                               columns=["symbol", "n_train", "coef", "sigma", "error"])

    return gram.mapInPandas(fn, SOLUTION)


def fit_least_squares(df: DataFrame, k: int, x: str = "x", y: str = "y",
                      penalty: list[float] | None = None, min_rows: int | None = None) -> DataFrame:
    """Per-symbol (ridge) least squares of ``y`` on ``x: array<double>[k]``."""
    if k <= 8:
        return solve(gram_by_sums(df, k, x, y), k, penalty, min_rows)
    return solve_gram(df.select("symbol", F.col(x).alias("x"), F.col(y).alias("y")), solver(k, penalty, min_rows), SOLUTION)
