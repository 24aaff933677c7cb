"""Exact quantiles of many columns without sorting or collecting a column.

``percentile``/``median`` keep a value->count map of the whole column in one
aggregation buffer, and a global sort shuffles every value. Here the wanted
ranks are bracketed and the brackets narrowed:

1. the values between a bracket's ends are summarised in a mergeable quantile
   sketch (KLL), one for each bracket however many ranks it holds. Sketches
   are merged in two levels, by groups of partitions and then over the groups:
   of 400,000 partitions no task reads more than about 640 of them;
2. the sketch gives a narrower bracket around every rank (neighbouring ranks
   share one), and one aggregate counts the values below, at and between its
   ends, so a rank at an end is found and every other is known to lie between;
3. once few values (``collect_limit``) lie between the ends, their distinct
   values and counts are fetched, in a job beside the counting one.

A bracket shrinks some 300 times a round: a column of 1e6 values takes two
steps of scans, 1e12 values about five; no row is exploded by column, and the
driver receives at most ``collect_limit`` distinct values a bracket. Sketches
only propose brackets: a rank that the counts do not confirm is bracketed again
with a wider margin, so results are exact. Only order matters, so infinities
and any span of values are handled. NaN and null are ignored (missing).
"""

from __future__ import annotations

import math
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Groups of partitions whose sketches are merged first (the root of some 400,000 partitions), size of a sketch
#: (about 3 * K doubles), and the share of values taken to each side of a rank: well above the sketch's
#: normalized rank error (0.16 % at this size, 99 % confidence).
GROUPS, SKETCH_K, MARGIN = 640, 2048, 0.003


def _value(col: str) -> Column:
    x = F.col(col).cast("double")
    return F.when(~F.isnan(x), x)


def column_counts(df: DataFrame, cols: list[str]) -> dict[str, tuple[int, float, float]]:
    """(count, min, max) of the non-missing values per column, one job."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols)}


def _inside(x: Column, lo: float | None, hi: float | None) -> Column:
    """Strictly between the ends (None: no end)."""
    cond = x.isNotNull()
    if lo is not None:
        cond = cond & (x > F.lit(lo)) & (x < F.lit(hi))
    return cond


def _values(df: DataFrame, cols: list[str]) -> tuple[DataFrame, dict[str, Column]]:
    """The columns' values alone, each worked out once a row."""
    names = {c: f"x{j}" for j, c in enumerate(dict.fromkeys(cols))}
    return df.select(*[_value(c).alias(n) for c, n in names.items()]), {c: F.col(n) for c, n in names.items()}


def _fetch(df: DataFrame, intervals: list[tuple]) -> dict[tuple, list]:
    """Sorted (value, count) of the values inside each (column, lo, hi); one scan."""
    df, at = _values(df, [c for c, *_ in intervals])
    hits = F.filter(F.array(*[F.struct(F.lit(j).alias("iv"), F.when(_inside(at[c], lo, hi), at[c]).alias("x"))
                              for j, (c, lo, hi) in enumerate(intervals)]), lambda v: v["x"].isNotNull())
    rows = df.select(F.explode(hits).alias("h")).groupBy("h.iv", "h.x").agg(F.count(F.lit(1)).alias("n")).collect()
    out: dict[tuple, list] = defaultdict(list)
    for r in rows:
        out[intervals[r["iv"]]].append((r["x"], r["n"]))
    return {k: sorted(v) for k, v in out.items()}


def merged_sketches(df: DataFrame, values: list[Column], k: int = SKETCH_K, groups: int | None = None) -> DataFrame:
    """One row (s0, s1, ...): a sketch of each value over all rows, merged by
    groups of partitions first: of P partitions' sketches a task reads at most
    P / groups, the last one ``groups``."""
    names = [f"s{i}" for i in range(len(values))]
    first = df.groupBy((F.spark_partition_id() % (groups or GROUPS)).alias("_g")).agg(
        *[F.kll_sketch_agg_double(v, F.lit(k)).alias(n) for n, v in zip(names, values)])
    return first.agg(*[F.kll_merge_agg_double(F.col(n), F.lit(k)).alias(n) for n in names])


def sketch_quantiles(df: DataFrame, values: list[Column], shares: list[list[float]]) -> list[list[float]]:
    """Approximate quantiles of each value at its shares."""
    sketches = merged_sketches(df, values)
    asked = [F.when(F.kll_sketch_get_n_double(f"s{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", F.array(*[F.lit(float(p)) for p in ps])))
             for i, ps in enumerate(shares)]
    row = sketches.select(*[q.alias(f"q{i}") for i, q in enumerate(asked)]).first()
    return [list(row[f"q{i}"] or ()) for i in range(len(values))]


def _joined(ends: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Overlapping or touching (lo, hi) as one."""
    out: list[tuple[float, float]] = []
    for a, b in sorted(ends):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _counted(df: DataFrame, brackets: list[tuple]) -> list[tuple[int, int, int, int]]:
    """For each (column, lo, hi, a, b) the values inside (lo, hi) that are
    below a, at a, strictly between, and at b (0 if a is b); one scan."""
    aggs = []
    df, at = _values(df, [c for c, *_ in brackets])
    for i, (c, lo, hi, a, b) in enumerate(brackets):
        x, own = at[c], _inside(at[c], lo, hi)
        aggs += [F.count_if(own & (x < F.lit(a))).alias(f"l{i}"), F.count_if(own & (x == F.lit(a))).alias(f"a{i}"),
                 F.count_if(own & (x > F.lit(a)) & (x < F.lit(b))).alias(f"m{i}"), F.count_if(own & (x == F.lit(b))).alias(f"z{i}")]
    r = df.agg(*aggs).first()
    return [(r[f"l{i}"], r[f"a{i}"], r[f"m{i}"], r[f"z{i}"] if b != a else 0) for i, (*_, a, b) in enumerate(brackets)]


def _at_rank(values: list[tuple], rank: int) -> float:
    """The value at a 0-based rank of sorted (value, count)."""
    for x, n in values:
        rank -= n
        if rank < 0:
            return x
    raise RuntimeError("fewer values than counted: the table changed between scans")


def order_statistics(df: DataFrame, wanted: dict[str, list[int]], stats: dict[str, tuple[int, float, float]],
                     collect_limit: int = 20000, margin: float = MARGIN, first: dict | None = None) -> dict[tuple[str, int], float]:
    """Values at 0-based ranks ``wanted[col]`` among non-missing values.
    ``first``: approximate quantiles {(col, rank): (below, above)} already
    known for the whole column (else sketched here)."""
    done: dict[tuple[str, int], float] = {}
    # rank -> (lo, hi, values at or below lo, values strictly between)
    todo: dict[tuple[str, int], tuple] = {}
    for c, ranks in wanted.items():
        n, lo, hi = stats[c]
        for k in ranks:
            if not 0 <= k < n:
                raise ValueError(f"rank {k} outside 0..{n - 1} for {c}")
            if lo == hi:
                done[(c, k)] = lo
            else:
                todo[(c, k)] = (None, None, 0, n)
    pool = ThreadPoolExecutor(max_workers=2)
    try:
        while todo:
            few = {key: v for key, v in todo.items() if v[3] <= collect_limit}
            if few:
                intervals = sorted({(key[0], v[0], v[1]) for key, v in few.items()}, key=str)
                values = _fetch(df, intervals)
                for key, (lo, hi, below, _n) in few.items():
                    done[key] = _at_rank(values[(key[0], lo, hi)], key[1] - below)
                    del todo[key]
                continue
            # a narrower bracket around every rank, one sketch for each interval
            within: dict[tuple, list] = defaultdict(list)
            for key, (lo, hi, below, n) in todo.items():
                within[(key[0], lo, hi)].append((key, (key[1] - below + 0.5) / n))
            spans = {}
            if first and all(lo is None for _, lo, _ in within):
                spans = {key: first[key] for key in todo if key in first}
            if len(spans) < len(todo):
                shares = [[min(max(p + d * margin, 0.0), 1.0) for _, p in ps for d in (-1, 1)] for ps in within.values()]
                ends = sketch_quantiles(df, [F.when(_inside(_value(c), lo, hi), _value(c)) for c, lo, hi in within], shares)
                for ps, q in zip(within.values(), ends):
                    spans.update({key: (q[2 * j], q[2 * j + 1]) for j, (key, _) in enumerate(ps)})
            first = None
            bracket_of = {}
            for iv, ps in within.items():
                joined = _joined([spans[key] for key, _ in ps])
                for key, _ in ps:
                    bracket_of[key] = (*iv, *next((a, b) for a, b in joined if a <= spans[key][0] and spans[key][1] <= b))
            brackets = sorted(set(bracket_of.values()), key=str)
            # brackets that should hold few values are fetched while they are counted
            sizes = {(c, lo, hi): todo[ps[0][0]][3] for (c, lo, hi), ps in within.items()}
            ranks_in = {b: sum(x == b for x in bracket_of.values()) for b in brackets}
            early = [(c, a, b) for c, lo, hi, a, b in brackets
                     if a < b and sizes[(c, lo, hi)] * 2 * margin * ranks_in[(c, lo, hi, a, b)] <= collect_limit]
            fetching = pool.submit(_fetch, df, early) if early else None
            counts = dict(zip(brackets, _counted(df, brackets)))
            values = fetching.result() if fetching else {}
            missed = False
            for key, bracket in bracket_of.items():
                c, _, _, a, b = bracket
                lo, hi, below, n = todo[key]
                under, at_a, between, at_b = counts[bracket]
                at = key[1] - below - under
                if at < 0 or at >= at_a + between + at_b:
                    missed = True  # the sketch was off: again, with a wider margin
                    continue
                if at < at_a:
                    done[key] = a
                elif at >= at_a + between:
                    done[key] = b
                elif (c, a, b) in values and sum(m for _, m in values[(c, a, b)]) == between:
                    done[key] = _at_rank(values[(c, a, b)], at - at_a)
                else:
                    todo[key] = (a, b, below + under + at_a, between)
                    continue
                del todo[key]
            if missed:
                margin = min(0.5, margin * 4)
    finally:
        pool.shutdown()
    return done


def first_brackets(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float]]:
    """Per column the approximate quantiles a margin below and above each
    probability; needs no counts, so it can run beside other first passes."""
    shares = [min(max(p + d * MARGIN, 0.0), 1.0) for p in probs for d in (-1, 1)]
    return dict(zip(cols, sketch_quantiles(df, [_value(c) for c in cols], [shares] * len(cols))))


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    interpolation: str = "linear", stats: dict | None = None,
                    ends: dict[str, list[float]] | None = None, **kw) -> dict[tuple[str, float], float | None]:
    """Exact quantiles per column.

    interpolation ``"linear"``: position p*(n-1), linear between neighbours
    (SQL ``percentile``/``quantile_cont``, midpoint median).
    ``"lower"``: the smallest value whose cumulative share reaches p
    (SQL ``quantile_disc``; the lower median). ``stats`` ((count, min,
    max) per column, e.g. from a profile aggregate already run) saves the
    first pass, ``ends`` (from ``first_brackets`` over the same columns and
    probabilities) the first sketches."""
    stats = stats or column_counts(df, cols)
    wanted: dict[str, list[int]] = {}
    plan: dict[tuple[str, float], tuple] = {}
    for c in cols:
        n = stats[c][0]
        if n == 0:
            continue
        ranks = set()
        for p in probs:
            if interpolation == "lower":
                k = max(int(math.ceil(p * n)) - 1, 0)
                plan[(c, p)] = (k, k, 0.0)
                ranks.add(k)
            else:
                pos = p * (n - 1)
                k0, k1 = int(math.floor(pos)), int(math.ceil(pos))
                plan[(c, p)] = (k0, k1, pos - k0)
                ranks.update((k0, k1))
        wanted[c] = sorted(ranks)
    first = None
    if ends:
        # small columns are fetched whole; in others a margin holds both neighbours of a position
        first = {(c, k): tuple(ends[c][2 * i:2 * i + 2]) for c in wanted for i, p in enumerate(probs) for k in plan[(c, p)][:2]}
    vals = order_statistics(df, wanted, stats, first=first, **kw) if wanted else {}
    out: dict[tuple[str, float], float | None] = {}
    for c in cols:
        for p in probs:
            if (c, p) not in plan:
                out[(c, p)] = None
                continue
            k0, k1, frac = plan[(c, p)]
            a, b = vals[(c, k0)], vals[(c, k1)]
            if k0 == k1 or a == b:
                out[(c, p)] = a
            elif math.isinf(b - a) and not (math.isinf(a) or math.isinf(b)):
                out[(c, p)] = a * (1 - frac) + b * frac  # their difference is beyond the largest double
            else:
                out[(c, p)] = a + frac * (b - a)
    return out
