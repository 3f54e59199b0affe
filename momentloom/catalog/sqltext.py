"""Pieces of DuckDB SQL that recur in the checks. They share no code with what they check."""

from __future__ import annotations

from collections.abc import Sequence


def rd(x: str, digits: int = 6) -> str:
    """Round half up to decimals, by the same arithmetic as the engine."""
    return f"(floor(({x})::double*1e{digits} + 0.5e0)/1e{digits})"


def rs(x: str, digits: int = 8) -> str:
    """Round half up to significant digits."""
    m = f"pow(10e0, {digits - 1}e0 - floor(log10(abs(({x})::double))))"
    return f"(case when ({x}) = 0 then 0e0 else floor(({x})::double*{m} + 0.5e0)/{m} end)"


def hash32(key: str, seed: int | str) -> str:
    return f"cast('0x'||substr(md5(cast({key} as varchar)||':{seed}'),1,8) as bigint)"


def uniform(key: str, seed: int | str) -> str:
    return f"(({hash32(key, seed)} + 0.5e0) / 4294967296e0)"


def normal(key: str, seed: int | str) -> str:
    return f"(sqrt(-2e0*ln({uniform(key, f'{seed}a')}))*cos(6.283185307179586e0*{uniform(key, f'{seed}b')}))"


def total(a: str) -> str:
    """Sum of a list in list order."""
    return f"list_reduce(list_prepend(0e0, ({a})::double[]), lambda u, v: u + v)"


def eliminate(source: str, size: int, keys: Sequence[str], tag: str) -> tuple[str, str]:
    """Gauss-Jordan elimination, one step per CTE, on columns ``m_i_j`` (j = size is the right side).

    Returns the CTE texts and the name of the last, where ``m_i_size`` is the solution. No pivoting:
    for positive definite systems.
    """
    texts, name = [], source
    for k in range(size):
        cols = list(keys)
        for i in range(size):
            for j in range(k + 1, size + 1):
                value = f"m_{k}_{j}/m_{k}_{k}" if i == k else f"m_{i}_{j} - m_{i}_{k}*m_{k}_{j}/m_{k}_{k}"
                cols.append(f"{value} as m_{i}_{j}")
        step = f"{tag}{k}"
        texts.append(f"{step} as (select {', '.join(cols)} from {name})")
        name = step
    return ",\n".join(texts), name


def covariances(source: str, cols: Sequence[str], keys: Sequence[str], name: str) -> str:
    """One row per key with count, means ``a_i`` and population covariances ``v_i_j`` (i <= j)."""
    items = list(keys) + ["count(*)::double as n"] + [f"avg({c}) as a_{i}" for i, c in enumerate(cols)]
    items += [f"covar_pop({a}, {b}) as v_{i}_{j}" for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j]
    group = f" group by {', '.join(keys)}" if keys else ""
    return f"{name} as (select {', '.join(items)} from {source}{group})"


def regression(
    source: str, xs: Sequence[int], y: int, keys: Sequence[str], tag: str, lam: float = 0.0, standardized: bool = False
) -> tuple[str, str]:
    """Coefficients from a ``covariances`` CTE, for the columns at positions ``xs``.

    The last CTE has ``b_j`` for each position and ``b0``. ``lam`` is per row, on the coefficients
    or on those of standardised columns.
    """
    v = lambda i, j: f"v_{min(i, j)}_{max(i, j)}"
    items = list(keys)
    for i, p in enumerate(xs):
        for j, q in enumerate(xs):
            plus = ""
            if i == j and lam:
                plus = f" + {lam!r}*{v(p, p)}*n/(n-1)" if standardized else f" + {lam!r}"
            items.append(f"{v(p, q)}{plus} as m_{i}_{j}")
        items.append(f"{v(p, y)} as m_{i}_{len(xs)}")
    start = f"{tag}s as (select {', '.join(items)} from {source})"
    steps, last = eliminate(f"{tag}s", len(xs), keys, tag)
    joined = " and ".join(f"c.{k} = e.{k}" for k in keys) or "true"
    coefs = [f"e.m_{i}_{len(xs)} as b_{p}" for i, p in enumerate(xs)]
    constant = " - ".join([f"c.a_{y}"] + [f"e.m_{i}_{len(xs)}*c.a_{p}" for i, p in enumerate(xs)])
    out = [f"c.{k}" for k in keys] + coefs + [f"{constant} as b0"]
    final = f"{tag}f as (select {', '.join(out)} from {source} c join {last} e on {joined})"
    return ",\n".join([start, steps, final]), f"{tag}f"


def newton(source: str, xs: Sequence[str], y: str, tag: str, steps: int = 9, key: str = "k") -> tuple[str, str]:
    """Logistic regression by unrolled Newton steps, one fit per value of ``key`` in ``source``.

    ``source`` has the rows of each fit. The last CTE has the key and ``w0`` (intercept), ``w1``, ...
    """
    d = len(xs) + 1
    inputs = ["1e0", *xs]
    texts = [f"{tag}b0 as (select distinct {key}, {', '.join(f'0e0 as w{i}' for i in range(d))} from {source})"]
    for s in range(steps):
        z = " + ".join(f"b.w{i}*({c})" for i, c in enumerate(inputs))
        texts.append(f"{tag}p{s} as (select d.*, 1e0/(1e0+exp(-({z}))) as p_ from {source} d join {tag}b{s} b using ({key}))")
        sums = [f"sum(p_*(1e0-p_)*({a})*({b})) as m_{i}_{j}" for i, a in enumerate(inputs) for j, b in enumerate(inputs)]
        sums += [f"sum((({y})-p_)*({a})) as m_{i}_{d}" for i, a in enumerate(inputs)]
        texts.append(f"{tag}h{s} as (select {key}, {', '.join(sums)} from {tag}p{s} group by {key})")
        chain, last = eliminate(f"{tag}h{s}", d, [key], f"{tag}q{s}_")
        texts.append(chain)
        moved = ", ".join(f"b.w{i} + e.m_{i}_{d} as w{i}" for i in range(d))
        texts.append(f"{tag}b{s + 1} as (select {key}, {moved} from {tag}b{s} b join {last} e using ({key}))")
    return ",\n".join(texts), f"{tag}b{steps}"
