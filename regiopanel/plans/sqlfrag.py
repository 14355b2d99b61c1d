"""Shared SQL fragments for the DuckDB oracles (text codes, user panel, embeddings)."""

from __future__ import annotations

from regiopanel.plans.fixtures import EMB_DIM, EVENT_TYPES, UP_FEATURES

def code_sql(key: str, width: int = 5) -> str:
    """Text code of at least ``width`` characters; longer keys stay whole."""
    text = f"CAST({key} AS VARCHAR)"
    return f"CASE WHEN length({text}) >= {width} THEN {text} ELSE lpad({text}, {width}, '0') END"


UP_SQL = ("SELECT user_id, " + ", ".join(
    f"CAST(COUNT(CASE WHEN event_type = '{t}' THEN 1 END) AS DOUBLE) AS n_{t}" for t in EVENT_TYPES)
    + ", AVG(value) AS mean_value FROM events GROUP BY user_id")

UPZ_SQL = ("SELECT user_id, " + ", ".join(
    f"COALESCE(({c} - AVG({c}) OVER ()) / NULLIF(STDDEV_POP({c}) OVER (), 0), 0) AS {c}" for c in UP_FEATURES)
    + f" FROM ({UP_SQL})")

EMB_SQL = ("SELECT vec_id, label, " + ", ".join(
    f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i}" for i in range(EMB_DIM)) + " FROM embeddings")

EMB_LONG_SQL = " UNION ALL ".join(
    f"SELECT vec_id, label, 'x{i}' AS variable, x{i} AS value FROM ({EMB_SQL})" for i in range(EMB_DIM))


def euclid(p: str, q: str, cols: list[str]) -> str:
    return "sqrt(" + " + ".join(f"({p}.{c} - {q}.{c}) * ({p}.{c} - {q}.{c})" for c in cols) + ")"


def sqeuclid(p: str, q: str, cols: list[str]) -> str:
    return "(" + " + ".join(f"({p}.{c} - {q}.{c}) * ({p}.{c} - {q}.{c})" for c in cols) + ")"


#: Sweeps of the Jacobi recursion; a 6 x 6 matrix is diagonal to rounding after six.
JACOBI_SWEEPS = 10


def jacobi_sql(points: str, cols: list[str]) -> str:
    """CTEs of the principal components of ``points`` (a CTE name): ``eig`` (component, value) and ``vec`` (component, i, loading).

    The covariance is rotated until it is diagonal, one pair of axes a step; the
    rotations multiply up to the eigenvectors. Matrices are lists, row by row. Signs: the largest loading is positive.
    """
    d = len(cols)
    cov = ", ".join(f"COVAR_SAMP({a}, {b})" for a in cols for b in cols)
    unit = ", ".join("1.0::DOUBLE" if i == j else "0.0::DOUBLE" for i in range(d) for j in range(d))
    axes = ", ".join(f"({n}, {i}, {j})" for n, (i, j) in enumerate((i, j) for i in range(d) for j in range(i + 1, d)))
    steps = d * (d - 1) // 2
    at = lambda m, i, j: f"{m}[({i}) * {d} + ({j}) + 1]"
    turned = lambda m, row, col: (
        f"CASE WHEN {col} = p THEN c * {at(m, row, 'p')} - s * {at(m, row, 'q')} "
        f"WHEN {col} = q THEN s * {at(m, row, 'p')} + c * {at(m, row, 'q')} ELSE {at(m, row, col)} END")
    row, col = f"(x // {d})", f"(x % {d})"
    left = (f"CASE WHEN {row} = p THEN c * {at('b', 'p', col)} - s * {at('b', 'q', col)} "
            f"WHEN {row} = q THEN s * {at('b', 'p', col)} + c * {at('b', 'q', col)} ELSE {at('b', row, col)} END")
    return f"""axes(n, p, q) AS (VALUES {axes}),
jac(r, a, v) AS (
  SELECT 0, [{cov}], [{unit}] FROM {points} UNION ALL
  SELECT r + 1, [{left} FOR x IN range({d * d})], v FROM (
    SELECT r, p, q, c, s, [{turned("a", row, col)} FOR x IN range({d * d})] AS b, [{turned("v", row, col)} FOR x IN range({d * d})] AS v FROM (
      SELECT *, cos(t) AS c, sin(t) AS s FROM (
        SELECT r, a, v, p, q, 0.5 * atan2(2 * {at("a", "p", "q")}, {at("a", "q", "q")} - {at("a", "p", "p")}) AS t
        FROM jac JOIN axes ON n = r % {steps} WHERE r < {steps * JACOBI_SWEEPS})))),
diag AS (SELECT i, {at("a", "i", "i")} AS value, v FROM jac, range({d}) AS g(i) WHERE r = {steps * JACOBI_SWEEPS}),
eig AS (SELECT row_number() OVER (ORDER BY value DESC) AS component, value, i, v FROM diag),
raw AS (SELECT component, j AS i, {at("v", "j", "eig.i")} AS loading FROM eig, range({d}) AS g(j)),
vec AS (SELECT component, i, loading * SIGN(arg_max(loading, ABS(loading)) OVER (PARTITION BY component)) AS loading FROM raw)"""
