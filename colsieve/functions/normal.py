"""Inverse normal distribution (algorithm AS 241, PPND16) for SQL text and NumPy."""

from __future__ import annotations

import numpy as np

# Coefficients of the published algorithm AS 241 (Wichura, 1988), low order first.
CENTRAL = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3,
     1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4,
     3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4,
     5.2264952788528545610e3),
)
MIDDLE = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
     3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
     2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
     1.05075007164441684324e-9),
)
FAR = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
     2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
     2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
     2.04426310338993978564e-15),
)
# Fixed value: probabilities are kept this far from 0 and 1.
PROB_EPS = 1e-12


def _ratio(coefficients, x):
    top, bottom = (np.polynomial.polynomial.polyval(x, c) for c in coefficients)
    return top / bottom


def phi_inv(u: np.ndarray) -> np.ndarray:
    """Standard normal quantiles of ``u`` (strictly inside (0, 1))."""
    q = u - 0.5
    out = q * _ratio(CENTRAL, 0.180625 - q * q)
    edge = np.abs(q) > 0.425
    if edge.any():
        tail = np.sqrt(-np.log(np.minimum(u[edge], 1.0 - u[edge])))
        size = np.where(tail <= 5.0, _ratio(MIDDLE, tail - 1.6), _ratio(FAR, tail - 5.0))
        out[edge] = np.where(q[edge] < 0, -size, size)
    return out


def _horner(coefficients, x: str) -> str:
    text = f"{coefficients[-1]:.17e}"
    for c in reversed(coefficients[:-1]):
        text = f"({text} * {x} + {c:.17e})"
    return text


def _ratio_sql(coefficients, x: str) -> str:
    return f"({_horner(coefficients[0], x)} / {_horner(coefficients[1], x)})"


def phi_inv_sql(u: str) -> str:
    """The same quantile as one SQL expression; ``u`` must be a column name."""
    central = f"(1.80625e-1 - ({u} - 5e-1) * ({u} - 5e-1))"
    tail = f"sqrt(-ln(least({u}, 1e0 - {u})))"
    size = (
        f"CASE WHEN {tail} <= 5e0 THEN {_ratio_sql(MIDDLE, f'({tail} - 1.6e0)')} "
        f"ELSE {_ratio_sql(FAR, f'({tail} - 5e0)')} END"
    )
    return (
        f"CASE WHEN abs({u} - 5e-1) <= 4.25e-1 THEN ({u} - 5e-1) * {_ratio_sql(CENTRAL, central)} "
        f"WHEN {u} < 5e-1 THEN -({size}) ELSE ({size}) END"
    )


def normal_scores(values: np.ndarray, knots: np.ndarray) -> np.ndarray:
    """Map a column through its CDF table to normal scores; missing values become 0."""
    out = np.zeros(values.shape[0])
    seen = np.isfinite(values)
    if seen.any():
        probs = np.linspace(0.0, 1.0, knots.shape[0])
        u = np.interp(values[seen], knots, probs)
        out[seen] = phi_inv(np.clip(u, PROB_EPS, 1.0 - PROB_EPS))
    return out
