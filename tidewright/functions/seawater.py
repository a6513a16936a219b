"""Practical salinity (PSS-78) and sea pressure, as native polynomials.

Sources: Fofonoff & Millard (1983), UNESCO Technical Paper 44; Hill, Dauphinee &
Woods (1986) for salinities below 2; the TEOS-10 manual (IOC et al., 2010) for
the specific volume at standard salinity and 0 degrees.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: PSS-78 coefficients, lowest power first ---------------------
SAL_A = [0.0080, -0.1692, 25.3851, 14.0941, -7.0261, 2.7081]
SAL_B = [0.0005, -0.0056, -0.0066, -0.0375, 0.0636, -0.0144]
RT_C = [0.6766097, 2.00564e-2, 1.104259e-4, -6.9698e-7, 1.0031e-9]
RP_E = [2.070e-5, -6.370e-10, 3.989e-15]
RP_T = [1.0, 3.426e-2, 4.464e-4]
RP_R = [4.215e-1, -3.107e-3]
F_K = 0.0162
ITS90_TO_IPTS68 = 1.00024
#: 1 / C(35, 15, 0) in (mS/cm)^-1
R_PER_C = 0.023302418791070513

#: Factor that makes the low-salinity branch continuous at 2, less one, as a
#: polynomial in the temperature term: 2 / (uncorrected branch at 2), fitted over
#: -5..45 degrees with a residual below 4e-13.
LOW_SALINITY_JOIN = [
    4.705521088436322e-06,
    8.414860841294885e-06,
    -9.141955200698634e-09,
    1.3964892205617014e-12,
    1.2339417049306374e-15,
]

# ---- fixed values: gravity and specific volume ---------------------------------
GRAVITY = [1.0, 5.2792e-3, 2.32e-5]
GRAVITY_EQUATOR = 9.780327
GRAVITY_DEPTH = 2.26e-7
#: specific volume at standard salinity and 0 degrees, in powers of p / 1e4 dbar
SPECIFIC_VOLUME = [
    9.726613854843870e-4,
    -4.505913211160929e-5,
    7.130728965927127e-6,
    -6.657179479768312e-7,
]


def _poly(coefs: list[float], x: str) -> str:
    """Horner form of a polynomial in ``x`` as SQL text, lowest power first."""
    return reduce(lambda acc, c: f"({acc} * {x} + {c!r}D)", reversed(coefs[:-1]), f"{coefs[-1]!r}D")


def add_practical_salinity(
    df: DataFrame, conductivity: str, temperature: str, pressure_dbar: str, name: str = "salinity"
) -> DataFrame:
    """Add practical salinity from conductivity (S/m), temperature and sea pressure.

    A negative conductivity ratio or salinity gives NULL.  The intermediate
    quantities are columns of their own, so each is computed once and the
    expressions stay small.
    """
    p = pressure_dbar
    rp = f"1D + {p} * {_poly(RP_E, p)} / ({_poly(RP_T, '_t68')} + {_poly(RP_R, '_t68')} * _r)"
    low = (
        f"_sal - {SAL_A[0]!r}D / {_poly([1.0, 1.5, 1.0], '(400D * _x * _x)')}"
        f" - {SAL_B[0]!r}D * _ft / {_poly([1.0, 1.0, 1.0, 1.0], '(10D * _x)')}"
    )
    steps = [
        {"_t68": f"{ITS90_TO_IPTS68!r}D * {temperature}", "_r": f"{10.0 * R_PER_C!r}D * {conductivity}"},
        {"_ft": f"(_t68 - 15D) / (1D + {F_K!r}D * (_t68 - 15D))", "_rt": f"_r / (({rp}) * {_poly(RT_C, '_t68')})"},
        {"_x": "sqrt(CASE WHEN _rt >= 0D THEN _rt END)"},
        {"_sal": f"{_poly(SAL_A, '_x')} + _ft * {_poly(SAL_B, '_x')}"},
        {"_sal": f"CASE WHEN _sal >= 2D THEN _sal ELSE ({low}) * (1D + {_poly(LOW_SALINITY_JOIN, '_ft')}) END"},
        {name: "CASE WHEN _sal >= 0D THEN _sal END"},
    ]
    for step in steps:
        df = df.withColumns({c: F.expr(e) for c, e in step.items()})
    return df.drop("_t68", "_r", "_ft", "_rt", "_x", "_sal")


def pressure_from_depth(depth_m: str, latitude: str) -> Column:
    """Sea pressure (dbar) at ``depth_m`` metres below the surface.

    The hydrostatic balance is solved by one Newton step from the constant-volume
    solution: exact to 1e-8 dbar down to 100 m.
    """
    sin2 = f"pow(sin(radians({latitude})), 2D)"
    head = (
        f"({GRAVITY_EQUATOR!r}D * {_poly(GRAVITY, sin2)}"
        f" * ({depth_m} + {0.5 * GRAVITY_DEPTH!r}D * {depth_m} * {depth_m}))"
    )
    start = f"({head} / {1e4 * SPECIFIC_VOLUME[0]!r}D)"
    z = f"({start} * 1e-4D)"
    enthalpy = f"1e8D * {z} * {_poly([c / (i + 1) for i, c in enumerate(SPECIFIC_VOLUME)], z)}"
    return F.expr(f"{start} - ({enthalpy} - {head}) / (1e4D * {_poly(SPECIFIC_VOLUME, z)})")
