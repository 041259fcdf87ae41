"""Equilibrium arguments, nodal corrections and inferred minor constituents of the tide, as column expressions.

V(t) of a constituent is the sum of its Doodson numbers times six longitudes: mean lunar time tau, moon s, sun h, lunar perigee
p, the node N' = -N and solar perigee ps, and a constant phase. The longitudes are polynomials of time, so V stays right
over centuries, which a speed times a span does not. A compound constituent is a sum of others: its Doodson numbers and
its nodal angle are sums, its nodal factor is a product.

Time is days since EPOCH in UTC; the minute between UTC and dynamical time is left out (the moon moves 0.01 degrees in it).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Days from EPOCH (1992-01-01) to noon of 2000-01-01, from which Julian centuries count.
J2000_DAYS, CENTURY = 2922.5, 36525.0
#: Fixed values (Meeus 1998; Simon et al. 1994 for ps): degrees, by powers of Julian centuries.
LONGITUDES = {
    "s": (218.3164477, 481267.88123421, -0.0015786, 1 / 538841, -1 / 65194000),
    "h": (280.46646, 36000.76983, 0.0003032),
    "p": (83.3532465, 4069.0137287, -0.0103200, -1 / 80053, 1 / 18999000),
    "n": (125.0445479, -1934.1362891, 0.0020754, 1 / 467441, -1 / 60616000),
    "ps": (282.93735, 1.71946, 0.00046),
}
#: Fixed values (Doodson 1921): multiples of tau, s, h, p, N', ps, and the phase in degrees.
DOODSON = {
    "SA": ((0, 0, 1, 0, 0, -1), 0.0),
    "SSA": ((0, 0, 2, 0, 0, 0), 0.0),
    "MM": ((0, 1, 0, -1, 0, 0), 0.0),
    "MSF": ((0, 2, -2, 0, 0, 0), 0.0),
    "MF": ((0, 2, 0, 0, 0, 0), 0.0),
    "MTM": ((0, 3, 0, -1, 0, 0), 0.0),
    "MSQM": ((0, 4, -2, 0, 0, 0), 0.0),
    "2Q1": ((1, -3, 0, 2, 0, 0), 270.0),
    "SIGMA1": ((1, -3, 2, 0, 0, 0), 270.0),
    "Q1": ((1, -2, 0, 1, 0, 0), 270.0),
    "RHO1": ((1, -2, 2, -1, 0, 0), 270.0),
    "O1": ((1, -1, 0, 0, 0, 0), 270.0),
    "CHI1": ((1, 0, 2, -1, 0, 0), 90.0),
    "PI1": ((1, 1, -3, 0, 0, 1), 270.0),
    "P1": ((1, 1, -2, 0, 0, 0), 270.0),
    "S1": ((1, 1, -1, 0, 0, 0), 180.0),
    "K1": ((1, 1, 0, 0, 0, 0), 90.0),
    "PHI1": ((1, 1, 2, 0, 0, 0), 90.0),
    "THETA1": ((1, 2, -2, 1, 0, 0), 90.0),
    "J1": ((1, 2, 0, -1, 0, 0), 90.0),
    "OO1": ((1, 3, 0, 0, 0, 0), 90.0),
    "EPS2": ((2, -3, 2, 1, 0, 0), 0.0),
    "2N2": ((2, -2, 0, 2, 0, 0), 0.0),
    "MU2": ((2, -2, 2, 0, 0, 0), 0.0),
    "N2": ((2, -1, 0, 1, 0, 0), 0.0),
    "NU2": ((2, -1, 2, -1, 0, 0), 0.0),
    "M2": ((2, 0, 0, 0, 0, 0), 0.0),
    "LAMBDA2": ((2, 1, -2, 1, 0, 0), 180.0),
    "L2": ((2, 1, 0, -1, 0, 0), 180.0),
    "T2": ((2, 2, -3, 0, 0, 1), 0.0),
    "S2": ((2, 2, -2, 0, 0, 0), 0.0),
    "R2": ((2, 2, -1, 0, 0, -1), 180.0),
    "K2": ((2, 2, 0, 0, 0, 0), 0.0),
    "ETA2": ((2, 3, 0, -1, 0, 0), 0.0),
    "M3": ((3, 0, 0, 0, 0, 0), 0.0),
}
#: Compound constituents as multiples of others.
COMPOUND = {
    "MKS2": {"M2": 1, "K2": 1, "S2": -1},
    "2SM2": {"S2": 2, "M2": -1},
    "MK3": {"M2": 1, "K1": 1},
    "2MK3": {"M2": 2, "K1": -1},
    "N4": {"N2": 2},
    "MN4": {"M2": 1, "N2": 1},
    "M4": {"M2": 2},
    "MS4": {"M2": 1, "S2": 1},
    "S4": {"S2": 2},
    "M6": {"M2": 3},
    "S6": {"S2": 3},
    "M8": {"M2": 4},
}
#: Fixed values (Doodson and Warburg 1941, Schureman 1958, Pugh 1987): f = a + b cos N, u = c sin N, c in degrees.
NODAL = {
    "MM": (1.0, -0.130, 0.0),
    "MF": (1.043, 0.414, -23.7),
    "Q1": (1.009, 0.187, 10.8),
    "O1": (1.009, 0.187, 10.8),
    "K1": (1.006, 0.115, -8.9),
    "J1": (1.013, 0.168, -12.9),
    "OO1": (1.103, 0.650, -36.7),
    "2N2": (1.0, -0.037, -2.1),
    "MU2": (1.0, -0.037, -2.1),
    "N2": (1.0, -0.037, -2.1),
    "NU2": (1.0, -0.037, -2.1),
    "M2": (1.0, -0.037, -2.1),
    "K2": (1.024, 0.286, -17.7),
    "M3": (1.0, -0.056, -3.2),
}
#: Constituents corrected like another of the same origin.
NODAL_LIKE = {
    "2Q1": "O1", "SIGMA1": "O1", "RHO1": "O1", "CHI1": "J1", "THETA1": "J1", "EPS2": "M2", "LAMBDA2": "M2", "L2": "M2", "ETA2": "K2",
    "MTM": "MF", "MSQM": "MF", "MSF": "M2",
}
#: Fixed values (Cartwright and Edden 1973): size of each line of the tidal potential, by species.
POTENTIAL = {
    1: {
        "2Q1": 0.00664, "SIGMA1": 0.00802, "Q1": 0.05020, "RHO1": 0.00954, "O1": 0.26221, "CHI1": 0.00394, "PI1": 0.00714, "P1": 0.12203,
        "K1": 0.36878, "PHI1": 0.00525, "THETA1": 0.00394, "J1": 0.02062, "OO1": 0.01128,
    },
    2: {
        "EPS2": 0.00467, "2N2": 0.01601, "MU2": 0.01932, "N2": 0.12099, "NU2": 0.02298, "M2": 0.63192, "LAMBDA2": 0.00466, "L2": 0.01786,
        "T2": 0.01720, "K2": 0.07996, "ETA2": 0.00447,
    },
}
#: Constituents at whose frequencies the admittance is taken as known, where the grid has them. S2 is partly due to the sun's warmth.
KNOTS = {1: ("Q1", "O1", "K1"), 2: ("N2", "M2", "K2")}


@dataclass(frozen=True)
class Constituent:
    name: str
    doodson: tuple[int, ...]
    phase: float
    #: multiples of constituents of NODAL that make f (product) and u (sum)
    nodal: tuple[tuple[str, int], ...]

    @cached_property
    def speed(self) -> float:
        """Degrees an hour at J2000."""
        rate = {k: v[1] / (CENTURY * 24) for k, v in LONGITUDES.items()}
        return sum(d * r for d, r in zip(self.doodson, (15 + rate["h"] - rate["s"], rate["s"], rate["h"], rate["p"], -rate["n"], rate["ps"]), strict=True))


def constituent(name: str) -> Constituent | None:
    """A constituent of DOODSON or COMPOUND by name, in any case; None for any other."""
    key = name.upper()
    if key in DOODSON:
        like = NODAL_LIKE.get(key, key)
        return Constituent(key, *DOODSON[key], ((like, 1),) if like in NODAL else ())
    if key in COMPOUND:
        parts = [(constituent(k), n) for k, n in COMPOUND[key].items()]
        numbers = tuple(sum(n * c.doodson[i] for c, n in parts) for i in range(6))
        return Constituent(key, numbers, sum(n * c.phase for c, n in parts) % 360, tuple((k, n) for c, n in parts for k, _ in c.nodal))
    return None


def longitudes(days: Column) -> dict[str, Column]:
    """s, h, p, n and ps in degrees, not reduced to a turn."""
    t = (days - J2000_DAYS) / CENTURY
    out = {}
    for name, terms in LONGITUDES.items():
        value = F.lit(terms[-1])
        for term in reversed(terms[:-1]):  # by Horner's rule
            value = value * t + term
        out[name] = value
    return out


def doodson_longitudes(days: Column) -> Column:
    """Array of tau, s, h, p, N' and ps in degrees, tau and s to full turns only where that keeps digits."""
    at = longitudes(days)
    hours = (days - F.floor(days)) * 24
    return F.array(15 * hours + at["h"] - at["s"], at["s"], at["h"], at["p"], -at["n"], at["ps"])


NODAL_TYPE = "array<struct<a: double, b: double, c: double, times: int>>"


def rows(names: list[str]) -> dict[str, tuple]:
    """By name: name, Doodson numbers, phase, and the nodal terms (a, b, c and multiple of each factor); an error for unknown ones."""
    found = {n: constituent(n) for n in names}
    if unknown := sorted(n for n, c in found.items() if c is None):
        raise ValueError(f"no Doodson numbers for {', '.join(unknown)}")
    return {n: (n, list(c.doodson), c.phase, [(*NODAL[k], m) for k, m in c.nodal]) for n, c in found.items()}


def table(spark: SparkSession, names: list[str]) -> DataFrame:
    """name, doodson, phase and nodal of the named constituents."""
    return spark.createDataFrame(list(rows(names).values()), f"name string, doodson array<int>, phase double, nodal {NODAL_TYPE}")


def argument(doodson: Column, phase: Column, longitude: Column) -> Column:
    """V in degrees, from Doodson numbers and ``doodson_longitudes``."""
    return F.aggregate(F.zip_with(doodson, longitude, lambda d, x: d * x), phase, lambda a, x: a + x)


def nodal_factor(nodal: Column, n: Column) -> Column:
    """f, from the nodal terms of ``table`` and the node's longitude; 1 without terms."""
    return F.aggregate(nodal, F.lit(1.0), lambda f, t: f * F.pow(t["a"] + t["b"] * F.cos(F.radians(n)), F.abs(t["times"])))


def nodal_angle(nodal: Column, n: Column) -> Column:
    """u in degrees; 0 without terms."""
    return F.aggregate(nodal, F.lit(0.0), lambda u, t: u + t["times"] * t["c"] * F.sin(F.radians(n)))


def inferred(known: list[str]) -> list[tuple[str, str, float]]:
    """(constituent, target, coefficient): what each known constituent's constants give to itself and to minor ones.

    The admittance is the constants over the potential, a smooth function of frequency within a species. It is
    interpolated linearly in speed between the neighbouring KNOTS that the grid has, and taken from the nearest beyond
    them; a species with fewer than two knots gives no minor constituents. A minor constituent's constants are therefore a
    fixed sum of those of two known ones, and the constituents that the grid has are left as they are.
    """
    own = {n.upper(): n for n in known}
    out = [(n, n, 1.0) for n in known]
    for species, lines in POTENTIAL.items():
        knots = sorted((constituent(k).speed, k) for k in KNOTS[species] if k in own)
        if len(knots) < 2:
            continue
        for name, size in lines.items():
            if name in own:
                continue
            speed = min(max(constituent(name).speed, knots[0][0]), knots[-1][0])
            (low, a), (high, b) = next((x, y) for x, y in zip(knots, knots[1:], strict=False) if speed <= y[0])
            part = (speed - low) / (high - low)
            out += [(own[k], name, w * size / lines[k]) for k, w in ((a, 1 - part), (b, part)) if w]
    return out
