"""Distance Column functions: haversine (sphere) and the ellipsoidal geodesic (WGS-84).

The haversine is a native Column expression.  The geodesic is an Arrow-batched numpy kernel
(Vincenty's inverse; pairs on which it does not settle, near-antipodal ones, are solved by
bisection of the azimuth), so every pair of points has a distance.  ``with_geodesic`` runs it once
per distinct coordinate pair and joins the result back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: earth constants. ---------------------------------------------------------
EARTH_RADIUS_KM = 6371.0              # mean radius used by the haversine distance
WGS84_A = 6378137.0                   # semi-major axis, metres
WGS84_F = 1 / 298.257223563           # flattening
METRES_PER_MILE = 1609.344
METRES_PER_KM = 1000.0
# --- end of fixed values ------------------------------------------------------------------

WGS84_B = (1 - WGS84_F) * WGS84_A
GEODESIC_TOLERANCE = 1e-12
#: Vincenty settles within a few steps or not at all; the rest is bisected.
VINCENTY_STEPS, BISECTIONS = 20, 200

_UNITS = {"m": 1.0, "km": METRES_PER_KM, "miles": METRES_PER_MILE, "mi": METRES_PER_MILE}


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def haversine_km(lat1, lon1, lat2, lon2, ndigits: int | None = 3) -> Column:
    """Great-circle distance in km on a 6371 km sphere, rounded to ``ndigits`` decimals."""
    p1, l1, p2, l2 = (F.radians(_col(c)) for c in (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2), 2)
    # Opposite points may round above 1; NULL stays NULL, which least() alone would skip.
    s = F.when(a > 1, F.lit(1.0)).otherwise(F.sqrt(a))
    d = 2 * F.asin(s) * F.lit(EARTH_RADIUS_KM)
    return F.round(d, ndigits) if ndigits is not None else d


def _series(f, cos2a):
    """Vincenty's C: the part of the longitude that the flattening takes."""
    return f / 16 * cos2a * (4 + f * (4 - 3 * cos2a))


def _arc_metres(a, b, ss, cs, sig, c2a, c2sm):
    """The length of an arc ``sig`` of the auxiliary sphere, in metres."""
    usq = c2a * (a * a - b * b) / (b * b)
    big_a = 1 + usq / 16384 * (4096 + usq * (-768 + usq * (320 - 175 * usq)))
    big_b = usq / 1024 * (256 + usq * (-128 + usq * (74 - 47 * usq)))
    turn = c2sm + big_b / 4 * (cs * (-1 + 2 * c2sm * c2sm) - big_b / 6 * c2sm * (-3 + 4 * ss * ss) * (-3 + 4 * c2sm * c2sm))
    return b * big_a * (sig - big_b * ss * turn)


def geodesic_np(lat1, lon1, lat2, lon2):
    """WGS-84 distance in metres of numpy arrays of degrees; NaN where a coordinate is missing.
    Vincenty's inverse first, bisection for the pairs on which it has not settled."""
    import numpy as np

    a, b, f = WGS84_A, WGS84_B, WGS84_F
    lat1, lon1, lat2, lon2 = (np.asarray(x, dtype="float64") for x in (lat1, lon1, lat2, lon2))
    out = np.full(lat1.shape, np.nan)
    there = np.nonzero(~np.isnan(lat1 + lon1 + lat2 + lon2))[0]
    u1, u2 = (np.arctan((1 - f) * np.tan(np.radians(x[there]))) for x in (lat1, lat2))
    # The longitude difference in [-pi, pi].
    L = np.radians((lon2[there] - lon1[there] + 180.0) % 360.0 - 180.0)
    su1, cu1, su2, cu2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam, settled, metres = L.copy(), np.zeros(L.shape, dtype=bool), np.zeros(L.shape)
    for _ in range(VINCENTY_STEPS):
        i = np.nonzero(~settled)[0]
        if not i.size:
            break
        lm = lam[i]
        ss = np.hypot(cu2[i] * np.sin(lm), cu1[i] * su2[i] - su1[i] * cu2[i] * np.cos(lm))
        cs = su1[i] * su2[i] + cu1[i] * cu2[i] * np.cos(lm)
        sig = np.arctan2(ss, cs)
        with np.errstate(divide="ignore", invalid="ignore"):
            sa = np.where(ss == 0, 0.0, cu1[i] * cu2[i] * np.sin(lm) / ss)
            c2a = 1 - sa * sa
            c2sm = np.where(c2a == 0, 0.0, cs - 2 * su1[i] * su2[i] / c2a)
        c = _series(f, c2a)
        new = L[i] + (1 - c) * f * sa * (sig + c * ss * (c2sm + c * cs * (-1 + 2 * c2sm * c2sm)))
        same = (ss == 0) & (cs > 0)  # one point
        ok = same | ((np.abs(new - lm) < GEODESIC_TOLERANCE) & (np.abs(new) <= np.pi) & (ss > 0))
        metres[i[ok]] = np.where(same[ok], 0.0, _arc_metres(a, b, ss, cs, sig, c2a, c2sm)[ok])
        settled[i[ok]] = True
        lam[i] = new
    i = np.nonzero(~settled)[0]
    if i.size:
        metres[i] = _bisected(a, b, f, u1[i], u2[i], np.abs(L[i]))
    out[there] = metres
    return out


def _bisected(a, b, f, u1, u2, L):
    """Distances of pairs (reduced latitudes, longitude difference in [0, pi]) whose geodesic goes
    nearly half way round.  Turned so that point 1 is the farther one from the equator and not
    north of it, a geodesic that leaves it at azimuth 0 reaches latitude 2 at longitude 0, one at
    azimuth pi reaches it at longitude pi, and the longitude grows between: it is bisected."""
    import numpy as np

    swap = np.abs(u1) < np.abs(u2)
    u1, u2 = np.where(swap, u2, u1), np.where(swap, u1, u2)
    flip = np.where(u1 > 0, -1.0, 1.0)
    su1, cu1, su2, cu2 = np.sin(u1 * flip), np.cos(u1), np.sin(u2 * flip), np.cos(u2)

    def between(s1, c1, s2, c2):
        """The angle from (c1, s1) on to (c2, s2), in [0, pi]."""
        return np.arctan2(np.abs(np.maximum(0.0, c1 * s2 - s1 * c2)), c1 * c2 + s1 * s2)

    def reach(azimuth):
        sa, c1 = np.sin(azimuth) * cu1, np.cos(azimuth) * cu1  # sa: sine of the azimuth at the equator
        c2 = np.sqrt(np.maximum(0.0, c1 * c1 + (cu2 - cu1) * (cu2 + cu1)))
        sig = between(su1, c1, su2, c2)
        w = between(sa * su1, c1, sa * su2, c2)
        c2a = 1 - sa * sa
        n1, n2 = np.hypot(su1, c1), np.hypot(su2, c2)
        with np.errstate(divide="ignore", invalid="ignore"):
            c2sm = np.where((n1 == 0) | (n2 == 0), 0.0, (c1 * c2 - su1 * su2) / (n1 * n2))
        ss, cs = np.sin(sig), np.cos(sig)
        c = _series(f, c2a)
        lam = w - (1 - c) * f * sa * (sig + c * ss * (c2sm + c * cs * (-1 + 2 * c2sm * c2sm)))
        return lam, _arc_metres(a, b, ss, cs, sig, c2a, c2sm)

    lo, hi = np.zeros_like(L), np.full_like(L, np.pi)
    for _ in range(BISECTIONS):  # beyond the last bit of the azimuth
        mid = (lo + hi) / 2
        beyond = reach(mid)[0] > L
        lo, hi = np.where(beyond, lo, mid), np.where(beyond, mid, hi)
    return reach((lo + hi) / 2)[1]


def geodesic(lat1, lon1, lat2, lon2, unit: str = "m") -> Column:
    """Ellipsoidal (WGS-84) distance of every row, NULL where a coordinate is NULL; ``unit`` is one
    of m, km, miles.  Arrow-batched; ``with_geodesic`` spares repeated pairs."""
    from tripflow.functions.kernels import geodesic_m_udf

    if unit not in _UNITS:
        raise ValueError(f"unit must be one of {sorted(_UNITS)}")
    d = geodesic_m_udf(_col(lat1), _col(lon1), _col(lat2), _col(lon2)) / _UNITS[unit]
    return F.when(~F.isnan(d), d)


def with_geodesic(df: DataFrame, lat1: str, lon1: str, lat2: str, lon2: str, out: str,
                  unit: str = "m") -> DataFrame:
    """Add ``out`` = WGS-84 geodesic distance, evaluated once per distinct coordinate pair.

    Trips repeat station coordinates, so the kernel runs over the distinct
    (lat1, lon1, lat2, lon2) set (partial aggregation before the shuffle) in Arrow batches, and the
    result joins back; whether that is a broadcast is left to the size Spark measures.  Rows with a
    NULL coordinate get NULL.
    """
    cols = [lat1, lon1, lat2, lon2]
    keys = ["__gk_lat1", "__gk_lon1", "__gk_lat2", "__gk_lon2"]
    pairs = (df.select(*[F.col(c).alias(k) for c, k in zip(cols, keys)]).dropna().distinct()
             .withColumn("__gk_dist", geodesic(*keys, unit=unit)))
    cond = None
    for c, k in zip(cols, keys):
        e = df[c] == pairs[k]
        cond = e if cond is None else (cond & e)
    joined = df.join(pairs, cond, "left")
    return joined.select(*[df[c] for c in df.columns], F.col("__gk_dist").alias(out))


def null_safe(dist: Column, *coords, zero_is_missing: bool = False) -> Column:
    """0.0 when any coordinate is NULL (or, with ``zero_is_missing``, equal to 0)."""
    miss = None
    for c in coords:
        cc = _col(c)
        m = cc.isNull() | (cc == 0) if zero_is_missing else cc.isNull()
        miss = m if miss is None else (miss | m)
    return F.when(miss, F.lit(0.0)).otherwise(dist)
