"""Longitude/latitude column expressions: regions, UTM, boxes."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

KM_PER_DEGREE = 111.0

# Coarse regions as (west, south, east, north); the first box that holds a point wins.
CONTINENT_BOXES = (
    ("NorthAmerica", (-170, 12, -50, 84)),
    ("CentralAmericaCaribbean", (-95, 5, -58, 27)),
    ("SouthAmerica", (-93, -57, -32, 13)),
    ("Europe", (-25, 34, 45, 72)),
    ("Africa", (-20, -37, 52, 38)),
    ("MiddleEast", (34, 12, 63, 42)),
    ("SouthAsia", (60, 5, 98, 38)),
    ("EastAsia", (98, 18, 150, 55)),
    ("SoutheastAsia", (92, -11, 142, 21)),
    ("CentralAsiaRussia", (45, 40, 180, 78)),
    ("Oceania", (110, -50, 180, -10)),
)

# The box inside which the yearly crop-type map is used, and its first year.
CROP_TYPE_BOX = (-125.0, 24.0, -66.5, 50.0)
CROP_TYPE_FIRST_YEAR = 2008


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def in_box(lon, lat, box) -> Column:
    west, south, east, north = box
    return _col(lon).between(west, east) & _col(lat).between(south, north)


def continent_of(lon, lat) -> Column:
    """Coarse region of a point; bounds inclusive, box order is part of the meaning."""
    label = None
    for name, box in CONTINENT_BOXES:
        hit = in_box(lon, lat, box)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label.otherwise("Other")


def utm_epsg(lon, lat) -> Column:
    zone = F.floor((_col(lon) + 180.0) / 6.0).cast("int") + 1
    return (F.when(_col(lat) >= 0, 32600).otherwise(32700) + zone).cast("int")


def pad_bbox_km(west, south, east, north, km: float) -> Column:
    """Grow a box by ``km`` on each side; the longitude pad follows the middle latitude."""
    west, south, east, north = map(_col, (west, south, east, north))
    dlat = km / KM_PER_DEGREE
    shrink = F.greatest(F.cos(F.radians((south + north) / 2.0)), F.lit(0.1))
    dlon = F.lit(km) / (KM_PER_DEGREE * shrink)
    return F.struct(
        (west - dlon).alias("w"), (south - dlat).alias("s"),
        (east + dlon).alias("e"), (north + dlat).alias("n"),
    )


def boxes_overlap(a: tuple, b: tuple) -> Column:
    """Closed overlap of two (w, s, e, n) tuples of columns."""
    aw, as_, ae, an = map(_col, a)
    bw, bs, be, bn = map(_col, b)
    return (aw <= be) & (ae >= bw) & (as_ <= bn) & (an >= bs)


def cropland_source(lon, lat, year) -> Column:
    """Which cropland map serves a place and year: (kind, product, product_year)."""
    year = _col(year).cast("int")
    typed = in_box(lon, lat, CROP_TYPE_BOX)
    early = year <= 2020
    crop_year = F.greatest(year, F.lit(CROP_TYPE_FIRST_YEAR))
    return F.struct(
        F.when(typed, "cdl").otherwise("worldcover").alias("kind"),
        F.when(typed, F.concat(F.lit("CDL"), crop_year.cast("string")))
        .when(early, "v100-WorldCover").otherwise("v200-WorldCover").alias("product"),
        F.when(typed, crop_year).when(early, 2020).otherwise(2021).cast("int").alias("product_year"),
    )


def rect_ring(west, south, east, north) -> Column:
    """A box as one closed ring of (x, y) points."""
    west, south, east, north = map(_col, (west, south, east, north))
    corners = ((west, south), (east, south), (east, north), (west, north), (west, south))
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners])


def bbox_of_rings(rings, digits: int | None = 5) -> Column:
    """Bounds of ARRAY<ARRAY<STRUCT<x,y>>>, half-even rounded unless ``digits`` is None."""
    points = F.flatten(_col(rings))
    xs = F.transform(points, lambda p: p["x"])
    ys = F.transform(points, lambda p: p["y"])
    parts = {"w": F.array_min(xs), "s": F.array_min(ys), "e": F.array_max(xs), "n": F.array_max(ys)}
    if digits is not None:
        parts = {k: F.bround(v, digits) for k, v in parts.items()}
    return F.struct(*[v.alias(k) for k, v in parts.items()])


# --- UTM on WGS 84 (Krueger series, published by Karney 2011), third-order terms ---------------
_A, _F = 6378137.0, 1 / 298.257223563
_N = _F / (2 - _F)
_K0 = 0.9996
_RECT = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64) * _K0
_ALPHA = (_N / 2 - 2 / 3 * _N**2 + 5 / 16 * _N**3, 13 / 48 * _N**2 - 3 / 5 * _N**3, 61 / 240 * _N**3)
_BETA = (_N / 2 - 2 / 3 * _N**2 + 37 / 96 * _N**3, _N**2 / 48 + _N**3 / 15, 17 / 480 * _N**3)
_DELTA = (2 * _N - 2 / 3 * _N**2 - 2 * _N**3, 7 / 3 * _N**2 - 8 / 5 * _N**3, 56 / 15 * _N**3)
_ECC = 2 * math.sqrt(_N) / (1 + _N)


def _atanh(x: Column) -> Column:
    return 0.5 * F.log((1 + x) / (1 - x))


def _central_meridian(epsg: Column) -> Column:
    return F.pmod(epsg, F.lit(100)).cast("double") * 6.0 - 183.0


def utm_forward(lon, lat, epsg) -> Column:
    """(x, y) metres of a lon/lat point in the given UTM zone."""
    lon, lat, epsg = map(_col, (lon, lat, epsg))
    sin_lat = F.sin(F.radians(lat))
    t = F.sinh(_atanh(sin_lat) - _ECC * _atanh(_ECC * sin_lat))
    dlon = F.radians(lon - _central_meridian(epsg))
    xi = F.atan2(t, F.cos(dlon))
    eta = _atanh(F.sin(dlon) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return F.struct(
        (500000.0 + _RECT * east).alias("x"),
        (F.when(epsg >= 32700, 1e7).otherwise(0.0) + _RECT * north).alias("y"),
    )


def utm_inverse(x, y, epsg) -> Column:
    """(lon, lat) degrees of a UTM point."""
    x, y, epsg = map(_col, (x, y, epsg))
    xi = (y - F.when(epsg >= 32700, 1e7).otherwise(0.0)) / _RECT
    eta = (x - 500000.0) / _RECT
    xi0, eta0 = xi, eta
    for j, b in enumerate(_BETA, 1):
        xi0 = xi0 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta0 = eta0 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi0) / F.cosh(eta0))
    lat = chi
    for j, d in enumerate(_DELTA, 1):
        lat = lat + d * F.sin(2 * j * chi)
    lon = F.degrees(F.atan2(F.sinh(eta0), F.cos(xi0))) + _central_meridian(epsg)
    return F.struct(lon.alias("lon"), F.degrees(lat).alias("lat"))


_SNAP = 1e-6  # pixels; an edge this close to a grid line counts as on it


def _bounds(points: list[Column], ax: str, ay: str) -> dict[str, Column]:
    xs, ys = [p[ax] for p in points], [p[ay] for p in points]
    return {"min_x": F.least(*xs), "min_y": F.least(*ys), "max_x": F.greatest(*xs), "max_y": F.greatest(*ys)}


def event_grid(west, south, east, north, res: float) -> Column:
    """UTM zone of a lon/lat box and its snapped pixel grid: epsg, x0, y0 (top left), n_rows, n_cols."""
    west, south, east, north = map(_col, (west, south, east, north))
    epsg = utm_epsg((west + east) / 2.0, (south + north) / 2.0)
    box = _bounds([utm_forward(x, y, epsg) for x in (west, east) for y in (south, north)], "x", "y")
    down = lambda v: F.floor(v / res + _SNAP)
    up = lambda v: F.ceil(v / res - _SNAP)
    left, right, bottom, top = down(box["min_x"]), up(box["max_x"]), down(box["min_y"]), up(box["max_y"])
    return F.struct(
        epsg.alias("epsg"), (left * res).alias("x0"), (top * res).alias("y0"),
        (top - bottom).cast("long").alias("n_rows"), (right - left).cast("long").alias("n_cols"),
    )


def chip_footprint(x0, y0, row, col, size: int, res: float, epsg, digits: int | None = 6) -> Column:
    """Lon/lat bounds of a pixel window, over its four corners (unrounded when ``digits`` is None)."""
    x0, y0, row, col, epsg = map(_col, (x0, y0, row, col, epsg))
    left, top = x0 + col * res, y0 - row * res
    corners = [utm_inverse(x, y, epsg) for x in (left, left + size * res) for y in (top, top - size * res)]
    box = _bounds(corners, "lon", "lat")
    names = {"min_lon": "min_x", "min_lat": "min_y", "max_lon": "max_x", "max_lat": "max_y"}
    tidy = (lambda v: v) if digits is None else (lambda v: F.bround(v, digits))
    return F.struct(*[tidy(box[src]).alias(dst) for dst, src in names.items()])


def pixel_area_km2(xres, yres) -> Column:
    return F.abs(_col(xres)) * F.abs(_col(yres)) / 1e6
