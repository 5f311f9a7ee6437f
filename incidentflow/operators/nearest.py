"""Nearest-station match (k = 1) by squared Euclidean distance in degrees.

The stations are packed once into an index of cells that covers the whole plane;
each cell carries the stations that can be the nearest of a point in it, so every
point finds its cell by arithmetic, meets the candidates in one equi-join and
takes the least distance.  The points are never aggregated or written, need no
key, and move at most once (not at all where the planner broadcasts the index).

The cells:

* Inside the stations' square, slabs of equal station counts by longitude, each
  cut into tiles of equal counts by latitude (sort-tile packing; the bounds are
  mergeable quantiles), every tile cut into a small grid.
* Outside, rings of doubling size, twelve squares each, out to ``PLACE_LIMIT``.

The candidates: a station is left out of a cell only if another one is nearer at
all four corners.  The difference of two squared distances is linear in the
point, so it is then nearer everywhere in the cell; a margin far above rounding
error keeps every station that the computed distances could prefer.  Tiles and
rings come first: a station of each tile stands for it, five of these champion a
region, and each station goes to the regions where none of them beats it.  Then
a tile's list gives the lists of its grid in the same way.

``within`` matches inside groups: a point only sees the stations of its own group
(such as those with a reading on its day), each group with candidates of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentflow.session import materialise, ship_package

#: Coordinates beyond this (no place on Earth in degrees or metres) are no places.
PLACE_LIMIT = 1e9
#: Tiles along each side at most, and stations in a tile where that suffices.
MOST_SLABS = 64
PER_TILE = 16
#: Stations of a group that one task deals out.
SHARE_ROWS = 50_000
_MARGIN = 1e-12  # of a squared distance; rounding errors stay below 1e-14
_PAD = 1e-9  # of a cell's size, for points that rounding puts in a neighbouring cell


def placed(lat: str, lon: str) -> Column:
    """Both coordinates are known, finite and within ``PLACE_LIMIT``."""
    known = lambda c: F.col(c).isNotNull() & (F.abs(F.col(c).cast("double")) <= PLACE_LIMIT)
    return known(lat) & known(lon)


def _sq_distance(lat: Column, lon: Column, s_lat: Column, s_lon: Column) -> Column:
    dlat = lat - s_lat
    dlon = lon - s_lon
    return dlat * dlat + dlon * dlon


def _doubles(values) -> str:
    return "array(" + ", ".join(_doubles(v) if isinstance(v, list) else f"{float(v)!r}D" for v in values) + ")"


class Cells:
    """The plane's cells: ``cx, cy, half`` of the stations' square, slab bounds,
    each slab's tile bounds, and how many rings lie around."""

    def __init__(self, center: tuple[float, float], half: float, slabs: list[float], tiles: list[list[float]], grid: int):
        self.cx, self.cy = center
        self.half, self.grid = half, grid
        self.lon = [self.cx - half, *slabs, self.cx + half]
        self.lat = [[self.cy - half, *row, self.cy + half] for row in tiles]
        self.side = len(self.lat)
        self.rings = max(1, ceil(log2(4 * PLACE_LIMIT / half)))

    def regions(self) -> list[tuple[float, float, float, float]]:
        """West, east, south, north of every region by its number, a little enlarged."""
        out = []
        for i in range(self.side):
            for j in range(self.side):
                out.append((self.lon[i], self.lon[i + 1], self.lat[i][j], self.lat[i][j + 1]))
        for k in range(self.rings):
            size = self.half * 2**k
            for code in range(16):
                span = lambda far, minus: (-(far + 1) * size, -far * size) if minus else (far * size, (far + 1) * size)
                x, y = span(code & 1, code >> 1 & 1), span(code >> 2 & 1, code >> 3 & 1)
                # the four squares around the centre are tiled: no point asks for them
                empty = not code & 5
                out.append((self.cx + x[0], self.cx + x[0] if empty else self.cx + x[1], self.cy + y[0], self.cy + y[0] if empty else self.cy + y[1]))
        return [(a - _PAD * (b - a), b + _PAD * (b - a), c - _PAD * (d - c), d + _PAD * (d - c)) for a, b, c, d in out]

    def region(self, lat: Column, lon: Column) -> dict[str, Column]:
        """A point's region and its place in the tile's grid, to be added to a
        frame in this order."""
        x, y = (lon - self.cx) / self.half, (lat - self.cy) / self.half
        reach = F.greatest(F.abs(x), F.abs(y))
        ring = F.size(F.filter(F.expr(_doubles(2.0**k for k in range(1, self.rings))), lambda b: b <= reach)) if self.rings > 1 else F.lit(0)
        size = F.pow(F.lit(2.0), ring)
        code = F.lit(0)
        for at, bit in ((x, 0), (y, 2)):
            code = code + F.when(F.abs(at) >= size, 1 << bit).otherwise(0) + F.when(at < 0, 2 << bit).otherwise(0)
        outer = self.side * self.side + ring * 16 + code
        if self.side == 1:
            return {"inner": reach < 1, "region": F.when(reach < 1, 0).otherwise(outer)}
        slab = F.size(F.filter(F.expr(_doubles(self.lon[1:-1])), lambda b: b <= lon))
        row = F.element_at(F.expr(_doubles([r[1:-1] for r in self.lat])), slab + 1)
        return {"inner": reach < 1, "region": F.when(reach < 1, slab * self.side + F.size(F.filter(row, lambda b: b <= lat))).otherwise(outer)}


def _with_box(df: DataFrame, region: Column, boxes: list, name: str) -> tuple[DataFrame, list[Column]]:
    """Adds a region's box to the rows; its west, east, south and north."""
    df = df.withColumn(name, F.element_at(F.expr(_doubles([list(b) for b in boxes])), region + 1))
    return df, [F.element_at(name, k) for k in (1, 2, 3, 4)]


# ------------------------------------------------------ candidates as arrays
def _corners(lat: np.ndarray, lon: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """Squared distances of every station to the corners of every box, by corner."""
    w, e, s, n = boxes.T
    dw, de, ds, dn = ((v[:, None] - b[None, :]) ** 2 for v, b in ((lon, w), (lon, e), (lat, s), (lat, n)))
    return np.stack([dw + ds, dw + dn, de + ds, de + dn])


def _champions(lat: np.ndarray, lon: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """Five stations for each box: the nearest to each corner, and the one whose
    farthest corner is nearest."""
    d = _corners(lat, lon, boxes)
    return np.concatenate([d.argmin(axis=1), d.max(axis=0).argmin(axis=0)[None]])


def _remain(lat: np.ndarray, lon: np.ndarray, c_lat: np.ndarray, c_lon: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """Which stations (rows) no champion of a box (columns) surely beats in all of it."""
    d = _corners(lat, lon, boxes)
    margin = _MARGIN * d.max(axis=0)
    out = np.ones(d.shape[1:], dtype=bool)
    w, e, s, n = boxes.T
    for y, x in zip(c_lat, c_lon):
        own = np.stack([(v - x) ** 2 + (u - y) ** 2 for v in (w, e) for u in (s, n)])
        out &= (d - own[:, None, :]).min(axis=0) <= margin
    return out


def _runs(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The stretches of a sorted batch that agree in ``keys``."""
    if not batch.num_rows:
        return
    if not keys:
        yield (), batch
        return
    codes = [pc.dictionary_encode(batch.column(k)).indices.to_numpy() for k in keys]
    edge = np.flatnonzero(np.any([np.diff(c) != 0 for c in codes], axis=0)) + 1
    for a, b in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows]):
        yield tuple(batch.column(k)[a].as_py() for k in keys), batch.slice(a, b - a)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _deal_regions(boxes: np.ndarray, groups: list[str], chunk: int = 256):
    """Streams rows sorted by (group, share), a group's representatives first:
    they give every region's champions, then each station goes to the regions
    where it stays a candidate.  Memory: the representatives and a chunk."""
    wide = np.flatnonzero(boxes[:, 0] < boxes[:, 1])
    real = boxes[wide]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, champions = None, [], None
        for batch in batches:
            for key, part in _runs(batch, [*groups, "_share", "_first"]):
                lat, lon = _column(part, "_lat"), _column(part, "_lon")
                if key[:-1] != now:
                    now, held, champions = key[:-1], [], None
                if key[-1] == 0:  # representatives
                    held.append((lat, lon))
                    continue
                if champions is None:
                    r_lat, r_lon = (np.concatenate(x) for x in zip(*held))
                    best = _champions(r_lat, r_lon, real)
                    champions = r_lat[best], r_lon[best]
                for a in range(0, len(lat), chunk):
                    row, region = np.nonzero(_remain(lat[a : a + chunk], lon[a : a + chunk], *champions, real))
                    taken = part.slice(a, chunk).take(pa.array(row))
                    cols = [taken.column(c) for c in [*groups, "_code", "_lat", "_lon"]]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(wide[region].astype(np.int32))], names=[*groups, "_code", "_lat", "_lon", "_region"])

    return run


def _deal_cells(boxes: np.ndarray, inner: int, grid: int, groups: list[str]):
    """Streams candidates sorted by (group, region): a region's list gives the
    lists of its cells (a tile has ``grid`` squared, a ring's square one)."""
    step = np.arange(grid)
    i, j = np.repeat(step, grid), np.tile(step, grid)

    def cells(region: int) -> np.ndarray:
        w, e, s, n = boxes[region]
        if region >= inner:
            return boxes[region][None]
        dx, dy = (e - w) / grid, (n - s) / grid
        return np.stack([w + dx * (i - 2 * _PAD), w + dx * (i + 1 + 2 * _PAD), s + dy * (j - 2 * _PAD), s + dy * (j + 1 + 2 * _PAD)], axis=1)

    def lists(parts: list[pa.RecordBatch], region: int) -> pa.RecordBatch:
        all_of = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        lat, lon, own = _column(all_of, "_lat"), _column(all_of, "_lon"), cells(region)
        cell, row = [], []
        for a in range(0, len(own), 64):
            best = _champions(lat, lon, own[a : a + 64])
            c, r = np.nonzero(_remain(lat, lon, lat[best], lon[best], own[a : a + 64]).T)
            cell.append(c + a)
            row.append(r)
        cell, row = np.concatenate(cell), np.concatenate(row)
        taken = all_of.take(pa.array(row))
        entry = pa.StructArray.from_arrays([taken.column(c) for c in ("_code", "_lat", "_lon")], names=["code", "lat", "lon"])
        edge = np.searchsorted(cell, np.arange(len(own) + 1)).astype(np.int32)
        first = all_of.slice(0, 1)
        keys = [first.column(g).take(pa.array(np.zeros(len(own), np.int32))) for g in groups]
        number = region * grid * grid + np.arange(len(own), dtype=np.int64)
        return pa.RecordBatch.from_arrays([*keys, pa.array(number), pa.ListArray.from_arrays(pa.array(edge), entry)], names=[*groups, "_cell", "_candidates"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for key, part in _runs(batch, [*groups, "_region"]):
                if held and key != now:
                    yield lists(held, now[-1])
                    held = []
                now = key
                held.append(part)
        if held:
            yield lists(held, now[-1])

    return run


def build_index(stations: DataFrame, groups: list[str], per_tile: int = PER_TILE) -> tuple[Cells, DataFrame] | None:
    """The cells and the index ``<groups>, _cell, _candidates`` (structs of
    code, lat, lon) of stations ``<groups>, _code, _lat, _lon``; None without
    stations.  The index is written under the checkpoint folder, so that joins
    see its size.

    The driver reads at most 64 quantiles a slab of at most 64; stations stream
    through tasks in shares and move with the regions in which they stay candidates.
    """
    # of stations in one place only the smallest code can be chosen
    st = materialise(stations.groupBy(*groups, "_lat", "_lon").agg(F.min("_code").alias("_code")), "nearest-stations")
    shares = [k / MOST_SLABS for k in range(1, MOST_SLABS)]
    ext = st.agg(
        F.count("*").alias("n"),
        *[f(c).alias(f"{f.__name__}{c}") for f in (F.min, F.max) for c in ("_lat", "_lon")],
        F.percentile_approx("_lon", shares, 10_000).alias("q"),
    ).first()
    if not ext.n:
        return None
    largest, n_groups = ext.n, 1
    if groups:
        largest, n_groups = st.groupBy(*groups).count().agg(F.max("count"), F.count("*")).first()
    each = ext.n / n_groups
    side = max(1, min(MOST_SLABS, ceil(sqrt(each / per_tile))))
    pick = lambda q: [q[k * MOST_SLABS // side - 1] for k in range(1, side)]
    slabs = pick(ext.q)
    tiles: list[list[float]] = [[]]
    if side > 1:
        slab = F.size(F.filter(F.expr(_doubles(slabs)), lambda b: b <= F.col("_lon")))
        found = {r[0]: pick(r[1]) for r in st.groupBy(slab).agg(F.percentile_approx("_lat", shares, 10_000)).collect()}
        tiles = [found.get(i) or next(iter(found.values())) for i in range(side)]
    spread = max(ext["max_lat"] - ext["min_lat"], ext["max_lon"] - ext["min_lon"])
    cells = Cells(
        ((ext["max_lon"] + ext["min_lon"]) / 2, (ext["max_lat"] + ext["min_lat"]) / 2),
        max(spread / 2 * (1 + 1e-6), 1e-6),
        slabs,
        tiles,
        grid=max(1, ceil(sqrt(each / side / side))),
    )
    boxes, spark = np.array(cells.regions()), st.sparkSession
    ship_package(spark)
    # a station of each tile stands for it; large groups are dealt out in shares, each with all of them
    shares = F.lit(ceil(largest / SHARE_ROWS))
    tile = cells.region(F.col("_lat"), F.col("_lon"))["region"]
    every = st.withColumns({"_share": F.pmod(F.xxhash64("_lat", "_lon"), shares).cast("int"), "_first": F.lit(1)})
    of_tile = st.groupBy(*groups, tile.alias("_tile")).agg(F.min(F.struct("_lat", "_lon", "_code")).alias("_s")).select(*groups, "_s.*")
    of_tile = of_tile.withColumns({"_share": F.explode(F.sequence(F.lit(0), shares - 1)), "_first": F.lit(0)})
    keys = [*groups, "_share"]
    streams = every.unionByName(of_tile).repartition(*keys).sortWithinPartitions(*keys, "_first")
    kinds = {f.name: f.dataType.simpleString() for f in st.schema.fields}
    station = [f"{g} {kinds[g]}" for g in groups] + [f"_code {kinds['_code']}", "_lat double", "_lon double", "_region int"]
    kept = streams.mapInArrow(_deal_regions(boxes, groups), ", ".join(station))
    keys = [*groups, "_region"]
    schema = ", ".join([f"{g} {kinds[g]}" for g in groups] + [f"_cell long, _candidates array<struct<code:{kinds['_code']},lat:double,lon:double>>"])
    index = kept.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_deal_cells(boxes, cells.side**2, cells.grid, groups), schema)
    return cells, materialise(index, "nearest-index")


def with_cell(points: DataFrame, cells: Cells, lat: Column, lon: Column, name: str) -> DataFrame:
    """Adds the cell of every (placed) point."""
    g, at = cells.grid, cells.region(lat, lon)
    rows = points.withColumns({f"{name}i": at["inner"], f"{name}r": at["region"]})
    rows, (w, e, s, n) = _with_box(rows, F.when(F.col(f"{name}i"), F.col(f"{name}r")).otherwise(0), cells.regions()[: cells.side**2], f"{name}t")
    step = lambda v, a, b: F.least(F.greatest(F.floor((v - a) / (b - a) * g), F.lit(0)), F.lit(g - 1))
    sub = F.when(F.col(f"{name}i") & (w < e) & (s < n), step(lon, w, e) * g + step(lat, s, n)).otherwise(0)
    return rows.withColumn(name, F.col(f"{name}r") * F.lit(g * g).cast("long") + sub).drop(f"{name}i", f"{name}r", f"{name}t")


def nearest_station(
    points: DataFrame,
    stations: DataFrame,
    out: str = "meteo_estacio_proxima",
    lat: str = "latitud_wgs84",
    lon: str = "longitud_wgs84",
    station_key: str = "codi_estacio",
    station_lat: str = "latitud_wgs84",
    station_lon: str = "longitud_wgs84",
    distance_col: str | None = None,
    within: dict[str, str] | None = None,
    per_tile: int = PER_TILE,
) -> DataFrame:
    """Add ``out`` (and optionally the squared distance) to every placed point.

    ``within`` maps columns of the points to columns of the stations: only
    stations that agree in them count, and a point whose group has none is
    dropped (a null agrees with nothing).  Points without a place (a null, NaN,
    infinite or impossible coordinate) are dropped, as the match is inner;
    stations without a code or a place are no stations.  Ties go to the smaller
    code.  Repeated points and points with equal keys keep a row each; other
    columns pass through.  ``per_tile`` only sets how fine the index is.
    """
    groups = [f"_g{k}" for k in range(len(within or {}))]
    st = stations.where(placed(station_lat, station_lon) & F.col(station_key).isNotNull()).select(
        *[F.col(c).alias(g) for g, c in zip(groups, (within or {}).values())],
        F.col(station_key).alias("_code"),
        F.col(station_lat).cast("double").alias("_lat"),
        F.col(station_lon).cast("double").alias("_lon"),
    )
    for g in groups:
        st = st.where(F.col(g).isNotNull())
    located = points.where(placed(lat, lon))
    built = build_index(st, groups, per_tile)
    if built is None:
        empty = points.where(F.lit(False)).withColumn(out, F.lit(None).cast(stations.schema[station_key].dataType))
        return empty.withColumn(distance_col, F.lit(None).cast("double")) if distance_col else empty
    cells, index = built
    free = "_" * (1 + max(len(c) for c in points.columns))  # longer than any name of the points
    own = index.select(*[F.col(c).alias(free + c) for c in index.columns])
    y, x = F.col(lat).cast("double"), F.col(lon).cast("double")
    keyed = with_cell(located, cells, y, x, free)
    same = keyed[free] == own[f"{free}_cell"]
    for g, c in zip(groups, within or {}):
        same = same & (keyed[c] == own[free + g])
    best = F.array_min(F.transform(f"{free}_candidates", lambda s: F.struct(_sq_distance(y, x, s["lat"], s["lon"]).alias("d"), s["code"].alias("code"))))
    found = keyed.join(own, same).withColumn(f"{free}b", best)
    cols = {out: F.col(f"{free}b.code")}
    if distance_col:
        cols[distance_col] = F.col(f"{free}b.d")
    return found.withColumns(cols).select(*[c for c in points.columns if c not in cols], *cols)
