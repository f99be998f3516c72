"""Geo queries. Places are fixed functions of the keys, on thousandths of a degree."""

from pyspark.sql import functions as F

from docspark.functions import geo
from docspark.operators import proximity
from docspark.plans import criteria as C
from docspark.plans.search import Order, Search
from docspark.schema import DocSchema

from .registry import Tables, lat_sql, located, lon_sql, query

R = "6371008.7714"
P = f"p AS (SELECT *, {lat_sql('c_custkey')}::DOUBLE AS lat, {lon_sql('c_custkey')}::DOUBLE AS lon FROM customer)"


def plane(lat1, lon1, lat2, lon2):
    x = f"(radians({lon2} - {lon1}) * cos(radians(({lat1} + {lat2}) / 2.0)))"
    return f"(sqrt(pow({x}, 2) + pow(radians({lat2} - {lat1}), 2)) * {R})"


def arc(lat1, lon1, lat2, lon2):
    return (f"(asin(least(1.0, sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
            f"cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))) * 2 * {R})")


def customers(t: Tables) -> Search:
    df = located(t.customer, "c_custkey")
    return Search(df, DocSchema.of(df, id="c_custkey"))


def found(s: Search, node):
    return s.query(node).matches().select("c_custkey")


BERLIN = geo.Point(52.52, 13.405)


@query("geo_within_distance", f"WITH {P} SELECT c_custkey FROM p WHERE {plane('lat', 'lon', '52.52', '13.405')} <= 1500000")
def _(t):
    return found(customers(t), C.Criteria.where("location").within(BERLIN, geo.Distance(1500.9, "km")))


@query("geo_within_miles", f"WITH {P} SELECT c_custkey FROM p WHERE {plane('lat', 'lon', '10.0', '-60.0')} <= 900 * 1609.344")
def _(t):
    return found(customers(t), C.within("location", "10.0,-60.0", "900mi"))


@query("geo_point_equals", f"""WITH {P}, q AS (SELECT lat AS qlat, lon AS qlon FROM p WHERE c_custkey = 77)
    SELECT c_custkey FROM p, q WHERE {plane('lat', 'lon', 'qlat', 'qlon')} <= 1""")
def _(t):
    lat, lon = (77 * 7919) % 170000 / 1000.0 - 85, (77 * 104729) % 360000 / 1000.0 - 180
    return found(customers(t), C.point_equals("location", geo.Point(lat, lon)))


@query("geo_bbox", f"WITH {P} SELECT c_custkey FROM p WHERE lat BETWEEN 35 AND 60 AND lon BETWEEN -10 AND 40")
def _(t):
    return found(customers(t), C.bounded_by("location", geo.Point(60, -10), geo.Point(35, 40)))


@query("geo_bbox_antimeridian", f"WITH {P} SELECT c_custkey FROM p WHERE lat BETWEEN -30 AND 30 AND (lon >= 150 OR lon <= -150)")
def _(t):
    return found(customers(t), C.bounded_by("location", "30.0,150.0", "-30.0,-150.0"))


@query("geo_filter_with_should", f"""WITH {P} SELECT c_custkey FROM p WHERE lat BETWEEN 0 AND 80 AND lon BETWEEN -100 AND 100""")
def _(t):
    # a geo filter makes the alternatives optional
    node = (C.Criteria.where("c_mktsegment").is_("BUILDING").or_("c_nationkey").is_(3)
            .or_("location").bounded_by(geo.Point(80, -100), geo.Point(0, 100)))
    return found(customers(t), node)


# an L-shaped ring
RING = [(0.0, 0.0), (0.0, 80.0), (30.0, 80.0), (30.0, 30.0), (60.0, 30.0), (60.0, 0.0)]


def ring_sql(lat, lon):
    edges = []
    for (a_lat, a_lon), (b_lat, b_lon) in zip(RING, RING[1:] + RING[:1]):
        if a_lat != b_lat:
            slope = (b_lon - a_lon) / (b_lat - a_lat)
            edges.append(f"((({a_lat} > {lat}) <> ({b_lat} > {lat})) AND {lon} < ({lat} - {a_lat}) * {slope} + {a_lon})::INT")
    return "((" + " + ".join(edges) + ") % 2 = 1)"


POLYGON = geo.Polygon(tuple(geo.Point(a, b) for a, b in RING))


@query("geo_shape_rel", f"WITH {P} SELECT c_custkey FROM p WHERE {ring_sql('lat', 'lon')}")
def _(t):
    return found(customers(t), C.shape("location", "within", POLYGON))


@query("geo_shape_disjoint", f"WITH {P} SELECT c_custkey FROM p WHERE NOT {ring_sql('lat', 'lon')}")
def _(t):
    return found(customers(t), C.shape("location", "disjoint", POLYGON))


@query("geo_shape_boxes", f"""WITH {P}, b AS (SELECT c_custkey, lat + 1 + c_nationkey AS t, lat - 1 - c_nationkey AS b,
      lon - 2 - c_nationkey AS l, lon + 2 + c_nationkey AS r FROM p)
    SELECT c_custkey, l <= 20 AND r >= -20 AND b <= 15 AND t >= -15 AS intersects,
      NOT (l <= 20 AND r >= -20 AND b <= 15 AND t >= -15) AS disjoint,
      l >= -20 AND r <= 20 AND b >= -15 AND t <= 15 AS "within",
      l <= -20 AND r >= 20 AND b <= -15 AND t >= 15 AS contains FROM b""")
def _(t):
    df = located(t.customer, "c_custkey")
    lat, lon, n = F.col("location.lat"), F.col("location.lon"), F.col("c_nationkey")
    area = F.struct((lat + 1 + n).alias("top"), (lon - 2 - n).alias("left"),
                    (lat - 1 - n).alias("bottom"), (lon + 2 + n).alias("right"))
    df = df.withColumn("area", area)
    box = geo.Box(geo.Point(15, -20), geo.Point(-15, 20))
    return df.select("c_custkey", *[geo.shape_relation(F.col("area"), r, box).alias(r)
                                    for r in ("intersects", "disjoint", "within", "contains")])


@query("geo_distance_sort", f"""WITH {P} SELECT c_custkey, round({arc('lat', 'lon', '52.52', '13.405')} / 1000, 4) AS km
    FROM p ORDER BY {arc('lat', 'lon', '52.52', '13.405')}, c_custkey LIMIT 25""")
def _(t):
    s = customers(t).sort(Order("location", origin=BERLIN, unit="km")).limit(25)
    return s.sort_values().select("c_custkey", F.round("_sort_0", 4).alias("km"))


@query("unit_convert", f"WITH {P} SELECT c_custkey, round({plane('lat', 'lon', '0.0', '0.0')} / 1852, 4) AS nmi, "
       f"round({plane('lat', 'lon', '0.0', '0.0')} / 0.3048, 2) AS feet FROM p")
def _(t):
    df = located(t.customer, "c_custkey")
    zero = geo.Point(0.0, 0.0)
    return df.select("c_custkey", F.round(geo.distance_to(F.col("location"), zero, "plane", "nmi"), 4).alias("nmi"),
                     F.round(geo.distance_to(F.col("location"), zero, "plane", "feet"), 2).alias("feet"))


# --- cells -------------------------------------------------------------------------------------------


def hash_sql(lat, lon, precision):
    """Bits of the two indices, five to a digit."""
    lon_bits, lat_bits = (5 * precision + 1) // 2, 5 * precision // 2
    col = f"floor(({lon} + 180) / 360 * {1 << lon_bits})::BIGINT"
    row = f"floor(({lat} + 90) / 180 * {1 << lat_bits})::BIGINT"
    digits = []
    for d in range(precision):
        bits = []
        for i, bit in enumerate(range(5 * d, 5 * d + 5)):
            src, shift = (col, lon_bits - 1 - bit // 2) if bit % 2 == 0 else (row, lat_bits - 1 - bit // 2)
            bits.append(f"(({src} >> {shift}) & 1) * {16 >> i}")
        digits.append(f"substr('{geo.BASE32}', ({' + '.join(bits)})::INT + 1, 1)")
    return " || ".join(digits)


@query("geohash_cell", f"WITH {P} SELECT c_custkey, {hash_sql('lat', 'lon', 6)} AS cell FROM p")
def _(t):
    df = located(t.customer, "c_custkey")
    return df.select("c_custkey", geo.geohash(F.col("location.lat"), F.col("location.lon"), 6).alias("cell"))


@query("geohash_bounds", f"""WITH {P}, i AS (SELECT c_custkey, floor((lat + 90) / 180 * 1024)::BIGINT AS r,
      floor((lon + 180) / 360 * 1024)::BIGINT AS c FROM p)
    SELECT c_custkey, (r + 1) * 0.17578125 - 90 AS top, c * 0.3515625 - 180 AS "left", r * 0.17578125 - 90 AS bottom,
      (c + 1) * 0.3515625 - 180 AS "right" FROM i""".replace("0.17578125", "0.17578125::DOUBLE").replace("0.3515625", "0.3515625::DOUBLE"))
def _(t):
    df = located(t.customer, "c_custkey")
    cell = df.select("c_custkey", geo.geohash(F.col("location.lat"), F.col("location.lon"), 4).alias("cell"))
    return cell.select("c_custkey", geo.cell_bounds(F.col("cell"), 4).alias("b")).select("c_custkey", "b.*")


@query("geohash_neighbors", f"""WITH {P}, d AS (SELECT unnest([-1, 0, 1]) AS x), g AS (SELECT a.x AS dr, b.x AS dc FROM d a, d b
      WHERE a.x <> 0 OR b.x <> 0),
    i AS (SELECT c_custkey, floor((lat + 90) / 180 * 128)::BIGINT + dr AS r,
      (floor((lon + 180) / 360 * 256)::BIGINT + dc + 256) % 256 AS c FROM p, g),
    b AS (SELECT c_custkey, (r + 0.5) * 1.40625 - 90 AS lat, (c + 0.5) * 1.40625 - 180 AS lon FROM i WHERE r BETWEEN 0 AND 127)
    SELECT DISTINCT c_custkey, {hash_sql('lat', 'lon', 3)} AS cell FROM b""")
def _(t):
    df = located(t.customer, "c_custkey")
    # precision 3 has 15 bits: 8 for the longitude, 7 for the latitude
    cell = df.select("c_custkey", geo.geohash(F.col("location.lat"), F.col("location.lon"), 3).alias("cell"))
    return cell.select("c_custkey", F.explode(geo.cell_neighbors(F.col("cell"), 3)).alias("cell"))


@query("geohash_prefix", f"WITH {P} SELECT c_custkey FROM p WHERE starts_with({hash_sql('lat', 'lon', 5)}, 'u')")
def _(t):
    df = located(t.customer, "c_custkey").withColumn(
        "cell", geo.geohash(F.col("location.lat"), F.col("location.lon"), 5))
    return Search(df, DocSchema.of(df)).query(C.starts_with("cell", "u")).matches().select("c_custkey")


# --- joins by place ---------------------------------------------------------------------------------------

S = f"s AS (SELECT s_suppkey, {lat_sql('(s_suppkey + 50021)')}::DOUBLE AS slat, {lon_sql('(s_suppkey + 50021)')}::DOUBLE AS slon FROM supplier)"


def suppliers(t: Tables):
    return located(t.supplier.withColumn("_k", F.col("s_suppkey") + 50021), "_k", "site").drop("_k")


@query("geo_proximity_join", f"""WITH {P}, {S} SELECT s_suppkey, count(c_custkey) AS near FROM s LEFT JOIN p
    ON {plane('lat', 'lon', 'slat', 'slon')} <= 500000 GROUP BY 1""")
def _(t):
    return proximity.count_near(located(t.customer, "c_custkey"), suppliers(t), 500_000.0,
                                point_location="location", site_location="site", site_id="s_suppkey")


@query("geo_area_join", f"""WITH {P}, {S} SELECT s_suppkey, count(*) AS inside, min(c_custkey) AS first_key FROM s JOIN p
    ON lat BETWEEN slat - 4 AND slat + 4 AND lon BETWEEN slon - 6 AND slon + 6 GROUP BY 1""")
def _(t):
    lat, lon = F.col("site.lat"), F.col("site.lon")
    areas = suppliers(t).select("s_suppkey", F.struct(
        (lat + 4).alias("top"), (lon - 6).alias("left"), (lat - 4).alias("bottom"), (lon + 6).alias("right")).alias("box"))
    pairs = proximity.points_in_areas(located(t.customer, "c_custkey").select("c_custkey", "location"), areas, 10.0,
                                      location="location", box="box")
    return pairs.groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("inside"), F.min("c_custkey").alias("first_key"))
