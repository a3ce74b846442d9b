"""Who is inside an affected zone (R11): counts per zone, without pairs of zones and incidents.

A zone is the disc of its outline, in degrees with longitudes shrunk by 0.97.  Incidents at one
place are one weighted point, equal zones one zone.  Points fall into square cells of the largest
radius, cells are split into 4 x 4, and so on; each cell knows its tight box and its number of
incidents.  A zone adds the whole weight of cells that lie inside it, drops those outside, and
only looks into cells that its edge cuts.  So the work of a zone grows with the cells along its edge, not with
the incidents inside, and a cell that holds half of all incidents is split for it like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.session import materialize, spread

SHRINK = 0.97  # longitude degrees against latitude degrees, as in the outline
_SPLIT = 4
_MARGIN = 1e-9  # boxes decide only what rounding cannot change


def _square(c):
    return c * c


def zone_counts(zones: DataFrame, incidents: DataFrame, id_col: str = "id", radius_col: str = "zone_radius_deg") -> DataFrame:
    """One row per zone with a place and a radius: its id and the number of incidents inside (``incidents_inside``), edges included.

    ``zones`` and ``incidents`` have ``latitude`` and ``longitude``; incidents without a place count nowhere.
    """
    x, y = F.col("latitude").cast("double"), F.col("longitude").cast("double") * F.lit(SHRINK)
    placed = F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & ~F.isnan("latitude") & ~F.isnan("longitude")
    points = materialize(incidents.where(placed).select(x.alias("x"), y.alias("y")).groupBy("x", "y").agg(F.count(F.lit(1)).alias("w")), "zone-points")
    own = zones.where(placed & (F.col(radius_col) >= 0)).select(
        F.col(id_col).alias("id"), x.alias("cx"), y.alias("cy"), F.col(radius_col).cast("double").alias("r")
    )
    own = materialize(own, "zone-rows")
    distinct = own.groupBy("cx", "cy", "r").agg(F.min("id").alias("zone"))
    side = own.agg(F.max("r")).first()[0] or 1.0
    at = lambda c, s: F.floor(F.col(c) / F.lit(s)).cast("long")

    def boxes(s: float, *parent) -> DataFrame:
        return points.groupBy(*parent, at("x", s).alias("sx"), at("y", s).alias("sy")).agg(
            F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.sum("w").alias("w")
        )

    around = F.array(*[F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    met = (
        spread(distinct).withColumn("o", F.explode(around))
        .withColumns({"sx": at("cx", side) + F.col("o.dx"), "sy": at("cy", side) + F.col("o.dy")}).drop("o").join(boxes(side), ["sx", "sy"])
    )
    zero = F.lit(0.0)
    near = _square(F.greatest(F.col("x0") - F.col("cx"), F.col("cx") - F.col("x1"), zero)) + _square(F.greatest(F.col("y0") - F.col("cy"), F.col("cy") - F.col("y1"), zero))
    far = _square(F.greatest(F.col("x1") - F.col("cx"), F.col("cx") - F.col("x0"))) + _square(F.greatest(F.col("y1") - F.col("cy"), F.col("cy") - F.col("y0")))
    reach = F.col("r") * F.col("r")
    point = (F.col("x0") == F.col("x1")) & (F.col("y0") == F.col("y1"))
    exact = _square(F.col("x0") - F.col("cx")) + _square(F.col("y0") - F.col("cy")) <= reach
    inside = F.when(point, exact).otherwise(far <= reach * (1 - _MARGIN))
    sums = None
    while True:
        cut = met.where(near <= reach * (1 + _MARGIN)).select("zone", "cx", "cy", "r", "sx", "sy", "w", point.alias("point"), inside.alias("inside"))
        cut = materialize(cut.where("inside or not point"), "zone-cells")
        got = cut.where("inside").groupBy("zone").agg(F.sum("w").alias("n"))
        sums = got if sums is None else sums.unionByName(got)
        open_ = cut.where("not inside").select("zone", "cx", "cy", "r", F.col("sx").alias("ux"), F.col("sy").alias("uy"))
        if not open_.limit(1).count():
            break
        finer = boxes(side / _SPLIT, at("x", side).alias("ux"), at("y", side).alias("uy"))
        met, side = open_.join(finer, ["ux", "uy"]).drop("ux", "uy"), side / _SPLIT
    total = sums.groupBy("zone").agg(F.sum("n").alias("n"))
    named = distinct.join(total, "zone", "left").select("cx", "cy", "r", F.coalesce("n", F.lit(0)).cast("long").alias("incidents_inside"))
    return own.join(named, ["cx", "cy", "r"]).select("id", "incidents_inside")
