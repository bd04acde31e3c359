"""Reprojection, and finding the system an archive was surveyed in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trowel.functions import geometry as G
from trowel.functions import projection as P
from trowel.functions.geometry import point_wkb
from trowel.operators.median import geometric_median
from trowel.operators.site import archive_names, centroid_points, recorded_srid
from trowel.operators.spatial import region_hits
from trowel.schema import TARGET_SRID
from trowel.session import broadcast_if_small, cut_lineage

A = "archive"

# Systems tried after the recorded one, in this order.
CANDIDATES = (3006, 3021, 3010, 3007, 3027, 3008, 4124)


def _with_system(df: DataFrame, srid: str) -> DataFrame:
    """Rows with the constants of the system in ``srid``; an unknown one is an error."""
    systems = P.systems_table(df.sparkSession)
    fields = F.struct(*[F.col(c) for c in systems.columns])
    systems = systems.select(F.col("srid").cast("int").alias(srid), fields.alias("system"))
    joined = df.join(F.broadcast(systems), srid, "left")  # a fixed list of some 25 rows
    problem = F.concat(F.lit("unknown SRID "), F.col(srid).cast("string"))
    return joined.withColumn("system", F.when(
        F.col("system").isNull() & F.col(srid).isNotNull(), F.raise_error(problem))
        .otherwise(F.col("system")))


def reproject(t, srids: DataFrame, target: int = TARGET_SRID) -> DataFrame:
    """Geometries moved from each archive's system (archive, likely_srid) to the target."""
    systems = broadcast_if_small(srids.select(A, "likely_srid"))
    shaped = t["geo_object"].drop("srid").join(systems, A, "left")
    shaped = _with_system(shaped, "likely_srid").withColumn("shape", G.decode_shape("wkb"))
    source, fixed = P.by_column(F.col("system")), P.fixed(target)
    moved = G.map_rings(F.col("shape"), lambda pts: P.transform_points(pts, source, fixed))
    done = F.when(F.col("likely_srid") == target, F.col("shape")).otherwise(moved)
    return (shaped.withColumn("shape", done).withColumn("wkb", G.encode_shape("shape"))
            .select(A, "ObjectId", "MetaId", "SymbolId", "wkb",
                    F.lit(target).alias("srid")))


def likely_srid(t) -> DataFrame:
    """The system archives are taken to be in: the target system."""
    return archive_names(t).select(A, F.lit(TARGET_SRID).alias("likely_srid"))


def likely_srid_cascade(t, candidates=CANDIDATES, cell: float = 50000.0,
                        **median_options) -> DataFrame:
    """The first system under which an archive's centre falls into a sea zone.

    The recorded system comes first (0 counts as the target), then the list.  Without
    any match the target system is taken.  ``converged`` is false where one of the centres
    tried is only the best point found in the rounds allowed, NULL without any centre.
    """
    noted = recorded_srid(t).select(
        A, F.when(F.col("intrasis_srid") == 0, TARGET_SRID)
        .otherwise(F.col("intrasis_srid")).alias("noted"))
    known = F.col("noted").isin(*P.SYSTEMS)
    ranked = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(s).alias("candidate"))
                       for i, s in enumerate(candidates, 1)])
    first = F.array(F.struct(F.lit(0).alias("rank"), F.col("noted").alias("candidate")))
    tries = archive_names(t).join(noted, A, "left").select(
        A, F.inline(F.when(known, F.concat(first, ranked)).otherwise(ranked)))
    points = _with_system(centroid_points(t).join(broadcast_if_small(tries), A), "candidate")
    one = F.array(F.struct("x", "y", F.lit(None).cast("double").alias("z")))
    moved = P.transform_points(one, P.by_column(F.col("system")), P.fixed(TARGET_SRID))[0]
    moved = F.when(F.col("candidate") != TARGET_SRID, moved).otherwise(one[0])
    placed = (points.select(A, "rank", "candidate", moved.alias("p"))
              .select(A, "rank", "candidate", "p.x", "p.y")
              .where(~F.isnan("x") & ~F.isnan("y") & (F.abs("x") < 1e8) & (F.abs("y") < 1e8)))
    centres = cut_lineage(geometric_median(cut_lineage(placed), A, "rank", "candidate", **median_options))
    spots = cut_lineage(centres.select(A, "rank", "candidate", point_wkb("x", "y").alias("wkb")))
    hits = region_hits(spots, [A, "rank", "candidate"], t["zone"], [], cell)
    best = hits.groupBy(A).agg(F.min(F.struct("rank", "candidate")).alias("best"))
    found = centres.groupBy(A).agg(F.min("converged").alias("converged"))
    return archive_names(t).join(best, A, "left").join(found, A, "left").select(
        A, F.coalesce("best.candidate", F.lit(TARGET_SRID)).alias("likely_srid"), "converged")
