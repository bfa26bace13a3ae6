"""The agency registry as a YAML document of one line for each agency, so that no task holds the whole document.

The part files, read in name order, are one valid document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from transitlake.schemas import AGENCIES, struct


def write_registry(agencies: DataFrame, path: str) -> None:
    """Write agencies in the order of ``agency_pos``. Each is an item of the list on a line of its own, and JSON, which is YAML."""
    names = ("agency_pos", *(field.name for field in struct(AGENCIES)))
    items = agencies.select(F.lit(1).alias("part"), "agency_pos", F.concat(F.lit("- "), F.to_json(F.struct(*names))).alias("line"))
    head = agencies.sparkSession.range(1).select(
        F.lit(0).alias("part"), F.lit(None).cast(agencies.schema["agency_pos"].dataType).alias("agency_pos"), F.lit("agencies:").alias("line")
    )
    head.unionByName(items).orderBy("part", "agency_pos").select("line").write.mode("overwrite").text(path)
