"""Country -> area mapping: inversion, enrichment, and versioned (as-of) enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.functions.text import split_countries
from logtide.operators.joins import join_dimension
from logtide.operators.scans import asof_lookup
from logtide.session import checkpointed

# Batches (and versions) per chunk of the as-of lookup.
VERSION_CHUNK = 65_536


def invert_mapping(mapping: DataFrame, *, by: list[str] | None = None) -> DataFrame:
    """(area, countries "FR,DE,IT") -> (country_code, area), one row per country.

    A country listed under two areas takes the greatest area name (any fixed
    choice would do). ``by`` keeps extra grouping columns,
    e.g. a snapshot version.
    """
    by = by or []
    pairs = mapping.where(F.col("area").isNotNull()).select(
        *by, "area", F.explode(split_countries(F.col("countries"))).alias("country_code"))
    return pairs.groupBy(*by, "country_code").agg(F.max("area").alias("area"))


def enrich_area(records: DataFrame, country_area: DataFrame) -> DataFrame:
    """Left join on country_code: an unknown country keeps its row with a NULL area."""
    return join_dimension(records, country_area.select("country_code", "area"), "country_code", "left")


def _published(versions: DataFrame) -> DataFrame:
    """Rows of non-empty snapshots: those that list a country."""
    return versions.where(F.col("area").isNotNull() & (F.size(split_countries(F.col("countries"))) > 0))


def latest_nonempty_version(versions: DataFrame, at_batch: int | None = None) -> DataFrame | None:
    """Snapshot guard: the newest non-empty snapshot (at or before ``at_batch``), as (country_code, area).

    ``versions`` holds (version, area, countries); an empty snapshot is a version whose rows carry no
    country. Only the snapshot in force is inverted. Without a bound, None where there is no such snapshot.
    """
    known = versions if at_batch is None else versions.where(F.col("version") <= at_batch)
    newest = _published(known).agg(F.max("version")).first()[0]
    if newest is None and at_batch is None:
        return None
    return invert_mapping(versions.where(F.col("version") == F.lit(newest)))


def version_in_force(batches: DataFrame, versions: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """(batch, _version): for each distinct batch the newest non-empty version at or before it."""
    known = _published(versions).select(F.col("version").cast("long").alias("version")).distinct()
    points = batches.select(F.col(batch_col).cast("long").alias("_batch")).where("_batch IS NOT NULL")
    found = asof_lookup(points, "_batch", known, "version", "version", "_version", forward=False, chunk=VERSION_CHUNK)
    return found.select(F.col("_batch").cast(batches.schema[batch_col].dataType).alias(batch_col), "_version")


def enrich_area_as_of(records: DataFrame, versions: DataFrame, batch_col: str = "batch_id",
                      batches: DataFrame | None = None) -> DataFrame:
    """Each record takes the mapping in force at its batch.

    In force = the newest non-empty snapshot whose version (publish batch) is
    <= the record's batch; empty snapshots leave the previous one in force.
    The version is found once per distinct batch (of ``batches``, which is cheaper than the records
    where those are still to be parsed); records then meet it, and the mapping on
    (version, country), in equi-joins. Records before the first snapshot get a NULL area.
    """
    # One row per batch, stored: its size is known before the join is planned.
    force = checkpointed(version_in_force(records if batches is None else batches, versions, batch_col), "version-in-force")
    dim = invert_mapping(versions, by=["version"]).select(
        F.col("version").cast("long").alias("_version"), "country_code", "area")
    tagged = join_dimension(records, force, batch_col, "left")
    return join_dimension(tagged, dim, ["_version", "country_code"], "left").drop("_version")
