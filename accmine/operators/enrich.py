"""Enrichment of ids with catalogue and entity metadata.

All lookups are equi-joins; the optimizer broadcasts a side when its size in bytes allows and shuffles
otherwise, so nothing here depends on how large the dimensions are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import iso_date, parent_id


@dataclass(frozen=True)
class PortalConfig:
    """Names and links written into feeds. The defaults are neutral placeholders; pass the
    values of your own repository."""

    default_repository: str = "Repository"
    entity_url: str = "https://repository.example.org/{id}"
    id_prefix: str = "syn"


def _last_per_key(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """One row per key, the one with the greatest ``order_col``: like filling a dictionary row by row, the
    last row wins, also when its values are null."""
    rest = [c for c in df.columns if c not in (key, order_col)]
    return (df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order_col)).alias("_r"))
              .select(key, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def catalog_names(catalog: DataFrame, apps: DataFrame, cfg: PortalConfig = PortalConfig(),
                  order_col: str = "ord") -> DataFrame:
    """id, app_id, link, repository: catalogue rows with the app's friendly name.

    Both tables have an order column; of several rows for an id or an app the last one counts. A missing
    app id reads as ''; an empty link as null; an unknown app gets the default name."""
    cat = _last_per_key(catalog.select("id", F.coalesce(F.col("app_id"), F.lit("")).alias("app_id"),
                                       F.nullif(F.col("link"), F.lit("")).alias("link"), order_col), "id", order_col)
    names = _last_per_key(apps.select("app_id", "friendly_name", order_col), "app_id", order_col)
    return cat.join(names, "app_id", "left").select(
        "id", "app_id", "link", F.coalesce(F.col("friendly_name"), F.lit(cfg.default_repository)).alias("repository"))


def portal_table(catalog: DataFrame, apps: DataFrame, cfg: PortalConfig = PortalConfig(),
                 order_col: str = "ord") -> DataFrame:
    """The catalogue resolved to (id, repository, link, hit), ready for lookups. It is used for an entity and
    its parent, for old and new entries alike: stage it once where it is used several times."""
    return catalog_names(catalog, apps, cfg, order_col).select("id", "repository", "link", F.lit(True).alias("hit"))


def portal_resolve(entities: DataFrame, portals: DataFrame, cfg: PortalConfig = PortalConfig()) -> DataFrame:
    """Per entity: the catalogue entry of the entity itself, else of its parent, else the default.

    ``portals`` comes from ``portal_table``. The choice is by *row presence*: an entity listed
    with a null link does not fall through to its parent. Two lookups with a non-null marker.
    The entity's own columns are carried through, so callers need no join back on ``id``."""
    cat = portals
    keep = [c for c in entities.columns if c not in ("parent_id", "repository", "portal_link")]
    e = entities.select(*keep, parent_id("benefactor_id", cfg.id_prefix).alias("parent_id"))
    own = cat.select(F.col("id").alias("o_id"), F.col("repository").alias("o_repo"),
                     F.col("link").alias("o_link"), F.col("hit").alias("o_hit"))
    par = cat.select(F.col("id").alias("p_id"), F.col("repository").alias("p_repo"),
                     F.col("link").alias("p_link"), F.col("hit").alias("p_hit"))
    j = (e.join(own, e["id"] == own["o_id"], "left")
          .join(par, F.col("parent_id") == par["p_id"], "left"))
    return j.select(
        *keep, "parent_id",
        F.when(F.col("o_hit"), F.col("o_repo")).when(F.col("p_hit"), F.col("p_repo"))
         .otherwise(F.lit(cfg.default_repository)).alias("repository"),
        F.when(F.col("o_hit"), F.col("o_link")).when(F.col("p_hit"), F.col("p_link")).alias("portal_link"))


def entity_meta(entities: DataFrame, portals: DataFrame, cfg: PortalConfig = PortalConfig()) -> DataFrame:
    """Cache rows for entities with a header: name (id when empty), description, date, portal."""
    name = F.coalesce(F.nullif(F.col("name"), F.lit("")), F.col("id"))
    base = entities.select("id", name.alias("name"), iso_date("created_on").alias("created_on"),
                           "benefactor_id")
    return (portal_resolve(base, portals, cfg)
            .select("id", "name", F.col("name").alias("description"), "created_on",
                    "repository", "portal_link"))


def refresh_cache(ids: DataFrame, cache: DataFrame, entities: DataFrame, portals: DataFrame,
                  cfg: PortalConfig = PortalConfig(), refresh: bool = False) -> DataFrame:
    """New cache version (J5): old entries plus metadata for ids not cached yet.

    ``ids`` has a ``synid`` column (normally the citation pairs, so only ids cited by an
    article with an id count, and the pairs' shuffle is shared with the feed).

    With ``refresh`` the old cache is ignored. Ids without an entity header are not
    cached, so a later run tries them again."""
    want = ids.select(F.col("synid").alias("id")).distinct()
    old = cache.select(*schemas.ENTITY_META.fieldNames())
    missing = want if refresh else want.join(old.select("id"), "id", "left_anti")
    fetched = entity_meta(entities.join(missing, "id", "left_semi"), portals, cfg)
    fresh = fetched.select(*schemas.ENTITY_META.fieldNames())
    return fresh if refresh else old.unionByName(fresh)


def search_entries(pairs: DataFrame, cache: DataFrame, cfg: PortalConfig = PortalConfig()) -> DataFrame:
    """One entry per cited id that has metadata (J6): id, name, description, created (null when
    unknown, so the dates element is left out), repository, full_link, n_refs."""
    counts = pairs.groupBy("synid").agg(F.count(F.lit(1)).alias("n_refs"))
    j = counts.join(cache.withColumnRenamed("id", "synid"), "synid")
    name = F.coalesce(F.nullif(F.col("name"), F.lit("")), F.col("synid"))
    link = F.coalesce(F.nullif(F.col("portal_link"), F.lit("")),
                      F.replace(F.lit(cfg.entity_url), F.lit("{id}"), F.col("synid")))
    return j.select(F.col("synid").alias("id"), name.alias("name"),
                    F.coalesce(F.nullif(F.col("description"), F.lit("")), name).alias("description"),
                    F.nullif(F.col("created_on"), F.lit("")).alias("created"),
                    F.coalesce(F.nullif(F.col("repository"), F.lit("")),
                               F.lit(cfg.default_repository)).alias("repository"),
                    link.alias("full_link"), "n_refs")


def inaccessible(ids: DataFrame, cache: DataFrame) -> DataFrame:
    """Ids left out of the search feed because no metadata exists for them."""
    return (ids.select("synid").distinct()
               .join(cache.select(F.col("id").alias("synid")), "synid", "left_anti"))
