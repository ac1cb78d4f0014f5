"""Lineage edges: paths resolved to table names, tiers, and what is shown."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
TIERS = ("bronze", "silver", "gold", "features")


def trimmed(path: Column) -> Column:
    return F.regexp_replace(path, "/+$", "")


def container(node: Column) -> Column:
    """The store of a path: ``store`` of ``scheme://store@account/...``."""
    return F.regexp_extract(node, r"^\w+://([^@/]+)@", 1)


def tier_of(node: Column) -> Column:
    """The tier of a table name (its schema) or of a path (its store or a folder);
    ``external`` for others, null for null."""
    schema = F.regexp_extract(node, r"^[^./]+\.([^./]+)\.[^./]+$", 1)
    folder = F.regexp_extract(node, rf"/({'|'.join(TIERS)})(?:/|$)", 1)
    found = F.when(schema.isin(*TIERS), schema).when(container(node).isin(*TIERS), container(node)).when(folder != "", folder)
    return F.when(node.isNotNull(), F.coalesce(found, F.lit("external")))


def canonicalize(edges: DataFrame, locations: DataFrame) -> DataFrame:
    """source_node, source_col, target_node, target_col: names where given, else the
    name registered for the path, else the path.  ``locations``: full_name,
    storage_path; the catalogue of tables is small, and shuffled if it is not."""
    known = locations.groupBy(trimmed(F.col("storage_path")).alias("path")).agg(F.min("full_name").alias("name")).where("path is not null")
    by = lambda side: known.select(F.col("path").alias(f"{side}_p"), F.col("name").alias(f"{side}_n"))
    rows = edges.join(by("s"), trimmed(F.col("source_path")) == F.col("s_p"), "left").join(by("t"), trimmed(F.col("target_path")) == F.col("t_p"), "left")
    node = lambda side, short: F.coalesce(f"{side}_table_full_name", f"{short}_n", trimmed(F.col(f"{side}_path")))
    return rows.select(node("source", "s").alias("source_node"), F.col("source_column_name").alias("source_col"), node("target", "t").alias("target_node"), F.col("target_column_name").alias("target_col"))


def column_edges(edges: DataFrame, locations: DataFrame) -> DataFrame:
    """Distinct column-level edges between known nodes, with both tiers; an edge
    of a table to itself is none."""
    rows = canonicalize(edges, locations).where("source_node is not null and target_node is not null and source_node != target_node")
    return rows.select("*", tier_of(F.col("source_node")).alias("source_tier"), tier_of(F.col("target_node")).alias("target_tier")).distinct()


def tier_edges(columns: DataFrame) -> DataFrame:
    return columns.groupBy("source_tier", "target_tier").agg(F.countDistinct("source_node", "target_node").alias("table_edges"), F.count("*").alias("column_edges"))


def render(tiers: list[dict], column_edge_count: int, generated: str) -> str:
    """Markdown with a diagram of the tiers."""
    lines = ["# Lineage", "", f"Generated {generated}; {column_edge_count} column edges.", "", "```mermaid", "flowchart LR"]
    for r in sorted(tiers, key=lambda r: (r["source_tier"], r["target_tier"])):
        lines.append(f"  {r['source_tier']} -->|{r['table_edges']} tables, {r['column_edges']} columns| {r['target_tier']}")
    missing = [t for t in TIERS if not any(t in (r["source_tier"], r["target_tier"]) for r in tiers)]
    lines += ["```", "", "Tiers without edges: " + (", ".join(missing) or "none") + ".", ""]
    return "\n".join(lines)


def artifacts(columns: DataFrame, generated: str) -> tuple[str, str]:
    """(JSON, Markdown) of the tier graph; a handful of rows are collected."""
    tiers = [r.asDict() for r in tier_edges(columns).orderBy("source_tier", "target_tier").collect()]
    count = columns.count()
    return json.dumps({"generated": generated, "column_edges": count, "tiers": tiers}, indent=2), render(tiers, count, generated)
