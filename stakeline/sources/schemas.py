"""Column contracts (DDL) of the source tables; sources are never read with inferred types."""

from __future__ import annotations

PRODUCTION = (
    "field string, unit string, operator string, region string, location string, unit_type string, "
    "period string, oil_mbd double, assoc_gas_mmscfd double, dry_gas_mmscfd double, condensate_mbd double, "
    "water_mbd double, gas_pipeline double, lon double, lat double, object_id bigint, "
    "reported_at timestamp_ntz"
)
CLASSIFICATION = ("field string, unit string, classification string, note string")
ALIASES = ("production_name string, equity_name string")
STAKES = (
    "field_name string, on_offshore string, status string, company_name string, interest_pct double, "
    "operator_flag string, start_date date, end_date date, period_label string"
)
OVERRIDES = ("line_no int, entity string, display_group string, basis string, status string")
SUBAREAS = (
    "object_id bigint, licence_number int, licence_reference string, block_reference string, subarea_name string, "
    "licence_status string, start_ms bigint, end_ms bigint, holder_text string, holder_group string, "
    "equity_pct double, operator_group string, rings array<array<array<double>>>"
)
EPISODES = (
    "object_id bigint, history string, licence_number double, licence_reference string, block_reference string, "
    "licence_status string, start_ms bigint, end_ms bigint, licensee_names string, licensee_group string, "
    "operator_names string, operator_group string, admin_org string, admin_group string, "
    "rings array<array<array<double>>>"
)
POLYGONS = (
    "field_no string, polygon_name string, determination_status string, rings array<array<array<double>>>"
)
FEATURE_PAGE = (
    "exceededTransferLimit boolean, features array<struct<"
    "attributes: struct<object_id: bigint, field: string, unit: string, period: string, oil_mbd: double>, "
    "geometry: struct<x: double, y: double>>>"
)
LANDED_PAGE = "offset bigint, " + FEATURE_PAGE
MANIFEST = ("offset bigint, features bigint")
