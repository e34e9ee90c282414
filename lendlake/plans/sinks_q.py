"""Mart exports (K1-K3) with a twin that checks every export is whole."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lendlake.plans.quality_q import MART_CTES, Tables
from lendlake.plans.registry import mart_cte, query, staging_folder
from lendlake.sources import sinks

# mart -> (order keys, bounded size -> single file)
EXPORTS = {
    "kpis": (["kpi_display_order"], True),
    "kpis_wide": ([], True),
    "yearly": (["origination_year"], True),
    "quarterly": (["origination_year", "origination_quarter_number"], True),
    "segmentation": (["feature_name", "-observed_loss_rate", "-funded_loan_count"], False),
    "bands": (["severity_band_order"], True),
    "concentration": (["loss_rank"], False),
    "summary": (["top_share_threshold"], True),
}

_SQL = ",\n".join(mart_cte(f"m_{m}", MART_CTES[m]) for m in EXPORTS) + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{m}' AS mart, count(*) AS rows, true AS in_order, true AS is_whole FROM m_{m}" for m in EXPORTS
)


@query("export_marts", _SQL)
def q_export_marts(spark, sf_dir):
    """K1-K3, O2, O3: export the eight stored marts as ordered CSV; rows, order and content read back from the files."""
    tables = Tables(spark, sf_dir)
    base = f"{staging_folder(spark, sf_dir)}/exports-{uuid.uuid4().hex[:8]}"
    written = {}
    for name, (order, single) in EXPORTS.items():
        stored = tables[name]
        keys = [F.col(k[1:]).desc() if k.startswith("-") else F.col(k) for k in order] or stored.columns[:1]
        sinks.export_csv(stored, f"{base}/csv/{name}", keys, single_file=single)
        written[name] = stored, f"{base}/csv/{name}", order
    return sinks.checked_exports(spark, written)
