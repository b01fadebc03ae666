"""panelkit: regional panel analytics as lazy Spark DataFrame operators.

Layout
------
sources/    readers: fixture tables, the panel bridge, report grids, link pages,
            indicator JSON, file manifests, region vertices
functions/  column expressions (no Python UDFs): label cleaning, entity
            matching, safe numeric parsing, risk bands, period labels
operators/  DataFrame -> DataFrame operators: panel consolidation, features,
            statistics, grid extraction, evaluation, explanation, scenarios,
            regions, quality checks
plans/      the registered queries (one per inventory item) and their SQL twins
streaming/  incremental consolidation of newly arriving publications
"""

from panelkit.spec import PanelSpec, DEFAULT_SPEC

__all__ = ["PanelSpec", "DEFAULT_SPEC"]
