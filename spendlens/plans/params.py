"""Parameters of the method (the reference's constants, made explicit)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass
class Params:
    """Knobs of the method; defaults are the reference's, test values below."""
    first_fy: int = 2017
    last_fy: int = 2023
    fy_mode: str = "documented"        # or "as_coded" (text ranges on year-month)
    spread_mode: str = "documented"    # or "as_coded" (case 2 divides positives)
    structure: str = "2A"
    country: str = "USA"
    code_mode: str = "token"           # or "substring"
    first_uei_only: bool = False       # True: only the first UEI of an address goes on
    cell: float = 0.05                 # grid cell (degrees) of the point-in-polygon index
    band: float | None = None          # y band of the edge index (default cell / 4)
    spatial_index: str = "grid"        # or "cover": quadtree cells of a bounded number for each polygon
    code_map: dict = field(default_factory=dict)
    placement_join: str = "inner"      # "left": keep transactions without place/registry rows (docs)
    broadcast_limit: int | None = None # bytes; None = operators.joins.DEFAULT_BROADCAST_LIMIT, 0 = never
