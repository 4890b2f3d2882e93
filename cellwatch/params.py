"""Every limit the operators use, as one named, overridable record.

Comments tell two kinds of default apart: *documented* limits belong to the rule set
this engine reproduces; *assumed* ones fill a gap it leaves open and are ours to tune
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # --- time layout -------------------------------------------------------------
    slot_seconds: int = 7200            # documented: 2-hour slot, 12 per day
    soc_bin: float = 5.0                # documented: 5 % bins, 20 of them
    soc_bins: int = 20
    curr_edges: tuple[float, ...] = (-100.0, 0.0, 100.0)   # assumed
    retention_days: int = 30            # documented

    # --- sample quality ----------------------------------------------------------
    missing_share: float = 0.3          # documented: strictly more than 30 %
    jump_soc: float = 5.0               # assumed
    jump_volt: float = 20.0             # assumed
    station_hot_c: float = 50.0         # documented
    station_cold_c: float = -30.0       # documented
    station_high_v: float = 410.0       # documented
    station_low_v: float = 250.0        # documented

    # --- inference signals (documented) ------------------------------------------
    hot_c: float = 55.0
    temp_spread_c: float = 30.0
    cell_low_mv: float = 1300.0
    cell_high_mv: float = 4500.0
    spread_mv: float = 300.0
    iso_kohm: float = 100.0
    cool_c: float = 40.0
    cool_spread_mv: float = 200.0
    tdiff_c: float = 15.0
    tdiff_flat_mv: float = 50.0

    multi_signal: int = 2               # assumed: metrics beyond a limit that make several

    # --- sustained insulation ----------------------------------------------------
    iso_lv2_frames: int = 3             # assumed
    iso_lv3_seconds: int = 600          # assumed

    # --- hazard score ------------------------------------------------------------
    hazard_window: int = 100            # documented: frames
    hazard_limit: float = 10.0          # documented
    # assumed: one weight per indicator, in the order of operators.signals.HAZARD
    hazard_weights: tuple[float, ...] = (1.0, 1.0, 1.0, 1.0, 1.0, 1.0)

    # --- rest after charge -------------------------------------------------------
    rest_seconds: int = 300             # documented
    drop_rate_lt: float = 1.5           # documented limit, direction as written
    outlier_gt: float = 0.66            # documented
    selfdch_cell_type: str = "NCM"      # documented
    parking_growth_mv: float = 10.0     # assumed

    # --- voltage spread ----------------------------------------------------------
    lfp_spread_mv: float = 25.0         # documented
    lfp_deviation_v: float = 0.05       # assumed
    ncm_spread_mv: float = 16.0         # documented
    ncm_deviation_v: float = 0.07       # documented
    high_spread_mv: float = 100.0       # documented
    high_spread_frames: int = 1         # documented: more than one frame
    rank_shift: float = 5.0             # assumed
    alphaq_energy_kwh: float = 70.0     # documented
    iqr_factor: float = 1.5             # assumed
    math_quantile: float = 0.99         # assumed

    # --- sampling ----------------------------------------------------------------
    pack_gap_v: float = 20.0            # documented
    cold_init_c: float = -40.0          # documented
    cold_init_frames: int = 60          # documented
    init_share: float = 0.1             # assumed
    sigma: float = 3.0                  # assumed

    # --- diagnosis ---------------------------------------------------------------
    suspect_seconds: int = 600          # assumed

    # --- streaming ---------------------------------------------------------------
    watermark: str = "10 minutes"       # assumed
    rest_tolerance_seconds: int = 3600  # assumed

    # --- features ----------------------------------------------------------------
    quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)       # assumed points
    # documented initial values a bus reports before the first measurement
    init_cell_v: tuple[float, ...] = (4.096, 5.094, 65535.0)
    init_probe_c: tuple[float, ...] = (-40.0, -50.0, 255.0)
    init_iso_kohm: tuple[float, ...] = (5000.0, 10000.0, 60000.0)


DEFAULTS = Params()
