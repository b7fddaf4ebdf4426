"""Column expressions. Every function takes and returns ``Column`` objects so
that the work stays inside whole-stage code generation."""

from tarmac.functions.timeparts import (  # noqa: F401
    hhmm_minutes, local_schedule, sched_dep_utc, crs_dep_hour, hour_bin,
    hour_of, dow_sunday0, to_ntz, gap_seconds,
)
from tarmac.functions.flags import (  # noqa: F401
    SENTINEL, is_present, late_flag, positive_part, precip_flag, precip_indicator,
    wind_sin, wind_cos, coco_text, rain_label,
)
from tarmac.functions.bins import cut_index, cut_label, hist_center  # noqa: F401
