"""Domain constants that parameterise the operators.

The reference hard-codes one automated scheduling agent (a user id plus two
channel ids) and one "initial evaluation" specialty id. Here they are plain
parameters so tests and adapters can choose their own values.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Appointment status codes (id -> meaning), 12 rows.
STATUS_NAMES: tuple[tuple[int, str], ...] = (
    (1, "to confirm"),
    (2, "no answer"),
    (3, "rescheduled"),
    (4, "confirmed"),
    (5, "cancelled"),
    (6, "check-in"),
    (7, "attended"),
    (8, "concluded"),
    (9, "unresolved"),
    (10, "approval"),
    (11, "awaiting return"),
    (12, "return created"),
)

# Status groups used by the business rules.
ATTENDED_STATUSES: tuple[int, ...] = (7, 8)
CONFIRMED_STATUS = 4
CONCLUDED_STATUS = 8
RESCHEDULED_STATUS = 3
RESCUE_PRIOR_STATUSES: tuple[int, ...] = (5, 11)

# Lead label, default regional, limits.
CAMPAIGN_LABEL = "campanha"
AD_ORIGIN_ATTRIBUTE = "anuncio_de_origem"
DEFAULT_REGIONAL = "SP"
MAX_PERIOD_DAYS = 92
ERROR_TEXT_MAX = 500
PAGE_SIZE_MIN, PAGE_SIZE_MAX, PAGE_SIZE_DEFAULT = 10, 100, 25
DRILL_LIMIT_MIN, DRILL_LIMIT_MAX, DRILL_LIMIT_DEFAULT = 10, 500, 100
ATTRIBUTION_WINDOW_DAYS = 30
RESCHEDULE_GAP_SECONDS = 24 * 3600


@dataclass(frozen=True)
class Domain:
    """Who the automated agent is and which specialty is the first evaluation."""

    agent_user_id: str = "mc"
    agent_channel_ids: tuple[str, ...] = ("mc_channel",)
    eval_specialty_id: str = "eval"
    campaign_label: str = CAMPAIGN_LABEL
    window_days: int = ATTRIBUTION_WINDOW_DAYS
    attended: tuple[int, ...] = field(default=ATTENDED_STATUSES)
    # width of the time buckets that split a patient's attribution window
    # (None = the window itself; smaller = finer split of very active patients)
    asof_bucket_days: int | None = None
    # split patients by range partitions with seams instead (also within one instant)
    asof_seams: bool = False


DEFAULT_DOMAIN = Domain()
