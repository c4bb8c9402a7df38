"""Column groups and cleaning lookups of the media fact.

Every operator takes a :class:`MediaSpec`, so the same functions serve any fact table
that carries a per-week KPI copied onto granular rows. Columns named here but absent
from a given table are skipped everywhere (the optional-column path).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must equal the analysed workflow's configuration for the
# results to agree; they are stated here once, in their original order.
# ---------------------------------------------------------------------------
DIMENSIONS = [
    "tab",
    "media_type",
    "channel",
    "sub_channel",
    "site",
    "device",
    "platform_type",
    "partner_type",
    "audience",
    "creative",
]

METRICS = [
    "spend",
    "impressions",
    "clicks",
    "video_starts",
    "video_completes",
    "hh_grps_tv",
    "impact",
    "reach",
    "likes",
    "engagements",
    "positive_comments",
    "neutral_comments",
    "base_amount",
    "replies",
    "reposts",
    "mention_volume",
    "post_volume",
    "comments",
]

TARGET = "base_amount"

FILTER_DIMENSIONS = ["media_type", "channel", "sub_channel", "site", "device", "platform_type"]

# Snapshot / driver dimensions used by the overview and sales-driver views.
SNAPSHOT_DIMENSIONS = ["media_type", "channel", "site", "device", "platform_type"]

WEIGHT_PRIORITY = ["spend", "impressions", "reach", "hh_grps_tv", "engagements", "likes"]

TYPO_FIX = {"sub_channel": {"VIdeo": "Video"}}

STRUCTURAL_FILLS = {
    "site": "Unknown",
    "device": "Not Tracked",
    "platform_type": "Unknown",
    "partner_type": "Not Applicable",
    "audience": "Not Applicable",
    "creative": "Unspecified Creative",
}

# Columns correlated with sales on the weekly grain (explainability view).
SALES_CORRELATION_COLUMNS = [
    "spend",
    "impressions",
    "clicks",
    "engagements",
    "reach",
    "video_starts",
    "video_completes",
    "hh_grps_tv",
    "likes",
    "comments",
]

# Columns of the weekly correlation matrix.
CORRELATION_COLUMNS = ["spend", "impressions", "clicks", "engagements", "total_sales"]

# Key metrics summarised by the descriptive-statistics view.
DESCRIBE_COLUMNS = ["spend", "impressions", "clicks", "engagements", "base_amount"]

# Source header -> snake_case name, for tables that still carry spreadsheet headers.
SOURCE_RENAME = {
    "Week Starting Sunday": "activity_date",
    "TAB": "tab",
    "Media Type": "media_type",
    "Channel": "channel",
    "Sub-Channel": "sub_channel",
    "Site": "site",
    "Device": "device",
    "Platform Type": "platform_type",
    "Partner Type": "partner_type",
    "Audience": "audience",
    "Creative": "creative",
    "Spend": "spend",
    "Impressions": "impressions",
    "Clicks": "clicks",
    "Video Starts": "video_starts",
    "Video Completes": "video_completes",
    "HH GRPs (TV)": "hh_grps_tv",
    "Impact": "impact",
    "Reach": "reach",
    "Likes": "likes",
    "Engagements": "engagements",
    "Positive Comments": "positive_comments",
    "Neutral comments": "neutral_comments",
    "Base Dollar Amount": "base_amount",
    "Replies": "replies",
    "Reposts": "reposts",
    "Mention Volume": "mention_volume",
    "Post Volume": "post_volume",
    "Comments": "comments",
}

# Date formats tried, in order, when the activity date arrives as text.
DATE_FORMATS = ["yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy", "M/d/yy", "d-MMM-yyyy", "yyyy/MM/dd"]


@dataclass(frozen=True)
class MediaSpec:
    """Names and parameters of one media fact table."""

    date_col: str = "activity_date"
    week_col: str = "week"
    target_col: str = TARGET
    metrics: tuple = tuple(METRICS)
    weight_priority: tuple = tuple(WEIGHT_PRIORITY)
    typos: dict = field(default_factory=lambda: dict(TYPO_FIX))
    fills: dict = field(default_factory=lambda: dict(STRUCTURAL_FILLS))
    fallback_weight: float = 1.0
    credit_flag: str = "spend_is_credit"
    spend_col: str = "spend"
    # grain at which the copied KPI is repaired (default: one value per week)
    kpi_keys: tuple = ("week",)
    horizon: int = 12
    test_weeks: int = 12
    seed: int = 42

    @property
    def additive(self) -> tuple:
        return tuple(m for m in self.metrics if m != self.target_col)

    def present(self, df, cols) -> list:
        names = set(df.columns)
        return [c for c in cols if c in names]


DEFAULT_SPEC = MediaSpec()
