"""The reports, composed from the operators."""

from farebox.plans.card_tips import card_tips, card_tips_sql
from farebox.plans.hourly import HOURLY_NEEDS, hourly_profile, hourly_profile_arrow, hourly_profile_histogram
from farebox.plans.tip_days import TIP_NEEDS, top_tip_days, top_tip_days_sql
from farebox.plans.zone_balance import zone_balance
from farebox.plans.zone_flows import zone_flows, zone_flows_sql
from farebox.plans.zone_join import zone_join
from farebox.plans.zone_revenue import zone_revenue

__all__ = [
    "HOURLY_NEEDS",
    "TIP_NEEDS",
    "card_tips",
    "card_tips_sql",
    "hourly_profile",
    "hourly_profile_arrow",
    "hourly_profile_histogram",
    "top_tip_days",
    "top_tip_days_sql",
    "zone_balance",
    "zone_flows",
    "zone_flows_sql",
    "zone_join",
    "zone_revenue",
]
