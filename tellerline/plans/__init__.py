"""Gold summaries: pure plans plus the jobs that store them."""

from tellerline.plans.daily import daily_by_atm, daily_by_bank, distinct_atm_bank, run_daily, with_bank
from tellerline.plans.incremental import run_daily_incremental
from tellerline.plans.monthly import monthly_by_customer, run_monthly

__all__ = [
    "daily_by_atm",
    "daily_by_bank",
    "distinct_atm_bank",
    "monthly_by_customer",
    "run_daily",
    "run_daily_incremental",
    "run_monthly",
    "with_bank",
]
