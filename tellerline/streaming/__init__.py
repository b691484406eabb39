"""Stage -> bronze and bronze -> silver jobs."""

from tellerline.streaming.bronze import run_stage_to_bronze
from tellerline.streaming.silver import (
    prepare_customers,
    prepare_locations,
    prepare_visits,
    run_customers,
    run_locations,
    run_visits,
)
from tellerline.streaming.supervise import supervise

__all__ = [
    "prepare_customers",
    "prepare_locations",
    "prepare_visits",
    "run_customers",
    "run_locations",
    "run_stage_to_bronze",
    "run_visits",
    "supervise",
]
