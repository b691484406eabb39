"""Staging hand-made files and running the jobs over them."""

from __future__ import annotations

import datetime as dt
import json
import os
from collections import Counter

from tellerline.params import JobConfig
from tellerline.sources import read_table
from tellerline.streaming import run_stage_to_bronze

DAY1, DAY2, DAY3 = (dt.datetime(2024, 1, d, 6) for d in (6, 7, 8))


def config(root, **overrides) -> JobConfig:
    return JobConfig.under(root, **{"key_buckets": 4, "publish_grace_seconds": 0, **overrides})


def stage(cfg: JobConfig, folder: str, name: str, lines) -> None:
    """One staged file; its modification time follows the order of the calls."""
    path = f"{cfg.stage_root}/{folder}"
    os.makedirs(path, exist_ok=True)
    file = f"{path}/{name}.json"
    with open(file, "w") as out:
        for line in lines:
            out.write((line if isinstance(line, str) else json.dumps(line)) + "\n")
    when = 1_700_000_000 + len(os.listdir(path))
    os.utime(file, (when, when))


def ingest(spark, cfg: JobConfig, *folders: str, **options):
    return [run_stage_to_bronze(spark, cfg, folder, **options) for folder in folders]


def table_rows(spark, cfg: JobConfig, spec, *columns: str) -> Counter:
    df = read_table(spark, cfg, spec)
    return Counter(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def visit(visit_id, day="2024-01-05", atm=1, customer=1, tag="withdrawl", amount=10, time="12:00:00"):
    return {
        "visit_id": visit_id,
        "customer_id": customer,
        "atm_id": atm,
        "withdrawl_or_deposit": tag,
        "amount": amount,
        "fraud_report": "N",
        "transaction_ts": f"{day}T{time}Z",
        "date": day,
    }


def customer(customer_id, first_name="ann", **fields):
    return {
        "customer_id": customer_id,
        "card_number": 1,
        "checking_savings": "checking",
        "first_name": first_name,
        "last_name": "lee",
        "customer_since_date": "2019-05-05",
        "preferred": 1,
        **fields,
    }


def location(atm_id, bank="north", **fields):
    place = {"city": "c", "state": "s", "zip": "z"}
    return {"atm_id": atm_id, "city_state_zip": place, "pos_capability": "yes", "bank": bank, **fields}
