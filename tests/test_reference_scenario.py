"""The source job's own input scenario, end to end, against brute force."""

import os
from collections import defaultdict
from decimal import Decimal as D

from tillroll.plans import batch, synth
from tillroll.sinks import parquet


def test_reference_batch_through_the_job(spark, tmp):
    land = os.path.join(tmp, "landing")
    sizes = {"sales_range": 3000, "sales_day": 2000, "sales_extra": 300, "sales_missing": 50}
    synth.write_reference_batch(spark, land, sizes)
    customer, store, team = synth.synth_dims(spark)
    out = os.path.join(tmp, "out")
    res = batch.run(spark, batch.JobConfig(
        landing=[land], out_root=out, run_id="000000000000001",
        customer=customer, store=store, sales_team=team, ledger_path=f"{out}/ledger",
        partition_keys=("sales_month", "store_id")))
    # the missing-column file(s) are set aside, the other three layouts pass
    assert res.layouts == 2 and res.files_set_aside >= 1

    # brute force over the accepted files' rows
    names = {r.customer_id: (r.first_name, r.last_name, r.address, r.phone_number)
             for r in customer.collect()}
    totals = defaultdict(D)
    n = 0
    for kind in ("sales_range", "sales_day", "sales_extra"):
        for r in spark.read.option("header", "true").csv(os.path.join(land, kind)).collect():
            totals[(int(r.customer_id), r.sales_date[:7])] += D(r.total_cost)
            n += 1
    got = {(r.customer_id, r.sales_date_month): r.total_sales
           for r in parquet.latest_snapshot(spark, f"{out}/customer_monthly_total").collect()}
    assert got == dict(totals)
    full = {r.full_name for r in parquet.latest_snapshot(spark, f"{out}/customer_monthly_total").collect()}
    assert full <= {f"{a} {b}" for a, b, _, _ in names.values()}
    assert spark.read.parquet(f"{out}/sales_team_partitioned").count() == n  # one run
    team_tot = parquet.latest_snapshot(spark, f"{out}/sales_team_monthly_total")
    assert sum(r.total_sales for r in team_tot.collect()) == sum(totals.values())
