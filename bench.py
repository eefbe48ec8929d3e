"""Bench: headline stages of the notice pipeline at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries": {name: sec}, "sf", ...}.
Each stage is forced with a no-op write (full execution, nothing collected).
A fresh checkpoint folder is used so the landing zone and the store are built inside the timing.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    ckpt = tempfile.mkdtemp(prefix="noticespark-bench-")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("noticespark-bench")
             .config("spark.sql.shuffle.partitions", str(max(8, cpus * 2)))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false")
             .config("spark.checkpoint.dir", ckpt)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    from noticespark.functions import codes as C
    from noticespark.functions import text as T
    from noticespark.operators import dedup as DD
    from noticespark.operators import enrich as E
    from noticespark.operators import link as L
    from noticespark.operators import link_classes as LC
    from noticespark.plans import pipelines as PL
    from noticespark.plans import scenario as SC

    times: dict[str, float] = {}
    counts: dict[str, int] = {}

    def run(name, build, count=False):
        t = time.time()
        df = build()
        if count:
            counts[name] = df.count()
        else:
            df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)

    # landing zone (driver tables -> landed records, pages, PDF pages), written once
    t = time.time()
    land = SC.landed(spark, sf_dir)
    times["landing_zone"] = round(time.time() - t, 3)

    run("code_extraction", lambda: land.pages.select("k", C.html_hts_codes(T.html_text(F.col("html"))).alias("codes")))

    t = time.time()
    store = SC.store_events(spark, sf_dir, land)
    times["store_build"] = round(time.time() - t, 3)
    counts["store_events"] = store.count()

    def hashed_fr():
        docs = PL.prepare_documents(PL.fr_documents(land.fr_raw), "federal_register", land.pages,
                                    PL.fr_pdf_codes(land.pdf_pages))
        return DD.dedup_within_batch(DD.dedup_against_store(docs, store.select("source", "content_hash")))

    run("content_hash_dedup", hashed_fr)

    new = PL.link_projection(PL.fr_pipeline(land.fr_raw, land.pages, land.pdf_pages, store,
                                            as_of=SC.AS_OF["federal_register"], link=False).events)
    other = PL.link_projection(store.where(F.col("source") != "federal_register"))
    # Both sides are staged (timed as a stage of its own), so the stages below time linking alone.
    t = time.time()
    for name, df in (("new", new), ("other", other)):
        df.write.parquet(os.path.join(ckpt, "bench-" + name))
    times["link_staging"] = round(time.time() - t, 3)
    new, other = (spark.read.parquet(os.path.join(ckpt, "bench-" + name)) for name in ("new", "other"))
    run("candidate_join", lambda: L.candidate_pairs(new, other, 5))
    run("reachable_pairs", lambda: L.reachable_pairs(new, other), count=True)
    run("scored_links", lambda: L.link_documents(new, other, limit=5))
    run("scored_links_all_candidates", lambda: L.link_documents(new, other, limit=None))
    run("html_tables", lambda: land.pages.select("k", F.size(T.html_tables(F.col("html"))).alias("tables")))
    run("class_links", lambda: LC.link_classes(new, other).edges)

    def whole():
        # the FR run as a job would do it: prepare once, stage, append events, link, append edges
        out = os.path.join(ckpt, "bench-run")
        r = PL.fr_pipeline(land.fr_raw, land.pages, land.pdf_pages, store, as_of=SC.AS_OF["federal_register"], link=False)
        PL.store_batch(r, store, "federal_register", out + "/staging", out + "/events", out + "/edges")
        return spark.read.parquet(out + "/edges")

    t = time.time()
    counts["edges"] = whole().count()
    times["whole_fr_run"] = round(time.time() - t, 3)

    setup = {"landing_zone": times.pop("landing_zone")}   # fixture generation from the driver tables (like dbgen)
    total = round(sum(times.values()), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "notice_pipeline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir, "setup": setup, "cpus": cpus, "spark": spark.version, "rows": counts}))
    spark.stop()


if __name__ == "__main__":
    main()
