"""Write PLANS.md: formatted physical plans of the headline queries (sf0.01)."""
import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgerlake.operators import bronze as B  # noqa: E402
from ledgerlake.operators import features as FE  # noqa: E402
from ledgerlake.operators import marts as M  # noqa: E402
from ledgerlake.operators import quality as Q  # noqa: E402
from ledgerlake.operators.history import prior_history_scan  # noqa: E402
from ledgerlake.operators.quantiles import exact_quantiles  # noqa: E402
from ledgerlake.plans import catalog as C  # noqa: E402
from ledgerlake.plans import job as J  # noqa: E402
from ledgerlake.session import local_session  # noqa: E402
from ledgerlake.operators import silver as S  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
spark = local_session(shuffle_partitions=8)
spark.sparkContext.setLogLevel("ERROR")
sink = tempfile.mkdtemp(prefix="ledgerlake-plans-")
params = J.RunParams(run_id="plans")
bronze = J.bronze_stage(spark, C.raw(spark, sf), sink, params)
silver = J.silver_stage(spark, bronze, sink, params)


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)


def formatted(df) -> str:
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.sub(r"#\d+L?", "", text)


from ledgerlake.contracts import BRONZE_REQUIRED_COLUMNS  # noqa: E402
from ledgerlake.functions import record_hash  # noqa: E402

history_input = silver.select("origin_account", "step", "amount", "is_fraud",
                              record_hash(BRONZE_REQUIRED_COLUMNS).alias("_record_hash"))
sections = [
    ("Silver from Bronze (filter pushed into the Bronze scan)", S.silver_transactions(bronze)),
    ("Fraud monitoring from written Silver (pushed filter, pruned columns)", M.fraud_monitoring(silver)),
    ("High-value summary (pushed filter, partial + final aggregate)", M.high_value_summary(silver)),
    ("Calendar rollup: five marts and the day estimates (merged sketches) from one aggregate of cells", M.calendar_rollup(silver)),
    ("Distinct accounts per day (narrow pairs, no Expand)", M.distinct_accounts(silver, ["transaction_day"])),
    ("Cardinality of all columns (narrow pairs, no Expand)", Q.cardinality_profile(B.to_raw_names(bronze))),
    ("Exact quantiles: what is left after the counts are written (no rank)", exact_quantiles(silver, "amount", [0.25, 0.5, 0.95], ["transaction_type"])),
    ("Ruled layer: rules and statuses, written without a shuffle", J.R.validated_bronze(B.bronze_ruled(B.to_raw_names(bronze)))),
    ("Fraud features, ordinary accounts (window path)", FE.fraud_feature(silver)),
    ("Prefix scan for hot accounts (checkpointed ranges, N-row carry broadcast)",
     prior_history_scan(history_input, "origin_account", ["step", "_record_hash"])),
    ("Quality report (one aggregate pass + duplicates + missing steps)", Q.quality_report(C.raw(spark, sf))),
]


def trim(text: str, width: int = 260) -> str:
    lines = []
    for line in text.splitlines():
        lines.append(line if len(line) <= width else line[:width] + " ...")
    return "\n".join(lines).strip()


out = ["# Physical plans of the headline queries\n\n",
       "Generated by `tools/plans.py` on sf0.01 (local[8], 8 shuffle partitions, AQE on). "
       "Expression ids removed, long lines cut.\n"]
for title, df in sections:
    out.append(f"\n## {title}\n\n```\n{trim(formatted(df))}\n```\n")
with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
    fh.write("".join(out))
print("wrote PLANS.md")
