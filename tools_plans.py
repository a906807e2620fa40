"""Write PLANS.md: physical plans of representative queries (sf0.01, local).

Broadcast joins are switched off so the plans show the shuffles a large
cluster would run; long expressions are cut for reading.
"""

from __future__ import annotations

import io
import sys
from contextlib import redirect_stdout

sys.path.insert(0, ".")

KEYS = ["eval_train_validate_test", "feat_page_pipeline", "topk_per_key", "agg_rating_stats",
        "split_80_10_10", "eval_auc_hard"]


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    lines = []
    for ln in buf.getvalue().splitlines():
        lines.append(ln if len(ln) <= 170 else ln[:167] + "...")
    return "\n".join(lines)


def main() -> None:
    from pyspark.sql import functions as F

    from orchard.operators import linear
    from orchard.plans import prepared as P
    from orchard.plans.registry import QUERIES
    from orchard.session import local_session
    spark = local_session(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    sf = "/root/testdata/sf0.01"
    out = ["# PLANS", "", "Physical plans at sf0.01 with broadcast joins disabled (the shape a large",
           "cluster runs). Generated by `tools_plans.py`.", ""]
    for k in KEYS:
        out += [f"## {k}", "", "```", _plan(QUERIES[k](spark, sf)), "```", ""]
    prep = P.binary(spark, sf)
    train = prep.part("train").select("features", "label", "u")
    w = [0.1] * prep.dim
    step = train.selectExpr(
        "features AS __x", f"CAST({linear._flag_sql('u', 1, 0.5)} AS DOUBLE) AS b0",
        f"({linear._multiplier_sql('logistic', linear._dot_sql('__x', w), 'CAST(label AS DOUBLE)')})"
        " * b0 AS m0").selectExpr("CAST(sum(b0) AS BIGINT) AS n0",
                                  *[f"sum(m0 * __x[{j}]) AS g0_{j}" for j in range(prep.dim)])
    out += ["## one SGD step (one configuration)", "", "```", _plan(step), "```", ""]
    with open("PLANS.md", "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
