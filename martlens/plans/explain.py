"""Write the physical plan tree of every registered query to PLANS.md.

    python -m martlens.plans.explain /root/testdata/sf0.1 PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import sys

from martlens.plans.queries import QUERIES
from martlens.session import local_session


def plan_tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    tree = text.split("\n\n\n")[0]
    return tree.replace("== Physical Plan ==\n", "")


def _count(tree: str, word: str) -> int:
    return sum(1 for line in tree.splitlines() if word in line)


def main(sf_dir: str, out: str) -> None:
    spark = local_session(8)
    trees = {name: plan_tree(q(spark, sf_dir)) for name, q in QUERIES.items()}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    no_bc = {name: plan_tree(q(spark, sf_dir)) for name, q in QUERIES.items()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    parts = ["# Physical plans", "",
             f"`explain(\"formatted\")` tree of each registered query on `{sf_dir}` (`local[8]`, AQE on; the "
             "adaptive plan may still switch join strategies at run time from measured sizes).", "",
             "Summary. *Shuffles (cluster)* counts hash exchanges with broadcasts disabled -- the shape when "
             "every joined side is larger than the broadcast threshold, as at 100 TB; *here* is the plan below "
             "(small dimensions broadcast after Catalyst's size check).", "",
             "| query | shuffles (cluster) | shuffles here | broadcasts here |", "| --- | --- | --- | --- |"]
    for name in QUERIES:
        parts.append(f"| {name} | {_count(no_bc[name], 'Exchange') - _count(no_bc[name], 'BroadcastExchange')} | "
                     f"{_count(trees[name], 'Exchange') - _count(trees[name], 'BroadcastExchange')} | "
                     f"{_count(trees[name], 'BroadcastExchange')} |")
    parts.append("")
    for name in QUERIES:
        parts += [f"## {name}", "", "```", trees[name].rstrip(), "```", ""]
    with open(out, "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1", sys.argv[2] if len(sys.argv) > 2 else "PLANS.md")
