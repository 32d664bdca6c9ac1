"""Write the physical plan (tree, pushed filters, read schemas) of every
registered query to PLANS.md.  usage: python scripts/plans.py [sf_dir]"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.queries import QUERIES  # noqa: E402
from tessera.session import build_session  # noqa: E402


def summarise(text: str) -> str:
    tree, details = text.split("\n\n", 1) if "\n\n" in text else (text, "")
    tree = tree.split("+- == Initial Plan ==")[0]
    keep = [
        ln for ln in details.splitlines()
        if ln.startswith(("PushedFilters", "ReadSchema", "Location"))
    ]
    keep = [re.sub(r"\[file:[^\]]*/", "[", ln) for ln in keep]
    return tree.rstrip() + "\n\n" + "\n".join(dict.fromkeys(keep))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("plans", master="local[8]", shuffle_partitions=16)
    out = [
        "# Physical plans",
        "",
        f"Final adaptive plans of every registered query on `{os.path.basename(sf)}` "
        "(`explain(\"formatted\")` after one run; tree plus pushed filters and read schemas).",
        "Regenerate with `python scripts/plans.py`.",
        "",
    ]
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        df.collect()
        text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        out += [f"## {name}", "", "```", summarise(text), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
