"""Write the physical plans of representative registered queries to docs/PLANS.md.

    python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkloom.plans.registry import all_queries  # noqa: E402
from sparkloom.session import local_session  # noqa: E402

SHOWN = ["run_query_spec", "pred_not_in", "profile_columns", "text_vectors_hashing", "text_entities", "cross_attention",
         "image_texture"]

NOTES = {
    "run_query_spec": "The spec's filter reaches the scan (`PushedFilters`), only the five used columns are read, and the "
                      "aggregate is partial before its only shuffle; the final sort sees one row per group.",
    "pred_not_in": "`NOT EXISTS` becomes a left anti join; the small filtered side is broadcast here, and at scale the "
                   "planner (or AQE) switches to a shuffled join on the key.",
    "profile_columns": "One wide aggregate for counts / min / max, plus a long form `(ordinal, value)` deduplicated by a "
                       "partial hash aggregate for exact distinct counts (no `Expand`).",
    "text_vectors_hashing": "Tokens are counted per (doc, bucket) map-side (a document is one input row, so the partial "
                            "aggregate is already complete); the IDF table (<= n_features rows) is broadcast; one window "
                            "per document gives the norm.",
    "text_entities": "Every rule's matches are unioned and hash-partitioned by document once; the offset window "
                     "(doc, rule) and the overlap window (doc) both use that partitioning.",
    "cross_attention": "Blocked product: text blocks (collect_list of at most block_rows rows) are replicated over the "
                       "image block ids and equi-joined to the image blocks; `MapInPandas` multiplies one block pair per "
                       "row; with several image blocks an exact log-sum-exp merge follows.",
    "image_texture": "Horizontal neighbours come from a window over one image row `(image_id, y)`; sums and the joint "
                     "histogram are partial aggregates per image before their shuffles.",
}


def plan_tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n(1)")[0].strip()  # the tree, without the per-node details


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=16)
    reg = all_queries()
    out = ["# Physical plans of representative queries", "",
           f"Generated by `tools/explain_plans.py` at `{sf}` (`explain(\"formatted\")`, tree only).", ""]
    for name in SHOWN:
        df = reg[name].fn(spark, sf)
        out += [f"## {name}", "", NOTES.get(name, ""), "", "```", plan_tree(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
