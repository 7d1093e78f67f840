"""Print the physical plans of the main jobs (tree part + scan details).

Usage: python scripts/show_plans.py SF_DIR > PLANS.txt
"""

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from charloom.operators import counts  # noqa: E402
from charloom.operators.trim import trim  # noqa: E402
from charloom.plans import queries as Q  # noqa: E402
from charloom.plans.model import CharModel, count_corpus  # noqa: E402
from charloom.session import get_spark  # noqa: E402


def tree(df, title):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head = "\n".join(text.split("\n\n\n")[0].splitlines()[:70])
    scans = re.findall(r"\(\d+\) Scan parquet.*?\n(?:.*\n)*?ReadSchema: .*", text)
    print(f"## {title}\n\n```\n{head.strip()}\n```\n")
    for s in scans[:2]:
        lines = [ln for ln in s.splitlines() if ln.startswith(("(", "PushedFilters", "ReadSchema"))]
        print("```\n" + "\n".join(lines) + "\n```\n")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark()
    corpus = Q._corpus(spark, sf)
    tree(counts.window_counts(corpus.select("line_id", "text"), 6), "Window counting (G1, A2 stage 1)")
    raw = count_corpus(corpus, 6)
    tree(trim(raw.pairs, 5, 300_000, 48), "Trim (P4: A5 A6 L6 L7)")
    model = CharModel.from_counts(raw, Q.BASELINE).prepare(3)
    dev = Q._dev(spark, sf)
    tree(model.predict(dev), "Predict (P5), no guess table")
    tree(CharModel.from_counts(raw, Q.BASELINE).prepare(3, guess_table=True).predict(dev), "Predict (P5), guess table")
    from charloom.operators import evaluate
    tree(evaluate.grade(model.predict(dev), dev), "Grade (P6)")


if __name__ == "__main__":
    main()
