"""Evaluation report: a tidy metric table, rendered as Markdown.

``metric_table`` lays every figure out as one row (section, name, value); grades and
recommendations come from :func:`terracover.operators.metrics.metric_grades`. Rendering
needs only these rows, so the same table serves the report, a CSV and a dashboard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracover.operators.metrics import metric_grades

COUNTS = ("tn", "fp", "fn", "tp")
PER_CLASS = ("precision", "recall", "f1")
HINTS = {
    "low_recall": "Class 1 is often missed. Look at its weight, and at how far label polygons were eroded.",
    "ready_for_production": "The classes separate well enough to score new zones.",
    "many_false_positives": "Class 1 is claimed too often. Sweep the threshold before scoring.",
}


def _section(name: str) -> str:
    if name in COUNTS:
        return "counts"
    return f"class {name[-1]}" if name[:-2] in PER_CLASS and name[-2:] in ("_0", "_1") else "overall"


def metric_table(evaluation: DataFrame) -> DataFrame:
    """(section, name, value) of a one-row evaluation; counts become doubles."""
    names = [c for c, t in evaluation.dtypes if t in ("double", "bigint", "int")]
    cells = [F.struct(F.lit(_section(n)).alias("section"), F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in names]
    return evaluation.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def evaluation_report(evaluation: DataFrame, ranked: DataFrame, model_type: str, k: int = 15) -> str:
    """Markdown of one evaluation and the ``k`` strongest features: two small tables and the verdict."""
    rows = metric_table(evaluation).orderBy("section", "name").collect()
    verdict = metric_grades(evaluation).first()
    strongest = ranked.orderBy(F.col("importance").desc(), "feature").limit(k).collect()
    n_rows = int(sum(r["value"] for r in rows if r["section"] == "counts"))
    shown = lambda r: f"{int(r['value'])}" if r["section"] == "counts" else f"{r['value']:.4f}"
    hints = [HINTS[name] for name in (verdict["recommendations"] or "").split(",") if name]
    blocks = [
        [f"# {model_type}: {n_rows} held-out rows",
         f"Separation {verdict['auc_grade']}, recall of class 1 {verdict['recall_grade'].replace('_', ' ')}."],
        ["| part | metric | value |", "| --- | --- | ---: |", *(f"| {r['section']} | {r['name']} | {shown(r)} |" for r in rows)],
        ["| rank | feature | importance |", "| ---: | --- | ---: |",
         *(f"| {i} | {r['feature']} | {r['importance']:.4f} |" for i, r in enumerate(strongest, 1))],
        hints,
    ]
    return "\n\n".join("\n".join(b) for b in blocks if b) + "\n"
