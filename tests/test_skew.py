"""A hot class (60 % of all rows) must not change exact results: caps,
stratified splits and ranks are computed from counts, never by sorting the
hot class in one task."""

import math

import numpy as np
import pandas as pd

from traitlab.functions.columns import DET_ADD, DET_MOD, DET_MULT
from traitlab.operators import sample as B


def det_py(k, seed=42):
    return (k * DET_MULT + DET_ADD * seed) % DET_MOD


def test_hot_class_exact(spark):
    rng = np.random.default_rng(21)
    n = 20_000
    pdf = pd.DataFrame({"row_id": rng.choice(1 << 31, n, replace=False).astype(np.int64), "g": rng.choice(["hot", "b", "c"], n, p=[0.6, 0.3, 0.1])})
    df = spark.createDataFrame(pdf).repartition(8)
    srt = pdf.assign(d=pdf.row_id.map(det_py)).sort_values(["d", "row_id"])

    capped = {r[0] for r in B.cap_classes(df, "g", "row_id", cap=2500).select("row_id").collect()}
    assert capped == set(srt.groupby("g").head(2500).row_id)

    sp = B.split(df, "row_id", 0.2, stratify="g").groupBy("g", "split").count().toPandas()
    for g, cnt in pdf.g.value_counts().items():
        test = int(sp[(sp.g == g) & (sp.split == "test")]["count"].sum())
        assert test == math.floor(0.2 * cnt + 0.5)

    ranks = B.det_rank(df, "row_id", by=["g"]).toPandas().set_index("row_id")["rank"]
    exp = srt.assign(rank=srt.groupby("g").cumcount()).set_index("row_id")["rank"]
    assert (ranks.sort_index() == exp.sort_index()).all()
