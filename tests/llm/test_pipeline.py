"""Each stage of the pipeline against a plain version over its own input, and the whole."""

import re

import corpus_pipeline as C
import numpy as np

from tessella.llm import language_id
from tessella.llm import toxicity as T
from tests.llm.test_duplicates import brute_components
from tests.llm.test_tokens import check_packing


def test_stages_and_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in C.STAGES[:-1]:
        given = docs
        docs = C.materialize(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        kept = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert kept.items() <= seen.items() and docs.count() == len(kept)
        if name == "toxicity":
            labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
            toxic = {r["doc_id"] for r in T.score(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels).filter("predicted = 1").collect()}
            assert seen.keys() - kept.keys() == toxic
        elif name == "language":
            # the stage's rule, written out over the fitted models and its own input
            before = list(seen)
            fitted = language_id.fit(given)
            bits, size, letters = fitted.bits([seen[d] or "" for d in before])
            random = -np.log2(fitted.model.uniform)
            rejected = set()
            for d, row, n, any_letter in zip(before, bits, size.tolist(), letters, strict=True):
                j = int(row.argmin())
                limit = max(fitted.mean[j] + 6 * fitted.deviation[j], (fitted.mean[j] + random) / 2)
                if not any_letter or (row[j] > limit and n >= 40):
                    rejected.add(d)
            assert seen.keys() - kept.keys() == rejected
        elif name == "exact_dedup":
            first = {}
            for d in sorted(seen):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", seen[d]), d)
            assert kept.keys() == set(first.values())
        elif name == "jaccard":
            assert kept.keys() == {c for _, _, c in brute_components(list(seen.items()))}
        seen = kept
    rows = C.run(spark, sf_dir).collect()
    check_packing(rows, seen)
    assert C.run in __import__("__spark_entry__").queries().values()
