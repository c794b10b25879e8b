"""The pipeline's stages, each held against its own input."""

import corpus_pipeline
from kawara.llm.common import DOCUMENT_COLUMNS
from tests.llm.test_native import ascii_lower
from tests.llm.test_near_dedup import brute


def test_stages_and_run(spark, docs, awkward, tmp_path):
    good = [(50 + i, " ".join(f"The word{i} and that word{i * j % 97} of it, is here." for j in range(30))) for i in range(20)]
    between = " ".join(f" The end{i}, and it is" for i in range(7))  # shares between 0.80 and 0.85 with its like
    rows = awkward + good + [(80, good[3][1]), (81, good[4][1] + " More words."), (82, good[5][1] + between)] + [(90, "JUNK!! " * 40), (91, "x&&& y$$$ " * 30)]
    docs(rows, extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in df.collect()]
        out = stage(spark, df, str(tmp_path))
        assert tuple(out.columns) == DOCUMENT_COLUMNS
        out.write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
        after = [(r.doc_id, r.text) for r in df.collect()]
        assert set(after) <= set(before)
        if name == "near_dedup":
            assert len(after) == brute(before, corpus_pipeline.NEAR_PERCENT)[1]
        if name == "exact_dedup":
            assert len(after) == len({ascii_lower(t) for _, t in before})
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == {i for i, _ in after}


def test_empty_table(spark, docs, tmp_path):
    docs([], extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
