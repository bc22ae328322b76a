"""The pipeline's stages one after another, on the small tables."""

import corpus_pipeline as P
from spindrift.llm import decontamination, line_dedup, quality_rules
from spindrift.llm.common import cut

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality", "lines", "near_duplicates", "benchmark", "mixing"]
    trusted = spark.read.parquet(f"{DATA}/labels.parquet").where("quality = 1").select("doc_id")
    before, sizes = docs, []
    for k, (name, stage) in enumerate(P.STAGES):
        after = cut(stage(spark, before, DATA))
        sizes.append(after.count())
        assert after.columns[: len(docs.columns)] == docs.columns and (k == len(P.STAGES) - 1 or after.columns == docs.columns)
        ids = {r[0] for r in after.select("doc_id").collect()}
        assert ids <= {r[0] for r in before.select("doc_id").collect()}
        if name == "quality":
            assert ids == {r["doc_id"] for r in quality_rules.quality(docs, trusted).where("kept").collect()}
        if name == "lines":
            assert sizes[-1] == sizes[-2] and line_dedup.removed_lines(before).count() > 0
            assert all(r["n_chars"] == len(r["text"]) for r in after.collect())
        if name == "benchmark":
            assert not decontamination.contamination(after, spark.read.parquet(f"{DATA}/benchmark.parquet")).where("contaminated").count()
        if name == "mixing":
            assert all(r["rate"] > 0 for r in after.collect())
        before = after
    assert sizes[0] < docs.count() and sizes[2] < sizes[1]
    assert P.run(spark, DATA).count() == sizes[-1]


def test_stages_on_odd_documents(spark):
    long = "word " * 20_000 + "end"
    rows = [(1, None, None, None, None), (None, "a text without an id that has more than ten words in it", "en", None, 3), (2, "", "en", "s", 0), (3, " \n\t", None, "s", 3), (4, long, "en", "s", len(long)), (5, "twice\nthe same", "en", "s", 14), (5, "twice\nthe same", "en", "s", 14)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").selectExpr("*", "'x' as _id", "1 as h", "'y' as gone", "0 as p_0")
    for name, stage in P.STAGES:
        out = cut(stage(spark, docs, DATA))
        assert out.columns[: len(docs.columns)] == docs.columns and out.count() <= len(rows)
        assert all((r["_id"], r["h"], r["gone"], r["p_0"]) == ("x", 1, "y", 0) for r in out.collect())
        assert stage(spark, docs.limit(0), DATA).count() == 0
