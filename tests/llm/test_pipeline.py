"""The corpus pipeline stage by stage on the smallest table."""

import corpus_pipeline as P

from shiftlake.llm import near_dup

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    twin = docs.limit(3)
    docs = docs.union(twin)  # repeated rows
    kept = {}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        kept[name] = out.count()
        if name == "near_dedup":
            left = near_dup.near_duplicates(out).collect()
            assert all(r.kept for r in left) and len({r.doc_id for r in left}) == len(left)
        docs = out
    assert 0 < kept["decontamination"] <= kept["near_dedup"] < kept["quality"]
    assert kept["pii"] == kept["decontamination"]
    packed = P.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == kept["pii"]


def test_run_gives_the_packed_rows(spark):
    assert P.run(spark, SF).count() > 0
    assert P.ORACLE_SQL is None


def test_near_dedup_judges_texts_not_ids(spark):
    text = lambda name: " ".join(f"{name}{k}" for k in range(60))
    rows = [(3, text("x")), (5, text("x") + " near"), (5, text("b")), (None, text("n")), (None, text("n")), (None, None)]
    more = [(7, text("z")), (7, text("z"))]  # a repeated row: the fate of rows without id doesn't hang on it
    for extra in ([], more):
        table = spark.createDataFrame(rows + extra, "doc_id long, text string")
        out = P.near_dedup(spark, table, SF)
        assert out.columns == table.columns
        left = sorted((r.doc_id or 0, r.text or "") for r in out.collect())
        assert left == sorted([(0, ""), (0, text("n")), (0, text("n")), (3, text("x")), (5, text("b")), *extra[:1]])
    unique = [(1, text("x")), (2, text("x") + " near"), (None, text("n")), (None, text("n"))]
    assert P.near_dedup(spark, spark.createDataFrame(unique, "doc_id long, text string"), SF).count() == 3
