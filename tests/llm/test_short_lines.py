"""Equal lines of one or two words, and of scripts without blanks, are removed."""

import corpus_pipeline
from markforge.llm import op2

ROWS = [(1, "haanth.\nthis line has five words\n你好世界。\n\n"), (2, "Haanth.\nanother one\n你好世界。\n\nनया"),
        (3, "ANOTHER  one\t\nxyz\nxyz"), (4, "你好世界。\nhaanth."), (5, "a b c d e f g x"), (6, "a b c d e f g y"), (7, None)]


def test_short_lines(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_near, r.kept_text) for r in op2.line_dedup(docs, op2.EVERY).collect()}
    assert got == {1: (0, 0, ROWS[0][1]), 2: (2, 0, "another one\n\nनया"), 3: (2, 0, "xyz"), 4: (2, 0, ""), 5: (0, 0, ROWS[4][1]),
                   6: (1, 1, ""), 7: (0, 0, "")}
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.n_removed for r in op2.op2_line_dedup(spark, str(tmp_path)).collect()} == {i: v[0] for i, v in got.items()}


def test_copies_leave_no_stubs(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, str(tmp_path)).collect()}
    assert 4 not in got and got[2] == "another one\n\nनया"
